"""Sinks and named views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    only_present_partitions: bool = False,
    rebalance: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """Write Parquet (an action).

    ``only_present_partitions`` replaces just the partitions found in ``df``.
    ``rebalance`` shuffles rows by ``partition_by`` first, so that many months in one
    input do not leave a file per task and month; adaptive execution splits a month
    too large for one task, which a plain ``repartition`` would not.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *(F.col(name) for name in partition_by))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_present_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def refresh_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year", "month"), **options
) -> None:
    """Periodic refresh: replace the periods present in ``df``, keep all others (an action)."""
    write_table(df, path, partition_by=partition_by, only_present_partitions=True, **options)


def file_place(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop has them: any store that Spark can write to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = file_place(spark, path)
    files.delete(place, True)


def subfolders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Folders below ``path`` that match, relative to it."""
    files, place = file_place(spark, f"{path}/{pattern}")
    depth = pattern.count("/") + 1
    return ["/".join(f.getPath().toString().rsplit("/", depth)[1:]) for f in files.globStatus(place) or []]


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file from the driver."""
    files, place = file_place(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text_file(spark: SparkSession, path: str) -> str:
    """A small file, to the driver."""
    files, place = file_place(spark, path)
    stream = files.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Name each table for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
