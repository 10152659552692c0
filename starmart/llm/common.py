"""Text expressions and staging shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Collection
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starmart
from starmart.functions.columns import quoted
from starmart.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# White space as the operators mean it: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; the short way where a text has only one-byte characters."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def whole_text(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(quoted(name), F.lit(""))


def other_columns(df: DataFrame, results: Collection[str]) -> list[str]:
    """Columns of ``df`` that stay beside an operator's results: Spark does not tell names apart by case.

    Names that begin with ``_llm_`` are the operators' own.
    """
    taken = {name.lower() for name in results}
    return [c for c in df.columns if c.lower() not in taken and not c.lower().startswith("_llm_")]


def row_key(*names: str) -> list[Column]:
    """128 bits of the named columns. Equal rows share it, and so share whatever follows from the row."""
    columns = [quoted(n) for n in names]
    return [F.xxhash64(*columns), F.xxhash64(F.lit(77), *columns)]


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/starmart-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, short lineage, known size."""
    path = stage_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers find this package and get small batches; called before a Python function is used.

    Workers look where the driver found the package; on a cluster it must be installed or shipped there. Arrow
    batches are cut at 16 MiB instead of Spark's 64; a bound that the session sets itself stays.
    """
    root = str(Path(starmart.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # the default
        spark.conf.set(key, "16m")
