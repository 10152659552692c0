"""Sources. Schemas are declared, so no read costs an inference pass unless asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import quoted
from starmart.schemas import ARRIVALS, ARRIVALS_SCHEMA, MALFORMED, SourceColumn

TEXT_FORMATS = ("csv",)


def read_fact(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | None = ARRIVALS_SCHEMA,
    **options: str,
) -> DataFrame:
    """Scan a fact in any format the session can load; ``schema=None`` takes the file's own.

    The arrivals' text formats with a header line are read by its names, see :func:`read_by_name`; without
    one the columns stand in the schema's order.
    """
    header = {k.lower(): str(v).lower() for k, v in options.items()}.get("header") == "true"
    if fmt in TEXT_FORMATS and header and schema is ARRIVALS_SCHEMA:
        return read_by_name(spark, path, ARRIVALS, fmt, **options)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _converted(text: Column, kind: str) -> Column:
    """The text as a value; NULL where it cannot be one. Ordinary numbers are told by their form, without exceptions."""
    text = F.trim(text)
    if kind == "long":
        whole = F.when(text.rlike(r"^[+-]?[0-9]{1,18}$"), text.try_cast("bigint"))
        number = F.when(text.rlike(r"^[+-]?[0-9]*\.?[0-9]*([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
        in_range = (number == F.floor(number)) & (F.abs(number) < 9e18)
        return F.coalesce(whole, F.when(in_range, number.try_cast("bigint")))
    return text.try_cast(kind)


def read_by_name(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[SourceColumn],
    fmt: str = "csv",
    **options: str,
) -> DataFrame:
    """Scan text with a header line: columns are found by name in any order, others are left out.

    A column that the header lacks is an error. Values are read as text and converted by form and range, so
    ``100.0`` and ``3000000000`` are whole numbers. What is there but cannot be converted becomes NULL, and its
    column is named in the array ``_malformed``, by which cleaning tells it from an empty value and the report
    counts it.
    """
    reader = spark.read.format(fmt).options(**{**options, "header": "true", "inferSchema": "false"})
    header = reader.load(path).columns
    missing = [c.source for c in columns if c.source not in header]
    if missing:
        raise ValueError(f"columns missing in the header: {', '.join(missing)}")
    # Every file's header is held against the first one's, so files in another order fail.
    names = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = reader.option("enforceSchema", "false").schema(names).load(path)

    def value(c: SourceColumn) -> Column:
        return quoted(c.source) if c.type == "string" else _converted(quoted(c.source), c.type)

    bad = [
        F.when((F.trim(quoted(c.source)) != "") & value(c).isNull(), F.lit(c.source))
        for c in columns
        if c.type != "string"
    ]
    return raw.select(*(value(c).alias(c.source) for c in columns), F.array_compact(F.array(*bad)).alias(MALFORMED))


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan a CSV file with a header line.

    With a schema the header is checked against it by name, so swapped columns fail
    instead of being read into each other, and what a type cannot hold is NULL. Without one,
    types are inferred, which reads the file once more.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_dictionary(
    spark: SparkSession, paths: str | list[str], record_separator: str | None = None
) -> DataFrame:
    """Scan dictionary texts as rows of ``(source, value)``.

    Each file is one text; with ``record_separator`` a file may hold many texts and is
    split among tasks.
    """
    if record_separator is None:
        texts = spark.read.text(paths, wholetext=True)
    else:
        texts = spark.read.text(paths, lineSep=record_separator)
    return texts.select(F.col("_metadata.file_path").alias("source"), "value")


def read_dictionary_lines(spark: SparkSession, path: str) -> DataFrame:
    """One dictionary text, a file of any size, as its lines ``(block, row, value)``, split among tasks.

    ``block`` is where in the file the task's split begins and ``row`` rises within it, so both together tell the lines'
    order. Write the result before it is used twice: ``row`` also depends on how splits are dealt to tasks.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value"
    )


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan a Parquet table."""
    return spark.read.parquet(path)


def literal_table(
    spark: SparkSession, rows: Sequence[Sequence[object]], names: Sequence[str]
) -> DataFrame:
    """A small constant table, built as an expression.

    Unlike a table made from Python objects, Spark knows its size and can broadcast it.
    """
    structs = [
        F.struct(*(F.lit(value).alias(name) for name, value in zip(names, row, strict=True)))
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
