"""Profiling. Each report is one pass with partial aggregation on every task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import count_non_null, count_null, quoted


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def _per_column(df: DataFrame, columns: Sequence[str] | None, measure, value: str) -> DataFrame:
    columns = list(columns or df.columns)
    counts = df.agg(*(measure(c).alias(c) for c in columns))
    return counts.unpivot([], [quoted(c) for c in columns], "column_name", value)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column: ``(column_name, nulls)``."""
    return _per_column(df, columns, count_null, "nulls")


def non_null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-NULLs per column: ``(column_name, non_nulls)``."""
    return _per_column(df, columns, count_non_null, "non_nulls")


def group_non_null_counts(
    df: DataFrame, key: str, columns: Sequence[str] | None = None, *, keep_null_key: bool = False
) -> DataFrame:
    """Non-NULLs of every other column per group; rows without a key form no group by default."""
    if not keep_null_key:
        df = df.filter(quoted(key).isNotNull())
    columns = [c for c in (columns or df.columns) if c != key]
    return df.groupBy(quoted(key)).agg(*(count_non_null(c).alias(c) for c in columns))


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Least and greatest value, in one pass."""
    return df.agg(F.min(quoted(column)).alias("min_value"), F.max(quoted(column)).alias("max_value"))


# Types whose least and greatest value Parquet footers tell exactly, also of NULL and odd values.
FOOTER_TYPES = ("tinyint", "smallint", "int", "bigint", "date", "boolean")


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a Parquet table, and the range of each column: ``(column_name, rows, min_value, max_value)``, as texts.

    Columns of whole numbers and dates are answered from the files' footers: Spark's own Parquet source takes
    counts, least and greatest values into its scan, and no row is read. For other types, whose footers may be cut short or
    leave out values, a scan of those columns is added. The files must have statistics, as all that Spark writes do.
    """
    # The source that answers aggregates is the newer one; it is asked for in a session of its own.
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    from_footers = session.read.parquet(path)
    types = dict(from_footers.dtypes)
    known = [c for c in columns if types[c] in FOOTER_TYPES]
    others = [c for c in columns if c not in known]

    def ranges(df: DataFrame, names: Sequence[str]) -> DataFrame:
        found = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.min(quoted(c)).alias(f"min{i}") for i, c in enumerate(names)),
            *(F.max(quoted(c)).alias(f"max{i}") for i, c in enumerate(names)),
        )
        lines = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"min{i}").cast("string").alias("min_value"),
                F.col(f"max{i}").cast("string").alias("max_value"),
            )
            for i, c in enumerate(names)
        ]
        return found.select("rows", F.inline(F.array(*lines))).select("column_name", "rows", "min_value", "max_value")

    parts = [ranges(from_footers, known)] if known else []
    if others:
        parts.append(ranges(session.read.parquet(path), others))
    return reduce(DataFrame.unionAll, parts)


def where_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(quoted(column) == F.lit(value))


def first_rows(df: DataFrame, n: int, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` rows; without an order, any ``n``."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """Schema with fill level: ``(position, column_name, type, nullable, non_nulls)``."""
    shape = F.array(
        *(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.lit(field.nullable).alias("nullable"),
                quoted(field.name).alias("non_nulls"),
            )
            for position, field in enumerate(df.schema)
        )
    )
    return df.agg(*(count_non_null(c).alias(c) for c in df.columns)).select(F.inline(shape))
