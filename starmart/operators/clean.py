"""Row-wise cleaning. Each operator adds one projection or filter, which Spark merges."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import quoted, to_int_or_null
from starmart.schemas import MALFORMED

log = logging.getLogger(__name__)


def _takes(data_type: T.DataType, value: object) -> bool:
    if isinstance(value, bool):
        return isinstance(data_type, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(data_type, T.NumericType)
    return isinstance(data_type, T.StringType)


def fill_defaults(df: DataFrame, defaults: Mapping[str, float | str | bool]) -> DataFrame:
    """Replace NULL (and NaN) by a default per column.

    A default of another kind than its column, such as a number for a text column, is
    left out and logged.
    """
    kept = {name: value for name, value in defaults.items() if _takes(df.schema[name].dataType, value)}
    skipped = sorted(set(defaults) - set(kept))
    if skipped:
        log.warning("defaults not of the column's type, skipped: %s", ", ".join(skipped))


    def filled(name: str, value: float | str | bool):
        kind = df.schema[name].dataType
        column = quoted(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        return F.coalesce(column, F.lit(value).cast(kind))

    # Not ``na.fill``, which takes a dot in a name for a path.
    return df.withColumns({name: filled(name, value) for name, value in kept.items()}) if kept else df


def cast_columns(df: DataFrame, types: Mapping[str, str], *, strict: bool = False) -> DataFrame:
    """Cast columns in place; fractions are cut when the target is integral.

    A value the target cannot hold becomes NULL, or fails the job if ``strict``.
    """

    def cast(name: str, target: str):
        if strict:
            return quoted(name).cast(target)
        if target == "int" and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            return to_int_or_null(quoted(name))
        return quoted(name).try_cast(target)

    return df.withColumns({name: cast(name, target) for name, target in types.items()})


def fill_and_cast(
    df: DataFrame, columns: Sequence[str], default: float = 0, target: str = "int"
) -> DataFrame:
    """Fill then cast the same columns."""
    return cast_columns(
        fill_defaults(df, dict.fromkeys(columns, default)), dict.fromkeys(columns, target)
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*(quoted(name) for name in names))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of the columns.

    Written as plain NULL tests, which unlike ``dropna`` reach the scan. Of a table read from text, a row
    stays whose value was there but could not be read: the report counts it.
    """
    for name in columns:
        kept = quoted(name).isNotNull()
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            kept = kept & ~F.isnan(quoted(name))
        if MALFORMED in df.columns:
            kept = kept | F.array_contains(quoted(MALFORMED), name)
        df = df.filter(kept)
    return df


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies collapse before the shuffle, so copied rows cannot skew it."""
    return df.distinct()
