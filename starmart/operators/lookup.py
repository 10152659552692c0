"""Joins of a large table to code lists.

No join here carries a broadcast hint. Spark measures the code list (from its files,
or from the text it is parsed from) and broadcasts it below
``spark.sql.autoBroadcastJoinThreshold``; a larger list is joined by shuffle, where
adaptive execution splits the partitions of a hot code. It cannot where the list comes
straight from an aggregate or a window; ``spread_join`` splits hot codes against any list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import quoted


HOT_CODES = 64  # so many codes may be hot at once
TRACKED_CODES = 1 << 13  # codes the sketch follows; it is off by a few rows in so many at most
SLICES_EACH = 16  # a hot code's slices are this much smaller than what a task gets


@dataclass(frozen=True)
class Lookup:
    """A code column and the list that names its codes; ``output`` is the name's column.

    ``unique`` says that the list holds each code once, as staged lists do. Else it is made so first, the greatest name
    of a code that comes several times staying, so that no list multiplies rows.
    """

    column: str
    codes: DataFrame
    code: str
    name: str
    output: str
    unique: bool = False


def enrich_by_name(
    df: DataFrame,
    text_column: str,
    codes: DataFrame,
    name: str,
    output: Sequence[str] | None = None,
) -> DataFrame:
    """Left join on ``upper(text) = name``; rows without a match keep NULL codes.

    A name the list holds twice gives two rows.
    """
    joined = df.join(codes, F.upper(quoted(text_column)) == codes[name], "left")
    return joined.select(*output) if output else joined


def lookup_codes(df: DataFrame, lookups: Sequence[Lookup], *, spread: bool = False) -> DataFrame:
    """Add the name of each code; the code column is compared as text. Rows stay as many as they are.

    ``spread`` splits hot codes before the join (``spread_join``), for rows that are not counted first.
    """
    for number, item in enumerate(lookups):
        key = f"_code{number}"
        codes = item.codes.select(quoted(item.code).cast("string").alias(key), quoted(item.name).alias(item.output))
        if not item.unique:
            codes = codes.groupBy(key).agg(F.max(quoted(item.output)).alias(item.output))
        if spread:
            df = spread_join(df, quoted(item.column).cast("string"), codes, key).drop(key)
        else:
            df = df.join(codes, quoted(item.column).cast("string") == F.col(key), "left").drop(key)
    return df


def conform_codes(
    df: DataFrame,
    column: str,
    codes: DataFrame,
    code: str,
    other: str = "99",
    *,
    unique: bool = False,
    spread: bool = False,
) -> DataFrame:
    """Replace a missing or unlisted code by ``other``.

    ``unique`` says that the list holds each code once, as staged lists do. Else it is made so first, and a code
    that comes twice cannot double rows; but Spark does not split a hot code in a join whose other side comes
    straight from an aggregate, so a list too large to be broadcast should be staged, or joined with ``spread``.
    """
    valid = codes.select(quoted(code).alias("_valid"))
    if not unique:
        valid = valid.distinct()
    if spread:
        joined = spread_join(df, quoted(column), valid, "_valid")
    else:
        joined = df.join(valid, quoted(column) == F.col("_valid"), "left")
    return joined.withColumn(column, F.coalesce("_valid", F.lit(other))).drop("_valid")


def hot_codes(df: DataFrame, code: Column, tasks: int) -> dict[str, int]:
    """Codes that hold more rows than a slice of a task's share, and into how many slices each is cut (an action).

    A frequent-items sketch, merged over all tasks, finds them in one pass over the one column; what comes to the driver
    is at most ``HOT_CODES`` of them. A NULL code joins nothing; its rows are cut as well.
    """
    codes = df.select(code.cast("string").alias("code"))
    found = codes.agg(
        F.expr(f"approx_top_k(code, {HOT_CODES}, {TRACKED_CODES})").alias("items"), F.count(F.lit(1)).alias("rows")
    ).first()
    slice_rows = max(1, found["rows"] // (tasks * SLICES_EACH))
    cut = {item["item"]: -(-item["count"] // slice_rows) for item in found["items"] if found["rows"]}
    return {item: slices for item, slices in cut.items() if slices > 1}


def spread_join(df: DataFrame, code: Column, listed: DataFrame, key: str, *, tasks: int | None = None) -> DataFrame:
    """Left join of ``df`` on ``code`` to the column ``key`` of ``listed``, with hot codes cut into slices.

    Hot codes of ``df`` are found first (``hot_codes``). Their rows are dealt into slices by turns, and only their rows of
    the list are repeated, once for each slice; all other rows are in slice 0. So no task gets a hot code as a whole,
    whatever the list comes from. Result: all columns of both sides.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = hot_codes(df, code, tasks)
    if not cut:
        return df.join(listed, code == quoted(key), "left")
    # At most HOT_CODES entries.
    slices_of = F.create_map(*(F.lit(x) for code_, n in cut.items() if code_ is not None for x in (code_, n)))
    slices = F.lit(1)
    if any(c is not None for c in cut):
        slices = F.coalesce(slices_of[code.cast("string")], slices)
    listed_slices = slices_of[quoted(key).cast("string")] if any(c is not None for c in cut) else F.lit(None).cast("int")
    repeated = listed.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(listed_slices, F.lit(1)) - 1)))
    # Rows without a code meet nothing, wherever they are.
    slices = F.when(code.isNull(), cut.get(None, 1)).otherwise(slices)
    dealt = df.withColumn("_turn", F.pmod(F.monotonically_increasing_id(), slices.cast("bigint")).cast("int"))
    both = (code == quoted(key)) & (F.col("_turn") == F.col("_slice"))
    return dealt.join(repeated, both, "left").drop("_turn", "_slice")


def unmatched_codes(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Codes a list does not hold, with the number of rows: ``(column_name, code, rows)``.

    All code columns are counted in one pass, and counted before the join, so a code used
    by a third of all rows is one row by the time it meets the lists. A NULL code is
    unmatched as well.
    """
    columns = [quoted(item.column).cast("string").alias(item.column) for item in lookups]
    used = (
        df.select(*columns)
        .unpivot([], [quoted(item.column) for item in lookups], "column_name", "code")
        .groupBy("column_name", "code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = reduce(
        DataFrame.unionAll,
        (
            item.codes.select(
                F.lit(item.column).alias("_list"), quoted(item.code).cast("string").alias("_code")
            )
            for item in lookups
        ),
    )
    # Not an anti join: Spark moves one below the aggregate and probes the lists with
    # every row, which took three times as long.
    listed = (F.col("column_name") == F.col("_list")) & (F.col("code") == F.col("_code"))
    return used.join(known, listed, "left").filter("_list IS NULL").drop("_list", "_code")
