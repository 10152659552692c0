"""Surrogate ids that do not depend on partitioning, and ids that stay from refresh to refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import quoted

BUCKET_BITS = 20
COPIES_PER_SLICE = 100_000


def _placed(df: DataFrame, columns: list[str], bits: int) -> DataFrame:
    df = df.withColumn("_hash", F.xxhash64(*(quoted(c) for c in columns)))
    return df.withColumn("_bucket", F.shiftrightunsigned("_hash", 64 - bits).cast("bigint"))


def with_surrogate_id(
    df: DataFrame,
    id_column: str = "id",
    *,
    distinct: bool = False,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add a unique, non-null long id that is the same however the rows are partitioned.

    The id is laid out as Spark's own increasing id, a number in the high bits and a
    position in the low ones, but the high bits are a hash bucket of the row's content
    and the position is the row's rank by all columns within that bucket. There is no
    global sort or count, and because the bucket hashes whole rows, a value shared by
    many rows does not fill one bucket.

    ``distinct=True`` says that ``df`` holds no two equal rows and saves the step that
    makes equal rows safe: they would share a bucket, so they are counted, placed once,
    and written out again in slices spread over all tasks. The copies come after the last
    shuffle, so Spark takes the result for as small as the slices: a hint keeps joins from
    broadcasting it. Smaller tables that are to be broadcast to it need ``F.broadcast``.
    """
    columns = df.columns
    low = 63 - bits
    order = [quoted(c) for c in columns]
    # By the whole hash first: rows are told apart by one number before long texts are compared.
    within = Window.partitionBy("_bucket").orderBy("_hash", *order)
    if distinct:
        rank = F.row_number().over(within).cast("bigint") - 1
        return _placed(df, columns, bits).select(
            *order, (F.shiftleft("_bucket", low) + rank).alias(id_column)
        )

    counted = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    before = F.sum("_copies").over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = _placed(counted, columns, bits).select(
        *order,
        (F.shiftleft("_bucket", low) + F.coalesce(before, F.lit(0))).alias("_first"),
        "_copies",
    )
    # In a step of its own: Spark would explode before it ranks if both were in one select.
    starts = F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(COPIES_PER_SLICE))
    slices = placed.withColumn("_from", F.explode(starts))
    # A stated number of partitions: adaptive execution would size them by the slices,
    # which are small, and not by the rows they turn into.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    upto = F.least(F.col("_from") + (COPIES_PER_SLICE - 1), F.col("_copies") - 1)
    return (
        slices.repartition(tasks, "_first", "_from")
        .withColumn("_copy", F.explode(F.sequence("_from", upto)))
        .select(*order, (F.col("_first") + F.col("_copy")).alias(id_column))
        .hint("merge")
    )


# Ids that stay from refresh to refresh: a key map remembers, for every row met, the ids it was given. A row is known by
# 128 bits of its content; of a trillion different rows, two share them with a chance of 10^-15.
KEY_MAP_SCHEMA = "h1 long, h2 long, first long, copies long"


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """128 bits of a row. Spark's hash passes over NULLs, so which columns are NULL is hashed as well."""
    nulls = F.concat(F.lit("|"), *(F.when(quoted(c).isNull(), "1").otherwise("0") for c in columns))
    values = [nulls, *(quoted(c) for c in columns)]
    return F.xxhash64(*values), F.xxhash64(F.lit(101), *values)


def assign_kept_ids(
    df: DataFrame, known: DataFrame | None, *, distinct: bool = False, bits: int = BUCKET_BITS
) -> DataFrame:
    """Each row of ``df`` once, with the ids it keeps or is given; see ``rows_with_kept_ids`` and ``new_keys``.

    ``known`` is the key map of all refreshes before (``KEY_MAP_SCHEMA``), None at the first. Rows and map are merged by the
    row's hash within its hash bucket: one shuffle, in which no value of the data meets all others, and no join. A
    known row keeps its id, whatever else comes or goes. New rows are numbered after the greatest id that the bucket ever
    gave, so ids of rows that are gone are not given again, and a row that returns finds its own.

    Of equal rows as many keep their ids as there were before; further copies are given new ones. Use the result
    twice only after writing it. The map must be used with the ``bits`` it was made with.
    """
    columns, low = df.columns, 63 - bits
    rows = df if distinct else df.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias("_copies"))
    h1, h2 = _row_hashes(columns)
    rows = rows.withColumns({"_h1": h1, "_h2": h2, "_wanted": F.lit(1).cast("long") if distinct else F.col("_copies")})
    rows = rows.select(*map(quoted, columns), "_h1", "_h2", "_wanted")
    old = df.sparkSession.createDataFrame([], KEY_MAP_SCHEMA) if known is None else known
    merged = rows.unionByName(
        old.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.struct("first", "copies").alias("_given")),
        allowMissingColumns=True,
    ).withColumn("_bucket", F.shiftrightunsigned("_h1", 64 - bits).cast("bigint"))

    # Dealt by bucket once; then the windows one after the other, the finest first, so that one sort serves them all.
    merged = merged.repartition("_bucket")
    same_row = Window.partitionBy("_bucket", "_h1", "_h2")
    bucket = Window.partitionBy("_bucket")
    before = bucket.orderBy("_h1", "_h2").rowsBetween(Window.unboundedPreceding, -1)
    merged = merged.withColumn("_kept", F.collect_list("_given").over(same_row))
    merged = merged.withColumn("_next", F.max(F.col("_given.first") + F.col("_given.copies")).over(bucket))
    had = F.reduce("_kept", F.lit(0).cast("long"), lambda n, given: n + given["copies"])
    merged = merged.withColumn("_more", F.greatest(F.col("_wanted") - had, F.lit(0).cast("long")))
    start = F.coalesce("_next", F.shiftleft("_bucket", low)) + F.coalesce(F.sum("_more").over(before), F.lit(0))
    new = F.struct(start.alias("first"), F.col("_more").alias("copies"))
    return (
        merged.withColumn("_new", new)
        .where("_wanted IS NOT NULL")
        .select(
            *map(quoted, columns), "_h1", "_h2", "_wanted", "_more", F.col("_new.first").alias("_first"),
            F.array_sort("_kept").alias("_kept"),
        )
    )


ASSIGNED = ("_h1", "_h2", "_wanted", "_more", "_first", "_kept")


def rows_with_kept_ids(assigned: DataFrame, id_column: str = "id", *, distinct: bool = False) -> DataFrame:
    """All rows of ``assign_kept_ids``, copies included, with their ids.

    With copies, joins do not broadcast the result, as in ``with_surrogate_id``.
    """
    columns = [quoted(c) for c in assigned.columns if c not in ASSIGNED]
    if distinct:
        return assigned.select(*columns, F.coalesce(F.get("_kept", F.lit(0))["first"], F.col("_first")).alias(id_column))
    more = F.when(F.col("_more") > 0, F.array(F.struct(F.col("_first").alias("first"), F.col("_more").alias("copies"))))
    given = F.concat("_kept", F.coalesce(more, F.array().cast("array<struct<first:bigint,copies:bigint>>")))
    # A range of ids and how many copies have theirs from the ranges before it.
    ranges = assigned.withColumn("_given", given).select(
        *columns, "_wanted", "_given", F.posexplode("_given").alias("_place", "_range")
    )
    done = F.reduce(F.slice("_given", F.lit(1), F.col("_place")), F.lit(0).cast("long"), lambda n, g: n + g["copies"])
    use = F.least(F.col("_range.copies"), F.col("_wanted") - done)
    ranges = ranges.select(*columns, F.col("_range.first").alias("_first"), use.alias("_use")).where("_use > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("_use") - 1, F.lit(COPIES_PER_SLICE).cast("long"))
    slices = ranges.withColumn("_from", F.explode(starts))
    tasks = int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    upto = F.least(F.col("_from") + (COPIES_PER_SLICE - 1), F.col("_use") - 1)
    return (
        slices.repartition(tasks, "_first", "_from")
        .withColumn("_copy", F.explode(F.sequence("_from", upto)))
        .select(*columns, (F.col("_first") + F.col("_copy")).alias(id_column))
        .hint("merge")
    )


def new_keys(assigned: DataFrame) -> DataFrame:
    """What ``assign_kept_ids`` gave for the first time, to be added to the key map."""
    return assigned.where("_more > 0").select(
        F.col("_h1").alias("h1"), F.col("_h2").alias("h2"), F.col("_first").alias("first"), F.col("_more").alias("copies")
    )
