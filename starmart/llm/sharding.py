"""Contiguous shards of equal bytes, cut by prefix sums of sizes.

The rows are put in an order that any task can tell from a row alone: the MD5 of the text,
then a hash of the id. The leading digits of both name the row's partition. Each partition's
total is taken first, the totals are summed up in order on two levels (the coarse level has
at most 4096 rows, whatever the table's size), and only then are the rows of a partition
numbered. A row's shard follows from the bytes before it. No global sort, no row count on
the driver; a text that makes up a third of all rows is spread over 256 fine partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import staged, whole_text

COARSE_DIGITS = 3  # hexadecimal digits of the text's hash: 4096 coarse partitions
FINE_DIGITS = 2  # and of the id's hash: 256 fine ones in each

RESULT = ("size", "text_crc32", "shard", "slot")


def balanced_shards(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """Give every row a shard from 0 to ``shards - 1`` and its slot in there.

    Result: the input without its text, and ``size`` (UTF-8 bytes plus 1), ``text_crc32``,
    ``shard`` and ``slot`` (gapless from 0). Shards hold runs of rows in the order of (MD5 of
    the text, MD5 of the id), so equal texts stand together, and differ in bytes by less than
    two of the largest rows.

    * A null text has no bytes: size 1, the checksum of nothing. A null id comes first among equal texts.
    * Equal rows are one row each, in slots next to each other. An empty table gives an empty one.
    * Fewer rows than shards leave shards empty. Input columns named like a result are replaced.
    """
    names = [c for c in docs.columns if c != text and c.lower() not in RESULT]
    hash_of = lambda c: F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        *(quoted(c) for c in names),
        (F.octet_length(whole_text(text)) + 1).cast("long").alias("size"),
        F.crc32(whole_text(text).cast("binary")).alias("text_crc32"),
        hash_of(quoted(text)).alias("_llm_text"),
        hash_of(quoted(id)).alias("_llm_id"),
        quoted(id).isNotNull().alias("_llm_known"),
    ).withColumns(
        {
            "_llm_coarse": F.substring("_llm_text", 1, COARSE_DIGITS),
            "_llm_fine": F.substring("_llm_id", 1, FINE_DIGITS),
        }
    )
    rows = staged(rows, "shard-rows")

    totals = rows.groupBy("_llm_coarse", "_llm_fine").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
    )
    totals = staged(totals, "shard-totals")
    before = lambda of, w: F.coalesce(F.sum(of).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = totals.groupBy("_llm_coarse").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    in_order = Window.orderBy("_llm_coarse")
    everything = Window.partitionBy()
    coarse = coarse.select(
        "_llm_coarse",
        before("bytes", in_order).alias("coarse_bytes"),
        before("rows", in_order).alias("coarse_rows"),
        F.sum("bytes").over(everything).alias("_llm_total"),
    )
    in_coarse = Window.partitionBy("_llm_coarse").orderBy("_llm_fine")
    starts = totals.join(coarse, "_llm_coarse").select(
        "_llm_coarse",
        "_llm_fine",
        "_llm_total",
        (F.col("coarse_bytes") + before("bytes", in_coarse)).alias("_llm_bytes"),
        (F.col("coarse_rows") + before("rows", in_coarse)).alias("_llm_rows"),
    )

    in_fine = Window.partitionBy("_llm_coarse", "_llm_fine").orderBy("_llm_text", "_llm_id", "_llm_known", "size")
    placed = (
        rows.withColumns(
            {"_llm_own": before("size", in_fine), "_llm_nth": F.row_number().over(in_fine).cast("long") - 1}
        )
        .join(starts, ["_llm_coarse", "_llm_fine"])
        # The shard in which the middle of the row's bytes falls; in doubled bytes to stay whole numbers.
        .withColumn("_llm_middle", 2 * (F.col("_llm_bytes") + F.col("_llm_own")) + F.col("size"))
        .withColumn(
            "shard",
            F.least(
                F.floor(F.col("_llm_middle").cast("decimal(30,0)") * shards / (2 * F.col("_llm_total"))), F.lit(shards - 1)
            ).cast("int"),
        )
        .withColumn("_llm_nth", F.col("_llm_rows") + F.col("_llm_nth"))
        .select(*(quoted(c) for c in names), "size", "text_crc32", "shard", "_llm_nth")
    )
    placed = staged(placed, "shard-places")
    first = placed.groupBy("shard").agg(F.min("_llm_nth").alias("_llm_first"))
    return placed.join(F.broadcast(first), "shard").select(
        *(quoted(c) for c in names),
        "size",
        "text_crc32",
        "shard",
        (F.col("_llm_nth") - F.col("_llm_first")).alias("slot"),
    )
