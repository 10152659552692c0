"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint has 64 bits, cut into ``segments`` that stand in a ring. If two fingerprints differ in at
most ``distance`` bits, then from some segment on every chain of 1, 2, 3 ... consecutive segments
differs in at most its proportional share of them (chain length times distance over segments). With
5 segments and 2 bits the shares are 0, 0, 1, 1, 2: the first two segments are equal, and the next two
differ in one bit at most. That second condition is put into the join key as well: of the four halves
of these two segments at least three are equal, so each fingerprint gives four keys, leaving out one
half each. Such a key has 45 of the 64 bits. The chain is tested in full on the pairs that meet, and
the Hamming distance last.

All this works on distinct fingerprints: copies of a text, however many, are one. Links become
components by star steps; documents get their component by a join on the fingerprint.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import LOWER, UPPER, prepare_workers, row_key, staged
from starmart.llm.components import components

BITS = 64
SEED = 42
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
AT_ONCE = 1 << 16  # shingles whose bits are spread out at one time


def fingerprint(text: str, words_each: int = 3) -> int:
    """The majority of the bits of all shingle hashes; 0 for a text without words."""
    # bytes.split takes exactly the six white space characters meant here.
    words = text.encode("utf-8", "surrogatepass").translate(LOWERED).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    last = min(words_each, len(words)) - 1
    starts, stops = (stops - lengths)[: len(words) - last].tolist(), stops[last:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), AT_ONCE):
        chunk = zip(starts[at : at + AT_ONCE], stops[at : at + AT_ONCE], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in chunk], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words_each: int = 3) -> Column:
    @F.arrow_udf("long")
    def of_batch(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t.as_py() or "", words_each) for t in texts], np.uint64)
        return pa.array(found.view(np.int64))

    return of_batch(text)


def budgets(segments: int, distance: int) -> list[int]:
    """How many bits a chain of 1, 2, ... segments may differ in."""
    return [length * distance // segments for length in range(1, segments + 1)]


def ring(column: Column, start: int) -> Column:
    """The bits turned so that bit ``start`` comes first."""
    if not start:
        return column
    low = F.shiftrightunsigned(column, start)
    return low.bitwiseOR(F.shiftleft(column, BITS - start))


def mask(first: int, stop: int) -> Column:
    bits = ((1 << stop) - 1) & ~((1 << first) - 1)
    return F.lit(bits - (1 << BITS) if bits >= 1 << (BITS - 1) else bits).cast("long")


def edges_of_segments(segments: int) -> list[int]:
    return [BITS * i // segments for i in range(segments + 1)]


def chain_keys(fp: Column, segments: int, distance: int) -> Column:
    """All join keys of a fingerprint: (rotation and half left out, remaining bits of the chain)."""
    allowed, cuts = budgets(segments, distance), edges_of_segments(segments)
    equal, nearly = allowed.count(0), allowed.count(1)
    keys = []
    for r in range(segments):
        turned = ring(fp, cuts[r])
        ends = [0]
        for i in range(segments):
            j = (r + i) % segments
            ends.append(ends[-1] + cuts[j + 1] - cuts[j])
        halves = []
        for a, b in pairwise(ends[equal : equal + nearly + 1]):
            halves += [(a, (a + b) // 2), ((a + b) // 2, b)]
        # With at most one differing bit in all halves, at most one half differs.
        for i, (a, b) in enumerate(halves or [(0, 0)]):
            left = turned.bitwiseAND(mask(0, ends[equal + nearly])).bitwiseAND(F.bitwise_not(mask(a, b)))
            keys.append(F.struct(F.lit(r * 64 + i).alias("chain"), left.alias("bits")))
    return F.array(*keys)


def within_budgets(different: Column, segments: int, distance: int) -> Column:
    """Whether some chain around the ring keeps all its budgets."""
    allowed, cuts = budgets(segments, distance), edges_of_segments(segments)
    found = F.lit(False)
    for r in range(segments):
        turned, end, kept = ring(different, cuts[r]), 0, F.lit(True)
        for i in range(segments):
            j = (r + i) % segments
            end += cuts[j + 1] - cuts[j]
            kept = kept & (F.bit_count(turned.bitwiseAND(mask(0, end))) <= allowed[i])
        found = found | kept
    return found


def linked_fingerprints(prints: DataFrame, *, segments: int = 5, distance: int = 2) -> DataFrame:
    """(u, v): the pairs of distinct ``fp`` in ``prints`` that differ in at most ``distance`` bits."""
    if budgets(segments, distance)[0] or budgets(segments, distance).count(0) == segments:
        raise ValueError("take more segments than bits, and at least one bit")
    keyed = prints.select("fp", F.explode(chain_keys(F.col("fp"), segments, distance)).alias("key")).select(
        "fp", "key.chain", "key.bits"
    )
    other = keyed.withColumnRenamed("fp", "fp2")
    different = F.col("fp").bitwiseXOR(F.col("fp2"))
    return (
        keyed.join(other, ["chain", "bits"])
        .where(F.col("fp") < F.col("fp2"))
        .where(within_budgets(different, segments, distance))
        .where(F.bit_count(different) <= distance)
        .select(F.col("fp").alias("u"), F.col("fp2").alias("v"))
        .distinct()
    )


def _classes(docs: DataFrame, id: str, text: str, words_each: int, segments: int, distance: int):
    """Per row: id, fp, content key. Per fingerprint in a component of several: its root."""
    prepare_workers(docs.sparkSession)
    k1, k2 = row_key(id, text)
    rows = staged(
        docs.select(
            quoted(id).alias("_llm_id"),
            k1.alias("_llm_k1"),
            k2.alias("_llm_k2"),
            fingerprint_column(quoted(text), words_each).alias("fp"),
        ),
        "fingerprints",
    )
    links = linked_fingerprints(rows.select("fp").distinct(), segments=segments, distance=distance)
    roots = components(staged(links, "fingerprint-links"))
    return rows, roots.select(F.col("node").alias("fp"), F.col("root").alias("_llm_root"))


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", words_each: int = 3, segments: int = 5, distance: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    Fingerprints are 16 hexadecimal digits. Rows are linked if they differ in at most ``distance`` bits; the
    component's id is the smallest id reachable, ids that are null not counting (null if none is known).

    * A null or empty text has no words: fingerprint zero, linked like any other.
    * Fewer words than a shingle has are one shingle. A–Z are lower-cased, white space is ASCII.
    * Rows that come again share a component. An empty table gives an empty one.
    """
    rows, roots = _classes(docs, id, text, words_each, segments, distance)
    per_print = rows.groupBy("fp").agg(F.min("_llm_id").alias("own")).join(roots, "fp", "left")
    per_print = per_print.withColumn("_llm_root", F.coalesce("_llm_root", "fp"))
    lowest = per_print.groupBy("_llm_root").agg(F.min("own").alias("component_id"))
    ids = staged(per_print.join(lowest, "_llm_root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(ids, "fp").select(
        quoted("_llm_id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", words_each: int = 3, segments: int = 5, distance: int = 2
) -> DataFrame:
    """Keep one row of each component: that of the smallest id, the first by content where ids are equal or null."""
    rows, roots = _classes(docs, id, text, words_each, segments, distance)
    best = F.min(F.struct(F.col("_llm_id").isNull(), F.col("_llm_id"), "_llm_k1", "_llm_k2")).alias("best")
    per_print = rows.groupBy("fp").agg(best).join(roots, "fp", "left")
    stay = (
        per_print.groupBy(F.coalesce("_llm_root", "fp"))
        .agg(F.min("best").alias("best"))
        .select("best._llm_k1", "best._llm_k2")
    )
    return keep_best(docs, staged(stay, "near-duplicates-stay"), id, text)


def keep_best(docs: DataFrame, stay: DataFrame, id: str, text: str) -> DataFrame:
    """One row of ``docs`` for each key (_llm_k1, _llm_k2) in ``stay``."""
    keys = ["_llm_k1", "_llm_k2"]
    k1, k2 = row_key(id, text)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return (
        docs.withColumns({"_llm_k1": k1, "_llm_k2": k2})
        .join(stay, keys, "left_semi")
        # Rows equal in id and text share their key.
        .withColumn("_llm_nth", first)
        .where("_llm_nth = 1")
        .select(*(quoted(c) for c in docs.columns))
    )
