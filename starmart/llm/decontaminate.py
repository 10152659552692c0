"""Benchmark decontamination by winnowing.

Of every six neighbouring 8-word hashes of a document the least is kept as a fingerprint with
its place. A span of 13 words has six 8-word hashes, so each 13-word window of a document
holds at least one fingerprint; the benchmark side keeps all of its 8-word hashes, so every shared
window is met by a join of fingerprints. Each meeting is then extended to both sides: the up to six
13-word windows around it are looked up among the benchmark's, by 128 bits of their words, and count only
if they are there. Neighbouring windows make longer spans.

An item of fewer than 13 words is one window as a whole. It is met by its first 8, 4, 2 or 1
words; the documents then give all their hashes of that many words, and only if such items exist.

Documents meet the benchmark as (document, place, hash), without their text; if the benchmark's
fingerprints are small by Spark's measure of the staged table they are broadcast, else the join
shuffles, with hot hashes split. Only documents with a meeting are read again for the extension. A document's
meetings are places of its own text, and its windows are looked up without the items that hold them; items come to
a document last, by its distinct windows. So a passage that stands many times in a document and in many
items makes no rows of its own for each pair of the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import ascii_lower, other_columns, row_key, staged, whole_text

WINDOW = 13
SEED = 8
WINNOW = WINDOW - SEED + 1
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), NO_WORD), lambda w: w != "")


def shifted(df: DataFrame, first: str, second: str, by: int, name: str, merge) -> DataFrame:
    """Add ``name``: ``merge`` of each element of ``first`` and the one of ``second`` that stands ``by`` later."""
    n = F.greatest(F.least(F.size(first), F.size(second) - by), F.lit(0))
    return df.withColumn(name, F.zip_with(F.slice(first, 1, n), F.slice(second, by + 1, n), merge))


def gram_hashes(df: DataFrame, words: str, longest: int = SEED) -> DataFrame:
    """Add ``_llm_g1``, ``_llm_g2`` ... : a hash for each run of 1, 2, 4 ... words, by its first word's place."""
    df = df.withColumn("_llm_g1", F.transform(words, lambda w: F.xxhash64(w)))
    k = 1
    while k < longest:
        df = shifted(df, f"_llm_g{k}", f"_llm_g{k}", k, f"_llm_g{2 * k}", lambda a, b: F.xxhash64(a, b))
        k *= 2
    return df


def seed_hash(value: Column) -> Column:
    """The hash without the three bits that tell a place within a winnowing window."""
    return value.bitwiseAND(F.lit(-8).cast("long"))


def fingerprints(df: DataFrame, keys: Sequence[str], words: str, short: Sequence[int]) -> DataFrame:
    """(keys, k, hash, place): the winnowed 8-word hashes, and all hashes of ``short`` many words."""
    df = gram_hashes(df.select(*keys, words), words).select(*keys, *(f"_llm_g{k}" for k in sorted({*short, SEED})))
    # Three bits of place ride in the hash, enough to tell which of six neighbours was the least.
    tagged = F.transform(
        f"_llm_g{SEED}", lambda h, i: seed_hash(h).bitwiseOR(i.cast("long").bitwiseAND(F.lit(7).cast("long")))
    )
    df = df.withColumn("_llm_m1", tagged)
    df = shifted(df, "_llm_m1", "_llm_m1", 1, "_llm_m2", lambda a, b: F.least(a, b))
    df = shifted(df, "_llm_m2", "_llm_m2", 2, "_llm_m4", lambda a, b: F.least(a, b))
    df = shifted(df, "_llm_m4", "_llm_m2", 4, "_llm_m6", lambda a, b: F.least(a, b))
    at = lambda j: F.get("_llm_m6", j)
    changes = F.filter(
        F.sequence(F.lit(0), F.size("_llm_m6") - 1), lambda j: (j == 0) | (at(j) != at(j - 1))
    )
    least = F.transform(
        changes,
        lambda j: F.struct(
            F.lit(SEED).alias("k"), seed_hash(at(j)).alias("hash"), (j + low_bits(at(j), j)).alias("place")
        ),
    )
    marks = F.when(F.size("_llm_m6") > 0, least).otherwise(F.array().cast("array<struct<k:int,hash:bigint,place:int>>"))
    for k in short:
        marks = F.concat(marks, all_marks(k))
    return df.select(*keys, F.explode(marks).alias("mark")).select(*keys, "mark.*")


def all_marks(k: int) -> Column:
    return F.transform(
        f"_llm_g{k}", lambda h, i: F.struct(F.lit(k).alias("k"), seed_hash(h).alias("hash"), i.alias("place"))
    )


def low_bits(tagged: Column, j: Column) -> Column:
    """How far behind place ``j`` the tagged hash stands: the difference of the places modulo 8."""
    own = tagged.bitwiseAND(F.lit(7).cast("long")).cast("int")
    return F.pmod(own - F.pmod(j, F.lit(8)), F.lit(8))


def seed_words(n: Column) -> Column:
    """How many words an item of ``n`` words is met by."""
    return F.when(n >= 8, 8).when(n >= 4, 4).when(n >= 2, 2).otherwise(1)


def item_seeds(items: DataFrame) -> DataFrame:
    """(k, hash): all 8-word hashes of long items, the first 8, 4, 2 or 1 words of short ones."""
    n = F.size("words")
    items = gram_hashes(items, "words").withColumn("n", n).withColumn("k", seed_words(n))
    grams = F.when(F.col("n") >= WINDOW, F.col(f"_llm_g{SEED}"))
    for k in (8, 4, 2, 1):
        grams = grams.when(F.col("k") == k, F.slice(f"_llm_g{k}", 1, 1))
    gram = F.explode(grams).alias("gram")
    return items.select("k", gram).select("k", seed_hash(F.col("gram")).alias("hash")).distinct()


def window_struct(words: str, start: Column, n: Column) -> Column:
    """A window of ``n`` words from place ``start``, with 128 bits of it. Words hold no blank, so joined ones are told apart."""
    text = F.array_join(F.slice(words, start + 1, n), " ")
    again = F.array_join(F.slice(words, start + 1, n), " ")
    return F.struct(
        start.alias("start"), n.alias("n"), F.xxhash64(text).alias("w1"), F.xxhash64(F.lit(13), again).alias("w2")
    )


def item_windows(items: DataFrame) -> DataFrame:
    """(n, w1, w2, i1, i2): every window of every item."""
    n = F.least(F.size("words"), F.lit(WINDOW))
    starts = F.sequence(F.lit(0), F.size("words") - n)
    found = items.select("i1", "i2", F.explode(F.transform(starts, lambda s: window_struct("words", s, n))).alias("w"))
    return found.select("w.n", "w.w1", "w.w2", "i1", "i2").distinct()


def windows_around(words: str, hits: str, lengths: Sequence[int]) -> Column:
    """The distinct windows of a text that its meetings may belong to; ``lengths`` are those of the benchmark's windows."""
    nothing = F.array().cast("array<struct<start:int,n:int>>")

    def around(hit: Column) -> Column:
        found = nothing
        for n in lengths:
            k = max(x for x in (1, 2, 4, 8) if x <= min(n, SEED))
            behind = range(WINNOW) if n == WINDOW else (0,)
            pairs = [F.struct((hit["place"] - j).alias("start"), F.lit(n).alias("n")) for j in behind]
            found = F.concat(found, F.when(hit["k"] == k, F.array(*pairs)).otherwise(nothing))
        return found

    all_ = F.array_distinct(F.flatten(F.transform(hits, around)))
    inside = F.filter(all_, lambda w: (w["start"] >= 0) & (w["start"] + w["n"] <= F.size(words)))
    return F.transform(inside, lambda w: window_struct(words, w["start"], w["n"]))


RESULT = ("n_words", "n_hit", "n_items", "item_ids", "spans", "contaminated")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    part: int = 20,
) -> DataFrame:
    """Mark the words of documents that stand in a 13-word window of a benchmark item.

    Result: the input and ``n_words``; ``n_hit``, the words inside any occurrence; ``n_items`` and
    ``item_ids``, the items met (ids as texts, sorted); ``spans``, the runs of words hit, by start;
    ``contaminated``: some word is hit, and at least one in ``part``.

    * A null text has no words. A null item has no window; an item without an id is counted in ``n_items``
      but not named. Items that come again count once.
    * Every row is a document, equal rows get equal results. Empty tables: nothing is hit, or an empty result.
    * Input columns named like a result, in any case, are replaced.
    """
    named = benchmark.select(
        quoted(item_id).cast("string").alias("item_id"), word_list(whole_text(item_text)).alias("words")
    )
    named = named.where(F.size("words") > 0).select(
        "item_id", "words", F.xxhash64("words").alias("i1"), F.xxhash64(F.lit(5), "words").alias("i2")
    )
    named = staged(named, "bench-items")
    distinct = named.select("i1", "i2", "words").dropDuplicates(["i1", "i2"])
    windows = staged(item_windows(distinct), "bench-windows")
    window_keys = staged(windows.select("n", "w1", "w2").distinct(), "bench-window-keys")
    hashes = staged(item_seeds(distinct), "bench-hashes")
    # Thirteen values and four at most.
    lengths = sorted(r[0] for r in window_keys.select("n").distinct().collect())
    short = sorted({max(x for x in (1, 2, 4, 8) if x <= n) for n in lengths if n < WINDOW})

    k1, k2 = row_key(id, text)
    keyed = docs.select(k1.alias("_llm_k1"), k2.alias("_llm_k2"), whole_text(text).alias("_llm_text"))
    keys = ["_llm_k1", "_llm_k2"]
    worded = keyed.select(*keys, word_list(F.col("_llm_text")).alias("_llm_words"))
    met = (
        fingerprints(worded, keys, "_llm_words", short)
        .join(hashes, ["k", "hash"], "left_semi")
        .groupBy(*keys)
        .agg(F.collect_set(F.struct("k", "place")).alias("_llm_hits"))
    )
    met = staged(met, "bench-meetings")
    around = (
        keyed.join(met, keys)
        .dropDuplicates(keys)
        .select(*keys, "_llm_hits", word_list(F.col("_llm_text")).alias("_llm_words"))
        .select(*keys, F.explode(windows_around("_llm_words", "_llm_hits", lengths)).alias("w"))
    )
    held = staged(around.select(*keys, "w.*").join(window_keys, ["n", "w1", "w2"], "left_semi"), "bench-held")
    ranges = held.groupBy(*keys).agg(F.collect_set(F.struct("start", "n")).alias("_llm_ranges"))
    places = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform("_llm_ranges", lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1)))
        )
    )
    # Runs of places: where one begins, and where it ends.
    at = lambda i: F.get("_llm_places", i)
    first = F.filter("_llm_places", lambda p, i: (i == 0) | (at(i - 1) != p - 1))
    last = F.filter("_llm_places", lambda p, i: (i == F.size("_llm_places") - 1) | (at(i + 1) != p + 1))
    spans = F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop")))
    ranges = staged(ranges.select(*keys, places.alias("_llm_places")), "bench-places").select(
        *keys, F.size("_llm_places").cast("long").alias("_llm_n_hit"), spans.alias("_llm_spans")
    )
    items = (
        held.select(*keys, "n", "w1", "w2")
        .distinct()
        .join(windows, ["n", "w1", "w2"])
        .select(*keys, "i1", "i2")
        .distinct()
        .join(named.select("i1", "i2", "item_id").distinct(), ["i1", "i2"])
        .groupBy(*keys)
        .agg(
            F.array_sort(F.collect_set("item_id")).alias("_llm_ids"),
            F.max(F.col("item_id").isNull().cast("int")).alias("_llm_unnamed"),
        )
    )
    found = ranges.join(items, keys)
    names = other_columns(docs, RESULT)
    hit = F.coalesce("_llm_n_hit", F.lit(0)).cast("long")
    return (
        docs.select(
            *(quoted(c) for c in names),
            F.size(word_list(whole_text(text))).cast("long").alias("n_words"),
            k1.alias("_llm_k1"),
            k2.alias("_llm_k2"),
        )
        .join(found, keys, "left")
        .select(
            *(quoted(c) for c in names),
            "n_words",
            hit.alias("n_hit"),
            F.coalesce(F.size("_llm_ids") + F.col("_llm_unnamed"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("_llm_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("_llm_spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
            ((hit > 0) & (part * hit >= F.col("n_words"))).alias("contaminated"),
        )
    )
