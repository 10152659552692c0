"""Names matched to the labels of a list that write them otherwise: by the words they share.

A name is the set of its words: lower case, without accents, whatever stands between them. A label matches a name if it
holds at least a share ``least`` of the name's words; the best one shares most words with it and has fewest of its own,
which is the order of containment, then of Jaccard similarity, in whole numbers. A name with one best row of the list
is matched; one with several is a tie, which is reported and not decided.

Names never meet all labels. Of a name's n words at least k = ceil(least * n) must be shared, so one of any n - k + 1 of
them is. Each name is looked up by its n - k + 1 words that are rarest in the list; the rows met are verified in full.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import quoted

# Lower-case Latin letters with accents, and the letters they are without.
ACCENTED = {
    chr(c): unicodedata.normalize("NFD", chr(c))[0]
    for c in range(0xC0, 0x250)
    if unicodedata.normalize("NFD", chr(c))[0].isascii()
}
SIMILAR, TIE, NONE = "similar", "tie", "none"


def name_words(text: Column) -> Column:
    """The distinct words of a name."""
    plain = F.translate(F.lower(text), "".join(ACCENTED), "".join(ACCENTED.values()))
    return F.array_distinct(F.filter(F.split(F.lower(plain), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def match_names(
    names: DataFrame, name: str, listed: DataFrame, label: str, *, least: float = 1.0
) -> DataFrame:
    """A row per distinct non-null name: the name, ``status``, ``shared``, ``n_best``, and the matched list row as ``match``.

    ``status`` is ``similar`` for a name with one best row, ``tie`` for one with ``n_best`` of them, else ``none``;
    ``match`` (a struct of the list's columns) is NULL unless ``similar``. Rows of the list that are equal in all
    columns are one, others are not: a label that is listed with two codes is a tie.
    """
    if not 0 < least <= 1:
        raise ValueError("the least share of a name's words lies above 0 and is 1 at most")
    rows = listed.where(quoted(label).isNotNull()).distinct()
    rows = rows.select(F.struct(*(quoted(c) for c in listed.columns)).alias("_row"), name_words(quoted(label)).alias("_words"))
    words = rows.select("_row", "_words", F.explode("_words").alias("_word"))
    # The list's words with how many rows hold them: small beside the names if the list is.
    frequency = words.groupBy("_word").agg(F.count(F.lit(1)).alias("_rows"))

    texts = names.select(quoted(name).alias("_name")).where("_name IS NOT NULL").distinct()
    texts = texts.withColumn("_own", name_words(F.col("_name")))
    own = texts.select("_name", "_own", F.explode("_own").alias("_word")).join(frequency, "_word", "left")
    # Rarest first; a word that no row holds is rarest of all, and meets nothing.
    by_rarity = F.array_sort(F.collect_list(F.struct(F.coalesce("_rows", F.lit(0)).alias("rows"), F.col("_word").alias("word"))))
    needed = F.ceil(F.size("_own") * F.lit(least) - F.lit(1e-9)).cast("int")
    probes = own.groupBy("_name", "_own").agg(by_rarity.alias("_sorted")).withColumn("_needed", needed)
    probe = F.explode(F.slice("_sorted", F.lit(1), F.size("_own") - F.col("_needed") + 1))
    probes = probes.select("_name", "_own", "_needed", probe.alias("_probe")).where("_probe.rows > 0")
    probes = probes.select("_name", "_own", "_needed", F.col("_probe.word").alias("_word"))

    shared = F.size(F.array_intersect("_own", "_words"))
    met = probes.join(words, "_word").withColumn("_shared", shared).where("_shared >= _needed")
    # A row met by several words counts once. Greater is better: more words shared, fewer others.
    met = met.select("_name", F.struct("_shared", (-F.size("_words")).alias("_size")).alias("_score"), "_row").distinct()
    scored = met.groupBy("_name", "_score").agg(F.count(F.lit(1)).alias("_n_best"), F.min("_row").alias("_row"))
    best = scored.groupBy("_name").agg(F.max(F.struct("_score", "_n_best", "_row")).alias("_best"))
    unique = F.col("_best._n_best") == 1
    return texts.join(best.withColumnRenamed("_name", "_found"), F.col("_name") == F.col("_found"), "left").select(
        F.col("_name").alias(name),
        F.when(F.col("_best").isNull(), NONE).when(unique, SIMILAR).otherwise(TIE).alias("status"),
        F.coalesce("_best._score._shared", F.lit(0)).alias("shared"),
        F.coalesce("_best._n_best", F.lit(0)).cast("long").alias("n_best"),
        F.when(unique, F.col("_best._row")).alias("match"),
    )


def enrich_by_similar_name(
    df: DataFrame,
    text_column: str,
    codes: DataFrame,
    name: str,
    output: Sequence[str] | None = None,
    *,
    least: float = 1.0,
) -> DataFrame:
    """As ``enrich_by_name``, but a text that equals no name takes the one similar row of the list, if there is one.

    Texts that equal a name are matched as before: one that the list holds twice gives two rows. Others keep NULL codes
    where no row or no single one is best. Only the distinct texts are matched; the table meets them in one join.
    """
    texts = df.select(quoted(text_column).alias("_text")).where("_text IS NOT NULL").distinct()
    listed = codes.select(F.struct(*(quoted(c) for c in codes.columns)).alias("_row"), quoted(name).alias("_label"))
    exact = texts.join(listed.where("_label IS NOT NULL"), F.upper("_text") == F.col("_label"), "left")
    unmatched = exact.where("_label IS NULL").select("_text")
    similar = match_names(unmatched, "_text", codes, name, least=least)
    found = exact.where("_label IS NOT NULL").select("_text", "_row").unionByName(
        similar.where(F.col("match").isNotNull()).select("_text", F.col("match").alias("_row"))
    )
    joined = df.join(found, quoted(text_column) == F.col("_text"), "left").select(
        *(quoted(c) for c in df.columns), F.col("_row")
    )
    joined = joined.select(
        *(quoted(c) for c in df.columns), *(F.col("_row")[c].alias(c) for c in codes.columns)
    )
    return joined.select(*output) if output else joined
