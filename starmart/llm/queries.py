"""Registered queries of the operators, each next to its checking SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.alignment import aligned_documents, with_corpus_links
from starmart.llm.decontaminate import find_contamination
from starmart.llm.html_text import extract_text
from starmart.llm.langid import identify_language
from starmart.llm.line_dedup import dedup_lines
from starmart.llm.lm import score_documents
from starmart.llm.packing import pack_documents
from starmart.llm.pii import KINDS, find_personal_data
from starmart.llm.quality import judge_quality
from starmart.llm.sharding import balanced_shards
from starmart.llm.simhash import near_duplicates
from starmart.llm.token_counts import count_document_tokens
from starmart.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# SQL texts. The blanks of the operators: space, tab, line feed, vertical tab, form feed, return.
BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_line_dedup",
    f"""
    WITH lines AS (
        SELECT doc_id, t.line, t.place,
               {LOWER_SQL.format(f"trim(t.line, {BLANKS_SQL})")} AS key
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents),
             LATERAL (SELECT unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS place) t
    ), common AS (
        SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE c.key IS NOT NULL) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
    FROM lines l LEFT JOIN common c ON l.key = c.key
    GROUP BY doc_id
    """,
)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


WORDS_SQL = f"""regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"""


@query(
    "op4_decontaminate",
    f"""
    WITH d AS (SELECT doc_id, {WORDS_SQL} AS words FROM documents),
    i AS (SELECT item_id, {WORDS_SQL} AS words FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(words), 13) AS n,
               array_to_string(words[s : s + least(len(words), 13) - 1], ' ') AS w
        FROM i, LATERAL (SELECT unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s) WHERE len(words) > 0
    ), lengths AS (SELECT DISTINCT n FROM windows),
    runs AS (
        SELECT doc_id, n, s, array_to_string(words[s : s + n - 1], ' ') AS w
        FROM d, lengths, LATERAL (SELECT unnest(range(1, len(words) - n + 2)) AS s)
    ), met AS (SELECT doc_id, n, s, item_id FROM runs JOIN windows USING (n, w)),
    hit AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT doc_id, n, s FROM met), LATERAL (SELECT unnest(range(s, s + n)) AS p) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"), "quality",
    )


# CRC-32 of the UTF-8 bytes, by the checksum's polynomial: first the table of all bytes, then a fold.
SHARDS_SQL = """
    WITH crc_table AS (
        SELECT list(list_reduce(list_prepend(k, range(8)),
                   lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS crc_of
        FROM range(256) t(k)
    ), texts AS (
        SELECT doc_id, text AS raw, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS digits FROM documents
    ), sized AS (
        SELECT doc_id, md5(text) AS text_md5, md5(coalesce(doc_id::VARCHAR, '')) AS id_md5,
               doc_id IS NOT NULL AS known, length(digits) // 2 + 1 AS size,
               xor(list_reduce(
                   list_prepend(4294967295::BIGINT, list_transform(range(length(digits) // 2),
                       lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
                   lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])
               ), 4294967295::BIGINT) AS text_crc32
        FROM texts, crc_table
    ), summed AS (
        SELECT *, coalesce(sum(size) OVER w, 0) AS before, sum(size) OVER () AS total, row_number() OVER o AS nth
        FROM sized
        WINDOW o AS (ORDER BY text_md5[1:3], id_md5[1:2], text_md5, id_md5, known),
               w AS (ORDER BY text_md5[1:3], id_md5[1:2], text_md5, id_md5, known
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), cut AS (
        SELECT *, least(((2 * before + size) * 16) // (2 * total), 15)::INTEGER AS shard FROM summed
    )
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
           (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM cut
"""


@query("op8_sharding", SHARDS_SQL)
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = balanced_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents")).select("doc_id", "spans")
    order = {kind: i for i, kind in enumerate(KINDS)}
    rank = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    ordered = F.array_sort(
        F.transform(
            "spans",
            lambda s: F.struct(
                rank[s["kind"]].alias("rank"), *(s[n].alias(n) for n in ("start", "stop", "kind", "plain"))
            ),
        )
    )
    found = found.select("doc_id", ordered.alias("spans"))
    plain = F.filter("spans", lambda s: s["plain"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind):
        of_kind = F.filter("spans", lambda s: s["plain"] & (s["kind"] == kind))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(joined(plain), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_document_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = aligned_documents(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return with_corpus_links(aligned.withColumn("groups_sha256", digest).drop("groups"))


@query("op12_html_text")
def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))
