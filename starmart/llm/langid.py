"""Language identification by averaged subword embeddings and a linear softmax.

A document is the average of the embeddings of all its hashed character n-grams; a softmax layer on
top gives the languages' probabilities. Both are trained together by stochastic gradient descent in
numpy, on a bounded sample of labelled documents (``per_language`` each, whole texts and some of their
lines, so that short texts are known too). Part of the sample is held back to calibrate: a temperature
makes the scores match how often they are right, and documents whose score lies below what nearly all
sound documents reach are rejected.

Averaging and the layer are both linear, so a trained model is one row of language scores for each
n-gram bucket (``BUCKETS`` x languages), and a token's rows can be summed once and kept. Prediction
reads every whole text in its own task; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import other_columns, prepare_workers, staged

UNKNOWN = "und"
BUCKETS = 1 << 15
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
KEPT_TOKENS = 400_000  # a task forgets the tokens or words it knows beyond so many, and starts anew


def word_subwords(word: str) -> list[int]:
    """The buckets of a lower-cased word: its runs of 2 to 4 bytes, with marks for both ends."""
    marked = f"<{word}>".encode()
    return [
        zlib.crc32(marked[i : i + n]) & (BUCKETS - 1) for n in (2, 3, 4) for i in range(len(marked) - n + 1)
    ]


def subwords(token: str) -> list[int]:
    """The buckets of all words of a token."""
    return [b for word in LETTERS.findall(token) for b in word_subwords(word)]


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # BUCKETS x languages, before averaging
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        z = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def in_training(id: str) -> Column:
    """Documents whose CRC-32 of the id as text leaves 2 modulo 4 are held out; a null id is empty text."""
    return F.crc32(F.coalesce(quoted(id).cast("string"), F.lit("")).cast("binary")) % 4 != 2


def sample_features(docs: DataFrame, text: str, lang: str, key: Column, per_language: int, lines_each: int):
    """Of each language the documents with the least keys, as counted buckets: (lang, key, buckets, counts)."""
    docs = docs.select(quoted(lang).alias("lang"), quoted(text).alias("text"), key.alias("key"))
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Candidates by key alone: about twice as many of each language as are taken, however many documents and tasks there are.
    share = F.least(F.lit(1.0), (2 * per_language + 40) / F.count(F.lit(1)))
    some = staged(docs.groupBy("lang").agg(share.alias("share")), "language-shares")
    candidates = docs.select("lang", "key").join(F.broadcast(some), "lang")
    candidates = candidates.where(F.pmod("key", F.lit(1 << 40)) < F.col("share") * (1 << 40)).select("lang", "key").distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("key", F.lit(1 << 40)), "key"))
    chosen = candidates.withColumn("nth", nth).where(F.col("nth") <= per_language)
    last = chosen.groupBy("lang").agg(F.max(F.pmod("key", F.lit(1 << 40))).alias("last"))
    # A row a language, staged so that it is found once; the texts are filtered where they are, not shuffled by language.
    last = F.broadcast(staged(last, "language-samples"))
    chosen = docs.join(last, "lang").where(F.pmod("key", F.lit(1 << 40)) <= F.col("last")).dropDuplicates(["lang", "key"])

    def count_subwords(batches):
        for batch in batches:
            rows = []
            for lang_, key_, text_ in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "text")), strict=True):
                lines = [x for x in text_.split("\n") if len(x) > 20]
                step = max(1, len(lines) // max(1, lines_each))
                for part in [text_, *lines[::step][:lines_each]]:
                    counted = Counter()
                    for token, times in Counter(part.lower().split()).items():
                        for bucket in subwords(token):
                            counted[bucket] += times
                    if counted:
                        rows.append(
                            {
                                "lang": lang_,
                                "key": key_,
                                "buckets": np.fromiter(counted.keys(), "<i4").tobytes(),
                                "counts": np.fromiter(counted.values(), "<i4").tobytes(),
                            }
                        )
            schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("buckets", pa.binary()), ("counts", pa.binary())])
            yield pa.RecordBatch.from_pylist(rows, schema)

    return chosen.select("lang", "key", "text").mapInArrow(
        count_subwords, "lang string, key bigint, buckets binary, counts binary"
    )


def train(examples: list[tuple[str, np.ndarray, np.ndarray, bool]], *, size: int = 16, epochs: int = 6, rate: float = 4.0):
    """Fit (language, buckets, counts, held back) examples; held back ones only calibrate."""
    languages = sorted({e[0] for e in examples})
    rng = np.random.default_rng(9)
    vectors = rng.uniform(-1 / size, 1 / size, (BUCKETS, size)).astype(np.float32)
    layer, bias = np.zeros((size, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    learned = [e for e in examples if not e[3]]
    share = Counter(e[0] for e in learned)
    for epoch in range(epochs):
        for done, i in enumerate(rng.permutation(len(learned))):
            lang, buckets, counts, _ = learned[i]
            step = rate * (1 - (epoch + done / len(learned)) / epochs)
            # Languages weigh alike, however many examples each has.
            step *= len(learned) / len(languages) / share[lang]
            weights = (counts / counts.sum()).astype(np.float32)
            mean = weights @ vectors[buckets]
            z = mean @ layer + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[languages.index(lang)] -= 1
            back = layer @ error
            layer -= 0.1 * step * np.outer(mean, error)
            bias -= 0.01 * step * error
            vectors[buckets] -= step * np.outer(weights, back) * len(buckets) ** 0.5
    return languages, vectors @ layer, bias


def calibrate(languages, scores, bias, examples, rejected_share: float) -> tuple[float, float]:
    """The temperature under which held back examples are most likely, and the score that all but a share reach."""
    if not examples:
        return 1.0, 0.0
    z = np.array([(c / c.sum()) @ scores[b] + bias for _, b, c, _ in examples])
    true = np.array([languages.index(e[0]) for e in examples])

    def surprise(t: float) -> float:
        y = z / t
        y = y - y.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(y).sum(axis=1)) - y[np.arange(len(y)), true]))

    temperature = min((2.0**k for k in np.arange(-4, 4.5, 0.5)), key=surprise)
    y = z / temperature
    p = np.exp(y - y.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    right = p.argmax(axis=1) == true
    reached = np.quantile(p.max(axis=1)[right], rejected_share) if right.any() else 0.0
    # Never reject what is more likely right than not.
    return float(temperature), float(min(reached, 0.5))


def held_back_keys(documents: list[tuple[str, int]]) -> set[tuple[str, int]]:
    """Every fifth document of each language, by key; a language of fewer than five is learned from as a whole."""
    by_language: dict[str, list[int]] = {}
    for lang, key in sorted(set(documents)):
        by_language.setdefault(lang, []).append(key)
    return {(lang, key) for lang, keys in by_language.items() for key in keys[4::5]}


def fit_languages(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = 400, lines_each: int = 6, rejected_share: float = 0.0005,
) -> LanguageModel | None:
    """Train on at most ``per_language`` documents of each language, not held out, with a text and a language.

    None if there is no such document with a letter.
    """
    prepare_workers(docs.sparkSession)
    key = F.xxhash64(quoted(id), quoted(text))
    sample = sample_features(docs.where(in_training(id)), text, lang, key, per_language, lines_each)
    rows = sorted((r.lang, r.key, r.buckets, r.counts) for r in sample.collect())  # bounded by the parameters
    held = held_back_keys([(la, k) for la, k, _, _ in rows])
    examples = [(la, np.frombuffer(b, "<i4"), np.frombuffer(c, "<i4"), (la, k) in held) for la, k, b, c in rows]
    if not examples:
        return None
    languages, scores, bias = train([e for e in examples if not e[3]])
    held_back = [e for e in examples if e[3]]
    temperature, reject_below = calibrate(languages, scores, bias, held_back, rejected_share)
    return LanguageModel(languages, scores.astype(np.float32), bias, temperature, reject_below)


def predict_column(model: LanguageModel | None, text: Column, spark) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``rejected``."""
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages floats
    known: dict[str, int] = {}  # token to row
    words: dict[str, int] = {}  # word to row; "thing" and "thing," share one
    state: dict[str, np.ndarray] = {}

    def learn(tokens: set[str]) -> None:
        """Give each token a row: summed scores of its subwords, and their number."""
        starts, buckets = [], []
        first = row = state["used"]
        for token in tokens:
            found = LETTERS.findall(token)
            name = found[0] if len(found) == 1 else token
            at = words.get(name)
            if at is None:
                own = [b for word in found for b in word_subwords(word)]
                if not own:  # no letters: row 0
                    at = 0
                else:
                    starts.append(len(buckets))
                    buckets += own
                    at, row = row, row + 1
                words[name] = at
            known[token] = at
        if row == first:
            return
        while row > len(state["rows"]):
            state["rows"] = np.concatenate([state["rows"], np.zeros_like(state["rows"])])
        state["rows"][first:row, :-1] = np.add.reduceat(shared.value.scores[buckets], starts, axis=0)
        state["rows"][first:row, -1] = np.diff([*starts, len(buckets)])
        state["used"] = row

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        trained = shared.value
        width = len(trained.languages) + 1 if trained else 2
        sums = np.zeros((len(texts), width))
        for i, value in enumerate(texts) if trained else ():
            tokens = (value.as_py() or "").lower().split()
            if len(known) > KEPT_TOKENS or "rows" not in state:
                known.clear()
                words.clear()
                state.update(rows=np.zeros((1024, width), np.float32), used=1)
            for at in range(0, len(tokens), KEPT_TOKENS):
                part = tokens[at : at + KEPT_TOKENS]
                if new := set(part).difference(known):
                    learn(new)
                rows = np.fromiter(map(known.__getitem__, part), np.int64, len(part))
                sums[i] += state["rows"][rows].sum(axis=0, dtype=np.float64)
        named = np.full(len(texts), UNKNOWN, object)
        score = np.zeros(len(texts))
        has_letter = sums[:, -1] > 0
        if trained and has_letter.any():
            p = trained.probabilities(sums[has_letter, :-1], sums[has_letter, -1])
            named[has_letter] = np.array(trained.languages, object)[p.argmax(axis=1)]
            score[has_letter] = p.max(axis=1)
        rejected = ~has_letter | (score < (trained.reject_below if trained else 1.0))
        return pa.StructArray.from_arrays(
            [pa.array(named, pa.string()), pa.array(score), pa.array(rejected)], ["lang_pred", "score", "rejected"]
        )

    return predict(text)


RESULT = ("held_out", "lang_pred", "score", "rejected")


def identify_language(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", model: LanguageModel | None = None, **fit
) -> DataFrame:
    """Predict the language of every whole text; without ``model``, train one on ``docs`` first.

    Result: the input and ``held_out``, ``lang_pred``, ``score`` (calibrated, 0 to 1), ``rejected``.

    * A null text or one without letters is ``und`` with score 0, and rejected.
    * Documents without a language are predicted, not learned from. If none has one, all are ``und``.
    * Every row is predicted by its text alone, equal texts alike. An empty table gives an empty one.
    * Input columns named like a result, in any case, are replaced. The text column may be one of them.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    model = model or fit_languages(docs, id=id, text=text, lang=lang, **fit)
    names = other_columns(docs, RESULT)
    found = predict_column(model, quoted(text), spark)
    return docs.select(
        *(quoted(c) for c in names), (~in_training(id)).alias("held_out"), found.alias("_llm_found")
    ).select(*(quoted(c) for c in names), "held_out", "_llm_found.*")
