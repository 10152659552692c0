"""A hidden Markov language model, trained by Baum-Welch over all partitions.

Latent states emit classes of words: the ``OWN`` most frequent words are a class each, as is the end of
a document; the others share ``SHARED`` classes by their last two letters, and within a class a word
has its (count + 1) share, one part going to all unseen words. So every text has a proper probability.

1. Words are counted over all training documents (each task combines its own first).
2. Documents become sequences of class numbers, two bytes a token. Counts of the ``FREQUENT`` most
   frequent words (a bounded table) are looked up on the spot; the rest of each document's words is joined
   with the full counts, so that no vocabulary has to fit into a task.
3. Each round of Baum-Welch runs the scaled forward and backward recursions over all training sequences;
   tasks send expected counts by class (bounded), which are summed by a grouping.
4. The forward recursion gives each document's exact likelihood, long ones included.

The recursions run over many documents side by side in numpy, sorted by length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starmart.functions.columns import quoted
from starmart.llm.common import LOWER, UPPER, prepare_workers, staged

END = 0  # the class of the end of a document; its word is the empty one
OWN = 4096
SHARED = 255
CLASSES = 1 + OWN + SHARED
FREQUENT = 1 << 17
STATES = 6
ROUNDS = 4
RUN = 1 << 17  # training holds the messages of so many tokens of a longer document at a time
SIDE_BY_SIDE = 1 << 18  # tokens of all documents worked on at a time
COUNTED_AT_ONCE = 300_000  # distinct words that a task gathers before it sends their counts
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWERED).split()


def shared_class(word: bytes) -> int:
    return 1 + OWN + zlib.crc32(word.decode("utf-8", "replace")[-2:].encode()) % SHARED


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, count) over all documents; the empty word stands for the end of each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def batch_of() -> pa.RecordBatch:
            words = pa.array(list(counts.keys()), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "count"])

        for batch in batches:
            for value in batch.column(0):
                counts.update(words_of(value.as_py() or b""))
                counts[b""] += 1
                if len(counts) > COUNTED_AT_ONCE:
                    yield batch_of()
                    counts.clear()
        yield batch_of()

    counted = docs.select(quoted(text).cast("binary").alias("text")).mapInArrow(count, "word string, count long")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words in order, at most FREQUENT, and what the others add up to."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int
    ends: int
    class_tokens: np.ndarray  # training tokens by class
    class_words: np.ndarray  # distinct training words by class

    @property
    def log_share(self) -> np.ndarray:
        """log10 of what a count in a shared class is divided by; 0 for classes of one word."""
        out = np.log10(self.class_tokens + self.class_words + 1.0)
        out[: 1 + OWN] = 0
        return out


def frequent_words(counts: DataFrame) -> list:
    """The FREQUENT words of greatest count, of equal ones those of least hash; all words if there are fewer.

    An ordering with a limit would have every task send so many words. Instead sizes tell how far down to go: first of
    counts in steps of about a hundredth, a few thousand rows; then, in the step that is not taken as a whole, of its
    counts; then, of the words of one count, a share that holds about twice as many as are needed.
    """

    def whole_groups(group, rows: DataFrame, room: int):
        """(least group that is taken with all above it, the next one, its size, room left)."""
        lowest = None
        for size in sorted(rows.groupBy(group.alias("g")).count().collect(), reverse=True):
            if size["count"] > room:
                return lowest, size["g"], size["count"], room
            lowest, room = size["g"], room - size["count"]
        return lowest, None, 0, room

    step, count = F.floor(F.log2("count") * 64).cast("int"), F.col("count")
    lowest, last_step, _, room = whole_groups(step, counts, FREQUENT)
    top = [] if lowest is None else counts.where(step >= lowest).collect()
    if last_step is not None:
        within = counts.where(step == last_step)
        lowest, last_count, size, room = whole_groups(count, within, room)
        top += [] if lowest is None else within.where(count >= lowest).collect()
        if last_count is not None and room:
            order = F.pmod(F.xxhash64("word"), F.lit(1 << 40))
            few = within.where(count == last_count).where(order < int(min(1.0, (2 * room + 40) / size) * (1 << 40)))
            top += few.orderBy(order, "word").limit(room).collect()
    return top


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = counts.where("word = ''").agg(F.sum("count")).first()[0] or 0
    top = frequent_words(counts.where("word <> ''"))
    top.sort(key=lambda r: (-r["count"], r.word))
    words, numbers = [r.word.encode() for r in top], np.array([r["count"] for r in top], np.int64)
    suffix = F.crc32(F.right("word", F.lit(2)).cast("binary")) % SHARED
    # All words by shared class; those with a class of their own are taken out again.
    shared = counts.where("word <> ''").groupBy(suffix.cast("int").alias("c")).agg(F.sum("count"), F.count(F.lit(1)))
    tokens, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for c, n, v in shared.collect():
        tokens[1 + OWN + c], distinct[1 + OWN + c] = n, v
    for i, word in enumerate(words[:OWN]):
        c = shared_class(word)
        tokens[c] -= numbers[i]
        distinct[c] -= 1
        tokens[1 + i], distinct[1 + i] = numbers[i], 1
    tokens[END], distinct[END] = ends, int(ends > 0)
    return Vocabulary(words, numbers, total.n or 0, total.v or 0, ends, tokens, distinct)


class Ranks(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def sequences(docs: DataFrame, id: str, text: str, held_out, known: Vocabulary) -> DataFrame:
    """A row per document: its classes, the sums over its frequent words, and the words to be joined.

    ``found``: tokens with a known count; ``logs``: sum of log10(count + 1); ``inner``: the log10 shares within
    the classes as far as known here; ``rest``: the other words with their number.
    """
    own = docs.select(quoted(id).alias("id"), held_out.alias("held_out"), quoted(text).cast("binary").alias("text"))
    fields = StructType.fromDDL(
        "held_out boolean, n_tokens long, found long, logs double, inner double, classes binary,"
        " rest array<struct<word: string, times: int>>"
    )
    schema = StructType([StructField("id", own.schema["id"].dataType), *fields.fields])
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        ranks = Ranks(zip(v.words, range(len(v.words)), strict=True))
        logs = np.log10(v.counts + 1.0)
        class_of = np.array([1 + i if i < OWN else shared_class(w) for i, w in enumerate(v.words)], np.uint16)
        share, end_log = v.log_share, float(np.log10(v.ends + 1.0))
        for batch in batches:
            numbers = {k: [] for k in ("n_tokens", "found", "logs", "inner")}
            classes, offsets, rest_words, rest_times = [], [0], [], []
            for value in batch.column("text"):
                words = words_of(value.as_py() or b"")
                rank = np.fromiter(map(ranks.__getitem__, words), np.int32, len(words))
                seen = rank[rank >= 0]
                row = np.full(len(words) + 1, END, np.uint16)
                if len(seen):
                    row[:-1][rank >= 0] = class_of[seen]
                missing = np.flatnonzero(rank < 0).tolist()
                if missing:
                    others = [words[i] for i in missing]
                    row[missing] = [shared_class(w) for w in others]
                    counted = Counter(others)
                    rest_words += counted.keys()
                    rest_times += counted.values()
                offsets.append(len(rest_words))
                numbers["n_tokens"].append(len(words) + 1)
                numbers["found"].append(len(seen) + (v.ends > 0))
                numbers["logs"].append(float(logs[seen].sum()) + end_log)
                numbers["inner"].append(float(logs[seen[seen >= OWN]].sum() - share[row].sum()))
                classes.append(row.astype("<u2").tobytes())
            rest = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(rest_words, pa.binary()).cast(pa.string()), pa.array(rest_times, pa.int32())],
                    ["word", "times"],
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("held_out"), pa.array(numbers["n_tokens"], pa.int64()),
                    pa.array(numbers["found"], pa.int64()), pa.array(numbers["logs"], pa.float64()),
                    pa.array(numbers["inner"], pa.float64()), pa.array(classes, pa.binary()), rest,
                ],
                [f.name for f in schema],
            )

    return own.mapInArrow(encode, schema)


@dataclass(frozen=True)
class HiddenMarkov:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # classes x states


def first_model(known: Vocabulary) -> HiddenMarkov:
    """Near the class frequencies, each state leaning its own way."""
    rng = np.random.default_rng(11)
    share = (known.class_tokens + 1.0) / (known.class_tokens + 1.0).sum()
    emit = share[:, None] * rng.uniform(0.5, 1.5, (CLASSES, STATES))
    move = np.full((STATES, STATES), 0.1 / (STATES - 1)) + np.eye(STATES) * (0.9 - 0.1 / (STATES - 1))
    return HiddenMarkov(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


def side_by_side(rows: list[np.ndarray]) -> Iterator[list[int]]:
    """Lots of documents alike in length, of a bounded number of tokens together."""
    lot: list[int] = []
    for i in sorted(range(len(rows)), key=lambda i: len(rows[i])):
        if lot and (len(lot) + 1) * len(rows[i]) > SIDE_BY_SIDE:
            yield lot
            lot = []
        lot.append(i)
    if lot:
        yield lot


def log_likelihoods(model: HiddenMarkov, rows: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each class sequence, by the scaled forward recursion."""
    out = np.zeros(len(rows))
    for lot in side_by_side(rows):
        grid, _, began = as_grid([rows[i] for i in lot])
        total, alpha = np.zeros(len(lot)), np.tile(model.start, (len(lot), 1))
        for t, a in enumerate(began.tolist()):
            now = (alpha[a:] @ model.move if t else alpha) * model.emit[grid[t, a:]]
            scale = now.sum(axis=1)
            alpha[a:] = now / scale[:, None]
            total[a:] += np.log10(scale)
        out[lot] = total
    return out


def as_grid(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Time x documents of ascending length; the lengths; by time, how many documents are over."""
    lengths = np.array([len(r) for r in rows])
    grid = np.zeros((int(lengths[-1]), len(rows)), np.uint16)
    for j, r in enumerate(rows):
        grid[: len(r), j] = r
    return grid, lengths, np.searchsorted(lengths, np.arange(len(grid)), side="right")


def expected_counts(
    model: HiddenMarkov,
    rows: list[np.ndarray],
    firsts: np.ndarray,
    counts: dict[str, np.ndarray],
    *,
    beta: np.ndarray | None = None,
    begins: bool = True,
) -> np.ndarray:
    """Add one lot's expected counts, by the forward and backward recursions.

    ``rows``: sequences by ascending length; ``firsts``: for each the state probabilities before its first token.
    ``beta``: what each state after the last token is worth by what follows, where something does; ``begins``: the first
    tokens are those of documents. Gives what each state of the first tokens is worth, by them and all that follows.
    """
    grid, lengths, began = as_grid(rows)
    longest, n = grid.shape
    inside = np.arange(longest)[:, None] < lengths[None, :]
    seen = model.emit[grid]  # time x documents x states
    alpha = np.zeros_like(seen)
    scale = np.ones((longest, n))
    for t, a in enumerate(began.tolist()):
        now = (alpha[t - 1, a:] @ model.move if t else firsts) * seen[t, a:]
        scale[t, a:] = now.sum(axis=1)
        alpha[t, a:] = now / scale[t, a:, None]
    beta = np.ones((n, STATES)) if beta is None else beta.copy()
    back = np.zeros_like(seen)  # what a state is worth by all that follows, and by its own token
    gamma = np.zeros_like(seen)
    for t in range(longest - 1, -1, -1):
        a = began[t]
        gamma[t, a:] = alpha[t, a:] * beta[a:]
        back[t, a:] = seen[t, a:] * beta[a:] / scale[t, a:, None]
        beta[a:] = back[t, a:] @ model.move.T
    flat = grid[inside]
    weights = gamma[inside]
    weights /= weights.sum(axis=1, keepdims=True)
    for k in range(STATES):
        counts["emit"][:, k] += np.bincount(flat, weights[:, k], minlength=CLASSES)
    if longest > 1:
        both = inside[1:]
        counts["move"] += model.move * (alpha[:-1][both].T @ back[1:][both])
    if begins:
        first = gamma[0] / gamma[0].sum(axis=1, keepdims=True)
        counts["start"] += first.sum(axis=0)
    return back[0]


def add_long_document(model: HiddenMarkov, row: np.ndarray, counts: dict[str, np.ndarray], run: int) -> None:
    """Add the expected counts of one document, exactly, holding the messages of ``run`` tokens at a time.

    A first walk keeps the forward message at each border between runs; the second goes through the runs from the last to
    the first and hands the backward message on.
    """
    runs = [row[at : at + run] for at in range(0, len(row), run)]
    firsts, lasts = [model.start], []
    for part in runs:
        alpha = firsts[-1]
        for t, token in enumerate(part.tolist()):
            alpha = (alpha @ model.move if t else alpha) * model.emit[token]
            alpha = alpha / alpha.sum()
        lasts.append(alpha)
        firsts.append(alpha @ model.move)
    beta = np.ones((1, STATES))
    for i in range(len(runs) - 1, -1, -1):
        back = expected_counts(model, [runs[i]], firsts[i][None, :], counts, beta=beta, begins=i == 0)
        beta = back @ model.move.T
        if i:  # the move over the border
            counts["move"] += model.move * np.outer(lasts[i - 1], back[0])


def baum_welch_round(encoded: DataFrame, model: HiddenMarkov, known: Vocabulary) -> HiddenMarkov:
    """One re-estimation over all training sequences."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    states = [f"s{k}" for k in range(STATES)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        counts = {"emit": np.zeros((CLASSES, STATES)), "move": np.zeros((STATES, STATES)), "start": np.zeros(STATES)}
        for batch in batches:
            rows = [np.frombuffer(v.as_py(), "<u2") for v in batch.column(0)]
            short = [r for r in rows if len(r) <= RUN]
            for lot in side_by_side(short):
                expected_counts(m, [short[i] for i in lot], np.tile(m.start, (len(lot), 1)), counts)
            for row in rows:
                if len(row) > RUN:
                    add_long_document(m, row, counts, RUN)
        # Classes, then moves from each state, then starts.
        table = np.vstack([counts["emit"], counts["move"], counts["start"]])
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(table[used, k]) for k in range(STATES))], ["row", *states]
        )

    summed = (
        encoded.where("NOT held_out")
        .select("classes")
        .mapInArrow(count, "row int, " + ", ".join(f"{s} double" for s in states))
        .groupBy("row")
        .agg(*(F.sum(s).alias(s) for s in states))
    )
    table = np.zeros((CLASSES + STATES + 1, STATES))
    for r in summed.collect():  # CLASSES + STATES + 1 rows at most
        table[r.row] = [r[s] for s in states]
    share = (known.class_tokens + 1.0) / (known.class_tokens + 1.0).sum()
    emit = table[:CLASSES] + 10.0 * share[:, None]
    move = table[CLASSES : CLASSES + STATES] + 0.1
    start = table[-1] + 0.1
    return HiddenMarkov(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def score_documents(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, rounds: int = ROUNDS
) -> DataFrame:
    """Score every whole text by a model of those whose CRC-32 of the id as text is not ``fold`` modulo ``folds``.

    Result: the id, ``held_out``, ``n_tokens`` (words and the end), ``n_known`` (with a training count),
    ``train_tokens``, ``base_score`` (add-one unigram) and ``score`` (hidden Markov model), both log10 probabilities.

    * A null or empty text is its end alone. A null id counts as an empty text when folds are dealt.
    * Rows that come again are counted and scored again. Without training documents every word is unseen.
    * Other input columns are not kept, so their names cannot clash.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    held_out = F.crc32(F.coalesce(quoted(id).cast("string"), F.lit("")).cast("binary")) % folds == fold
    counts = staged(count_words(docs.where(~held_out), text), "word-counts")
    known = vocabulary(counts)
    encoded = sequences(docs, id, text, held_out, known).withColumn("row", F.monotonically_increasing_id())
    encoded = staged(encoded, "class-sequences")
    model = first_model(known)
    for _ in range(rounds):
        model = baum_welch_round(encoded, model, known)

    shared = spark.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(v.as_py(), "<u2") for v in batch.column("classes")]
            likely = log_likelihoods(shared.value, rows)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(likely)], ["row", "likely"])

    likely = encoded.select("row", "classes").mapInArrow(forward, "row long, likely double")
    rest = (
        encoded.select("row", F.explode("rest").alias("w"))
        .select("row", "w.*")
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("count") + 1.0)).alias("more_logs"))
    )
    logs = F.coalesce("more_logs", F.lit(0.0))
    return (
        encoded.drop("classes", "rest")
        .join(likely, "row")
        .join(rest, "row", "left")
        .select(
            F.col("id").alias(id),
            "held_out",
            "n_tokens",
            (F.col("found") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(known.tokens).cast("long").alias("train_tokens"),
            (F.col("logs") + logs - F.col("n_tokens") * F.log10(F.lit(known.tokens + known.distinct + 1.0))).alias(
                "base_score"
            ),
            (F.col("likely") + F.col("inner") + logs).alias("score"),
        )
    )
