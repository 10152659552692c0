"""Language model: the base score and the exact likelihood against plain loops."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import documents
from pyspark.sql import functions as F

from starmart.llm import lm
from starmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_words(text):
    return [w.decode() for w in lm.words_of((text or "").encode())]


def plain_base(rows):
    """By id: held_out, n_tokens, n_known, base score; and the training tokens."""
    held = lambda doc: zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2
    counts = Counter()
    for doc, text in rows:
        if not held(doc):
            counts.update([*plain_words(text), ""])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        tokens = [*plain_words(text), ""]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out.append((doc, held(doc), len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out, counts


def same(found, expected):
    key = lambda r: (r[0] is None, r[0], r[2])
    for a, b in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)


def test_query_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op7_lm_score"](spark, SF).collect()
    expected, _ = plain_base(rows)
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found], expected)
    held = [r for r in found if r.held_out]
    # Held-out texts are likelier under the latent states than under one distribution of all words.
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def random_model(rng):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return lm.HiddenMarkov(
        norm(rng.random(lm.STATES), 0), norm(rng.random((lm.STATES, lm.STATES)), 1), norm(rng.random((lm.CLASSES, lm.STATES)), 0)
    )


def test_forward_and_backward_match_plain_recursions(monkeypatch):
    rng = np.random.default_rng(3)
    model = random_model(rng)
    rows = [rng.integers(0, 40, n).astype(np.uint16) for n in (1, 1, 2, 5, 5, 9)]
    counts = {"emit": np.zeros((lm.CLASSES, lm.STATES)), "move": np.zeros((lm.STATES,) * 2), "start": np.zeros(lm.STATES)}
    lm.expected_counts(model, rows, np.tile(model.start, (len(rows), 1)), counts)
    emit, move, start, logs = np.zeros_like(counts["emit"]), np.zeros_like(counts["move"]), np.zeros(lm.STATES), []
    for row in rows:
        a = [model.start * model.emit[row[0]]]
        for c in row[1:]:
            a.append((a[-1] @ model.move) * model.emit[c])
        b = [np.ones(lm.STATES)]
        for c in row[:0:-1]:
            b.insert(0, model.move @ (model.emit[c] * b[0]))
        p = a[-1].sum()
        logs.append(math.log10(p))
        for t, c in enumerate(row):
            emit[c] += a[t] * b[t] / p
            if t:
                move += np.outer(a[t - 1], model.emit[c] * b[t]) * model.move / p
        start += a[0] * b[0] / p
    for name, value in (("emit", emit), ("move", move), ("start", start)):
        assert np.allclose(counts[name], value)
    assert np.allclose(lm.log_likelihoods(model, rows), logs)
    monkeypatch.setattr(lm, "SIDE_BY_SIDE", 6)
    assert np.allclose(lm.log_likelihoods(model, rows[::-1]), logs[::-1])


def test_training_makes_the_training_texts_likelier(spark):
    docs = documents(spark, [(i, "ab ac ad ab ac ad" if i % 2 else "xy xz xy xz xx") for i in range(40)])
    train = lambda rounds: sum(
        r.score for r in lm.score_documents(docs, rounds=rounds).collect() if not r.held_out
    )
    assert train(0) < train(1) < train(4)


def test_probabilities_of_all_texts_add_up_to_one():
    words = [b"aa", b"ab"]
    known = lm.Vocabulary(
        words, np.array([3, 1]), 6, 3, 2, np.bincount([0, 0, 1, 1, 1, 2], minlength=lm.CLASSES),
        np.bincount([0, 1, 2], minlength=lm.CLASSES),
    )
    model = lm.first_model(known)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1)
    assert known.log_share[: 1 + lm.OWN].max() == 0


def test_nulls_long_repeated_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3)  # so that most words take the join
    rows = [
        (1, None), (2, ""), (3, "A b\tC"), (4, "a B c d"), (4, "a B c d"), (None, "ohne id"),
        (5, " ".join(f"w{i % 50}" for i in range(150_000))), (6, "never seen words é"),
    ]
    df = documents(spark, rows).selectExpr("*", "1 AS n_tokens", "2 AS row")
    found = lm.score_documents(df, rounds=1).collect()
    expected, _ = plain_base(rows)
    same([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found], expected)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert lm.score_documents(df.limit(0), rounds=1).count() == 0
    alone = lm.score_documents(df.where("doc_id = 3"), folds=1, fold=0, rounds=1).first()
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, 0.0)


@pytest.mark.parametrize("limit", [0, 1, 3, 5, 8, 10, 12, 13, 40])
def test_ties_do_not_empty_the_vocabulary(spark, monkeypatch, limit):
    """Ten words of one count, two of greater ones, one of a lesser: the limit may fall anywhere."""
    rows = [(f"w{i}", 5) for i in range(10)] + [("often", 900), ("also", 901), ("rare", 1), ("", 7)]
    monkeypatch.setattr(lm, "FREQUENT", limit)
    known = lm.vocabulary(spark.createDataFrame(rows, "word string, count long"))
    assert len(known.words) == min(limit, 13)
    counts = dict(rows)
    taken = sorted((counts[w.decode()] for w in known.words), reverse=True)
    assert taken == sorted((n for w, n in rows if w), reverse=True)[:limit]
    again = lm.vocabulary(spark.createDataFrame(rows[::-1], "word string, count long").repartition(5))
    assert again.words == known.words


def plain_expected(model, row):
    """Expected counts of one sequence by unscaled-by-run recursion over the whole of it."""
    n, k = len(row), len(model.start)
    alpha, scale = np.zeros((n, k)), np.zeros(n)
    for t in range(n):
        now = (alpha[t - 1] @ model.move if t else model.start) * model.emit[row[t]]
        scale[t] = now.sum()
        alpha[t] = now / scale[t]
    beta = np.ones((n, k))
    for t in range(n - 2, -1, -1):
        beta[t] = model.move @ (model.emit[row[t + 1]] * beta[t + 1]) / scale[t + 1]
    gamma = alpha * beta
    emit, move = np.zeros_like(model.emit), np.zeros_like(model.move)
    np.add.at(emit, row, gamma)
    for t in range(1, n):
        move += model.move * np.outer(alpha[t - 1], model.emit[row[t]] * beta[t] / scale[t])
    return {"emit": emit, "move": move, "start": gamma[0]}


@pytest.mark.parametrize(("length", "run"), [(1, 4), (4, 4), (5, 4), (23, 7), (23, 1), (2000, 64), (300_000, 1 << 17)])
def test_long_documents_are_counted_exactly(length, run):
    rng = np.random.default_rng(length)
    known = lm.Vocabulary([], np.zeros(0, np.int64), 0, 0, 0, rng.integers(1, 50, lm.CLASSES), np.ones(lm.CLASSES, np.int64))
    first = lm.first_model(known)
    move = rng.dirichlet(np.ones(len(first.start)), len(first.start))
    model = lm.HiddenMarkov(first.start, move, first.emit)
    row = rng.integers(0, lm.CLASSES, length).astype(np.uint16)
    counts = {k: np.zeros_like(getattr(model, k)) for k in ("emit", "move", "start")}
    lm.add_long_document(model, row, counts, run)
    want = plain_expected(model, row)
    for name, found in counts.items():
        assert np.allclose(found, want[name], rtol=1e-9, atol=1e-9), name


def test_scores_against_plain_computation(spark):
    """The whole score: the likelihood of the classes, and each word's share of its class, by plain loops."""
    rng = np.random.default_rng(3)
    words = [f"wort{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(60)] + [(100, None), (101, "neu wort1 Neu")]
    docs = documents(spark, rows)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    counts = lm.count_words(docs.where(~held), "text")
    known = lm.vocabulary(counts)
    encoded = lm.sequences(docs, "doc_id", "text", held, known)
    model = lm.first_model(known)
    for _ in range(lm.ROUNDS):
        model = lm.baum_welch_round(encoded, model, known)
    by_word = {r["word"]: r["count"] for r in counts.collect()}
    own = {w.decode(): i for i, w in enumerate(known.words[: lm.OWN])}
    for r in lm.score_documents(docs).collect():
        text = dict(rows)[r.doc_id]
        tokens, total, alpha = [*plain_words(text), None], 0.0, None
        for token in tokens:
            c = lm.END if token is None else 1 + own[token] if token in own else lm.shared_class(token.encode())
            now = (model.start if alpha is None else alpha @ model.move) * model.emit[c]
            total += math.log10(now.sum())
            alpha = now / now.sum()
            if token is not None and token not in own:
                total += math.log10((by_word.get(token, 0) + 1) / (known.class_tokens[c] + known.class_words[c] + 1))
        assert abs(total - r.score) < 1e-6 * max(1, abs(total)), r
