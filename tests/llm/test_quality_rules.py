"""Quality rules against plain loops; expectation-maximisation on votes of known accuracy."""

import random
import re
from collections import Counter

from llm_helpers import documents

from starmart.llm import quality
from starmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_word_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_capitals": len(re.findall("[A-Z]", text)), "n_digits": len(re.findall("[0-9]", text)),
    }


def plain_votes(m):
    """The default rules in plain words; no words, no ratios."""
    def vote(bad, good):
        return 2 if bad else 1 if good else 0

    w, lines = m["n_words"], m["n_word_lines"]
    out = [vote(w < 50, w >= 100)]
    if not w:
        return (*out, *[0] * 8)
    length, dup = m["word_chars"] / w, m["n_dup_lines"] / lines
    symbols, repeats, capitals, digits = (m[k] / w for k in ("n_symbols", "n_repeat_words", "n_capitals", "n_digits"))
    return (
        *out, vote(length < 2.5 or length > 12, 3.5 <= length <= 9), vote(symbols > 0.1, symbols < 0.02),
        vote(symbols > 0.3, symbols < 0.05), vote((s := m["n_symbols"] / m["word_chars"]) > 0.05, s < 0.01), vote(dup > 0.3, dup < 0.1),
        vote(repeats > 0.5, repeats < 0.2), vote(capitals > 2, capitals < 0.7), vote(digits > 1, digits < 0.1),
    )


def plain_judgement(texts):
    measured = [plain_measures(t) for t in texts]
    votes = [plain_votes(m) for m in measured]
    model = quality.fit_votes(dict(Counter(votes)), 9)
    return [(m, model.log_odds(v) >= 0) for m, v in zip(measured, votes, strict=True)]


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = sorted(QUERIES["op6_quality_rules"](spark, SF).collect(), key=lambda r: r.doc_id)
    for row, r, (m, good) in zip(rows, found, plain_judgement([x.text for x in rows]), strict=True):
        assert row.doc_id == r.doc_id
        failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        assert {k: r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")} == {
            k: m[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        }
        assert (r.base_failed, r.kept) == (failed, not failed and good)
    assert 0 < sum(r.kept for r in found) < len(found)


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    texts = [
        None, "", " \n\t", "a b c a b c", "a b c a b", "x x x x", "a\n a\nb\na", "é É É é", "eins zwei drei vier " * 20_000,
        " ".join(f"w{i}" for i in range(50_000)) + " w1 w2 w3 w4", "a b c a b c",
    ]
    df = documents(spark, list(enumerate(texts))).selectExpr("*", "1 AS n_words", "2 AS kept", "3 AS votes", "4 AS quality")
    found = {r.doc_id: r for r in quality.judge_quality(df).collect()}
    for i, (m, good) in enumerate(plain_judgement(texts)):
        assert {k: found[i][k] for k in m} == m, texts[i]
        assert found[i].kept == good
    assert quality.judge_quality(df.limit(0)).count() == 0


def test_equal_high_bits_of_different_hashes_are_told_apart(spark):
    # Alike in the high bits, with other hashes between equal ones.
    a, b = 1 << 40, (1 << 40) + 1
    df = spark.createDataFrame([(1, [a, b, a, 5, b, 7, 8]), (2, [a, b, 9]), (3, [a, a]), (4, [])], "id int, w array<bigint>")
    found = {r.id: r.n for r in quality.words_repeated(df, "w", ["id"], "n").collect()}
    assert found == {1: len({0, 1, 2, 3, 4, 5, 6}), 2: 0, 3: 4, 4: 0}


def test_accuracies_are_found_from_votes_alone():
    rng = random.Random(2)
    accuracy, votes = [0.95, 0.8, 0.7, 0.6], Counter()
    for _ in range(20_000):
        good = rng.random() < 0.7
        votes[tuple(0 if rng.random() < 0.3 else 1 if (rng.random() < a) == good else 2 for a in accuracy)] += 1
    model = quality.fit_votes(dict(votes), 4, rounds=200)
    assert abs(model.prior - 0.7) < 0.05
    assert all(abs(model.accuracy(i) - a) < 0.05 for i, a in enumerate(accuracy))
    assert quality.fit_votes({}, 4).prior == 0.5
