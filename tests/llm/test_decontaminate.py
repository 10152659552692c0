"""Decontamination against plain windows."""

import random
import re

from llm_helpers import documents

from starmart.llm.decontaminate import find_contamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w, hit, met = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    met |= found
        ids = sorted(str(x) for x in met if x is not None)
        out.append((doc, len(w), len(hit), len(met), ids, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids, r.contaminated) for r in df.collect()), key=str)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_shared_spans_of_all_lengths(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 7, 8, 12, 13, 14, 20, 40])))) for i in range(12) if i != 5]
    items = [x for x in items if len(words(x[1])) > 2] + [(70, "x1 x2 x3 x4 x5 x6 x7 x8 x9 x10 x11 x12 x13 x14")]
    rows = []
    for i in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        source = words(rng.choice(items)[1])
        a = rng.randint(0, max(0, len(source) - 5))
        text[10:10] = source[a : a + rng.choice([5, 11, 12, 13, 14, 30])]
        rows.append((i, ", ".join(text).upper()))
    rows += [(90, " ".join(f"x{i}" for i in range(1, 13))), (91, " ".join(f"x{i}" for i in range(1, 14)))]
    assert found(find_contamination(documents(spark, rows), benchmark(spark, items))) == plain(rows, items)


def test_nulls_short_items_long_and_repeated_texts(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    items = [(1, passage), (1, passage), (2, passage), (None, "solo"), (3, None), (4, ""), (5, "…!"), (6, "zwei worte"), (12, "Ünï côde")]
    rows = [
        (1, None), (2, ""), (3, "Solo"), (4, "a zwei-worte b"), (5, passage), (5, passage), (None, f"x {passage} y"),
        (6, " ".join(f"q{i}" for i in range(60_000)) + " " + passage), (7, "ünï CÔDE Ünï cÔde"), (8, (passage + " ") * 40),
    ]
    df = documents(spark, rows).selectExpr("*", "1 AS n_words", "2 AS k", "3 AS hash", "4 AS item_ids", "5 AS words")
    result = find_contamination(df, benchmark(spark, items))
    assert result.columns[:8] == ["doc_id", "text", "lang", "source", "n_chars", "k", "hash", "words"]
    assert found(result) == plain(rows, items)


def test_empty_tables(spark):
    df, items = documents(spark, [(1, "a b")]), benchmark(spark, [(1, "a b")])
    assert find_contamination(df.limit(0), items).count() == 0
    assert found(find_contamination(df, items.limit(0))) == [(1, 2, 0, 0, [], False)]


def test_a_passage_many_times_in_a_document_and_in_many_items(spark, monkeypatch):
    """Repeated 300 times in one text and shared by 300 items: no row for each pair of the two."""
    from starmart.llm import decontaminate

    passage = " ".join(f"p{i}" for i in range(20))
    items = [(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(300)]
    rows = [(1, " x ".join([passage] * 300)), (2, f"a7 b7 {passage} c7"), (3, "nothing of it")]
    sizes = {}
    staged = decontaminate.staged

    def counted(df, name, **options):
        out = staged(df, name, **options)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(decontaminate, "staged", counted)
    result = find_contamination(documents(spark, rows), benchmark(spark, items))
    assert found(result) == plain(rows, items)
    assert {r.doc_id: len(r.spans) for r in result.collect()} == {1: 300, 2: 1, 3: 0}
    assert sizes["bench-meetings"] == 2 and sizes["bench-held"] < 300 * 20 + 30


def test_spans_are_runs_of_words_hit(spark):
    text = " ".join(f"p{i}" for i in range(40))
    items = [(1, " ".join(f"p{i}" for i in range(5, 30))), (2, "p33 p34")]
    row = find_contamination(documents(spark, [(1, text)]), benchmark(spark, items)).first()
    assert [(s.start, s.stop) for s in row.spans] == [(5, 30), (33, 35)] and row.n_hit == 27
