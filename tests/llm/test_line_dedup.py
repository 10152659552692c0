"""Line dedup against plain counting; the store's levels."""

from collections import Counter

import pytest
from llm_helpers import documents

from starmart.llm.common import stage_path
from starmart.llm.line_dedup import LineStore, dedup_lines
from starmart.sources import subfolders

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    counts = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if counts[key(x)] < min_docs]
        out.append((doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


ROWS = [
    *((i, f"  Common LINE\t\nown line {i}\n\ncommon line\nÉ {i % 3}\né {i % 3}") for i in range(12)),
    (50, None), (51, ""), (52, "\n\n"), (53, "common line"), (54, "Common line "), (None, "own line 1\nCOMMON line"),
    (55, "\n".join(f"line {i}" for i in range(30_000)) + "\ncommon line\r"), (3, ROWS3 := "again\nagain\ncommon line"), (3, ROWS3),
]


def test_nulls_long_texts_repeated_rows_and_ties(spark):
    df = documents(spark, ROWS)
    for min_docs in (2, 4, 5, 14, 100):
        assert found(dedup_lines(df, min_docs=min_docs, batches=5)) == plain(ROWS, min_docs), min_docs


def test_clashing_names_other_columns_and_empty_table(spark):
    df = documents(spark, ROWS).selectExpr("*", "'x' AS n_lines", "1 AS h1", "2 AS batch", "3 AS `a.b`")
    kept = dedup_lines(df, min_docs=3)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "h1", "batch", "a.b", "n_lines", "n_dropped"]
    assert found(kept) == plain(ROWS, 3)
    assert dedup_lines(df.limit(0)).count() == 0


def test_batches_are_merged_level_by_level_and_common_lines_leave(spark):
    store = LineStore(spark, stage_path(spark, "test-runs"), min_docs=3, fanout=2)
    total = Counter()
    for batch in range(7):
        counts = {(1, 1): 1, (2, batch % 2): 1, (3, batch): 5 if batch == 4 else 1}
        total.update(counts)
        store.add(spark.createDataFrame([(*k, n) for k, n in counts.items()], "h1 long, h2 long, n_docs long"))
    assert [len(level) for level in store.levels] == [1, 1, 1]
    assert sorted(tuple(r) for r in store.common().collect()) == sorted(k for k, n in total.items() if n >= 3)
    # A line that became common is in no later run.
    assert store._read(store.levels[0]).where("h1 = 1").count() == 0


def line_counts(spark, lines):
    return spark.createDataFrame([(*k, n) for k, n in lines.items()], "h1 long, h2 long, n_docs long")


@pytest.mark.parametrize("fanout", [2, 3])
def test_a_store_is_opened_again_and_goes_on(spark, fanout):
    path = stage_path(spark, "test-reopened")
    total = Counter()
    for batch in range(5):
        # Every batch by another job, in a session that knows nothing of the runs.
        store = LineStore(spark.newSession(), path, min_docs=4, fanout=fanout)
        assert store.batches == [str(b) for b in range(batch)]
        lines = {(i, i * batch % 5): 1 + (i + batch) % 2 for i in range(batch, 20)}
        for _ in range(2):  # the second time it is known
            store.add(line_counts(store.spark, lines), str(batch))
        total.update(lines)
        want = sorted(k for k, n in total.items() if n >= 4)
        assert sorted(tuple(r) for r in store.common().collect()) == want
    runs = {run for level in store.levels for run in level} | set(store.common_runs)
    assert {f"run={r:06d}" for r in runs} == set(subfolders(spark, path, "run=*"))  # merged runs are gone


def test_a_batch_that_fails_leaves_the_store_as_it_was(spark, monkeypatch):
    path = stage_path(spark, "test-failed")
    store = LineStore(spark, path, min_docs=2)
    store.add(line_counts(spark, {(1, 1): 1, (2, 2): 1}), "a")
    with monkeypatch.context() as patched:
        patched.setattr(LineStore, "_put_down", lambda self: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.add(line_counts(spark, {(1, 1): 1}), "b")
    again = LineStore(spark, path)
    assert again.min_docs == 2 and again.batches == ["a"] and again.common().count() == 0
    again.add(line_counts(spark, {(2, 2): 1}), "b")
    assert [tuple(r) for r in again.common().collect()] == [(2, 2)]
