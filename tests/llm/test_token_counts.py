"""Separator scan against plain splitting, blocks of any size."""

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import documents
from tokenizers import Tokenizer

from starmart.llm import token_counts
from starmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_counts(texts):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    model.encode_special_tokens = True
    return [len(model.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), plain_counts([r.text for r in rows]), strict=True))
    found = QUERIES["op3_token_counts"](spark, SF).collect()
    assert len(found) == len(rows) and {r.doc_id: r.n_tokens for r in found} == want


def test_order_nulls_special_and_long_texts(spark, tmp_path):
    texts = ["ein paar Worte", None, "", "a <|endoftext|> b", "lang " * 50_000, "ein paar Worte"]
    docs = documents(spark, list(enumerate(texts))).coalesce(1).selectExpr("*", "1 AS ids", "2 AS path", "3 AS N_Tokens")
    path = str(tmp_path / "flat")
    index = token_counts.write_token_files(docs, path)
    assert [(r.document, r.id) for r in index.orderBy("document").collect()] == [(i, i) for i in range(6)]
    found = token_counts.count_tokens(token_counts.token_files(spark, path), block_bytes=64).orderBy("document").collect()
    assert [r.n_tokens for r in found] == plain_counts(texts) and all(r.closed for r in found)
    assert [r.start for r in found] == (np.cumsum([0, *plain_counts(texts)])[:-1] + np.arange(6)).tolist()
    assert token_counts.count_document_tokens(docs.limit(0)).count() == 0


def test_every_row_has_its_own_count(spark):
    """Null and repeated ids, and more tasks than rows."""
    rows = [(1, "eins zwei"), (1, "eins"), (None, "a b c"), (None, None), (2, ""), (2, "")]
    found = token_counts.count_document_tokens(documents(spark, rows).repartition(8), block_bytes=4).collect()
    want = zip([r[0] for r in rows], plain_counts([r[1] for r in rows]), strict=True)
    assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in found))) == sorted(map(str, want))


def test_files_of_lost_tasks_do_not_count(spark, monkeypatch, tmp_path):
    docs = documents(spark, [(1, "eins zwei"), (2, "drei")])
    path = str(tmp_path / "flat")
    monkeypatch.setattr(token_counts, "stage_path", lambda *a: path)
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "part-000000-lost").write_bytes(b"1234567890")
    assert token_counts.count_document_tokens(docs).count() == 2


def test_the_scan_over_a_file_carries_numbers_only(spark, tmp_path):
    (tmp_path / "flat").write_bytes(np.tile(np.array([5, 0], "<u2"), 1000).tobytes())
    found = token_counts.count_tokens(token_counts.token_files(spark, str(tmp_path)), end=0, block_bytes=100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert "ends" not in window.replace("n_ends", "") and found.count() == 1000


@pytest.mark.parametrize("block_bytes", [4, 8, 12, 4096])
def test_blocks_of_any_size(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(6)
    files = {
        "mixed": rng.choice([0, 1, 2, 70_000], 300), "no_end": [5, 6, 7], "only_ends": [0, 0, 0], "empty": [],
        "open": [1, 0, 2, 3], "one": [0],
    }
    expected = []
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes())
        start = n = 0
        for place, token in enumerate([*ids, None]):
            if token == 0 or (token is None and place > start):
                expected.append((name, n, start, place - start, token == 0))
                start, n = place + 1, n + 1
    found = token_counts.count_tokens(token_counts.token_files(spark, str(tmp_path)), end=0, width=4, block_bytes=block_bytes).collect()
    assert sorted((r.path.rsplit("/", 1)[1], *r[1:]) for r in found) == sorted(expected)


def test_half_a_token_is_an_error(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"123")
    with pytest.raises(Exception, match="whole tokens"):
        token_counts.count_tokens(token_counts.token_files(spark, str(tmp_path))).collect()
