"""Shards: contiguous, balanced, gapless, whatever the rows."""

import hashlib
import zlib

import pytest
from llm_helpers import documents

from starmart.llm.sharding import balanced_shards


def plain(rows, shards):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    order = lambda r: (md5(r[1] or "")[:3], md5("" if r[0] is None else str(r[0]))[:2], md5(r[1] or ""), md5("" if r[0] is None else str(r[0])))
    size = lambda r: len((r[1] or "").encode()) + 1
    total, before, slots, out = sum(map(size, rows)), 0, {}, []
    for r in sorted(rows, key=order):
        shard = min((2 * before + size(r)) * shards // (2 * total), shards - 1)
        before += size(r)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((r[0], size(r), zlib.crc32((r[1] or "").encode()), shard, slots[shard]))
    return sorted(out, key=str)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_nulls_repeated_rows_long_and_equal_texts(spark, shards):
    rows = [(i, "the same text, a third of all rows") for i in range(40)] + [(i, f"text {i} é " * (i % 7)) for i in range(80)]
    rows += [(1, None), (2, ""), (None, None), (None, "x"), (7, "again"), (7, "again"), (8, "long " * 3000)]
    df = documents(spark, rows).selectExpr("*", "1 AS size", "2 AS `rows`", "3 AS bytes")
    placed = balanced_shards(df, shards=shards)
    assert placed.columns == ["doc_id", "lang", "source", "n_chars", "rows", "bytes", "size", "text_crc32", "shard", "slot"]
    found = [(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in placed.collect()]
    assert sorted(found, key=str) == plain(rows, shards)
    loads = [sum(f[1] for f in found if f[3] == s) for s in range(shards)]
    assert max(loads) - min(loads) < 2 * max(f[1] for f in found)


def test_fewer_rows_than_shards_and_none(spark):
    df = documents(spark, [(1, "a"), (2, "b")])
    assert sorted(r.slot for r in balanced_shards(df).collect()) == [0, 0]
    assert balanced_shards(df.limit(0)).count() == 0
