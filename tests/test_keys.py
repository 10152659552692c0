import random
import re
import uuid
from collections import Counter

import pytest

from starmart.operators import keys
from starmart.operators.keys import with_surrogate_id
from starmart.queries import shapes
from starmart.queries.keys import kept_ids_copies


def distinct_frame(spark, seed, partitions):
    rows = [(i % 3 or None, f"name {i % 11}", i / 4) for i in range(500)]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "a int, b string, c double").repartition(partitions)


def with_shuffle_partitions(spark, n, run):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        return run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("distinct", [True, False])
def test_ids_do_not_depend_on_partitioning_or_order(spark, distinct):
    seen = []
    for seed, partitions in ((1, 1), (2, 3), (3, 8)):
        df = with_surrogate_id(distinct_frame(spark, seed, partitions), distinct=distinct)
        seen.append(with_shuffle_partitions(spark, partitions, lambda df=df: {tuple(r) for r in df.collect()}))
    assert seen[0] == seen[1] == seen[2]
    ids = [r[-1] for r in seen[0]]
    assert len(set(ids)) == 500 and min(ids) >= 0


def test_both_ways_give_distinct_rows_the_same_ids(spark):
    df = distinct_frame(spark, 1, 2)
    assert {tuple(r) for r in with_surrogate_id(df, distinct=True).collect()} == {
        tuple(r) for r in with_surrogate_id(df).collect()
    }


def test_copies_get_ids_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(keys, "COPIES_PER_SLICE", 7)
    rows = [("hot", None)] * 1000 + [("warm", 1.0)] * 8 + [(f"cold {i}", 2.0) for i in range(1500)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "a string, b double").repartition(6)
    out = [tuple(r) for r in with_surrogate_id(df).collect()]
    assert Counter((a, b) for a, b, _ in out) == Counter(rows)
    assert len({i for _, _, i in out}) == len(rows)
    hot = sorted(i for a, _, i in out if a == "hot")
    assert hot == list(range(hot[0], hot[0] + 1000))
    again = [tuple(r) for r in with_surrogate_id(df.repartition(2)).collect()]
    assert sorted(out, key=str) == sorted(again, key=str)


def test_copies_are_spread_over_tasks(spark, monkeypatch):
    """A third of all rows are one row; no task writes them all."""
    monkeypatch.setattr(keys, "COPIES_PER_SLICE", 100)
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, -1, id) as v")
    sizes = with_surrogate_id(df).selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    largest = max(r["count"] for r in sizes)
    assert len(sizes) == 8 and largest < 90_000 / 8 * 1.5


def joined_plan(left, right):
    """How Spark joined the two by id in the end."""
    joined = left.join(right.withColumnRenamed("v", "w"), "id")
    assert joined.collect()
    return joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_copies_are_not_broadcast(spark):
    """Spark takes rows that are exploded after a shuffle for as small as what was shuffled."""
    df = spark.range(200_000).selectExpr("id % 3 as v")
    plan = joined_plan(with_surrogate_id(df), with_surrogate_id(df.repartition(3)))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_the_contract_of_ids_is_checked_without_a_join(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d"), (-1, "e"), (7, "f")]
    df = spark.createDataFrame(rows, "id long, v string")
    again = spark.createDataFrame([*rows[:3], (3, "other"), (None, "d"), (-1, "e"), (7, "f"), (7, "f")], df.schema)
    checked = shapes.with_id_contract(df, again, "id")
    assert Counter(map(tuple, checked.collect())) == Counter(
        {("a", False): 2, (None, True): 1, ("c", False): 1, ("d", False): 1, ("e", False): 1, ("f", False): 1}
    )
    assert "Join" not in checked._jdf.queryExecution().executedPlan().toString()


def test_hot_values_do_not_fill_a_bucket(spark):
    """Distinct rows that share a value in every key-like column still spread evenly."""
    df = spark.range(20_000).selectExpr("'CA' as state", "null as note", "id as v")
    ids = with_surrogate_id(df, distinct=True, bits=6)
    buckets = ids.selectExpr("shiftright(id, 57) as bucket").groupBy("bucket").count().collect()
    assert len(buckets) == 64 and max(r["count"] for r in buckets) < 20_000 / 64 * 1.5


def test_window_is_never_unpartitioned(spark):
    for distinct in (True, False):
        df = with_surrogate_id(distinct_frame(spark, 1, 2), distinct=distinct)
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "`Median Age` int, `a.b` int")
    assert with_surrogate_id(df).columns == ["Median Age", "a.b", "id"]
    assert with_surrogate_id(df, distinct=True).count() == 2


def refresh(spark, folder, known, df, *, distinct=False, **options):
    """(rows with ids, key map) of a refresh; the map is what the one before gave and what is new."""
    path = f"{folder}/{uuid.uuid4().hex}"
    keys.assign_kept_ids(df, known, distinct=distinct, **options).write.parquet(path)
    assigned = spark.read.parquet(path)
    added = keys.new_keys(assigned)
    ids = keys.rows_with_kept_ids(assigned, distinct=distinct)
    return ids, added if known is None else known.union(added)


def some_rows(spark, numbers, partitions=4):
    rows = [(None if i % 5 == 0 else i, f"name {i}" if i % 7 else None, float(i % 3)) for i in numbers]
    return spark.createDataFrame(rows, "a int, b string, c double").repartition(partitions)


@pytest.mark.parametrize("bits", [2, 20])
def test_known_rows_keep_their_ids_whatever_comes_and_goes(spark, tmp_path, bits):
    known, given = None, {}
    for n, numbers in enumerate((range(40), range(20, 90), [], range(0, 90, 3), range(120))):
        ids, known = refresh(spark, tmp_path, known, some_rows(spark, numbers, 1 + n), distinct=True, bits=bits)
        rows = {tuple(r[:-1]): r.id for r in ids.collect()}
        assert len(rows) == len(set(rows.values())) == len(some_rows(spark, numbers).distinct().collect())
        assert all(given.get(row, id_) == id_ for row, id_ in rows.items())
        # An id is never given to another row, also not that of a row that is gone.
        assert not {i for r, i in given.items() if r not in rows} & set(rows.values())
        given |= rows
    assert min(given.values()) >= 0 and known.count() == len(given)


def test_copies_keep_their_ids(spark, tmp_path):
    frame = lambda counts: spark.createDataFrame([(v,) for v, n in counts.items() for _ in range(n)], "v string")
    known, seen = None, {}
    for counts in ({"x": 3, "y": 1}, {"x": 5, "z": 2}, {"x": 2, "y": 4, "z": 2}, {"x": 9, "y": 4}):
        ids, known = refresh(spark, tmp_path, known, frame(counts), bits=1)
        got = {}
        for r in ids.collect():
            got.setdefault(r.v, set()).add(r.id)
        assert {v: len(i) for v, i in got.items()} == counts
        assert len(set().union(*got.values())) == sum(counts.values())
        for v, ids_now in got.items():
            before = seen.get(v, set())
            assert ids_now <= before or before <= ids_now
            seen[v] = before | ids_now
    assert sum(len(i) for i in seen.values()) == 9 + 4 + 2


def test_rows_that_differ_in_what_is_null_are_not_one(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("", None), ("a", "")], "x string, y string")
    ids, known = refresh(spark, tmp_path, None, df, distinct=True)
    assert len({r.id for r in ids.collect()}) == 5 and known.count() == 5
    again, _ = refresh(spark, tmp_path, known, df, distinct=True)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in ids.collect()}


def test_kept_ids_take_one_shuffle(spark, tmp_path):
    _, known = refresh(spark, tmp_path, None, some_rows(spark, range(50)), distinct=True)
    path = str(tmp_path / "known")
    known.write.parquet(path)
    more = spark.range(100).selectExpr("cast(id as int) as a", "string(id) as b", "double(id) as c")
    plan = keys.assign_kept_ids(more, spark.read.parquet(path), distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "Join" not in plan and "Python" not in plan


def test_kept_copies_are_not_broadcast(spark, tmp_path):
    df = spark.range(200_000).selectExpr("id % 3 as v")
    first, known = refresh(spark, tmp_path, None, df)
    rows, _ = refresh(spark, tmp_path, known, df)
    plan = joined_plan(first, rows)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_kept_copies_are_checked_in_a_stated_number_of_tasks(spark, tmp_path):
    """By what is shuffled, adaptive execution would put them into a few tasks of many rows."""
    rows = [(i % 4, "AR"[i % 2], f"199{4 + i % 3}-05-06") for i in range(600)]
    lines = spark.createDataFrame(rows, "l_suppkey long, l_returnflag string, day string")
    lines = lines.selectExpr("l_suppkey", "l_returnflag", "cast(day as date) as l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = kept_ids_copies(spark, str(tmp_path))
    assert {tuple(r) for r in found.select("l_suppkey", "rows", "ids", "known_before", "kept").collect()} == {
        (k, 150, 150, 100, 100) for k in range(4)
    }
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"hashpartitioning\(l_suppkey#\d+L, l_returnflag#\d+, id#\d+L, 8\), REPARTITION_BY_NUM", plan)) == 2
