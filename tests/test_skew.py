"""A third of all rows share a key. Results stay whole, and no task gets the third."""

import re

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from starmart.operators.clean import distinct_rows
from starmart.operators.labels import code_list_tables, parse_code_lists
from starmart.operators.lookup import Lookup, conform_codes, hot_codes, lookup_codes, spread_join
from starmart.plans.star import count_by
from starmart.schemas import CODE_LISTS
from starmart.sources import read_table, write_table

ROWS = 300_000


@pytest.fixture
def shuffled_joins(spark):
    """Lists too large to broadcast, and partitions small enough for the test to count as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


@pytest.fixture(params=["0", "null"])
def hot(spark, request):
    """Rows 0, 3, 6, ... share a code or have none; the others spread over 10,000 codes."""
    return spark.range(0, ROWS, 1, 8).selectExpr("id", f"if(id % 3 = 0, {request.param}, id % 10000) as code", "uuid() as load")


@pytest.fixture
def codes(spark):
    return spark.range(10_000).filter("id % 10 <> 9").selectExpr("cast(id as string) as code", "concat('n', id) as name")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_of_a_hot_code_is_split(shuffled_joins, hot, codes):
    out = lookup_codes(hot, [Lookup("code", codes, "code", "name", "name", unique=True)])
    assert re.search(r"SortMergeJoin\(skew=true\)", final_plan(out))
    wrong = out.filter("NOT (name <=> if(code % 10 = 9, null, concat('n', code)))")
    assert wrong.count() == 0 and out.count() == ROWS


def test_conforming_a_hot_code_is_split(shuffled_joins, hot, codes):
    out = conform_codes(hot.selectExpr("id", "cast(code as string) as code", "load"), "code", codes, "code", unique=True)
    assert re.search(r"SortMergeJoin\(skew=true\)", final_plan(out))
    assert out.count() == ROWS and out.filter("code IN ('0', '99')").count() >= ROWS // 3


def test_counts_of_a_hot_code_are_combined_before_the_shuffle(shuffled_joins, hot, codes):
    out = count_by(hot, ["code"], [Lookup("code", codes, "code", "name", "name", unique=True)])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.index("Join") < text.index("HashAggregate") < text.index("partial_count")
    got = {r.code: r.arrivals for r in out.collect()}
    assert sum(got.values()) == ROWS
    expected = {r["code"]: r["count"] for r in hot.groupBy("code").count().collect()}
    assert got == expected


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(0, ROWS, 1, 8).selectExpr("if(id % 3 = 0, 0, id) as v", "'x' as w")
    out = distinct_rows(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
    assert out.count() == ROWS - ROWS // 3 + 1


def test_small_results_match_with_and_without_broadcast(spark, hot, codes, shuffled_joins):
    lookups = [Lookup("code", codes, "code", "name", "name", unique=True)]
    shuffled = rows_of(lookup_codes(hot.filter("id < 2000").drop("load"), lookups))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    broadcast = lookup_codes(hot.filter("id < 2000").drop("load"), lookups)
    assert "BroadcastHashJoin" in final_plan(broadcast)
    assert rows_of(broadcast) == shuffled


def test_hot_codes_are_split_against_staged_lists(shuffled_joins, spark, hot, tmp_path):
    """Lists as the build has them: parsed from a text, and staged."""
    lines = "".join(f"\n{i}='n{i}'" for i in range(10_000) if i % 10 != 9)
    text = spark.createDataFrame([(f"value i94addrl{lines};",)], "value string")
    wanted = [c for c in CODE_LISTS if c.table == "state_codes"]
    write_table(parse_code_lists(text, wanted).coalesce(1), str(tmp_path / "lists"))
    staged = code_list_tables(read_table(spark, str(tmp_path / "lists")), wanted)["state_codes"]
    write_table(staged, str(tmp_path / "states"))
    states = read_table(spark, str(tmp_path / "states"))
    rows = hot.selectExpr("id", "cast(code as string) as code", "load")
    conformed = conform_codes(rows, "code", states, "state_code", unique=True)
    named = lookup_codes(rows, [Lookup("code", states, "state_code", "state_name", "name", unique=True)])
    for out in (conformed, named):
        assert re.search(r"SortMergeJoin\(skew=true\)", final_plan(out))
        assert out.count() == ROWS


def test_a_code_that_comes_twice_in_a_list_does_not_double_rows(hot, codes):
    rows = hot.selectExpr("id", "cast(code as string) as code").filter("id < 100")
    assert conform_codes(rows, "code", codes.unionAll(codes), "code").count() == 100


@pytest.fixture
def aggregated(codes):
    """A list straight from an aggregate, which Spark cannot join a split partition to."""
    return codes.unionAll(codes).groupBy("code").agg({"name": "max"}).withColumnRenamed("max(name)", "name")


def rows_by_task(df):
    """Rows of each of the join's tasks."""
    counts = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"), F.count("name")).collect()
    return sorted(r["rows"] for r in counts)


@pytest.mark.parametrize("spread", [False, True])
def test_hot_codes_against_a_list_from_an_aggregate(shuffled_joins, spark, hot, aggregated, spread):
    rows = hot.selectExpr("id", "cast(code as string) as code", "load")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        if spread:
            out = spread_join(rows, rows.code, aggregated.withColumnRenamed("code", "listed"), "listed")
        else:
            out = rows.join(aggregated.withColumnRenamed("code", "listed"), F.col("code") == F.col("listed"), "left")
        by_task = rows_by_task(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(by_task) == ROWS
    if spread:
        assert by_task[-1] <= 2 * by_task[len(by_task) // 2]
    else:
        assert by_task[-1] >= ROWS // 3  # what the slices are for


def test_spread_lookups_give_the_same_rows(shuffled_joins, hot, aggregated, codes):
    rows = hot.selectExpr("id", "cast(code as string) as code").filter("id < 30000")
    lookups = [Lookup("code", aggregated, "code", "name", "name")]
    plain = lookup_codes(rows, lookups)
    spread = lookup_codes(rows, lookups, spread=True)
    assert spread.columns == plain.columns and spread.exceptAll(plain).isEmpty() and spread.count() == 30000
    doubled = codes.unionAll(codes.selectExpr("code", "concat('m', code)"))
    named = lookup_codes(rows, [Lookup("code", doubled, "code", "name", "name")], spread=True)
    assert named.exceptAll(plain).isEmpty() and named.count() == 30000
    conformed = conform_codes(rows, "code", aggregated, "code", spread=True)
    assert conformed.exceptAll(conform_codes(rows, "code", aggregated, "code")).isEmpty()


def test_only_hot_codes_are_cut(spark, hot):
    assert set(hot_codes(hot, hot.code, 8)) in ({"0"}, {None})
    assert hot_codes(spark.range(1000), F.col("id"), 8) == {} == hot_codes(spark.range(0), F.col("id"), 8)
    empty = spread_join(spark.range(0), F.col("id"), spark.range(5).withColumnRenamed("id", "key"), "key")
    assert empty.columns == ["id", "key"] and empty.count() == 0


def test_a_doubled_list_does_not_double_rows(spark, hot, codes):
    rows = hot.selectExpr("id", "cast(code as string) as code").filter("id < 100")
    named = lookup_codes(rows, [Lookup("code", codes.unionAll(codes), "code", "name", "name")])
    assert named.count() == 100
