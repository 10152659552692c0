import datetime

import pytest
from helpers import rows_of

from starmart.operators import profile


@pytest.fixture
def df(spark):
    rows = [("HI", 1, None), ("HI", None, None), ("CA", 3, 2.5), (None, 4, 1.5)]
    return spark.createDataFrame(rows, "State string, `Median Age` int, x double")


def test_null_and_non_null_profiles(df):
    assert dict(profile.null_profile(df).collect()) == {"State": 1, "Median Age": 1, "x": 2}
    assert dict(profile.non_null_profile(df).collect()) == {"State": 3, "Median Age": 3, "x": 2}
    assert dict(profile.null_profile(df, ["x"]).collect()) == {"x": 2}


def test_group_counts_leave_out_rows_without_a_key(df):
    assert rows_of(profile.group_non_null_counts(df, "State")) == [("CA", 1, 1), ("HI", 1, 0)]
    with_null = profile.group_non_null_counts(df, "State", ["x"], keep_null_key=True)
    assert set(map(tuple, with_null.collect())) == {("CA", 1), ("HI", 0), (None, 1)}


def test_value_range(spark):
    days = [datetime.date(2013, 9, 1), datetime.date(1743, 11, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "date date")
    assert tuple(profile.value_range(df, "date").first()) == (days[1], days[0])


def test_where_equals_and_first_rows(df):
    assert profile.where_equals(df, "State", "HI").count() == 2
    assert [r.x for r in profile.first_rows(df, 2, ["State", "`Median Age`"]).collect()] == [1.5, 2.5]
    assert profile.first_rows(df, 3).count() == 3


def test_row_count(df):
    assert profile.row_count(df).first()[0] == 4


def test_schema_profile(df):
    assert [tuple(r) for r in profile.schema_profile(df).collect()] == [
        (0, "State", "string", True, 3),
        (1, "Median Age", "int", True, 3),
        (2, "x", "double", True, 2),
    ]


def test_profiles_read_once(df, tmp_path):
    path = str(tmp_path / "t")
    df.write.parquet(path)
    again = df.sparkSession.read.parquet(path)
    for report in (
        profile.null_profile(again),
        profile.non_null_profile(again),
        profile.schema_profile(again),
        profile.value_range(again, "x"),
    ):
        assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_footers_answer_without_reading_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr(
        "id", "cast(if(id % 4 = 0, null, id % 7) as int) as n", "date_add(DATE'2000-01-01', cast(id as int)) as d",
        "cast(id as string) as s", "if(id = 5, double('NaN'), id / 2) as x",
    )
    rows.repartition(3).write.parquet(path)
    found = profile.footer_profile(spark, path, ["id", "n", "d"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MIN(n), MIN(d), MAX(id), MAX(n), MAX(d)]" in plan
    assert rows_of(found) == [("d", 1000, "2000-01-01", "2002-09-26"), ("id", 1000, "0", "999"), ("n", 1000, "0", "6")]
    both = profile.footer_profile(spark, path, ["id", "s", "x"])
    assert rows_of(both) == [("id", 1000, "0", "999"), ("s", 1000, "0", "999"), ("x", 1000, "0.0", "NaN")]
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan and "PushedAggregation: []" in plan
    # The caller's own reads go on as they did.
    assert "PushedAggregation" not in spark.read.parquet(path).agg({"id": "max"})._jdf.queryExecution().executedPlan().toString()
