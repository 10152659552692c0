import datetime
from types import SimpleNamespace

import pytest
from helpers import arrivals, rows_of

from starmart import session
from starmart.operators.labels import visa_codes
from starmart.schemas import ARRIVALS_SCHEMA, DEMOGRAPHIC_SCHEMA, TEMPERATURE_SCHEMA
from starmart.sources import (
    literal_table,
    read_delimited,
    read_fact,
    read_table,
    refresh_partitions,
    register_views,
    write_table,
)


def test_demographic_file(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text(
        "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;"
        "Foreign-born;Average Household Size;State Code;Race;Count\n"
        "Oneham;Firstland;30.5;1000;1100;2100;50;300;2.5;FL;Group A;900\n"
        "Twoham;Secondland;40.0;;1200;2200;60;400;2.25;SL;Group B;800\n"
    )
    df = read_delimited(spark, str(path), ";", DEMOGRAPHIC_SCHEMA)
    assert df.schema == DEMOGRAPHIC_SCHEMA
    assert [r["Male Population"] for r in df.collect()] == [1000, None]
    inferred = read_delimited(spark, str(path), ";")
    assert dict(inferred.dtypes)["Total Population"] == "int"
    assert rows_of(inferred) == rows_of(df)


def test_temperature_file(spark, tmp_path):
    path = tmp_path / "temperature.csv"
    path.write_text(
        "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
        "1743-11-01,6.068,1.7369999999999999,Arhus,Denmark,57.05N,10.33E\n"
        "1743-12-01,,,Arhus,Denmark,57.05N,10.33E\n"
    )
    df = read_delimited(spark, str(path), ",", TEMPERATURE_SCHEMA)
    first, second = df.collect()
    assert first.dt == datetime.date(1743, 11, 1) and first.AverageTemperature == 6.068
    assert second.AverageTemperature is None
    assert dict(read_delimited(spark, str(path)).dtypes)["dt"] == "date"


def test_swapped_columns_fail(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(path), ",", "a int, b int").collect()


def test_fact_in_any_format(spark, tmp_path):
    df = arrivals(spark, {}, {"i94addr": None})
    df.write.parquet(str(tmp_path / "p"))
    df.write.orc(str(tmp_path / "o"))
    df.write.csv(str(tmp_path / "c"), header=True, sep="|")
    expected = rows_of(df)
    assert rows_of(read_fact(spark, str(tmp_path / "p"))) == expected
    assert rows_of(read_fact(spark, str(tmp_path / "o"), "orc")) == expected
    text = read_fact(spark, str(tmp_path / "c"), "csv", header="true", sep="|")
    assert rows_of(text.drop("_malformed")) == expected and text.filter("size(_malformed) > 0").isEmpty()
    assert read_fact(spark, str(tmp_path / "o"), "orc", None).schema == ARRIVALS_SCHEMA


def test_literal_table_has_a_known_size(spark):
    df = visa_codes(spark)
    assert rows_of(df) == [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]
    joined = spark.range(10).selectExpr("cast(id as string) as visa_code").join(df, "visa_code", "left")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        literal_table(spark, [(1,)], ["a", "b"])


def test_refresh_replaces_only_the_months_it_brings(spark, tmp_path):
    path = str(tmp_path / "fact")
    months = spark.createDataFrame(
        [(2016, 3, "old"), (2016, 4, "old"), (2016, 4, "old too"), (2017, 4, "old")], "year int, month int, v string"
    )
    refresh_partitions(months, path)
    refresh_partitions(spark.createDataFrame([(2016, 4, "new")], months.schema), path, rebalance=True)
    got = read_table(spark, path)
    assert rows_of(got.select("year", "month", "v")) == [
        (2016, 3, "old"), (2016, 4, "new"), (2017, 4, "old"),
    ]
    plan = got.filter("year = 2016 and month = 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_overwrite_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path, max_records_per_file=1)
    assert read_table(spark, path).count() == 3


def test_rebalance_splits_a_month_too_large_for_one_task(spark, tmp_path):
    """One month holds almost all rows; it still is written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        path = str(tmp_path / "fact")
        df = spark.range(200_000).selectExpr("2016 as year", "if(id % 10 = 0, 3, 4) as month", "uuid() as v")
        write_table(df, path, partition_by=["year", "month"], rebalance=True)
        files = read_table(spark, path).selectExpr("month", "input_file_name() as f").distinct()
        assert dict(files.groupBy("month").count().collect())[4] > 4
        assert read_table(spark, path).count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_views(spark):
    register_views({"visa": visa_codes(spark)}, prefix="t_")
    assert spark.sql("SELECT COUNT(*) FROM t_visa WHERE visa_code IS NULL").first()[0] == 0


def test_shared_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class FakeSession:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-1")
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_only_local_sessions_make_a_folder():
    assert session.shared_folder(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_shuffle_partitions_follow_the_size():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(10 * 2**40) == 81920
