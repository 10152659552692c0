import pytest
from helpers import rows_of

from starmart.operators.lookup import Lookup
from starmart.operators.quality import (
    Integrity,
    QualityError,
    Rules,
    check_nulls,
    check_row_count,
    duplicate_keys,
    enforce,
    integrity_report,
    quality_report,
    stage_counts,
    table_report,
)
from starmart.schemas import NOT_NULL


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "a", None), (2, None, None), (None, "c", 3)], "id int, name string, count int")


def test_report_lists_every_check(spark, people):
    report = table_report("people", people, Rules(["id", "count"]))
    assert report.columns == ["table", "check", "column", "observed", "severity", "passed"]
    assert {tuple(r) for r in report.collect()} == {
        ("people", "row_count", None, 3, "error", True),
        ("people", "null_count", "id", 1, "error", False),
        ("people", "null_count", "count", 2, "error", False),
    }


def test_gate_names_all_failures(spark, people):
    rules = {"people": Rules(["id", "name"]), "empty": Rules(), "ignored": Rules(["id"])}
    report = quality_report({"people": people, "empty": people.limit(0), "no_rules": people}, rules)
    with pytest.raises(QualityError) as failure:
        enforce(report)
    assert isinstance(failure.value, ValueError)
    assert {(f["table"], f["column"]) for f in failure.value.failures} == {
        ("people", "id"), ("people", "name"), ("empty", None),
    }
    for text in ("people.id null_count = 1", "people.name null_count = 1", "empty.* row_count = 0"):
        assert text in str(failure.value)


def test_warnings_do_not_stop(spark, people):
    rows = enforce(quality_report({"people": people}, {"people": Rules(["id"], severity="warn")}))
    assert [r["passed"] for r in rows] == [True, False]


def test_row_count_fails_on_the_forbidden_count_only(spark, people):
    assert check_row_count("people", people) == 3
    with pytest.raises(ValueError, match="row_count = 3"):
        check_row_count("people", people, forbidden_rows=3)
    with pytest.raises(ValueError, match="row_count = 0"):
        check_row_count("people", people.limit(0))


def test_null_check(spark, people):
    check_nulls("people", people.limit(0), ["id"])
    check_nulls("people", people.filter("id = 1"), ["id", "name"])
    with pytest.raises(ValueError, match="people.count null_count = 2"):
        check_nulls("people", people, ["count"])


def test_one_scan_reads_only_the_checked_columns(spark, people, tmp_path):
    path = str(tmp_path / "people")
    people.write.parquet(path)
    report = table_report("people", spark.read.parquet(path), Rules(["id", "count"]))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<id:int,count:int>" in plan


def test_rules_of_the_star():
    assert sum(len(columns) for columns in NOT_NULL.values()) == 16
    assert NOT_NULL["temperature"] == ("temp_id", "country_code")


def test_stage_counts(spark, people):
    out = stage_counts({"read": people, "cleaned": people.dropna(subset=["name"])})
    assert rows_of(out) == [("cleaned", 2), ("read", 3)]


def test_duplicate_keys_are_counted_exactly(spark):
    rows = [(1, "a"), (1, "b"), (1, "a"), (2, None), (2, None), (None, "a"), ("1", None)]
    df = spark.createDataFrame([(None if a is None else str(a), b) for a, b in rows], "a string, b string")
    assert duplicate_keys(df, ["a", "b"]).first()[0] == 2
    assert duplicate_keys(df, ["a"]).first()[0] == 4
    assert duplicate_keys(df.limit(0), ["a"]).first()[0] == 0


def test_keys_that_share_a_hash_are_not_taken_for_one(spark):
    # Spark's hash passes over NULLs, so these two have the same one.
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    assert df.selectExpr("xxhash64(a, b) as h").distinct().count() == 1
    assert duplicate_keys(df, ["a", "b"]).first()[0] == 0


def test_integrity_shuffles_numbers_not_rows(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(1000).selectExpr("id", "repeat('x', 100) as load", "id % 7 as code").write.parquet(path)
    df = spark.read.parquet(path)
    codes = spark.createDataFrame([(n, "n") for n in range(5)], "code long, name string")
    rules = {"wide": Integrity([("id",)], [Lookup("code", codes, "code", "name", "name")])}
    report = integrity_report({"wide": df}, rules)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "load" not in plan and "NestedLoop" not in plan
    assert rows_of(report.select("check", "column", "observed", "passed")) == [
        ("duplicate_count", "id", 0, True), ("unmatched_count", "code", 285, False),
    ]
    assert len(enforce(report)) == 2  # a lost reference is a warning
    with pytest.raises(QualityError, match="wide.code duplicate_count = 993"):
        enforce(integrity_report({"wide": df}, {"wide": Integrity([("code",)])}))
