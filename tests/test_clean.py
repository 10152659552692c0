import datetime
import logging
import math

import pytest
from helpers import arrivals, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmart.functions import sas_days_to_date, strip, text_to_date
from starmart.operators import clean
from starmart.plans.arrivals import clean_arrivals, clean_demographic, clean_temperature
from starmart.schemas import DEMOGRAPHIC_SCHEMA, TEMPERATURE_SCHEMA

D = datetime.date


def test_fill_skips_and_names_a_default_of_another_type(spark, caplog):
    df = spark.createDataFrame([(None, None), ("CA", 1.5)], "state string, age double")
    with caplog.at_level(logging.WARNING):
        out = clean.fill_defaults(df, {"state": 99, "age": 0})
    assert set(map(tuple, out.collect())) == {("CA", 1.5), (None, 0.0)}
    assert "state" in caplog.text


def test_fill_replaces_nan(spark):
    df = spark.createDataFrame([(math.nan,)], "x double")
    assert clean.fill_defaults(df, {"x": 7}).first()[0] == 7.0


def test_fill_with_only_mismatches_changes_nothing(spark):
    df = spark.createDataFrame([(None,)], "state string")
    assert clean.fill_defaults(df, {"state": 99}).first()[0] is None


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (2.7, 2), (-2.7, -2), (None, None), (math.nan, None), (math.inf, None),
        (2147483647.9, 2147483647), (2147483648.0, None), (-2147483648.9, -2147483648),
        (-2147483649.0, None),
    ],
)
def test_cast_cuts_and_never_fails(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert clean.cast_columns(df, {"x": "int"}).first()[0] == expected


def test_lenient_cast_equals_try_cast(spark):
    values = [0.0, -0.0, 1.5, -1.5, 2**31 - 0.5, 2**31 + 0.5, -(2**31) - 0.5, -(2**31) - 1.5, math.nan, -math.inf]
    df = spark.createDataFrame([(v, v) for v in values], "x double, y double")
    out = clean.cast_columns(df, {"x": "int"}).withColumn("y", F.col("y").try_cast("int"))
    assert all(r.x == r.y for r in out.collect())


def test_strict_cast_fails_on_overflow(spark):
    df = spark.createDataFrame([(1e12,)], "x double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        clean.cast_columns(df, {"x": "int"}, strict=True).collect()


def test_fill_and_cast(spark):
    df = spark.createDataFrame([(None, 3.9), (2.0, None)], "`Male Population` double, b double")
    out = clean.fill_and_cast(df, ["Male Population", "b"])
    assert rows_of(out) == [(0, 3), (2, 0)]
    assert [t for _, t in out.dtypes] == ["int", "int"]


def test_rename_ignores_missing_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.rename_columns(df, {"a": "x", "nope": "y"}).columns == ["x", "b"]


def test_drop_incomplete_looks_at_its_columns_only(spark):
    rows = [(1, 1.0, None), (2, None, "x"), (3, math.nan, "x"), (None, 1.0, "x")]
    df = spark.createDataFrame(rows, "`a b` int, x double, note string")
    assert rows_of(clean.drop_incomplete(df, ["a b", "x"])) == [(1, 1.0, None)]


def test_drop_incomplete_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "cast(id as double) as x").write.parquet(path)
    df = clean.drop_incomplete(spark.read.parquet(path), ["id", "x"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), IsNotNull(x)" in plan


def test_select_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, `b.c` int, d int")
    assert clean.select_columns(df, ["d", "b.c"]).columns == ["d", "b.c"]


@pytest.mark.parametrize(
    ("days", "expected"),
    [
        (0.0, D(1960, 1, 1)), (20573.0, D(2016, 4, 29)), (20573.9, D(2016, 4, 29)),
        (-1.5, D(1959, 12, 31)), (-0.5, D(1960, 1, 1)), (2936549.0, D(9999, 12, 31)),
        (2936549.9, D(9999, 12, 31)), (2936550.0, None), (-715509.0, D(1, 1, 1)),
        (-715509.9, D(1, 1, 1)), (-715510.0, None), (1e12, None), (math.nan, None),
        (math.inf, None), (None, None),
    ],
)
def test_sas_days(spark, days, expected):
    df = spark.createDataFrame([(days,)], "d double")
    assert df.select(sas_days_to_date(F.col("d"))).first()[0] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 4e6) | st.floats(), min_size=1, max_size=200))
def test_sas_days_like_calendar_arithmetic(spark, days):
    def by_calendar(x):
        try:
            return D(1960, 1, 1) + datetime.timedelta(days=math.trunc(x))
        except (OverflowError, ValueError):
            return None

    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d double")
    got = dict(df.select("i", sas_days_to_date(F.col("d"))).collect())
    assert got == {i: by_calendar(d) for i, d in enumerate(days)}


@pytest.mark.parametrize(
    ("text", "pattern", "expected"),
    [
        ("20160429", "yyyyMMdd", D(2016, 4, 29)), ("10282016", "MMddyyyy", D(2016, 10, 28)),
        ("", "yyyyMMdd", None), ("D/S", "MMddyyyy", None), ("20160431", "yyyyMMdd", None),
        ("00000000", "yyyyMMdd", None), ("20160422x", "yyyyMMdd", None), ("1022016", "MMddyyyy", None),
        (" 0160429", "yyyyMMdd", None), ("20160429\n", "yyyyMMdd", None), ("00000101", "yyyyMMdd", None),
        ("2016 429", "yyyyMMdd", None), ("+2160429", "yyyyMMdd", None), ("29042016", "ddMMyyyy", D(2016, 4, 29)),
        ("20160229", "yyyyMMdd", D(2016, 2, 29)), ("20150229", "yyyyMMdd", None), ("00010101", "yyyyMMdd", D(1, 1, 1)),
        (None, "yyyyMMdd", None), ("2016-04-29", "yyyy-MM-dd", D(2016, 4, 29)),
    ],
)
def test_text_to_date(spark, text, pattern, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_to_date(F.col("t"), pattern)).first()[0] == expected


def test_eight_digits_like_try_to_date(spark):
    """All texts of month and day digits, valid or not, and some that only look like digits."""
    texts = [f"2016{m:02}{d:02}" for m in range(0, 15) for d in range(0, 34)] + ["2016١٢٢٤", "0x160101", "1e100101"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(text_to_date(F.col("t"), "yyyyMMdd").alias("a"), F.try_to_date("t", "yyyyMMdd").alias("b"))
    assert out.filter("NOT (a <=> b)").collect() == []
    assert out.filter("a IS NOT NULL").count() == 366


@pytest.mark.parametrize("blank", [" ", "\t", "\r", "\n", "\xa0", " ", "\x1c", "　", "\x85"])
def test_strip_takes_any_white_space(spark, blank):
    df = spark.createDataFrame([(f"{blank}{blank}a{blank}b{blank}",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == f"a{blank}b"


def test_complete_arrival(spark):
    row = clean_arrivals(arrivals(spark, {})).first()
    assert (row.arrival_date, row.departure_date) == (D(2016, 4, 29), D(2016, 5, 8))
    assert (row.dtadfile, row.dtaddto, row.state_code) == (D(2016, 4, 29), D(2016, 10, 28), "CA")
    assert (row.cicid, row.year, row.month, row.mode, row.age, row.birth_year) == (6, 2016, 4, 1, 37, 1979)


def test_arrival_columns_keep_their_order_and_types(spark):
    out = clean_arrivals(arrivals(spark, {}))
    # Final column names in order.
    assert out.columns == [
        "cicid", "year", "month", "citizenship", "residence", "port", "arrival_date", "mode",
        "state_code", "departure_date", "age", "i94visa", "count", "dtadfile", "visapost", "occup",
        "entdepa", "entdepd", "entdepu", "matflag", "birth_year", "dtaddto", "gender", "insnum",
        "airline", "admnum", "fltno", "visa_type",
    ]
    types = dict(out.dtypes)
    assert {types[c] for c in ("arrival_date", "departure_date", "dtadfile", "dtaddto")} == {"date"}
    assert types["admnum"] == "double" and types["count"] == "int"


def test_missing_values_of_an_arrival(spark):
    missing = dict.fromkeys(
        "depdate i94bir biryear i94mode i94cit i94res i94addr dtadfile dtaddto visapost occup entdepa "
        "entdepd entdepu matflag gender insnum airline fltno".split()
    )
    row = clean_arrivals(arrivals(spark, missing)).first()
    assert row.departure_date == D(1960, 1, 1)
    assert (row.age, row.birth_year, row.mode, row.citizenship, row.residence) == (0, 0, 9, 999, 999)
    assert (row.dtadfile, row.dtaddto) == (None, None)
    assert [row[c] for c in ("state_code", "visapost", "occup", "gender", "airline", "fltno")] == [""] * 6


def test_values_without_a_default_stay_missing(spark):
    # Source names.
    names = "cicid i94yr i94mon i94port arrdate i94visa count admnum visatype".split()
    row = clean_arrivals(arrivals(spark, dict.fromkeys(names))).first()
    # Final names of the source columns above.
    finals = "cicid year month port arrival_date i94visa count admnum visa_type".split()
    assert [row[c] for c in finals] == [None] * 9


def test_bad_dates_of_an_arrival(spark):
    row = clean_arrivals(arrivals(spark, {"dtaddto": "D/S", "dtadfile": "20160431"})).first()
    assert (row.dtaddto, row.dtadfile) == (None, None)


def test_copied_arrivals_are_kept(spark):
    assert clean_arrivals(arrivals(spark, {}, {})).count() == 2


def test_named_departures_from_the_defaults(spark):
    out = clean_arrivals(arrivals(spark, {"depdate": None}), missing_departure="null", rename_visa=True)
    assert out.first().departure_date is None
    assert "visa_code" in out.columns and "i94visa" not in out.columns
    with pytest.raises(ValueError):
        clean_arrivals(arrivals(spark, {}), missing_departure="zero")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        clean_arrivals(arrivals(spark, {"cicid": 1e12}), strict=True).collect()
    assert clean_arrivals(arrivals(spark, {"cicid": 1e12})).first().cicid is None


def test_demographic(spark):
    full = ("Hilo", "Hawaii", 40.0, 10, 11, 21, 1, 2, 2.5, "HI", "Asian", 5)
    rows = [full, full, full[:10] + ("White", 6), full[:2] + (None,) + full[3:]]
    for i in (3, 4, 6, 7, 8):
        rows.append(full[:i] + (None,) + full[i + 1 :])
    out = clean_demographic(spark.createDataFrame(rows, DEMOGRAPHIC_SCHEMA))
    # Final column names in order.
    assert out.columns == [
        "city", "state_name", "median_age", "male_population", "female_population", "total_population",
        "number_of_veterans", "foreign_born", "average_household_size", "state_code", "race", "count", "id",
    ]
    kept = out.collect()
    assert len(kept) == 3
    assert len({r.id for r in kept}) == 3 and all(r.id >= 0 for r in kept)
    assert sum(r.median_age is None for r in kept) == 1


def test_temperature(spark):
    full = (D(2000, 1, 1), 3.5, 0.5, "Aarhus", "Denmark", "57.05N", "10.33E")
    rows = [full, full, full[:1] + (None,) + full[2:], full[:2] + (None,) + full[3:], full[:4] + (None,) + full[5:]]
    out = clean_temperature(spark.createDataFrame(rows, TEMPERATURE_SCHEMA))
    # Final column names in order.
    assert out.columns == [
        "date", "average_temperature", "average_temperature_uncertainty", "city", "country", "latitude",
        "longitude", "temp_id",
    ]
    assert out.count() == 2
