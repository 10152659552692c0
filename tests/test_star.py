"""Star questions on rows small enough to count by hand."""

import datetime

import pytest
from helpers import DICTIONARY, arrivals, rows_of

from starmart.operators.labels import build_code_lists
from starmart.plans import star
from starmart.plans.arrivals import clean_arrivals, clean_demographic
from starmart.schemas import DEMOGRAPHIC_SCHEMA

D = datetime.date


@pytest.fixture(scope="module")
def fact(spark):
    return clean_arrivals(
        arrivals(
            spark,
            {"i94res": 108.0},
            {"i94res": 108.0, "depdate": 20575.0},
            {"i94res": 209.0, "i94addr": "AL", "depdate": None, "i94mon": 5.0},
            {"i94res": None, "i94addr": None, "arrdate": None, "i94visa": 7.0},
        )
    ).cache()


@pytest.fixture(scope="module")
def tables(spark):
    return build_code_lists(spark.createDataFrame([(DICTIONARY,)], "value string"))


def test_arrivals_by_names(fact, tables):
    by_residence = star.arrivals_by(fact, tables, ["residence"])
    assert set(map(tuple, by_residence.collect())) == {(108, 2, "DENMARK"), (209, 1, "JAPAN"), (999, 1, None)}
    by_visa = star.arrivals_by(fact, tables, ["i94visa", "mode"])
    assert set(map(tuple, by_visa.collect())) == {(2, 1, 3, "Air", "Pleasure"), (7, 1, 1, "Air", None)}
    assert star.arrivals_by(fact, tables, ["month"]).columns == ["month", "arrivals"]


def test_population_is_not_counted_once_per_race(spark, fact):
    def city(name, state, total, race):
        return (name, state, 30.0, total // 2, total // 2, total, 1, 2, 2.5, state, race, 1)

    rows = [city("A", "CA", 100, "x"), city("A", "CA", 100, "y"), city("B", "CA", 50, "x"), city("A", "NY", 8, "x")]
    demographic = clean_demographic(spark.createDataFrame(rows, DEMOGRAPHIC_SCHEMA))
    out = star.arrivals_and_population(fact, demographic).select("state_code", "arrivals", "cities", "total_population")
    assert set(map(tuple, out.collect())) == {("CA", 2, 2, 150), ("AL", 1, None, None), ("", 1, None, None)}


def test_climate_meets_arrivals_on_the_month_of_the_year(spark, fact):
    temperature = spark.createDataFrame(
        [
            (D(2000, 4, 1), 6.0, "108"), (D(2001, 4, 1), 8.0, "108"), (D(2001, 7, 1), 20.0, "108"),
            (D(2001, 5, 1), 15.0, None),
        ],
        "date date, average_temperature double, country_code string",
    )
    out = star.arrivals_and_climate(fact, temperature)
    assert set(map(tuple, out.collect())) == {
        ("108", 4, 2, 7.0, 2), ("209", 5, 1, None, None), ("999", 4, 1, None, None),
    }


def test_stays_leave_out_the_stand_in_date_and_missing_arrivals(fact):
    assert rows_of(star.stay_length(fact)) == [(2, 1), (9, 1)]


def test_unmatched(fact, tables):
    got = set(map(tuple, star.unmatched(fact, tables).collect()))
    assert {("citizenship", "692", 4), ("residence", "999", 1), ("i94visa", "7", 1), ("state_code", "", 1)} <= got
    assert not [r for r in got if r[0] == "mode"]


def test_margins_count_the_fact_once(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.range(3000).selectExpr(
        "cast(id % 3 as int) as residence", "cast(id % 2 as int) as mode", "cast(null as string) as port", "1 as i94visa",
        "concat('S', id % 5) as state_code", "id as cicid",
    )
    rows.write.parquet(path)
    fact = spark.read.parquet(path)
    lists = {
        "country_codes": spark.createDataFrame([("0", "ZERO")], "country_code string, country_name string"),
        **{
            f"{n}_codes": spark.createDataFrame([], f"{n}_code string, {m} string")
            for n, m in (("port", "port_name"), ("mode", "mode_name"), ("state", "state_name"), ("visa", "visa_category"))
        },
    }
    keys = ["residence", "mode", "port", "state_code"]
    out = star.arrivals_margins(fact, lists, keys)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    # What is repeated for each grouping are the counts: the Expand stands above the first aggregation.
    assert plan.index("Expand") < plan.index("partial_count(1)")
    got = {(r.grouping, r.residence, r["mode"], r.port, r.state_code): r.arrivals for r in out.collect()}
    assert got[15, None, None, None, None] == 3000 and got[13, None, None, None, None] == 3000  # all; and by port, all NULL
    assert [got[7, n, None, None, None] for n in range(3)] == [1000] * 3
    assert got[14, None, None, None, "S4"] == 600 and len(got) == 3 + 2 + 1 + 5 + 1
    pairs = star.arrivals_margins(fact, lists, keys, [["residence", "mode"], ["port"]])
    assert pairs.count() == 7


def test_sketches_of_months_add_up(spark):
    """Quantiles over a year from twelve months' sketches, against all lengths; a third of the rows have one length."""
    days = "if(id % 3 = 0, 14, cast(pow(id % 997, 2) / 900 as int))"
    fact = spark.range(200_000).selectExpr(
        "cast(id % 2 as int) as residence", "2016 as year", "cast(id % 12 + 1 as int) as month",
        "DATE'2016-01-01' as arrival_date", f"date_add(DATE'2016-01-01', {days}) as departure_date",
    )
    sketches = star.stay_sketches(fact)
    assert sketches.count() == 12  # a month has one parity
    assert sketches.selectExpr("max(length(sketch))").first()[0] < 10_000
    at = [0.05, 0.25, 0.5, 0.75, 0.95]
    exact = {}
    for r in fact.selectExpr("residence", "date_diff(departure_date, arrival_date) as days").collect():
        exact.setdefault(r.residence, []).append(r.days)
    for row in star.stay_quantiles(sketches, at=at).collect():
        lengths = exact[row.residence]
        assert row.stays == len(lengths)
        for rank, found in zip(at, row.days, strict=True):
            below, upto = sum(d < found for d in lengths), sum(d <= found for d in lengths)
            error = 2 * star.SKETCH_ERROR
            assert below / len(lengths) - error <= rank <= upto / len(lengths) + error
    odd = fact.limit(2).selectExpr("residence", "year", "month", "arrival_date", "DATE'1960-01-01' as departure_date")
    assert star.stay_sketches(odd).count() == 0
