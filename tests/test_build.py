import datetime
import re
from dataclasses import replace
from pathlib import Path

import pytest
from helpers import DICTIONARY, arrivals, rows_of

from starmart.operators.quality import QualityError
from starmart.plans import build, star
from starmart.plans.build import StarConfig, build_star, main, read_star
from starmart.sources import PublishConflictError, read_manifest, read_published

CITIES = (
    "City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;"
    "Foreign-born;Average Household Size;State Code;Race;Count\n"
    "Fresno;California;30.0;100;110;210;5;20;3.0;CA;White;120\n"
    "Fresno;California;30.0;100;110;210;5;20;3.0;CA;Asian;40\n"
    "Fresno;California;30.0;100;110;210;5;20;3.0;CA;Asian;40\n"
    "Mobile;Alabama;38.0;;100;190;7;3;2.4;AL;White;90\n"
)
READINGS = (
    "dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n"
    "2000-04-01,6.0,0.5,Aarhus,Denmark,57.05N,10.33E\n"
    "2000-04-01,6.0,0.5,Aarhus,Denmark,57.05N,10.33E\n"
    "2001-04-01,8.0,0.5,Aarhus,Denmark,57.05N,10.33E\n"
    "2001-04-01,,,Aarhus,Denmark,57.05N,10.33E\n"
    "2001-04-01,14.0,0.5,Tokyo,Japan,36.17N,139.23E\n"
)
TABLES = (
    "country_codes", "port_codes", "mode_codes", "state_codes", "visa_codes", "immigration",
    "demographic", "temperature",
)


@pytest.fixture
def inputs(spark, tmp_path):
    def make(changes=({}, {"i94addr": None}, {"i94mon": 3.0}), readings=READINGS, **options):
        (tmp_path / "labels.sas").write_text(DICTIONARY)
        (tmp_path / "cities.csv").write_text(CITIES)
        (tmp_path / "readings.csv").write_text(readings)
        arrivals(spark, *changes).write.mode("overwrite").parquet(str(tmp_path / "arrivals"))
        return StarConfig(
            labels=str(tmp_path / "labels.sas"),
            arrivals=str(tmp_path / "arrivals"),
            demographic=str(tmp_path / "cities.csv"),
            temperature=str(tmp_path / "readings.csv"),
            output=str(tmp_path / "output"),
            **options,
        )

    return make


def test_all_tables_are_published(spark, inputs):
    config = inputs()
    result = build_star(spark, config)
    assert published(config) == set(read_manifest(spark, config.output).tables) == set(TABLES)
    counts = {name: df.count() for name, df in read_star(spark, config.output).items()}
    assert counts == {
        "country_codes": 6, "port_codes": 3, "mode_codes": 3, "state_codes": 4, "visa_codes": 3,
        "immigration": 3, "demographic": 2, "temperature": 3,
    }
    assert result.counts["demographic.read"] == 4
    assert result.counts["temperature.read"] == 5
    assert result.counts["immigration.read"] == 3
    assert {k.removesuffix(".checked"): v for k, v in result.counts.items() if k.endswith("checked")} == counts
    assert len(result.report) == 8 + 16 + 8 + 3 + 3 and all(r["passed"] for r in result.report)
    assert spark.sql("SELECT COUNT(*) FROM immigration WHERE departure_date = DATE'2016-05-08'").first()[0] == 3


def test_nothing_is_published_when_a_check_fails(spark, inputs):
    config = inputs(
        changes=({"i94yr": None}, {"cicid": 1e12}),
        readings=READINGS + "2001-04-01,20.0,0.5,Acapulco,Mexico,16.87N,100.08W\n",
    )
    with pytest.raises(QualityError) as failure:
        build_star(spark, config)
    assert {(f["table"], f["column"]) for f in failure.value.failures} == {
        ("immigration", "cicid"), ("immigration", "year"), ("temperature", "country_code"),
    }
    assert published(config) == set()


def published(config):
    """Tables that have any folder of a run."""
    return {p.parent.name for p in (Path(config.output) / "_data").glob("*/published_run=*")}


def staged(config):
    return list((Path(config.output) / "_stage").iterdir())


def test_a_value_that_cannot_be_read_fails_the_gate(spark, inputs):
    config = inputs(readings=READINGS + "2002-04-01,n/a,0.5,Aarhus,Denmark,57.05N,10.33E\n")
    with pytest.raises(QualityError, match=r"temperature\.average_temperature malformed_count = 1"):
        build_star(spark, config)
    assert published(config) == set() and staged(config) == []
    result = build_star(spark, replace(config, warn_only=("temperature",)))
    kept = result.tables["temperature"].filter("date = DATE'2002-04-01'").first()
    assert kept.average_temperature is None and "_malformed" not in result.tables["temperature"].columns


def test_large_and_fractional_whole_numbers_are_kept(spark, inputs, tmp_path):
    config = inputs()
    (tmp_path / "cities.csv").write_text(
        CITIES.splitlines()[0] + "\nA;B;30.0;100.0;1e2;3000000000;5;20;3.0;CA;White;1\nA;B;30.0;;1;2;5;20;3.0;CA;White;1\n"
    )
    only = build_star(spark, config).tables["demographic"].collect()
    assert [(r.male_population, r.female_population, r.total_population) for r in only] == [(100, 100, 3_000_000_000)]
    inferred = build_star(spark, replace(config, infer_types=True)).tables["demographic"].first()
    assert (inferred.male_population, inferred.total_population) == (100.0, 3_000_000_000)


@pytest.mark.parametrize("table", ["temperature", "demographic"])
def test_all_rows_incomplete_is_a_warning_if_asked_for(spark, inputs, tmp_path, table):
    header, *_ = READINGS.splitlines()
    readings = f"{header}\n2000-04-01,,0.5,Aarhus,Denmark,57.05N,10.33E\n" if table == "temperature" else READINGS
    config = inputs(readings=readings, warn_only=(table,))
    if table == "demographic":
        (tmp_path / "cities.csv").write_text(CITIES.splitlines()[0] + "\n" + CITIES.splitlines()[-1] + "\n")
    result = build_star(spark, config)
    assert result.counts[f"{table}.read"] == 1 and result.counts[f"{table}.checked"] == 0
    assert read_published(spark, config.output, table).count() == 0


def content(spark, config):
    return {n: rows_of(df) for n, df in read_star(spark, config.output).items()}


@pytest.mark.parametrize("table", TABLES)
def test_a_failed_write_leaves_the_previous_set(spark, inputs, monkeypatch, table):
    config = inputs()
    build_star(spark, config)
    before, manifest = content(spark, config), read_manifest(spark, config.output)
    write = build.write_table

    def failing(df, path, **options):
        write(df, path, **options)
        if f"/_data/{table}/" in path:
            raise OSError("disk full")

    monkeypatch.setattr(build, "write_table", failing)
    config = inputs(changes=({"cicid": 99.0},))
    with pytest.raises(OSError, match="disk full"):
        build_star(spark, config)
    assert content(spark, config) == before
    assert read_manifest(spark, config.output) == manifest and staged(config) == []
    assert len(list((Path(config.output) / "_data").glob("*/*"))) == len(TABLES)  # nothing of the failed run is left


def test_two_builds_at_once_do_not_mix(spark, inputs, monkeypatch):
    config = inputs(monthly=True)
    build_star(spark, config)
    write = build.write_table
    once = []

    def overtaken(df, path, **options):
        write(df, path, **options)
        if "/_data/immigration/" in path and not once:
            once.append(path)
            build_star(spark, inputs(changes=({"cicid": 55.0},), monthly=True))

    monkeypatch.setattr(build, "write_table", overtaken)
    with pytest.raises(PublishConflictError):
        build_star(spark, inputs(changes=({"cicid": 44.0, "i94mon": 3.0},), monthly=True))
    fact = read_star(spark, config.output)["immigration"]
    assert rows_of(fact.select("month", "cicid")) == [(3, 6), (4, 55)]


def test_the_callers_session_stays_as_it_is(spark, inputs):
    before = dict(spark.conf.getAll)
    build_star(spark, inputs(monthly=True))
    assert dict(spark.conf.getAll) == before


def test_views_are_named_after_the_gate(spark, inputs):
    spark.catalog.dropTempView("immigration")
    with pytest.raises(QualityError):
        build_star(spark, inputs(changes=({"i94yr": None},)))
    assert not spark.catalog.tableExists("immigration")


def test_numbers_too_large_are_counted(spark, inputs):
    report = build_star(spark, inputs(changes=({"i94bir": 1e12}, {}))).report
    assert [(r["column"], r["observed"]) for r in report if not r["passed"]] == [("age", 1)]


def test_strict_stops_at_a_number_that_is_too_large(spark, inputs):
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        build_star(spark, inputs(changes=({"i94bir": 1e12},), strict=True))


def test_arrivals_as_text_are_found_by_name(spark, inputs):
    config = inputs()
    expected = rows_of(build_star(spark, config).tables["immigration"])
    raw, path = spark.read.parquet(config.arrivals), config.arrivals + "_other_order"
    raw.select("visatype", *raw.columns[:-1]).selectExpr("7 as row", "*").write.csv(path, header=True)
    text = replace(config, arrivals=path, arrivals_format="csv", arrivals_options={"header": "true"})
    assert rows_of(build_star(spark, text).tables["immigration"]) == expected
    raw.drop("cicid").write.csv(path + "_less", header=True)
    with pytest.raises(ValueError, match="missing in the header: cicid"):
        build_star(spark, replace(text, arrivals=path + "_less"))


def test_a_monthly_fact_is_shuffled_by_month_unless_told_otherwise(spark, inputs):
    many = tuple({"cicid": float(i), "i94mon": float(1 + i % 2)} for i in range(40))

    def files(config):
        folders = read_manifest(spark, config.output).tables["immigration"].folders
        return sum(len(list((Path(config.output) / f).glob("*.parquet"))) for f in folders)

    config = inputs(changes=many, monthly=True)
    spread = spark.read.parquet(config.arrivals).repartition(8)
    spread.write.parquet(config.arrivals + "_spread")
    config = replace(config, arrivals=config.arrivals + "_spread")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        build_star(spark, config)
        together = files(config)
        build_star(spark, replace(config, rebalance=False))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert together == 2 < files(config)


def test_shuffles_are_sized_by_the_scans_unless_the_session_is(spark, tmp_path, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    df = spark.range(10)
    monkeypatch.setattr(build, "shuffle_partitions", lambda size: 1000 + size)
    try:
        build._size_shuffles(spark, df)
        assert spark.conf.get(key) == before  # the session's own figure stays
        spark.conf.set(key, "200")
        build._size_shuffles(spark, df)
        assert int(spark.conf.get(key)) == 1080
        spark.conf.set(key, "200")
        spark.conf.set(build.EXPLICIT_SIZE, "1")
        build._size_shuffles(spark, df)
        assert spark.conf.get(key) == "200"
    finally:
        spark.conf.unset(build.EXPLICIT_SIZE)
        spark.conf.set(key, before)


def test_an_empty_table_fails(spark, inputs):
    config = inputs(readings=READINGS.splitlines()[0] + "\n")
    with pytest.raises(QualityError, match=r"temperature\.\* row_count = 0"):
        build_star(spark, config)


def test_unmatched_countries_may_be_a_warning(spark, inputs):
    config = inputs(
        readings=READINGS + "2001-04-01,20.0,0.5,Acapulco,Mexico,16.87N,100.08W\n", warn_only=("temperature",)
    )
    result = build_star(spark, config)
    mexico = result.tables["temperature"].filter("city = 'Acapulco'").first()
    assert (mexico.country_code, mexico.country_name) == (None, None)


def test_monthly_runs_keep_the_other_months(spark, inputs):
    config = inputs(monthly=True)
    build_star(spark, config)
    config = inputs(changes=({"cicid": 77.0},), monthly=True, rebalance=True)
    fact = build_star(spark, config).tables["immigration"]
    assert rows_of(fact.select("month", "cicid")) == [(3, 6), (4, 77)]
    assert dict(fact.dtypes)["year"] == "int"


def test_named_departures_from_the_defaults(spark, inputs):
    config = inputs(
        changes=({"i94addr": "ZZ", "depdate": None}, {}),
        missing_departure="null",
        rename_visa=True,
        conform_states=True,
    )
    fact = build_star(spark, config).tables["immigration"]
    assert rows_of(fact.select("state_code", "departure_date", "visa_code")) == [
        ("99", None, 2), ("CA", datetime.date(2016, 5, 8), 2),
    ]


def test_a_second_run_gives_the_same_rows(spark, inputs):
    config = inputs()
    first = {n: rows_of(df) for n, df in build_star(spark, config).tables.items()}
    second = {n: rows_of(df) for n, df in build_star(spark, config).tables.items()}
    assert first == second


def test_countries_that_the_list_writes_otherwise(spark, inputs):
    """A label with more words than the country's name gives its code, and so its climate."""
    config = inputs(
        changes=({"i94res": 582.0}, {"i94res": 108.0}),
        readings=READINGS + "2001-04-01,20.0,0.5,Acapulco,Mexico,16.87N,100.08W\n",
        similar_countries=1.0,
    )
    tables = build_star(spark, config).tables
    found = tables["temperature"].filter("city = 'Acapulco'").first()
    assert (found.country_code, found.country_name[:10]) == ("582", "MEXICO Air")
    climate = star.arrivals_and_climate(tables["immigration"], tables["temperature"])
    assert climate.filter("country_code = '582'").first().mean_temperature == 20.0


def test_keys_and_references_are_checked_on_request(spark, inputs):
    report = build_star(spark, inputs(changes=({"i94addr": "ZZ"}, {}), check_integrity=True)).report
    found = {(r["table"], r["check"], r["column"]): r["observed"] for r in report}
    assert len(report) == 8 + 16 + 8 + 3 + 3 + 7 + 6
    assert found["immigration", "unmatched_count", "state_code"] == 1
    assert found["temperature", "duplicate_count", "temp_id"] == 0


def test_sketches_are_published_by_month(spark, inputs):
    config = inputs(monthly=True, stay_sketches=True)
    build_star(spark, config)
    later = inputs(changes=({"i94mon": 5.0, "depdate": 20575.0},) * 3, monthly=True, stay_sketches=True)
    sketches = build_star(spark, later).tables["stay_sketches"]
    assert rows_of(sketches.select("month", "stays")) == [(3, 1), (4, 2), (5, 3)]
    assert rows_of(star.stay_quantiles(sketches, ["year"], [0.0, 1.0])) == [(2016, 6, [2, 9])]


def test_ids_that_are_kept(spark, inputs):
    config = inputs(keep_ids=True)
    first = build_star(spark, config).tables
    more = READINGS + "".join(f"2002-0{m}-01,{m}.0,0.5,Aarhus,Denmark,57.05N,10.33E\n" for m in range(1, 10))
    gone = more.replace("2000-04-01", "1999-04-01")
    ids = lambda df: {(r.date, r.average_temperature, r.city): r.temp_id for r in df.collect()}
    runs = [ids(first["temperature"])]
    for readings in (more, gone, more):
        runs.append(ids(build_star(spark, inputs(readings=readings, keep_ids=True)).tables["temperature"]))
    assert [len(r) for r in runs] == [3, 12, 12, 12]
    given = {}
    for run in runs:
        assert len(set(run.values())) == len(run) and all(given.get(k, v) == v for k, v in run.items())
        given |= run
    assert len(set(given.values())) == 13
    assert runs[1] == runs[3]  # a row that returns finds its id
    assert read_published(spark, config.output, "temperature_keys").count() == 13
    assert read_published(spark, config.output, "demographic_keys").count() == 2


def test_a_run_that_fails_gives_no_id_away(spark, inputs):
    config = inputs(keep_ids=True)
    build_star(spark, config)
    before = rows_of(read_published(spark, config.output, "temperature_keys"))
    with pytest.raises(QualityError):
        build_star(spark, inputs(readings=READINGS + "2003-01-01,1.0,0.5,A,Atlantis,1N,1E\n", keep_ids=True))
    assert rows_of(read_published(spark, config.output, "temperature_keys")) == before


def test_command_line(spark, inputs, capsys):
    config = inputs()
    names = ("labels", "arrivals", "demographic", "temperature", "output")
    main([a for n in names for a in (f"--{n}", getattr(config, n))] + ["--monthly"])
    assert "immigration.checked: 3" in capsys.readouterr().out
    folders = read_manifest(spark, config.output).tables["immigration"].folders
    assert {f.split("/", 3)[3] for f in folders} == {"year=2016/month=3", "year=2016/month=4"}


@pytest.fixture
def scans(spark, monkeypatch):
    """The scans of all plans the build runs, as text."""
    found = []

    def recorded(name):
        run = getattr(build, name)

        def wrapper(df, *args, **kwargs):
            plan = df._jdf.queryExecution().executedPlan().toString()
            found.extend(line for line in plan.splitlines() if "FileScan" in line)
            return run(df, *args, **kwargs)

        monkeypatch.setattr(build, name, wrapper)

    for name in ("write_table", "enforce"):
        recorded(name)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield lambda path: [line for line in found if f"{path}]" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_passes_over_the_inputs(spark, inputs, scans):
    """Arrivals: checked columns once, whole rows once. Shuffled inputs: once."""
    config = inputs()
    build_star(spark, config)
    checked, whole = sorted(
        len(re.search("ReadSchema: struct<(.*)>", scan)[1].split(",")) for scan in scans(config.arrivals)
    )
    # Nine columns are checked; a filled state code cannot be NULL, so it is not even read.
    assert (checked, whole) == (8, 28)
    assert len(scans(config.demographic)) == len(scans(config.temperature)) == 1
    # All lists are parsed in one pass.
    assert len(scans(config.labels)) == 1


def test_a_row_format_is_read_once(spark, inputs, scans):
    config = inputs()
    expected = rows_of(build_star(spark, config).tables["immigration"])
    path = config.arrivals + "_csv"
    spark.read.parquet(config.arrivals).write.csv(path, header=True)
    config = replace(config, arrivals=path, arrivals_format="csv", arrivals_options={"header": "true"})
    result = build_star(spark, config)
    assert len(scans(path)) == 1
    assert rows_of(result.tables["immigration"]) == expected
    assert result.counts["immigration.read"] == 3
