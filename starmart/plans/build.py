"""Build the star: read, clean, enrich, check, and only then publish.

Passes over each input:

* The arrivals need no shuffle. From a columnar format their checks read the checked
  columns only, and the write reads the input a second time and cleans it on the way. A
  row format would be read in full both times, so it is staged like the others.
* Demographics and temperatures are shuffled, so they are cleaned once into a staged
  Parquet table; checks and publishing read that.
* The dictionary text is parsed once, all lists in one table, and staged as well.

Staged tables live below the output under the run's own name, and go at its end, however it ends. Tables are published
by ``sources.publish``: each run writes folders of its own, and a manifest that is put down last makes them live, all
at once. Whatever step fails, readers find the set of the last run that succeeded. ``read_star`` gives that set.

The build works in a session of its own that has the caller's settings, so what it sets does not show elsewhere.
"""

from __future__ import annotations

import argparse
import logging
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from py4j.protocol import Py4JError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.keys import assign_kept_ids, new_keys, rows_with_kept_ids
from starmart.operators.labels import code_list_tables, parse_code_lists
from starmart.operators.lookup import conform_codes
from starmart.operators.quality import ERROR, WARN, Integrity, Rules, enforce, integrity_report, quality_report
from starmart.plans.arrivals import (
    clean_arrivals,
    clean_demographic,
    clean_temperature,
    complete_rows,
    enrich_temperature,
)
from starmart.plans.star import star_lookups, stay_sketches
from starmart.session import DEFAULT_PARTITIONS, EXPLICIT_SIZE, create_session, shuffle_partitions
from starmart.sources import (
    APPEND,
    PERIODS,
    REPLACE,
    Publication,
    published_tables,
    read_by_name,
    read_delimited,
    read_dictionary,
    read_fact,
    read_published,
    read_table,
    register_views,
    remove_folder,
    write_table,
)

log = logging.getLogger(__name__)
FACT = "immigration"
SKETCHES = "stay_sketches"
COLUMNAR_FORMATS = ("parquet", "orc")
# Tables whose rows may keep their ids: columns of the source, and the id's name.
KEPT = {"demographic": (S.DEMOGRAPHIC, "id"), "temperature": (S.TEMPERATURE, "temp_id")}


@dataclass(frozen=True)
class StarConfig:
    """Where the inputs are, where the tables go, and the named departures from the defaults.

    ``infer_types`` lets Spark infer the types of the two CSV inputs instead of converting them by declaration.
    ``strict`` fails the job on an arrival's number that is too large. ``keep_ids`` gives cities and readings the ids they had
    in the runs before, by key maps that are published with the tables. ``check_integrity`` adds
    unique ids and codes, and codes that their lists lack (as warnings), to the report. ``stay_sketches`` publishes
    ``stay_sketches`` beside the fact, by month if that is. ``similar_countries`` lets a reading's country that
    equals no name of the list take the one row that holds at least this share of its words. ``rebalance`` shuffles the fact by month before it is
    written; None does so if ``monthly``.
    """

    labels: str
    arrivals: str
    demographic: str
    temperature: str
    output: str
    arrivals_format: str = "parquet"
    arrivals_options: Mapping[str, str] = field(default_factory=dict)
    missing_departure: str = "epoch"
    rename_visa: bool = False
    conform_states: bool = False
    monthly: bool = False
    rebalance: bool | None = None
    infer_types: bool = False
    strict: bool = False
    keep_ids: bool = False
    check_integrity: bool = False
    stay_sketches: bool = False
    similar_countries: float | None = None
    warn_only: tuple[str, ...] = ()


@dataclass(frozen=True)
class BuildResult:
    """The published tables, the passed report, and the row counts seen on the way."""

    tables: dict[str, DataFrame]
    report: list[Row]
    counts: dict[str, int]


def star_rules(warn_only: tuple[str, ...] = ()) -> dict[str, Rules]:
    read_as_text = {
        FACT: S.typed(S.ARRIVALS),
        "demographic": S.typed(S.DEMOGRAPHIC),
        "temperature": S.typed(S.TEMPERATURE),
    }
    return {
        table: Rules(
            columns,
            read_as_text.get(table, ()),
            S.WATCHED.get(table, ()),
            severity=WARN if table in warn_only else ERROR,
        )
        for table, columns in S.NOT_NULL.items()
    }


def star_integrity(tables: Mapping[str, DataFrame], warn_only: tuple[str, ...] = ()) -> dict[str, Integrity]:
    """Each id and each code of a list stands once; codes of the fact that a list lacks are a warning."""
    keys = {name: [(id_,)] for name, (_, id_) in KEPT.items()}
    keys |= {item.table: [(item.code,)] for item in (*S.CODE_LISTS, S.VISA_LIST)}
    rules = {
        name: Integrity(unique, severity=WARN if name in warn_only else ERROR) for name, unique in keys.items()
    }
    return {**rules, FACT: Integrity(references=star_lookups(tables[FACT], tables))}


def _side_by_side(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes at once, so that small tables do not wait for large ones."""
    with ThreadPoolExecutor(len(writes)) as pool:
        # The threads take over the session's pool and job group.
        for write in [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]:
            write.result()


def _watched(df: DataFrame, seen: Observation) -> DataFrame:
    return df.observe(seen, F.count(F.lit(1)).alias("rows"))


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of the caller's, which may be changed without a trace there."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    # Keep stages whose rows were all dropped in the plan: adaptive execution would take their row counts along.
    key, rule = (
        "spark.sql.adaptive.optimizer.excludedRules",
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation",
    )
    before = session.conf.get(key, None)
    session.conf.set(key, f"{before},{rule}" if before else rule)
    return session


def _counts(seen: Mapping[str, Observation]) -> dict[str, int]:
    """Rows of the inputs, for information: one that Spark did not report is left out, and never fails the build."""
    counts = {}
    for name, observation in seen.items():
        try:
            counts[f"{name}.read"] = observation.get["rows"]
        except (Py4JError, KeyError, AssertionError) as error:
            log.warning("rows read of %s are not known: %s", name, type(error).__name__)
    return counts


def _size_shuffles(spark: SparkSession, *inputs: DataFrame) -> None:
    """Shuffle partitions by the shuffled inputs' size as Spark's scans know it, unless the session says otherwise."""
    key = "spark.sql.shuffle.partitions"
    if spark.conf.get(EXPLICIT_SIZE, None) is None and spark.conf.get(key) == str(DEFAULT_PARTITIONS):
        sizes = [int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs]
        spark.conf.set(key, str(shuffle_partitions(max(sizes))))


def build_star(spark: SparkSession, config: StarConfig) -> BuildResult:
    """Run the whole build (an action). Raises ``QualityError`` before anything is published.

    ``counts`` of the inputs come with the jobs that read them and cost no pass of their
    own. They are for information: Spark counts a task again that it has to repeat. The
    report is exact, and it alone decides.
    """
    run = uuid.uuid4().hex
    stage = f"{config.output}/_stage/{run}"
    try:
        own = _own_session(spark)
        with Publication(own, config.output) as new:
            report, counts = _build(own, config, stage, new)
    finally:
        remove_folder(spark, stage)
    published = read_star(spark, config.output)
    register_views(published)
    return BuildResult(published, report, counts)


def read_star(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The tables of the last run that succeeded."""
    return published_tables(spark, output)


def _key_map(name: str) -> str:
    return f"{name}_keys"


def _assigned(new: Publication, name: str, raw: DataFrame) -> DataFrame:
    """Cleaned rows with the ids they had, or get; the key map is that of the run this one follows."""
    known = None
    if new.before and _key_map(name) in new.before.tables:
        known = read_published(new.spark, new.output, _key_map(name), manifest=new.before)
    return assign_kept_ids(complete_rows(raw, KEPT[name][0]), known, distinct=True)


def _build(spark: SparkSession, config: StarConfig, stage: str, new: Publication) -> tuple[list[Row], dict[str, int]]:
    def read_text(path: str, sep: str, columns: tuple[S.SourceColumn, ...]) -> DataFrame:
        return read_delimited(spark, path, sep) if config.infer_types else read_by_name(spark, path, columns, sep=sep)

    arrivals = read_fact(spark, config.arrivals, config.arrivals_format, **config.arrivals_options)
    cities = read_text(config.demographic, ";", S.DEMOGRAPHIC)
    readings = read_text(config.temperature, ",", S.TEMPERATURE)
    rebalance = config.monthly if config.rebalance is None else config.rebalance
    _size_shuffles(spark, cities, readings, *([arrivals] if rebalance else []))

    write_table(parse_code_lists(read_dictionary(spark, config.labels)).coalesce(1), f"{stage}/labels")
    tables = code_list_tables(read_table(spark, f"{stage}/labels"))

    def fact(raw: DataFrame) -> DataFrame:
        df = clean_arrivals(
            raw,
            missing_departure=config.missing_departure,
            rename_visa=config.rename_visa,
            strict=config.strict,
        )
        if config.conform_states:
            states = read_table(spark, f"{stage}/labels").filter("list = 'state_codes'")
            df = conform_codes(df, "state_code", states, "code", S.OTHER_STATE, unique=True)
        return df

    seen = {name: Observation() for name in ("demographic", "temperature")}
    watched = {
        "demographic": _watched(cities, seen["demographic"]),
        "temperature": _watched(readings, seen["temperature"]),
    }
    if config.keep_ids:
        to_stage = {name: _assigned(new, name, df) for name, df in watched.items()}
    else:
        cleaned = clean_temperature(watched["temperature"])
        to_stage = {
            "demographic": clean_demographic(watched["demographic"]),
            "temperature": enrich_temperature(cleaned, tables["country_codes"], similar=config.similar_countries),
        }
    if config.arrivals_format not in COLUMNAR_FORMATS:
        to_stage[FACT] = fact(arrivals)
    _side_by_side(spark, *(partial(write_table, df, f"{stage}/{name}") for name, df in to_stage.items()))
    counts = _counts(seen)
    staged = {name: read_table(spark, f"{stage}/{name}") for name in to_stage}
    keys = {}
    if config.keep_ids:
        keys = {_key_map(name): new_keys(staged[name]) for name in KEPT}
        staged |= {name: rows_with_kept_ids(staged[name], id_, distinct=True) for name, (_, id_) in KEPT.items()}
        staged["temperature"] = enrich_temperature(
            staged["temperature"], tables["country_codes"], similar=config.similar_countries
        )
    tables = {**tables, FACT: fact(arrivals), **staged}

    report = quality_report(tables, star_rules(config.warn_only))
    if config.check_integrity:
        report = report.unionAll(integrity_report(tables, star_integrity(tables, config.warn_only)))
    report = enforce(report)
    checked = {f"{r['table']}.checked": r["observed"] for r in report if r["check"] == "row_count"}
    # Cleaning drops no arrival.
    counts = {f"{FACT}.read": checked[f"{FACT}.checked"], **counts, **checked}

    periods = {FACT: ("year", "month")} if config.monthly else {}
    publish = {name: df.drop(S.MALFORMED) for name, df in tables.items()} | keys
    _side_by_side(
        spark,
        *(
            partial(
                write_table,
                df,
                new.folder(name),
                partition_by=periods.get(name, ()),
                rebalance=rebalance and name == FACT,
            )
            for name, df in publish.items()
        )
    )
    for name, df in publish.items():
        # A monthly fact changes the months it brings, all other tables as a whole.
        mode = PERIODS if name in periods else APPEND if name in keys else REPLACE
        new.add(name, df.schema, partition_by=periods.get(name, ()), mode=mode)
    if config.stay_sketches:
        # From what was just written: three columns, already clean.
        sketches = stay_sketches(read_table(spark, new.folder(FACT)))
        by_month = periods.get(FACT, ())
        write_table(sketches, new.folder(SKETCHES), partition_by=by_month, rebalance=bool(by_month))
        new.add(SKETCHES, sketches.schema, partition_by=by_month, mode=PERIODS if by_month else REPLACE)
    new.complete()
    return report, counts


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the arrivals star.")
    for name in ("labels", "arrivals", "demographic", "temperature", "output"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--arrivals-format", default="parquet")
    parser.add_argument("--arrivals-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--packages", help="jar of the arrivals format, as Maven coordinates")
    parser.add_argument("--monthly", action="store_true", help="partition by year and month")
    parser.add_argument(
        "--rebalance", action=argparse.BooleanOptionalAction, help="shuffle by month before writing; on with --monthly"
    )
    parser.add_argument("--infer-types", action="store_true", help="infer the types of the CSV inputs")
    parser.add_argument("--strict", action="store_true", help="fail on numbers that are too large")
    parser.add_argument("--check-integrity", action="store_true", help="check keys and references as well")
    parser.add_argument("--stay-sketches", action="store_true", help="publish quantile sketches of the length of stay")
    parser.add_argument("--keep-ids", action="store_true", help="ids as in the runs before")
    parser.add_argument(
        "--similar-countries", type=float, metavar="SHARE", help="match countries by this share of their words"
    )
    parser.add_argument("--missing-departure", choices=("epoch", "null"), default="epoch")
    parser.add_argument("--rename-visa", action="store_true")
    parser.add_argument("--conform-states", action="store_true")
    parser.add_argument("--warn-only", nargs="*", default=(), metavar="TABLE")
    parser.add_argument("--largest-shuffle-bytes", type=int, help="size of the largest shuffled input")
    args = parser.parse_args(argv)
    spark = create_session(packages=args.packages, largest_shuffle_bytes=args.largest_shuffle_bytes)
    result = build_star(
        spark,
        StarConfig(
            labels=args.labels,
            arrivals=args.arrivals,
            demographic=args.demographic,
            temperature=args.temperature,
            output=args.output,
            arrivals_format=args.arrivals_format,
            arrivals_options=dict(option.split("=", 1) for option in args.arrivals_option),
            monthly=args.monthly,
            rebalance=args.rebalance,
            infer_types=args.infer_types,
            strict=args.strict,
            keep_ids=args.keep_ids,
            check_integrity=args.check_integrity,
            stay_sketches=args.stay_sketches,
            similar_countries=args.similar_countries,
            missing_departure=args.missing_departure,
            rename_visa=args.rename_visa,
            conform_states=args.conform_states,
            warn_only=tuple(args.warn_only),
        ),
    )
    for name, rows in result.counts.items():
        print(f"{name}: {rows}")


if __name__ == "__main__":
    main()
