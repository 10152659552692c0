"""Data-quality report and gate: one aggregate per table, every failure at once; keys and references on request."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import count_null, quoted
from starmart.operators.lookup import Lookup, unmatched_codes
from starmart.schemas import MALFORMED

ERROR = "error"
WARN = "warn"


class QualityError(ValueError):
    """Raised by the gate; ``failures`` holds the failed rows of the report."""

    def __init__(self, failures):
        self.failures = failures
        super().__init__(
            "quality check failed: "
            + "; ".join(
                f"{f['table']}.{f['column'] or '*'} {f['check']} = {f['observed']}" for f in failures
            )
        )


@dataclass(frozen=True)
class Rules:
    """Checks of one table: a row count it must not have, columns without NULL, and values that can be read.

    ``malformed`` has (source name, column) pairs; they are checked where a table was read from text. NULL in a
    ``watched`` column is counted and never more than a warning.
    """

    not_null: Sequence[str] = ()
    malformed: Sequence[tuple[str, str]] = ()
    watched: Sequence[str] = ()
    forbidden_rows: int = 0
    severity: str = ERROR


def table_report(name: str, df: DataFrame, rules: Rules) -> DataFrame:
    """One row per check: ``(table, check, column, observed, severity, passed)``.

    Only the checked columns are read, and all checks share one aggregate.
    """
    malformed = rules.malformed if MALFORMED in df.columns else ()
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(count_null(c).alias(f"_null{i}") for i, c in enumerate((*rules.not_null, *rules.watched))),
        *(
            F.count_if(F.array_contains(MALFORMED, source)).alias(f"_malformed{i}")
            for i, (source, _) in enumerate(malformed)
        ),
    )

    def line(check, column, observed, passed, severity=rules.severity):
        return F.struct(
            F.lit(name).alias("table"),
            F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"),
            observed.alias("observed"),
            F.lit(severity).alias("severity"),
            passed.alias("passed"),
        )

    rows = F.col("_rows")
    lines = [line("row_count", None, rows, rows != rules.forbidden_rows)]
    for i, column in enumerate((*rules.not_null, *rules.watched)):
        nulls = F.col(f"_null{i}")
        severity = rules.severity if i < len(rules.not_null) else WARN
        lines.append(line("null_count", column, nulls, nulls == 0, severity))
    for i, (_, column) in enumerate(malformed):
        values = F.col(f"_malformed{i}")
        lines.append(line("malformed_count", column, values, values == 0))
    return counts.select(F.inline(F.array(*lines)))


def quality_report(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """Reports of all tables that have rules, as one DataFrame."""
    parts = [table_report(name, df, rules[name]) for name, df in tables.items() if name in rules]
    return reduce(DataFrame.unionAll, parts)


def enforce(report: DataFrame) -> list:
    """Raise ``QualityError`` naming all failed checks; give the report's rows otherwise (an action).

    A report has one row per check, so it is small whatever the tables hold.
    """
    rows = report.collect()
    failures = [r for r in rows if r["severity"] == ERROR and not r["passed"]]
    if failures:
        raise QualityError(failures)
    return rows


def check_row_count(name: str, df: DataFrame, forbidden_rows: int = 0) -> int:
    """Fail if the table has exactly ``forbidden_rows`` rows; give its row count (an action)."""
    return enforce(table_report(name, df, Rules(forbidden_rows=forbidden_rows)))[0]["observed"]


def check_nulls(name: str, df: DataFrame, columns: Sequence[str]) -> None:
    """Fail if any of the columns holds a NULL, naming all that do (an action)."""
    enforce(table_report(name, df, Rules(columns)).filter("check = 'null_count'"))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Exact row counts before and after each step: ``(stage, rows)``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        for stage, df in stages.items()
    ]
    return reduce(DataFrame.unionAll, parts)


@dataclass(frozen=True)
class Integrity:
    """What must hold between rows: each combination of ``unique`` columns stands once, and each code of ``references``
    stands in its list. A NULL code refers to nothing; it is left to the null checks."""

    unique: Sequence[Sequence[str]] = ()
    references: Sequence[Lookup] = ()
    severity: str = ERROR
    reference_severity: str = WARN


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows come after the first of their key, as one row ``(observed)``; keys with a NULL are keys as well.

    In two levels. First each key's 64-bit hash is counted, each task adding up its own: what is shuffled is a number a
    key, whatever the key is made of. Only keys whose hash comes again are then compared in full, so that two keys that share
    a hash are not taken for one. No row is shuffled.
    """
    key = [quoted(c) for c in columns]
    hashed = df.select(F.xxhash64(*key).alias("_hash"), F.struct(*key).alias("_key"))
    again = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_hash")
    met = hashed.join(again, "_hash", "left_semi").groupBy("_hash", "_key").agg(F.count(F.lit(1)).alias("_rows"))
    return met.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("long").alias("observed"))


def unmatched_references(df: DataFrame, references: Sequence[Lookup]) -> DataFrame:
    """Rows whose code its list does not hold, ``(column, observed)`` for every column of ``references``.

    Codes are counted before they meet the lists, all columns in one pass (``unmatched_codes``).
    """
    lost = unmatched_codes(df, references).where("code IS NOT NULL").select(F.col("column_name").alias("column"), "rows")
    # A row of none for each column, so that those without a loss are told as well.
    columns = F.explode(F.array(*(F.lit(item.column) for item in references))).alias("column")
    none = df.sparkSession.range(1).select(columns, F.lit(0).cast("long").alias("rows"))
    return lost.unionAll(none).groupBy("column").agg(F.sum("rows").alias("observed"))


def integrity_report(tables: Mapping[str, DataFrame], rules: Mapping[str, Integrity]) -> DataFrame:
    """Checks of keys and references as rows of the one report: ``(table, check, column, observed, severity, passed)``."""
    parts = []
    for name, rule in rules.items():
        found = [
            (duplicate_keys(tables[name], key).withColumn("column", F.lit(", ".join(key))), "duplicate_count", rule.severity)
            for key in rule.unique
        ]
        if rule.references:
            lost = unmatched_references(tables[name], rule.references)
            found.append((lost, "unmatched_count", rule.reference_severity))
        parts += [
            df.select(
                F.lit(name).alias("table"), F.lit(check).alias("check"), "column", "observed",
                F.lit(severity).alias("severity"), (F.col("observed") == 0).alias("passed"),
            )
            for df, check, severity in found
        ]
    return reduce(DataFrame.unionAll, parts)
