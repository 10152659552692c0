"""Cleaners of the three inputs. All are lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmart import schemas as S
from starmart.functions import quoted, sas_days_to_date, text_to_date
from starmart.operators.clean import (
    cast_columns,
    distinct_rows,
    drop_incomplete,
    fill_defaults,
    rename_columns,
)
from starmart.operators.keys import with_surrogate_id
from starmart.operators.lookup import enrich_by_name
from starmart.operators.names import enrich_by_similar_name


def clean_arrivals(
    raw: DataFrame,
    *,
    missing_departure: str = "epoch",
    rename_visa: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Fill, cast, convert dates, rename. Row-wise: no row is dropped and nothing shuffles.

    A missing departure becomes day zero, 1960-01-01, unless
    ``missing_departure="null"``. The visa column keeps its source name unless
    ``rename_visa``. ``strict`` fails the job on a number too large for an int, which
    otherwise becomes NULL.
    """
    if missing_departure not in ("epoch", "null"):
        raise ValueError("missing_departure is 'epoch' or 'null'")
    columns = S.ARRIVALS
    defaults = S.fills(columns)
    if missing_departure == "null":
        del defaults["depdate"]
    names = S.renames(columns)
    if rename_visa:
        names["i94visa"] = "visa_code"

    df = fill_defaults(raw, defaults)
    df = cast_columns(df, {c.source: "int" for c in columns if c.convert == "int"}, strict=strict)
    dates = {}
    for c in columns:
        if c.convert == "sas_date":
            dates[c.source] = sas_days_to_date(quoted(c.source))
        elif c.convert not in (None, "int"):
            dates[c.source] = text_to_date(quoted(c.source), c.convert)
    return rename_columns(df.withColumns(dates), names)


def complete_rows(raw: DataFrame, columns: tuple[S.SourceColumn, ...]) -> DataFrame:
    """Complete, distinct rows under their cleaned names, without an id."""
    df = drop_incomplete(raw, S.required(columns))
    return distinct_rows(rename_columns(df, S.renames(columns)))


def _clean_rows(raw: DataFrame, columns: tuple[S.SourceColumn, ...], id_column: str) -> DataFrame:
    return with_surrogate_id(complete_rows(raw, columns), id_column, distinct=True)


def clean_demographic(raw: DataFrame) -> DataFrame:
    """City demographics: complete, distinct rows with an ``id``."""
    return _clean_rows(raw, S.DEMOGRAPHIC, "id")


def clean_temperature(raw: DataFrame) -> DataFrame:
    """Temperature series: complete, distinct rows with a ``temp_id``."""
    return _clean_rows(raw, S.TEMPERATURE, "temp_id")


def enrich_temperature(
    temperature: DataFrame, country_codes: DataFrame, *, similar: float | None = None
) -> DataFrame:
    """Give each reading its country code; the list's name replaces the reading's own.

    With ``similar`` a country that equals no name takes the one list row that holds at least that share of its words
    and fits best; several that fit alike leave it without a code.
    """
    output = [*S.TEMPERATURE_OUTPUT, *(c for c in temperature.columns if c == S.MALFORMED)]
    if similar is None:
        return enrich_by_name(temperature, "country", country_codes, "country_name", output)
    return enrich_by_similar_name(temperature, "country", country_codes, "country_name", output, least=similar)
