"""Declared inputs and the cleaning rules of the arrivals star.

One row per source column says what happens to it, so the schema, the fills, the
casts and the renames all follow from the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceColumn:
    """A raw column: its type, its final name, its fill and its conversion.

    ``convert`` is ``"int"``, ``"sas_date"``, or a text date pattern.
    """

    source: str
    type: str
    name: str | None = None
    fill: float | str | None = None
    convert: str | None = None
    required: bool = False

    @property
    def final(self) -> str:
        return self.name or self.source


# Source names, final names and fill values of the arrivals records.
ARRIVALS = (
    SourceColumn("cicid", "double", convert="int"),
    SourceColumn("i94yr", "double", "year", convert="int"),
    SourceColumn("i94mon", "double", "month", convert="int"),
    SourceColumn("i94cit", "double", "citizenship", fill=999, convert="int"),
    SourceColumn("i94res", "double", "residence", fill=999, convert="int"),
    SourceColumn("i94port", "string", "port"),
    SourceColumn("arrdate", "double", "arrival_date", convert="sas_date"),
    SourceColumn("i94mode", "double", "mode", fill=9, convert="int"),
    SourceColumn("i94addr", "string", "state_code", fill=""),
    SourceColumn("depdate", "double", "departure_date", fill=0, convert="sas_date"),
    SourceColumn("i94bir", "double", "age", fill=0, convert="int"),
    SourceColumn("i94visa", "double", convert="int"),
    SourceColumn("count", "double", convert="int"),
    SourceColumn("dtadfile", "string", fill="", convert="yyyyMMdd"),
    SourceColumn("visapost", "string", fill=""),
    SourceColumn("occup", "string", fill=""),
    SourceColumn("entdepa", "string", fill=""),
    SourceColumn("entdepd", "string", fill=""),
    SourceColumn("entdepu", "string", fill=""),
    SourceColumn("matflag", "string", fill=""),
    SourceColumn("biryear", "double", "birth_year", fill=0, convert="int"),
    SourceColumn("dtaddto", "string", fill="", convert="MMddyyyy"),
    SourceColumn("gender", "string", fill=""),
    SourceColumn("insnum", "string", fill=""),
    SourceColumn("airline", "string", fill=""),
    SourceColumn("admnum", "double"),
    SourceColumn("fltno", "string", fill=""),
    SourceColumn("visatype", "string", "visa_type"),
)

# Header names, final names and required columns of the city demographics.
DEMOGRAPHIC = (
    SourceColumn("City", "string", "city"),
    SourceColumn("State", "string", "state_name"),
    SourceColumn("Median Age", "double", "median_age"),
    SourceColumn("Male Population", "long", "male_population", required=True),
    SourceColumn("Female Population", "long", "female_population", required=True),
    SourceColumn("Total Population", "long", "total_population"),
    SourceColumn("Number of Veterans", "long", "number_of_veterans", required=True),
    SourceColumn("Foreign-born", "long", "foreign_born", required=True),
    SourceColumn("Average Household Size", "double", "average_household_size", required=True),
    SourceColumn("State Code", "string", "state_code"),
    SourceColumn("Race", "string", "race"),
    SourceColumn("Count", "long", "count"),
)

# Header names, final names and required columns of the temperature series.
TEMPERATURE = (
    SourceColumn("dt", "date", "date"),
    SourceColumn("AverageTemperature", "double", "average_temperature", required=True),
    SourceColumn(
        "AverageTemperatureUncertainty", "double", "average_temperature_uncertainty", required=True
    ),
    SourceColumn("City", "string", "city"),
    SourceColumn("Country", "string", "country"),
    SourceColumn("Latitude", "string", "latitude"),
    SourceColumn("Longitude", "string", "longitude"),
)

# Column order of the published temperature table.
TEMPERATURE_OUTPUT = (
    "temp_id",
    "date",
    "average_temperature",
    "average_temperature_uncertainty",
    "city",
    "country_name",
    "country_code",
    "latitude",
    "longitude",
)


@dataclass(frozen=True)
class CodeList:
    """A code list: its table, its two columns and its section in the dictionary text."""

    table: str
    code: str
    name: str
    section: str | None = None


# Code lists, their columns and the section names of the dictionary text.
CODE_LISTS = (
    CodeList("country_codes", "country_code", "country_name", "i94cntyl"),
    CodeList("port_codes", "port_code", "port_name", "i94prtl"),
    CodeList("mode_codes", "mode_code", "mode_name", "i94model"),
    CodeList("state_codes", "state_code", "state_name", "i94addrl"),
)

# The visa categories, which the dictionary text holds only as a comment.
VISA_LIST = CodeList("visa_codes", "visa_code", "visa_category")
VISA_ROWS = (("1", "Business"), ("2", "Pleasure"), ("3", "Student"))

# The code of "all other" states, and the columns that may hold no NULL.
OTHER_STATE = "99"
NOT_NULL = {
    "country_codes": ("country_code",),
    "port_codes": ("port_code",),
    "mode_codes": ("mode_code",),
    "state_codes": ("state_code",),
    "visa_codes": ("visa_code",),
    "immigration": ("cicid", "year", "month", "citizenship", "residence", "state_code"),
    "demographic": ("id", "city", "state_code"),
    "temperature": ("temp_id", "country_code"),
}

# Columns of the arrivals that are filled and then made whole numbers: NULL is a number that was too large.
WATCHED = {"immigration": ("mode", "age", "birth_year")}


TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


# Of a table read from text: the source names of the values that could not be read.
MALFORMED = "_malformed"


def typed(columns: tuple[SourceColumn, ...]) -> list[tuple[str, str]]:
    """Source and final names of the columns that text must be converted for."""
    return [(c.source, c.final) for c in columns if c.type != "string"]


def struct_type(columns: tuple[SourceColumn, ...]) -> T.StructType:
    return T.StructType([T.StructField(c.source, TYPES[c.type]) for c in columns])


def fills(columns: tuple[SourceColumn, ...]) -> dict[str, float | str]:
    return {c.source: c.fill for c in columns if c.fill is not None}


def renames(columns: tuple[SourceColumn, ...]) -> dict[str, str]:
    return {c.source: c.name for c in columns if c.name}


def required(columns: tuple[SourceColumn, ...]) -> list[str]:
    return [c.source for c in columns if c.required]


ARRIVALS_SCHEMA = struct_type(ARRIVALS)
DEMOGRAPHIC_SCHEMA = struct_type(DEMOGRAPHIC)
TEMPERATURE_SCHEMA = struct_type(TEMPERATURE)
