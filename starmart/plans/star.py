"""Questions the star answers. Facts are aggregated to the join key before any join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.dates import SAS_EPOCH
from starmart.operators.lookup import Lookup, lookup_codes, unmatched_codes


VISA_COLUMNS = ("i94visa", "visa_code")  # the source's name, and the one of ``rename_visa``


def star_lookups(fact: DataFrame, tables: Mapping[str, DataFrame]) -> list[Lookup]:
    """The joins from the fact to its code lists, which hold each code once; the visa column is the one the fact has."""
    visa_column = next((c for c in VISA_COLUMNS if c in fact.columns), VISA_COLUMNS[0])
    countries = tables["country_codes"]
    return [
        Lookup("citizenship", countries, "country_code", "country_name", "citizenship_name", unique=True),
        Lookup("residence", countries, "country_code", "country_name", "residence_name", unique=True),
        Lookup("port", tables["port_codes"], "port_code", "port_name", "port_name", unique=True),
        Lookup("mode", tables["mode_codes"], "mode_code", "mode_name", "mode_name", unique=True),
        Lookup("state_code", tables["state_codes"], "state_code", "state_name", "state_name", unique=True),
        Lookup(visa_column, tables["visa_codes"], "visa_code", "visa_category", "visa_category", unique=True),
    ]


def count_by(df: DataFrame, keys: Sequence[str], lookups: Sequence[Lookup] = ()) -> DataFrame:
    """Rows per combination of codes, then the names of those codes.

    The join runs on the combinations, not on the rows.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("arrivals"))
    return lookup_codes(counts, [item for item in lookups if item.column in keys])


def arrivals_by(
    fact: DataFrame, tables: Mapping[str, DataFrame], keys: Sequence[str]
) -> DataFrame:
    """Arrivals per residence, mode, visa category, port or state, with their names."""
    lost = [k for k in keys if k in VISA_COLUMNS and k not in fact.columns]
    if lost:
        raise ValueError(f"the fact names its visa column otherwise than {lost[0]}")
    return count_by(fact, keys, star_lookups(fact, tables))


def arrivals_margins(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    keys: Sequence[str],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Arrivals by several groupings at once, with names: by each of ``keys`` alone and in all, unless ``sets`` says otherwise.

    ``grouping`` is SQL's grouping id: a bit for each of ``keys``, the first one highest, set where a row is not grouped by it.
    The fact is read once and counted by all keys; what is repeated for each grouping are those counts, not its rows.
    """
    groupings = [[k] for k in keys] + [[]] if sets is None else [list(s) for s in sets]
    counts = count_by(fact, keys)
    margins = counts.groupingSets([[F.col(k) for k in s] for s in groupings], *keys).agg(
        F.sum("arrivals").alias("arrivals"), F.grouping_id().alias("grouping")
    )
    return lookup_codes(margins, [item for item in star_lookups(fact, tables) if item.column in keys])


def state_profile(demographic: DataFrame) -> DataFrame:
    """Population per state.

    The table holds a city once per race with its totals repeated, so it is reduced to
    cities before states are summed.
    """
    measures = (
        "total_population",
        "male_population",
        "female_population",
        "number_of_veterans",
        "foreign_born",
    )
    cities = demographic.groupBy("state_code", "city").agg(*(F.max(m).alias(m) for m in measures))
    return cities.groupBy("state_code").agg(
        F.count(F.lit(1)).alias("cities"), *(F.sum(m).alias(m) for m in measures)
    )


def arrivals_and_population(fact: DataFrame, demographic: DataFrame) -> DataFrame:
    """Arrivals per state next to the state's population."""
    arrivals = fact.groupBy("state_code").agg(F.count(F.lit(1)).alias("arrivals"))
    return arrivals.join(state_profile(demographic), "state_code", "left")


def monthly_climate(temperature: DataFrame) -> DataFrame:
    """Mean temperature per country and month of the year, over all years."""
    return (
        temperature.filter("country_code IS NOT NULL")
        .groupBy("country_code", F.month("date").alias("month"))
        .agg(
            F.avg("average_temperature").alias("mean_temperature"),
            F.count(F.lit(1)).alias("readings"),
        )
    )


def arrivals_and_climate(fact: DataFrame, temperature: DataFrame) -> DataFrame:
    """Arrivals per residence and month next to that country's usual climate.

    Readings end years before the arrivals begin, so they meet on the month of the year.
    """
    arrivals = fact.groupBy(
        F.col("residence").cast("string").alias("country_code"), "month"
    ).agg(F.count(F.lit(1)).alias("arrivals"))
    return arrivals.join(monthly_climate(temperature), ["country_code", "month"], "left")


def stay_length(fact: DataFrame) -> DataFrame:
    """Arrivals per length of stay in days; the stand-in for a missing departure is left out."""
    stayed = fact.filter(F.col("departure_date") != F.lit(SAS_EPOCH).cast("date"))
    days = F.date_diff("departure_date", "arrival_date").alias("days")
    return stayed.filter("arrival_date IS NOT NULL").groupBy(days).agg(
        F.count(F.lit(1)).alias("arrivals")
    )


SKETCH_SIZE = 400  # ranks read from such a sketch are off by less than SKETCH_ERROR, but for one case in a hundred
SKETCH_ERROR = 0.0085


def _stays(fact: DataFrame) -> DataFrame:
    """Rows with a length of stay, ``days``; the stand-in for a missing departure is left out."""
    stayed = fact.filter((F.col("departure_date") != F.lit(SAS_EPOCH).cast("date")) & F.col("arrival_date").isNotNull())
    return stayed.withColumn("days", F.date_diff("departure_date", "arrival_date").cast("bigint"))


def stay_sketches(fact: DataFrame, keys: Sequence[str] = ("residence", "year", "month")) -> DataFrame:
    """Stays of each group and a quantile sketch of their lengths: ``(*keys, stays, sketch)``.

    A sketch is some kilobytes whatever it has seen, each task makes its own, and sketches add up: those of a month
    are published with it and serve all later questions without the fact.
    """
    return _stays(fact).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("stays"), F.kll_sketch_agg_bigint("days", F.lit(SKETCH_SIZE)).alias("sketch")
    )


def stay_quantiles(
    sketches: DataFrame, keys: Sequence[str] = ("residence",), at: Sequence[float] = (0.25, 0.5, 0.75, 0.95)
) -> DataFrame:
    """Lengths of stay at the ranks ``at`` for coarser groups, from sketches alone: ``(*keys, stays, days)``, an array."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("stays").alias("stays"), F.kll_merge_agg_bigint("sketch", F.lit(SKETCH_SIZE)).alias("_sketch")
    )
    ranks = F.array(*(F.lit(float(p)) for p in at))
    return merged.select(*keys, "stays", F.kll_sketch_get_quantile_bigint("_sketch", ranks).alias("days"))


def unmatched(fact: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Codes of the fact that its lists do not hold."""
    return unmatched_codes(fact, star_lookups(fact, tables))
