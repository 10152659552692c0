"""Sources, sinks and named views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.clean import cast_columns
from starmart.operators.labels import visa_codes
from starmart.operators.lookup import Lookup, lookup_codes
from starmart.operators.quality import Rules, quality_report
from starmart.plans.arrivals import clean_arrivals, clean_demographic, clean_temperature
from starmart.plans.build import star_rules
from starmart.plans.incoming import take_arrivals
from starmart.queries import shapes
from starmart.queries.registry import query, table, work_path
from starmart.sources import (
    APPEND,
    PERIODS,
    Publication,
    literal_table,
    read_by_name,
    read_delimited,
    read_fact,
    read_published,
    read_table,
    refresh_partitions,
    register_views,
    write_table,
)

ORDERS_CSV = "o_orderkey long, o_status string, o_totalprice double, o_day date"
ORDERS_SQL = """
    select o_orderkey, nullif(o_orderstatus, 'P') as o_status, o_totalprice,
           cast(o_orderdate as date) as o_day
    from orders
"""


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_orderstatus, 'P') as o_status",
        "o_totalprice",
        "cast(o_orderdate as date) as o_day",
    )


def _csv(spark, df, name, sep):
    path = work_path(spark, name)
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


@query("fact_scan", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def fact_scan(spark, sf_dir):
    schema = "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string"
    fact = read_fact(spark, f"{sf_dir}/lineitem.parquet", "parquet", schema)
    return fact.select("l_orderkey", "l_linenumber", "l_quantity")


@query("fact_scan_csv", shapes.ARRIVALS_SQL)
def fact_scan_csv(spark, sf_dir):
    """Arrivals as CSV with its columns in another order and more of them, found by the names in the header."""
    raw = shapes.arrivals_raw(table(spark, sf_dir, "orders"))
    shuffled = raw.select(F.lit(1).alias("row"), *reversed(raw.columns), F.lit("x").alias("remark"))
    path = _csv(spark, shuffled, "fact_scan_csv", ",")
    return clean_arrivals(read_fact(spark, path, "csv", header="true")).drop(S.MALFORMED)


def _cities_as_text(spark, sf_dir):
    """Cities as CSV; of four customers one has a fraction, one a large number, one no number, one nothing."""
    cities = table(spark, sf_dir, "customer").selectExpr(
        "concat('City ', c_custkey) as City",
        "concat('State ', c_nationkey) as State",
        "cast(c_custkey % 90 as string) as `Median Age`",
        "element_at(array('100.0', '3000000000', 'n/a', ''), cast(c_custkey % 4 as int) + 1) as `Male Population`",
        "'1e2' as `Female Population`",
        "if(c_custkey % 8 = 0, '?', '200') as `Total Population`",
        "'7' as `Number of Veterans`",
        "'3' as `Foreign-born`",
        "'2.5' as `Average Household Size`",
        "concat('S', c_nationkey) as `State Code`",
        "c_mktsegment as Race",
        "'1' as Count",
    )
    path = _csv(spark, cities, "cities_as_text", ";")
    return clean_demographic(read_by_name(spark, path, S.DEMOGRAPHIC, sep=";"))


def _readings_as_text(spark, sf_dir):
    readings = table(spark, sf_dir, "events").selectExpr(
        "if(event_id % 9 = 0, 'some day', string(date_add(cast(ts as date), cast(event_id % 365 as int)))) as dt",
        "element_at(array('1.5', '1e1', 'n/a', ''), cast(event_id % 4 as int) + 1) as AverageTemperature",
        "'0.5' as AverageTemperatureUncertainty",
        "concat('City ', event_id) as City",
        "'Here' as Country",
        "'1N' as Latitude",
        "'1E' as Longitude",
    )
    path = _csv(spark, readings, "readings_as_text", ",")
    return clean_temperature(read_by_name(spark, path, S.TEMPERATURE))


@query(
    "malformed_values",
    """
    select 'City ' || c_custkey as city,
           case c_custkey % 4 when 0 then 100 when 1 then 3000000000 end as male_population,
           100::bigint as female_population, case when c_custkey % 8 <> 0 then 200::bigint end as total_population,
           concat_ws(',', case when c_custkey % 4 = 2 then 'Male Population' end,
                          case when c_custkey % 8 = 0 then 'Total Population' end) as malformed
    from customer where c_custkey % 4 <> 3
    """,
)
def malformed_values(spark, sf_dir):
    """Only the empty value loses its row; one that is no number keeps it, and is told."""
    return _cities_as_text(spark, sf_dir).select(
        "city", "male_population", "female_population", "total_population",
        F.array_join(S.MALFORMED, ",").alias("malformed"),
    )


@query(
    "malformed_report",
    """
    with cities as (select count(*) filter (c_custkey % 4 = 2) as male, count(*) filter (c_custkey % 8 = 0) as total
                    from customer),
         readings as (select count(*) filter (event_id % 4 = 2) as warm,
                             count(*) filter (event_id % 9 = 0 and event_id % 4 <> 3) as day from events)
    select 'demographic' as "table", 'male_population' as "column", male as observed, male = 0 as passed from cities
    union all select 'demographic', 'total_population', total, total = 0 from cities
    union all select 'demographic', unnest(['median_age', 'female_population', 'number_of_veterans', 'foreign_born',
                                            'average_household_size', 'count']), 0, true
    union all select 'temperature', 'date', day, day = 0 from readings
    union all select 'temperature', 'average_temperature', warm, warm = 0 from readings
    union all select 'temperature', 'average_temperature_uncertainty', 0, true
    """,
)
def malformed_report(spark, sf_dir):
    tables = {"demographic": _cities_as_text(spark, sf_dir), "temperature": _readings_as_text(spark, sf_dir)}
    rules = {name: Rules(malformed=star_rules()[name].malformed) for name in tables}
    report = quality_report(tables, rules)
    return report.filter("check = 'malformed_count'").select("table", "column", "observed", "passed")


@query("csv_semicolon", ORDERS_SQL)
def csv_semicolon(spark, sf_dir):
    path = _csv(spark, _orders(spark, sf_dir), "csv_semicolon", ";")
    return read_delimited(spark, path, ";", ORDERS_CSV)


@query("csv_comma", ORDERS_SQL)
def csv_comma(spark, sf_dir):
    path = _csv(spark, _orders(spark, sf_dir), "csv_comma", ",")
    return read_delimited(spark, path, ",", ORDERS_CSV)


@query("csv_inferred", ORDERS_SQL)
def csv_inferred(spark, sf_dir):
    """Types inferred from the file; an inferred int is widened so that the result keeps its schema."""
    path = _csv(spark, _orders(spark, sf_dir), "csv_inferred", ",")
    return cast_columns(read_delimited(spark, path), {"o_orderkey": "bigint"}, strict=True)


@query(
    "literal_table",
    """
    select o_orderkey, case o_orderstatus when 'F' then 'Final' when 'O' then 'Open' end as status_name,
           case substr(o_orderpriority, 1, 1)
               when '1' then 'Business' when '2' then 'Pleasure' when '3' then 'Student' end as visa_category
    from orders
    """,
)
def literal(spark, sf_dir):
    """Constant tables joined to a whole table."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "substr(o_orderpriority, 1, 1) as visa"
    )
    status = literal_table(spark, [("F", "Final"), ("O", "Open")], ["code", "name"])
    lookups = [
        Lookup("o_orderstatus", status, "code", "name", "status_name"),
        Lookup("visa", visa_codes(spark), "visa_code", "visa_category", "visa_category"),
    ]
    return lookup_codes(orders, lookups).select("o_orderkey", "status_name", "visa_category")


@query("parquet_roundtrip", ORDERS_SQL)
def parquet_roundtrip(spark, sf_dir):
    path = work_path(spark, "parquet_roundtrip")
    write_table(_orders(spark, sf_dir), path)
    return read_table(spark, path)


@query(
    "monthly_refresh",
    """
    select o_orderkey,
           case when year(o_orderdate) = 1998 and month(o_orderdate) in (3, 4)
                then o_totalprice * 2 else o_totalprice end as o_totalprice,
           cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month
    from orders
    """,
)
def monthly_refresh(spark, sf_dir):
    """All months written, two of them delivered again with other prices."""
    path = work_path(spark, "monthly_refresh")
    months = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "year(o_orderdate) as year", "month(o_orderdate) as month"
    )
    write_table(months, path, partition_by=["year", "month"], rebalance=True)
    again = months.filter("year = 1998 and month in (3, 4)")
    refresh_partitions(again.selectExpr("o_orderkey", "o_totalprice * 2 as o_totalprice", "year", "month"), path)
    return read_table(spark, path)


@query(
    "versioned_publish",
    """
    with months as (
        select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as year,
               cast(month(o_orderdate) as integer) as month from orders
    )
    select 'live' as published, o_orderkey,
           case when year = 1998 and month in (3, 4) then o_totalprice * 2 else o_totalprice end as o_totalprice, year, month
    from months
    union all
    select 'before', * from months
    union all
    select 'notes', count(*), null, null, null from months group by year, month
    """,
)
def versioned_publish(spark, sf_dir):
    """All months published, two of them delivered again, and a table that is added to; both manifests' rows."""
    output = f"{work_path(spark, 'versioned_publish')}/{uuid.uuid4().hex}"
    months = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_totalprice", "year(o_orderdate) as year", "month(o_orderdate) as month"
    )
    again = months.filter("year = 1998 and month in (3, 4)").withColumn("o_totalprice", F.expr("o_totalprice * 2"))
    manifests = []
    for delivered in (months, again):
        # Notes are taken of the months that are new.
        known = read_published(spark, output, "months") if manifests else months.limit(0)
        notes = delivered.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))
        notes = notes.join(known.select("year", "month").distinct(), ["year", "month"], "left_anti")
        with Publication(spark, output) as new:
            write_table(delivered, new.folder("months"), partition_by=["year", "month"], rebalance=True)
            new.add("months", delivered.schema, partition_by=["year", "month"], mode=PERIODS)
            write_table(notes, new.folder("notes"))
            new.add("notes", notes.schema, mode=APPEND)
            manifests.append(new.complete())
    live, before = (read_published(spark, output, "months", manifest=m) for m in reversed(manifests))
    notes = read_published(spark, output, "notes").selectExpr(
        "'notes' as published", "rows as o_orderkey", "null as o_totalprice", "null as year", "null as month"
    )
    return (
        live.withColumn("published", F.lit("live"))
        .unionByName(before.withColumn("published", F.lit("before")))
        .unionByName(notes)
    )


@query(
    "arriving_files",
    f"""
    with fact as ({shapes.ARRIVALS_SQL}) select cicid, year, month, arrival_date, state_code from fact
    union all
    select -cicid, year, month, arrival_date, state_code from fact where month = 2
    """,
)
def arriving_files(spark, sf_dir):
    """Arrivals brought as files in two goes, then February's once more under other ids; each file is taken once."""
    root = f"{work_path(spark, 'arriving_files')}/{uuid.uuid4().hex}"
    raw = shapes.arrivals_raw(table(spark, sf_dir, "orders"))
    again = raw.filter("i94mon = 2").withColumn("cicid", F.expr("-cicid"))
    for part in (raw.filter("i94mon < 7"), raw.filter("i94mon >= 7"), again):
        part.write.mode("append").parquet(f"{root}/incoming")
        for _ in range(2):  # the second time there is nothing new
            take_arrivals(spark, f"{root}/incoming", f"{root}/output", checkpoint=f"{root}/log", add=True)
    fact = read_published(spark, f"{root}/output", "immigration")
    return fact.select("cicid", "year", "month", "arrival_date", "state_code")


@query("view_select_all", "select * from supplier")
def view_select_all(spark, sf_dir):
    register_views({"supplier": table(spark, sf_dir, "supplier")}, prefix="starmart_")
    return spark.sql("SELECT * FROM starmart_supplier")


@query(
    "null_gate_count",
    "select count(*) as nbr from orders where o_orderpriority = '5-LOW'",
)
def null_gate_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("nullif(o_orderpriority, '5-LOW') as priority")
    register_views({"orders": orders}, prefix="starmart_")
    return spark.sql("SELECT COUNT(*) AS nbr FROM starmart_orders WHERE priority IS NULL")
