"""Star queries, and the whole build."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.labels import visa_codes
from starmart.plans import arrivals, build
from starmart.plans import star as plans
from starmart.queries import shapes
from starmart.queries.registry import query, table, work_path
from starmart.sources import literal_table, write_table


@query(
    "star_counts",
    """
    select r_name, n_name, c_mktsegment, count(*) as items
    from lineitem join orders on l_orderkey = o_orderkey
                  join customer on o_custkey = c_custkey
                  join nation on c_nationkey = n_nationkey
                  join region on n_regionkey = r_regionkey
    group by all
    """,
)
def star_counts(spark, sf_dir):
    """Items per region, nation and segment.

    Counted per order, then per customer, each before the next join: a key with a third
    of all items is one row by the time it is shuffled.
    """
    per_order = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("items"))
    )
    per_customer = (
        table(spark, sf_dir, "orders")
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("items").alias("items"))
    )
    per_nation = (
        table(spark, sf_dir, "customer")
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey", "c_mktsegment")
        .agg(F.sum("items").alias("items"))
    )
    return (
        per_nation.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("r_name", "n_name", "c_mktsegment", "items")
    )


def _fact(spark, sf_dir, **options):
    return arrivals.clean_arrivals(shapes.arrivals_raw(table(spark, sf_dir, "orders")), **options)


def _tables(spark, sf_dir):
    return {
        "country_codes": shapes.country_codes(table(spark, sf_dir, "nation")),
        "port_codes": literal_table(
            spark, [("URG", "Urgent Bay"), ("HIG", "High Point"), ("LOW", "Low Cove")], ["port_code", "port_name"]
        ),
        "mode_codes": literal_table(spark, [("1", "Air"), ("2", "Sea"), ("3", "Land")], ["mode_code", "mode_name"]),
        "state_codes": table(spark, sf_dir, "nation").selectExpr(
            "concat('S', n_nationkey) as state_code", "concat('STATE ', n_nationkey) as state_name"
        ),
        "visa_codes": visa_codes(spark),
    }


PORT_NAME_SQL = """case port when 'URG' then 'Urgent Bay' when 'HIG' then 'High Point'
                             when 'LOW' then 'Low Cove' end"""
MODE_NAME_SQL = "case mode when 1 then 'Air' when 2 then 'Sea' when 3 then 'Land' end"
VISA_NAME_SQL = "case i94visa when 1 then 'Business' when 2 then 'Pleasure' when 3 then 'Student' end"


@query(
    "arrivals_by_dimension",
    f"""
    select residence, mode, i94visa, port, state_code, count(*) as arrivals,
           any_value(country_name) as residence_name, any_value({PORT_NAME_SQL}) as port_name,
           any_value({MODE_NAME_SQL}) as mode_name, any_value({VISA_NAME_SQL}) as visa_category,
           any_value(case when try_cast(substr(state_code, 2) as integer) < 25
                          then 'STATE ' || substr(state_code, 2) end) as state_name
    from ({shapes.ARRIVALS_SQL}) left join ({shapes.COUNTRY_SQL}) on cast(residence as varchar) = country_code
    group by residence, mode, i94visa, port, state_code
    """,
)
def arrivals_by_dimension(spark, sf_dir):
    keys = ["residence", "mode", "i94visa", "port", "state_code"]
    return plans.arrivals_by(_fact(spark, sf_dir), _tables(spark, sf_dir), keys)


@query(
    "arrivals_by_renamed_visa",
    f"""
    select i94visa as visa_code, mode, count(*) as arrivals, any_value({MODE_NAME_SQL}) as mode_name,
           any_value({VISA_NAME_SQL}) as visa_category
    from ({shapes.ARRIVALS_SQL}) group by i94visa, mode
    """,
)
def arrivals_by_renamed_visa(spark, sf_dir):
    return plans.arrivals_by(_fact(spark, sf_dir, rename_visa=True), _tables(spark, sf_dir), ["visa_code", "mode"])


UNMATCHED_SQL = f"""
    with fact as ({shapes.ARRIVALS_SQL})
    select 'citizenship' as column_name, cast(citizenship as varchar) as code, count(*) as rows
    from fact where citizenship >= 25 group by 2
    union all select 'residence', cast(residence as varchar), count(*) from fact where residence >= 25 group by 2
    union all select 'port', port, count(*) from fact where port not in ('URG', 'HIG', 'LOW') group by 2
    union all select 'mode', cast(mode as varchar), count(*) from fact where mode not in (1, 2, 3) group by 2
    union all select 'state_code', state_code, count(*) from fact
              where state_code = '' or cast(substr(state_code, 2) as integer) >= 25 group by 2
    union all select 'i94visa', cast(i94visa as varchar), count(*) from fact where i94visa > 3 group by 2
"""


@query("unmatched_report", UNMATCHED_SQL)
def unmatched_report(spark, sf_dir):
    return plans.unmatched(_fact(spark, sf_dir), _tables(spark, sf_dir))


@query("unmatched_renamed_visa", UNMATCHED_SQL.replace("'i94visa'", "'visa_code'"))
def unmatched_renamed_visa(spark, sf_dir):
    return plans.unmatched(_fact(spark, sf_dir, rename_visa=True), _tables(spark, sf_dir))


@query(
    "state_profile_join",
    f"""
    with fact as ({shapes.ARRIVALS_SQL}),
         cities as (select distinct state_code, city, total_population, male_population, female_population,
                                    number_of_veterans, foreign_born from ({shapes.DEMOGRAPHIC_SQL})),
         states as (select state_code, count(*) as cities,
                           cast(sum(total_population) as bigint) as total_population,
                           cast(sum(male_population) as bigint) as male_population,
                           cast(sum(female_population) as bigint) as female_population,
                           cast(sum(number_of_veterans) as bigint) as number_of_veterans,
                           cast(sum(foreign_born) as bigint) as foreign_born
                    from cities group by 1)
    select state_code, arrivals, cities, total_population, male_population, female_population,
           number_of_veterans, foreign_born
    from (select state_code, count(*) as arrivals from fact group by 1) left join states using (state_code)
    """,
)
def state_profile_join(spark, sf_dir):
    demographic = arrivals.clean_demographic(shapes.demographic_raw(table(spark, sf_dir, "customer")))
    return plans.arrivals_and_population(_fact(spark, sf_dir), demographic)


@query(
    "month_climate_join",
    f"""
    with fact as ({shapes.ARRIVALS_SQL}), countries as ({shapes.COUNTRY_SQL}),
         climate as (select country_code, cast(month(date) as integer) as month,
                            avg(average_temperature) as mean_temperature, count(*) as readings
                     from ({shapes.TEMPERATURE_SQL}) join countries on upper(country) = country_name group by 1, 2)
    select country_code, month, arrivals, mean_temperature, readings
    from (select cast(residence as varchar) as country_code, month, count(*) as arrivals from fact group by 1, 2)
         left join climate using (country_code, month)
    """,
)
def month_climate_join(spark, sf_dir):
    countries = shapes.country_codes(table(spark, sf_dir, "nation"))
    readings = arrivals.clean_temperature(shapes.temperature_raw(table(spark, sf_dir, "events")))
    return plans.arrivals_and_climate(
        _fact(spark, sf_dir), arrivals.enrich_temperature(readings, countries)
    )


@query(
    "stay_length",
    """
    select cast(cast(shipped as date) - cast(o_orderdate as date) as integer) as days, count(*) as arrivals
    from orders join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by 1)
         on l_orderkey = o_orderkey
    group by 1
    """,
)
def stay_length(spark, sf_dir):
    """From an order to its last shipment; an order without one gets the stand-in date."""
    last = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    stays = (
        table(spark, sf_dir, "orders")
        .join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .selectExpr(
            "cast(o_orderdate as date) as arrival_date",
            "coalesce(cast(shipped as date), DATE'1960-01-01') as departure_date",
        )
    )
    return plans.stay_length(stays)


@query(
    "stay_quantiles",
    """
    with stays as (
        select o_custkey % 30 as residence, cast(shipped as date) - cast(o_orderdate as date) as days
        from orders join (select l_orderkey, max(l_shipdate) as shipped from lineitem group by 1)
             on l_orderkey = o_orderkey
    )
    select cast(residence as integer) as residence, count(*) as stays, p as rank, true as near from stays, (values (0.1::double), (0.5), (0.9)) t(p)
    group by residence, p
    """,
)
def stay_quantiles(spark, sf_dir):
    """Quantiles by residence from sketches by residence and month; the exact rank of each lies within the bound."""
    last = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("shipped"))
    stays = table(spark, sf_dir, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey")).selectExpr(
        "cast(o_custkey % 30 as int) as residence", "year(o_orderdate) as year", "month(o_orderdate) as month",
        "cast(o_orderdate as date) as arrival_date", "cast(shipped as date) as departure_date",
    )
    at = (0.1, 0.5, 0.9)
    found = plans.stay_quantiles(plans.stay_sketches(stays), at=at)
    ranks = found.select("residence", "stays", F.posexplode("days").alias("n", "found"))
    ranks = ranks.withColumn("rank", F.array(*map(F.lit, at))[F.col("n")])
    lengths = stays.groupBy("residence", F.date_diff("departure_date", "arrival_date").alias("days")).count()
    exact = (
        ranks.join(lengths, "residence")
        .groupBy("residence", "stays", "rank")
        .agg(
            F.sum(F.when(F.col("days") < F.col("found"), F.col("count")).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("days") <= F.col("found"), F.col("count")).otherwise(0)).alias("upto"),
        )
    )
    near = (F.col("below") <= (F.col("rank") + 0.02) * F.col("stays")) & (F.col("upto") >= (F.col("rank") - 0.02) * F.col("stays"))
    return exact.select("residence", "stays", "rank", near.alias("near"))


@query(
    "arrivals_margins",
    f"""
    with fact as ({shapes.ARRIVALS_SQL}), margins as (
        select residence, mode, i94visa, port, state_code, count(*) as arrivals,
               grouping(residence, mode, i94visa, port, state_code) as grouping
        from fact group by grouping sets ((residence), (mode), (i94visa), (port), (state_code), ())
    )
    select residence, mode, i94visa, port, state_code, arrivals, cast(grouping as bigint) as grouping,
           country_name as residence_name, {PORT_NAME_SQL} as port_name, {MODE_NAME_SQL} as mode_name,
           {VISA_NAME_SQL} as visa_category,
           case when try_cast(substr(state_code, 2) as integer) < 25 then 'STATE ' || substr(state_code, 2) end as state_name
    from margins left join ({shapes.COUNTRY_SQL}) on cast(residence as varchar) = country_code
    """,
)
def arrivals_margins(spark, sf_dir):
    """Arrivals by each dimension alone, and in all, from one pass over the fact."""
    keys = ["residence", "mode", "i94visa", "port", "state_code"]
    return plans.arrivals_margins(_fact(spark, sf_dir), _tables(spark, sf_dir), keys)


DICTIONARY = (
    "value i94cntyl\n"
    + "\n".join(f"   {n} =  'NATION_{n}'" for n in range(25))
    + " ;\n"
    + "value $i94prtl\n\t'URG'\t=\t'URGENT BAY  '\n\t'HIG'\t=\t'HIGH POINT'\n;\n"
    + "value i94model\n\t1 = 'Air'\n\t2 = 'Sea'\n\t9 = 'Not reported' ;\n"
    + "value i94addrl\n\t'S1'='STATE 1'\n\t'99'='All Other Codes' ;\nrun ;\n"
)


def _content(columns: Sequence[str], decimals: Sequence[str] = ()) -> str:
    """SQL of both engines: a row's values as one text, fractions cut to four places."""
    values = (f"cast(floor({c} * 10000) as bigint)" if c in decimals else c for c in columns)
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({v} as {{text}}), '-')" for v in values) + ")"


CONTENTS = {
    "immigration": _content(
        [c.final for c in S.ARRIVALS if c.final not in ("year", "month")] + ["year", "month"], ["admnum"]
    ),
    "demographic": _content([c.final for c in S.DEMOGRAPHIC], ["median_age", "average_household_size"]),
    "temperature": _content(
        S.TEMPERATURE_OUTPUT[1:], ["average_temperature", "average_temperature_uncertainty"]
    ),
    "country_codes": _content(["country_code", "country_name"]),
    "port_codes": _content(["port_code", "port_name"]),
    "mode_codes": _content(["mode_code", "mode_name"]),
    "state_codes": _content(["state_code", "state_name"]),
    "visa_codes": _content(["visa_code", "visa_category"]),
}
IDS = {"demographic": "id", "temperature": "temp_id", **{item.table: "id" for item in (*S.CODE_LISTS, S.VISA_LIST)}}
EXPECTED = {
    "immigration": shapes.ARRIVALS_SQL,
    "demographic": shapes.DEMOGRAPHIC_SQL,
    "temperature": f"""
        select *, case when nation < 25 then 'NATION_' || nation end as country_name,
               case when nation < 25 then nation::varchar end as country_code
        from (select *, substr(country, 8)::integer as nation from ({shapes.TEMPERATURE_SQL}))
    """,
    "country_codes": "select n as country_code, 'NATION_' || n as country_name from range(25) t(n)",
    "port_codes": "select * from (values ('URG', 'URGENT BAY'), ('HIG', 'HIGH POINT')) t(port_code, port_name)",
    "mode_codes": "select * from (values (1, 'Air'), (2, 'Sea'), (9, 'Not reported')) t(mode_code, mode_name)",
    "state_codes": "select * from (values ('S1', 'STATE 1'), ('99', 'All Other Codes')) t(state_code, state_name)",
    "visa_codes": "select * from (values (1, 'Business'), (2, 'Pleasure'), (3, 'Student')) t(visa_code, visa_category)",
}


@query(
    "star_build",
    " union all ".join(
        f"select '{name}' as stage, {content.format(text='varchar')} as content, true as ids_ok from ({EXPECTED[name]})"
        for name, content in CONTENTS.items()
    ),
)
def star_build(spark, sf_dir):
    """The whole build on whole tables: every row of every published table, and whether its ids keep their contract."""
    root = work_path(spark, "star_build")
    literal_table(spark, [(DICTIONARY,)], ["value"]).coalesce(1).write.mode("overwrite").text(
        f"{root}/labels", lineSep="\n"
    )
    write_table(shapes.arrivals_raw(table(spark, sf_dir, "orders")), f"{root}/arrivals")
    for name, df, sep in (
        ("demographic", shapes.demographic_raw(table(spark, sf_dir, "customer")), ";"),
        ("temperature", shapes.temperature_raw(table(spark, sf_dir, "events")), ","),
    ):
        df.write.mode("overwrite").option("header", True).option("sep", sep).csv(f"{root}/{name}")
    result = build.build_star(
        spark,
        build.StarConfig(
            labels=f"{root}/labels",
            arrivals=f"{root}/arrivals",
            demographic=f"{root}/demographic",
            temperature=f"{root}/temperature",
            output=f"{root}/output",
            monthly=True,
            warn_only=("temperature",),
        ),
    )
    parts = []
    for name, content in CONTENTS.items():
        df, ok = result.tables[name], F.lit(True)
        if name in IDS:
            owners = df.groupBy(IDS[name]).agg(F.count(F.lit(1)).alias("_owners"))
            df = df.join(owners, IDS[name], "left")
            ok = F.coalesce((F.col(IDS[name]) >= 0) & (F.col("_owners") == 1), F.lit(False))
        parts.append(
            df.select(
                F.lit(name).alias("stage"),
                F.expr(content.format(text="string")).alias("content"),
                ok.alias("ids_ok"),
            )
        )
    return reduce(DataFrame.unionAll, parts)
