"""The driver's tables in the shape of the star's inputs.

The tables hold no NULL and no bad value, so both are put in by rules on the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL_DAY = "datediff(o_orderdate, DATE'1960-01-01')"


def arrivals_raw(orders: DataFrame) -> DataFrame:
    """Orders as raw arrival records, one for one."""
    return orders.selectExpr(
        "cast(o_orderkey as double) as cicid",
        "cast(year(o_orderdate) as double) as i94yr",
        "cast(month(o_orderdate) as double) as i94mon",
        "case when o_orderpriority <> '5-LOW' then cast(o_custkey % 25 as double) end as i94cit",
        "case when o_orderstatus <> 'P' then cast(o_custkey % 30 as double) end as i94res",
        "substr(o_orderpriority, 3, 3) as i94port",
        f"{ARRIVAL_DAY} + cast(0.5 as double) as arrdate",
        "case o_orderstatus when 'F' then 1D when 'O' then 2D end as i94mode",
        "case when o_orderpriority <> '5-LOW' then concat('S', o_custkey % 28) end as i94addr",
        f"""case when o_orderstatus = 'P' then null
                 when o_orderpriority = '1-URGENT' then 1e12
                 else {ARRIVAL_DAY} + floor(o_totalprice / 10000) end as depdate""",
        "case when o_totalprice >= 50000 then cast(floor(o_totalprice / 10000) as double) end as i94bir",
        "cast(substr(o_orderpriority, 1, 1) as double) as i94visa",
        "1D as count",
        "case when o_orderstatus <> 'P' then date_format(o_orderdate, 'yyyyMMdd') end as dtadfile",
        "nullif(o_orderstatus, 'O') as visapost",
        "cast(null as string) as occup",
        "'G' as entdepa",
        "nullif(o_orderstatus, 'P') as entdepd",
        "cast(null as string) as entdepu",
        "case when o_orderstatus = 'F' then 'M' end as matflag",
        """case when o_totalprice >= 50000
                then cast(year(o_orderdate) - floor(o_totalprice / 10000) as double) end as biryear""",
        """case o_orderstatus when 'F' then 'D/S' when 'O' then '20013102'
                else date_format(o_orderdate, 'MMddyyyy') end as dtaddto""",
        "nullif(o_orderstatus, 'F') as gender",
        "cast(null as string) as insnum",
        "substr(o_orderpriority, 3) as airline",
        "o_totalprice as admnum",
        "cast(o_custkey as string) as fltno",
        "o_orderpriority as visatype",
    )


def _twice(rows: DataFrame, condition: str) -> DataFrame:
    """Rows meeting the condition come twice, without a second scan."""
    copies = F.expr(f"array_repeat(0, if({condition}, 2, 1))")
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def demographic_raw(customer: DataFrame) -> DataFrame:
    """Customers as city demographics; a city's totals repeat, and one segment comes twice."""
    city = "(c_custkey div 4)"
    rows = customer.selectExpr(
        f"concat('City ', {city}) as City",
        "concat('State ', c_nationkey) as State",
        "case when c_mktsegment <> 'BUILDING' then c_acctbal end as `Median Age`",
        f"cast(case when c_mktsegment <> 'MACHINERY' then {city} % 1000 end as int) as `Male Population`",
        f"cast({city} % 900 as int) as `Female Population`",
        f"cast({city} % 1000 + {city} % 900 as int) as `Total Population`",
        f"cast({city} % 70 as int) as `Number of Veterans`",
        f"cast({city} % 300 as int) as `Foreign-born`",
        "case when c_acctbal >= 0 then 2.5D end as `Average Household Size`",
        "concat('S', c_nationkey) as `State Code`",
        "c_mktsegment as Race",
        "cast(c_custkey % 2 as int) as Count",
    )
    return _twice(rows, "Race = 'FURNITURE'")


def temperature_raw(events: DataFrame) -> DataFrame:
    """Events as temperature readings spread over the year, many of them twice.

    Temperatures are cut to quarters, so that their sums are exact in any order.
    """
    rows = events.selectExpr(
        "date_add(cast(ts as date), cast(event_id % 365 as int)) as dt",
        "case when event_type <> 'error' then floor(value * 4) / 4 end as AverageTemperature",
        "case when event_type <> 'signup' then value / 8 end as AverageTemperatureUncertainty",
        "concat('City ', user_id) as City",
        "concat('Nation_', user_id % 28) as Country",
        "concat(user_id % 90, '.5N') as Latitude",
        "concat(user_id % 180, '.5E') as Longitude",
    )
    return _twice(rows, "AverageTemperature > 5")


def country_codes(nation: DataFrame) -> DataFrame:
    return nation.selectExpr("cast(n_nationkey as string) as country_code", "n_name as country_name")


def with_id_contract(df: DataFrame, again: DataFrame, id_column: str) -> DataFrame:
    """The other columns, and ``id_ok``: the id is there, not negative, of this row only, and the same in ``again``.

    Both tables are dealt by id once and counted in windows, in a stated number of partitions: ids shrink well in a
    shuffle, and adaptive execution would size tasks by what is shuffled.
    """
    others = [c for c in df.columns if c != id_column]
    row = F.xxhash64(*(F.col(f"`{c}`") for c in others)).alias("_row")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = df.select("*", row, F.lit(1).alias("_own")).unionByName(
        again.select(F.col(id_column), row, F.lit(0).alias("_own")), allowMissingColumns=True
    )
    twins = F.sum(1 - F.col("_own")).over(Window.partitionBy(id_column, "_row"))
    owners = F.sum("_own").over(Window.partitionBy(id_column))
    return (
        both.repartition(tasks, id_column)
        .withColumn("_twins", twins)
        .withColumn("_owners", owners)
        .where("_own = 1")
        .select(
            *others,
            F.coalesce(
                (F.col(id_column) >= 0) & (F.col("_twins") == 1) & (F.col("_owners") == 1), F.lit(False)
            ).alias("id_ok"),
        )
    )


# The same inputs for the checking SQL.
ARRIVALS_SQL = """
select cast(o_orderkey as integer) as cicid,
       cast(year(o_orderdate) as integer) as year,
       cast(month(o_orderdate) as integer) as month,
       cast(case when o_orderpriority = '5-LOW' then 999 else o_custkey % 25 end as integer) as citizenship,
       cast(case when o_orderstatus = 'P' then 999 else o_custkey % 30 end as integer) as residence,
       substr(o_orderpriority, 3, 3) as port,
       cast(o_orderdate as date) as arrival_date,
       cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 9 end as integer) as mode,
       case when o_orderpriority = '5-LOW' then '' else 'S' || (o_custkey % 28) end as state_code,
       case when o_orderstatus = 'P' then date '1960-01-01'
            when o_orderpriority = '1-URGENT' then null
            else cast(o_orderdate as date) + cast(floor(o_totalprice / 10000) as integer)
       end as departure_date,
       cast(case when o_totalprice >= 50000 then floor(o_totalprice / 10000) else 0 end as integer) as age,
       cast(substr(o_orderpriority, 1, 1) as integer) as i94visa,
       1 as count,
       case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as dtadfile,
       case when o_orderstatus = 'O' then '' else o_orderstatus end as visapost,
       '' as occup,
       'G' as entdepa,
       case when o_orderstatus = 'P' then '' else o_orderstatus end as entdepd,
       '' as entdepu,
       case when o_orderstatus = 'F' then 'M' else '' end as matflag,
       cast(case when o_totalprice >= 50000
                 then year(o_orderdate) - floor(o_totalprice / 10000) else 0 end as integer) as birth_year,
       case when o_orderstatus = 'P' then cast(o_orderdate as date) end as dtaddto,
       case when o_orderstatus = 'F' then '' else o_orderstatus end as gender,
       '' as insnum,
       substr(o_orderpriority, 3) as airline,
       o_totalprice as admnum,
       cast(o_custkey as varchar) as fltno,
       o_orderpriority as visa_type
from orders
"""

DEMOGRAPHIC_SQL = """
select distinct 'City ' || (c_custkey // 4) as city,
       'State ' || c_nationkey as state_name,
       case when c_mktsegment <> 'BUILDING' then c_acctbal end as median_age,
       cast((c_custkey // 4) % 1000 as integer) as male_population,
       cast((c_custkey // 4) % 900 as integer) as female_population,
       cast((c_custkey // 4) % 1000 + (c_custkey // 4) % 900 as integer) as total_population,
       cast((c_custkey // 4) % 70 as integer) as number_of_veterans,
       cast((c_custkey // 4) % 300 as integer) as foreign_born,
       cast(2.5 as double) as average_household_size,
       'S' || c_nationkey as state_code,
       c_mktsegment as race,
       cast(c_custkey % 2 as integer) as count
from customer
where c_mktsegment <> 'MACHINERY' and c_acctbal >= 0
"""

TEMPERATURE_SQL = """
select distinct cast(ts as date) + cast(event_id % 365 as integer) as date,
       floor(value * 4) / 4 as average_temperature,
       value / 8 as average_temperature_uncertainty,
       'City ' || user_id as city,
       'Nation_' || (user_id % 28) as country,
       (user_id % 90) || '.5N' as latitude,
       (user_id % 180) || '.5E' as longitude
from events
where event_type not in ('error', 'signup')
"""

COUNTRY_SQL = "select cast(n_nationkey as varchar) as country_code, n_name as country_name from nation"
