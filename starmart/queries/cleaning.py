"""Fill, cast, dates, rename, drop, distinct, and the composed cleaners."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.functions import sas_days_to_date, text_to_date
from starmart.operators import clean
from starmart.plans import arrivals
from starmart.queries import shapes
from starmart.queries.registry import query, table


@query(
    "fill_defaults",
    """
    select o_orderkey,
           coalesce(nullif(o_orderstatus, 'P'), '') as o_orderstatus,
           case when o_orderpriority = '5-LOW' then 0 else o_totalprice end as o_totalprice,
           nullif(o_orderpriority, '2-HIGH') as o_orderpriority
    from orders
    """,
)
def fill_defaults(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_orderstatus, 'P') as o_orderstatus",
        "case when o_orderpriority <> '5-LOW' then o_totalprice end as o_totalprice",
        "nullif(o_orderpriority, '2-HIGH') as o_orderpriority",
    )
    # The number given for the text column o_orderpriority has no effect.
    return clean.fill_defaults(raw, {"o_orderstatus": "", "o_totalprice": 0, "o_orderpriority": 99})


@query(
    "cast_to_int",
    """
    select l_orderkey, l_linenumber,
           try_cast(trunc(l_extendedprice) as integer) as l_extendedprice,
           try_cast(trunc(-l_quantity * 1.75) as integer) as l_quantity,
           try_cast(trunc(l_extendedprice * 50000) as integer) as l_tax
    from lineitem
    """,
)
def cast_to_int(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "-l_quantity * 1.75D as l_quantity",
        "l_extendedprice * 50000D as l_tax",
    )
    return clean.cast_columns(raw, dict.fromkeys(("l_extendedprice", "l_quantity", "l_tax"), "int"))


@query(
    "fill_and_cast",
    """
    select p_partkey,
           cast(case when p_type = 'ECONOMY' then 0 else trunc(p_retailprice) end as integer) as p_retailprice,
           cast(case when p_size > 40 then 0 else p_size end as integer) as p_size
    from part
    """,
)
def fill_and_cast(spark, sf_dir):
    raw = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "case when p_type <> 'ECONOMY' then p_retailprice end as p_retailprice",
        "case when p_size <= 40 then cast(p_size as double) end as p_size",
    )
    return clean.fill_and_cast(raw, ["p_retailprice", "p_size"])


@query(
    "sas_days_to_date",
    """
    select l_orderkey, l_linenumber,
           case when l_returnflag = 'N' or l_discount = 0.05 then null
                else cast(l_shipdate as date) end as shipped
    from lineitem
    """,
)
def sas_days(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """case when l_returnflag = 'N' then null
                when l_discount = 0.05D then 1e12
                else datediff(l_shipdate, DATE'1960-01-01') + cast(0.75 as double) end as days""",
    )
    return raw.select("l_orderkey", "l_linenumber", sas_days_to_date(F.col("days")).alias("shipped"))


@query(
    "text_to_date",
    """
    select o_orderkey,
           case when o_orderstatus = 'O' then cast(o_orderdate as date) end as by_month,
           case when o_orderstatus = 'O' then cast(o_orderdate as date) end as by_year
    from orders
    """,
)
def text_dates(spark, sf_dir):
    def text(pattern):
        return f"""case o_orderstatus when 'O' then date_format(o_orderdate, '{pattern}')
                        when 'F' then 'D/S' else '' end"""

    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{text('MMddyyyy')} as by_month", f"{text('yyyyMMdd')} as by_year"
    )
    return raw.withColumns(
        {
            "by_month": text_to_date(F.col("by_month"), "MMddyyyy"),
            "by_year": text_to_date(F.col("by_year"), "yyyyMMdd"),
        }
    )


@query(
    "rename_select",
    "select c_mktsegment as segment, c_custkey as customer, c_nationkey from customer",
)
def rename_select(spark, sf_dir):
    names = {"c_custkey": "customer", "c_mktsegment": "segment", "not_a_column": "ignored"}
    renamed = clean.rename_columns(table(spark, sf_dir, "customer"), names)
    return clean.select_columns(renamed, ["segment", "customer", "c_nationkey"])


@query(
    "drop_incomplete",
    """
    select l_orderkey, l_linenumber, l_quantity, l_returnflag,
           nullif(l_linestatus, 'O') as l_linestatus
    from lineitem where l_quantity <> 7 and l_returnflag <> 'R'
    """,
)
def drop_incomplete(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "nullif(l_quantity, 7D) as l_quantity",
        "nullif(l_returnflag, 'R') as l_returnflag",
        "nullif(l_linestatus, 'O') as l_linestatus",
    )
    return clean.drop_incomplete(raw, ["l_quantity", "l_returnflag"])


@query("distinct_rows", "select distinct o_custkey, o_orderpriority from orders")
def distinct_rows(spark, sf_dir):
    return clean.distinct_rows(table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority"))


@query("clean_arrivals", shapes.ARRIVALS_SQL)
def clean_arrivals(spark, sf_dir):
    return arrivals.clean_arrivals(shapes.arrivals_raw(table(spark, sf_dir, "orders")))


@query("clean_demographic", f"select *, true as id_ok from ({shapes.DEMOGRAPHIC_SQL})")
def clean_demographic(spark, sf_dir):
    raw = shapes.demographic_raw(table(spark, sf_dir, "customer"))
    cleaned, again = (arrivals.clean_demographic(r) for r in (raw, raw.repartition(7)))
    return shapes.with_id_contract(cleaned, again, "id")


@query("clean_temperature", f"select *, true as id_ok from ({shapes.TEMPERATURE_SQL})")
def clean_temperature(spark, sf_dir):
    raw = shapes.temperature_raw(table(spark, sf_dir, "events"))
    cleaned, again = (arrivals.clean_temperature(r) for r in (raw, raw.repartition(7)))
    return shapes.with_id_contract(cleaned, again, "temp_id")
