"""Quality checks as reports."""

from __future__ import annotations

from starmart.operators.lookup import Lookup
from starmart.operators.quality import Integrity, Rules, integrity_report, quality_report, stage_counts, table_report
from starmart.plans import arrivals
from starmart.queries import shapes
from starmart.queries.registry import query, table


@query(
    "row_count_gate",
    """
    select 'lineitem' as "table", 'row_count' as "check", cast(null as varchar) as "column",
           count(*) as observed, 'error' as severity, count(*) <> 0 as passed
    from lineitem
    """,
)
def row_count_gate(spark, sf_dir):
    return table_report("lineitem", table(spark, sf_dir, "lineitem"), Rules())


@query(
    "null_gate",
    """
    select 'orders' as "table", 'null_count' as "check", 'o_orderkey' as "column",
           count(*) filter (o_orderkey is null) as observed, 'error' as severity,
           count(*) filter (o_orderkey is null) = 0 as passed
    from orders
    union all
    select 'orders', 'null_count', 'priority', count(*) filter (o_orderpriority = '5-LOW'), 'error',
           count(*) filter (o_orderpriority = '5-LOW') = 0
    from orders
    """,
)
def null_gate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderpriority, '5-LOW') as priority"
    )
    report = table_report("orders", orders, Rules(["o_orderkey", "priority"]))
    return report.filter("check = 'null_count'")


@query(
    "quality_report",
    """
    select 'immigration' as "table", 'row_count' as "check", cast(null as varchar) as "column",
           count(*) as observed, 'error' as severity, count(*) <> 0 as passed from orders
    union all
    select 'immigration', 'null_count', 'departure_date', count(*), 'error', count(*) = 0
    from orders where o_orderstatus <> 'P' and o_orderpriority = '1-URGENT'
    union all
    select 'immigration', 'null_count', 'cicid', 0, 'error', true
    union all
    select 'customer', 'row_count', null, count(*), 'warn', count(*) <> 0 from customer
    union all
    select 'customer', 'null_count', 'segment', count(*), 'warn', count(*) = 0
    from customer where c_mktsegment = 'BUILDING'
    """,
)
def report(spark, sf_dir):
    tables = {
        "immigration": arrivals.clean_arrivals(shapes.arrivals_raw(table(spark, sf_dir, "orders"))),
        "customer": table(spark, sf_dir, "customer").selectExpr("nullif(c_mktsegment, 'BUILDING') as segment"),
    }
    rules = {
        "immigration": Rules(["departure_date", "cicid"]),
        "customer": Rules(["segment"], severity="warn"),
    }
    return quality_report(tables, rules)


@query(
    "stage_counts",
    f"""
    select 'read' as stage, count(*) + count(*) filter (c_mktsegment = 'FURNITURE') as rows from customer
    union all
    select 'cleaned', count(*) from ({shapes.DEMOGRAPHIC_SQL})
    """,
)
def counts(spark, sf_dir):
    raw = shapes.demographic_raw(table(spark, sf_dir, "customer"))
    return stage_counts({"read": raw, "cleaned": arrivals.clean_demographic(raw)})


@query(
    "integrity_report",
    """
    with lines as (
        select l_orderkey, l_linenumber, nullif(l_suppkey, 5) as l_suppkey, l_returnflag from lineitem
        union all
        select l_orderkey, l_linenumber, null, null from lineitem where l_orderkey % 40 = 0
    ), found as (
        select 'lines' as "table", 'duplicate_count' as "check", 'l_orderkey, l_linenumber' as "column",
               count(*) - count(distinct (l_orderkey, l_linenumber)) as observed, 'error' as severity from lines
        union all
        select 'lines', 'duplicate_count', 'l_returnflag', count(*) - (select count(*) from (select distinct l_returnflag from lines)),
               'error' from lines
        union all
        select 'lines', 'unmatched_count', 'l_suppkey', count(*) filter (l_suppkey % 10 = 3), 'warn' from lines
        union all
        select 'lines', 'unmatched_count', 'l_returnflag', 0, 'warn'
        union all
        select 'orders', 'duplicate_count', 'o_orderkey', 0, 'error'
    )
    select *, observed = 0 as passed from found
    """,
)
def integrity(spark, sf_dir):
    """Keys that come again, some put in, and codes that a list lacks; a key of whole rows and one of few values."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "nullif(l_suppkey, 5) as l_suppkey", "l_returnflag"
    )
    again = lines.filter("l_orderkey % 40 = 0").selectExpr(
        "l_orderkey", "l_linenumber", "nullif(l_suppkey, l_suppkey) as l_suppkey", "nullif(l_returnflag, l_returnflag) as l_returnflag"
    )
    suppliers = table(spark, sf_dir, "supplier").filter("s_suppkey % 10 <> 3")
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct().selectExpr("l_returnflag as flag", "1 as one")
    references = [
        Lookup("l_suppkey", suppliers, "s_suppkey", "s_name", "supplier"),
        Lookup("l_returnflag", flags, "flag", "one", "flag"),
    ]
    rules = {
        "lines": Integrity([("l_orderkey", "l_linenumber"), ("l_returnflag",)], references),
        "orders": Integrity([("o_orderkey",)]),
    }
    return integrity_report({"lines": lines.unionAll(again), "orders": table(spark, sf_dir, "orders")}, rules)
