"""Counts, profiles, ranges, filters and first rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators import profile
from starmart.queries.registry import query, table


def _patchy_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_orderstatus, 'P') as o_orderstatus",
        "case when o_totalprice >= 100000 then o_totalprice end as o_totalprice",
        "nullif(o_orderpriority, '5-LOW') as o_orderpriority",
        "o_orderdate",
    )


@query("row_count", "select count(*) as rows from lineitem")
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"))


@query(
    "null_profile",
    """
    select 'o_orderkey' as column_name, count(*) filter (o_orderkey is null) as nulls from orders
    union all select 'o_orderstatus', count(*) filter (o_orderstatus = 'P') from orders
    union all select 'o_totalprice', count(*) filter (o_totalprice < 100000) from orders
    union all select 'o_orderpriority', count(*) filter (o_orderpriority = '5-LOW') from orders
    union all select 'o_orderdate', count(*) filter (o_orderdate is null) from orders
    """,
)
def null_profile(spark, sf_dir):
    return profile.null_profile(_patchy_orders(spark, sf_dir))


@query(
    "non_null_profile",
    """
    select 'o_orderkey' as column_name, count(o_orderkey) as non_nulls from orders
    union all select 'o_orderstatus', count(*) filter (o_orderstatus <> 'P') from orders
    union all select 'o_totalprice', count(*) filter (o_totalprice >= 100000) from orders
    union all select 'o_orderpriority', count(*) filter (o_orderpriority <> '5-LOW') from orders
    union all select 'o_orderdate', count(o_orderdate) from orders
    """,
)
def non_null_profile(spark, sf_dir):
    return profile.non_null_profile(_patchy_orders(spark, sf_dir))


@query(
    "group_non_null_counts",
    """
    select o_orderstatus, count(o_orderkey) as o_orderkey,
           count(*) filter (o_totalprice >= 100000) as o_totalprice,
           count(*) filter (o_orderpriority <> '5-LOW') as o_orderpriority,
           count(o_orderdate) as o_orderdate
    from orders where o_orderstatus <> 'P' group by 1
    """,
)
def group_non_null_counts(spark, sf_dir):
    return profile.group_non_null_counts(_patchy_orders(spark, sf_dir), "o_orderstatus")


@query(
    "value_range",
    "select cast(min(l_shipdate) as date) as min_value, cast(max(l_shipdate) as date) as max_value from lineitem",
)
def value_range(spark, sf_dir):
    shipped = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("shipped"))
    return profile.value_range(shipped, "shipped")


@query(
    "footer_profile",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) as rows, cast(min({c}) as varchar) as min_value,
                   cast(max({c}) as varchar) as max_value from lineitem"""
        for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    ),
)
def footer_profile(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"]
    return profile.footer_profile(spark, f"{sf_dir}/lineitem.parquet", columns)


@query(
    "filter_equals",
    "select c_custkey, c_name, c_nationkey from customer where c_mktsegment = 'BUILDING'",
)
def filter_equals(spark, sf_dir):
    rows = profile.where_equals(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")
    return rows.select("c_custkey", "c_name", "c_nationkey")


@query(
    "top_rows",
    """
    select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
    order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey limit 10
    """,
)
def top_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey"]
    return profile.first_rows(rows, 10, order)


@query(
    "schema_profile",
    """
    select 0 as position, 'c_custkey' as column_name, 'bigint' as type, true as nullable,
           count(c_custkey) as non_nulls from customer
    union all select 1, 'c_name', 'string', true, count(c_name) from customer
    union all select 2, 'c_nationkey', 'int', true, count(c_nationkey) from customer
    union all select 3, 'c_acctbal', 'double', true, count(c_acctbal) from customer
    union all select 4, 'c_mktsegment', 'string', true, count(c_mktsegment) from customer
    """,
)
def schema_profile(spark, sf_dir):
    return profile.schema_profile(table(spark, sf_dir, "customer"))
