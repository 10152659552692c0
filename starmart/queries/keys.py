"""Surrogate ids, checked by contract: unique, not negative, the same under another partitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators.clean import distinct_rows
from starmart.operators.keys import assign_kept_ids, new_keys, rows_with_kept_ids, with_surrogate_id
from starmart.queries import shapes
from starmart.queries.registry import query, table, work_path
from starmart.sources import read_table, write_table


@query(
    "surrogate_id",
    """
    select distinct o_custkey, nullif(o_orderpriority, '5-LOW') as priority, o_orderstatus, true as id_ok from orders
    """,
)
def surrogate_id(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey", "nullif(o_orderpriority, '5-LOW') as priority", "o_orderstatus"
    )
    ids, again = (with_surrogate_id(distinct_rows(r), distinct=True) for r in (rows, rows.repartition(7)))
    return shapes.with_id_contract(ids, again, "id")


@query("surrogate_id_copies", "select l_suppkey, l_returnflag, true as id_ok from lineitem")
def surrogate_id_copies(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag")
    ids, again = (with_surrogate_id(r) for r in (rows, rows.repartition(7)))
    return shapes.with_id_contract(ids, again, "id")


@query(
    "surrogate_id_contract",
    """
    select count(*) as rows, count(*) as ids, count(*) as distinct_ids, true as never_negative from lineitem
    """,
)
def surrogate_id_contract(spark, sf_dir):
    """The id by content hash: non-null, unique and not negative on a whole table with copies."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_quantity")
    ids = with_surrogate_id(rows).groupBy("id").count()
    return ids.selectExpr(
        "sum(count) as rows",
        "sum(case when id is not null then count else 0 end) as ids",
        "count(id) as distinct_ids",
        "min(id) >= 0 as never_negative",
    )


def _two_refreshes(spark, name, first, rows, distinct):
    """Rows of a first refresh and of a second one with their ids, by way of the key map."""
    path, ids, known = work_path(spark, name), [], None
    for number, df in enumerate((first, rows)):
        write_table(assign_kept_ids(df, known, distinct=distinct), f"{path}/{number}")
        assigned = read_table(spark, f"{path}/{number}")
        known = new_keys(assigned)
        ids.append(rows_with_kept_ids(assigned, distinct=distinct))
    return ids


@query(
    "kept_ids",
    """
    with rows as (
        select distinct o_custkey, nullif(o_orderpriority, '5-LOW') as priority, o_orderstatus from orders
    ), first as (
        select distinct o_custkey, nullif(o_orderpriority, '5-LOW') as priority, o_orderstatus
        from orders where o_orderdate < date '1996-01-01'
    )
    select rows.*, first.o_custkey is not null as known_before, true as id_ok
    from rows left join first on rows.o_custkey = first.o_custkey and rows.o_orderstatus = first.o_orderstatus
         and rows.priority is not distinct from first.priority
    """,
)
def kept_ids(spark, sf_dir):
    """Ids given to a first part of the orders, then to all: who was known keeps the id, and all ids differ."""
    orders = table(spark, sf_dir, "orders")
    part = orders.filter("o_orderdate < DATE'1996-01-01'")
    first, rows = (
        distinct_rows(df.selectExpr("o_custkey", "nullif(o_orderpriority, '5-LOW') as priority", "o_orderstatus"))
        for df in (part, orders)
    )
    first, rows = _two_refreshes(spark, "kept_ids", first, rows, True)
    same = [rows[c].eqNullSafe(first[c]) for c in ("o_custkey", "priority", "o_orderstatus")]
    owners = rows.groupBy("id").agg(F.count(F.lit(1)).alias("owners"))
    return (
        rows.join(first.withColumnRenamed("id", "old_id"), same, "left")
        .select(*(rows[c] for c in rows.columns), "old_id")
        .join(owners, "id")
        .selectExpr(
            "o_custkey", "priority", "o_orderstatus", "old_id is not null as known_before",
            "id >= 0 and owners = 1 and (old_id is null or old_id = id) as id_ok",
        )
    )


@query(
    "kept_ids_copies",
    """
    select l_suppkey, l_returnflag, count(*) as rows, count(*) as ids,
           count(*) filter (where l_shipdate < date '1996-01-01') as known_before,
           count(*) filter (where l_shipdate < date '1996-01-01') as kept
    from lineitem group by all
    """,
)
def kept_ids_copies(spark, sf_dir):
    """The same of rows that come many times: as many copies keep their ids as there were before."""
    lines = table(spark, sf_dir, "lineitem")
    part = lines.filter("l_shipdate < DATE'1996-01-01'")
    first, rows = (df.select("l_suppkey", "l_returnflag") for df in (part, lines))
    first, rows = _two_refreshes(spark, "kept_ids_copies", first, rows, False)
    # In a stated number of partitions: ids shrink well in a shuffle, and adaptive execution goes by what is shuffled.
    tasks, keys = int(spark.conf.get("spark.sql.shuffle.partitions")), ["l_suppkey", "l_returnflag", "id"]
    before = first.withColumn("before", F.lit(1)).repartition(tasks, *keys)
    both = rows.repartition(tasks, *keys).join(before, keys, "left")
    lost = first.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("known_before"))
    return (
        both.groupBy("l_suppkey", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"), F.count("before").alias("kept"))
        .join(lost, ["l_suppkey", "l_returnflag"], "left")
        .fillna(0, ["known_before"])
    )
