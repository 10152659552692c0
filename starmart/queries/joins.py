"""Lookups of codes and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators import lookup
from starmart.operators.labels import visa_codes
from starmart.operators.names import enrich_by_similar_name, match_names
from starmart.plans import arrivals
from starmart.queries import shapes
from starmart.queries.registry import query, table
from starmart.sources import literal_table


@query(
    "enrich_by_name",
    """
    select c_custkey, n_name, n_nationkey
    from customer left join nation on c_nationkey + 3 = n_nationkey
    """,
)
def enrich_by_name(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "concat('Nation_', c_nationkey + 3) as country"
    )
    return lookup.enrich_by_name(
        customer,
        "country",
        table(spark, sf_dir, "nation"),
        "n_name",
        ["c_custkey", "n_name", "n_nationkey"],
    )


@query(
    "enrich_temperature",
    f"""
    select date, average_temperature, average_temperature_uncertainty, city,
           country_name, country_code, latitude, longitude
    from ({shapes.TEMPERATURE_SQL}) left join ({shapes.COUNTRY_SQL}) on upper(country) = country_name
    """,
)
def enrich_temperature(spark, sf_dir):
    readings = arrivals.clean_temperature(shapes.temperature_raw(table(spark, sf_dir, "events")))
    codes = shapes.country_codes(table(spark, sf_dir, "nation"))
    return arrivals.enrich_temperature(readings, codes).drop("temp_id")


@query(
    "lookup_codes",
    f"""
    with fact as ({shapes.ARRIVALS_SQL}), countries as ({shapes.COUNTRY_SQL})
    select cicid, c.country_name as citizenship_name, r.country_name as residence_name,
           case i94visa when 1 then 'Business' when 2 then 'Pleasure' when 3 then 'Student' end as visa_category
    from fact left join countries c on cast(citizenship as varchar) = c.country_code
              left join countries r on cast(residence as varchar) = r.country_code
    """,
)
def lookup_codes(spark, sf_dir):
    fact = arrivals.clean_arrivals(shapes.arrivals_raw(table(spark, sf_dir, "orders")))
    countries = shapes.country_codes(table(spark, sf_dir, "nation"))
    named = lookup.lookup_codes(
        fact,
        [
            lookup.Lookup("citizenship", countries, "country_code", "country_name", "citizenship_name"),
            lookup.Lookup("residence", countries, "country_code", "country_name", "residence_name"),
            lookup.Lookup("i94visa", visa_codes(spark), "visa_code", "visa_category", "visa_category"),
        ],
    )
    return named.select("cicid", "citizenship_name", "residence_name", "visa_category")


HOT_SQL = """
    with rows as (
        select l_orderkey, l_linenumber,
               case when l_orderkey % 3 = 0 then '7' when l_orderkey % 11 = 0 then null else cast(l_suppkey as varchar) end as code
        from lineitem
    ), listed as (
        select cast(s_suppkey as varchar) as code, max(name) as name
        from (select s_suppkey, s_name as name from supplier
              union all select s_suppkey, concat('also ', s_name) from supplier where s_suppkey % 2 = 0)
        where s_suppkey % 10 <> 3 group by 1
    )
"""


def _hot_rows(spark, sf_dir):
    """A third of all rows with one code, some with none; and a list that holds every second code twice."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """case when l_orderkey % 3 = 0 then '7' when l_orderkey % 11 = 0 then null
                else cast(l_suppkey as string) end as code""",
    )
    suppliers = table(spark, sf_dir, "supplier").filter("s_suppkey % 10 <> 3")
    also = suppliers.filter("s_suppkey % 2 = 0").selectExpr("s_suppkey", "concat('also ', s_name) as s_name")
    return rows, suppliers.select("s_suppkey", "s_name").unionAll(also)


@query(
    "lookup_doubled_list",
    f"""
    {HOT_SQL} select l_orderkey, l_linenumber, rows.code, name from rows left join listed using (code)
    """,
)
def lookup_doubled_list(spark, sf_dir):
    """A list that holds codes twice does not multiply rows."""
    rows, suppliers = _hot_rows(spark, sf_dir)
    return lookup.lookup_codes(rows, [lookup.Lookup("code", suppliers, "s_suppkey", "s_name", "name")])


@query(
    "lookup_hot_codes",
    f"""
    {HOT_SQL} select l_orderkey, l_linenumber, rows.code, name from rows left join listed using (code)
    """,
)
def lookup_hot_codes(spark, sf_dir):
    """The same with hot codes cut into slices, against a list that comes straight from an aggregate."""
    rows, suppliers = _hot_rows(spark, sf_dir)
    lookups = [lookup.Lookup("code", suppliers, "s_suppkey", "s_name", "name")]
    return lookup.lookup_codes(rows, lookups, spread=True)


@query(
    "conform_hot_codes",
    f"""
    {HOT_SQL} select l_orderkey, l_linenumber, coalesce(listed.code, '99') as code from rows left join listed using (code)
    """,
)
def conform_hot_codes(spark, sf_dir):
    rows, suppliers = _hot_rows(spark, sf_dir)
    listed = suppliers.selectExpr("cast(s_suppkey as string) as s_suppkey")
    return lookup.conform_codes(rows, "code", listed, "s_suppkey", spread=True)


@query(
    "conform_codes",
    """
    select l_orderkey, l_linenumber, coalesce(cast(s_suppkey as varchar), '99') as supplier
    from lineitem left join supplier
         on l_suppkey = s_suppkey and l_returnflag <> 'N' and l_suppkey % 10 <> 0
    """,
)
def conform_codes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        """case when l_returnflag = 'N' then null
                when l_suppkey % 10 = 0 then concat('unlisted ', l_suppkey)
                else cast(l_suppkey as string) end as supplier""",
    )
    listed = table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as string) as code")
    # A code that comes twice in the list must not double the rows.
    listed = listed.unionAll(listed)
    return lookup.conform_codes(rows, "supplier", listed, "code")


@query(
    "unmatched_codes",
    """
    select 'l_suppkey' as column_name, cast(-1 - l_suppkey as varchar) as code, count(*) as rows
    from lineitem where l_suppkey % 10 = 0
    group by 2
    union all
    select 'l_returnflag', nullif(l_returnflag, 'R'), count(*)
    from lineitem where l_returnflag in ('N', 'R') group by 2
    """,
)
def unmatched_codes(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_suppkey % 10 = 0, -1 - l_suppkey, l_suppkey) as l_suppkey", "nullif(l_returnflag, 'R') as l_returnflag"
    )
    suppliers = table(spark, sf_dir, "supplier")
    flags = literal_table(spark, [("A", "accepted")], ["flag", "flag_name"])
    return lookup.unmatched_codes(
        rows,
        [
            lookup.Lookup("l_suppkey", suppliers, "s_suppkey", "s_name", "supplier"),
            lookup.Lookup("l_returnflag", flags, "flag", "flag_name", "flag_name"),
        ],
    )


# Names as readers write them, and labels as lists do: a nation, one of many of a region, one with a word too much,
# and none at all.
NAMES_SQL = """
    select c_custkey, case c_custkey % 5
               when 0 then concat('Nation ', c_nationkey)
               when 1 then concat('the nation, ', lower(r_name))
               when 2 then concat('Nation_', c_nationkey, ' of Nowhere')
               when 3 then concat('Atlantis ', c_nationkey + 100)
               else concat('NATION_', c_nationkey, ' (', r_name, ')') end as country
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""
LABELS_SQL = """
    select n_nationkey as code, concat(n_name, ' (', r_name, ')') as label
    from nation join region on n_regionkey = r_regionkey
    union all
    select n_nationkey + 50, concat('INVALID: ', n_name, ' THE OLD ONE') from nation where n_nationkey % 3 = 0
"""
WORDS_SQL = """list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> ''))"""
# Every name beside every label: what the operator finds without that.
SIMILAR_SQL = f"""
    names as ({NAMES_SQL}), labels as ({LABELS_SQL}),
    sets as (select distinct country, {WORDS_SQL.format("country")} as own from names),
    listed as (select distinct code, label, {WORDS_SQL.format("label")} as words from labels),
    pairs as (
        select country, code, label, len(list_intersect(own, words)) as shared, len(words) as size
        from sets, listed where len(list_intersect(own, words)) >= 0.6 * len(own)
    ),
    ranked as (
        select *, rank() over (partition by country order by shared desc, size) as nth from pairs
    ),
    best as (
        select country, max(shared) as shared, count(*) as n_best, min(code) as code, min(label) as label
        from ranked where nth = 1 group by country
    )
"""


def _names_and_labels(spark, sf_dir):
    for name in ("customer", "nation", "region"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"starmart_{name}")
    as_views = lambda sql: spark.sql(
        sql.replace("customer join", "starmart_customer join")
        .replace("from nation", "from starmart_nation")
        .replace("join nation", "join starmart_nation")
        .replace("join region", "join starmart_region")
    )
    return as_views(NAMES_SQL), as_views(LABELS_SQL)


@query(
    "match_names",
    f"""
    with {SIMILAR_SQL}
    select country, case when n_best = 1 then 'similar' when n_best > 1 then 'tie' else 'none' end as status,
           cast(coalesce(shared, 0) as integer) as shared, coalesce(n_best, 0) as n_best,
           case when n_best = 1 then code end as code, case when n_best = 1 then label end as label
    from sets left join best using (country)
    """,
)
def names_matched(spark, sf_dir):
    """Distinct names against a list that writes them otherwise: unique best matches, ties, and none."""
    names, labels = _names_and_labels(spark, sf_dir)
    found = match_names(names, "country", labels, "label", least=0.6)
    return found.select("country", "status", "shared", "n_best", "match.code", "match.label")


@query(
    "enrich_by_similar_name",
    f"""
    with {SIMILAR_SQL}
    select c_custkey, country, coalesce(l.code, case when n_best = 1 then best.code end) as code
    from names left join labels l on upper(country) = l.label left join best using (country)
    """,
)
def similar_names(spark, sf_dir):
    """All rows with the code of their name: the equal one, else the one that is most similar."""
    names, labels = _names_and_labels(spark, sf_dir)
    return enrich_by_similar_name(names, "country", labels, "label", ["c_custkey", "country", "code"], least=0.6)
