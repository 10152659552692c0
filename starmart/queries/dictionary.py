"""Code lists out of dictionary texts, one text per part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators import labels
from starmart.queries.registry import query, table, work_path
from starmart.sources import read_dictionary, read_dictionary_lines, read_table, write_table

RECORD_SEPARATOR = "\x1e"


def _texts(spark, sf_dir):
    """A text with four sections per part: odd spacing, a repeated code, a value with ``=``."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.format_string(
            "/* PART %s */\n"
            "value i94cntyl\n   %s =  '%s  '\n   brand = 'replaced later'\n   two=a=b\n   brand =  '%s' ;\n\n"
            "value $i94prtl\n\t'%s '\t=\t'%s, PORT     '\n;\n"
            "value i94model\r\n\t1 = 'Air'\r\n\t%d = 'Size' ;\r\n"
            "value i94addrl\n\t'AL'='%s'\n\t'99'='All Other Codes' ;\nrun ;\n",
            F.col("p_partkey").cast("string"),
            "p_type",
            "p_name",
            "p_brand",
            F.substring("p_type", 1, 3),
            "p_name",
            F.col("p_size") + 10,
            "p_brand",
        ).alias("value"),
    )


CODE_LIST_SQL = """
    select p_partkey, p_type as code, p_name as name from part
    union all select p_partkey, 'brand', p_brand from part
"""


@query("code_list", CODE_LIST_SQL)
def code_list(spark, sf_dir):
    return labels.extract_code_list(_texts(spark, sf_dir), "i94cntyl", by=["p_partkey"])


@query(
    "code_lists",
    f"""
    select 'country_codes' as list, p_partkey, code, name from ({CODE_LIST_SQL})
    union all select 'port_codes', p_partkey, substr(p_type, 1, 3), p_name || ', PORT' from part
    union all select 'mode_codes', p_partkey, '1', 'Air' from part
    union all select 'mode_codes', p_partkey, cast(p_size + 10 as varchar), 'Size' from part
    union all select 'state_codes', p_partkey, 'AL', p_brand from part
    union all select 'state_codes', p_partkey, '99', 'All Other Codes' from part
    union all select 'visa_codes', null, '1', 'Business'
    union all select 'visa_codes', null, '2', 'Pleasure'
    union all select 'visa_codes', null, '3', 'Student'
    """,
)
def code_lists(spark, sf_dir):
    lists = labels.parse_code_lists(_texts(spark, sf_dir), by=["p_partkey"])
    visa = labels.visa_codes(spark).select(
        F.lit("visa_codes").alias("list"),
        F.lit(None).cast("bigint").alias("p_partkey"),
        F.col("visa_code").alias("code"),
        F.col("visa_category").alias("name"),
    )
    return lists.unionByName(visa)


@query(
    "dictionary_scan",
    "select substr(p_type, 1, 3) as code, p_name || ', PORT' as name, count(*) as texts from part group by all",
)
def dictionary_scan(spark, sf_dir):
    """Texts written to files and scanned back; each is told apart by its own content."""
    path = work_path(spark, "dictionary_scan")
    _texts(spark, sf_dir).select("value").write.mode("overwrite").text(path, lineSep=RECORD_SEPARATOR)
    texts = read_dictionary(spark, path, RECORD_SEPARATOR).withColumn("text_id", F.md5("value"))
    ports = labels.extract_code_list(texts, "i94prtl", by=["text_id"])
    return ports.groupBy("code", "name").agg(F.count(F.lit(1)).alias("texts"))


@query(
    "large_dictionary",
    """
    select 'countries' as list, cast(p_partkey as varchar) as code, case when p_partkey % 10 = 0 then p_brand else p_name end as name
    from part
    union all
    select 'ports', cast(-p_partkey as varchar), concat(p_type, ', PORT') from part
    """,
)
def large_dictionary(spark, sf_dir):
    """One text whose sections hold a line for each part, some codes twice; read by its lines and not as a row."""
    root = work_path(spark, "large_dictionary")
    parts = table(spark, sf_dir, "part")
    line = "concat('\\t', {code}, ' =  \\'', {name}, '  \\'')"
    sections = [
        spark.range(1).selectExpr("0 as section", "0L as place", "'/* value of\\t */ value i94cntyl' as value"),
        parts.selectExpr("1 as section", "p_partkey as place", f"{line.format(code='p_partkey', name='p_name')} as value"),
        parts.filter("p_partkey % 10 = 0").selectExpr(
            "2 as section", "p_partkey as place", f"{line.format(code='p_partkey', name='p_brand')} as value"
        ),
        spark.range(1).selectExpr("3 as section", "0L as place", "'two = a = b ; x = y\nvalue $i94prtl' as value"),
        parts.selectExpr(
            "4 as section", "p_partkey as place", f"""{line.format(code='-p_partkey', name="p_type, ', PORT'")} as value"""
        ),
        spark.range(1).selectExpr("5 as section", "0L as place", "';\nz = lost' as value"),
    ]
    text = reduce(DataFrame.unionAll, sections).orderBy("section", "place").coalesce(1)
    text.select("value").write.mode("overwrite").text(f"{root}/text")
    write_table(read_dictionary_lines(spark, f"{root}/text"), f"{root}/lines")
    return labels.parse_section_lines(read_table(spark, f"{root}/lines"), {"countries": "i94cntyl", "ports": "i94prtl"})
