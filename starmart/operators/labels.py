"""Code lists from dictionary text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import strip
from starmart.operators.keys import with_surrogate_id
from starmart.schemas import CODE_LISTS, VISA_LIST, VISA_ROWS, CodeList
from starmart.sources.readers import literal_table


def _last_names(pairs: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last name of each key.

    A maximum of texts is found by sorting, first within each task, and the pairs of a task that reads texts are many
    times what it reads. So they are rebalanced before: a task sorts what Spark's advisory size allows. It is done by the
    name as well, so that the pairs of a frequent key may be split and still meet as one row a task.
    """
    spread = pairs.hint("rebalance", *keys, "name")
    return spread.groupBy(*keys).agg(F.max_by("name", order).alias("name"))


def parse_sections(
    texts: DataFrame,
    sections: Mapping[str, str],
    *,
    text_column: str = "value",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows ``(list, *by, code, name)`` of all sections, in one pass over the texts.

    ``sections`` maps a list's name to its section. A section's text runs from its first mention up to the next
    semicolon. Lines after the section's first with exactly one ``=`` count; quotes are dropped, both sides
    trimmed, and the last of several lines with the same code wins. A text without the section, or without a
    semicolon closing it, fails the job. Each step is a column of its own, so that it is computed once per text.
    """
    wanted = F.array(
        *(F.struct(F.lit(k).alias("list"), F.lit(v).alias("section")) for k, v in sections.items())
    )
    text, rest, section = F.col("_text"), F.col("_rest"), F.col("_section")
    bodies = (
        texts.select(*by, F.replace(F.col(text_column), F.lit("\t"), F.lit("")).alias("_text"))
        .select(*by, "_text", F.inline(wanted).alias("list", "_section"))
        .withColumn("_start", F.position(section, text))
        .withColumn(
            "_rest",
            F.when(F.col("_start") > 0, F.substr(text, F.col("_start"))).otherwise(
                F.raise_error(F.concat(F.lit("no section "), section, F.lit(" in the dictionary text")))
            ),
        )
        .withColumn("_end", F.instr(rest, ";"))
        .select(
            "list",
            *by,
            F.when(F.col("_end") > 0, F.substr(rest, F.lit(1), F.col("_end") - 1))
            .otherwise(F.raise_error(F.concat(F.lit("section "), section, F.lit(" has no closing semicolon"))))
            .alias("_body"),
        )
    )
    body = F.replace(F.col("_body"), F.lit("'"), F.lit(""))
    lines = bodies.select(
        "list", *by, F.posexplode(F.split(body, r"\r\n|\r|\n")).alias("_line", "_text")
    ).filter("_line > 0")
    pairs = (
        lines.select("list", *by, "_line", F.split("_text", "=").alias("_sides"))
        .filter(F.size("_sides") == 2)
        .select(
            "list",
            *by,
            strip(F.get("_sides", F.lit(0))).alias("code"),
            strip(F.get("_sides", F.lit(1))).alias("name"),
            "_line",
        )
    )
    # The name breaks ties between texts that are not told apart by ``by``.
    return _last_names(pairs, ["list", *by, "code"], F.struct("_line", "name"))


def parse_section_lines(lines: DataFrame, sections: Mapping[str, str]) -> DataFrame:
    """As ``parse_sections``, of one text that is given by its lines and may be larger than a row or a task.

    ``lines`` is what ``read_dictionary_lines`` gives, written and read again. No line is shuffled or ordered: where each
    section begins is a minimum over all lines, and so is where the first semicolon after that stands; what lies between
    the two is then read by itself. The places, one a section, come to the driver.
    """
    text = F.replace(F.col("value"), F.lit("\t"), F.lit(""))
    lines = lines.select(F.struct("block", "row").alias("_at"), text.alias("_text"))
    names = list(sections)
    first = lines.agg(*(F.min(F.when(F.position(F.lit(sections[n]), "_text") > 0, F.col("_at"))).alias(n) for n in names)).first()
    for name in names:
        if first[name] is None:
            raise ValueError(f"no section {sections[name]} in the dictionary text")
    at = {n: F.struct(F.lit(first[n].block).alias("block"), F.lit(first[n].row).alias("row")) for n in names}

    def closed(name: str) -> Column:
        """Whether a semicolon stands in the line, after the section's mention if it is in this one."""
        rest = F.substr("_text", F.position(F.lit(sections[name]), F.col("_text")))
        return F.when(F.col("_at") == at[name], F.instr(rest, ";") > 0).otherwise(
            (F.col("_at") > at[name]) & (F.instr("_text", ";") > 0)
        )

    last = lines.agg(*(F.min(F.when(closed(n), F.col("_at"))).alias(n) for n in names)).first()
    parts = []
    for name in names:
        if last[name] is None:
            raise ValueError(f"section {sections[name]} has no closing semicolon")
        end = F.struct(F.lit(last[name].block).alias("block"), F.lit(last[name].row).alias("row"))
        inside = (F.col("_at") > at[name]) & (F.col("_at") <= end)
        body = F.when(F.col("_at") == end, F.substring_index("_text", ";", 1)).otherwise(F.col("_text"))
        parts.append(lines.filter(inside).select(F.lit(name).alias("list"), "_at", F.replace(body, F.lit("'"), F.lit("")).alias("_body")))
    sides = reduce(DataFrame.unionAll, parts).select("list", "_at", F.split("_body", "=").alias("_sides"))
    pairs = sides.filter(F.size("_sides") == 2).select(
        "list", strip(F.get("_sides", F.lit(0))).alias("code"), strip(F.get("_sides", F.lit(1))).alias("name"), "_at"
    )
    return _last_names(pairs, ["list", "code"], F.col("_at"))


def extract_code_list(
    texts: DataFrame,
    section: str,
    code: str = "code",
    name: str = "name",
    *,
    text_column: str = "value",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows ``(code, name)`` of a section, one list per distinct ``by`` (all texts if empty)."""
    parsed = parse_sections(texts, {section: section}, text_column=text_column, by=by)
    return parsed.select(*by, F.col("code").alias(code), F.col("name").alias(name))


def visa_codes(spark: SparkSession, visa: CodeList = VISA_LIST) -> DataFrame:
    return literal_table(spark, VISA_ROWS, (visa.code, visa.name))


def parse_code_lists(
    texts: DataFrame,
    lists: Sequence[CodeList] = CODE_LISTS,
    *,
    text_column: str = "value",
    by: Sequence[str] = (),
) -> DataFrame:
    """All code lists of a dictionary text as one table ``(list, *by, code, name)``; ``list`` is the table's name."""
    return parse_sections(texts, {i.table: i.section for i in lists}, text_column=text_column, by=by)


def code_list_tables(
    parsed: DataFrame, lists: Sequence[CodeList] = CODE_LISTS, *, by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """The parsed lists as tables of their own, plus the constant visa list, each with an id.

    Each table reads ``parsed`` for itself: stage it first if several are used.
    """
    tables = {
        item.table: parsed.filter(F.col("list") == item.table).select(
            *by, F.col("code").alias(item.code), F.col("name").alias(item.name)
        )
        for item in lists
    }
    tables[VISA_LIST.table] = visa_codes(parsed.sparkSession)
    return {table: with_surrogate_id(df, distinct=True) for table, df in tables.items()}


def build_code_lists(
    texts: DataFrame,
    lists: Sequence[CodeList] = CODE_LISTS,
    *,
    text_column: str = "value",
    by: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """All code lists of a dictionary text plus the constant visa list, each with an id."""
    return code_list_tables(parse_code_lists(texts, lists, text_column=text_column, by=by), lists, by=by)
