import pytest
from helpers import DICTIONARY, rows_of
from pyspark.sql import functions as F

from starmart.operators.labels import build_code_lists, extract_code_list, parse_section_lines, parse_sections
from starmart.schemas import CODE_LISTS
from starmart.sources import read_dictionary, read_dictionary_lines


def texts(spark, *values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "source string, value string")


def test_four_lists_and_the_visa_categories(spark):
    tables = build_code_lists(texts(spark, DICTIONARY))
    assert list(tables) == ["country_codes", "port_codes", "mode_codes", "state_codes", "visa_codes"]
    lists = {name: dict(df.drop("id").collect()) for name, df in tables.items()}
    assert lists["country_codes"] == {
        "582": "MEXICO Air Sea, and Not Reported (no land arrivals)",
        "108": "DENMARK",
        "209": "JAPAN",
        "997": "INVALID: STATELESS",
        "996": "INVALID: STATELESS",
        "849": "No Country Code (849)",
    }
    assert lists["port_codes"] == {
        "ALC": "ALCAN, AK", "CP": "No PORT Code (CP)", "NK": "No PORT Code (NK)",
    }
    assert lists["mode_codes"] == {"1": "Air", "2": "Sea", "9": "Not reported"}
    assert lists["state_codes"] == {
        "AL": "ALABAMA", "CA": "CALIFORNIA", "WI": "WISCONSON", "99": "All Other Codes",
    }
    assert lists["visa_codes"] == {"1": "Business", "2": "Pleasure", "3": "Student"}


def test_lists_have_string_codes_and_long_ids(spark):
    for name, df in build_code_lists(texts(spark, DICTIONARY)).items():
        assert [t for _, t in df.dtypes] == ["string", "string", "bigint"], name
        ids = [r.id for r in df.collect()]
        assert len(set(ids)) == len(ids) and None not in ids


def test_last_of_repeated_codes_wins(spark):
    text = "list x\n 'A' = 'first'\n B = 'only'\n A = 'last' ;"
    assert rows_of(extract_code_list(texts(spark, text), "x")) == [("A", "last"), ("B", "only")]


def test_lines_need_exactly_one_equals_sign(spark):
    text = "list x = y\n a=b=c\n no sign\n\n d=\n =e\n f=g;h=i"
    assert rows_of(extract_code_list(texts(spark, text), "x")) == [("", "e"), ("d", ""), ("f", "g")]


def test_starts_at_the_first_mention_and_ends_at_the_next_semicolon(spark):
    text = "/* about x */\n a=1\n;\nvalue x\n b=2\n;"
    assert rows_of(extract_code_list(texts(spark, text), "x")) == [("a", "1")]


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_any_line_end_and_any_white_space(spark, newline):
    text = f"x{newline} 'A '\t=\t' one '{newline} B = two{newline};"
    assert rows_of(extract_code_list(texts(spark, text), "x")) == [("A", "one"), ("B", "two")]


@pytest.mark.parametrize("text", ["nothing here;", "list x\n a=b"])
def test_a_missing_section_or_semicolon_fails(spark, text):
    with pytest.raises(Exception, match="section x"):
        extract_code_list(texts(spark, text), "x").collect()


def test_lists_are_kept_apart_by_text(spark):
    df = extract_code_list(texts(spark, "x\n a=1\n a=2;", "x\n a=3;"), "x", by=["source"])
    assert rows_of(df) == [("0", "a", "2"), ("1", "a", "3")]


def test_pairs_are_spread_before_they_are_sorted(spark):
    """A task that reads many texts does not sort all of their pairs; equal codes still meet."""
    text = F.concat(F.lit("x\n a="), F.col("id").cast("string"), F.lit("\n b=1\n a=last "), F.col("id") % 2, F.lit(";"))
    many = spark.range(0, 1000, 1, 1).select(text.alias("value"), (F.col("id") % 10).alias("source"))
    df = extract_code_list(many, "x", by=["source"])
    assert rows_of(df) == rows_of(
        spark.createDataFrame([(i, c, n) for i in range(10) for c, n in (("a", f"last {i % 2}"), ("b", "1"))], df.schema)
    )
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.rindex("SortAggregate") < plan.index("REBALANCE_PARTITIONS_BY_COL")


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "one.sas").write_text(DICTIONARY)
    (tmp_path / "two.sas").write_text(DICTIONARY.replace("DENMARK", "NORWAY"))
    df = read_dictionary(spark, str(tmp_path))
    assert df.count() == 2
    names = extract_code_list(df, "i94cntyl", by=["source"]).filter("code = '108'")
    assert {(r.source[-7:], r.name) for r in names.collect()} == {("one.sas", "DENMARK"), ("two.sas", "NORWAY")}


def test_many_texts_in_a_file(spark, tmp_path):
    (tmp_path / "all.txt").write_text("\x1e".join(["x\n a=1;", "x\n a=2;", "x\n a=3;"]))
    df = read_dictionary(spark, str(tmp_path), "\x1e").withColumnRenamed("value", "text")
    assert rows_of(extract_code_list(df, "x", text_column="text", by=["text"]).select("name")) == [
        ("1",), ("2",), ("3",),
    ]


LISTS = {item.table: item.section for item in CODE_LISTS}


def lines_of(spark, tmp_path, text, split="1k"):
    """The text as lines, read in small splits and staged."""
    path = tmp_path / f"text-{split}"
    path.write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        staged = str(tmp_path / f"lines-{split}")
        read_dictionary_lines(spark, str(path)).write.parquet(staged)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return spark.read.parquet(staged)


@pytest.mark.parametrize("split", ["64b", "100b", "1k", "1m"])
def test_lines_give_the_lists_of_the_whole_text(spark, tmp_path, split):
    whole = spark.createDataFrame([(DICTIONARY,)], "value string")
    lines = lines_of(spark, tmp_path, DICTIONARY, split)
    assert split == "1m" or lines.select("block").distinct().count() > 1
    assert rows_of(parse_section_lines(lines, LISTS)) == rows_of(parse_sections(whole, LISTS))


def test_a_text_of_many_tasks(spark, tmp_path):
    """Sections begin, end and repeat codes in different splits."""
    body = "".join(f"   {n % 30_000} =  'NAME {n}'\r\n" for n in range(60_000))
    text = f"x=y;\n/* i94cntyl */ value i94cntyl\n{body};\nvalue $i94prtl 'A'='no' ; 'B'='no'\n{body}"
    lines = lines_of(spark, tmp_path, text, "100k")
    assert lines.select("block").distinct().count() > 20
    found = parse_section_lines(lines, {"a": "i94cntyl", "b": "i94prtl"})
    assert found.count() == 30_000 and found.where("name <> concat('NAME ', 30000 + code)").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan


def test_lines_without_a_section_or_its_end(spark, tmp_path):
    lines = lines_of(spark, tmp_path, "value a\n1='x'\n")
    with pytest.raises(ValueError, match="no section b"):
        parse_section_lines(lines, {"b": "b"})
    with pytest.raises(ValueError, match="no closing semicolon"):
        parse_section_lines(lines, {"a": "value a"})
