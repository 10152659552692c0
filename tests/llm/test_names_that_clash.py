"""Input columns named like a result, in another case: replaced, as the docstrings say."""

import pytest
from llm_helpers import documents

from starmart.llm.decontaminate import find_contamination
from starmart.llm.langid import identify_language
from starmart.llm.pii import find_personal_data
from starmart.llm.quality import judge_quality

ROWS = [(1, "Ein Text mit jo@example.org und mehr", "de"), (2, None), (3, "and some more words", "en")]


def contamination(docs):
    items = docs.sparkSession.createDataFrame([(1, "some more words")], "item_id long, text string")
    return find_contamination(docs, items)


@pytest.mark.parametrize(
    ("run", "clashing"),
    [
        (find_personal_data, ["Spans"]),
        (judge_quality, ["N_WORDS", "Kept", "QUALITY", "Votes"]),
        (contamination, ["N_WORDS", "Item_Ids", "SPANS", "Contaminated"]),
        (identify_language, ["Score", "LANG_PRED", "Rejected", "Held_Out"]),
    ],
)
def test_columns_of_another_case_are_replaced(spark, tmp_path, run, clashing):
    odd = documents(spark, ROWS).selectExpr("*", *(f"1 AS {c}" for c in clashing), "2 AS _LLM_k1", "3 AS `a.b`")
    path = str(tmp_path / "out")
    run(odd).write.parquet(path)
    found = spark.read.parquet(path)
    lower = [c.lower() for c in found.columns]
    assert len(set(lower)) == len(lower) and "a.b" in lower and "_llm_k1" not in lower
    assert not set(clashing) & set(found.columns) and set(map(str.lower, clashing)) <= set(lower)
    assert found.count() == len(ROWS)
