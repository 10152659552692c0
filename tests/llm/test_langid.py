"""Language identification: accuracy on held-out documents, rejection, odd rows."""

import zlib

import pytest
from llm_helpers import documents

from starmart.llm import langid
from starmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_on_the_whole_table(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op9_language_id"](spark, SF).collect()
    assert {r.doc_id for r in found} == set(langs) and len(found) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.rejected for r in found) <= 0.01 * len(found)


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit_languages(spark.read.parquet(f"{SF}/documents.parquet"), per_language=60)


def test_nulls_no_letters_short_long_and_repeated_texts(spark, model):
    english = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").first().text
    rows = [
        (1, None), (2, ""), (3, "123 ²³ +++ ..."), (4, english), (4, english), (None, english * 400), (5, "and the", "xx"),
        (6, "zzzz qqqq ïïï"),
    ]
    df = documents(spark, rows).selectExpr("*", "1 AS score", "2 AS held_out", "3 AS rejected", "4 AS lang_pred")
    found = langid.identify_language(df, model=model)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "held_out", "lang_pred", "score", "rejected"]
    rows = found.collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in rows if r.doc_id in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert {r.lang_pred for r in rows if r.doc_id in (4, 5, None)} == {"en"}
    assert all(r.lang_pred in model.languages for r in rows if r.doc_id == 6)
    assert langid.identify_language(df.limit(0), model=model).count() == 0


def test_nothing_to_learn_from(spark):
    rows = [(1, "some text"), (2, None)]
    assert {(r.lang_pred, r.score, r.rejected) for r in langid.identify_language(documents(spark, rows)).collect()} == {
        ("und", 0.0, True)
    }


def test_the_sample_is_bounded_and_learns_from_no_held_out_row(spark):
    rows = [(i, f"wort text {i}", "de" if i % 3 else "fr") for i in range(300)]
    df = documents(spark, rows).where(langid.in_training("doc_id"))
    from pyspark.sql import functions as F

    sample = langid.sample_features(df, "text", "lang", F.xxhash64("doc_id", "text"), 20, 0)
    assert {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()} == {"de": 20, "fr": 20}


def test_predictions_do_not_depend_on_what_a_task_remembers(spark, model, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    whole = langid.identify_language(df, model=model).collect()
    monkeypatch.setattr(langid, "KEPT_TOKENS", 50)
    few = langid.identify_language(df, model=model).collect()
    for a, b in zip(whole, few, strict=True):
        assert a.lang_pred == b.lang_pred and abs(a.score - b.score) < 1e-6


def test_a_language_of_few_documents_is_learned(spark):
    rows = [(i, f"das ist der text nummer {i} und nicht mehr", "de") for i in range(200)]
    rows += [(1000, "le texte est dans la maison avec les autres", "fr")]
    df = documents(spark, rows)
    model = langid.fit_languages(df)
    assert model.languages == ["de", "fr"]
    found = langid.identify_language(documents(spark, [(1, "les autres dans la maison"), (2, "das ist nicht der text")]), model=model)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "fr", 2: "de"}


def test_every_fifth_document_of_a_language_is_held_back():
    documents_ = [("a", k) for k in range(23)] + [("b", k) for k in range(4)] + [("c", 7)] * 9
    held = langid.held_back_keys(documents_)
    assert held == {("a", k) for k in (4, 9, 14, 19)}


def test_scores_against_plain_computation(spark, model):
    """Mean of the subwords' language scores, softmax at the model's temperature: by plain loops over whole texts."""
    import math

    import regex

    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()
    found = {r.doc_id: r for r in langid.identify_language(spark.read.parquet(f"{SF}/documents.parquet"), model=model).collect()}
    for row in rows:
        sums, n = [0.0] * len(model.languages), 0
        for word in regex.findall(r"\p{L}[\p{L}\p{M}]*", (row.text or "").lower()):
            marked = ("<" + word + ">").encode()
            for size in (2, 3, 4):
                for at in range(len(marked) - size + 1):
                    bucket = zlib.crc32(marked[at : at + size]) % 32768
                    n += 1
                    for i in range(len(sums)):
                        sums[i] += float(model.scores[bucket][i])
        got = found[row.doc_id]
        if not n:
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        z = [(s / n + float(b)) / model.temperature for s, b in zip(sums, model.bias, strict=True)]
        p = [math.exp(v - max(z)) for v in z]
        best = max(range(len(p)), key=p.__getitem__)
        assert abs(got.score - p[best] / sum(p)) < 1e-4
        assert got.lang_pred == model.languages[best] or abs(sorted(p)[-1] - sorted(p)[-2]) < 1e-4
        assert got.rejected == (got.score < model.reject_below)
