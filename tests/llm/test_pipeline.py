"""The pipeline, stage after stage, against the operators' brute-force versions."""

import random

import corpus_pipeline
import pytest
import test_decontaminate
import test_line_dedup
import test_packing
import test_simhash
from llm_helpers import SCHEMA
from test_packing import plain  # noqa: F401  (a fixture)

from starmart.llm.langid import identify_language

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ENGLISH = "the of and to in that it is was for on are with as they at be this from have or by one had not but".split()
GERMAN = "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er".split()


def make_documents():
    rng = random.Random(12)
    passage = " ".join(rng.choices(ENGLISH, k=30)) + " xylophone quartz"
    rows = []

    def add(text, lang, doc=...):
        rows.append((len(rows) if doc is ... else doc, text, lang, f"src{len(rows) % 3}", None if text is None else len(text)))

    for i in range(60):
        words, lang = (ENGLISH, "en") if i % 2 else (GERMAN, "de")
        add("\n".join(" ".join(rng.choices(words, k=12)) for _ in range(5)) + "\nShared last line", lang)
    for i in (3, 4, 5):
        add(rows[i][1], rows[i][2])  # exact copies
        add(rows[i][1].replace("\n", " \n", 1).upper(), rows[i][2])  # near ones
    add(passage, "en")
    add(rows[7][1] + "\n" + " ".join(rng.choices(ENGLISH, k=1500)) + " " + passage, "en")  # long, hit, but not contaminated
    add(None, "en")
    add("", None)
    add("12345 ... 67", "de")
    add("Shared last line", "en")
    add(" ".join(rng.choices(GERMAN, k=30_000)), "de")
    add(rows[8][1] + " eins", "de")
    add("\n".join([" ".join(rng.choices(ENGLISH, k=20))] * 2), None, None)
    rows.append(rows[-2])
    return rows, [(0, passage), (1, None), (2, "quartz xylophone of"), (3, "")]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows, items = make_documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_run_against_brute_force(spark, sf_dir, plain):  # noqa: F811
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in identify_language(documents).where("NOT rejected").collect()]
    # Nothing with letters is lost.
    assert sorted(docs, key=str) == sorted(
        ((r[0], r[1]) for r in make_documents()[0] if any(c.isalpha() for c in r[1] or "")), key=str
    )
    docs = [(doc, text) for doc, text, _, _ in test_line_dedup.plain(docs, 10)]
    groups = {}
    for (doc, text), (_, print_, component) in zip(
        sorted(docs, key=str), sorted_like(docs, test_simhash.brute_force(docs)), strict=True
    ):
        groups.setdefault(component, []).append((doc, text, print_))
    kept = []
    for component, members in groups.items():
        own = sorted((m for m in members if m[0] == component), key=str)
        kept.append(own[0][:2] if len({m[1] for m in own}) == 1 else own)
    assert all(isinstance(k, tuple) for k in kept)  # these rows leave no choice
    items = make_documents()[1]
    dirty = {x[0] for x in test_decontaminate.plain(kept, items) if x[5]}
    kept = [k for k in kept if k[0] not in dirty]
    found = corpus_pipeline.run(spark, sf_dir).collect()
    used, least = test_packing.check_packing(found, kept, plain, 2048)
    assert used <= least + 1


def sorted_like(docs, found):
    """``found`` is sorted by text; the fingerprint of each document in the documents' own sorted order."""
    by_doc = {}
    for doc, print_, component in found:
        by_doc.setdefault(doc, []).append((doc, print_, component))
    out = []
    for doc, text in sorted(docs, key=str):
        want = f"{test_simhash.plain_fingerprint(text):016x}"
        out.append(next(x for x in by_doc[doc] if x[1] == want))
    return out


def test_stages_keep_columns_and_work_on_empty_tables(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "near_dedup", "decontamination", "packing",
    ]
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf_dir)
        assert out.count() == 0
        assert out.columns == COLUMNS or name == "packing"


def test_a_changed_text_gets_its_own_length(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cleaned = corpus_pipeline.line_dedup(spark, documents, sf_dir).collect()
    assert all(r.n_chars is None if r.text is None else r.n_chars == len(r.text) for r in cleaned)
    assert not any(line.strip().lower() == "shared last line" for r in cleaned for line in (r.text or "").split("\n"))
