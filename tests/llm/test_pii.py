"""Personal data: the plain forms against bare patterns, other forms by kinship, nothing without it."""

import re

import numpy as np
import pytest
from llm_helpers import documents

from starmart.llm import pii
from starmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
# The patterns as they are stated, without care for time.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d if d < 10 else d - 9
    return total % 10 == 0


def stated_finds(text):
    found = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return found


def test_query_on_the_whole_table(spark):
    import hashlib

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    found = QUERIES["op2_pii"](spark, SF).collect()
    assert len(found) == len(rows)
    for r in found:
        finds = stated_finds(rows[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in finds)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(f[0] == k for f in finds) for k in STATED]
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert sum(r.n_email + r.n_phone for r in found) > 0


@pytest.mark.parametrize(
    "text",
    [
        "", "a@b.c@d.e.f@g", "x@y", "@a.b", "..@a-.-b.c d@e.f.", "1.2.3.4.5.6.7.8 1.2.3.256 0255.1.1.1 1.2.3", "é a@b.de ü+49 (30) 123-45.6",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 4 1 1", "+1 2 +12345678 +1234567890123456 ++49 170 1234567+", "+1((((((9", "1" * 5000,
        "a" * 5000 + "@", "5.5.5.5.", "+49 170 1234567, 4111111111111111 10.0.0.1 a%b@c.d-e",
    ],
)
def test_plain_forms_as_stated(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.plain_finds(text)] == stated_finds(text)


TRAINING = [
    (i, f"Call +49 170 12345{i:02d} or write to user{i}@mail.example soon. Again: +49 170 12345{i:02d}. Order 88{i:05d} and 99{i:05d}. "
        f"Server 10.0.0.{i} is up; 10.0.0.{i} was down. Card 4111 1111 1111 1111 expired, use 4111 1111 1111 1111.")
    for i in range(60)
]


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(documents(spark, TRAINING))


def spans(model, text):
    return {(pii.KINDS[k], text[a:b]) for k, a, b, plain in pii.find_spans(model, text) if not plain}


def test_other_forms_of_what_is_known(model):
    filler = "word " * 3000
    assert spans(model, f"Call +49 170 7654321. {filler} or 0170 7654321 today") == {("phone", "0170 7654321")}
    assert spans(model, f"jo.doe@mail.example {filler} jo.doe [at] mail [dot] example") == {("email", "jo.doe [at] mail [dot] example")}
    assert spans(model, f"10.0.0.7 {filler} 10-0-0-7") == {("ip", "10-0-0-7")}
    assert spans(model, f"4111 1111 1111 1111 {filler} 4111.1111.1111.1111") == {("card", "4111.1111.1111.1111")}


def test_nothing_is_added_without_kin(model):
    assert spans(model, "Order 8800001 of 12-24-36-48 pieces, 4111.1111.1111.1112") == set()
    assert spans(model, "Call +49 170 7654321. Order 8812345, 30 40 50 60 70, some [at] thing [dot] de") == set()


def test_labels_agree_over_a_chain_of_kin(model):
    text = "+49 170 7654321 " + " and 0170 765 4321, " * 30
    assert len(spans(model, text)) == 1 and len(pii.find_spans(model, text)) == 31


def test_nulls_repeated_rows_and_empty_table(spark, model):
    rows = [(1, None), (2, ""), (3, "a@b.de"), (3, "a@b.de"), (None, "x" * 300_000 + " 10.0.0.1")]
    df = documents(spark, rows).selectExpr("*", "1 AS spans")
    found = pii.find_personal_data(df, model=model)
    assert sorted(len(r.spans) for r in found.collect()) == [0, 0, 1, 1, 1]
    assert found.columns == documents(spark, rows).columns + ["spans"]
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_numbers_of_a_list_are_places_of_their_own(model):
    text = "+49 170 7654321, then 0170 7654321, 0170 765 4321 / 0170-7654321 and 0049 (170) 7654321"
    assert spans(model, text) == {
        ("phone", "0170 7654321"), ("phone", "0170 765 4321"), ("phone", "0170-7654321"), ("phone", "0049 (170) 7654321"),
    }
    assert pii.listed_numbers("12, 34, 5678901", 0, 15) == [(0, 15)]


def exact_beliefs(model, text, nodes):
    """Label probabilities by adding up all labellings."""
    import itertools

    edges = [(i, i + 1, model.chain) for i in range(len(nodes) - 1)]
    edges += [(a, b, model.skip) for a, b in pii.skip_edges(nodes)]
    total = np.zeros((len(nodes), pii.LABELS))
    for labels in itertools.product(*([n.label] if n.label is not None else range(pii.LABELS) for n in nodes)):
        score = sum(
            model.shape[n.shape][y] + model.context[pii.context(text, n)][y] + model.form[pii.FORM_OTHER][y]
            for n, y in zip(nodes, labels, strict=True)
            if n.label is None
        )
        weight = np.exp(score + sum(p[labels[a], labels[b]] for a, b, p in edges))
        for i, y in enumerate(labels):
            total[i, y] += weight
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("scale", [0.3, 1.0])
def test_messages_against_all_labellings(model, scale):
    """Exact on graphs without a circle; near enough to give the same labels on those with one."""
    rng = np.random.default_rng(2)
    sizes = {k: getattr(model, k).shape for k in ("shape", "context", "form", "chain", "skip")}
    parts = {k: rng.normal(0, scale, v) for k, v in sizes.items()}
    parts["chain"], parts["skip"] = ((parts[k] + parts[k].T) / 2 for k in ("chain", "skip"))
    random_model = pii.SkipChain(**parts)
    trees = ["0170 7654321 and 0171 1234567", "+49 170 7654321 or 0170 7654321", "10-0-0-7 x 12345678 y 88 99 77 66"]
    for text in trees:
        nodes = pii.places_of(text)[1]
        assert np.abs(pii.beliefs(random_model, text, nodes) - exact_beliefs(random_model, text, nodes)).max() < 2e-2
    loops = ["+49 170 7654321 a 0170 7654321 b 0170-7654321 c 12345678", "0170 7654321 a 55555555 b 0170 7654321"]
    for text in loops:
        nodes = pii.places_of(text)[1]
        found, exact = pii.beliefs(random_model, text, nodes), exact_beliefs(random_model, text, nodes)
        assert np.abs(found - exact).max() < 0.15
        found, exact = pii.beliefs(model, text, nodes), exact_beliefs(model, text, nodes)
        assert (found.argmax(axis=1) == exact.argmax(axis=1)).all()


def test_the_field_decides(model):
    """The same places, with and without what ties them to a plain find: belief alone tells."""
    text = "Call +49 170 7654321 or 0170 7654321"
    assert spans(model, text) == {("phone", "0170 7654321")}
    untied = pii.SkipChain(model.shape, model.context, model.form, model.chain, np.zeros_like(model.skip))
    assert spans(untied, text) == set()
    against = pii.SkipChain(model.shape, model.context, model.form, model.chain, -model.skip)
    assert spans(against, text) == set()
