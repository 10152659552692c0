"""Personal data, by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card and phone numbers in their plain form; what they find
always counts. The same data often comes again in another form: a phone number without its country code, an
address with [at], a card number with dots. Such places are nodes of a graph, as are the patterns' finds. Neighbours in
the text are tied by chain edges, places that hold the same or nearly the same data, however far apart, by skip edges.
Loopy message passing over the document's graph decides which label fits all of them together.

The potentials are trained by pseudo-likelihood on the patterns' own finds, over all documents: what is trained on is
the number of times each local situation occurs, a table that is bounded by the features' values. Half the weight lies on
copies of the situations in which the plain form is hidden, so the model learns how far kin alone tells a label. Places in
another form that are kin to a find are what is asked for; they are not trained on. What the field believes decides alone:
a place counts if a kind is its likeliest label, whether or not the document holds a plain find.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import other_columns, prepare_workers

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)  # the label of what is no personal data
LABELS = OTHER + 1
NOBODY = LABELS  # in place of a neighbour's label where there is none

# The patterns of the plain forms, written so that no text takes more than linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Other forms.
NUMBER = re.compile(r"(?<![\w.+])\(?[0-9](?:[ ()./_,:\[\]-]{0,3}[0-9])++(?!\w)")
AT = re.compile(r"[ ]?(?:\[at\]|\(at\))[ ]?", re.IGNORECASE)
DOT = re.compile(r"[ ]?(?:\[dot\]|\(dot\))[ ]?", re.IGNORECASE)
AFTER_AT = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|[ ]?(?:\[dot\]|\(dot\))[ ]?)[A-Za-z0-9-]++)++", re.IGNORECASE)
BETWEEN_NUMBERS = re.compile(r"(?:,|:| /) +")
DIGITS = re.compile(r"[0-9]+")
BEFORE = re.compile(r"([^\W\d_]+)[^\w]*\Z")

CONTEXTS = 64  # buckets for the word before
FORM_OTHER, FORM_PLAIN, FORM_HIDDEN = 0, 1, 2
ROUNDS = 12  # of message passing
AGREEMENT = 6.0  # log potential of equal labels along a skip edge, before training
LEAST_DIGITS = 7  # of a number that stands by itself in a list
TAIL = 8  # numbers with so many last digits in common are kin


def digits_of(text: str) -> str:
    return "".join(DIGITS.findall(text))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: around every @ that has both."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def plain_finds(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, stop) of the plain forms, by kind and start; leftmost and apart within a kind."""
    found = [(0, *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits_of(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


@dataclass(frozen=True)
class Place:
    start: int
    stop: int
    label: int | None  # of a plain find; None elsewhere
    shape: int  # the kind whose data it could be
    kin: tuple[tuple[str, str], ...]


def kin_of(kind: int, text: str) -> tuple[tuple[str, str], ...]:
    if kind == 0:
        return (("mail", AT.sub("@", DOT.sub(".", text)).lower()),)
    groups = DIGITS.findall(text)
    if kind == 1:
        return (("ip", ".".join(g.lstrip("0") or "0" for g in groups)),)
    digits = "".join(groups)
    tail = (("tail", digits[-TAIL:]),) if kind == 3 and len(digits) >= TAIL else ()
    return (("number", digits), *tail)


def other_forms(text: str) -> Iterator[Place]:
    """Places that could be personal data in another form."""
    for m in AT.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        after = AFTER_AT.match(text, m.end())
        if start < m.start() and after:
            yield Place(start, after.end(), None, 0, kin_of(0, text[start : after.end()]))
    for m in NUMBER.finditer(text):
        for start, stop in listed_numbers(text, m.start(), m.end()):
            number = text[start:stop]
            start += number.startswith("(") and ")" not in number
            groups = DIGITS.findall(number)
            size = sum(map(len, groups))
            if len(groups) == 4 and all(len(g) < 4 and int(g) <= 255 for g in groups):
                yield Place(start, stop, None, 1, kin_of(1, number) + kin_of(3, number))
            elif 16 <= size <= 19:
                yield Place(start, stop, None, 2, kin_of(2, number))
            elif 7 <= size <= 15:
                yield Place(start, stop, None, 3, kin_of(3, number))


def listed_numbers(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """The numbers of a list that is written with commas or slashes; one, if what stands between them is part of a number."""
    cuts = [m.span() for m in BETWEEN_NUMBERS.finditer(text, start, stop)]
    spans = list(zip([start, *(b for _, b in cuts)], [*(a for a, _ in cuts), stop], strict=True))
    return spans if all(len(digits_of(text[a:b])) >= LEAST_DIGITS for a, b in spans) else [(start, stop)]


def places_of(text: str) -> tuple[list[tuple[int, int, int]], list[Place]]:
    """The plain finds, and all nodes of the document in order."""
    has_digit = DIGITS.search(text) is not None
    if not has_digit and "@" not in text and AT.search(text) is None:
        return [], []
    finds = plain_finds(text)
    nodes = [Place(a, b, kind, kind, kin_of(kind, text[a:b])) for kind, a, b in finds]
    taken = sorted((a, b) for _, a, b in finds)
    starts = [a for a, _ in taken]
    reach = list(np.maximum.accumulate([b for _, b in taken])) if taken else []
    for place in other_forms(text):
        # Not where a plain find already is: the last find that starts before its end must be over.
        i = int(np.searchsorted(starts, place.stop, side="left"))
        if i == 0 or reach[i - 1] <= place.start:
            nodes.append(place)
    return finds, sorted(nodes, key=lambda p: (p.start, p.stop, p.shape))


def skip_edges(nodes: list[Place]) -> list[tuple[int, int]]:
    """Ties between places of the same kin: to the plain find before, or the first one; to the next place if none is plain.

    So there are about as many edges as places, not as pairs, and each place hears a plain find at first hand.
    """
    first_plain: dict[tuple[str, str], int] = {}
    for i in reversed(range(len(nodes))):
        if nodes[i].label is not None:
            first_plain.update((kin, i) for kin in nodes[i].kin)
    edges, last = set(), {}
    for i, node in enumerate(nodes):
        for kin in [k for k in node.kin if k in first_plain] or node.kin:
            if (other := last.get(kin, first_plain.get(kin))) not in (None, i):
                edges.add((min(other, i), max(other, i)))
            if kin not in first_plain or node.label is not None:
                last[kin] = i
    return sorted(edges)


def context(text: str, place: Place) -> int:
    word = BEFORE.search(text[max(0, place.start - 24) : place.start])
    return zlib.crc32(word[1].lower().encode()) % CONTEXTS if word else 0


def kin_to_finds(nodes: list[Place], edges: list[tuple[int, int]]) -> list[bool]:
    """Whether a place is tied to a plain find, over any number of skip edges."""
    group = list(range(len(nodes)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for a, b in edges:
        group[root(a)] = root(b)
    found = {root(i) for i, n in enumerate(nodes) if n.label is not None}
    return [root(i) in found for i in range(len(nodes))]


def situations(text: str) -> Iterator[tuple[int, ...]]:
    """(shape, context, form, labels before and after in the text, before and after among kin, label) of trained places."""
    _, nodes = places_of(text)
    if not nodes:
        return
    edges = skip_edges(nodes)
    asked = [k and n.label is None for k, n in zip(kin_to_finds(nodes, edges), nodes, strict=True)]
    label = [NOBODY if a else OTHER if n.label is None else n.label for a, n in zip(asked, nodes, strict=True)]
    before, after = {b: a for a, b in edges}, {a: b for a, b in edges}
    for i, node in enumerate(nodes):
        if not asked[i]:
            yield (
                node.shape, context(text, node), FORM_OTHER if node.label is None else FORM_PLAIN,
                label[i - 1] if i else NOBODY, label[i + 1] if i + 1 < len(nodes) else NOBODY,
                label[before[i]] if i in before else NOBODY, label[after[i]] if i in after else NOBODY, label[i],
            )


@dataclass(frozen=True)
class SkipChain:
    """Log potentials."""

    shape: np.ndarray  # kinds x labels
    context: np.ndarray  # CONTEXTS x labels
    form: np.ndarray  # 2 x labels
    chain: np.ndarray  # labels x labels, symmetric
    skip: np.ndarray


def fit(counts: dict[tuple[int, ...], int], *, steps: int = 400, rate: float = 0.5, weight: float = 2e-3) -> SkipChain:
    """Ascend the pseudo-likelihood of the counted situations, with a quadratic penalty.

    Potentials are drawn to 0, those of equal labels along a skip edge to ``AGREEMENT``: kin agrees unless the
    documents show otherwise, also for a kind that they never repeat.
    """
    sizes = {"shape": (len(KINDS), LABELS), "context": (CONTEXTS, LABELS), "form": (3, LABELS)}
    p = {k: np.zeros(v) for k, v in sizes.items()} | {k: np.zeros((LABELS + 1, LABELS)) for k in ("chain", "skip")}
    drawn_to = {k: np.zeros_like(v) for k, v in p.items()}
    drawn_to["skip"][:LABELS] = AGREEMENT * np.eye(LABELS)
    p["skip"] += drawn_to["skip"]
    rows = sorted(counts)
    if rows:
        table = np.array(rows)
        table = np.vstack([table, table])
        table[len(rows) :, 2] = FORM_HIDDEN
        # Counts by their root: what is met everywhere shall not drown what is met rarely.
        share = np.sqrt(np.tile([counts[r] for r in rows], 2).astype(float))
        share /= share.sum()
        parts = [("shape", 0), ("context", 1), ("form", 2), ("chain", 3), ("chain", 4), ("skip", 5), ("skip", 6)]
        speed = {k: np.zeros_like(v) for k, v in p.items()}
        for _ in range(steps):
            z = sum(p[name][table[:, c]] for name, c in parts)
            error = np.exp(z - z.max(axis=1, keepdims=True))
            error /= -error.sum(axis=1, keepdims=True)
            error[np.arange(len(table)), table[:, 7]] += 1
            error *= share[:, None]
            step = {k: weight * (drawn_to[k] - v) for k, v in p.items()}
            for name, c in parts:
                np.add.at(step[name], table[:, c], error)
            for k in p:
                if k in ("chain", "skip"):  # one potential for an edge, from whichever end it is seen
                    step[k][:LABELS] = (step[k][:LABELS] + step[k][:LABELS].T) / 2
                    step[k][NOBODY] = 0
                elif k == "form":
                    step[k][FORM_HIDDEN] = 0
                speed[k] = 0.9 * speed[k] + step[k]
                p[k] += rate * speed[k]
    return SkipChain(p["shape"], p["context"], p["form"][:2], p["chain"][:LABELS], p["skip"][:LABELS])


def beliefs(model: SkipChain, text: str, nodes: list[Place]) -> np.ndarray:
    """Label probabilities of all places after loopy message passing (sum-product, damped)."""
    local = np.stack(
        [model.shape[n.shape] + model.context[context(text, n)] + model.form[FORM_OTHER] for n in nodes]
    )
    for i, n in enumerate(nodes):
        if n.label is not None:  # a plain find is certain
            local[i] = -1e6
            local[i, n.label] = 0.0
    skips = skip_edges(nodes)
    chains = [(i, i + 1) for i in range(len(nodes) - 1)]
    edges = np.array(chains + skips).reshape(-1, 2)
    potential = np.exp(np.stack([model.chain] * len(chains) + [model.skip] * len(skips))) if len(edges) else None
    belief = local
    if potential is not None:
        source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
        potential = np.concatenate([potential, potential.transpose(0, 2, 1)])
        back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
        messages = np.zeros((len(source), LABELS))
        for _ in range(ROUNDS):
            belief = local.copy()
            np.add.at(belief, target, messages)
            sent = belief[source] - messages[back]
            sent = np.exp(sent - sent.max(axis=1, keepdims=True))
            new = np.log(np.einsum("es,est->et", sent, potential))
            new -= new.max(axis=1, keepdims=True)
            messages = 0.5 * messages + 0.5 * new
        belief = local.copy()
        np.add.at(belief, target, messages)
    e = np.exp(belief - belief.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def find_spans(model: SkipChain, text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, stop, plain) in order; places in another form count if the model gives them a kind."""
    finds, nodes = places_of(text)
    spans = [(*f, True) for f in finds]
    if any(n.label is None for n in nodes):
        for node, belief in zip(nodes, beliefs(model, text, nodes), strict=True):
            kind = int(belief.argmax())
            if node.label is None and kind != OTHER:
                spans.append((kind, node.start, node.stop, False))
    return sorted(set(spans))


def train(docs: DataFrame, text: str = "text") -> SkipChain:
    """Count the situations of all documents, and fit the potentials to them."""
    prepare_workers(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, ...]] = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(situations(value.as_py() or ""))
        keys = pa.array([",".join(map(str, k)) for k in counts], pa.string())
        yield pa.RecordBatch.from_arrays([keys, pa.array(list(counts.values()), pa.int64())], ["situation", "times"])

    counted = docs.select(quoted(text).alias("text")).mapInArrow(count, "situation string, times long")
    # Bounded by the features' values, however many documents there are.
    rows = counted.groupBy("situation").agg(F.sum("times").alias("times")).collect()
    return fit({tuple(map(int, r.situation.split(","))): r.times for r in rows})


def span_column(model: SkipChain, text: Column) -> Column:
    @F.arrow_udf("array<struct<kind: string, start: int, stop: int, plain: boolean>>")
    def of_batch(texts: pa.Array) -> pa.Array:
        return pa.array(
            [
                [{"kind": KINDS[k], "start": a, "stop": b, "plain": p} for k, a, b, p in find_spans(model, t.as_py() or "")]
                for t in texts
            ],
            pa.list_(
                pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("plain", pa.bool_())])
            ),
        )

    return of_batch(text)


def find_personal_data(docs: DataFrame, *, text: str = "text", model: SkipChain | None = None) -> DataFrame:
    """Add ``spans``: personal data in each whole text, by kind and start; without ``model``, train one on ``docs``.

    A span has ``kind`` (email, ip, card, phone), ``start`` and ``stop`` in code points, end exclusive, and ``plain``:
    found by a pattern, not by the field.

    * A null or empty text has no spans. Spans of a kind are apart; those of different kinds may overlap.
    * Texts are judged one by one: rows that come again get equal spans. An empty table gives an empty one.
    * An input column named ``spans``, in any case, is replaced.
    """
    prepare_workers(docs.sparkSession)
    model = model or train(docs, text)
    names = other_columns(docs, ["spans"])
    return docs.select(*(quoted(c) for c in names), span_column(model, quoted(text)).alias("spans"))
