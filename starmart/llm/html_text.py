"""Main text of web pages, by a recurrent labeller of their blocks.

A page is a sequence of leaf blocks (``html_blocks``). Each becomes a vector: the hashed elements and names of its tag
path, its hashed words, and a few measures. A bidirectional LSTM in numpy reads the whole sequence in both directions, so
that every block is labelled article or not in the context of its document. It is trained by back-propagation through
time, with Adam, on a bounded sample of pages whose markup names their parts (``article`` or ``main``), and on pages of
invented layouts around those pages' paragraphs, so that it does not depend on one site's layout.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import other_columns, prepare_workers
from starmart.llm.html_blocks import Block, Inventor, invented_page, read_blocks

SAMPLE_PAGES = 240  # pages to learn from, at most; all are read
SAMPLE_CHARS = 1 << 16  # of a page to learn from
PATH_BUCKETS, WORD_BUCKETS, MEASURES = 8192, 256, 8
EMBEDDED, HIDDEN = 24, 20  # sizes of a block's vector and of each direction's state
PAGES_AT_ONCE, STEPS, LEARNING_RATE = 24, 600, 0.012
BLOCKS_AT_ONCE = 1 << 14  # of pages that are labelled together
# Parts of a page by their elements, for pages to learn from.
ARTICLE_ELEMENTS = frozenset(("article", "main"))
OTHER_ELEMENTS = frozenset(("nav", "aside", "footer", "form"))


def _bucket(token: str, buckets: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % buckets


@lru_cache(maxsize=1 << 14)
def path_buckets(path: tuple[str, ...]) -> tuple[int, ...]:
    """Buckets of a path's elements and names; those of the innermost elements count again by their place."""
    found = {0}  # never empty
    for depth, element in enumerate(reversed(path)):
        tag, *names = element.split(" ")
        for name in names:
            found.add(_bucket(f"name {name.removesuffix('s')}", PATH_BUCKETS))
        found.add(_bucket(f"in {tag}", PATH_BUCKETS))
        if depth < 2:
            found.add(_bucket(f"{depth} {tag}", PATH_BUCKETS))
    return tuple(sorted(found))


@lru_cache(maxsize=1 << 17)
def word_bucket(word: str) -> int:
    return _bucket(word, WORD_BUCKETS)


class Features:
    """The vectors of some blocks, not yet embedded."""

    def __init__(self, blocks: Sequence[Block]) -> None:
        paths: dict[tuple[str, ...], int] = {}
        self.path = np.array([paths.setdefault(b.path, len(paths)) for b in blocks], np.int64)
        # Buckets of all distinct paths, one after the other, and where each begins.
        self.buckets = np.array([b for path in paths for b in path_buckets(path)], np.int64)
        sizes = np.array([len(path_buckets(path)) for path in paths], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.bucket_path = np.repeat(np.arange(len(paths)), sizes)
        self.words = np.zeros((len(blocks), WORD_BUCKETS), np.float32)
        self.measures = np.zeros((len(blocks), MEASURES), np.float32)
        for i, block in enumerate(blocks):
            words = block.text.lower().split()
            counts = np.bincount(np.fromiter(map(word_bucket, words), np.int64, len(words)), minlength=WORD_BUCKETS)
            self.words[i] = np.sqrt(counts / len(words))
            size, text = len(block.text), block.text
            self.measures[i] = (
                math.log1p(size) / 6, math.log1p(len(words)) / 4, block.in_links / size, text[-1] in ".!?…:;",
                "©" in text, text[0].isupper(), size < 40, 1,
            )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Labeller:
    """Weights of the network. ``direction`` 0 reads forwards, 1 backwards."""

    def __init__(self, seed: int = 12) -> None:
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

        self.weights = {
            "path": start(PATH_BUCKETS, EMBEDDED) * 16, "word": start(WORD_BUCKETS, EMBEDDED), "measure": start(MEASURES, EMBEDDED),
            "out": start(2 * HIDDEN, 1), "out_bias": np.zeros(1, np.float32),
        }
        for d in (0, 1):
            self.weights[f"in{d}"] = start(EMBEDDED, 4 * HIDDEN)
            self.weights[f"state{d}"] = start(HIDDEN, 4 * HIDDEN)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
            self.weights[f"bias{d}"] = bias

    def embed(self, features: Features) -> np.ndarray:
        w = self.weights
        paths = np.add.reduceat(w["path"][features.buckets], features.starts, axis=0)
        return np.tanh(paths[features.path] + features.words @ w["word"] + features.measures @ w["measure"])

    def run(self, x: np.ndarray, mask: np.ndarray, d: int, keep: list | None = None) -> np.ndarray:
        """States (steps, pages, HIDDEN) of one direction; past a page's end its state stays as it was."""
        steps, pages, _ = x.shape
        w = self.weights
        # All steps' inputs at once.
        inputs = x.reshape(-1, x.shape[2]) @ w[f"in{d}"] + w[f"bias{d}"]
        inputs = inputs.reshape(steps, pages, -1)
        h = c = np.zeros((pages, HIDDEN), np.float32)
        states = np.empty((steps, pages, HIDDEN), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            z = inputs[t] + h @ w[f"state{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = m * (f * c + i * g) + (1 - m) * c
            squashed = np.tanh(new_c)
            new_h = m * (o * squashed) + (1 - m) * h
            if keep is not None:
                keep.append((t, i, f, o, g, c, h, squashed, m))
            states[t] = new_h
            h, c = new_h, new_c
        return states

    def logits(self, states: np.ndarray) -> np.ndarray:
        return (states @ self.weights["out"])[..., 0] + self.weights["out_bias"][0]

    def label(self, pages: Sequence[Sequence[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks belong to the article."""
        blocks = [b for page in pages for b in page]
        lengths = [len(p) for p in pages]
        if not blocks:
            return [np.zeros(0, bool) for _ in pages]
        parts = range(0, len(blocks), 2048)
        x = np.concatenate([self.embed(Features(blocks[at : at + 2048])) for at in parts])
        starts = np.cumsum([0, *lengths])
        x, mask = _laid_out([x[a:b] for a, b in zip(starts, starts[1:], strict=False)])
        states = np.concatenate([self.run(x, mask, 0), self.run(x, mask, 1)], axis=2)
        found = self.logits(states) > 0
        return [found[: lengths[p], p] for p in range(len(pages))]

    def gradients(self, pages: Sequence[tuple[Features, np.ndarray]]) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss a block, and its gradient, over pages of (features, labels)."""
        w = self.weights
        embedded = [self.embed(f) for f, _ in pages]
        x, mask = _laid_out(embedded)
        steps, n, _ = x.shape
        target = np.zeros((steps, n), np.float32)
        for p, (_, labels) in enumerate(pages):
            target[: len(labels), p] = labels
        kept: tuple[list, list] = ([], [])
        states = np.concatenate([self.run(x, mask, d, kept[d]) for d in (0, 1)], axis=2)
        chance = _sigmoid(self.logits(states))
        total = mask.sum()
        right = np.where(target > 0, chance, 1 - chance)
        loss = float(-(np.log(np.maximum(right, 1e-7)) * mask).sum() / total)
        error = ((chance - target) * mask / total).astype(np.float32)
        found = {k: np.zeros_like(v) for k, v in w.items()}
        found["out"] = states.reshape(-1, 2 * HIDDEN).T @ error.reshape(-1, 1)
        found["out_bias"] = np.array([error.sum()], np.float32)
        d_states = error[:, :, None] * w["out"][:, 0]
        d_x = np.zeros_like(x)
        for d in (0, 1):
            d_z = np.zeros((steps, n, 4 * HIDDEN), np.float32)
            before = np.zeros((steps, n, HIDDEN), np.float32)
            d_h = d_c = np.zeros((n, HIDDEN), np.float32)
            for t, i, f, o, g, c, h, squashed, m in reversed(kept[d]):
                d_h = d_h + d_states[t, :, d * HIDDEN : (d + 1) * HIDDEN]
                inner = m * d_h
                d_new = d_c + inner * o * (1 - squashed**2)
                live = m * d_new
                d_z[t] = np.concatenate(
                    [live * g * i * (1 - i), live * c * f * (1 - f), inner * squashed * o * (1 - o), live * i * (1 - g**2)],
                    axis=1,
                )
                before[t] = h
                d_h = d_z[t] @ w[f"state{d}"].T + (1 - m) * d_h
                d_c = live * f + (1 - m) * d_new
            flat = d_z.reshape(-1, 4 * HIDDEN)
            found[f"state{d}"] = before.reshape(-1, HIDDEN).T @ flat
            found[f"in{d}"] = x.reshape(-1, EMBEDDED).T @ flat
            found[f"bias{d}"] = flat.sum(axis=0)
            d_x += (flat @ w[f"in{d}"].T).reshape(x.shape)
        for p, (features, labels) in enumerate(pages):
            d_e = d_x[: len(labels), p] * (1 - embedded[p] ** 2)
            by_path = np.zeros((len(features.starts), EMBEDDED), d_e.dtype)
            np.add.at(by_path, features.path, d_e)
            np.add.at(found["path"], features.buckets, by_path[features.bucket_path])
            found["word"] += features.words.T @ d_e
            found["measure"] += features.measures.T @ d_e
        return loss, found


def _laid_out(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages side by side: (steps, pages, size) and a mask of the steps that a page has."""
    steps = max(len(p) for p in pages)
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for i, page in enumerate(pages):
        x[: len(page), i], mask[: len(page), i] = page, 1
    return x, mask


def train(pages: Sequence[tuple[Sequence[Block], Sequence[int]]], *, steps: int = STEPS, seed: int = 12) -> Labeller:
    """A labeller from pages of (blocks, labels), by Adam with a falling rate."""
    model = Labeller(seed)
    ready = [(Features(blocks), np.array(labels, np.float32)) for blocks, labels in pages if blocks]
    if not ready:
        return model
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(ready), min(PAGES_AT_ONCE, len(ready)))
        _, found = model.gradients([ready[i] for i in chosen])
        norm = math.sqrt(sum(float((g**2).sum()) for g in found.values()))
        rate = LEARNING_RATE * min(1.0, 1.2 - step / steps)
        for k, g in found.items():
            g = g * min(1.0, 2.0 / (norm + 1e-12))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g**2 - second[k])
            step_size = rate * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            model.weights[k] -= (step_size * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return model


def named_parts(blocks: Sequence[Block]) -> list[int] | None:
    """Labels of a page whose elements name its article; None if they do not."""
    labels = []
    for block in blocks:
        tags = {element.split(" ", 1)[0] for element in block.path}
        labels.append(int(bool(tags & ARTICLE_ELEMENTS) and not tags & OTHER_ELEMENTS))
    return labels if any(labels) else None


def training_pages(
    sample: Sequence[str], *, invented: int = 2600, seed: int = 12
) -> list[tuple[Sequence[Block], Sequence[int]]]:
    """The sampled pages whose parts are named, and ``invented`` ones around their paragraphs."""
    own = []
    for html in sample:
        blocks = read_blocks(html)
        labels = named_parts(blocks)
        if labels is not None:
            own.append((blocks, labels))
    prose = [b.text for blocks, labels in own for b, article in zip(blocks, labels, strict=True) if article]
    inventor = Inventor(seed, [t for t in prose if len(t) >= 20])
    return own + [invented_page(inventor) for _ in range(invented)]


def fit_labeller(pages: DataFrame, *, html: str = "html", sample: int = SAMPLE_PAGES, steps: int = STEPS) -> Labeller:
    """Train on at most ``sample`` pages of at most SAMPLE_CHARS characters, chosen by a hash of their content."""
    source = quoted(html)
    named = pages.where(F.length(source) <= SAMPLE_CHARS).where(F.lower(source).rlike("<(article|main)[ >]"))
    keyed = named.select(source.alias("html"), F.pmod(F.xxhash64(source), F.lit(1 << 30)).alias("key"))
    # About twice as many as wanted, so that few come from each task; of equal pages one.
    share = min(1.0, 2 * (sample + 20) / max(1, named.count()))
    few = keyed.where(F.col("key") < int(share * (1 << 30))).dropDuplicates(["key"])
    chosen = few.orderBy("key", "html").limit(sample)
    return train(training_pages([r.html for r in chosen.collect()]), steps=steps)


def text_column(model: Labeller, html: Column, spark) -> Column:
    shared = spark.sparkContext.broadcast(model.weights)
    kept: dict[str, Labeller] = {}

    @F.arrow_udf("string")
    def of_batch(pages: pa.Array) -> pa.Array:
        if "model" not in kept:
            kept["model"] = Labeller()
            kept["model"].weights = shared.value
        model = kept["model"]
        texts = [""] * len(pages)
        for group in _groups(pages):
            labels = model.label([blocks for _, blocks in group])
            for (i, blocks), article in zip(group, labels, strict=True):
                texts[i] = "\n".join(b.text for b, a in zip(blocks, article.tolist(), strict=True) if a)
        return pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string())

    return of_batch(html)


def _groups(pages: pa.Array) -> Iterator[list[tuple[int, list[Block]]]]:
    """Pages of about the same number of blocks, so many at a time that their steps stay few."""
    read: list[tuple[int, list[Block]]] = []
    held = 0
    for i, html in enumerate(pages):
        blocks = read_blocks(html.as_py())
        if not blocks:
            continue
        read.append((i, blocks))
        held += len(blocks)
        if held >= BLOCKS_AT_ONCE:
            yield from _alike(read)
            read, held = [], 0
    yield from _alike(read)


def _alike(read: list[tuple[int, list[Block]]]) -> Iterator[list[tuple[int, list[Block]]]]:
    group: list[tuple[int, list[Block]]] = []
    for page in sorted(read, key=lambda p: len(p[1])):
        if group and len(page[1]) > 2 * len(group[0][1]) + 8:
            yield group
            group = []
        group.append(page)
    if group:
        yield group


def extract_text(pages: DataFrame, *, html: str = "html", model: Labeller | None = None, **fit) -> DataFrame:
    """The input with ``text``, the page's article, and ``n_chars``, its code points.

    Without ``model`` one is trained first, on ``pages`` (``fit_labeller``). Character references are decoded, white space
    inside a block becomes one space, blocks are joined in page order by a line feed; nothing else is dropped or cut.

    * A page that is null, empty or has no text gives an empty text. Tags left open or closed in any order are read as far as they go.
    * Pages of any length are read whole. Equal pages get equal texts; rows that come again stay.
    * An empty table gives an empty one. A table without a page that names its parts is labelled by what invented layouts teach.
    * Input columns named like a result, in any case, are replaced.
    """
    prepare_workers(pages.sparkSession)
    model = model or fit_labeller(pages, html=html, **fit)
    names = other_columns(pages, ("text", "n_chars"))
    found = text_column(model, quoted(html), pages.sparkSession)
    extracted = pages.select(*(quoted(c) for c in names), found.alias("text"))
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
