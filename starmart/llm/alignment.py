"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and how often ids are linked corpus-wide.

Tokens of both tokenizers lie on the bytes of one text. Those that overlap belong together; a group ends where tokens of
both end. Groups are labelled by pointer jumping: every token points to the overlapping token that reaches farthest to
the right, and the successors are doubled, all tokens at once, until each points to the last token of its group.

Neither tokenizer has a token across a space between two other characters that are not white space, so such spaces
always part groups. Texts are cut there, and equal pieces are tokenized and grouped once, as long as a worker
keeps them; frequent ones it keeps on. New pieces go to the byte tokenizer many at a time, as one text.

The documents of a task are dealt into chunks of bounded size. A chunk tells once how many of its documents hold each
pair of ids linked; the corpus-wide counts are joined back to the chunks' pairs, and then meet the documents of the chunk,
which know their pairs by place. So a pair that stands in all documents is a row a chunk, never a row a document.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import prepare_workers, staged
from starmart.llm.tokens import AS_CHARACTER, tokenizer_path

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
LONG_PIECE = 80  # characters; longer pieces of a text are not kept
KEPT_BYTES = 40 << 20  # of pieces a worker keeps; as much of those before
PIECE_COST = 380  # of a kept piece, besides its texts
CHUNK_PAIRS = 1 << 19  # pairs of the documents of a chunk
CROSS_AT_ONCE = 1 << 12  # links of a group that are written out one by one
TOGETHER = 64  # pieces that are given to a tokenizer as one text


def farthest_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token of A, then of B, its label: the last token of A in its group.

    Both arrays are the rising end offsets of tokens that lie end to end on the same bytes from 0. By pointer jumping.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    # The last token of the other side that starts before this one ends is the one that holds its last byte.
    over_a = np.searchsorted(ends_b, ends_a, "left")
    over_b = np.searchsorted(ends_a, ends_b, "left")
    successor = np.empty(n_a + n_b, np.int64)
    # A token of A with none that reaches farther is the last of its group.
    successor[:n_a] = np.where(ends_b[over_a] > ends_a, over_a + n_a, np.arange(n_a)) if n_b else np.arange(n_a)
    successor[n_a:] = over_b
    while True:
        farther = successor[successor]
        if (farther == successor).all():
            return successor
        successor = farther


class Vocabulary:
    """The bytes of every id, and ids of many pieces at once."""

    def __init__(self, name: str) -> None:
        path = tokenizer_path(name)
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True  # their strings in a text are plain text
            as_byte = {chr(c): bytes([c]) for c in range(256) if c not in AS_CHARACTER}
            as_byte |= {chr(c): bytes([b]) for b, c in AS_CHARACTER.items()}
            shown = sorted((i, t) for t, i in tokenizer.get_vocab().items())
            self.bytes = {i: b"".join(as_byte.get(c, c.encode()) for c in t) for i, t in shown}
            self._ids = lambda pieces: [
                e.ids for e in tokenizer.encode_batch_fast([f" {p}" for p in pieces], add_special_tokens=False)
            ]
            self.together = TOGETHER
        else:
            from sentencepiece import SentencePieceProcessor

            processor = SentencePieceProcessor(model_file=path)
            self.bytes = {}
            for i in range(processor.get_piece_size()):
                piece = processor.id_to_piece(i)
                byte = BYTE_PIECE.fullmatch(piece) if processor.is_byte(i) else None
                self.bytes[i] = bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode()
            # It puts the space before a text by itself.
            self._ids = lambda pieces: processor.encode(pieces, num_threads=1)
            self.together = 1  # many short texts cost it no more than a few long ones
        size = max(self.bytes, default=-1) + 1
        self.lengths = np.zeros(size, np.int64)
        self.lengths[list(self.bytes)] = [len(v) for v in self.bytes.values()]
        self.by_id = pa.array([self.bytes.get(i) for i in range(size)], pa.large_binary())

    def encode(self, pieces: list[str], n_firm: int, whole: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row and how many each has; none for a piece whose tokens do not give its bytes.

        The first ``n_firm`` pieces neither begin nor end with white space. ``whole`` is all pieces' bytes in a row, each
        with its space, and ``ends`` where each ends.
        """
        if self.together > 1:
            # Firm pieces stand side by side as they do in a text, so they have the same tokens.
            texts = [" ".join(pieces[i : min(i + self.together, n_firm)]) for i in range(0, n_firm, self.together)]
            ids, _ = _in_a_row(self._ids(texts + pieces[n_firm:]))
            token_ends = np.cumsum(self.lengths[ids])
            until = np.searchsorted(token_ends, ends) + 1
            if (
                len(ids)
                and until[-1] == len(ids)
                and (token_ends[until - 1] == ends).all()
                and self.lengths[ids].all()
                and self.joined(ids) == whole
            ):
                return ids, np.diff(until, prepend=0)
        ids, counts = _in_a_row(self._ids(pieces))
        token_ends = np.append(0, np.cumsum(self.lengths[ids]))[np.cumsum(counts)]
        if (token_ends == ends).all() and self.joined(ids) == whole:
            return ids, counts
        until, texts = np.cumsum(counts), np.append(0, ends).tolist()
        sound = np.array(
            [
                self.joined(ids[i : i + n]) == whole[start:end]
                for i, n, start, end in zip((until - counts).tolist(), counts.tolist(), texts, texts[1:], strict=False)
            ]
        )
        return ids[np.repeat(sound, counts)], np.where(sound, counts, 0)

    def joined(self, ids: np.ndarray) -> bytes:
        data = self.by_id.take(pa.array(ids)).buffers()[2]
        return data.to_pybytes()[: self.lengths[ids].sum()] if data else b""


def _in_a_row(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and how many each list has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, counts.sum()), counts


def _is_loose(piece: str) -> bool:
    """Whether a piece begins or ends with white space."""
    return piece[0].isspace() or piece[-1].isspace()


class Kept:
    """What is known of pieces: groups as text, counts, pairs of linked ids."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[str | None] = []  # each with a ; at its end; None: the bytes differ
        self.counts = _Rows(np.zeros((0, 4), np.int64))  # tokens of A, of B, groups, links
        self.spans = _Rows(np.zeros((0, 2), np.int64))  # where a piece's pairs stand
        self.pairs = _Rows(np.zeros((0, 2), np.int64))  # packed ids, each pair once, and how often it is linked
        self.size = 0

    def add(self, pieces: list[str], groups: list[str | None], counts, n_pairs, pairs) -> None:  # noqa: ANN001
        """Pieces with their groups and counts, how many pairs each has, and these in a row."""
        self.groups += groups
        self.counts.add(counts)
        ends = self.pairs.n + np.cumsum(n_pairs)
        self.spans.add(np.stack([ends - n_pairs, ends], axis=1))
        self.pairs.add(pairs)
        self.size += PIECE_COST * len(pieces) + sum(map(len, pieces)) + 7 * int(counts[:, :2].sum())

    def pairs_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many pairs the pieces at the places have, and these in a row."""
        start, stop = self.spans.held[places].T
        size = stop - start
        return size, self.pairs.held[np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)]


class Pieces:
    """What is known of the pieces of now and those before; what is met again moves from these to those.

    So frequent pieces stay when the others go. Both are bounded by bytes.
    """

    def __init__(self, first: str, second: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        self.a, self.b = Vocabulary(first), Vocabulary(second)
        # Ids as text, with each sign that may follow.
        self.shown_a = {end: np.array([f"{i}{end}" for i in range(len(self.a.lengths))], object) for end in ",|"}
        self.shown_b = {end: np.array([f"{i}{end}" for i in range(len(self.b.lengths))], object) for end in ",;"}
        self.now, self.before = Kept(), Kept()

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For the pieces of each text, their places in ``now``; valid until the next call."""
        if self.now.size > KEPT_BYTES:
            self.now, self.before = Kept(), self.now
        places, long = self.now.places, {}
        pieces = list(chain.from_iterable(texts))
        found = np.fromiter(map(places.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            unknown = [pieces[i] for i in missing]
            new = set(unknown)
            again = new.intersection(self.before.places)
            if again:
                self._move(list(again))
                new -= again
            if new:
                # Only the first and the last piece of a text can begin or end with white space.
                loose = new.intersection(p for text in texts for p in text[:1] + text[-1:] if _is_loose(p))
                new = [*(new - loose), *loose]
                at = len(self.now.groups)
                self._align(new, len(new) - len(loose))
                if max(map(len, new)) <= LONG_PIECE:
                    places.update(zip(new, range(at, at + len(new)), strict=True))
                else:
                    for i, piece in enumerate(new, at):
                        (long if len(piece) > LONG_PIECE else places)[piece] = i
            found[missing] = [long[p] if p in long else places[p] for p in unknown]
        until = [0, *accumulate(map(len, texts))]
        return [found[i:j] for i, j in pairwise(until)]

    def _move(self, pieces: list[str]) -> None:
        """Take over pieces from those before."""
        before, at = self.before, len(self.now.groups)
        places = list(map(before.places.__getitem__, pieces))
        n_pairs, pairs = before.pairs_of(np.array(places))
        self.now.add(pieces, [before.groups[p] for p in places], before.counts.held[places], n_pairs, pairs)
        self.now.places.update(zip(pieces, range(at, at + len(pieces)), strict=True))

    def _align(self, pieces: list[str], n_firm: int) -> None:
        """Tokenize and group new pieces, all at once, as if they were one text.

        The first ``n_firm`` neither begin nor end with white space.
        """
        texts = [f" {p}".encode() for p in pieces]
        whole, ends = b"".join(texts), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        (flat_a, n_a), (flat_b, n_b) = (v.encode(pieces, n_firm, whole, ends) for v in (self.a, self.b))
        sound = (n_a > 0) & (n_b > 0)
        if not sound.all():
            flat_a, flat_b = flat_a[np.repeat(sound, n_a)], flat_b[np.repeat(sound, n_b)]
            n_a, n_b = np.where(sound, n_a, 0), np.where(sound, n_b, 0)
        label = farthest_tokens(np.cumsum(self.a.lengths[flat_a]), np.cumsum(self.b.lengths[flat_b]))
        # Tokens lie in order, so groups are runs; the label is the last token of A in each.
        last, group = np.unique(label, return_inverse=True)
        group_a, group_b = group[: len(flat_a)], group[len(flat_a) :]
        in_a, in_b = np.bincount(group_a, minlength=len(last)), np.bincount(group_b, minlength=len(last))
        piece_of = np.repeat(np.arange(len(pieces)), n_a)[last] if len(last) else np.zeros(0, np.int64)

        groups = self._groups(flat_a, flat_b, group_a, group_b, in_a, in_b, n_a, n_b)
        links = np.bincount(piece_of, in_a * in_b, len(pieces)).astype(np.int64)
        counts = np.stack([n_a, n_b, np.bincount(piece_of, minlength=len(pieces)), links], axis=1)
        self.now.add(pieces, groups, counts, *self._pairs(flat_a, flat_b, in_a, in_b, piece_of, len(pieces)))

    def _groups(self, flat_a, flat_b, group_a, group_b, in_a, in_b, n_a, n_b) -> list[str | None]:  # noqa: ANN001
        """The text of every piece's groups: ids of A in a group, then of B, each with the sign that follows it."""
        shown = np.empty(len(flat_a) + len(flat_b), object)
        both = np.cumsum(in_a + in_b) - in_a - in_b  # tokens of the groups before
        for flat, group, inside, start, signs in (
            (flat_a, group_a, in_a, both, self.shown_a),
            (flat_b, group_b, in_b, both + in_a, self.shown_b),
        ):
            nth = np.arange(len(flat)) - (np.cumsum(inside) - inside)[group]
            between, after = signs.values()
            shown[start[group] + nth] = np.where(nth == inside[group] - 1, after[flat], between[flat])
        parts, until = shown.tolist(), [0, *np.cumsum(n_a + n_b).tolist()]
        return ["".join(parts[i:j]) or None for i, j in pairwise(until)]

    @staticmethod
    def _pairs(flat_a, flat_b, in_a, in_b, piece_of, n_pieces) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
        """How many distinct pairs every piece has; these in a row, and how often they are linked."""
        start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        links = in_a * in_b
        usual = links <= CROSS_AT_ONCE
        # All links of the usual groups: the nth of a group has token n // b of A and n % b of B.
        groups = np.repeat(np.flatnonzero(usual), links[usual])
        nth = np.arange(len(groups)) - np.repeat(np.cumsum(links[usual]) - links[usual], links[usual])
        a = flat_a[start_a[groups] + nth // in_b[groups]] if len(groups) else np.zeros(0, np.int64)
        b = flat_b[start_b[groups] + nth % in_b[groups]] if len(groups) else np.zeros(0, np.int64)
        piece, pairs, times = piece_of[groups], a << 32 | b, np.ones(len(groups), np.int64)
        for g in np.flatnonzero(~usual).tolist():
            more, often = _distinct_links(
                flat_a[start_a[g] : start_a[g] + in_a[g]], flat_b[start_b[g] : start_b[g] + in_b[g]]
            )
            piece = np.append(piece, np.full(len(more), piece_of[g]))
            pairs, times = np.append(pairs, more), np.append(times, often)
        order = np.lexsort((pairs, piece))
        piece, pairs, times = piece[order], pairs[order], times[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (pairs[1:] != pairs[:-1]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(times, first) if len(first) else times
        return np.bincount(piece[first], minlength=n_pieces), np.stack([pairs[first], total], axis=1)


@lru_cache(maxsize=1)
def pieces_of_worker(first: str, second: str) -> Pieces:
    """What a Python worker knows; it goes from task to task."""
    return Pieces(first, second)


class _Rows:
    """Rows of numbers that more are added to."""

    def __init__(self, empty: np.ndarray) -> None:
        self.held, self.n = empty, 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.held):
            larger = np.empty((max(2 * len(self.held), self.n + len(rows)), self.held.shape[1]), np.int64)
            larger[: self.n] = self.held[: self.n]
            self.held = larger
        self.held[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


def _distinct_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a long group and how often each is linked."""
    (a, n_a), (b, n_b) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return (a[:, None] << 32 | b).ravel(), (n_a[:, None] * n_b).ravel()


def _binary(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


WORKING = "_llm_chunk long, _llm_places binary, _llm_times binary, _llm_pairs binary, _llm_documents binary"
WORKING_COLUMNS = [part.split()[0] for part in WORKING.split(", ")]
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_documents(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", first: str = BYTE_TOKENIZER, second: str = PIECE_TOKENIZER
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups) of every text, and columns ``_llm_*`` for ``with_corpus_links``.

    ``groups`` lists the groups in order, ``a1,a2|b1;a3|b2,b3``: ids of ``first`` for the text with a space before it,
    and of ``second``, which puts that space itself.
    """
    prepare_workers(docs.sparkSession)
    rows = docs.select(quoted(id).alias("_llm_id"), quoted(text).cast("binary").alias("_llm_text"))
    id_type = rows.schema["_llm_id"].dataType
    names = ["_llm_id", *COUNTS, "groups", *WORKING_COLUMNS]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces_of_worker(first, second)
        part, chunk = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        held_pairs = 0
        arrow_id = None

        def close() -> pa.RecordBatch:
            """The documents of a chunk; the last row has its distinct pairs and how many documents hold each."""
            number = part << 32 | chunk
            all_pairs = np.concatenate([r[-2] for r in held])
            distinct, documents = np.unique(all_pairs, return_counts=True)
            columns = list(zip(*(r[:-2] for r in held), strict=True))
            nothing = [None] * (len(held) - 1)
            places = [_binary(np.searchsorted(distinct, r[-2]), "<i4") for r in held]
            arrays = [pa.array(columns[0], arrow_id), *(pa.array(c, pa.int64()) for c in columns[1:5])]
            arrays += [pa.array(columns[5], pa.string()), pa.array([number] * len(held), pa.int64())]
            arrays += [pa.array(places, pa.binary()), pa.array([_binary(r[-1], "<i8") for r in held], pa.binary())]
            arrays += [pa.array([*nothing, _binary(distinct, "<i8")], pa.binary())]
            arrays += [pa.array([*nothing, _binary(documents, "<i8")], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            arrow_id = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 256):
                ids = batch.column(0).slice(at, 256).to_pylist()
                pieces = [_pieces_of(v.as_py()) for v in batch.column(1).slice(at, 256)]
                for doc, places in zip(ids, known.of(pieces), strict=True):
                    row, pairs, times = _document(known.now, places)
                    held.append((doc, *row, pairs, times))
                    held_pairs += len(pairs)
                    if held_pairs >= CHUNK_PAIRS:
                        yield close()
                        held, held_pairs, chunk = [], 0, chunk + 1
        if held:
            yield close()

    schema = f"_llm_id {id_type.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, groups string, {WORKING}"
    return rows.mapInArrow(align, schema).withColumnRenamed("_llm_id", id)


def _pieces_of(text: bytes | None) -> list[str]:
    """A text's pieces; none if it is null or empty or no valid UTF-8."""
    try:
        shown = (text or b"").decode()
    except UnicodeDecodeError:
        return []
    return BETWEEN_WORDS.split(shown) if shown else []


def _document(known: Kept, places: np.ndarray) -> tuple[tuple, np.ndarray, np.ndarray]:
    """Counts and groups of a text by its pieces; its distinct pairs and how often each is linked."""
    distinct, often = np.unique(places, return_counts=True)
    counts = known.counts.held[distinct]
    if not len(places) or not counts[:, 0].all():  # a piece's bytes differ
        return (0, 0, 0, 0, ""), np.zeros(0, np.int64), np.zeros(0, np.int64)
    groups = "".join(map(known.groups.__getitem__, places.tolist()))
    size, linked = known.pairs_of(distinct)
    pairs, times = linked.T
    order = np.argsort(pairs)
    pairs, times = pairs[order], (times * np.repeat(often, size))[order]
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    return (*(often @ counts).tolist(), groups[:-1]), pairs[first], np.add.reduceat(times, first)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(chunk, place, a, b, documents) of the chunks' distinct pairs of linked ids."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, documents in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                pairs, documents = np.frombuffer(pairs, "<i8"), np.frombuffer(documents, "<i8")
                columns = [np.full(len(pairs), chunk), np.arange(len(pairs)), pairs >> 32, pairs & 0xFFFFFFFF, documents]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["chunk", "place", "a", "b", "documents"])

    chunks = aligned.where("_llm_pairs IS NOT NULL").select("_llm_chunk", "_llm_pairs", "_llm_documents")
    return chunks.mapInArrow(unpack, "chunk long, place long, a long, b long, documents long")


def with_corpus_links(aligned: DataFrame) -> DataFrame:
    """Columns of ``aligned_documents``, the working ones replaced by ``n_best`` and ``count_sum``.

    The count of a pair of ids is the number of documents that hold it linked. ``count_sum`` adds it up over a document's
    links; ``n_best`` counts the links whose count is the highest of their first id, ties included.
    """
    aligned = staged(aligned, "aligned")
    parts = link_counts(aligned)
    counts = parts.groupBy("a", "b").agg(F.sum("documents").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    judged = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("is_best"))
    of_chunk = parts.join(judged, ["a", "b"]).select(F.col("chunk").alias("_llm_chunk"), "place", "count", "is_best")

    # Grouping takes column names without quoting them, so all go by plain ones here.
    names = [c for c in aligned.columns if c not in WORKING_COLUMNS]
    plain = [f"_llm_column_{i}" for i in range(len(names))]
    documents = aligned.select(
        *(quoted(c).alias(p) for c, p in zip(names, plain, strict=True)), "_llm_chunk", "_llm_places", "_llm_times"
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema if f.name in plain)

    def add_up(documents: pa.Table, counts: pa.Table) -> pa.Table:
        size = counts.num_rows
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = counts.column("place").to_numpy()
        count[place] = counts.column("count").to_numpy()
        best[place] = counts.column("is_best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for places, times in zip(
            documents.column("_llm_places").to_pylist(), documents.column("_llm_times").to_pylist(), strict=True
        ):
            places, times = np.frombuffer(places, "<i4"), np.frombuffer(times, "<i8")
            n_best.append(int(times @ best[places]))
            count_sum.append(int(times @ count[places]))
        kept = documents.select(plain)
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64())
        )

    summed = (
        documents.groupBy("_llm_chunk")
        .cogroup(of_chunk.groupBy("_llm_chunk"))
        .applyInArrow(add_up, f"{schema}, n_best long, count_sum long")
    )
    return summed.toDF(*names, "n_best", "count_sum")


def align_tokenizers(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", first: str = BYTE_TOKENIZER, second: str = PIECE_TOKENIZER
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every row.

    ``n_links`` counts the pairs of tokens of both tokenizers that share a group, whatever their ids.

    * A text that is null or empty, or whose tokens of either tokenizer do not give its bytes back, has no tokens: zeros and
      empty ``groups``. So has one that is no valid UTF-8.
    * Texts of special tokens are plain text. Texts of any length are read whole.
    * Rows that come again, or share an id, are documents of their own, each counted. Among ids linked as often as the
      highest all are best. An empty table gives an empty one. Other columns do not matter, whatever their names.
    """
    return with_corpus_links(aligned_documents(docs, id=id, text=text, first=first, second=second))
