"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents become pieces of at most ``capacity`` tokens; a full piece is a sequence by itself. The others are
dealt at random into districts of about ``DISTRICT`` pieces, each small enough for one task. In every district
several islands evolve packings of the same pieces. A child is made of one parent by injecting whole well-filled
bins of another: bins that hold a piece for the second time are dissolved, and so is the worst of the rest;
the displaced pieces go where they fit best, largest first. Between epochs every island sends its best packing to
the next one. The best packing of a district is taken.

Bins that are still poorly filled are pooled over all districts and packed again in new, fewer districts, whole
bins moving together, so that a round never makes a packing worse. Only (place, length) pairs are shuffled,
never tokens; every epoch is a grouped task on a bounded number of rows, with a seed of its own, so a lost
executor repeats it to the same result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starmart.functions.columns import quoted
from starmart.llm.common import prepare_workers, staged
from starmart.llm.tokens import TOKENIZER, WordTokenizer

DISTRICT = 1000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 5
POPULATION = 4
FULL_ENOUGH = 0.995  # bins below are pooled for the next round
ROUNDS = 3

Packing = list[list[int]]  # bins of piece numbers


def best_fit(bins: Packing, room: list[int], lengths: list[int], pieces: list[int], capacity: int) -> None:
    """Put ``pieces``, largest first, each into the fullest bin that has room; open bins as needed."""
    by_room = sorted((r, b) for b, r in enumerate(room) if r)
    for piece in sorted(pieces, key=lengths.__getitem__, reverse=True):
        length = lengths[piece]
        at = bisect_left(by_room, (length, -1))
        if at < len(by_room):
            left, b = by_room.pop(at)
            left -= length
            bins[b].append(piece)
        else:
            b, left = len(bins), capacity - length
            bins.append([piece])
            room.append(0)
        room[b] = left
        if left:
            insort(by_room, (left, b))


def fitness(bins: Packing, lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; among as many, the mean squared fill, which rewards full bins beside emptier ones."""
    return -len(bins), sum((sum(lengths[p] for p in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def cross(giver: Packing, taker: Packing, lengths: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """Inject well-filled bins of ``giver`` into ``taker`` and mend it."""
    fill = [sum(lengths[p] for p in b) for b in giver]
    well = [b for b, f in zip(giver, fill, strict=True) if f >= capacity * FULL_ENOUGH]
    if not well:
        well = [giver[i] for i in np.argsort(fill)[len(fill) // 2 :]]
    share = rng.uniform(0.2, 0.8)
    injected = [list(b) for b, u in zip(well, rng.random(len(well)), strict=True) if u < share]
    taken = {p for b in injected for p in b}
    bins, displaced = injected, []
    intact = []
    for b in taker:
        if taken.isdisjoint(b):
            intact.append(b)
        else:
            displaced += [p for p in b if p not in taken]
    # Dissolve poorly filled bins too, and some others, so that displaced pieces find new partners.
    for b, u in zip(intact, rng.random(len(intact)), strict=True):
        if u < 0.05 or sum(lengths[p] for p in b) < capacity * 0.97:
            displaced += b
        else:
            bins.append(list(b))
    room = [capacity - sum(lengths[p] for p in b) for b in bins]
    best_fit(bins, room, lengths, displaced, capacity)
    return bins


def first_packing(lengths: list[int], capacity: int, rng: np.random.Generator, shuffled: bool) -> Packing:
    """Best fit, largest first; if ``shuffled``, after a tenth of the pieces has been placed in small random lots."""
    bins: Packing = []
    room: list[int] = []
    pieces = list(range(len(lengths)))
    if shuffled:
        early = rng.permutation(len(pieces))[: len(pieces) // 10].tolist()
        for at in range(0, len(early), 8):
            best_fit(bins, room, lengths, early[at : at + 8], capacity)
        pieces = sorted(set(pieces).difference(early))
    best_fit(bins, room, lengths, pieces, capacity)
    return bins


def evolve(lengths: list[int], capacity: int, elites: list[Packing], seed: int) -> Packing:
    """One epoch of an island, from its elites and new packings to its best one."""
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    population = [*elites, first_packing(lengths, capacity, rng, False)]
    while len(population) < POPULATION:
        population.append(first_packing(lengths, capacity, rng, True))
    scored = sorted(((fitness(p, lengths, capacity), i, p) for i, p in enumerate(population)), reverse=True)
    born = len(scored)
    for _ in range(GENERATIONS):
        if -scored[0][0][0] <= least:
            break
        for _ in range(POPULATION):
            a, b = rng.choice(len(scored), 2, replace=False)
            child = cross(scored[min(a, b)][2], scored[max(a, b)][2], lengths, capacity, rng)
            scored.append((fitness(child, lengths, capacity), born, child))
            born += 1
        scored = sorted(scored, reverse=True)[:POPULATION]
    return scored[0][2]


def as_packing(numbers: np.ndarray) -> Packing:
    """Bins from each piece's bin number."""
    bins: dict[int, list[int]] = {}
    for piece, b in enumerate(numbers.tolist()):
        bins.setdefault(b, []).append(piece)
    return [bins[b] for b in sorted(bins)]


def as_numbers(packing: Packing, n: int) -> np.ndarray:
    numbers = np.empty(n, np.int64)
    for b, pieces in enumerate(packing):
        numbers[pieces] = b
    return numbers


# Rows of the evolution: piece (its number), its length, the bin it came in (first round: none),
# and the bin in the packing that the row carries.
ROW = "district bigint, island int, piece bigint, length int, came bigint, origin int, bin bigint"


def seed_of(*parts: int) -> int:
    return zlib.crc32(repr(parts).encode())


def pack_lengths(pieces: DataFrame, capacity: int, round_: int) -> DataFrame:
    """Pack (piece, length, came) rows; result: the same with ``bin``, unique over the districts of the round.

    ``came`` tells the bins of an earlier round, which stay together; it is the piece's own number in the first.
    """
    spark = pieces.sparkSession
    total = pieces.count()
    districts = max(1, -(-total // DISTRICT))
    start = pieces.select(
        F.pmod(F.xxhash64("came", F.lit(round_)), F.lit(districts)).alias("district"),
        F.explode(F.array(*(F.lit(i) for i in range(ISLANDS)))).alias("island"),
        "piece",
        "length",
        "came",
        F.lit(-1).alias("origin"),
        F.col("came").alias("bin"),
    )

    def epoch(number: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            district, island = int(key[0]), int(key[1])
            rows = rows.sort_values(["origin", "piece"], kind="stable")
            packings = [g for _, g in rows.groupby("origin", sort=True)]
            base = packings[0]
            lengths = base["length"].tolist()
            # In the first round the pieces come alone; later the bins they came in are a packing to beat.
            elites = [as_packing(g["bin"].to_numpy()) for g in packings]
            if number == 0 and round_ == 0:
                elites = []
            best = evolve(lengths, capacity, elites, seed_of(round_, number, district, island))
            found = base.assign(bin=as_numbers(best, len(base)), origin=island)
            # To itself, and as a migrant to the next island.
            return pd.concat([found, found.assign(island=(island + 1) % ISLANDS)])

        return run

    rows = start
    for number in range(EPOCHS):
        rows = rows.groupBy("district", "island").applyInPandas(epoch(number), ROW)

    def choose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["origin"] == rows["island"]]
        best = min(sorted(rows["island"].unique()), key=lambda i: rows.loc[rows["island"] == i, "bin"].max())
        return rows[rows["island"] == best].assign(bin=lambda x: x["bin"] * districts + int(key[0]))

    chosen = rows.groupBy("district").applyInPandas(choose, ROW)
    return staged(chosen.select("piece", "length", "bin"), f"packing-round-{round_}")


def tokenized(docs: DataFrame, id: str, text: str, capacity: int, tokenizer: str, keep_ids: bool) -> DataFrame:
    """A row per piece: the id, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32`` and, if wanted, the ids."""
    own = docs.select(quoted(id).alias("id"), quoted(text).cast("binary").alias("text"))
    fields = "piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    schema = StructType([StructField("id", own.schema["id"].dataType), *StructType.fromDDL(fields).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokenizer(tokenizer)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            texts = (value.as_py() or b"" for value in batch.column("text"))
            for i, text_ids in enumerate(tokens.all_ids(texts)):
                all_ids = text_ids + b"\0\0\0\0"
                for n, at in enumerate(range(0, len(all_ids), 4 * capacity)):
                    own_ids = all_ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(own_ids) // 4)
                    crc.append(zlib.crc32(own_ids))
                    if keep_ids:
                        ids.append(own_ids)
            columns = [
                batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return own.mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", capacity: int = 2048, tokenizer: str = TOKENIZER,
    keep_ids: bool = False,
) -> DataFrame:
    """Pack every document, as ids and a closing 0, into few sequences of at most ``capacity`` ids.

    Result, a row a piece: the id, ``piece``, ``start`` (ids of the document before it), ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` (place in the sequence, gapless from 0), and ``ids`` (little-endian 32 bits) with
    ``keep_ids``. Only documents longer than a sequence are cut.

    * A null or empty text is the closing 0 alone. A null id stays null; rows that come again are packed again.
    * Equal lengths are placed by the seeds of their district. An empty table gives an empty one.
    * Other input columns are not kept, so their names cannot clash, unless the id is named like a result.
    """
    if id in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"):
        raise ValueError(f"the id column cannot be named {id}")
    prepare_workers(docs.sparkSession)
    pieces = staged(
        tokenized(docs, id, text, capacity, tokenizer, keep_ids).withColumn("number", F.monotonically_increasing_id()),
        "pieces",
    )
    open_ = pieces.where(F.col("length") < capacity)
    pooled = open_.select(F.col("number").alias("piece"), F.col("length").cast("int").alias("length"))
    pooled = pooled.withColumn("came", F.col("piece"))
    placed = None
    for round_ in range(ROUNDS):
        packed = pack_lengths(pooled, capacity, round_)
        if round_ == ROUNDS - 1:
            done = packed
        else:
            filled = packed.groupBy("bin").agg(F.sum("length").alias("fill"))
            packed = packed.join(filled, "bin")
            poor = F.col("fill") < int(capacity * FULL_ENOUGH)
            done, pooled = packed.where(~poor), packed.where(poor).select("piece", "length", F.col("bin").alias("came"))
        # Rounds in the high bits, so that bins of different rounds differ; full pieces are counted below zero.
        done = done.select("piece", (F.lit(round_ + 1) * F.lit(1 << 58) + F.col("bin")).alias("sequence_id"))
        placed = done if placed is None else placed.unionByName(done)
    placed = placed.select(F.col("piece").alias("number"), "sequence_id")
    in_sequence = Window.partitionBy("sequence_id").orderBy("number")
    offsets = F.sum("length").over(in_sequence) - F.col("length")
    packed = open_.join(placed, "number").withColumn("offset", offsets)
    full = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("number"), "offset": F.lit(0).cast("long")}
    )
    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return packed.select("id", *names).unionByName(full.select("id", *names)).select(F.col("id").alias(id), *names)

