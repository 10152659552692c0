"""Documents and token counts of flat token files, by a separator scan.

A flat token file is nothing but ids of two or four bytes, documents one after the other, each closed by an
end-of-document id; there is no index. Files are cut into blocks of equal length, wherever documents begin or end.
Each task finds the separators of its blocks by a vectorised comparison, and sends their places. A prefix scan over
the blocks of a file then tells every block how many documents were closed before it, and where the document that is
open at its start began: a running sum and a running maximum. With that, each block's separators give whole
documents; one that spans many blocks is stitched together by the scan alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import prepare_workers, stage_path, staged
from starmart.llm.tokens import TOKENIZER, WordTokenizer

BLOCK_BYTES = 4 << 20
END_OF_DOCUMENT = 49407  # of the default tokenizer; no text gives it
KINDS = {2: "<u2", 4: "<u4"}


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end: int = END_OF_DOCUMENT,
    width: int = 2,
) -> DataFrame:
    """Write every text's ids and ``end`` to flat files below ``path``, one a task, in the order of the rows.

    Gives (file, document, id): the name of the file a row went to, its place there, and its id. Only files that are named
    belong to the table: a task that is repeated writes a new one, and one that was lost may leave its own behind.

    A null text is an empty one: ``end`` alone. The texts of special tokens are plain text, so ``end`` stands only
    between documents.
    """
    prepare_workers(docs.sparkSession)
    rows = docs.select(quoted(id).alias("id"), quoted(text).cast("binary").alias("text"))
    separator = int(end).to_bytes(width, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        tokens = WordTokenizer(tokenizer, special=False)
        store, folder = fs.FileSystem.from_uri(path)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        first = 0
        file = None
        try:
            for batch in batches:
                if file is None:
                    store.create_dir(folder, recursive=True)
                    file = store.open_output_stream(f"{folder}/{name}")
                for ids in tokens.all_ids(value.as_py() or b"" for value in batch.column(1)):
                    wide = np.frombuffer(ids, "<u4")
                    file.write(wide.astype(KINDS[width]).tobytes() + separator)
                n = batch.num_rows
                places = pa.array(np.arange(first, first + n))
                first += n
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), places, batch.column(0)], ["file", "document", "id"])
        finally:
            if file is not None:
                file.close()

    kind = rows.schema["id"].dataType.simpleString()
    return staged(rows.mapInArrow(encode, f"file string, document long, id {kind}"), "token-index")


def scan_blocks(files: DataFrame, end: int, width: int, block_bytes: int) -> DataFrame:
    """(path, first, tokens, ends) of every block of the (path, length) files; ``ends`` counts from the block's start."""
    if block_bytes % width:
        raise ValueError("a block must hold whole tokens")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))
    blocks = files.where("length > 0").select("path", "length", F.explode(starts).alias("at"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for path, length, at in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "at")), strict=True):
                if length % width:
                    raise ValueError(f"{path} does not hold whole tokens of {width} bytes")
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    data = file.read_at(min(block_bytes, length - at), at)
                tokens = np.frombuffer(data, KINDS[width])
                ends = np.flatnonzero(tokens == end).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]), pa.array([at // width], pa.int64()), pa.array([len(tokens)], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(ends)], pa.int32()), pa.array(ends)),
                    ],
                    ["path", "first", "tokens", "ends"],
                )

    # Blocks of one large file go to many tasks; the rows are a path and two numbers.
    spread = blocks.repartition("path", "at")
    return spread.mapInArrow(scan, "path string, first long, tokens long, ends array<int>")


def count_tokens(
    files: DataFrame, *, end: int = END_OF_DOCUMENT, width: int = 2, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """A row per document of the token files (path, length): ``path``, ``document`` (from 0), ``start``, ``n_tokens``, ``closed``.

    ``start`` is the place of its first token in the file, ``n_tokens`` does not count the separator.

    * Separators next to each other enclose a document of no tokens. Tokens after a file's last separator are a document
      that is not ``closed``; every file is closed by itself, and an empty one has no documents.
    * A file whose length is no multiple of ``width`` is an error.
    """
    prepare_workers(files.sparkSession)
    blocks = staged(scan_blocks(files, end, width, block_bytes), "token-blocks")
    # The prefix scan sees four numbers a block, however many separators the block holds.
    before = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    last_end = F.when(F.size("ends") > 0, F.col("first") + F.element_at("ends", -1))
    totals = blocks.select("path", "first", "tokens", F.size("ends").cast("long").alias("n_ends"), last_end.alias("last_end"))
    carried = totals.select(
        "path",
        "first",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("documents"),
        F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)).alias("open_since"),
    )
    scanned = blocks.where(F.size("ends") > 0).select("path", "first", "ends").join(carried, ["path", "first"])
    # Each separator with the start of its document: the place after the one before it.
    closed = F.transform(
        "ends",
        lambda e, i: F.struct(
            (F.col("documents") + i).alias("document"),
            F.when(i == 0, F.col("open_since")).otherwise(F.col("first") + F.get("ends", i - 1) + 1).alias("start"),
            (F.col("first") + e).alias("stop"),
        ),
    )
    found = scanned.select("path", F.explode(closed).alias("d")).select(
        "path",
        "d.document",
        "d.start",
        (F.col("d.stop") - F.col("d.start")).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    by_file = totals.groupBy("path").agg(
        F.sum("n_ends").alias("document"),
        F.coalesce(F.max("last_end") + 1, F.lit(0)).cast("long").alias("start"),
        F.sum("tokens").alias("tokens"),
    )
    rest = by_file.select(
        "path", "document", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")
    ).where("n_tokens > 0")
    return found.unionByName(rest)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files below ``path``; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def count_document_tokens(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(id, n_tokens, file, start) of every document: its tokens as a scan of token files in the shared folder finds them.

    ``start`` is the place of the document's first token in its ``file``. A null or empty text has no tokens. Rows that come
    again, or share an id, are documents of their own; an empty table gives an empty one. Other columns do not matter.
    """
    spark = docs.sparkSession
    path = stage_path(spark, "token-files")
    index = write_token_files(docs, path, id=id, text=text)
    if index.isEmpty():
        return index.select(quoted("id").alias(id), F.col("document").alias("n_tokens"), "file", F.col("document").alias("start"))
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    files = token_files(spark, path).join(index.select("file").distinct(), name == F.col("file"), "left_semi")
    counted = count_tokens(files, **options).select(name, "document", "start", "n_tokens")
    return index.join(counted, ["file", "document"]).select(F.col("id").alias(id), "n_tokens", "file", "start")
