"""Line dedup over levelled sorted runs of line hashes.

The store holds what is known of all lines so far, as in a log-structured merge tree:

* ``level 0`` takes one sorted run of (line hash, documents) for each batch added,
* ``fanout`` runs of a level are merged into one run of the next, now and then,
* lines that a merge shows to be in enough documents leave the levels for the ``common``
  runs, and every later batch is merge-anti-joined with them, so that the lines found
  most often are neither kept nor counted again.

A manifest beside the runs, put down anew after every batch, names those that count: a store can be opened again by
another job, which finds it as the last batch left it, and a batch is taken once. (Runs as bucketed tables, merged
without a shuffle, took more memory than the check tool grants an executor: see the README.)

A line is told by 128 bits of its key, the line stripped of white space at both ends and
with A-Z lower-cased. Nothing but hashes and counts is shuffled until the last step, where
the documents meet the places of their common lines.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import BLANKS, ascii_lower, other_columns, row_key, stage_path, staged, whole_text
from starmart.sources.publish import rename_new
from starmart.sources.writers import read_text_file, remove_folder, subfolders, write_text_file

LINE = ["h1", "h2"]
RUN = "h1 bigint, h2 bigint, n_docs bigint"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineStore:
    """Sorted runs below ``path``; ``min_docs`` documents make a line common.

    A store that is there is opened as it is, with the settings it was made with. One job at a time may add to it.
    """

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 10, fanout: int = 2) -> None:
        self.spark, self.path = spark, path
        numbers = sorted(int(n.removesuffix(".json")) for n in subfolders(spark, f"{path}/manifest", "*.json"))
        if numbers:
            state = json.loads(read_text_file(spark, f"{path}/manifest/{numbers[-1]:09d}.json"))
        else:
            state = {"min_docs": min_docs, "fanout": fanout, "levels": [], "common": [], "batches": []}
        self.number = numbers[-1] if numbers else 0
        self.min_docs, self.fanout = state["min_docs"], state["fanout"]
        self.levels: list[list[int]] = state["levels"]
        self.common_runs: list[int] = state["common"]
        self.batches: list[str] = state["batches"]
        # Runs that no manifest names may lie there; new ones are numbered after them.
        taken = [int(n.removeprefix("run=")) for n in subfolders(spark, path, "run=*")]
        self.written = max(taken, default=-1) + 1
        self.replaced: list[int] = []

    def add(self, counts: DataFrame, batch: str | None = None) -> None:
        """Take a batch of (h1, h2, n_docs), a row a line; lines known to be common are left out.

        A ``batch`` that was taken before, by this job or another, is passed over.
        """
        batch = uuid.uuid4().hex if batch is None else batch
        if batch in self.batches:
            return
        if self.common_runs:
            counts = counts.join(self._read(self.common_runs).select(*LINE).hint("merge"), LINE, "left_anti")
        self._push(0, self._write(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._compact(runs))
            level += 1
        self.batches.append(batch)
        self._put_down()

    def common(self) -> DataFrame:
        """(h1, h2) of all lines in ``min_docs`` documents or more, once each."""
        rest = [run for level in self.levels for run in level]
        found = self._merged(rest).where(F.col("n_docs") >= self.min_docs).select(*LINE)
        # A line that became common left its level, and later batches leave it out: no overlap.
        return self._read(self.common_runs).select(*LINE).unionByName(found) if self.common_runs else found

    def _compact(self, runs: list[int]) -> int:
        """One run of what several hold, without the lines that are common now; those make a common run."""
        whole = self._write(self._merged(runs))
        merged, enough = self._read([whole]), F.col("n_docs") >= self.min_docs
        self.common_runs.append(self._write(merged.where(enough)))
        self.replaced += [*runs, whole]
        return self._write(merged.where(~enough))

    def _push(self, level: int, run: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _merged(self, runs: list[int]) -> DataFrame:
        return self._read(runs).groupBy(*LINE).agg(F.sum("n_docs").alias("n_docs"))

    def _read(self, runs: list[int]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*(f"{self.path}/run={run:06d}" for run in runs))

    def _write(self, df: DataFrame) -> int:
        run = self.written
        self.written += 1
        df.select(*LINE, "n_docs").sortWithinPartitions(*LINE).write.parquet(f"{self.path}/run={run:06d}")
        return run

    def _put_down(self) -> None:
        """Name the runs that count; then those that were merged go."""
        self.number += 1
        state = {
            "min_docs": self.min_docs, "fanout": self.fanout,
            "levels": self.levels, "common": self.common_runs, "batches": self.batches,
        }
        draft = f"{self.path}/manifest/.{uuid.uuid4().hex}.draft"
        write_text_file(self.spark, draft, json.dumps(state))
        rename_new(self.spark, draft, f"{self.path}/manifest/{self.number:09d}.json")
        for run in self.replaced:
            remove_folder(self.spark, f"{self.path}/run={run:06d}")
        self.replaced = []


def dedup_lines(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", min_docs: int = 10, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """Drop every line whose key is in ``min_docs`` documents or more, in all of them.

    Result: the input with ``text`` replaced by the lines that stay, and ``n_lines`` (before),
    ``n_dropped``.

    * A null or empty text has one empty line, whose key is empty and never dropped; a null
      text stays null.
    * Every row is one document, also when its id is null or comes again; equal rows get equal results.
    * A document all of whose lines go has an empty text. An empty table gives an empty one.
    * Input columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    spark = docs.sparkSession
    k1, k2 = row_key(id, text)
    lines = F.split(whole_text(text), "\n", -1)
    hashed = F.transform(
        lines,
        lambda x: F.when(
            F.length(line_key(x)) > 0,
            F.struct(F.xxhash64(line_key(x)).alias("h1"), F.xxhash64(F.lit(7), line_key(x)).alias("h2")),
        ),
    )
    found = staged(docs.select(k1.alias("k1"), k2.alias("k2"), hashed.alias("lines")), "lines")

    batch = F.pmod(F.col("k2"), F.lit(batches)).cast("int").alias("batch")
    counts = (
        found.select(batch, F.explode(F.array_distinct("lines")).alias("line"))
        .where(F.col("line").isNotNull())
        .groupBy("batch", "line.h1", "line.h2")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    counts = staged(counts, "line-counts", partition_by="batch")
    store = LineStore(spark, stage_path(spark, "line-runs"), min_docs, fanout)
    for b in range(batches):
        store.add(counts.where(F.col("batch") == b), str(b))
    common = staged(store.common(), "common-lines")

    places = (
        found.select("k1", "k2", F.posexplode("lines").alias("place", "line"))
        .where(F.col("line").isNotNull())
        .select("k1", "k2", "place", "line.h1", "line.h2")
        .join(common, LINE)
        # Equal rows have the same places: a set, not a list.
        .groupBy("k1", "k2")
        .agg(F.collect_set("place").alias("_llm_places"))
        .withColumnsRenamed({"k1": "_llm_k1", "k2": "_llm_k2"})
    )
    places = staged(places, "common-places")
    names = other_columns(docs, ("n_lines", "n_dropped"))
    # The lines are a column of their own: an expression inside a lambda would be split anew for each line.
    joined = (
        docs.select(*(quoted(c) for c in names), k1.alias("_llm_k1"), k2.alias("_llm_k2"))
        .join(places, ["_llm_k1", "_llm_k2"], "left")
        .withColumn("_llm_lines", lines)
        .withColumn("n_lines", F.size("_llm_lines").cast("long"))
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("_llm_lines") - 1), F.col("_llm_places"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_llm_lines", i)), "\n")
    untouched = F.col("_llm_places").isNull()
    return joined.select(
        *(F.when(untouched, quoted(c)).otherwise(kept).alias(c) if c == text else quoted(c) for c in names),
        "n_lines",
        F.when(untouched, 0).otherwise(F.size("_llm_places")).cast("long").alias("n_dropped"),
    )
