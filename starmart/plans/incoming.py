"""Files of arrivals, taken into the published fact as they come: each one once.

A file source keeps a log of the files it has given out, below a checkpoint folder. ``take_arrivals`` has it give out what is
new, up to a stated number of files a batch, and ends when there is no more: it is run again and again, by whoever brings
the files or by a clock. Every batch is cleaned, checked and published as one run, and the batch's number becomes live
with its rows, in the same manifest. A batch that is given out again, because the job ended between its publication and
the log's commit, is known by that number and left alone; one that ended before it was published is taken anew.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from starmart import schemas as S
from starmart.operators.quality import enforce, quality_report
from starmart.plans.arrivals import clean_arrivals
from starmart.plans.build import FACT, star_rules
from starmart.sources import APPEND, PERIODS, Publication, read_manifest, read_table, remove_folder, write_table

MONTHS = ("year", "month")


def take_arrivals(
    spark: SparkSession,
    incoming: str,
    output: str,
    *,
    checkpoint: str,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    add: bool = False,
    files_per_batch: int = 1000,
    clean: Callable[[DataFrame], DataFrame] = clean_arrivals,
) -> int:
    """Publish what is new in ``incoming``; give the number of batches that were taken (an action).

    A batch replaces the months it brings, as a monthly refresh does; with ``add`` its rows are added to them. The other
    tables of ``output`` stay as they are. A batch that fails a check raises ``QualityError``, publishes nothing, and
    is given out again next time. ``checkpoint`` belongs to one ``incoming`` and must outlive the jobs.
    """
    source = "files:" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    taken: list[int] = []

    def take(raw: DataFrame, batch: int) -> None:
        live = read_manifest(spark, output)
        if live and batch <= live.marks.get(source, -1):
            return
        stage = f"{output}/_stage/{uuid.uuid4().hex}"
        try:
            # Checks and publication both read what was staged, so the files are read once.
            write_table(clean(raw), f"{stage}/{FACT}")
            rows = read_table(spark, f"{stage}/{FACT}")
            enforce(quality_report({FACT: rows}, star_rules()))
            rows = rows.drop(S.MALFORMED)
            with Publication(spark, output) as new:
                write_table(rows, new.folder(FACT), partition_by=MONTHS, rebalance=True)
                new.add(FACT, rows.schema, partition_by=MONTHS, mode=APPEND if add else PERIODS)
                new.complete({source: batch})
        finally:
            remove_folder(spark, stage)
        taken.append(batch)

    reader = spark.readStream.format(fmt).schema(S.ARRIVALS_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    stream = (
        reader.options(**(options or {}))
        .load(incoming)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return len(taken)
