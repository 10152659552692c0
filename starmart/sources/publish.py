"""Tables published together, run by run, behind a manifest.

A run writes its tables to folders of its own, ``_data/<table>/published_run=<run>``, and nothing is ever moved or written
over. Last of all it puts down a manifest, ``_manifest/<number>.json``, that lists the folders of every table and names the
run; the readable one with the highest number is the live one. So a reader finds the whole old set or the whole new
one, whatever step of a run fails, and one that holds an older manifest can go on reading: the folders of the
manifest before the live one stay until the next success.

A table may be replaced, or keep the periods (partition folders) that the run does not bring, or be added to. What stays
is listed again in the new manifest, by reference; no file of it is read or copied.

Two runs at once both build on the same manifest, and only one can put down the next number. The other one fails.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starmart.sources.writers import file_place, read_text_file, register_views, remove_folder, subfolders, write_text_file

log = logging.getLogger(__name__)

RUN_COLUMN = "published_run"
REPLACE, PERIODS, APPEND = "replace", "periods", "append"


class PublishConflictError(RuntimeError):
    """Another run has published since this one began."""


@dataclass(frozen=True)
class PublishedTable:
    """Folders of a table, relative to the output, and the schema of its rows."""

    folders: tuple[str, ...]
    schema: StructType
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Manifest:
    """What is live: ``number`` counts the runs that succeeded. ``marks`` say up to where each source has been taken."""

    number: int
    run: str
    tables: Mapping[str, PublishedTable]
    marks: Mapping[str, int] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {folder for table in self.tables.values() for folder in table.folders}

    def to_json(self) -> str:
        tables = {
            name: {"folders": t.folders, "partition_by": t.partition_by, "schema": t.schema.jsonValue()}
            for name, t in self.tables.items()
        }
        value = {"number": self.number, "run": self.run, "tables": tables, "marks": dict(self.marks)}
        return json.dumps(value, indent=1)

    @staticmethod
    def from_json(text: str) -> Manifest:
        value = json.loads(text)
        tables = {
            name: PublishedTable(tuple(t["folders"]), StructType.fromJson(t["schema"]), tuple(t["partition_by"]))
            for name, t in value["tables"].items()
        }
        return Manifest(value["number"], value["run"], tables, value.get("marks", {}))


def _manifest_path(output: str, number: int) -> str:
    return f"{output}/_manifest/{number:010d}.json"


def _numbers(spark: SparkSession, output: str) -> list[int]:
    names = subfolders(spark, f"{output}/_manifest", "*.json")
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def read_manifest(spark: SparkSession, output: str, number: int | None = None) -> Manifest | None:
    """The live manifest of an output, or one by number; None if nothing was published."""
    if number is None:
        numbers = _numbers(spark, output)
        if not numbers:
            return None
        number = numbers[-1]
    return Manifest.from_json(read_text_file(spark, _manifest_path(output, number)))


def read_published(
    spark: SparkSession, output: str, name: str, *, manifest: Manifest | None = None
) -> DataFrame:
    """A published table, as the live manifest (or the one given) has it."""
    manifest = manifest or read_manifest(spark, output)
    if manifest is None or name not in manifest.tables:
        raise ValueError(f"{name} is not published in {output}")
    table = manifest.tables[name]
    if not table.folders:
        return spark.createDataFrame([], table.schema)
    # All folders have the table's own as their base, so that periods of different runs are partitions of one table.
    reader = spark.read.schema(table.schema).option("basePath", f"{output}/_data/{name}")
    return reader.parquet(*(f"{output}/{folder}" for folder in table.folders)).select(*_quoted(table.schema.names))


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n.replace('`', '``')}`" for n in names]


def published_tables(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """All tables of the live manifest: one set, also if another run succeeds meanwhile."""
    manifest = read_manifest(spark, output)
    return {n: read_published(spark, output, n, manifest=manifest) for n in (manifest.tables if manifest else {})}


def register_published(spark: SparkSession, output: str, prefix: str = "") -> dict[str, DataFrame]:
    """Name the live tables for SQL. The views stay with the run that was live; register again to see a later one."""
    tables = published_tables(spark, output)
    register_views(tables, prefix)
    return tables


@dataclass
class Publication:
    """One run's tables on their way. Used as a context: what the run wrote goes if it does not ``complete``.

    >>> with Publication(spark, output) as new:                 # doctest: +SKIP
    ...     write_table(df, new.folder("fact"), partition_by=["year", "month"])
    ...     new.add("fact", df.schema, partition_by=["year", "month"], mode=PERIODS)
    ...     manifest = new.complete()
    """

    spark: SparkSession
    output: str
    run: str = field(default_factory=lambda: f"r{uuid.uuid4().hex}")

    def __enter__(self) -> Publication:
        self.before = read_manifest(self.spark, self.output)
        self._tables: dict[str, PublishedTable] = {}
        self._begun: set[str] = set()
        self._done = False
        return self

    def __exit__(self, kind, value, trace) -> None:
        if not self._done:
            for name in sorted(self._begun):
                remove_folder(self.spark, f"{self.output}/{self._relative(name)}")

    def _relative(self, name: str) -> str:
        return f"_data/{name}/{RUN_COLUMN}={self.run}"

    def folder(self, name: str) -> str:
        """Where this run writes a table, a new folder that no reader knows yet."""
        if "/" in name or name.startswith((".", "_")):
            raise ValueError(f"{name} cannot name a table")
        self._begun.add(name)
        return f"{self.output}/{self._relative(name)}"

    def add(
        self, name: str, schema: StructType, *, partition_by: Sequence[str] = (), mode: str = REPLACE
    ) -> None:
        """Say what was written to ``folder(name)``.

        ``REPLACE`` leaves nothing of the table as it was. ``PERIODS`` keeps the periods of ``partition_by`` that are not
        written, ``APPEND`` keeps all. ``schema`` is that of the rows; rows that stay lack columns that are new, as NULL.
        """
        if RUN_COLUMN in schema.names:
            raise ValueError(f"{name} has a column {RUN_COLUMN}")
        own = self._relative(name)
        old = self.before.tables.get(name) if self.before else None
        kept: tuple[str, ...] = ()
        if partition_by:
            pattern = "/".join(f"{column}=*" for column in partition_by)
            periods = sorted(subfolders(self.spark, f"{self.output}/{own}", pattern))
            new = tuple(f"{own}/{p}" for p in periods)
        else:
            periods, new = [], (own,)
        if old and mode == PERIODS:
            if old.partition_by != tuple(partition_by):
                raise ValueError(f"{name} is published by {old.partition_by or 'no periods'}")
            written = set(periods)
            kept = tuple(f for f in old.folders if _period(f) not in written)
        elif old and mode == APPEND:
            kept = old.folders
        # Partition columns come from the folders' names; they stand last, as they do in what Spark reads.
        fields = [f for f in schema.fields if f.name not in partition_by]
        fields += [schema[c] for c in partition_by]
        self._tables[name] = PublishedTable((*kept, *new), StructType(fields), tuple(partition_by))

    def complete(self, marks: Mapping[str, int] | None = None) -> Manifest:
        """Put down the manifest: from here on the run is live. Then remove what only manifests before the last two list.

        ``marks`` become live with the tables; those of other sources stay.
        """
        missing = self._begun - set(self._tables)
        if missing:
            raise ValueError(f"begun but not added: {', '.join(sorted(missing))}")
        number = self.before.number + 1 if self.before else 1
        kept = {n: t for n, t in self.before.tables.items() if n not in self._tables} if self.before else {}
        marked = {**(self.before.marks if self.before else {}), **(marks or {})}
        manifest = Manifest(number, self.run, {**kept, **self._tables}, marked)
        self._put_down(manifest)
        try:
            remove_superseded(self.spark, self.output, manifest)
        except (Py4JError, OSError) as error:  # the set is live; the next success removes what is left
            log.warning("what run %s supersedes is not all removed: %s", self.run, type(error).__name__)
        return manifest

    def _put_down(self, manifest: Manifest) -> None:
        target = _manifest_path(self.output, manifest.number)
        draft = f"{self.output}/_manifest/.{self.run}.draft"
        write_text_file(self.spark, draft, manifest.to_json())
        self._done = True  # until it is known that the name was not given, the run may be live
        try:
            rename_new(self.spark, draft, target)
        except Exception as error:
            if _numbers(self.spark, self.output)[-1:] >= [manifest.number]:
                if read_manifest(self.spark, self.output, manifest.number).run == self.run:
                    return  # done, though the answer was lost
                self._done = False
                raise PublishConflictError(f"another run has put down {target}") from error
            self._done = False
            raise
        finally:
            remove_folder(self.spark, draft)


def _root(folder: str) -> str:
    """The run's folder that a folder lies in, or is."""
    head, tail = folder.split(f"/{RUN_COLUMN}=", 1)
    return f"{head}/{RUN_COLUMN}={tail.partition('/')[0]}"


def _period(folder: str) -> str:
    """A folder's path below its run's: the period it holds."""
    return folder.split(f"/{RUN_COLUMN}=", 1)[1].partition("/")[2]


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Give a file its final name, whole, and only if there is none of that name."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    place = fs.Path(target)
    context = fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.NONE
    try:
        context.rename(fs.Path(source), place, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise FileExistsError(target) from error
        raise


def remove_superseded(spark: SparkSession, output: str, live: Manifest) -> None:
    """Remove manifests before the last two, and the folders that only they list. May be cut off and run again."""
    older = [n for n in _numbers(spark, output) if n < live.number - 1]
    if not older:
        return
    last = read_manifest(spark, output, live.number - 1) if live.number > 1 else live
    needed = live.folders() | last.folders()
    needed_roots = set(map(_root, needed))
    for number in older:
        superseded = read_manifest(spark, output, number).folders() - needed
        # A run's folder goes as a whole once no period in it is needed.
        for folder in sorted({f if _root(f) in needed_roots else _root(f) for f in superseded}):
            remove_folder(spark, f"{output}/{folder}")
        remove_folder(spark, _manifest_path(output, number))


def remove_abandoned(spark: SparkSession, output: str, *, older_than_hours: float = 168) -> list[str]:
    """Remove folders of runs that no manifest lists and that began long ago: of runs whose driver was lost.

    Returns them. A run that is still writing is younger; its folders stay.
    """
    known = {_root(f) for n in _numbers(spark, output) for f in read_manifest(spark, output, n).folders()}
    removed = []
    now = spark._jvm.java.lang.System.currentTimeMillis()
    for folder in subfolders(spark, f"{output}/_data", f"*/{RUN_COLUMN}=*"):
        if f"_data/{folder}" in known:
            continue
        files, place = file_place(spark, f"{output}/_data/{folder}")
        if now - files.getFileStatus(place).getModificationTime() > older_than_hours * 3_600_000:
            files.delete(place, True)
            removed.append(folder)
    return removed

