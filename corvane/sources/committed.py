"""A transactional sink: `format("committed")`, whose writes become visible as a whole or not at all.

Tasks write Parquet files, a file a task and day, into a folder of their transaction, where no reader looks. The commit
publishes the folder with one new entry of the log: entries are numbered, and an entry is created whole and never
replaced, so two writers can't publish the same number. A job that fails deletes its folder; one that died without doing
so leaves a folder that no entry names, which sweep() removes. Attempts of a task write files of different names, and
the commit publishes those of the attempts that Spark committed. mode("overwrite") publishes an entry after which earlier
ones don't count.

Options: path (a path that driver and workers share, or an address that pyarrow's file systems know), day (the column
that names partitions; utc_day). Defined cases: a write without rows publishes nothing; a null day is a partition of its
own; read() of a table without an entry has no rows, with the schema that is given.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

LOG, NONE = "_log", "__HIVE_DEFAULT_PARTITION__"
#: Files that a task keeps open; more days than that are written one after the other as far as rows come sorted.
OPEN_FILES = 64


def store(path: str) -> tuple[fs.FileSystem, str]:
    found, root = fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (fs.LocalFileSystem(), path)
    return found, root.rstrip("/")


def entries(path: str) -> list[dict]:
    """Published entries, in order."""
    files, root = store(path)
    found = sorted(f.path for f in files.get_file_info(fs.FileSelector(f"{root}/{LOG}", allow_not_found=True)) if re.fullmatch(r"\d{12}\.json", f.base_name))
    out = []
    for p in found:
        with files.open_input_stream(p) as f:
            out.append(json.loads(f.read()))
    return out


def publish(path: str, entry: dict) -> int:
    """Add an entry under the next free number; an entry appears whole or not at all."""
    files, root = store(path)
    files.create_dir(f"{root}/{LOG}")
    temporary = f"{root}/{LOG}/.{uuid.uuid4().hex}"
    with files.open_output_stream(temporary) as f:
        f.write(json.dumps(entry, sort_keys=True).encode())
    number = 0
    try:
        while True:
            taken = [int(f.base_name[:12]) for f in files.get_file_info(fs.FileSelector(f"{root}/{LOG}")) if re.fullmatch(r"\d{12}\.json", f.base_name)]
            number = max([number - 1, *taken]) + 1
            target = f"{root}/{LOG}/{number:012d}.json"
            if isinstance(files, fs.LocalFileSystem):
                try:
                    os.link(temporary, target)  # fails if there is one
                    return number
                except FileExistsError:
                    continue
            if files.get_file_info(target).type == fs.FileType.NotFound:  # elsewhere, writers must take turns
                files.move(temporary, target)
                return number
    finally:
        if files.get_file_info(temporary).type != fs.FileType.NotFound:
            files.delete_file(temporary)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.day, self.overwrite = options["path"], options.get("day", "utc_day"), overwrite
        if self.day not in schema.names:
            raise ValueError(f"no column {self.day!r}")
        self.transaction = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = store(self.path)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}" if task else f"part-{uuid.uuid4().hex}"
        writers: dict[str, tuple[pq.ParquetWriter, str]] = {}
        made, rows = [], 0
        try:
            for batch in iterator:
                days = batch.column(self.day).cast(pa.string())
                rest = batch.drop_columns([self.day])
                for day in pc.unique(days).to_pylist():
                    part = rest.filter(pc.is_null(days) if day is None else pc.fill_null(pc.equal(days, day), False))
                    key = NONE if day is None else day
                    if key not in writers:
                        if len(writers) >= OPEN_FILES:
                            writers.pop(next(iter(writers)))[0].close()
                        folder = f"txn={self.transaction}/{self.day}={key}"
                        files.create_dir(f"{root}/{folder}")
                        file = f"{folder}/{name}-{len(made):04d}.parquet"
                        writers[key] = pq.ParquetWriter(f"{root}/{file}", rest.schema, filesystem=files), file
                        made.append(file)
                    writers[key][0].write_batch(part)
                    rows += part.num_rows
        finally:
            for w, _ in writers.values():
                w.close()
        return Written(made, rows)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        files = sorted(f for m in done for f in m.files)
        if files or self.overwrite:
            self._keep_only(files)
            publish(self.path, {"transaction": self.transaction, "rows": sum(m.rows for m in done), "files": len(files), "days": sorted({f.split("/")[1].split("=", 1)[1] for f in files}), "whole": self.overwrite})

    def _keep_only(self, files: list[str]) -> None:
        """Remove files of attempts that weren't committed; one that resists stops the commit."""
        store_, root = store(self.path)
        there = store_.get_file_info(fs.FileSelector(f"{root}/txn={self.transaction}", recursive=True, allow_not_found=True))
        kept = {f"{root}/{f}" for f in files}
        for f in there:
            if f.type == fs.FileType.File and f.path not in kept:
                store_.delete_file(f.path)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = store(self.path)
        if files.get_file_info(f"{root}/txn={self.transaction}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/txn={self.transaction}")


class CommittedSink(DataSource):
    """format("committed"): rows by day, published as a whole."""

    @classmethod
    def name(cls) -> str:
        return "committed"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return CommittedWriter(dict(self.options), schema, overwrite)


def write(df: DataFrame, path: str, day: str = "utc_day", mode: str = "append") -> None:
    """Publish df's rows in the table of a path."""
    df.sparkSession.dataSource.register(CommittedSink)
    df.write.format("committed").option("path", path).option("day", day).mode(mode).save()


def transactions(path: str) -> list[str]:
    """Transactions that count: those from the last overwriting one on."""
    found = entries(path)
    first = max((k for k, e in enumerate(found) if e["whole"]), default=0)
    return [e["transaction"] for e in found[first:] if e["files"]]


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The published rows. Days are partitions, so a filter on them prunes."""
    folders = [f"{path.rstrip('/')}/txn={t}" for t in transactions(path)]
    if not folders:
        return spark.createDataFrame([], schema)
    txn = StructType([*schema.fields]).add("txn", "string")
    return spark.read.schema(txn).option("basePath", path).parquet(*folders).drop("txn").select(*schema.names)


def sweep(path: str) -> list[str]:
    """Remove folders that no entry names, of writers that died; not while a writer runs. Returns their transactions."""
    files, root = store(path)
    known = {e["transaction"] for e in entries(path)}
    gone = [f.base_name.removeprefix("txn=") for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.type == fs.FileType.Directory and f.base_name.startswith("txn=")]
    gone = sorted(set(gone) - known)
    for t in gone:
        files.delete_dir(f"{root}/txn={t}")
    return gone


def append_errors(errors: DataFrame, path: str, day: str = "utc_day") -> None:
    """Add error rows (source, url, error, collected) to a committed table. Nothing is added where the past of the days
    that it touches is malformed: an error without source, safe text or time."""
    from corvane.operators.quality import SAFE_ERROR
    from corvane.sources.archive import ArchiveError

    days = [r[0] for r in errors.select(F.col(day).cast("string")).distinct().collect()]  # partitions, not rows
    past = read(errors.sparkSession, path, errors.schema).where(F.col(day).cast("string").isin(days))
    odd = past.where(F.col("source").isNull() | F.col("collected").isNull() | ~F.coalesce(F.col("error").rlike(SAFE_ERROR), F.lit(False))).first()
    if odd:
        raise ArchiveError(f"a malformed error row of {odd[day]}: {odd.source}")
    write(errors, path, day)
