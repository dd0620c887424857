"""The day-partitioned archive: strict NDJSON scans, append without repeats, error rows, documents, manifests."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.session import drop, settled
from corvane.sources.key_index import KeyIndex


class ArchiveError(ValueError):
    """The archive holds something that it must not."""


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths (or globs) that match something, asked of the store itself."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        hits = path.getFileSystem(conf).globStatus(path)
        if hits is not None and len(hits):
            found.append(p)
    return found


def _complaint():
    return F.concat(F.col("file"), F.when(F.col("value").startswith("{"), ": malformed: ").otherwise(": not an object: "), F.substring("value", 1, 80))


def _parsed(lines: DataFrame, full: T.StructType, schema: T.StructType, told, keep: bool = False) -> DataFrame:
    """Lines parsed once; told is evaluated for lines that are no objects of the schema."""
    row = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.withColumn("_row", row)
    odd = ~F.col("value").startswith("{") | F.col("_row").isNull() | F.col("_row._bad").isNotNull()
    if keep:
        return rows.select(F.when(odd, told).alias("_odd"))
    checked = F.when(odd, told).otherwise(F.lit(None)).cast("string")
    return rows.withColumn("_odd", checked).where("_odd IS NULL").select(*[F.col(f"_row.{f.name}").alias(f.name) for f in schema.fields])


def read_ndjson(spark: SparkSession, paths: list[str], schema: T.StructType, lazy: bool = False) -> DataFrame:
    """Rows of NDJSON files; missing files and blank lines are skipped, a malformed or non-object line is an error that
    names file and line. The check is a pass of its own, before any row is used; with lazy, it is part of the one pass that
    reads the rows, and the query that meets such a line fails."""
    paths = existing(spark, paths)
    if not paths:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(paths).select(F.trim("value").alias("value"), F.col("_metadata.file_path").alias("file")).where("value <> ''")
    if lazy:
        return _parsed(lines, full, schema, F.raise_error(_complaint()))
    odd = _parsed(lines, full, schema, _complaint(), keep=True).where("_odd IS NOT NULL").select("_odd").first()
    if odd:
        raise ArchiveError(odd._odd)
    return _parsed(lines, full, schema, F.lit(None))


def duplicate_keys(archive: DataFrame, key: str = "id") -> DataFrame:
    return archive.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


#: A batch with no more new keys than this is sent to the archive's files, instead of shuffling the archive.
FEW_KEYS = 1_000_000


def append_unique(spark: SparkSession, items: DataFrame, path: str, key: str = "id", day: str = "utc_day", verify: bool = False, index: KeyIndex | None = None) -> int:
    """Append items whose key the archive lacks, into day partitions; nothing is written if nothing is new. Returns how many.

    Existing rows are never rewritten; of rows with one key the first stays. An empty key is an error; with verify, so is
    a repeated or empty key in the archive, which takes a pass over all of it and belongs into a check of its own.
    With an index, the batch reads the index's buckets of its own keys; an archive that the index doesn't know yet, or
    an append that was broken off, is indexed first. Without one, the archive's keys are read, and matched against the
    batch's, which are broadcast where they are few.
    """
    if items.where(F.coalesce(F.col(key).cast("string"), F.lit("")) == "").limit(1).count():
        raise ArchiveError("an item has no key")
    first = items.withColumn("_at", F.monotonically_increasing_id()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*items.columns), "_at").alias("_row"))
    new = settled(first.select("_row.*"), "batch")
    made = [new]
    try:
        if existing(spark, [f"{path.rstrip('/')}/{day}=*"]):
            old = spark.read.parquet(path).select(F.col(key).alias("_old"))
            if verify and (old.where(F.coalesce(F.col("_old").cast("string"), F.lit("")) == "").limit(1).count() or duplicate_keys(old, "_old").limit(1).count()):
                raise ArchiveError("the archive holds an empty or repeated key")
            keys = new.select(F.col(key).cast("string").alias("_new"))
            if index is not None:
                if index.broken() or index.version() is None:
                    index.rebuild(old)
                    index.end()
                seen = index.seen(keys, "_new").withColumnRenamed("_new", "_old")
            else:
                small = F.broadcast(keys) if keys.count() <= FEW_KEYS else keys
                seen = old.join(small, F.col("_old").cast("string") == F.col("_new"), "left_semi").distinct()
            fresh = settled(new.join(seen, F.col(key).cast("string") == F.col("_old").cast("string"), "left_anti"), "fresh")
            made.append(fresh)
        else:
            fresh = new
        n = fresh.count()
        if n:
            if index is not None:
                index.begin()
            fresh.write.mode("append").partitionBy(day).parquet(path)
            if index is not None:
                index.add(fresh.select(key))
                index.end()
    finally:
        for t in made:
            drop(t)
    return n


def load_json(path: str, default):
    """A driver-side document, or the default if there is none."""
    if not os.path.exists(path):
        return default
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def atomic_text(path: str, text: str) -> None:
    """Replace a driver-side file as a whole, synced to disk."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, tmp = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(tmp, path)
    except BaseException:
        os.unlink(tmp)
        raise
    d = os.open(folder, os.O_RDONLY)
    os.fsync(d)
    os.close(d)


def atomic_json(path: str, value) -> None:
    atomic_text(path, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (relative), bytes and SHA-256 of every file below a root."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/").removeprefix("file://") + "/"
    return files.select(F.substring_index("path", base, -1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("digest"))


def manifest(files: DataFrame) -> DataFrame:
    """One row: file_count, total_bytes, and the files sorted by path."""
    return files.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.array_sort(F.collect_list(F.struct("path", "bytes", "digest"))).alias("files"))
