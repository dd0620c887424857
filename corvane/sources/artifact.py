"""Artifacts: what lies in a checkout, its manifest, and every rule that either breaks, as rows.

Metadata of files, of links too, and their digests are read on the executors, a subtree a task, from a path that they
share. The manifest is one JSON document, read as VARIANT; its files become rows and meet the files found in a join.

Defined cases: a root that is missing has no files; a manifest that is no object breaks `manifest` and declares nothing;
files of the repository beside an artifact (artifact_ignored) are left out; links are violations whatever they point at.
"""

from __future__ import annotations

import hashlib
import json
import os
import stat
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import filters as S
from corvane.operators import joins as J
from corvane.session import drop, settled

# Folders of an artifact, fields of a manifest and of its files, states of a run.
ROOTS = ("data", "reports")
FIELDS = ("file_count", "files", "last_run_at", "schema", "state_status", "total_bytes")
FILE_FIELDS = ("bytes", "path", "sha256")
RUN_STATUSES = ("ok", "idle", "partial", "blocked", "failed")
SCHEMA = "collection-artifact-v1"


def _kind(path: str) -> str:
    mode = os.lstat(path).st_mode
    return "link" if stat.S_ISLNK(mode) else "folder" if stat.S_ISDIR(mode) else "file" if stat.S_ISREG(mode) else "special"


def _sha256(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def files(spark: SparkSession, root: str, depth: int = 3) -> DataFrame:
    """path (below the root), kind (file, link, special; a root that is no folder, too), bytes, digest of everything in
    the artifact's folders. The driver lists folders down to a depth (of days: year, month); tasks walk what is below."""
    seeds: list[tuple[str, bool]] = []

    def open_(relative: str, level: int) -> None:
        full = os.path.join(root, relative)
        if _kind(full) != "folder" or level == depth:
            seeds.append((relative, level < depth and _kind(full) == "folder"))
            return
        for name in sorted(os.listdir(full)):
            open_(f"{relative}/{name}", level + 1)

    for name in ROOTS:
        if os.path.lexists(os.path.join(root, name)):
            open_(name, 0)

    def walk(relative: str) -> Iterator[tuple]:
        full = os.path.join(root, relative)
        kind = _kind(full)
        if kind == "folder":
            for name in sorted(os.listdir(full)):
                yield from walk(f"{relative}/{name}")
        else:
            yield relative, kind, os.lstat(full).st_size if kind == "file" else None, _sha256(full) if kind == "file" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for p in b.column(0).to_pylist() for r in walk(p)]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], ["path", "kind", "bytes", "digest"])

    df = spark.createDataFrame([(p,) for p, _ in seeds], "path string")
    return df.repartition(max(1, min(len(seeds), 2 * spark.sparkContext.defaultParallelism))).mapInArrow(run, "path string, kind string, bytes long, digest string")


def document(text: DataFrame) -> DataFrame:
    """doc (VARIANT) of a one-row text column."""
    return text.select(F.try_parse_json(F.col(text.columns[0])).alias("doc"))


def declared(manifest: DataFrame) -> DataFrame:
    """at, row (VARIANT) of the manifest's files."""
    return manifest.select(F.posexplode(F.coalesce(F.try_variant_get("doc", "$.files", "array<variant>"), F.array().cast("array<variant>"))).alias("at", "row"))


def violations(manifest: DataFrame, found: DataFrame, state: DataFrame, schema: str = SCHEMA) -> DataFrame:
    """(scope, key, rule) of a manifest (doc), the files found (path, kind, bytes, digest) and the state document (doc)."""
    get = lambda d, path, kind="string": F.try_variant_get(d, path, kind)
    kind = lambda d, path: F.coalesce(F.schema_of_variant(F.try_variant_get(d, path, "variant")), F.lit("ABSENT"))
    keys = lambda d: F.array_sort(F.json_object_keys(F.to_json(d)))
    exactly = lambda names: F.array(*[F.lit(n) for n in names])
    out = []

    def told(df: DataFrame, scope: str, key, rules: dict) -> None:
        broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
        out.append(df.select(F.lit(scope).alias("scope"), key.cast("string").alias("key"), F.explode(broken).alias("rule")))

    rows = declared(manifest).select("at", "row", get(F.col("row"), "$.path").alias("path"), get(F.col("row"), "$.bytes", "bigint").alias("bytes"), get(F.col("row"), "$.sha256").alias("digest"))
    path = F.col("path")
    told(rows, "manifest", F.coalesce(path, F.concat(F.lit("files["), F.col("at").cast("string"), F.lit("]"))), {
        "file_fields": ~keys(F.col("row")).eqNullSafe(exactly(FILE_FIELDS)), "path": ~S.artifact_allowed(path) | (kind(F.col("row"), "$.path") != "STRING"), "bytes": (kind(F.col("row"), "$.bytes") != "BIGINT") | (F.col("bytes") < 0), "sha256": ~F.coalesce(F.col("digest").rlike("^[0-9a-f]{64}$"), F.lit(False)),
    })
    repeated = rows.where("path IS NOT NULL").groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    told(repeated, "manifest", path, {"repeated": F.lit(True)})

    kept = found.where(~((F.col("kind") == "file") & S.artifact_ignored(path)))
    told(kept, "artifact", path, {"link": F.col("kind") == "link", "special": F.col("kind") == "special", "not_a_folder": (F.col("kind") == "file") & path.isin(*ROOTS), "unexpected_path": (F.col("kind") == "file") & ~path.isin(*ROOTS) & ~S.artifact_allowed(path)})
    actual = kept.where((F.col("kind") == "file") & S.artifact_allowed(path))
    expected = rows.where(S.artifact_allowed(path)).groupBy("path").agg(F.max_by("bytes", "at").alias("bytes"), F.max_by("digest", "at").alias("digest"))  # of repeated paths the last
    different = J.difference(expected.select("path", "bytes", "digest"), actual.select("path", "bytes", "digest"))
    out.append(different.select(F.lit("artifact").alias("scope"), F.col("path").alias("key"), F.col("problem").alias("rule")))

    total = actual.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("size"), F.coalesce(F.bool_or(path == S.ARTIFACT_ROOTS["state_file"]), F.lit(False)).alias("has_state"))
    one = manifest.select(F.col("doc").alias("m")).crossJoin(state.select(F.col("doc").alias("s"))).crossJoin(total)  # of one row each
    m, s = F.col("m"), F.col("s")
    told(one, "manifest", F.lit("manifest"), {
        "manifest": ~F.coalesce(F.schema_of_variant(m).startswith("OBJECT"), F.lit(False)), "fields": ~keys(m).eqNullSafe(exactly(FIELDS)), "schema": ~get(m, "$.schema").eqNullSafe(F.lit(schema)), "state_status": ~F.coalesce(get(m, "$.state_status").isin(*RUN_STATUSES), F.lit(False)),
        "last_run_at": ~kind(m, "$.last_run_at").isin("STRING", "VOID"), "files": ~kind(m, "$.files").startswith("ARRAY"), "file_count": (kind(m, "$.file_count") != "BIGINT") | ~get(m, "$.file_count", "bigint").eqNullSafe(F.col("n")), "total_bytes": (kind(m, "$.total_bytes") != "BIGINT") | ~get(m, "$.total_bytes", "bigint").eqNullSafe(F.col("size")),
        "no_state_file": ~F.col("has_state"), "state_differs": ~get(m, "$.state_status").eqNullSafe(get(s, "$.status")), "last_run_differs": ~get(m, "$.last_run_at").eqNullSafe(get(s, "$.last_run_at")),
    })
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return whole


def manifest_of(found: DataFrame, state: DataFrame, schema: str = SCHEMA) -> DataFrame:
    """doc (VARIANT): the manifest of what was found. Its files are in order of their paths."""
    row = F.struct("path", "bytes", F.col("digest").alias("sha256"))
    total = found.where((F.col("kind") == "file") & S.artifact_allowed(F.col("path"))).agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"), F.array_sort(F.collect_list(row)).alias("files"))
    s = lambda p: F.try_variant_get("doc", p, "string")
    told = state.select(F.lit(schema).alias("schema"), s("$.status").alias("state_status"), s("$.last_run_at").alias("last_run_at")).crossJoin(total)  # of one row each
    return told.select(F.parse_json(F.to_json(F.struct("schema", "state_status", "last_run_at", "files", "file_count", "total_bytes"), {"ignoreNullFields": "false"})).alias("doc"))


def write_manifest(spark: SparkSession, root: str, output: str) -> dict:
    """Write the manifest of a checkout, which must break no rule; below the root, beside the artifact's folders."""
    from corvane.sources.archive import ArchiveError, atomic_text

    base, target = os.path.realpath(root), os.path.realpath(os.path.join(root, output))
    inside = os.path.relpath(target, base)
    if inside.split(os.sep)[0] in ("..", ".", *ROOTS):
        raise ArchiveError("the manifest must lie below the root, outside the artifact's folders")
    state = document(spark.createDataFrame([(_text(os.path.join(base, S.ARTIFACT_ROOTS["state_file"])),)], "t string"))
    found = settled(files(spark, base), "artifact")  # digests are read once
    try:
        doc = manifest_of(found, state)
        bad = violations(doc, found, state).limit(3).collect()
        if bad:
            raise ArchiveError(f"not an artifact: {[(r.key, r.rule) for r in bad]}")
        value = json.loads(doc.select(F.to_json("doc").alias("j")).first().j)
    finally:
        drop(found)
    atomic_text(target, json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n")
    return value


def verify(spark: SparkSession, root: str, manifest: str) -> DataFrame:
    """The violations of a checkout and its manifest (a path below the root)."""
    full = os.path.join(root, manifest)
    if not os.path.lexists(full) or _kind(full) != "file" or os.path.relpath(os.path.realpath(full), os.path.realpath(root)).startswith(".."):
        return spark.createDataFrame([("manifest", manifest, "not_a_file")], "scope string, key string, rule string")
    doc = lambda p: document(spark.createDataFrame([(_text(p),)], "t string"))
    return violations(doc(full), files(spark, root), doc(os.path.join(root, S.ARTIFACT_ROOTS["state_file"])))


def _text(path: str) -> str | None:
    try:
        with open(path, encoding="utf-8") as f:
            return f.read()
    except (OSError, UnicodeDecodeError):
        return None
