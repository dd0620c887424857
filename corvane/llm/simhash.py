"""SimHash near-duplicates, found by covering locality-sensitive hashing.

A fingerprint's 64 bits are labelled with vectors of radius + 1 bits; for every non-zero vector v there is a table whose
mask keeps the bits whose label has an odd product with v. Up to ``radius`` differing bits have labels in a space of
smaller dimension, so some v is orthogonal to all of them and its table drops every differing bit: each pair within the
radius meets in some bucket, without exception. A bucket of more than a few fingerprints gives a spanning
forest of its links, not all of its pairs; links that are checked afterwards are all given, but for those inside a
component that checked links have made already.
A bucket with too many fingerprints for one task is covered again with other labels, on top of its own mask, so that
its pairs meet in narrower buckets; this too loses none.

Defined cases: null and empty texts (no words) have fingerprint zero and link like any other; repeated rows and equal
fingerprints are one node; an empty table gives an empty table; a row without an id has the component of its fingerprint
(null if no row with an id has the same) and links nothing by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, small
from .components import components

#: A bucket with more fingerprints than this is covered again; levels beyond the last compare within the bucket.
CROWDED, LEVELS = 16_384, 2
#: A bucket of no more fingerprints than this gives all its links at once. Where every link of a larger one is wanted, it
#: is dense with more than DENSE of them a member; those are then sought after others have been checked. Buckets of up to
#: MANY are compared all at once.
FEW, DENSE, MANY = 16, 8, 256


def shingle_hashes(text: str | None, n: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of the n-word shingles of the text with A-Z in lower case, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    spans = zip((end - size)[: len(words) - n + 1].tolist(), end[n - 1 :].tolist(), strict=True)
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), [joined[a:b] for a, b in spans]), np.uint64, len(words) - n + 1)


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The distinct upper halves of the shingles' hashes."""
    return np.unique(shingle_hashes(text, n) >> np.uint64(32)).astype(np.uint32)


def simhash(text: str | None, n: int = 4) -> int:
    """The signed 64-bit fingerprint: a bit is 1 if it is set in over half of the shingles' hashes."""
    h = shingle_hashes(text, n)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 14):
        votes += np.unpackbits(h[k : k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4) -> DataFrame:
    """doc_id, fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([simhash(t.as_py(), n) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc_id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id long, fp long")


@cache
def masks(radius: int = 4, seed: int = 0, parts: int = 1) -> list[int]:
    """Covering masks as signed longs; labels are dealt evenly over the non-zero vectors. Where there are fewer bits than
    these, labels are the largest vectors: small ones would leave a vector that nearly all are orthogonal to, and its
    table with a key of a bit or two.

    With more parts, the bits are cut into as many, one of which has at most radius / parts of the differing bits, and
    each is covered for that many: far fewer tables, with shorter keys.
    """
    each = radius // parts
    v_max = 1 << (each + 1)
    rng = np.random.default_rng(seed)
    out = []
    for bits in np.array_split(np.arange(64), parts):
        few = len(bits) < v_max - 1
        labels = rng.permutation(v_max - 1 - np.arange(len(bits)) if few else np.arange(len(bits)) % (v_max - 1) + 1)
        for v in range(1, v_max):
            m = sum(1 << int(i) for i, x in zip(bits, labels, strict=True) if int(x & v).bit_count() & 1)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def forest(fps: np.ndarray, nodes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Spanning links of one bucket, breadth-first, comparing with what isn't reached yet: positions of nodes, of the
    smallest of their tree, and of the one that they were reached from."""
    left = np.argsort(nodes, kind="stable")
    while len(left) > 1:
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            here = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[here]) <= radius
            if near.any():
                hit, left = left[near], left[~near]
                queue += hit.tolist()
                yield hit, int(root), int(here)


def near_pairs(fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a bucket within the radius, as positions, in blocks of bounded memory."""
    k = 0
    while k < len(fps) - 1:
        n = max(1, (1 << 20) // (len(fps) - k))
        i, j = np.nonzero(np.bitwise_count(fps[k : k + n, None] ^ fps[None, k:]) <= radius)
        yield i[i < j] + k, j[i < j] + k
        k += n


def near_apart(fps: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a bucket within the radius whose roots differ, as positions, in blocks of bounded memory; nodes of the
    most frequent root are compared with the others only."""
    _, which, many = np.unique(root, return_inverse=True, return_counts=True)
    order = np.argsort(which == np.argmax(many), kind="stable")  # the most frequent one's come last
    few = len(root) - int(many.max())
    f, r = fps[order], root[order]
    k = 0
    while k < few:
        n = min(few - k, max(1, (1 << 20) // (len(f) - k)))
        i, j = np.nonzero((np.bitwise_count(f[k : k + n, None] ^ f[None, k:]) <= radius) & (r[k : k + n, None] != r[None, k:]))
        yield order[i[i < j] + k], order[j[i < j] + k]
        k += n


def meets_first(bits: np.ndarray, table: int, radius: int, parts: int) -> np.ndarray:
    """Positions of the differing bits of a table's pairs that meet in none of the tables before it."""
    path, at = [], np.arange(len(bits))
    while table >= 0:
        table, k = divmod(table, len(masks(radius, parts=parts)))
        path.append(k)
        table -= 1
    for level, k in enumerate(reversed(path)):
        for m in masks(radius, level, parts)[:k]:
            at = at[bits[at] & np.uint64(m & (1 << 64) - 1) != 0]
    return at


def by_bucket(rows: DataFrame, extra: list[str], links: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """links(table_id, key, fp, node, *extra) of rows, dealt by bucket and read as one sorted stream; it gets whole buckets."""
    names = ["table_id", "key", "fp", "node", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * len(names)
        for batch in batches:
            if batch.num_rows:
                kept = [np.concatenate([k, c.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)]) for k, c in zip(kept, batch.columns, strict=True)]
                change = np.flatnonzero((kept[0][:-1] != kept[0][-1]) | (kept[1][:-1] != kept[1][-1]))
                if len(change):
                    yield from links(*[k[: change[-1] + 1] for k in kept])
                    kept = [k[change[-1] + 1 :] for k in kept]
        if len(kept[0]) > 1:
            yield from links(*kept)

    return rows.select(names).repartition("table_id", "key").sortWithinPartitions("table_id", "key").mapInArrow(run, schema)


def starts(t: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where buckets start, and their sizes."""
    start = np.concatenate([[0], np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1])
    return start, np.diff(np.concatenate([start, [len(t)]]))


def close_in_buckets(fp: np.ndarray, start: np.ndarray, size: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs within the radius of buckets (start, size), as positions, and the number of each one's bucket."""
    at = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
    bucket, end = np.repeat(np.arange(len(start)), size), np.repeat(start + size, size)
    found = [(np.empty(0, np.int64),) * 3]
    for o in range(1, int(size.max(initial=1))):
        more = at + o < end
        at, bucket, end = at[more], bucket[more], end[more]
        near = np.flatnonzero(np.bitwise_count(fp[at] ^ fp[at + o]) <= radius)
        found.append((at[near], at[near] + o, bucket[near]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def first_met(fp: np.ndarray, t: np.ndarray, i: np.ndarray, j: np.ndarray, radius: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of positions that meet in no table before their own."""
    order = np.argsort(t[i], kind="stable")
    i, j = i[order], j[order]
    kept = []
    for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(t[i])) + 1) if len(i) else []:
        kept.append(part[meets_first(fp[i[part]] ^ fp[j[part]], int(t[i[part[0]]]), radius, parts)])
    at = np.concatenate(kept) if kept else np.empty(0, np.int64)
    return i[at], j[at]


def bucket_links(rows: DataFrame, radius: int, parts: int = 1, every: bool = False) -> DataFrame:
    """a, b (a > b) of rows (table_id, key, fp, node): links that connect what is within the radius.

    every: all links, for links that are checked afterwards. A dense bucket gives one row without b (a: one of its nodes),
    and of its forest the links whose ends meet in no table before: others are joined by those of the earlier table,
    where they are in one tree or were a link. So each pair is given by one table at most, however many it meets in, and
    every node with another one within the radius is the end of a link: that of the first table where it has one.
    """
    dense, few = DENSE, FEW
    most = max(FEW, MANY) if every else FEW  # buckets of so many are compared all at once

    def links(t, key, fp, node) -> Iterator[pa.RecordBatch]:
        fp = fp.view(np.uint64)  # bits are counted of absolute values otherwise
        start, size = starts(t, key)
        short = (size > 1) & (size <= most)
        begin, n = start[short], size[short]
        i, j, bucket = close_in_buckets(fp, begin, n, radius)
        apart = size > most
        if every:
            many = (np.bincount(bucket, minlength=len(n)) > dense * n) & (n > few)
            apart[np.flatnonzero(short)[many]] = True
            i, j = first_met(fp, t, i[~many[bucket]], j[~many[bucket]], radius, parts)
        a, b, full = [np.maximum(node[i], node[j])], [np.minimum(node[i], node[j])], []
        for s, n in zip(start[apart].tolist(), size[apart].tolist(), strict=True):
            f, v = fp[s : s + n], node[s : s + n]
            if every:
                if n > most:
                    found, left = [], dense * n
                    for i, j in near_pairs(f, radius):
                        if (left := left - len(i)) < 0:
                            break
                        found.append((i, j))
                    if left >= 0:
                        i, j = (np.concatenate(x) for x in zip(*found, strict=True))
                        at = meets_first(f[i] ^ f[j], int(t[s]), radius, parts)
                        a.append(np.maximum(v[i[at]], v[j[at]]))
                        b.append(np.minimum(v[i[at]], v[j[at]]))
                        continue
                full.append(v[0])
            found = [(np.empty(0, np.int64),) * 2]
            for hit, root, via in forest(f, v, radius):
                found += [(hit, np.full(len(hit), x)) for x in ({root, via} if every else {root})]
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            if every:
                at = meets_first(f[i] ^ f[j], int(t[s]), radius, parts)
                i, j = i[at], j[at]
            a.append(np.maximum(v[i], v[j]))
            b.append(np.minimum(v[i], v[j]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
        if full:
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.nulls(len(full), pa.int64())], ["a", "b"])

    return by_bucket(rows, [], links, "a long, b long")


def sketch(h: np.ndarray) -> tuple[int, ...]:
    """Size of a set of hashes, and for each of 256 residues (four longs) whether an odd number of them has it."""
    odd = np.packbits(np.bincount(h & 255, minlength=256) & 1).view("<i8")
    return len(h), *odd.tolist()


def may_be_similar(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of sketches (a column each) aren't too far apart for the Jaccard similarity: sets differ in at least as
    many members as sketches in bits, so no similar pair is left out."""
    total = x[0] + y[0]
    differ = np.bitwise_count(x[1:].view(np.uint64) ^ y[1:].view(np.uint64)).sum(axis=0, dtype=np.int64)
    return total - differ >= similarity * (total + differ) - 1e-6


SKETCH = ["n_set", "odd0", "odd1", "odd2", "odd3"]


def rest_links(rows: DataFrame, radius: int, parts: int = 1, similarity: float = 0.0) -> DataFrame:
    """a, b (a > b) of rows (table_id, key, fp, node, root, SKETCH): every pair within the radius whose roots differ and
    that may have the similarity, once.

    Rows are of nodes that links were found for, all with their root; a bucket of no more than FEW of them was not dense,
    or none of its others has another one within the radius.
    """
    few = FEW

    def links(t, key, fp, node, root, *sketches) -> Iterator[pa.RecordBatch]:
        sketches = np.stack(sketches)
        fp = fp.view(np.uint64)
        for s, n in zip(*(x.tolist() for x in starts(t, key)), strict=True):
            r = root[s : s + n]
            if n <= few or (r == r[0]).all():
                continue
            f, v, k = fp[s : s + n], node[s : s + n], sketches[:, s : s + n]
            for i, j in near_apart(f, r, radius):
                can = may_be_similar(np.ascontiguousarray(k[:, i]), np.ascontiguousarray(k[:, j]), similarity)
                i, j = i[can], j[can]
                at = meets_first(f[i] ^ f[j], int(t[s]), radius, parts)
                if len(at):
                    x, y = v[i[at]], v[j[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["a", "b"])

    return by_bucket(rows, ["root", *SKETCH], links, "a long, b long")


def bucket_tables(nodes: DataFrame, radius: int, parts: int = 1) -> DataFrame:
    """node, fp, table_id, mask, key and further columns of nodes (fp, node, ...): a row for each table, more where a bucket is crowded."""

    def tables(rows: DataFrame, base, ms: list[int], mask=None) -> DataFrame:
        out = rows.select(*nodes.columns, base.alias("base"), (F.lit(0).cast("long") if mask is None else mask).alias("own"), F.posexplode(F.array(*[F.lit(m).cast("long") for m in ms])).alias("k", "m"))
        out = out.select(*nodes.columns, (F.col("base") * len(ms) + F.col("k")).cast("long").alias("table_id"), F.col("own").bitwiseOR(F.col("m")).alias("mask"))
        return out.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))

    first = masks(radius, parts=parts)
    rows = tables(nodes, F.lit(0), first)
    counters = max(1 << 16, nodes.count() * len(first) * 8 // CROWDED)
    ready = []
    for level in range(1, LEVELS):
        # buckets are counted one by one only where some of them together are crowded
        told = rows.withColumn("u", F.pmod(F.xxhash64("table_id", "key"), F.lit(counters)))
        busy = settle(told.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).select("u"), "simhash-busy")
        if not busy.limit(1).count():
            break
        crowded = told.join(small(busy), "u", "left_semi").groupBy(F.col("table_id").alias("c_table"), F.col("key").alias("c_key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED)
        crowded = settle(crowded.drop("n"), "simhash-crowded")
        if not crowded.limit(1).count():
            break
        both = rows.join(small(crowded), (F.col("table_id") == F.col("c_table")) & (F.col("key") == F.col("c_key")), "left")
        ready.append(both.where("c_table is null").select(rows.columns))
        rows = tables(both.where("c_table is not null"), F.col("table_id") + 1, masks(radius, level, parts), F.col("mask"))
    for r in ready:
        rows = rows.unionByName(r)
    return rows


def link_fingerprints(nodes: DataFrame, radius: int = 4, parts: int = 1) -> DataFrame:
    """Links a, b of nodes (fp, node) such that fingerprints within the radius are connected."""
    return bucket_links(bucket_tables(nodes, radius, parts), radius, parts)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, n: int = 4) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) of every row."""
    prints = settle(fingerprints(docs, id_col, text_col, n), "simhash")
    nodes = settle(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-nodes")
    roots = components(link_fingerprints(nodes, radius))
    comp = nodes.join(small(roots), "node", "left").select(F.col("fp").alias("n_fp"), F.coalesce("root", "node").alias("component_id"))
    return prints.join(small(settle(comp, "simhash-comp")), F.col("fp") == F.col("n_fp"), "left").select("doc_id", "fp", "component_id")


def ends(links: DataFrame, name: str) -> DataFrame:
    """Every node of links (a, b) once, as column name; each side is aggregated before both are put together."""
    return links.select(F.col("a").alias(name)).distinct().union(links.select("b").distinct()).distinct()


def similar_links(docs: DataFrame, links: DataFrame, n: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The links whose texts' sets of n-word shingles have at least the Jaccard similarity."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [shingle_set(t.as_py(), n).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hashes, pa.binary())], ["s_id", "shingles"])

    base = docs.select(F.col(id_col).cast("long").alias("s_id"), F.col(text_col).alias("text"))
    shingles = settle(base.join(small(settle(ends(links, "s_id"), "simhash-ends")), "s_id").dropDuplicates(["s_id"]).mapInArrow(sets, "s_id long, shingles binary"), "simhash-shingles")
    one = links.join(shingles.withColumnRenamed("s_id", "a").withColumnRenamed("shingles", "sa"), "a")
    both = one.join(shingles.withColumnRenamed("s_id", "b").withColumnRenamed("shingles", "sb"), "b").select("a", "b", "sa", "sb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common))
            kept = pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield kept

    return both.mapInArrow(check, "a long, b long")


def keep_one_of_each(docs: DataFrame, n: int = 5, similarity: float = 0.8, radius: int = 11, parts: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, without near-duplicates of rows with a smaller id.

    Equal texts are one node. Fingerprints of n-word shingles within the radius (texts of that similarity differ in about
    a sixth of their bits at most) give candidates by covering tables over two halves: all pairs within the radius, but in
    dense buckets first a spanning forest and then all pairs that the checked links haven't joined. Candidates are checked
    by the exact similarity of their shingle sets, and one row of each component of the checked links stays. Rows without an id stay; of rows with one id, one stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([simhash(t.as_py(), n) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), fp], ["doc_id", "same", "fp"])

    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.md5(F.coalesce(text_col, F.lit("")).cast("binary")).alias("same"))
    prints = settle(base.mapInArrow(run, "doc_id long, same string, fp long"), "simhash")
    nodes = settle(prints.groupBy("same").agg(F.min("doc_id").alias("node"), F.min("fp").alias("fp")), "simhash-nodes")
    found = settle(bucket_links(bucket_tables(nodes.select("node", "fp"), radius, parts), radius, parts, every=True).distinct(), "simhash-links")
    check = lambda links: settle(similar_links(docs, links, n, similarity, id_col, text_col), "simhash-similar")
    similar = check(found.where("b IS NOT NULL").select("a", "b"))
    roots = components(similar)
    if found.where("b IS NULL").limit(1).count():
        dense = settle(ends(found.where("b IS NOT NULL"), "a"), "simhash-dense")
        again = nodes.select("node", "fp").join(small(dense), F.col("node") == F.col("a"), "left_semi")
        again = again.join(small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))

        def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    rows = [sketch(shingle_set(t.as_py(), n)) for t in b.column(1)]
                    yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]], ["node", *SKETCH])

        texts = docs.select(F.col(id_col).cast("long").alias("a"), F.col(text_col).alias("text")).join(small(dense), "a", "left_semi").dropDuplicates(["a"])
        sketches = settle(texts.mapInArrow(sketched, "node long, " + ", ".join(f"{c} long" for c in SKETCH)), "simhash-sketches")
        again = settle(again.join(small(sketches), "node"), "simhash-again")
        rest = settle(rest_links(bucket_tables(again, radius, parts), radius, parts, similarity), "simhash-rest")
        rest = settle(rest.join(found, ["a", "b"], "left_anti"), "simhash-unchecked")
        roots = components(similar.unionByName(check(rest)))
    top = nodes.join(small(roots), "node", "left").select("same", F.coalesce("root", "node").alias("stays"))
    ids = prints.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("same").alias("same"))
    gone = settle(ids.join(small(top), "same").where("doc_id <> stays").select("doc_id"), "simhash-gone")
    key = "_simhash_id"
    while key in docs.columns:
        key += "_"
    left = docs.join(small(gone.withColumnRenamed("doc_id", key)), F.col(id_col) == F.col(key), "left_anti")
    twice = settle(ids.where("n > 1").select(F.col("doc_id").alias(key)), "simhash-twice")
    if twice.limit(1).count():
        again = F.col(id_col) == F.col(key)
        left = left.join(small(twice), again, "left_anti").unionByName(left.join(small(twice), again, "left_semi").dropDuplicates([id_col]))
    return left
