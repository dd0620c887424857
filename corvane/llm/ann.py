"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to floor((a . x + b) / w) for a few Gaussian (2-stable) directions a; a cell is as
wide as twice the projections' deviation and cells are folded into CELLS for each direction, so that the number of
buckets is bounded, and a bucket holds about 12 rows. A query visits its own
bucket and then perturbed ones in the order of their estimated success - the squared distance, over all directions, from
the query's projection to the bucket's cell - until it has seen a share of the rows. That share is the smallest that
reaches ``recall`` for a bounded sample of vectors (SAMPLE_QUERIES), whose true neighbours among all rows are found by
brute force, in one pass: it falls as the table grows, where its vectors have directions. Candidates of all tables are
merged and reranked by the exact measure. The largest inner product becomes the smallest distance with one more
component, sqrt(max norm^2 - norm^2), which is 0 for queries.

Buckets are cut into chunks of bounded size and dealt, by chunk, to groups. Queries go in blocks, neighbouring buckets
together, to the groups of the chunks that they visit, and a vector goes to those blocks that visit its chunk, no others.
Every group answers with its best k of each query, so that a hot bucket is split and a task holds a bounded number of
vectors and queries. On directionless data no hashing is selective: the share is then large, whatever the method.

Defined cases: null, empty or zero vectors, those with null or non-finite components, null ids, and vectors whose length
isn't the most common one, take no part; ties go to the smaller id; repeated ids are one candidate; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

TABLES, CELLS, WIDTH = 2, 2, 2.0
#: Rows that widths are fitted on, and queries that the share is; vectors of a chunk, of a group, and queries of a block.
SAMPLE, SAMPLE_QUERIES = 4000, 200
CHUNK, GROUP, BLOCK = 512, 16_384, 8192
MOST_CHUNKS, MOST_DIRECTIONS = 1 << 22, 16
#: Queries whose lists of chunks are in memory at once.
ASKED = 64


@dataclass
class Hashes:
    """Directions, offsets and widths of every table; the share of rows to visit."""

    top: float
    a: np.ndarray  # tables x (dim + 1) x m
    b: np.ndarray  # tables x m
    w: np.ndarray  # tables x m
    share: float = 1.0

    def project(self, x: np.ndarray, query: bool) -> np.ndarray:
        """tables x rows x m, in units of a cell."""
        norm = np.linalg.norm(x, axis=1)
        if query:
            x, extra = x * (self.top / norm)[:, None], np.zeros(len(x))
        else:
            extra = np.sqrt(np.maximum(0, self.top**2 - norm**2))
        return (np.column_stack([x, extra]) @ self.a + self.b[:, None, :]) / self.w[:, None, :]

    def codes(self, p: np.ndarray) -> np.ndarray:
        """tables x rows: bucket numbers, unique over all tables."""
        cell = np.clip(np.floor(p), -CELLS // 2, CELLS // 2 - 1).astype(np.int64) + CELLS // 2
        m = p.shape[2]
        return cell @ CELLS ** np.arange(m) + (np.arange(len(p)) * CELLS**m)[:, None]

    def visits(self, p: np.ndarray, buckets: np.ndarray, counts: np.ndarray, rows: int, k: int) -> list[np.ndarray]:
        """For each query the positions of the buckets (of one table) that it visits, in order. p: queries x m."""
        m = p.shape[1]
        cell = (buckets[:, None] % CELLS**m // CELLS ** np.arange(m)) % CELLS - CELLS // 2
        lo, hi = np.where(cell == -CELLS // 2, -np.inf, cell), np.where(cell == CELLS // 2 - 1, np.inf, cell + 1)
        out = []
        for one in p:
            far = (np.maximum(np.maximum(lo - one, one - hi), 0) ** 2).sum(1)
            order = np.argsort(far, kind="stable")
            seen = np.cumsum(counts[order])
            out.append(order[: int(np.searchsorted(seen, min(rows, max(self.share * rows, 4 * k)))) + 1])
        return out


def directions(x: np.ndarray, top: float, rows: int, seed: int = 7) -> Hashes:
    """Hashes for ``rows`` rows like those of the sample x: about 12 rows a bucket."""
    m = int(np.clip(round(np.log2(max(rows, 64) / 12) / np.log2(CELLS)), 2, MOST_DIRECTIONS))
    rng = np.random.default_rng(seed)
    h = Hashes(top, rng.normal(size=(TABLES, x.shape[1] + 1, m)), np.zeros((TABLES, m)), np.ones((TABLES, m)))
    p = h.project(x, False)
    h.w = np.maximum(WIDTH * p.std(axis=1), 1e-9)
    h.b = rng.uniform(-0.25, 0.25, h.b.shape) * h.w - p.mean(axis=1)
    return h


def needed_share(h: Hashes, q: np.ndarray, near: list[np.ndarray], buckets: np.ndarray, counts: np.ndarray, rows: int, recall: float) -> float:
    """The share of rows after which queries q have seen ``recall`` of their true neighbours, whose vectors are given."""
    need = []
    pq = h.project(q, True)
    codes = [h.codes(h.project(x, False)) if len(x) else np.zeros((TABLES, 0), np.int64) for x in near]
    h.share = 1.0
    for t in range(TABLES):
        of = np.flatnonzero(buckets // CELLS ** pq.shape[2] == t)
        at = []
        for i, order in enumerate(h.visits(pq[t], buckets[of], counts[of], rows, rows)):
            seen = np.full(len(of), 2.0)  # the share at which the query comes to a bucket
            seen[order] = (np.cumsum(counts[of][order]) - counts[of][order]) / rows
            at.append(seen[np.searchsorted(buckets[of], codes[i][t])])
        need.append(np.concatenate(at) if at else np.zeros(0))
    least = np.sort(np.minimum.reduce(need))
    return float(min(1.0, least[min(len(least) - 1, int(np.ceil(recall * len(least))))] + 1e-9)) if len(least) else 1.0


def true_neighbours(cells: DataFrame, q: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """Vectors of the k rows with the largest inner products for each of a bounded number of queries."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, scores, ids, vecs = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros((0, q.shape[1])))
        for b in batches:
            if not b.num_rows:
                continue
            v, i = _matrix(b.column(1)), b.column(0).to_numpy()
            s = q @ v.T
            s[own[:, None] == i[None, :]] = -np.inf
            top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
            at = np.concatenate([at, np.repeat(np.arange(len(q)), top.shape[1])])
            scores = np.concatenate([scores, np.take_along_axis(s, top, 1).reshape(-1)])
            ids, vecs = np.concatenate([ids, i[top.reshape(-1)]]), np.concatenate([vecs, v[top.reshape(-1)]])
            order = np.lexsort((ids, -scores, at))
            place = np.arange(len(order)) - np.searchsorted(at[order], at[order])
            keep = order[place < k]
            at, scores, ids, vecs = at[keep], scores[keep], ids[keep], vecs[keep]
        ok = np.isfinite(scores)
        yield pa.RecordBatch.from_arrays([pa.array(at[ok]), pa.array(scores[ok]), pa.array(ids[ok]), pa.array(list(vecs[ok]), pa.list_(pa.float64()))], ["q", "score", "id", "vec"])

    found = cells.select("id", "vec").mapInArrow(best, "q long, score double, id long, vec array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "id"))
    got = found.withColumn("place", place).where(F.col("place") <= k).select("q", "vec").collect()  # k rows a query
    out: list[list] = [[] for _ in q]
    for r in got:
        out[r.q].append(r.vec)
    return [np.array(v).reshape(-1, q.shape[1]) for v in out]


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (array<double>) of the vectors that take part."""
    v = F.col("vec")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    out = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(F.col("id").isNotNull() & v.isNotNull()).where(good)
    common = out.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return out.where(F.size("vec") == (common.d if common else 0))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _matrix(column) -> np.ndarray:
    """A list array of equal lengths as a matrix."""
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    """Arrays of whole numbers as a list array, without Python objects."""
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))


def nearest(base: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for each row of queries among other rows of base."""
    spark = base.sparkSession
    x, q = usable(base, id_col, vec_col), usable(queries, id_col, vec_col)
    schema = "query_id long, vec_id long, score double"
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, e: s + e * e))
    stat = x.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).first()
    if not stat.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    got = x.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    h = directions(np.array([r.vec for r in got]), stat.top, stat.n)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = h.codes(h.project(_matrix(b.column(1)), False))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(codes.T), pa.list_(pa.int64()))], ["id", "vec", "buckets"])

    cells = settle(x.mapInArrow(hashed, "id long, vec array<double>, buckets array<long>"), "ann-index")
    sizes = cells.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("bucket").collect()  # at most TABLES * CELLS^MOST_DIRECTIONS rows
    buckets, counts = np.array([r.bucket for r in sizes]), np.array([r.n for r in sizes])
    sample = got[:SAMPLE_QUERIES]
    sv, own = np.array([r.vec for r in sample]), np.array([r.id for r in sample])
    h.share = needed_share(h, sv, true_neighbours(cells, sv, own, k), buckets, counts, stat.n, recall)
    m = h.a.shape[2]
    of_table = [np.flatnonzero(buckets // CELLS**m == t) for t in range(TABLES)]
    chunks = np.minimum(-(-counts // CHUNK), MOST_CHUNKS)
    groups = max(8, -(-stat.n * TABLES // GROUP))
    n_queries = q.count()
    # queries of neighbouring buckets of the first table are a block; a large bucket's are split by their ids
    ranges = max(1, -(-n_queries // BLOCK))
    mine = of_table[0]
    first = (np.cumsum(counts[mine]) - counts[mine]) * ranges // stat.n

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ASKED):  # a query's list of chunks is long: a few queries at a time
                yield from asked_few(whole.slice(start, ASKED))

    def asked_few(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p = h.project(_matrix(b.column(1)), True)
        near = np.minimum(np.searchsorted(buckets[mine], h.codes(p)[0]), len(mine) - 1)
        split = np.maximum(1, counts[mine][near] * n_queries // stat.n // BLOCK)
        block = first[near] * (1 << 20) + (mixed(b.column(0).to_numpy().astype(np.uint64)) % split.astype(np.uint64)).astype(np.int64)
        at, units = [], []
        visited: dict[tuple[int, int], list[np.ndarray]] = {}  # chunks by group and block, of these queries
        visits = [h.visits(p[t], buckets[of], counts[of], stat.n, k) for t, of in enumerate(of_table)]
        for i in range(b.num_rows):
            go = np.concatenate([of[v[i]] for of, v in zip(of_table, visits, strict=True)])
            c = np.repeat(buckets[go], chunks[go])
            j = np.arange(len(c)) - np.repeat(np.cumsum(chunks[go]) - chunks[go], chunks[go])
            g = (c * 7919 + j * 104729) % groups
            order = np.argsort(g, kind="stable")
            u, g = (c * MOST_CHUNKS + j)[order], g[order]
            cut = np.flatnonzero(np.diff(g)) + 1
            for start, part in zip([0, *cut.tolist()], np.split(u, cut), strict=True):
                at.append((int(g[start]), i))
                units.append(part)
                visited.setdefault((int(g[start]), int(block[i])), []).append(part)
        rows = pa.array([i for _, i in at])
        none = pa.nulls(len(visited), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in visited], pa.int64()), pa.array([b for _, b in visited], pa.int64()), none, pa.nulls(len(visited), pa.list_(pa.float64())), _lists([np.unique(np.concatenate(v)) for v in visited.values()])], ["g", "block", "id", "vec", "units"])
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in at], pa.int64()), pa.array(block).take(rows), b.column(0).take(rows), b.column(1).take(rows), _lists(units)], ["g", "block", "id", "vec", "units"])

    told = settle(q.mapInArrow(asked, "g long, block long, id long, vec array<double>, units array<long>"), "ann-asked")
    ask = told.where("id IS NOT NULL")
    table = spark.createDataFrame(pd.DataFrame({"b": buckets, "c": chunks}))
    at = cells.select("id", "vec", F.explode("buckets").alias("bucket")).join(F.broadcast(table), F.col("bucket") == F.col("b"))  # at most TABLES * CELLS^MOST_DIRECTIONS rows
    at = at.select("id", "vec", (F.col("bucket") * MOST_CHUNKS + F.pmod(F.xxhash64("id"), F.col("c"))).alias("unit"))
    wanted = told.where("id IS NULL").select(F.col("g").alias("w_g"), F.col("block").alias("w_block"), F.explode("units").alias("unit")).distinct()  # the directory: who visits which chunk
    at = at.join(wanted, "unit").select(F.col("w_g").alias("at_g"), F.col("w_block").alias("at_block"), "id", "vec", "unit")

    def best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if left.empty or right.empty:
            return empty
        left = left.sort_values(["unit", "id"], ignore_index=True)
        v, ids, unit = np.stack(left["vec"].to_numpy()), left["id"].to_numpy(), left["unit"].to_numpy()
        w, own = np.stack(right["vec"].to_numpy()), right["id"].to_numpy()
        lens = right["units"].map(len).to_numpy()
        wanted, by = np.concatenate(right["units"].to_numpy()), np.repeat(np.arange(len(own)), lens)
        order = np.argsort(wanted, kind="stable")
        wanted, by = wanted[order], by[order]
        floor = np.full(len(own), -np.inf)
        kept: list[list[np.ndarray]] = [[], [], []]

        def squeeze() -> None:
            i, j, s = (np.concatenate(c) for c in kept)
            o = np.lexsort((ids[j], -s, i))
            i, j, s = i[o], j[o], s[o]
            new = np.concatenate([[True], (i[1:] != i[:-1]) | (ids[j[1:]] != ids[j[:-1]])])  # equal ids score alike
            i, j, s = i[new], j[new], s[new]
            start = np.searchsorted(i, np.arange(len(own)))
            place = np.arange(len(i)) - start[i]
            full = np.flatnonzero(place == k - 1)
            floor[i[full]] = s[full]
            top = place < k
            kept[:] = [i[top]], [j[top]], [s[top]]

        held = 0
        starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        for a, z in zip(starts, [*starts[1:], len(unit)], strict=True):
            who = by[np.searchsorted(wanted, unit[a]) : np.searchsorted(wanted, unit[a], "right")]
            if not len(who):
                continue
            s = w[who] @ v[a:z].T
            i, j = np.nonzero((s >= floor[who][:, None] - 1e-9 * h.top**2) & (own[who][:, None] != ids[a:z][None, :]))
            if len(i):
                i, j = who[i], j + a
                for c, y in zip(kept, (i, j, np.einsum("ij,ij->i", w[i], v[j])), strict=True):
                    c.append(y)
                held += len(i)
            if held > 4 * k * len(own) + 10_000:
                squeeze()
                held = len(kept[0][0])
        if not held:
            return empty
        squeeze()
        i, j, s = (c[0] for c in kept)
        return pd.DataFrame({"query_id": own[i], "vec_id": ids[j], "score": s})

    found = at.groupBy("at_g", "at_block").cogroup(ask.groupBy("g", "block")).applyInPandas(best, schema)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
