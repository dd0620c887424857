"""Benchmark decontamination by a distributed positional inverted index.

Documents are dealt into segments of bounded size. A segment keeps, for every term of its texts, the ascending list of
its positions; segments are rows of a table in the shared folder, so an index is stored once and searched often. A
search brings the test windows to every segment in blocks of bounded size: in a segment, the lists of a window's terms
are intersected from the rarest on, each moved by its term's offset in the window, for all windows of a block at once.
What is left are exact phrases; with a slack, each term may lie so many words off its place (proximity matches). Nothing
is shuffled, no list leaves its segment, and a frequent term is long only within a segment.

Windows of several blocks find hits in the same document; their spans are put together document by document.

Defined cases: null and empty texts have no words; a document longer than a segment is a segment of its own; repeated
documents are judged row by row; items with equal ids count as one item, and an item without an id counts by the empty
id; items without words have no window; empty tables give no rows and no hits; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Words are runs of ASCII letters (lower-cased), digits and bytes of characters beyond ASCII; all else separates.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of text of a segment, item words of a block of windows, candidates that are intersected at once.
SEGMENT, BLOCK, AT_ONCE = 8 << 20, 200_000, 1 << 21
#: Words of an item that travel as one row.
PART = 10_000

INDEX = "seg long, doc_ids array<long>, starts binary, terms binary, counts binary, positions binary, n_words binary"
FOUND = "seg long, at int, doc_id long, n_words long, spans array<struct<lo:int,hi:int>>, items array<string>"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(LETTERS).split() if text else []


class Numbers(dict):
    """Numbers of terms in order of their first appearance."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def segment(seg: int, ids: list, texts: list[list[bytes]]) -> dict:
    """Postings of a segment: terms in byte order, and their positions one after the other; a gap of one position
    between documents keeps phrases within them."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(n + 1) - (n + 1)
    numbers = Numbers()
    term = np.concatenate([np.fromiter(map(numbers.__getitem__, ws), np.int32, len(ws)) for ws in texts] or [np.zeros(0, np.int32)])
    at = (np.arange(len(term)) + np.repeat(np.arange(len(n)), n)).astype(np.int32)
    names = list(numbers)
    order = sorted(range(len(names)), key=names.__getitem__)
    place = np.empty(len(names), np.int32)
    place[order] = np.arange(len(names), dtype=np.int32)
    term = place[term]
    return {"seg": seg, "doc_ids": ids, "starts": starts.astype("<i8").tobytes(), "terms": b" ".join(names[i] for i in order), "counts": np.bincount(term, minlength=len(names)).astype("<i4").tobytes(), "positions": at[np.argsort(term, kind="stable")].astype("<i4").tobytes(), "n_words": n.astype("<i8").tobytes()}


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None) -> DataFrame:
    """The positional inverted index of all texts, settled: one row per segment."""
    most = size or SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seg", pa.int64()), ("doc_ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("starts", "terms", "counts", "positions", "n_words")]])
        task, made, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                if ids and held + len(text or "") > most:
                    yield pa.RecordBatch.from_pylist([segment(task << 32 | made, ids, texts)], schema)
                    made, ids, texts, held = made + 1, [], [], 0
                ids.append(doc)
                texts.append(words(text))
                held += len(text or "") + 16
        if ids:
            yield pa.RecordBatch.from_pylist([segment(task << 32 | made, ids, texts)], schema)

    return settle(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, INDEX), "positions", packed=True)


def item_parts(items: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The words of the items, cut into parts that overlap by a window less one word: (item, size, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ws = words(text.as_py())
                for k in range(0, max(1, len(ws) - n + 1) if ws else 0, PART):
                    part = ws[k : k + PART + n - 1]
                    rows.append((item, len(part), b" ".join(part)))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.int64(), pa.binary()))], ["item", "size", "words"])

    return items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).mapInArrow(run, "item string, size long, words binary")


class Windows:
    """The windows of a block: rows of term numbers, -1 beyond the end of a short item, and the item of each."""

    def __init__(self, parts: list[tuple[str, bytes]], n: int):
        self.terms, self.names, rows, owner = Numbers(), list(dict.fromkeys(p[0] for p in parts)), [], []
        number = {x: k for k, x in enumerate(self.names)}
        for item, text in parts:
            ids = np.fromiter(map(self.terms.__getitem__, text.split(b" ")), np.int32)
            if len(ids) < n:
                ids = np.pad(ids, (0, n - len(ids)), constant_values=-1)
            rows.append(np.lib.stride_tricks.sliding_window_view(ids, n))
            owner.append(np.full(len(rows[-1]), number[item], np.int32))
        every = np.column_stack([np.concatenate(owner), np.concatenate(rows)]) if rows else np.zeros((0, n + 1), np.int32)
        every = np.unique(every, axis=0)
        self.item, self.rows = every[:, 0], every[:, 1:]
        self.terms = dict(self.terms)


def matches(w: Windows, terms: list[bytes], counts: np.ndarray, positions: np.ndarray, starts: np.ndarray, n_words: np.ndarray, slack: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, document, start) of the windows that occur in a segment, by intersecting lists from each window's rarest
    term on. Where a term has a place in the interval that its offset and the slack allow, within the document, the
    candidate stays."""
    local = np.full(len(w.terms) + 1, -1, np.int64)  # the last is for -1, the padding
    known = np.fromiter(map(w.terms.get, terms, repeat(-1)), np.int64, len(terms))
    there = np.flatnonzero(known >= 0)
    local[known[there]] = np.arange(len(there))
    size, ends = counts[there].astype(np.int64), np.cumsum(counts.astype(np.int64))[there]
    begin = np.cumsum(size) - size
    lists = positions[np.repeat(ends - size - begin, size) + np.arange(size.sum())].astype(np.int64)
    span = np.int64(1) << 33
    keys = np.repeat(np.arange(len(there)), size) * span + lists
    pad = w.rows < 0
    num = local[w.rows]
    live = np.flatnonzero(((num >= 0) | pad).all(axis=1))
    if not len(live):
        return
    num, pad = num[live], pad[live]
    length = (~pad).sum(axis=1)
    size = np.append(size, 1 << 62)
    rarest = np.argsort(size[np.where(pad, -1, num)], axis=1, kind="stable")
    first = np.take_along_axis(num, rarest[:, :1], axis=1)[:, 0]
    many = np.cumsum(size[first])
    cuts = [0]
    while cuts[-1] < len(live):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(many, (many[cuts[-1] - 1] if cuts[-1] else 0) + AT_ONCE, "right"))))
    for a, z in zip(cuts, cuts[1:], strict=False):
        n = size[first[a:z]]
        win = np.repeat(np.arange(a, z), n)
        seed = lists[np.repeat(begin[first[a:z]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        start, doc = seed - rarest[win, 0], np.searchsorted(starts, seed, "right") - 1
        for k in range(1, num.shape[1]):
            more = length[win] > k
            off = rarest[win, k]
            key, want = num[win, off] * span, start + off
            least, most = key + np.maximum(want - slack, starts[doc]), key + np.minimum(want + slack, starts[doc] + n_words[doc] - 1)
            at = np.minimum(np.searchsorted(keys, least), len(keys) - 1)
            kept = ~more | (keys[at] >= least) & (keys[at] <= most)
            win, doc, start = win[kept], doc[kept], start[kept]
        yield live[win], doc, start


def hits_of_segment(w: Windows, r: dict, n: int, slack: int) -> tuple[list, list]:
    """Per document of a segment, the merged spans of words that windows cover, and the items of those windows."""
    starts, length = np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["n_words"], "<i8")
    spans, found = [None] * len(starts), [None] * len(starts)
    pairs = []
    for win, doc, start in matches(w, r["terms"].split(b" "), np.frombuffer(r["counts"], "<i4"), np.frombuffer(r["positions"], "<i4"), starts, length, slack):
        lo = start - starts[doc]
        hi = lo + (w.rows[win] >= 0).sum(axis=1)
        pairs.append(np.column_stack([doc, np.maximum(lo, 0), np.minimum(hi, length[doc]), w.item[win]]))
    if pairs:
        every = np.concatenate(pairs)
        every = every[np.lexsort((every[:, 1], every[:, 0]))]
        for part in np.split(every, np.flatnonzero(np.diff(every[:, 0])) + 1):
            if len(part):
                reach = np.maximum.accumulate(part[:, 2])
                new = np.append(True, part[1:, 1] > reach[:-1])
                at = np.flatnonzero(new)
                d = int(part[0, 0])
                spans[d] = [{"lo": int(a), "hi": int(z)} for a, z in zip(part[at, 1], reach[np.append(at[1:], len(part)) - 1], strict=True)]
                found[d] = [w.names[i] for i in np.unique(part[:, 3])]
    return spans, found


def search(index: DataFrame, items: DataFrame, n: int = 10, slack: int = 0, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, spans (of covered words: from, to), items of every document of the index. Windows are n
    consecutive words of an item, and the whole item where it has fewer. With a slack, a window also occurs where each of
    its terms lies at most so many words off its place."""
    spark = index.sparkSession
    parts = settle(item_parts(items, n, id_col, text_col), "windows")
    blocks = max(1, -(-(parts.agg(F.sum("size")).first()[0] or 0) // BLOCK))
    numbered = settle(parts.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks))), "window-blocks") if blocks > 1 else parts.withColumn("block", F.lit(0))
    schema = pa.schema([("seg", pa.int64()), ("at", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))), ("items", pa.list_(pa.string()))])
    found = []
    for k in range(blocks):
        held = spark.sparkContext.broadcast([(r.item, bytes(r.words)) for r in numbered.where(F.col("block") == k).select("item", "words").collect()])  # about BLOCK words

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            w = Windows(held.value, n)
            for b in batches:
                for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                    spans, names = hits_of_segment(w, r, n, slack)
                    size = len(spans)
                    yield pa.RecordBatch.from_arrays([pa.array([r["seg"]] * size, pa.int64()), pa.array(np.arange(size, dtype=np.int32)), pa.array(r["doc_ids"], pa.int64()), pa.array(np.frombuffer(r["n_words"], "<i8")), pa.array(spans, schema.field("spans").type), pa.array(names, schema.field("items").type)], schema=schema)

        found.append(index.mapInArrow(run, FOUND))
    out = found[0]
    if blocks > 1:
        for f in found[1:]:
            out = out.unionByName(f)
        out = out.groupBy("seg", "at").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        out = out.withColumn("spans", F.when(F.size("spans") > 0, merged(F.array_sort("spans"))))
    return out.select("doc_id", "n_words", F.coalesce("spans", F.array()).cast("array<struct<lo:int,hi:int>>").alias("spans"), F.coalesce("items", F.array()).cast("array<string>").alias("items"))


def merged(spans: Column) -> Column:
    """Sorted spans with those that meet or overlap put together."""

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"))))
        return F.when(F.size(acc) == 0, F.array(x)).when(x["lo"] <= last["hi"], joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(spans, F.slice(spans, 1, 0), step)


def contaminated(docs: DataFrame, items: DataFrame, n: int = 10, slack: int = 0) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans and items of every document."""
    f = search(build_index(docs), items, n, slack)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
    return f.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), "spans", "items")
