"""Packing token pieces into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows, which are sequences of their own, and a rest, cut into pieces of at most a
quarter of a window. Pieces are dealt at random into groups of bounded size. In a group, each piece starts as a partial
partition into k windows; the two partial partitions with the largest imbalance are merged, the fullest windows of one
with the emptiest of the other, until one is left, whose windows are nearly equal. k starts at the least that could
hold the group's tokens and rises whenever a window exceeds the capacity.

Ids come from tiktoken, which gives the ids of the tokenizers file several times as fast; texts that it can't take and
texts with very long words go to the tokenizers library.

Defined cases: null and empty texts are one piece with the end id alone; repeated rows are packed row by row; an
empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Pieces that a group has on average; a piece of a rest is at most this part of a window.
GROUP, PART = 2048, 4
LONG_WORD = 2000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Token ids of texts; files are named as in public_tokenizers or given as paths."""

    def __init__(self, tokenizer: str = "byte_bpe_50k.json", ranks: str | None = "byte_bpe_50k.tiktoken"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        find = lambda name: name if os.sep in name else public_tokenizers.path(name)
        self.slow = Tokenizer.from_file(find(tokenizer))
        self.fast = None
        if ranks:
            import tiktoken

            special = {t.content: i for i, t in self.slow.get_added_tokens_decoder().items() if t.special}
            with open(find(ranks), "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and (len(text) <= LONG_WORD or max(map(len, text.split()), default=0) <= LONG_WORD):
            try:
                return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), np.uint32)
            except BaseException as e:  # a panic of the extension, where its regular expressions reach their limits
                if type(e).__name__ != "PanicException" and not isinstance(e, (ValueError, RuntimeError)):
                    raise
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", **encoder) -> DataFrame:
    """The pieces of every document: full windows, and parts of the rest."""
    part = max(1, window // PART)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(**encoder)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                n, at = len(ids), 0
                while at < n:
                    k = window if n - at >= window else min(part, n - at)
                    rows.append((doc, at, k, zlib.crc32(ids[at : at + k]), n))
                    at += k
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECE)


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
    """Sums and items of k windows by multiway differencing."""
    owners: list[tuple[int, int]] = []  # pairs of what was put together; ids from len(sizes) on
    n = len(sizes)
    heap = []
    for i, s in enumerate(sizes.tolist()):
        sums, ids = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], ids[0] = s, i
        heap.append((-s if k > 1 else 0, i, sums, ids))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        (_, _, a, x), (_, _, b, y) = heapq.heappop(heap), heapq.heappop(heap)
        b, y = b[::-1], y[::-1]
        sums, ids = a + b, np.where(x < 0, y, x)
        for j in np.flatnonzero((x >= 0) & (y >= 0)).tolist():
            ids[j] = n + len(owners)
            owners.append((int(x[j]), int(y[j])))
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, ids))
        made += 1
    sums, ids = heap[0][2:]
    out = []
    for i in ids.tolist():
        items, stack = [], [i] if i >= 0 else []
        while stack:
            j = stack.pop()
            if j < n:
                items.append(j)
            else:
                stack += owners[j - n]
        out.append(sorted(items))
    return sums, out


def near_equal_windows(sizes: np.ndarray, window: int) -> list[list[int]]:
    """Items of each window; the window count rises until no window exceeds the capacity."""
    k = max(1, -(-int(sizes.sum()) // window))
    while True:
        sums, items = differencing(sizes, k)
        if sums.max() <= window:
            return [x for x in items if x]
        k += 1


def pack(docs: DataFrame, window: int = 2048, end_id: int = 1, **options) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    cut = settle(pieces(docs, window, end_id, **options).withColumn("rid", F.monotonically_increasing_id()), "pack-pieces")
    rest = cut.where(F.col("length") < window)
    groups = max(1, round(rest.count() / GROUP))

    def assign(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid", ignore_index=True)
        size, sid, off = pdf["length"].to_numpy(), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for j, items in enumerate(near_equal_windows(size, window)):
            sid[items] = ((key[0] << 20) | j) * 2
            off[items] = np.cumsum(size[items]) - size[items]
        return pdf.assign(sequence_id=sid, offset=off).drop(columns=["rid", "g"])

    dealt = rest.withColumn("g", F.pmod(F.xxhash64("rid"), F.lit(groups)))
    packed = dealt.groupBy("g").applyInPandas(assign, f"{PIECE}, sequence_id long, offset long")
    full = cut.where(F.col("length") == window).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
