"""Suffix-array dedup of byte strings: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Repeated strings of at least ``length`` bytes are found in blocks of text. Suffixes are sorted to a depth beyond the
threshold, which gives the block's Burrows-Wheeler transform. Starting from the interval of all suffixes, intervals are
extended backwards by every byte before them, breadth first; an extension that ends where no boundary is known yet
sets one there, whose common prefix is the current depth, and is extended further. Common prefixes so come in
increasing order, and the expansion stops at the threshold: suffixes without a boundary between them share that many
bytes. The frame around blocks is shared_windows.

Defined cases: null text is empty; texts shorter than the threshold keep everything; repeated rows and equal ids aren't
smaller than each other and keep their text; a null id is larger than any other; an empty table gives an empty table;
further columns are ignored (dedup) or kept (trimmed).
"""

from __future__ import annotations

from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_windows import NULL_ID, Bytes, cut_by_minimiser, remove_repeats, sha256, spans


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes, sorted by at least their first ``depth`` bytes."""
    n = len(t)
    buf = t.tobytes() + bytes(16)
    key = np.empty(n + 8, np.uint64)
    for r in range(8):
        part = np.frombuffer(buf, ">u8", (n + 15 - r) // 8, r)
        key[r::8] = part[: len(key[r::8])]
    key = key[:n]
    sa = np.argsort(key)
    new = np.concatenate([[True], key[sa[1:]] != key[sa[:-1]]])
    rank = np.zeros(n + depth + 1, np.int64)  # the row where a suffix's group starts, plus 1
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1
    done = 8
    while done < depth:
        alone = new & np.append(new[1:], True)
        rows = np.flatnonzero(~alone)
        if not len(rows):
            break
        who = sa[rows]
        key = (rank[who] << 32) | rank[who + done]
        order = np.argsort(key)
        who, key = who[order], key[order]
        sa[rows] = who
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[who] = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))] + 1
        new[rows] = first
        done *= 2
    return sa


def boundaries(t: np.ndarray, sa: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each row of the suffix array with the row before, where below ``length``; else 255."""
    n = len(t)
    bwt = t[sa - 1]
    order = np.argsort(bwt, kind="stable").astype(np.int32)  # row of the suffix that is one byte shorter than that of row i
    back = np.empty(n, np.int32)
    back[order] = np.arange(n, dtype=np.int32)
    first = bwt[order]
    change = np.flatnonzero(first[1:] != first[:-1])
    before, after = np.empty(n, np.int32), np.empty(n, np.int32)  # of each row the rows next to it with the same byte in front
    before[order[1:]], after[order[:-1]] = order[:-1], order[1:]
    before[order[0]] = before[order[change + 1]] = -1
    after[order[-1]] = after[order[change]] = n
    lcp = np.full(n + 1, 255, np.uint8)
    lcp[0] = lcp[n] = 0
    lo, hi = np.array([0], np.int32), np.array([n], np.int32)
    for depth in range(length):
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size)  # all rows of the intervals
        at += np.arange(len(at))
        starts = back.take(at.compress(before.take(at) < np.repeat(lo, size)))
        ends = back.take(at.compress(after.take(at) >= np.repeat(hi, size)))
        starts.sort()
        ends.sort()
        ends += 1
        new = lcp.take(ends) == 255
        lo, hi = starts.compress(new), ends.compress(new)
        lcp[hi] = depth
        if not len(lo):
            break
    return lcp[:n]


def smallest_ids(length: int):
    """A solver: the smallest id, over all strings, of each window of each string, and the number of windows of each.

    Strings come by keys, and equal windows have equal keys. A string that is alone with its key shares no window with
    another, so it isn't sorted: its windows' smallest id is its own.
    """

    def sorted_ids(strings: list[bytes], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        t = np.frombuffer(b"\xff".join(strings) + b"\xff\xfe", np.uint8)  # never part of UTF-8; the last one is unique
        sa = suffix_order(t, length)
        lcp = boundaries(t, sa, length)
        owner = np.append(np.repeat(ids, size + 1), NULL_ID)
        end = np.cumsum(size + 1)
        window = np.repeat(end, size + 1) - np.arange(len(t) - 1) > length
        owner[:-1][~window] = NULL_ID
        cut = np.flatnonzero(lcp != 255)
        least = np.empty(len(t), np.int64)
        low = np.minimum.reduceat(owner[sa], cut)
        least[sa] = np.repeat(low, np.diff(np.append(cut, len(t))))
        return least[:-1][window]

    def solve(strings: list[bytes], ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        n = size - length + 1
        same = keys[1:] == keys[:-1]
        met = np.append(same, False) | np.append(False, same)
        value = np.repeat(ids, n)
        if met.any():
            value[np.repeat(met, n)] = sorted_ids(list(compress(strings, met.tolist())), ids[met], size[met])
        return value, n

    return solve


def dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def finish(doc_id, text, data, gone):
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data
        return doc_id, len(data), int(gone.sum()), len(spans(gone)), sha256(kept)

    return remove_repeats(docs, Bytes(length), cut_by_minimiser, smallest_ids(length), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", id_col, text_col)


def trim(text: bytes, gone: np.ndarray) -> str:
    """The text without the characters whose bytes are all marked."""
    if not gone.any():
        return text.decode()
    t = np.frombuffer(text, np.uint8)
    char = np.flatnonzero((t & 0xC0) != 0x80)
    whole = np.logical_and.reduceat(gone, char)
    return t[~np.repeat(whole, np.diff(np.append(char, len(t))))].tobytes().decode()


def trimmed(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with repeated stretches gone from the text (characters left whole), and n_chars to match if there is one."""

    def finish(doc_id, text, data, gone):
        return doc_id, trim(data, gone)

    carry = [c for c in docs.columns if c != text_col]
    out = remove_repeats(docs, Bytes(length), cut_by_minimiser, smallest_ids(length), finish, "doc_id long, kept string", id_col, text_col, carry)
    now = {text_col: F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return out.select(*[now.get(c, F.col("more").getField(c)).alias(c) for c in docs.columns])
