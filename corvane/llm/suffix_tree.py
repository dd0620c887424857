"""Substring dedup of word sequences with prefix-partitioned suffix trees.

Suffixes are the starts of windows that can repeat (shared_windows tells which), cut off at the window's length: a
longer repeat is the union of the windows at its successive starts. They are dealt to groups by prefixes of variable
length: all chunks count the prefixes of one, two, ... words, a prefix with no more than LEAVES suffixes is a group, and
one with more is extended by a word, until the whole window is the prefix. Each group is one subtree that fits in
memory, built as its sorted leaves and the common prefix of each with the leaf before, where only leaves that aren't
told apart yet read further words. Its internal nodes that are as deep as the window are the repeats: the smallest id
below such a node is the smallest of all its leaves. Marked at successive starts, they make up the maximal repeats
that are removed, whose number is n_spans.

Counts of prefixes are kept in a table of slots, whose number grows with the text up to SLOTS; prefixes that share a
slot count together, which can only make prefixes longer and groups smaller. A task tells only
counts from LEAVES / 8 tasks on, or from LEAST on where that is more: their number is in proportion to the text, and a
group can have at most an eighth of LEAVES, or LEAST for each task, more than its budget.

Defined cases: null text has no words; texts shorter than a window keep everything; repeated rows and equal ids aren't
smaller than each other; a null id is larger than any other; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, settle_kinds
from .shared_windows import _C1, NULL_ID, Dealt, Words, _batch, _split, _unzip, _zip, all_runs, found_in, known_keys, mixed, owner, ragged, remove_repeats, sha256, spans, texts_of, write_strings

#: Leaves of a subtree, unless they share a whole window; words that undecided leaves read at a time; slots of a depth.
LEAVES, RANGE, SLOTS = 1 << 17, 4, 1 << 20
#: Counts of a task below this aren't told.
LEAST = 16

_SUFFIXES = "kind string, chunk long, n long, ids binary, lens binary, texts binary, more binary, uses binary"


def slot(h: np.ndarray, slots: int) -> np.ndarray:
    return (h % np.uint64(slots)).astype(np.int64)


def prefixes(codes: np.ndarray, starts: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """depth, hash of the first depth + 1 words of each suffix."""
    h = np.zeros(len(starts), np.uint64)
    for d in range(length):
        h = mixed((h ^ codes[starts + d]) * _C1)
        yield d, h


def groups(codes: np.ndarray, starts: np.ndarray, over: np.ndarray) -> np.ndarray:
    """The hash of each suffix's shortest prefix that isn't over the budget (depth x slots), or of its whole window."""
    key = np.zeros(len(starts), np.uint64)
    left = np.arange(len(starts))
    h = np.zeros(len(starts), np.uint64)
    for d in range(len(over)):
        h = mixed((h ^ codes[starts[left] + d]) * _C1)
        stop = ~over[d, slot(h, over.shape[1])] | (d == len(over) - 1)
        key[left[stop]] = h[stop] + np.uint64(d)
        left, h = left[~stop], h[~stop]
        if not len(left):
            break
    return key


def numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word, and the words of the numbers."""
    found = pa.array(words, pa.large_binary()).dictionary_encode()
    return found.indices.to_numpy(), found.dictionary.to_pylist()


def window_rows(numbers: np.ndarray, at: np.ndarray, length: int) -> list[bytes]:
    """The numbers of the words of windows, as bytes."""
    if not len(at):
        return []
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(numbers, length)[at]).tobytes()
    return [rows[k : k + 4 * length] for k in range(0, len(rows), 4 * length)]


def find_suffixes(chunks: DataFrame, known: DataFrame, units: Words, parts: int, slots: int, least: int) -> DataFrame:
    """Chunks (kind text) with the starts of their distinct repeatable windows and all uses of these; each task's counts of prefixes
    from ``least`` on (kind count)."""
    n = units.length

    def uses(texts: list[bytes], known: list[dict] | None) -> tuple[bytes | None, np.ndarray, np.ndarray]:
        data, sizes, codes = units.stream(texts)
        if not known:
            return None, codes, np.empty(0, np.int64)
        code, _ = known_keys(known)
        at = []
        for *_, start, many, k in all_runs(units, codes, sizes):
            yes, _ = found_in(code, k, parts)
            at.append(ragged(start[yes], many[yes]))
        at = np.sort(np.concatenate(at))
        rows = window_rows(numbered(data)[0], at, n)
        seen: dict[bytes, int] = {}
        use = np.fromiter((seen.setdefault(x, len(seen)) for x in rows), np.int64, len(at))
        _, first = np.unique(use, return_index=True)
        packed = np.uint32(len(first)).tobytes() + at[first].astype(np.uint32).tobytes() + np.diff(at, prepend=0).astype(np.uint32).tobytes() + use.astype(np.uint32).tobytes()
        return _zip(packed), codes, at[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((n, slots), np.int64)
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                found, codes, starts = uses(texts_of(row)[1], row["known"])
                for d, h in prefixes(codes, starts, n):
                    counts[d] += np.bincount(slot(h, slots), minlength=slots)
                yield _batch(_SUFFIXES, [("text", row["chunk"], None, row["ids"], row["lens"], row["texts"], row["more"], found)])
        flat = counts.reshape(-1)
        some = np.flatnonzero(flat >= least)
        for k in range(0, len(some), 1 << 16):
            part, none = some[k : k + (1 << 16)], pa.nulls(len(some[k : k + (1 << 16)]), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(["count"] * len(part)), pa.array(part), pa.array(flat[part]), *[none] * 5], ["kind", "chunk", "n", "ids", "lens", "texts", "more", "uses"])

    return chunks.join(known, "chunk", "left").mapInArrow(run, _SUFFIXES)


def read_suffixes(uses: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the distinct windows, starts of all, and which of the distinct each is."""
    raw = _unzip(uses)
    m = int(np.frombuffer(raw, np.uint32, 1)[0])
    rest = np.frombuffer(raw, np.uint32, -1, 4 + 4 * m)
    return np.frombuffer(raw, np.uint32, m, 4).astype(np.int64), np.cumsum(rest[: len(rest) // 2], dtype=np.int64), rest[len(rest) // 2 :].astype(np.int64)


def dealt(codes: np.ndarray, starts: np.ndarray, over: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of suffixes by place and group, and in that order the place and 20 bits of the group."""
    key = mixed(groups(codes, starts, over))
    p, h = ((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), (key & np.uint64(0xFFFFF)).astype(np.uint32)
    order = np.lexsort((h, p))
    return order, p[order], h[order]


def deal_by_prefix(chunks: DataFrame, known: DataFrame, units: Words, parts: int, tasks: int, source: str) -> Dealt:
    """Every suffix that can repeat goes, once a chunk, to the place of its group."""
    slots = 1 << int(np.clip(np.ceil(np.log2(max(1, parts) * units.places * (1 << 22) / (2 * LEAVES))), 10, np.log2(SLOTS)))
    found, path = settle_kinds(find_suffixes(chunks, known, units, parts, slots, min(LEAVES, max(LEAST, LEAVES // (8 * tasks)))), "windows-suffixes")
    drop_path(chunks.sparkSession, source)  # the texts are in the new table, too
    counts = found.where("kind = 'count'").groupBy("chunk").agg(F.sum("n").alias("n")).where(F.col("n") > LEAVES).select("chunk")
    over = np.zeros((units.length, slots), bool)
    over.reshape(-1)[counts.toArrow().column(0).to_numpy()] = True  # at most length * SLOTS numbers
    bits = np.packbits(over)
    flags = lambda: np.unpackbits(bits)[: units.length * slots].reshape(units.length, slots).astype(bool)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = flags()
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if not row["uses"]:
                    continue
                ids, texts, _ = texts_of(row)
                data, sizes, codes = units.stream(texts)
                first, at, use = read_suffixes(row["uses"])
                least = np.full(len(first), NULL_ID, np.int64)
                np.minimum.at(least, use, ids[owner(sizes, at)])
                order, p, h = dealt(codes, first, over, parts)
                least = least[order]
                numbers, names = numbered(data)
                every = window_rows(numbers, first[order], units.length)
                rows = [("ask", row["chunk"], q, write_strings(units, every[part[0] : part[-1] + 1], h[part], least[part], names)) for q, part in _split(np.arange(len(p)), p)]
                for k in range(0, len(rows), 64):
                    yield _batch("kind string, chunk long, p long, blob binary", rows[k : k + 64])

    text = found.where("kind = 'text'").select("chunk", "ids", "lens", "texts", "more", "uses")
    asks = text.select("chunk", "ids", "lens", "texts", "uses").mapInArrow(ask, "kind string, chunk long, p long, blob binary").select("p", "chunk", "blob")
    cache: list[np.ndarray] = []

    def uses(row: dict, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not row["uses"]:
            return (np.empty(0, np.int64),) * 3
        if not cache:
            cache.append(flags())
        first, at, use = read_suffixes(row["uses"])
        order, _, _ = dealt(codes, first, cache[0], parts)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return at, rank[use], np.ones(len(at), np.int64)

    return Dealt(text.repartition(tasks, "chunk"), asks, uses, [path])


def subtrees(codes: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves (rows of codes, a suffix each) of the groups' subtrees in order, and for each the number of words that it
    has in common with the leaf before; a group's first leaf has none."""
    leaves = np.argsort(group, kind="stable")
    common = np.full(len(leaves), length, np.int64)
    first = np.concatenate([[True], group[leaves[1:]] != group[leaves[:-1]]])
    common[first] = 0
    open_, depth = np.arange(len(leaves)), 0  # leaves that share all words so far with a neighbour
    while depth < length and len(open_):
        step = min(RANGE, length - depth)
        before = common[open_] < length  # told apart from the leaf before
        order = np.lexsort((*codes[leaves[open_], depth : depth + step].T[::-1], np.cumsum(before)))
        leaves[open_] = leaves[open_][order]
        words = codes[leaves[open_], depth : depth + step]
        differ = np.cumprod(words[1:] == words[:-1], axis=1).sum(axis=1)
        here = np.concatenate([[step], differ])
        split = (here < step) & ~before
        common[open_[split]] = depth + here[split]
        alone = (common < length) & np.append(common[1:] < length, True)
        open_ = np.flatnonzero(~alone)
        depth += step
    return leaves, common


def deep_nodes(common: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 leaf of the nodes that are ``length`` words deep (a leaf alone is one, too)."""
    first = np.flatnonzero(common < length)
    return first, np.append(first[1:], len(common))


def smallest_ids(length: int):
    """A solver: the smallest id, over all strings, of each window of each string, and the number of windows of each."""

    def solve(strings: list[bytes], ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer(b"".join(strings), np.int32).reshape(-1, length)  # numbers of words
        leaves, common = subtrees(codes, keys, length)
        first, end = deep_nodes(common, length)
        least = np.empty(len(strings), np.int64)
        least[leaves] = np.repeat(np.minimum.reduceat(ids[leaves], first), end - first)
        return least, np.ones(len(strings), np.int64)

    return solve


def dedup(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans of every row."""

    def finish(doc_id, text, words, gone):
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words
        return doc_id, len(words), int(gone.sum()), sha256(b" ".join(kept)), len(spans(gone))

    return remove_repeats(docs, Words(length), deal_by_prefix, smallest_ids(length), finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long", id_col, text_col)


def kept_text(docs: DataFrame, length: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept, n_removed of every row: its words without repeats, joined by spaces."""

    def finish(doc_id, text, words, gone):
        return doc_id, b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode(), int(gone.sum())

    return remove_repeats(docs, Words(length), deal_by_prefix, smallest_ids(length), finish, "doc_id long, kept string, n_removed long", id_col, text_col)
