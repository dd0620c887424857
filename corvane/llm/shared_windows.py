"""Windows of a fixed length that start in a document with a smaller id: the distributed frame of both substring operators.

A unit is a byte or a word, and a window is ``length`` consecutive units of one document. Documents are put into
chunks of bounded size. (1) Chunks ask which of their windows' minimisers, the smallest hashes among shorter grams,
other documents have, too: a window that repeats is always among those kept. (2) Chunks deal out what they kept, each
distinct string once, in packed blobs; how it is dealt is the operator's. (3) Strings that may hold equal windows meet
in one task, where a ``solver`` (a suffix array's or a suffix tree's) finds for each window the smallest document id
that has it. (4) Chunks mark, from the answers, the windows of smaller documents.
A string of a third of all documents is one row per chunk, not per document, and no task gathers a row of every chunk:
where there are more than FAN chunks, groups of chunks first reduce equal strings to one with the smallest id, level by
level, and answers go back the same way. Numbers of partitions follow from the bytes of text.
Nothing is dropped or capped, and grouping by hashes decides only where strings are compared, not whether they are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, drop_tables, settings, settle, settle_kinds

#: Bytes of text in a chunk; window starts per piece of work; windows of a run.
CHUNK, PIECE, RUN = 1 << 22, 1 << 19, 64
#: Bytes of text for each place that compares; bytes of text of a task, and the number of tasks beyond which they grow.
PART, TASK, TASKS = 1 << 22, 1 << 23, 200_000
#: Rows that one place compares at once; equal strings of more chunks are reduced before.
FAN = 1024
#: A minimiser asked for by more chunks than this is split.
HOT = 64
NULL_ID = np.iinfo(np.int64).max
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
Solver = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C3
    return h ^ (h >> np.uint64(29))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[: max(0, len(h) - (w - span))], h[w - span :]) if w > span else h


def planes(x: np.ndarray) -> bytes:
    """All first bytes of numbers, all second ones, and so on: compresses better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def from_planes(b: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8, n * size).reshape(size, n).T).view(kind).reshape(n)


@dataclass
class Bytes:
    """Units are the bytes of a text."""

    length: int = 50
    grams: tuple[int, int] = (16, 40)
    block: int = 1 << 19  # bytes that the solver takes at once
    chunks: int = 2  # of CHUNK bytes in a chunk
    places: int = 2  # of PART bytes for a place

    def stream(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Concatenated units, the number of units of each text, and unit codes."""
        data = b"".join(texts)
        return data, np.fromiter(map(len, texts), np.int64, len(texts)), np.frombuffer(data, np.uint8)

    def gram_hashes(self, codes: np.ndarray, k: int) -> np.ndarray:
        buf = codes.tobytes()
        n = len(buf) - 7
        if n <= 0:
            return np.empty(0, np.uint64)
        eight = np.empty(n, np.uint64)
        for r in range(min(8, n)):
            eight[r::8] = np.frombuffer(buf, "<u8", (len(buf) - r) // 8, r)
        m = max(0, len(buf) - k + 1)
        h = np.zeros(m, np.uint64)
        for j in range(0, k, 8):
            h = (h ^ eight[j : j + m]) * _C1
            h ^= h >> np.uint64(31)
        return mixed(h)

    def cut(self, data, a: int, b: int) -> bytes:
        return data[a:b]

    def encode(self, strings: list[bytes], names: list[bytes]) -> bytes:
        return planes(np.fromiter(map(len, strings), np.uint32, len(strings))) + b"".join(strings)

    def decode(self, n: int, body: bytes, number: dict[bytes, int]) -> list[bytes]:
        ends = np.cumsum(from_planes(body, np.uint32, n), dtype=np.int64) + 4 * n
        return [body[a:b] for a, b in zip([4 * n, *ends[:-1].tolist()], ends.tolist(), strict=True)]


@dataclass
class Words:
    """Units are words without ASCII white space."""

    length: int = 13
    grams: tuple[int, int] = (8, 10)
    block: int = 1 << 22
    chunks: int = 2
    places: int = 4

    def stream(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        import zlib

        words = [t.split() for t in texts]
        flat = [w for ws in words for w in ws]
        return flat, np.fromiter(map(len, words), np.int64, len(words)), np.fromiter(map(zlib.crc32, flat), np.uint64, len(flat))

    def gram_hashes(self, codes: np.ndarray, k: int) -> np.ndarray:
        m = max(0, len(codes) - k + 1)
        h = np.zeros(m, np.uint64)
        for j in range(k):
            h = (h ^ codes[j : j + m]) * _C1
            h ^= h >> np.uint64(31)
        return mixed(h)

    def encode(self, strings: list[bytes], names: list[bytes]) -> bytes:
        """Strings are rows of numbers of words (of ``names``); written as the words in use and their ranks, frequent words
        first, then those used once, in order: of these the rank says only that the next one comes."""
        codes = np.frombuffer(b"".join(strings), np.int32)
        n = np.bincount(codes, minlength=len(names))
        often = np.flatnonzero(n > 1)
        often = often[np.argsort(-n[often], kind="stable")]
        rank = np.full(len(names), len(often), np.uint32)
        rank[often] = np.arange(len(often))
        words = b" ".join([names[i] for i in (*often.tolist(), *codes[n[codes] == 1].tolist())])
        return np.uint32(len(words)).tobytes() + np.uint32(len(often)).tobytes() + words + planes(rank[codes])

    def decode(self, n: int, body: bytes, number: dict[bytes, int]) -> list[bytes]:
        size, often = np.frombuffer(body, np.uint32, 2).tolist()
        known = np.fromiter((number.setdefault(w, len(number)) for w in body[8 : 8 + size].split(b" ")), np.int32)
        rank = from_planes(body[8 + size :], np.uint32, n * self.length).astype(np.int64)
        rank[rank == often] = np.arange(often, len(known))
        rows, size = known[rank].tobytes(), 4 * self.length
        return [rows[k : k + size] for k in range(0, len(rows), size)]


def window_keys(units, codes: np.ndarray, sizes: np.ndarray, level: int, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers of the window starts a to z of a stream, and which of them are windows of one text."""
    n = units.length
    k = units.grams[level]
    low = sliding_min(units.gram_hashes(codes[a : z + n - 1], k), n - k + 1)
    ok = np.zeros(z - a, bool)
    ends = np.cumsum(sizes)
    for s, e in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if e - n >= a and s < z:
            ok[max(s, a) - a : max(0, min(e - n + 1, z) - a)] = True
    key = np.zeros(z - a, np.uint64)
    key[: len(low)] = low[: z - a]
    return mixed(key * _C2), ok


def runs(key: np.ndarray, ok: np.ndarray, a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, number of windows and key of runs of windows with one key."""
    new = ok.copy()
    new[1:] &= (key[1:] != key[:-1]) | ~ok[:-1]
    start = np.flatnonzero(new)
    if not len(start):
        return start, start, key[:0]
    at = np.flatnonzero(ok)
    first = start[np.cumsum(new[at]) - 1]
    start = at[(at - first) % RUN == 0]
    nxt = np.append(start[1:], len(key))
    stop = np.flatnonzero(~np.append(ok, False))
    n = np.minimum(nxt, stop[np.searchsorted(stop, start)]) - start
    return start + a, n, key[start]


def all_runs(units, codes: np.ndarray, sizes: np.ndarray):
    for a in range(0, int(sizes.sum()), PIECE):
        z = min(a + PIECE, int(sizes.sum()))
        key, ok = window_keys(units, codes, sizes, 0, a, z)
        yield a, z, key, ok, *runs(key, ok, a)


def owner(sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which text of a stream each unit belongs to."""
    return np.searchsorted(np.cumsum(sizes), at, "right")


def place(key: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which task compares a key, and the 32 bits that are compared there."""
    return ((key & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64), (key >> np.uint64(32)).astype(np.uint32)


def _zip(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b)


def _unzip(b) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bytes(b))


def _split(order: np.ndarray, p: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cut = np.flatnonzero(np.diff(p[order])) + 1
    for part in np.split(order, cut) if len(order) else []:
        yield int(p[part[0]]), part


_CHUNK = "kind string, chunk long, p long, blob binary, ids binary, lens binary, texts binary, more binary"
_CUT = "chunk long, p long, blob binary"
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of a table of several kinds; fields that a row leaves out are null."""
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    full = [r + (None,) * (len(names) - len(r)) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*full, strict=True), kinds, strict=True)], list(names))


def chunked(docs: DataFrame, units, parts: int) -> DataFrame:
    """Chunks of documents (kind text: ids, lens, texts, more) and what each asks of each task (kind ask: p, blob)."""

    def ask(number: int, texts: list[bytes]) -> list[tuple]:
        _, sizes, codes = units.stream(texts)
        found = [(k, owner(sizes, s)) for *_, s, _, k in all_runs(units, codes, sizes)]
        key = np.concatenate([k for k, _ in found]) if found else np.empty(0, np.uint64)
        doc = np.concatenate([d for _, d in found]) if found else np.empty(0, np.int64)
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        last = np.append(first[1:], len(key)) - 1
        many = doc[first] != doc[last] if len(key) else np.empty(0, bool)
        p, h = place(key[first], parts)
        return [("ask", number, q, h[part].tobytes() + np.packbits(many[part]).tobytes()) for q, part in _split(np.lexsort((h, p)), p)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, more, size = [], [], [], 0
        number = TaskContext.get().partitionId() << 32

        def flush() -> pa.RecordBatch:
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            none = np.array([i is None for i in ids])
            known = np.array([NULL_ID if i is None else i for i in ids], np.int64)
            text = ("text", number, None, None, known.tobytes(), np.where(none, ~lens, lens).tobytes(), _zip(b"".join(texts)), _zip("\n".join(more).encode()))
            return _batch(_CHUNK, [text, *ask(number, texts)])

        for b in batches:
            for i, t, m in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                text = t.as_buffer().to_pybytes() if t.is_valid else b""
                ids.append(i)
                texts.append(text)
                more.append(m)
                size += len(text)
                if size >= CHUNK * units.chunks or len(ids) >= 50_000:
                    yield flush()
                    ids, texts, more, size = [], [], [], 0
                    number += 1
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), "text", "more").mapInArrow(run, _CHUNK)


def by_place(asks: DataFrame, tasks: int, answer: Callable[[list[int], list[bytes]], list[bytes | None]]) -> DataFrame:
    """chunk, p, blob: the answers to rows (p, chunk, blob), all questions of one p at once; rows with p below 0 as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunks, blobs = None, [], []

        def reply() -> pa.RecordBatch:
            got = list(zip(chunks, blobs, strict=True)) if now < 0 else [(c, a) for c, a in zip(chunks, answer(chunks, blobs), strict=True) if a]
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], pa.int64()), pa.array([now] * len(got), pa.int64()), pa.array([a for _, a in got], pa.binary())], ["chunk", "p", "blob"])

        for b in batches:
            for p, c, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if p != now and chunks:
                    yield reply()
                    chunks, blobs = [], []
                now = p
                chunks.append(c)
                blobs.append(blob.as_py())
        if chunks:
            yield reply()

    return asks.select("p", "chunk", "blob").repartition(tasks, "p").sortWithinPartitions("p").mapInArrow(run, "chunk long, p long, blob binary")


def shared_keys(chunks: list[int], blobs: list[bytes]) -> list[bytes | None]:
    """For each chunk which of its minimisers another document has (bit 0) and how often (bit 1: too often for one task)."""
    n = [len(b) * 8 // 33 for b in blobs]  # 32 bits and a flag each
    h = np.concatenate([np.frombuffer(b, np.uint32, m) for m, b in zip(n, blobs, strict=True)])
    many = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8, offset=4 * m), count=m) for m, b in zip(n, blobs, strict=True)]).astype(bool)
    _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    twice = (count > 1) | (np.bincount(inverse, weights=many) > 0)
    hot = count > HOT
    out, at = [], 0
    for m in n:
        which = inverse[at : at + m]
        part, at = h[at : at + m], at + m
        yes = twice[which]
        out.append(part[yes].tobytes() + np.packbits(hot[which[yes]]).tobytes() if yes.any() else None)
    return out


def read_keys(p: int, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) * 8 // 33
    return (np.uint64(p) << np.uint64(32)) | np.frombuffer(blob, np.uint32, n), np.unpackbits(np.frombuffer(blob, np.uint8, offset=4 * n), count=n).astype(bool)


def texts_of(row: dict) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids, texts, and which ids are null (they count as the largest)."""
    data, lens = _unzip(row["texts"]), np.frombuffer(row["lens"], np.int64)
    none = lens < 0
    lens = np.where(none, ~lens, lens)
    ends = np.cumsum(lens)
    return np.frombuffer(row["ids"], np.int64), [data[a:b] for a, b in zip((ends - lens).tolist(), ends.tolist(), strict=True)], none


def known_keys(known: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted minimisers that others have, too, and which of them many chunks have."""
    got = [read_keys(x["p"], x["blob"]) for x in known]
    code, hot = np.concatenate([c for c, _ in got]), np.concatenate([x for _, x in got])
    order = np.argsort(code)
    return code[order], hot[order]


def found_in(code: np.ndarray, key: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among the sorted ones, and where."""
    p, h = place(key, parts)
    c = (p.astype(np.uint64) << np.uint64(32)) | h
    i = np.minimum(np.searchsorted(code, c), len(code) - 1)
    return code[i] == c, i


def cut_strings(chunks: DataFrame, known: DataFrame, units, parts: int) -> DataFrame:
    """For each chunk the distinct strings that its shared runs cover (a row for each place p) and, with p below 0, where
    these runs are."""

    def strings(number: int, ids: np.ndarray, texts: list[bytes], known: list[dict]) -> list[tuple]:
        code, hot = known_keys(known)
        data, sizes, codes = units.stream(texts)
        found = []
        for a, z, key, ok, start, n, k in all_runs(units, codes, sizes):
            yes, i = found_in(code, k, parts)
            often = yes & hot[i]
            if often.any():  # these runs are cut again where a second minimiser changes
                here = np.zeros(z - a, bool)
                for s, m in zip((start[often] - a).tolist(), n[often].tolist(), strict=True):
                    here[s : s + m] = True
                second, _ = window_keys(units, codes, sizes, 1, a, z)
                found.append(runs(mixed(key * _C1 ^ second), here & ok, a))
            yes &= ~often
            found.append((start[yes], n[yes], k[yes]))
        start, n, key = (np.concatenate(x) for x in zip(*found, strict=True))
        p, h = place(key, parts)
        order = np.lexsort((start, h, p))
        start, n, p, h = start[order], n[order], p[order], h[order]
        seen: dict[bytes, int] = {}
        stop = start + n + (units.length - 1)
        every = [units.cut(data, x, y) for x, y in zip(start.tolist(), stop.tolist(), strict=True)]
        use = np.fromiter((seen.setdefault(x, len(seen)) for x in every), np.int64, len(every))
        out = list(seen)
        del every, seen
        doc = ids[owner(sizes, start)] if len(start) else np.empty(0, np.int64)
        least = np.full(len(out), NULL_ID, np.int64)
        np.minimum.at(least, use, doc)
        _, first = np.unique(use, return_index=True)  # equal strings have equal keys
        up, uh, rows = p[first], h[first], []
        for q, part in _split(np.arange(len(out)), up):
            rows.append((number, q, write_strings(units, out[part[0] : part[-1] + 1], uh[part], least[part])))
        uses = np.uint32(len(start)).tobytes() + start.astype(np.uint32).tobytes() + use.astype(np.uint32).tobytes() + n.astype(np.uint8).tobytes()
        return [(number, -1 - number, _zip(uses)), *rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                ids, texts, _ = texts_of(row)
                yield _batch(_CUT, strings(row["chunk"], ids, texts, row["known"]))

    return chunks.select("chunk", "ids", "lens", "texts").join(known, "chunk").mapInArrow(run, _CUT)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of stretches that begin at start, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def write_strings(units, strings: list[bytes], h: np.ndarray, least: np.ndarray, names: list[bytes] = ()) -> bytes:
    """Strings of one place, by rising h, with the smallest id of each."""
    return _zip(np.uint32(len(strings)).tobytes() + planes(np.diff(h, prepend=np.uint32(0))) + planes(least) + units.encode(strings, names))


def together(units, blobs: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, list[np.ndarray], list[bytes]]:
    """The distinct strings of blobs by rising h, their h and smallest ids, for each blob where its strings are, and names."""
    index: dict[bytes, int] = {}
    number: dict[bytes, int] = {}
    asked, hs, ds = [], [], []
    for blob in blobs:
        data = _unzip(blob)
        n = int(np.frombuffer(data, np.uint32, 1)[0])
        hs.append(np.cumsum(from_planes(data[4:], np.uint32, n), dtype=np.uint32))
        ds.append(from_planes(data[4 + 4 * n :], np.int64, n))
        asked.append(np.fromiter((index.setdefault(x, len(index)) for x in units.decode(n, data[4 + 12 * n :], number)), np.int64, n))
    every = list(index)
    index.clear()
    use = np.concatenate(asked)
    least = np.full(len(every), NULL_ID, np.int64)
    np.minimum.at(least, use, np.concatenate(ds))
    _, first = np.unique(use, return_index=True)
    h = np.concatenate(hs)[first]
    order = np.argsort(h, kind="stable")
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    return [every[i] for i in order.tolist()], h[order], least[order], [where[a] for a in asked], list(number)


def write_answer(n_runs: np.ndarray, runs_: np.ndarray, value: np.ndarray, mine: np.ndarray) -> bytes:
    """Of the strings ``mine`` the stretches of windows with one smallest id: how many, how long, and the ids."""
    first = np.cumsum(n_runs) - n_runs
    j = ragged(first[mine], n_runs[mine])
    return _zip(np.uint32(len(mine)).tobytes() + n_runs[mine].astype(np.uint8).tobytes() + runs_[j].astype(np.uint8).tobytes() + value[j].tobytes())


def read_answer(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = _unzip(blob)
    m = int(np.frombuffer(data, np.uint32, 1)[0])
    n_runs = np.frombuffer(data, np.uint8, m, 4)
    r = int(n_runs.sum(dtype=np.int64))
    return n_runs.astype(np.int64), np.frombuffer(data, np.uint8, r, 4 + m).astype(np.int64), np.frombuffer(data, np.int64, r, 4 + m + r)


def compare(solver: Solver, units) -> Callable[[list[int], list[bytes]], list[bytes | None]]:
    """Answers: for each string of each chunk the smallest id of each of its windows, as lengths of equal stretches and ids."""

    def answer(chunks: list[int], blobs: list[bytes]) -> list[bytes | None]:
        strings, h, least, asked, _ = together(units, blobs)
        size = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))
        new = np.flatnonzero(np.diff(h)) + 1  # whole keys in blocks of bounded size
        cuts, last = [0], 0
        for k, done in zip(new.tolist(), size[new - 1].tolist(), strict=True):
            if done - last >= units.block:
                cuts.append(k)
                last = done
        solved = [solver(strings[a:z], least[a:z], h[a:z]) for a, z in zip(cuts, [*cuts[1:], len(strings)], strict=True)]
        value, n = (np.concatenate(x) for x in zip(*solved, strict=True))  # of all windows of all strings, in order
        begin = np.cumsum(n) - n
        change = np.concatenate([[True], value[1:] != value[:-1]])
        change[begin] = True
        at = np.flatnonzero(change)
        n_runs = np.diff(np.append(np.searchsorted(at, begin), len(at)))
        runs_ = np.diff(np.append(at, len(value)))
        return [write_answer(n_runs, runs_, value[at], mine) for mine in asked]

    return answer


def solved(asks: DataFrame, nodes: int, tasks: int, answer, units) -> tuple[DataFrame, DataFrame, list[str]]:
    """chunk, p, blob: the answers to all questions (chunk, p, blob) of ``nodes`` chunks; no place gets more than about FAN of them.
    Then a table with the rows with p below 0, which go along unanswered, and folders to delete after use.

    With more, groups of about FAN chunks put their strings of a place together first, so that an equal string counts
    once a group, and ask as one; each level is a table, and its answers are dealt back to the chunks of the group.
    """
    if nodes <= FAN:
        out = settle(by_place(asks, tasks, answer), "windows-solved", packed=True)
        return out.where("p >= 0"), out.where("p < 0").select("chunk", "blob"), folder_of(out)
    groups = -(-nodes // FAN)
    grouped = asks.select("p", F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("parent"), "chunk", "blob")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (p, parent), chunks, blobs in _keyed(batches):
            if p < 0:
                yield _batch(_MERGED, [("along", p, parent, c, blob) for c, blob in zip(chunks, blobs, strict=True)])
                continue
            strings, h, least, asked, names = together(units, blobs)
            yield _batch(_MERGED, [("up", p, parent, None, write_strings(units, strings, h, least, names)), *[("map", p, parent, c, _zip(a.astype(np.uint32).tobytes())) for c, a in zip(chunks, asked, strict=True)]])

    spark = asks.sparkSession
    merged, path = settle_kinds(grouped.repartition(tasks, "p", "parent").sortWithinPartitions("p", "parent").mapInArrow(merge, _MERGED), "windows-merged")
    up, _, ups = solved(merged.where("kind = 'up'").select(F.col("parent").alias("chunk"), "p", "blob"), groups, tasks, answer, units)
    drop_path(spark, f"{path}/kind=up")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, said = None, None
        for b in batches:
            out = []
            for p, parent, chunk, blob in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3), strict=True):
                if chunk is None:  # the answer to the group comes before its chunks
                    now, said = (p, parent), read_answer(blob.as_py())
                elif now == (p, parent):
                    out.append((chunk, p, write_answer(*said, np.frombuffer(_unzip(blob.as_py()), np.uint32).astype(np.int64))))
            if out:
                yield _batch("chunk long, p long, blob binary", out)

    both = up.select("p", F.col("chunk").alias("parent"), F.lit(None).cast("long").alias("chunk"), "blob").unionByName(merged.where("kind = 'map'").select("p", "parent", "chunk", "blob"))
    out = both.repartition(tasks, "p", "parent").sortWithinPartitions("p", "parent", F.col("chunk").asc_nulls_first()).mapInArrow(deal, "chunk long, p long, blob binary")
    out = settle(out, "windows-solved", packed=True)
    for p in (*ups, f"{path}/kind=map"):
        drop_path(spark, p)
    return out, merged.where("kind = 'along'").select("chunk", "blob"), [*folder_of(out), path]


def folder_of(df: DataFrame) -> list[str]:
    """The folder of a settled table (none if it has no files)."""
    return [f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]]


_MERGED = "kind string, p long, parent long, chunk long, blob binary"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[int], list[bytes]]]:
    """Rows (a, b, chunk, blob) sorted by a and b, as one group at a time."""
    now, chunks, blobs = None, [], []
    for batch in batches:
        for a, b, c, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
            if (a, b) != now and chunks:
                yield now, chunks, blobs
                chunks, blobs = [], []
            now = (a, b)
            chunks.append(c)
            blobs.append(blob.as_py())
    if chunks:
        yield now, chunks, blobs


def read_uses(uses: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, string and number of windows of each use of a string in a chunk."""
    if not uses:
        return (np.empty(0, np.int64),) * 3
    raw = _unzip(uses)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    return np.frombuffer(raw, np.uint32, n, 4).astype(np.int64), np.frombuffer(raw, np.uint32, n, 4 + 4 * n).astype(np.int64), np.frombuffer(raw, np.uint8, n, 4 + 8 * n).astype(np.int64)


def marked(ids: np.ndarray, sizes: np.ndarray, uses: tuple[np.ndarray, np.ndarray, np.ndarray], answers: list[dict] | None, length: int) -> np.ndarray:
    """Which units of a chunk's stream lie in a window that starts in a document with a smaller id."""
    total = int(sizes.sum())
    start, use, wins = uses
    if not len(start) or not answers:
        return np.zeros(total, bool)
    pieces, count, least = (np.concatenate(x) for x in zip(*(read_answer(x["blob"]) for x in sorted(answers, key=lambda x: x["p"])), strict=True))
    value = np.repeat(least, count)  # of every window of every distinct string
    ends = np.cumsum(np.add.reduceat(count, np.cumsum(pieces) - pieces))
    begin = np.concatenate([[0], ends[:-1]])
    low = value[ragged(begin[use], wins)]
    at = ragged(start, wins)[low < np.repeat(ids[owner(sizes, start)], wins)]
    edge = np.bincount(at, minlength=total + 1) - np.bincount(at + length, minlength=total + 1)
    return np.cumsum(edge[:-1], dtype=np.int32) > 0


#: Carried columns travel as JSON; times keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


class Dealt:
    """What an operator deals out: chunks (chunk, ids, lens, texts, more and the columns that ``uses`` reads) and questions.
    Questions with p below 0 are what a chunk's ``uses`` is told again."""

    def __init__(self, chunks: DataFrame, asks: DataFrame, uses: Callable[[dict, np.ndarray, np.ndarray], tuple], paths: list[str]):
        self.chunks, self.asks, self.uses, self.paths = chunks, asks, uses, paths


def cut_by_minimiser(chunks: DataFrame, known: DataFrame, units, parts: int, tasks: int, source: str) -> Dealt:
    """Runs of windows with a shared minimiser, with the units that they cover; each goes where its minimiser is compared."""
    return Dealt(chunks, cut_strings(chunks, known, units, parts), lambda row, codes, sizes: read_uses(row["uses"]), [])


def remove_repeats(docs: DataFrame, units, deal, solver: Solver, finish, columns: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``columns`` of every row, made by finish(id, text, units of the text, which of them are marked).

    deal: how strings go to places (cut_by_minimiser or an operator's own; it may drop the folder of the chunks that it copies). carry: further columns of docs, which come
    back in a struct named more. The result is a settled table; all tables before it are deleted.
    """
    spark = docs.sparkSession
    more = F.to_json(F.struct(*carry), _JSON) if carry else F.lit("")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), more.alias("more"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(8, -(-total // (PART * units.places)))
    tasks = min(TASKS, max(8, -(-total // TASK)))
    columns += ", more string" if carry else ""
    names = [c.split()[0] for c in columns.split(", ")]
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": "8m"}):  # rows are megabytes here
        first, first_path = settle_kinds(chunked(base, units, parts), "windows-chunks")
        known = settle(by_place(first.where("kind = 'ask'"), tasks, shared_keys), "windows-known", packed=True)
        drop_path(spark, f"{first_path}/kind=ask")
        chunks = first.where("kind = 'text'").select("chunk", "ids", "lens", "texts", "more")
        nodes = chunks.count()
        chunks = chunks.repartition(tasks, "chunk")
        listed = known.repartition(tasks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("p", "blob")).alias("known"))  # no more than the chunk asked
        dealt = deal(chunks, listed, units, parts, tasks, first_path)
        told = dealt.chunks
        again = "uses" not in told.columns  # else nothing reads known any more
        if not again:
            drop_tables(spark, known)
        answers, along, paths = solved(dealt.asks, nodes, tasks, compare(solver, units), units)
        if again:
            drop_tables(spark, known)
            told = told.join(along.withColumnRenamed("blob", "uses").repartition(tasks, "chunk"), "chunk", "left")
        said = answers.repartition(tasks, "chunk").groupBy("chunk").agg(F.collect_list(F.struct("p", "blob")).alias("said"))
        uses = dealt.uses

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    row = b.slice(i, 1).to_pylist()[0]
                    ids, texts, none = texts_of(row)
                    data, sizes, codes = units.stream(texts)
                    gone = marked(ids, sizes, uses(row, codes, sizes), row["said"], units.length)
                    ends = np.cumsum(sizes)
                    out = [finish(None if x else d, t, data[a:z], gone[a:z]) for d, x, t, a, z in zip(ids.tolist(), none.tolist(), texts, (ends - sizes).tolist(), ends.tolist(), strict=True)]
                    if carry:
                        out = [(*o, m) for o, m in zip(out, _unzip(row["more"]).decode().split("\n"), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) if "string" in t else pa.array(c, pa.int64()) for c, t in zip(zip(*out, strict=True), columns.split(", "), strict=True)], names)

        out = settle(told.join(said, "chunk", "left").mapInArrow(run, columns), "windows-out")
        for path in (first_path, *dealt.paths, *paths):
            drop_path(spark, path)
    return out.withColumn("more", F.from_json("more", docs.select(*carry).schema, _JSON)) if carry else out


def sha256(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def spans(gone: np.ndarray) -> np.ndarray:
    """start, end of the maximal stretches of marked units, a row each."""
    return np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
