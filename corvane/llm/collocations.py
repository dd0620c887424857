"""Phrase collocation mining by vertical positional inverted lists.

Texts are dealt, language by language, into segments of bounded size. In a segment every word has the list of its
positions; positions skip one between pieces, so neighbours in different pieces are never adjacent. Level by level,
frequent phrases alone are extended: the positions of a phrase are merge-joined with those of the phrase that begins one
word later, which share all but its last word. The length of a list is the phrase's exact count in the segment, and the
sum over segments, one row each, its frequency; what is frequent is told back to the segments that hold it. Lists never
leave their segments, and nothing is broadcast.

A phrase is known by the place of its first list, (segment, number within it), as one 63-bit number: exact, without
hashes and without a global numbering.

Defined cases: null texts are empty, a null language is `und`; rows are texts whether or not they are repeated; empty
tables give no phrases; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_tables, settings, settle
from .positional_index import Numbers

#: ASCII capitals in small letters, tabs as spaces, and what ends a piece as line feeds.
PIECES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256))
#: Bytes of text of a segment, and of all segments that a task has begun.
SEGMENT, BEGUN = 8 << 20, 24 << 20
#: A phrase's number: task, segment of the task, list of the segment.
OF_TASK, OF_LIST = 12, 24
#: Segments travel in batches of few rows.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}

WORDS = "seg long, lang string, total long, words binary, counts binary, positions binary"
FREQUENT_PAIRS = ["id", "f", "a", "b", "seg", "places", "ids"]
PAIRS = "seg long, ids binary, first binary, second binary, counts binary, positions binary"


def postings(seg: int, lang: str, texts: list[bytes]) -> dict:
    """The positional lists of a segment, words in order of appearance."""
    numbers, found, length = Numbers(), [], []
    for text in texts:
        for piece in text.translate(PIECES).split(b"\n"):
            ws = piece.split()
            if ws:
                found += ws
                length.append(len(ws))
    word = np.fromiter(map(numbers.__getitem__, found), np.int32, len(found))
    n = np.asarray(length, np.int64)
    at = (np.arange(len(word)) + np.repeat(np.arange(len(n)), n)).astype("<i4")
    return {"seg": seg, "lang": lang, "total": len(word), "words": b" ".join(numbers), "counts": np.bincount(word, minlength=len(numbers)).astype("<i4").tobytes(), "positions": at[np.argsort(word, kind="stable")].tobytes()}


def segments(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Level 1: the lists of all words, settled."""
    schema = pa.schema([("seg", pa.int64()), ("lang", pa.string()), ("total", pa.int64()), *[(c, pa.binary()) for c in ("words", "counts", "positions")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, {}, {}

        def full(lang: str) -> pa.RecordBatch:
            nonlocal made
            made += 1
            if made > 1 << OF_TASK or task >= 1 << (63 - OF_TASK - OF_LIST):
                raise ValueError("too many segments in a task, or tasks")
            del size[lang]
            return pa.RecordBatch.from_pylist([postings(task << OF_TASK | (made - 1), lang, held.pop(lang))], schema)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = (text.as_py() or "").encode("utf-8", "replace")
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 64
                if size[lang] >= SEGMENT:
                    yield full(lang)
                while sum(size.values()) > BEGUN:
                    yield full(max(size, key=size.get))
        for lang in list(held):
            yield full(lang)

    return settle(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.col(text_col)).mapInArrow(run, WORDS), "words")


def word_rows(level1: DataFrame) -> DataFrame:
    """lang, word, code, n of every list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for seg, lang, words, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                names, n = words.split(b" ") if words else [], np.frombuffer(counts, "<i4").astype(np.int64)
                code = (seg << OF_LIST) + np.arange(len(n))
                yield pa.RecordBatch.from_arrays([pa.DictionaryArray.from_arrays(np.zeros(len(n), np.int32), pa.array([lang])).cast(pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(code), pa.array(n)], ["lang", "word", "code", "n"])

    return level1.select("seg", "lang", "words", "counts").mapInArrow(run, "lang string, word string, code long, n long")


def frequent_words(level1: DataFrame, least: int) -> DataFrame:
    """code, id, f, lang, word: the lists of words that are frequent in their language, settled."""
    w = Window.partitionBy("lang", "word")
    rows = word_rows(level1).withColumns({"f": F.sum("n").over(w), "id": F.min("code").over(w)})
    return settle(rows.where(F.col("f") >= least).select("code", "id", "f", "lang", "word"), "frequent-words")


def frequent_pairs(level2: DataFrame, least: int) -> DataFrame:
    """id, f, a, b of every frequent pair of words; and, for each segment that holds some of a batch's pairs, one row of
    seg, places and ids (the others are null), settled. Rows come sorted, and a batch is summed by runs of equal pairs;
    the last run waits for the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((4, 0), np.int64)
        for b in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy() for c in b.columns])], axis=1)
            new = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
            cut = int(new[-1]) if len(new) else 0
            yield from tables(rows[:, :cut])
            rest = rows[:, cut:]
        yield from tables(rest)

    def tables(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b, code, n = rows
        if not len(a):
            return
        begin = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        size = np.diff(np.append(begin, len(a)))
        f, id_ = np.add.reduceat(n, begin), np.minimum.reduceat(code, begin)
        often = f >= least
        none, empty = pa.nulls(int(often.sum()), pa.int64()), pa.nulls(int(often.sum()), pa.binary())
        yield pa.RecordBatch.from_arrays([*[pa.array(x[often]) for x in (id_, f, a[begin], b[begin])], none, empty, empty], FREQUENT_PAIRS)
        keep = np.repeat(often, size)
        code, ids = code[keep], np.repeat(id_, size)[keep]
        order = np.argsort(code, kind="stable")
        code, ids = code[order], ids[order]
        seg, place = code >> OF_LIST, code & ((1 << OF_LIST) - 1)
        at = np.flatnonzero(np.append(True, seg[1:] != seg[:-1])) if len(seg) else np.zeros(0, np.int64)
        cut = lambda x, t: pa.array([part.astype(t).tobytes() for part in np.split(x, at[1:])] if len(at) else [], pa.binary())
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(seg[at]), cut(place, "<i4"), cut(ids, "<i8")], FREQUENT_PAIRS)

    rows = pair_rows(level2).repartition("a", "b").sortWithinPartitions("a", "b")
    return settle(rows.mapInArrow(run, "id long, f long, a long, b long, seg long, places binary, ids binary"), "frequent-pairs")


def pair_rows(level2: DataFrame) -> DataFrame:
    """a, b, code, n of every list of two words; a and b are the words' numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for seg, ids, first, second, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids, n = np.frombuffer(ids, "<i8"), np.frombuffer(counts, "<i4").astype(np.int64)
                code = (seg << OF_LIST) + np.arange(len(n))
                columns = [ids[np.frombuffer(first, "<i4")], ids[np.frombuffer(second, "<i4")], code, n]
                for k in range(0, len(n), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 100_000]) for c in columns], ["a", "b", "code", "n"])

    return level2.select("seg", "ids", "first", "second", "counts").mapInArrow(run, "a long, b long, code long, n long")


def laid_out(positions: bytes, counts: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """The lists that are kept, merged by position: at each position the number of its list among them, else -1."""
    at = np.frombuffer(positions, "<i4")
    over = np.full(int(at.max()) + 2 if len(at) else 1, -1, np.int64)
    number = np.full(len(counts), -1, np.int64)
    number[kept] = np.arange(len(kept))
    over[at] = np.repeat(number, counts)
    return over


def adjacent(over: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of each list with those that stand one position on: first, second, count and positions of every pair."""
    at = np.flatnonzero((over[:-1] >= 0) & (over[1:] >= 0))
    key = over[at] * n + over[at + 1]
    bits = len(over).bit_length()
    if n * n < 1 << (63 - bits):  # pair and position in one number, which sorts faster
        key = np.sort(key << bits | at)
        key, at = key >> bits, key & ((1 << bits) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[begin] // max(1, n), key[begin] % max(1, n), np.diff(np.append(begin, len(key))), at


def told(frequent: DataFrame) -> DataFrame:
    """seg, place, id: what the segments must know of their frequent lists."""
    return frequent.select(F.shiftright("code", OF_LIST).alias("seg"), F.col("code").bitwiseAND((1 << OF_LIST) - 1).alias("place"), "id")


def pairs(level1: DataFrame, frequent: DataFrame) -> DataFrame:
    """Level 2: lists of two frequent words, settled."""

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("seg", pa.int64()), *[(c, pa.binary()) for c in ("ids", "first", "second", "counts", "positions")]])
        rows = []
        if right.num_rows:
            place, ids = right["place"].to_numpy(), right["id"].to_numpy()
            for r in left.to_pylist():
                over = laid_out(r["positions"], np.frombuffer(r["counts"], "<i4"), place)
                first, second, n, at = adjacent(over, len(place))
                rows.append({"seg": r["seg"], "ids": ids.astype("<i8").tobytes(), "first": first.astype("<i4").tobytes(), "second": second.astype("<i4").tobytes(), "counts": n.astype("<i4").tobytes(), "positions": at.astype("<i4").tobytes()})
        return pa.Table.from_pylist(rows, schema)

    lists = level1.select("seg", "counts", "positions")
    return settle(lists.groupBy("seg").cogroup(told(frequent).groupBy("seg")).applyInArrow(extend, PAIRS), "pairs")


def triples(level2: DataFrame, frequent: DataFrame) -> DataFrame:
    """Level 3: left and right (numbers of the two frequent pairs that a phrase of three words is made of) and frequency
    of every phrase."""

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if right.num_rows and left.num_rows:
            place, ids = (np.concatenate([np.frombuffer(x.as_buffer(), t) for x in right[c]]) for c, t in (("places", "<i4"), ("ids", "<i8")))
            r = left.to_pylist()[0]
            first, second, n, _ = adjacent(laid_out(r["positions"], np.frombuffer(r["counts"], "<i4"), place), len(place))
            out = [ids[first], ids[second], n]
        return pa.table({k: pa.array(x.astype(np.int64)) for k, x in zip(("left", "right", "n"), out, strict=True)})

    lists = level2.select("seg", "counts", "positions")
    held = frequent.where("seg IS NOT NULL").select("seg", "places", "ids")
    rows = lists.groupBy("seg").cogroup(held.groupBy("seg")).applyInArrow(extend, "left long, right long, n long")
    return rows.groupBy("left", "right").agg(F.sum("n").alias("f"))


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a^2 / (l r)), exact: products of up to 38 digits."""
    big = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", big(a) * big(a) * F.lit(1_000_000).cast("decimal(7,0)"), big(left) * big(right))


def candidates(docs: DataFrame, least: int = 10) -> tuple[DataFrame, DataFrame]:
    """Phrases of two and three words with their counts and cuts (lang, phrase, a, l, r, score, covered: the count of the
    most frequent longer candidate that holds the phrase), settled; and the word occurrences of each language."""
    spark = docs.sparkSession
    level1 = segments(docs)
    with settings(spark, FEW_ROWS):
        words = frequent_words(level1, least)
    level2 = pairs(level1, words)
    total = settle(level1.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    drop_tables(spark, level1)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "100000"}):
        known = frequent_pairs(level2, least)
    three = settle(triples(level2, known).where(F.col("f") >= least), "triples")
    drop_tables(spark, level2)
    word = words.where("code = id").select("id", "lang", "word", F.col("f").alias("n"))
    first, second = (word.select(F.col("id").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in ("lang", "word", "n")]) for k in ("a", "b"))
    two = known.where("id IS NOT NULL").select("id", "a", "b", "f").join(first, "a").join(second, "b")
    two = two.select("id", F.col("a_lang").alias("lang"), F.col("a_word").alias("w1"), F.col("b_word").alias("w2"), F.col("a_n").alias("n1"), F.col("b_n").alias("n2"), "f")
    two = settle(two, "two-words")
    held = three.select(F.col("left").alias("id"), "f").unionAll(three.select(F.col("right").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("covered"))
    short = two.join(held, "id", "left").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("n1").alias("l"), F.col("n2").alias("r"), score(F.col("f"), F.col("n1"), F.col("n2")).alias("score"), "covered")
    x, y = two.alias("x"), two.alias("y")
    j = three.alias("t").join(x, F.col("t.left") == F.col("x.id")).join(y, F.col("t.right") == F.col("y.id"))
    cut = lambda k, left, right: F.struct(score(F.col("t.f"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
    best = F.least(cut(1, F.col("x.n1"), F.col("y.f")), cut(2, F.col("x.f"), F.col("y.n2")))
    long = j.select("x.lang", F.concat_ws(" ", "x.w1", "x.w2", "y.w2").alias("phrase"), F.col("t.f").alias("a"), best.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.lit(None).cast("long").alias("covered"))
    return settle(short.unionByName(long), "phrases"), total


def collocations(docs: DataFrame, least: int = 10, share: int = 50, most: int = 2000) -> DataFrame:
    """Each language's first phrases by score, count and phrase: lang, rank, phrase, a, l, r, n, score. Phrases of which a
    longer candidate has this share of the occurrences (percent) are dropped."""
    found, total = candidates(docs, least)
    kept = found.where(F.col("covered").isNull() | (F.col("covered") * 100 < F.col("a") * share))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    top = kept.withColumn("rank", rank).where(F.col("rank") <= most)
    return top.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
