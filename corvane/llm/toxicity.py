"""A toxicity classifier with counterfactual regularisation.

Features are the presence of words and of word beginnings. The classifier is a logistic regression whose loss also
holds, for each labelled text that mentions a group, the squared change of its score when the mention is swapped for
another group of the same kind; what the group is called can then not move the score much. It is fitted by Newton's
method on the driver, on a bounded sample of labelled rows (``sample``), and applied to whole texts on the executors.

Defined cases: null and empty texts get the score of a text without features; null labels and labels without a document
are ignored; a document that is labelled twice counts as toxic if one label says so; with no labels, or labels of one
class only, every score is that class's smoothed share; repeated rows are scored each; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
#: Rows that the classifier is fitted on, at most; features it keeps, at most.
SAMPLE, FEATURES = 8_000, 512
#: A feature is known from so many rows on; swaps that are summed up at a time.
LEAST, SWAPS = 3, 1024

# Group mentions that may be swapped within their line.
IDENTITY = tuple(
    tuple(x.split())
    for x in (
        "women men girls boys ladies gentlemen frauen männer femmes hommes mujeres hombres",
        "woman man girl boy frau mann femme homme mujer hombre",
        "muslim christian jewish hindu buddhist sikh atheist catholic protestant",
        "muslims christians jews hindus buddhists sikhs atheists catholics protestants",
        "black white asian latino hispanic african european arab indigenous",
        "gay lesbian straight bisexual transgender queer heterosexual",
        "american mexican chinese russian german french spanish turkish polish indian",
        "immigrant refugee foreigner migrant citizen",
        "old young elderly teenage",
        "disabled blind deaf autistic",
    )
)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept for testing; a null id's text is empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def word_features(word: str) -> list[int]:
    """Hashes of a word and its beginnings."""
    return [zlib.crc32(b"w" + word.encode())] + [zlib.crc32(b"p%d" % n + word[:n].encode()) for n in PREFIXES if len(word) > n]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def swaps(words: set[str], identity: tuple[tuple[str, ...], ...] = IDENTITY) -> list[set[str]]:
    """The words after each swap of a mention for the next of its line."""
    return [words - {w} | {line[(i + 1) % len(line)]} for line in identity for i, w in enumerate(line) if w in words]


@dataclass
class Model:
    index: dict[int, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def scorer(self):
        """A function from texts to scores, which remembers words."""
        seen: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            on: set[int] = set()
            for w in text_words(text):
                if (f := seen.get(w)) is None:
                    if len(seen) > 500_000:
                        seen.clear()
                    f = seen[w] = tuple(self.index[h] for h in word_features(w) if h in self.index)
                on.update(f)
            z = self.bias + float(self.weights[sorted(on)].sum()) if on else self.bias
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def fit(rows: list[tuple[int, np.ndarray, list[np.ndarray]]], features: int = FEATURES, l2: float = 0.05, fairness: float = 10.0) -> Model:
    """Newton's method on (label, feature hashes, feature hashes after each swap)."""
    y = np.array([r[0] for r in rows], float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return Model(bias=float(np.log(share / (1 - share))))
    hashes, at = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
    n = np.bincount(at, minlength=len(hashes))
    pos = np.bincount(at, np.repeat(y, [len(r[1]) for r in rows]), len(hashes))
    known = np.flatnonzero(n >= LEAST)
    expected = n[known] * y.mean()
    chi = (pos[known] - expected) ** 2 / (expected * (1 - y.mean()))
    keep = np.sort(hashes[known[np.lexsort((known, -chi))[:features]]])
    index = {int(k): j for j, k in enumerate(keep)}
    x = np.zeros((len(rows), len(keep) + 1), np.float32)
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, [index[int(h)] for h in r[1] if int(h) in index]] = 1
    penalty = np.diag([l2] * len(keep) + [1e-6])
    change = np.zeros((SWAPS, x.shape[1]))  # swaps in blocks, so that memory doesn't grow with their number
    n_change = 0
    for i, (_, _, others) in enumerate(rows):
        for o in others:
            change[n_change] = x[i]
            change[n_change, [index[int(h)] for h in o if int(h) in index]] -= 1
            change[n_change, -1] = 0
            n_change += 1
            if n_change == SWAPS:
                penalty += fairness * change.T @ change
                change[:], n_change = 0, 0
    penalty += fairness * change[:n_change].T @ change[:n_change]
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)).sum() + 0.5 * w @ penalty @ w
    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        g = x.T @ (p - y) + penalty @ w
        h = penalty + sum((x[k : k + 1000] * (p * (1 - p))[k : k + 1000, None]).T @ x[k : k + 1000] for k in range(0, len(x), 1000))
        step, size = np.linalg.solve(h + 1e-9 * np.eye(len(w)), g), 1.0
        while (new := loss(w - size * step)) > now and size > 1e-6:
            size /= 2
        w, done, now = w - size * step, now - new < 1e-8 * now, new
        if done:
            break
    return Model(index, w[:-1], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """A model of the labelled rows that aren't held out: the ``sample`` of them with the smallest hashes of their id.

    Features are counted on the executors; of each row the driver gets those that are kept.
    """
    ids = docs.select(F.col(id_col).alias("l_id"))
    known = (labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isNotNull() & F.col("l_id").isNotNull())
             .where(~held_out(F.col("l_id"))).groupBy("l_id").agg(F.max("y").alias("y")).join(ids, "l_id", "left_semi").orderBy(F.xxhash64("l_id"), "l_id").limit(sample))
    rows = docs.select(F.col(id_col).alias("d_id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("d_id") == F.col("l_id"))  # at most ``sample`` rows
    rows = settle(rows.groupBy("l_id").agg(F.max("y").alias("y"), F.min("text").alias("text")).select("y", "text"), "toxicity-sample")  # of rows with one id the least text

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, pos = Counter(), Counter()
            for y, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                on = {h for w in text_words(t.as_py()) for h in word_features(w)}
                n.update(on)
                if y:
                    pos.update(on)
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(n.values(), pa.int64()), pa.array([pos[h] for h in n], pa.int64())], ["h", "n", "pos"])

    size, toxic = rows.agg(F.count(F.lit(1)), F.sum(F.when(F.col("y") != 0, 1).otherwise(0))).first()
    top: list[int] = []
    if 0 < (toxic or 0) < size:
        mean = toxic / size
        chi = F.pow(F.col("pos") - F.col("n") * mean, 2) / (F.col("n") * mean * (1 - mean))
        counted = rows.mapInArrow(counts, "h long, n long, pos long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
        top = [r.h for r in counted.where(F.col("n") >= LEAST).orderBy(chi.desc(), "h").limit(features).collect()]

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = set(top)
        pack = lambda ws: np.sort(np.fromiter({h for w in ws for h in word_features(w)} & wanted, np.uint32)).tobytes()
        for b in batches:
            words = [text_words(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(pack, words), pa.binary()), pa.array([[pack(o) for o in swaps(w)] for w in words], pa.list_(pa.binary()))], ["y", "x", "others"])

    got = rows.mapInArrow(kept, "y int, x binary, others array<binary>").toArrow()
    seen = lambda b: np.frombuffer(b.as_buffer(), np.uint32)
    found = [(y, seen(x), [seen(o) for o in others.values] if len(others) else []) for y, x, others in zip(got.column(0).to_pylist(), got.column(1), got.column(2), strict=True)]
    found.sort(key=lambda r: (r[1].tobytes(), r[0], [o.tobytes() for o in r[2]]))
    return fit(found, features, **options)


def score(docs: DataFrame, model: Model, columns: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """The columns named, and the score, of every row."""
    kept = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)], F.col(text_col).alias("text"))

    names = [*kept.columns[:-1], name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([one(t.as_py()) for t in b.columns[-1]], pa.float64())], names)

    schema = kept.drop("text").schema.add(name, "double")
    return kept.mapInArrow(run, schema).select(*[F.col(k).alias(c) for k, c in zip(names, [*columns, name], strict=True)])


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of docs, all columns, whose score is below the threshold."""
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    scored = score(docs, train(docs, labels, **options), docs.columns, name=name)
    return scored.where(F.col(name) < threshold).drop(name)
