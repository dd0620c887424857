"""Matching a lexicon in time linear in the text, however many stems it has.

A pattern is one or more stems separated by a space: words in a row, each of which begins with its stem; a stem that ends
in $ is a whole word. Words look up their beginnings in a table of first stems, so a text costs its words times the few
lengths that stems have; most words fail at their first letters, and only the others are remembered, a bounded number of
them. Substitution gives what replacing pattern after pattern would give, in which a name put in place of words may be
matched by a later pattern: places where a pattern may begin wait in a heap in order of pattern and position, and words
of names put in join it for the patterns still to come.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

WORD = re.compile(r"(\w+)")
#: Distinct words that begin like a stem and that a table remembers; texts that a task holds as Python objects.
REMEMBERED, TEXTS = 1 << 15, 256


class Patterns:
    """Patterns of names, in order: {name: "stem|stem stem|word$"}."""

    def __init__(self, table: dict[str, str]):
        self.names: list[str] = []
        self.stems: list[list[tuple[str, bool]]] = []
        self.begin: dict[str, list[int]] = {}
        for name, patterns in table.items():
            for p in filter(None, (x.strip() for x in patterns.lower().split("|"))):
                stems = [(s.removesuffix("$"), s.endswith("$")) for s in p.split()]
                if any(not re.fullmatch(r"\w+", s) for s, _ in stems):
                    raise ValueError(f"not stems of words: {p!r}")
                self.begin.setdefault(stems[0][0], []).append(len(self.names))
                self.names.append(name)
                self.stems.append(stems)
        self.lengths = sorted({len(s) for s in self.begin})
        self.least = self.lengths[0] if self.lengths else 0
        self.heads = {s[: self.least] for s in self.begin}
        self.known: dict[str, tuple[int, ...]] = {}

    def first(self, word: str) -> tuple[int, ...]:
        """Patterns whose first stem fits the word, in order."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            fits = (p for n in self.lengths if n <= len(word) for p in self.begin.get(word[:n], ()))
            got = self.known[word] = tuple(sorted(p for p in fits if not self.stems[p][0][1] or self.stems[p][0][0] == word))
        return got

    def candidates(self, words: list[str]) -> list[int]:
        """Positions of the words that begin with the first letters of some stem."""
        n, heads = self.least, self.heads
        return [k for k, w in enumerate(words) if w[:n] in heads]

    def found(self, words: list[str], gaps: list[str]) -> set[str]:
        """Names of which a pattern occurs; gaps[k] stands before word k."""
        out = set()
        for k in self.candidates(words):
            for p in self.first(words[k]):
                if self.names[p] not in out and all(k + j < len(words) and gaps[k + j].isspace() and fits(s, words[k + j]) for j, s in enumerate(self.stems[p][1:], 1)):
                    out.add(self.names[p])
        return out

    def substituted(self, words: list[str], gaps: list[str]) -> tuple[list[str], list[str], set[str]]:
        """Words and gaps with each name, between spaces, in place of what its patterns match; and the names."""
        heap = [(p, (k,), k) for k in self.candidates(words) for p in self.first(words[k])]
        if not heap:
            return words, gaps, set()
        heapq.heapify(heap)
        n = len(words)
        words, gaps = [*words, ""], list(gaps)  # the last is the end of the text
        after, before, alive, names = list(range(1, n + 2)), list(range(-1, n)), [True] * (n + 1), set()
        start, end = 0, n
        while heap:
            p, key, k = heapq.heappop(heap)
            if not alive[k]:
                continue
            taken, at = [k], k
            for s in self.stems[p][1:]:
                at = after[at]
                if at == end or not gaps[at].isspace() or not fits(s, words[at]):
                    break
                taken.append(at)
            if len(taken) < len(self.stems[p]):
                continue
            name = self.names[p]
            names.add(name)
            parts = WORD.split(f" {name} ")
            left, right = before[k], after[taken[-1]]
            for t in taken:
                alive[t] = False
            prev = left
            for j in range(1, len(parts), 2):
                new = len(words)
                words.append(parts[j])
                gaps.append((gaps[k] if j == 1 else "") + parts[j - 1])
                after.append(-1)
                before.append(prev)
                alive.append(True)
                if prev < 0:
                    start = new
                else:
                    after[prev] = new
                prev = new
                for q in self.first(parts[j]):
                    if q > p:
                        heapq.heappush(heap, (q, (*key, j), new))
            after[prev], before[right] = right, prev
            gaps[right] = parts[-1] + gaps[right]
        out_words, out_gaps, at = [], [], start
        while at != end:
            out_words.append(words[at])
            out_gaps.append(gaps[at])
            at = after[at]
        return out_words, [*out_gaps, gaps[end]], names


def fits(stem: tuple[str, bool], word: str) -> bool:
    return word == stem[0] if stem[1] else word.startswith(stem[0])


def split(text: str) -> tuple[list[str], list[str]]:
    """Words in small letters, and the gaps before them and at the end."""
    parts = WORD.split(text.lower())
    return parts[1::2], parts[0::2]


def put_together(words: list[str], gaps: list[str]) -> str:
    return " ".join("".join(x for pair in zip(gaps, [*words, ""], strict=True) for x in pair).split())


def matches(concepts: dict[str, str], as_written: dict[str, str], canonical: dict[str, str], texts: bool = True) -> Callable[[str], tuple]:
    """The function of a text that gives the columns of ``matched``."""
    c, w, k = Patterns(concepts), Patterns(as_written), Patterns(canonical)

    def one(text: str) -> tuple[list[str], list[str], list[str], str]:
        words, gaps = split(text)
        seen = w.found(words, gaps)
        words, gaps, names = c.substituted(words, gaps)
        if not texts:
            return sorted(names), sorted(seen), sorted(k.found(words, gaps))
        return sorted(names), sorted(seen), sorted(k.found(words, gaps)), put_together(words, gaps) if names else " ".join(text.lower().split())

    return one


def matched(df: DataFrame, text: str, concepts: dict[str, str], as_written: dict[str, str], canonical: dict[str, str], texts: bool = True) -> DataFrame:
    """df with anchors (concepts that were substituted), as_written (names found in the text itself), in_canonical (names
    found in the canonical text), each sorted, and canonical: the text in small letters with concepts in place.

    One pass over Arrow batches; filters on these columns stay above it, so a text is matched once. A null text is empty.
    Without texts, neither the text nor the canonical one is given: the canonical text isn't put together, and no text
    comes back from the worker.
    """
    fields = [StructField(c, ArrayType(StringType())) for c in ("anchors", "as_written", "in_canonical")] + [StructField("canonical", StringType())] * texts
    kept = [f for f in df.schema.fields if texts or f.name != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = matches(concepts, as_written, canonical, texts)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS):  # a few texts at a time, whatever the size of a batch
                b = whole.slice(k, TEXTS)
                rows = [one(value or "") for value in b.column(text).to_pylist()]
                new = [pa.array([r[j] for r in rows], pa.list_(pa.string()) if j < 3 else pa.string()) for j in range(len(fields))]
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *new], [f.name for f in [*kept, *fields]])

    return df.withColumn(text, F.coalesce(text, F.lit(""))).mapInArrow(run, StructType([*kept, *fields]))
