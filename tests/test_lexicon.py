"""The lexicon matcher against replacing one pattern after the other."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corvane import catalog
from corvane.functions.lexicon import Patterns, matched, put_together, split
from corvane.plans import clusters as C
from corvane.plans import policy as P


def pattern(p):
    return r"(?<!\w)" + r"\s+".join(re.escape(s.removesuffix("$")) + (r"(?!\w)" if s.endswith("$") else r"\w*") for s in p.split())


def one_by_one(text, table):
    value, names = " ".join(text.lower().split()), set()
    for name, patterns in table.items():
        for p in patterns.split("|"):
            if re.search(pattern(p), value):
                names.add(name)
                value = re.sub(pattern(p), f" {name} ", value)
    return " ".join(value.split()), names


@pytest.mark.parametrize("seed", range(40))
def test_substitution_is_that_of_pattern_after_pattern(seed):
    rng = random.Random(seed)
    bits = ["ab", "abc", "b", "ba", "c-a", "a b", "abb", "cab"]
    table = {n: "|".join({" ".join(rng.choice(["a", "ab", "b", "ba", "c", "abc"]) + rng.choice(["", "", "$"]) for _ in range(rng.choice([1, 1, 1, 2, 3]))) for _ in range(rng.randint(1, 3))}) for n in rng.sample(["ab", "c-ab", "b", "ca ba", "abc", "ба"], 5)}
    text = "".join(rng.choice(bits) + rng.choice([" ", " ", "  ", "-", ", ", "\n"]) for _ in range(60))
    p = Patterns(table)
    words, gaps = split(" ".join(text.split()))
    new_words, new_gaps, names = p.substituted(words, gaps)
    assert (put_together(new_words, new_gaps), names) == one_by_one(text, table)
    assert p.found(words, gaps) == {n for n, ps in table.items() if any(re.search(pattern(x), " ".join(text.lower().split())) for x in ps.split("|"))}


def test_a_large_lexicon_costs_little_more():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9)))
    text = " ".join(word() for _ in range(100_000))
    took = []
    for n in (200, 20_000):
        p = Patterns({f"n{k}": f"{word()}q" for k in range(n)})
        began = time.process_time()
        p.substituted(*split(text))
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 1  # a hundred times the stems


def test_words_that_begin_like_no_stem_are_not_remembered():
    p = Patterns({"x": "zab|zabc de$", "y": "qq"})
    words, gaps = split(" ".join(f"a{k}" for k in range(5000)) + " zabcd de zzz")
    assert p.found(words, gaps) == p.substituted(words, gaps)[2] == {"x"}
    assert len(p.known) <= 2


def test_stems_that_are_no_words_are_refused():
    with pytest.raises(ValueError, match="not stems"):
        Patterns({"x": "a.*"})


def test_nulls_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Ábc ab")], "id long, t string")
    got = {r.id: (r.anchors, r.canonical) for r in matched(df, "t", {"x": "áb"}, {}, {}).collect()}
    assert got == {1: ([], ""), 2: ([], ""), 3: (["x"], "x ab")}


def test_plan_of_clusters_is_small_and_matches_once(spark):
    items = catalog.V.items(spark, "/root/testdata/sf0.001")
    prep = C.prepared(items, P.TEST_LEXICON)
    plan = C.accepted(prep)._jdf.queryExecution().toString()
    assert len(plan) < 100_000 and plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1


def test_evidence_needs_neither_words_nor_texts_of_clusters(spark, monkeypatch):
    """One pass of the matcher that gives no text, and nothing is written between it and the scores."""
    written, plain = [], C.settled
    monkeypatch.setattr(C, "settled", lambda df, name: written.append(name) or plain(df, name))
    plan = catalog.QUERIES["evidence"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert not written and plan.count("MapInArrow") == 1 and " canonical#" not in plan
    assert "token_union" not in C.clusters(C.prepared(catalog.V.items(spark, "/root/testdata/sf0.001"), P.TEST_LEXICON, words=False)).columns


def test_matches_are_the_same_without_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Ábc ab"), (4, "ab x ábd")], "id long, t string")
    found = lambda **k: matched(df, "t", {"x": "áb"}, {"w": "ab"}, {"y": "x ab|x x"}, **k)
    less = found(texts=False)
    assert less.columns == ["id", "anchors", "as_written", "in_canonical"]
    assert sorted(map(tuple, less.collect())) == sorted(map(tuple, found().select(less.columns).collect()))


def test_groups_beyond_the_table_weigh_half(spark):
    rows = [(1, "d", "t", [], [], "f1", "other", "unknown"), (2, "d", "t", [], [], "f2", "other", ""), (3, "d", "t", [], [], "f3", "other", "x"), (4, "d", "t", [], [], "f4", "osint", "y")]
    best = spark.createDataFrame(rows, "item_id long, local_day string, topic string, locations array<string>, semantic array<string>, family string, grp string, perspective string")
    assert C.evidence(best).first().evidence == 0.5 * 2 + 3.5 + 1.0
    one = best.where(F.col("item_id") == 1)
    assert C.evidence(one).first().evidence == 0.5
