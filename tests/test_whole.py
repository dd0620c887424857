"""Queries over whole tables and whole scores, against brute force and SQL without cuts."""

import os
import random
import re
from collections import Counter
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from corvane import catalog
from corvane.plans import clusters as C
from corvane.plans import policy as P

SF = "/root/testdata/sf0.001"


def whole(spark, name, sql):
    """The query's rows and those of the SQL, sorted."""
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in "orders lineitem part documents events".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    rel = c.sql(sql)
    at = [[d[0] for d in rel.description].index(x) for x in df.columns]
    return sorted(map(tuple, df.collect()), key=repr), sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def test_words_decide_between_clusters_of_a_day(spark):
    row = lambda i, day, words, pulse, place=("delta",): (i, date(2024, 1, day), "strikes", ["delta", "strike"], pulse, list(place), int(i[1:]), words)
    rows = [row("h1", 1, ["bridge"], 9.0), row("h2", 1, ["market", "river"], 3.0), row("h3", 2, [], 5.0), row("h4", 2, ["market"], 1.0), row("c5", 3, ["market", "river", "night"], 2.0)]
    c = spark.createDataFrame(rows, "cluster_id string, local_day date, topic string, anchor_union array<string>, pulse double, locations array<string>, first_pos long, token_union array<string>")
    got = {r.cluster_id: r for r in C.temporal(c).collect()}
    assert (got["c5"].baseline, got["c5"].matched_days, got["c5"].change) == (2.0, 2, "CONTINUING")


def test_blocks_of_clusters_give_the_best_match_of_a_day(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_CLUSTERS", 4)
    monkeypatch.setattr(C, "COLUMNS", 8)
    rng = random.Random(3)
    some = lambda of, most: rng.sample(of, rng.randint(0, most))
    rows = [(f"c{k}", date(2024, 1, 1 + k % 9), rng.choice(["strikes", "energy", "naval", "support"]), some(["a", "b", "c", "d"], 3), rng.random(), some(["p", "q", "r"], 3), k, some([f"w{j}" for j in range(40)], 25)) for k in range(150)]
    c = spark.createDataFrame(rows, "cluster_id string, local_day date, topic string, anchor_union array<string>, pulse double, place_union array<string>, first_pos long, token_union array<string>").withColumn("locations", F.col("place_union"))
    share = lambda x, y: len({*x} & {*y}) / len({*x} | {*y}) if x and y else 0.0
    want = {}
    for i, day, topic, anchors, _, places, _, words in rows:
        best: dict = {}
        for _, h_day, h_topic, h_anchors, h_pulse, h_places, h_pos, h_words in rows:
            if 1 <= (day - h_day).days <= 7 and {*places} & {*h_places} and (topic == h_topic or {topic, h_topic} <= {*C.PAIRED}):
                best[h_day] = max(best.get(h_day, (-1.0, 0, 0.0)), (round(0.55 + 0.30 * share(anchors, h_anchors) + 0.15 * share(words, h_words), 9), -h_pos, h_pulse))
        want[i] = (pytest.approx(sum(b[2] for b in best.values()) / len(best), abs=1e-8) if best else None, len(best))
    assert {r.cluster_id: (r.baseline, r.matched_days) for r in C.temporal(c).collect()} == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_clusters_carry_the_words_of_their_items(spark):
    prep = catalog._prep(spark, SF)
    texts = {r.item_id: f"{r.title or ''} {r.text or ''}" for r in catalog.V.items(spark, SF).select("item_id", "title", "text").collect()}

    def words(text):
        value = " ".join(text.split()).lower()
        for name, (_, stem) in P.LEXICON.items():
            value = re.sub(rf"(?<!\w){stem}\w*", f" {name} ", value)
        return {t for t in re.findall(r"[a-z0-9][a-z0-9'-]{2,}", value) if len(t) >= 4 and t not in P.STOPWORDS}

    want: dict = {}
    for r in C.accepted(prep).collect():
        want.setdefault((r.local_day, r.topic, tuple(r.locations), tuple(r.semantic)), set()).update(words(texts[r.item_id]))
    got = {(r.local_day, r.topic, tuple(r.locations), tuple(r.semantic)): r.token_union for r in C.clusters(prep).collect()}
    assert {k: set(v) for k, v in got.items()} == want and all(len(v) == len(set(v)) for v in got.values())
    spark.catalog.clearCache()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_media_of_every_post(spark):
    got, want = whole(spark, "media_expand", "SELECT o_orderkey AS post_id, coalesce(string_agg(CASE WHEN p.p_partkey % 5 <> 0 THEN 'm/' || l_partkey END, ',' ORDER BY l_linenumber, l_partkey), '') AS media FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part p ON p_partkey = l_partkey GROUP BY 1")
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_period_of_every_order(spark):
    got, want = whole(spark, "period_days", "SELECT o_orderkey, CASE WHEN o_custkey % 40 < 31 THEN o_custkey % 40 + 1 END AS days FROM orders")
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_every_token_is_counted(spark):
    n: Counter = Counter()
    for r in catalog.V.items(spark, SF).select("text").collect():
        n.update({t for t in re.findall(r"[a-z0-9][a-z0-9'-]{2,}", r.text.lower()) if len(t) >= 4 and t not in P.STOPWORDS})
    assert {r.t: r.n for r in catalog.QUERIES["tokens"](spark, SF).collect()} == n and min(n.values()) < 20


def test_samples_are_of_different_families(spark):
    rows = [(i, date(2024, 1, 1), "strikes", ["delta"], [], "hot" if i < 20 else f"f{i}", P.GROUPS[i % 2], "known", "high", datetime(2024, 1, 1, 23 - i % 24)) for i in range(24)]
    acc = spark.createDataFrame(rows, "item_id long, local_day date, topic string, locations array<string>, semantic array<string>, family string, grp string, perspective string, trust string, stamp timestamp")
    got = C.samples(acc).orderBy("place").collect()
    rank = lambda r: (P.GROUP_RANK.get(r[6], 0), P.TRUST_RANK.get(r[8], 0), r[9], -r[0])
    best: dict = {}
    for r in sorted(rows, key=rank, reverse=True):
        best.setdefault(r[5], r)
    first, rest, seen = [], [], set()
    for r in sorted(best.values(), key=rank, reverse=True):
        (rest if r[6] in seen else first).append(r[0])
        seen.add(r[6])
    assert [r.item_id for r in got] == (first + rest)[:5] and len({r.family for r in got}) == 5
