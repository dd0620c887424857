"""Situation clusters: preparation, gates, build, scores, change over time, rank and selection."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions.lexicon import matched
from corvane.plans import policy as P
from corvane.session import drop, settled


def has(arr: Column, values: list[str]) -> Column:
    return F.arrays_overlap(arr, F.array(*[F.lit(v) for v in values]))


def only(arr: Column, values: list[str]) -> Column:
    return F.array_intersect(arr, F.array(*[F.lit(v) for v in values]))


def tokens(text: Column) -> Column:
    """Distinct words of four letters or more, without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(P.TOKEN), F.lit(1))
    return F.array_except(F.filter(F.array_distinct(found), lambda t: F.char_length(t) >= 4), F.array(*[F.lit(w) for w in P.STOPWORDS]))


def relevance(empty: Column, found: Column, anchor: Column, group: Column, redacted: Column, lex: P.Lexicon) -> Column:
    """The first gate, for recall. found: groups of stems in the canonical text."""
    context, action, support = has(anchor, lex.names("context", "location")), has(anchor, lex.names("action", "equipment")), has(anchor, lex.names("support"))
    return (F.when(redacted, "redacted").when(empty, "irrelevant").when((group == "official-ua") & (action | support), "relevant").when(context & (action | support), "relevant")
            .when(context & F.array_contains(found, "political"), "peripheral").otherwise("irrelevant"))


def topic(found: Column, anchor: Column) -> Column:
    a = lambda *n: has(anchor, list(n))
    return (F.when(a("casualties"), "civilian-harm").when(a("naval"), "naval").when(a("air-defence"), "air-defence").when(a("drone", "strike"), "strikes").when(a("frontline"), "frontline")
            .when(a("refinery", "railway"), "energy").when(a("sanctions", "aid"), "support").when(F.array_contains(found, "investigate"), "investigations").otherwise("other"))


def editorial_topic(first: Column, anchor: Column) -> Column:
    """Mentions of harm decide, then whether there was a strike (drones count as one)."""
    return F.when(has(anchor, ["casualties"]), F.when(has(anchor, P.STRIKES), "strikes").otherwise("civilian-harm")).otherwise(first)


def strict(found: Column, anchor: Column, group: Column, topic_: Column, located: Column) -> Column:
    """The second gate, for precision: a rule for each topic, and a veto for memorial texts."""
    a = lambda *n: has(anchor, list(n))
    current = a("homeland")
    ctx = located | current | (group == "official-ua")
    rule = (F.when(topic_ == "civilian-harm", a("casualties") & ctx & (located | current | a(*P.STRIKES))).when(topic_ == "strikes", ctx & a(*P.STRIKES)).when(topic_ == "air-defence", ctx & a("air-defence"))
            .when(topic_ == "frontline", ctx & a("frontline")).when(topic_ == "energy", ctx & a("refinery", "railway")).when(topic_ == "naval", ctx & a("naval"))
            .when(topic_ == "support", a("sanctions", "aid") & (current | group.isin("official-ua", "international-media", "analysts"))).when(topic_ == "investigations", group.isin("osint", "analysts") & (ctx | a(*P.STRIKES, "frontline"))).otherwise(F.lit(False)))
    return rule & ~F.array_contains(found, "memorial")


def signature(anchor: Column, topic_: Column, located: Column, family: Column, lex: P.Lexicon) -> Column:
    none = F.array().cast("array<string>")
    base = (F.when(topic_ == "civilian-harm", F.array(F.lit("casualties"))).when(topic_ == "support", F.when(has(anchor, ["sanctions"]), F.array(F.lit("sanctions"))).when(has(anchor, ["aid"]), F.array(F.lit("aid"))).otherwise(none))
            .when(topic_.isin("energy", "air-defence", "naval"), only(anchor, lex.names("equipment"))).otherwise(none))
    return F.when(~located & ~topic_.isin("support", "investigations"), F.concat(base, F.array(F.concat(F.lit("source:"), family)))).otherwise(base)


def prepared(items: DataFrame, lex: P.Lexicon, words: bool = True) -> DataFrame:
    """Items with anchors, topics, gates and cluster key. Each text is matched once, by words; rules read what was found.

    locations: display places of the text as written (cluster key); places: places among the anchors (change over time
    and dominance). tokens: only with words; without, no text is written anew or leaves the matcher.
    """
    text = T.clean(F.concat_ws(" ", F.col("title"), F.col("text")))
    p = items.select("item_id", "source", "platform", "grp", "perspective", "trust", "stamp", "local_day", F.lower("source_name").alias("family"), text.alias("body"), F.array_contains("tags", P.REDACT_TAGS[0]).alias("redacted"))
    p = p.withColumn("empty", F.col("body") == "")
    p = matched(p, "body", {n: stems for n, (_, stems) in lex.anchors.items()}, lex.as_written(), {k: lex.groups[k] for k in P.CANONICAL_GROUPS}, words)
    found, anchor = F.col("as_written"), F.col("anchors")
    p = p.withColumns({"relevance": relevance(F.col("empty"), F.col("in_canonical"), anchor, F.col("grp"), F.col("redacted"), lex), "first_topic": topic(F.col("in_canonical"), anchor), "places": only(anchor, lex.names("location")), "locations": F.transform(F.filter(found, lambda n: n.startswith(P.DISPLAY)), lambda n: F.substring(n, len(P.DISPLAY) + 1, 1 << 20))})
    located = F.size("locations") > 0
    p = p.withColumn("topic", editorial_topic(F.col("first_topic"), anchor))
    p = p.withColumns({k: F.array_contains(found, k) for k in ("major", "material", "alert")})
    p = p.withColumn("strict", strict(found, anchor, F.col("grp"), F.col("topic"), located))
    p = p.withColumn("semantic", signature(anchor, F.col("topic"), located, F.col("family"), lex))
    if words:
        p = p.withColumn("tokens", F.when(in_cluster(), tokens(F.col("canonical"))))
    return p.drop("body", "empty", "as_written", "in_canonical", "canonical")


def in_cluster() -> Column:
    return F.col("relevance").isin("relevant", "peripheral") & F.col("strict")


def accepted(prep: DataFrame) -> DataFrame:
    return prep.where(in_cluster())


KEY = ["local_day", "topic", "locations", "semantic"]


def cluster_id() -> Column:
    return F.concat_ws("|", F.col("local_day").cast("string"), "topic", F.array_join("locations", ","), F.array_join("semantic", ","))


def family_best(acc: DataFrame) -> DataFrame:
    """The best item of each source family in a cluster: group, trust, stamp, then the first."""
    rank = lambda table, c: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col(c)), F.lit(0))
    best = F.max_by(F.struct("item_id", "grp", "perspective", "trust", "stamp"), F.struct(rank(P.GROUP_RANK, "grp"), rank(P.TRUST_RANK, "trust"), F.col("stamp"), -F.col("item_id")))
    return acc.groupBy(*KEY, "family").agg(best.alias("b"), F.count(F.lit(1)).alias("items")).select(*KEY, "family", "items", "b.*")


def evidence(best: DataFrame) -> DataFrame:
    """Weight of each group (of a group that the table hasn't, 0.5) times at most two families, one more for two known
    perspectives, at most 10."""
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in P.WEIGHT.items() for x in kv]), F.col("grp")), F.lit(P.WEIGHT_OTHER))
    known = F.when(~F.col("perspective").isin("", "unknown"), F.col("perspective"))
    g = best.groupBy(*KEY, "grp").agg(F.count(F.lit(1)).alias("n"), F.collect_set(known).alias("seen"))
    g = g.groupBy(*KEY).agg(F.round(F.sum(weight * F.least("n", F.lit(2))), 9).alias("score"), F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"))
    return g.select(*KEY, F.least(F.lit(10.0), F.col("score") + F.when(F.col("seen") >= 2, 1.0).otherwise(0.0)).alias("evidence"))


def label(score: Column, high: float, middle: float, names: tuple[str, str, str]) -> Column:
    return F.when(score >= high, names[0]).when(score >= middle, names[1]).otherwise(names[2])


def pulse(acc: DataFrame) -> DataFrame:
    """Intensity on one message platform: families, mentions (three of a family count), perspectives; at most 10."""
    t = acc.where("platform = 'telegram'").groupBy(*KEY, "family").agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(~F.col("perspective").isin("", "unknown"), F.col("perspective"))).alias("seen"))
    t = t.groupBy(*KEY).agg(F.count(F.lit(1)).alias("families"), F.sum(F.least(F.lit(3), "n")).alias("capped"), F.sum("n").alias("posts"), F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"))
    score = F.lit(1.8) * F.log2(1 + F.col("families")) + F.lit(0.35) * F.col("capped") + F.lit(0.7) * F.greatest(F.lit(0), F.col("seen") - 1)
    return t.select(*KEY, F.round(F.least(F.lit(10.0), score), 9).alias("pulse"), "posts")


def clusters(prep: DataFrame) -> DataFrame:
    """One row per cluster of a local day, with its scores and predicates; and with its words, if prep has tokens."""
    acc = settled(accepted(prep).drop("relevance", "first_topic", "strict", "redacted"), "accepted")  # small columns of the items that are in clusters; four aggregations read it
    body = acc.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("items"), F.min("item_id").alias("first_pos"), F.count_distinct("family").alias("families"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("anchors")))).alias("anchor_union"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("places")))).alias("place_union"),
        F.bool_or("material").alias("material"), F.avg(F.col("alert").cast("double")).alias("alerts"))
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy("item_id"))
    early = acc.select(*KEY, "item_id", "major").withColumn("place", place).where(F.col("place") <= 20)  # cut on the map side, too
    major = early.groupBy(*KEY).agg(F.bool_or("major").alias("major"))
    on = lambda d: [F.col(f"c.{k}") == F.col(f"d.{k}") for k in KEY]
    c = body.alias("c").join(evidence(family_best(acc)).alias("d"), on("d")).select("c.*", "d.evidence")
    c = c.alias("c").join(major.alias("d"), on("d")).select("c.*", "d.major")
    c = c.alias("c").join(pulse(acc).alias("d"), on("d"), "left").select("c.*", F.coalesce("d.pulse", F.lit(0.0)).alias("pulse"))
    if "tokens" in acc.columns:
        words = acc.select(*KEY, F.explode("tokens").alias("token")).distinct().groupBy(*KEY).agg(F.collect_list("token").alias("token_union"))
        c = c.alias("c").join(words.alias("d"), on("d"), "left").select("c.*", F.coalesce("d.token_union", F.array().cast("array<string>")).alias("token_union"))
    base = F.create_map(*[F.lit(x) for kv in P.IMPORTANCE.items() for x in kv])
    imp = F.element_at(base, F.col("topic")) + F.when(F.col("major"), 1.0).otherwise(0.0) + F.when(has(F.col("anchor_union"), ["refinery", "railway"]), 0.5).otherwise(0.0) + F.when((F.col("topic") == "civilian-harm") & has(F.col("anchor_union"), ["casualties"]), 0.5).otherwise(0.0)
    n = F.size("locations")
    t = F.col("topic")
    c = c.withColumns({
        "importance": F.least(F.lit(10.0), imp), "routine": t.isin("strikes", "air-defence") & ~F.col("material") & (F.col("alerts") >= 0.5) & (F.col("families") <= 3), "broad": n >= F.when(t == "civilian-harm", 2).otherwise(3),
        "weak": (n == 0) & ~t.isin("support", "investigations"), "thin": F.when(t.isin("frontline", "air-defence", "naval", "support"), F.col("evidence") < 3.0).when(t == "energy", F.col("evidence") < 1.5).otherwise(F.lit(False)),
        "cluster_id": cluster_id()})
    out = settled(c, "clusters")  # a few hundred rows a day, read by history, rank and selection
    drop(acc)
    return out


def places_of(c: DataFrame) -> Column:
    """Places among the anchors; where clusters have but one list of places, that one."""
    return F.col("place_union" if "place_union" in c.columns else "locations")


PAIRED = ["strikes", "civilian-harm", "air-defence", "energy"]
#: Words of a block of a day's clusters, clusters of one, and columns of a matrix of them.
BLOCK_WORDS, BLOCK_CLUSTERS, COLUMNS = 1 << 21, 1024, 8192
#: Pairs whose scores are this near to a block's best are left for the exact rule to choose from.
NEAR = 1e-8


def common(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values that each list of a shares with each of b, as a matrix; and how many each of a, and of b, has."""
    n, m = len(a), len(b)
    rows = np.concatenate([pc.list_parent_indices(a).to_numpy(), n + pc.list_parent_indices(b).to_numpy()]).astype(np.int64)
    code = pc.dictionary_encode(pa.concat_arrays([a.flatten(), b.flatten()]), null_encoding="encode").indices.to_numpy().astype(np.int64)
    key = np.unique(code * (n + m) + rows)  # by value, each list once
    code, rows = key // (n + m), key % (n + m)
    size = np.bincount(rows, minlength=n + m)
    left = rows < n
    kinds = int(code[-1]) + 1 if len(code) else 0
    shared = (np.bincount(code[left], minlength=kinds) > 0) & (np.bincount(code[~left], minlength=kinds) > 0)
    keep = shared[code]
    code, rows = (np.cumsum(shared) - 1)[code[keep]], rows[keep]
    both = np.zeros((n, m), np.int64)
    for k in range(0, int(shared.sum()), COLUMNS):
        at = slice(*np.searchsorted(code, [k, k + COLUMNS]))
        x = np.zeros((n + m, COLUMNS), np.float32)
        x[rows[at], code[at] - k] = 1
        both += (x[:n] @ x[n:].T).astype(np.int64)  # exact: at most COLUMNS
    return both, size[:n], size[n:]


MATCHED = "cluster_id string, h_day date, h_pulse double, h_pos long, anchors_both long, anchors_all long, words_both long, words_all long"


def block_matches(key: tuple, now: pa.Table, old: pa.Table) -> pa.Table:
    """Of two blocks of clusters, one of an earlier day: for each later cluster the matches whose score is the best, or
    so near to it that rounding may decide; of equal ones the first."""
    names = [f.split()[0] for f in MATCHED.split(", ")]
    empty = pa.table({n: pa.array([], t) for n, t in zip(names, [pa.string(), pa.date32(), pa.float64(), *[pa.int64()] * 5], strict=True)})
    if not now.num_rows or not old.num_rows:
        return empty
    of = lambda t, c: t[c].combine_chunks()
    topic, h_topic = (np.array(t["topic"].to_pylist(), object)[:, None] for t in (now, old))
    known = lambda t: np.array([x is not None for x in t[:, 0]])
    ok = (topic == h_topic.T) & known(topic)[:, None] & known(h_topic)[None, :] | (np.isin(topic.astype(str), PAIRED) & np.isin(h_topic.astype(str), PAIRED).T)
    ok &= common(of(now, "places"), of(old, "places"))[0] > 0
    if not ok.any():
        return empty
    share = lambda part, whole: np.where(whole > 0, part / np.maximum(whole, 1), 0.0)
    a_both, a_n, a_m = common(of(now, "anchors"), of(old, "anchors"))
    a_all = np.where((a_n[:, None] > 0) & (a_m[None, :] > 0), a_n[:, None] + a_m[None, :] - a_both, 0)
    w_both, w_n, w_m = common(of(now, "words"), of(old, "words"))
    w_all = np.where((w_n[:, None] > 0) & (w_m[None, :] > 0), w_n[:, None] + w_m[None, :] - w_both, 0)
    score = np.where(ok, 0.55 + 0.30 * share(a_both, a_all) + 0.15 * share(w_both, w_all), -1.0)
    i, j = np.nonzero(ok & (score >= score.max(axis=1, keepdims=True) - NEAR))
    pos = old["first_pos"].to_numpy()
    order = np.lexsort((pos[j], score[i, j], i))
    i, j = i[order], j[order]
    first = np.append(True, (i[1:] != i[:-1]) | (score[i[1:], j[1:]] != score[i[:-1], j[:-1]]))
    i, j = i[first], j[first]
    counts = [pa.array(x[i, j].astype(np.int64)) for x in (a_both, a_all, w_both, w_all)]
    day = of(old, "day").take(pa.array(j))
    return pa.Table.from_arrays([of(now, "cluster_id").take(pa.array(i)), day, of(old, "pulse").take(pa.array(j)), of(old, "first_pos").take(pa.array(j)), *counts], names)


def temporal(c: DataFrame, days: int = 7) -> DataFrame:
    """cluster_id, change, novelty, baseline, matched_days.

    Two clusters match exactly if their topics are compatible and they share a place (a pair without one can't reach the
    threshold of the score); the score only picks the best match of a day. The clusters of a day are cut into blocks of
    bounded size, and each block meets those of the seven days before: a cluster travels once for each block that it
    meets, not for each cluster, and nothing is written for a pair that isn't the best of its block.
    """
    none = F.array().cast("array<string>")
    words = F.transform(F.coalesce("token_union", none), lambda t: F.xxhash64(t))  # as numbers; two words of a pair of clusters share one once in 10^12
    what = c.where(F.size(places_of(c)) > 0).select("cluster_id", "topic", F.col("local_day").alias("day"), F.filter(places_of(c), lambda p: p.isNotNull()).alias("places"), F.coalesce("anchor_union", none).alias("anchors"), words.alias("words"), F.col("pulse").cast("double").alias("pulse"), F.col("first_pos").cast("long").alias("first_pos"))
    load = F.greatest(F.sum(F.size("words")) / BLOCK_WORDS, F.count(F.lit(1)) / BLOCK_CLUSTERS)
    blocks = what.groupBy("day").agg(F.ceil(load).cast("int").alias("n"))
    what = what.join(blocks, "day").withColumn("block", F.pmod(F.xxhash64("cluster_id"), F.col("n")).cast("int")).drop("n")
    met = blocks.select(F.col("day").alias("met_day"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("met_block"))
    near = lambda first, last: what.withColumn("met_day", F.explode(F.sequence(F.date_add("day", first), F.date_add("day", last)))).join(met, "met_day")
    now, old = near(-days, -1), near(1, days)
    old = old.select([F.col(k).alias(k) for k in old.columns])  # columns of its own
    pairs = now.groupBy("day", "block", "met_day", "met_block").cogroup(old.groupBy("met_day", "met_block", "day", "block")).applyInArrow(block_matches, MATCHED)
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))
    score = 0.55 + 0.30 * share("anchors_both", "anchors_all") + 0.15 * share("words_both", "words_all")
    best = pairs.groupBy("cluster_id", "h_day").agg(F.max_by("h_pulse", F.struct(F.round(score, 9), -F.col("h_pos"))).alias("day_pulse"))
    base = best.groupBy("cluster_id").agg(F.round(F.avg("day_pulse"), 9).alias("baseline"), F.count(F.lit(1)).alias("matched_days"))
    j = c.select("cluster_id", "pulse").join(base, "cluster_id", "left")
    b, p = F.col("baseline"), F.col("pulse")
    change = F.when(b.isNull(), "NEW").when((b > 0) & (p >= b * 1.8) & (p - b >= 1.0), "ESCALATING").when((b > 0) & (p <= b * 0.55) & (b - p >= 1.0), "DECLINING").otherwise("CONTINUING")
    novelty = F.when(b.isNull(), 9.0).when(change == "ESCALATING", 7.0).when(change == "DECLINING", 4.0).otherwise(2.0)
    return j.select("cluster_id", change.alias("change"), novelty.alias("novelty"), "baseline", F.coalesce("matched_days", F.lit(0)).alias("matched_days"))


def ranked(c: DataFrame) -> DataFrame:
    """Clusters with the editorial rank, 0 to 10."""
    j = c.join(temporal(c), "cluster_id")
    score = 0.42 * F.col("importance") + 0.22 * F.col("novelty") + 0.18 * F.col("pulse") + 0.18 * F.col("evidence")
    score = score + F.when(F.col("families") >= 4, 0.5).when((F.col("families") == 1) & F.col("topic").isin("strikes", "air-defence"), -0.4).otherwise(0.0)
    for flag, cost in (("routine", 3.0), ("broad", 1.2), ("weak", 1.5), ("thin", 1.0)):
        score = score - F.when(F.col(flag), cost).otherwise(0.0)
    return j.withColumn("rank", F.round(F.greatest(F.lit(0.0), F.least(F.lit(10.0), score)), 9))


def primary(r: DataFrame, most: int = 14, per_topic: int = 4) -> DataFrame:
    """The day's primary clusters: in order of rank, at most so many a topic, none dominated by one chosen before.

    Each choice depends on those before, so it is a fold over the sorted clusters of a day - a few hundred at most.
    """
    row = F.struct((-F.col("rank")).alias("o"), "first_pos", "cluster_id", "topic", places_of(r).alias("locations"), "evidence", "families", "items")
    days = r.where("NOT (routine OR broad OR weak OR thin)").groupBy("local_day").agg(F.array_sort(F.collect_list(row)).alias("xs"))

    def step(acc: Column, x: Column) -> Column:
        inside = lambda s: (F.size(s["locations"]) > 0) & (F.size(s["locations"]) < F.size(x["locations"])) & (F.size(F.array_except(s["locations"], x["locations"])) == 0)
        wins = lambda s: (s["topic"] == x["topic"]) & inside(s) & (s["evidence"] >= x["evidence"]) & ((s["families"] >= x["families"] + 2) | (s["items"] >= F.greatest(F.lit(3), 2 * x["items"])))
        full = F.size(F.filter(acc, lambda s: s["topic"] == x["topic"])) >= per_topic
        return F.when((F.size(acc) >= most) | full | F.exists(acc, wins), acc).otherwise(F.concat(acc, F.array(x)))

    chosen = days.select("local_day", F.posexplode(F.aggregate("xs", F.slice("xs", 1, 0), step)).alias("pos", "x"))
    return chosen.select("local_day", (F.col("pos") + 1).alias("place"), "x.cluster_id", "x.topic", (-F.col("x.o")).alias("rank"))


def watch(r: DataFrame, chosen: DataFrame, least: float = 4.0, most: int = 6) -> DataFrame:
    """The strongest pulses that aren't primary."""
    rest = r.where(F.col("pulse") >= least).join(chosen.select("cluster_id"), "cluster_id", "left_anti")
    place = F.row_number().over(Window.partitionBy("local_day").orderBy(F.col("pulse").desc(), F.col("rank").desc(), "first_pos"))
    return rest.withColumn("place", place).where(F.col("place") <= most).select("local_day", "place", "cluster_id", "pulse")


def samples(acc: DataFrame, most: int = 5) -> DataFrame:
    """Diverse samples of a cluster, of the best items of its families: the best of each group first, then by rank."""
    rank = lambda table, c: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col(c)), F.lit(0))
    order = [rank(P.GROUP_RANK, "grp").desc(), rank(P.TRUST_RANK, "trust").desc(), F.col("stamp").desc(), F.col("item_id")]
    s = family_best(acc).withColumn("in_group", F.row_number().over(Window.partitionBy(*KEY, "grp").orderBy(*order)))
    s = s.withColumn("place", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.col("in_group") > 1, *order)))
    return s.where(F.col("place") <= most)
