"""Collocations, decontamination and conversation repair against brute force, on odd tables and with limits forced small."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corvane.llm import collocations, conversation_repair, positional_index

# --- collocations ---


def lists_of(rows):
    """Counts of all phrases of a language, and its words."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lower):
            ws = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(ws)
            for m in (1, 2, 3):
                f[lang].update(tuple(ws[k : k + m]) for k in range(len(ws) - m + 1))
    return f, n


def best_phrases(rows, least=10, share=50, most=2000):
    f, n = lists_of(rows)
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            longer = [c[q] for q in c if len(q) == 3 and c[q] >= least and len(p) == 2 and p in (q[:2], q[1:])]
            if not any(100 * x >= share * a for x in longer):
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def texts(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "of", "the", "çé", "x-y", "\x1fz", "漢", "don't"]
    make = lambda: "".join(rng.choice(words) + rng.choice([" "] * 8 + ["  ", "\t", ". ", ", ", "\n", "!", "\r\n"]) for _ in range(rng.choice([0, 1, 3, 30, 90])))
    rows = [(k if k % 9 else None, make(), rng.choice(["en", "en", "en", "de", None]), "s") for k in range(n)]
    return rows + [(1, None, "en", "s"), (2, "", "en", "s"), (3, " .. \t!", None, "s"), (4, "a of " * 300, "und", "s")] + [(5, "the the the", "en", "s")] * 12


COLS = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("segment, begun", [(8 << 20, 24 << 20), (200, 500), (1, 1)])
def test_collocations(spark, monkeypatch, segment, begun):
    monkeypatch.setattr(collocations, "SEGMENT", segment)
    monkeypatch.setattr(collocations, "BEGUN", begun)
    rows = texts(segment)
    df = spark.createDataFrame(rows, COLS)
    got = sorted(tuple(r) for r in collocations.collocations(df.repartition(3)).collect())
    assert got == best_phrases([(r[2], r[1]) for r in rows]) and got
    few = sorted(tuple(r) for r in collocations.collocations(df, least=25, share=90, most=3).collect())
    assert few == best_phrases([(r[2], r[1]) for r in rows], 25, 90, 3)


def test_collocations_of_odd_tables(spark):
    assert collocations.collocations(spark.createDataFrame([], COLS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None, None)], COLS)).collect() == []
    clash = spark.createDataFrame([("a b", "en", 1, "x", "y", 2, 3)] * 11, "text string, lang string, seg int, phrase string, id string, a int, n int")
    assert [tuple(r) for r in collocations.collocations(clash).collect()] == [("en", 1, "a b", 11, 11, 11, 22, 1_000_000)]


def test_scores_are_exact(spark):
    rng = random.Random(3)
    rows = [(a, left, right) for left, right in ((10 ** rng.randint(1, 13), 10 ** rng.randint(1, 13) + rng.randint(0, 9)) for _ in range(60)) for a in (min(left, right), 1 + min(left, right) // 3)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    assert all(r.s == 10**6 * r.a * r.a // (r.l * r.r) for r in df.select("*", collocations.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect())


# --- decontamination ---


def windows_of(items, n):
    out = defaultdict(set)
    for i, text in items:
        ws = positional_index.words(text)
        for k in range(max(1, len(ws) - n + 1) if ws else 0):
            out[tuple(ws[k : k + n])].add("" if i is None else str(i))
    return out


def hits(docs, items, n, slack=0):
    """(doc_id, words, hit words, items); with a slack, for each window and place of its rarest term: each term within so many words of its own place."""
    wins, out = windows_of(items, n), []
    for d, text in docs:
        ws, hit, found = positional_index.words(text), set(), set()
        for w, names in wins.items():
            for start in range(-len(w) - slack, len(ws)):
                near = [any(0 <= p < len(ws) and ws[p] == t for p in range(start + k - slack, start + k + slack + 1)) for k, t in enumerate(w)]
                exact = [0 <= start + k < len(ws) and ws[start + k] == t for k, t in enumerate(w)]
                if all(near) and (any(exact) if slack else all(exact)):
                    hit |= set(range(max(0, start), min(len(ws), start + len(w))))
                    found |= names
        out.append((d, len(ws), hit, sorted(found)))
    return out


def tables(seed):
    rng = random.Random(seed)
    docs = [(k if k % 7 else None, " ".join(rng.choice(["a", "B", "c", "é1", "D!e", "漢"]) for _ in range(rng.choice([0, 1, 5, 30, 120])))) for k in range(60)] + [(1, None), (2, ""), (3, " ?! ")]
    items = [(k if k else None, " ".join(rng.choice(["A", "b", "c", "É1", "é1"]) for _ in range(rng.choice([0, 1, 2, 3, 5, 12])))) for k in range(25)] + [(5, "a b"), (5, None), (77, "é1 c a b c")]
    return docs, items


@pytest.mark.parametrize("segment, block, at_once, part", [(8 << 20, 200_000, 1 << 21, 10_000), (100, 7, 5, 3)])
@pytest.mark.parametrize("n", [3, 10])
def test_contaminated_words(spark, monkeypatch, segment, block, at_once, part, n):
    for k, v in (("SEGMENT", segment), ("BLOCK", block), ("AT_ONCE", at_once), ("PART", part)):
        monkeypatch.setattr(positional_index, k, v)
    docs, items = tables(segment + n)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in positional_index.contaminated(d.repartition(3), i, n).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)
    assert got == sorted(((x, w, len(h), len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), bool(h)) for x, w, h, f in hits(docs, items, n)), key=repr)


def test_proximity(spark):
    docs = [(1, "the red fox x jumps"), (2, "fox red the"), (3, "red"), (4, "jumps the red y fox jumps"), (5, "the red fox jumps")]
    items = [(9, "the red fox jumps")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = positional_index.build_index(d)
    found = lambda slack: {r.doc_id for r in positional_index.search(index, i, 4, slack).collect() if r["items"]}
    assert found(0) == {5} and found(1) == {1, 4, 5} and found(9) == {1, 4, 5}  # no document but those has all four words


def test_windows_stay_within_documents(spark):
    d = spark.createDataFrame([(k, t) for k, t in enumerate(["a b", "c d", "b", "c"])], "doc_id long, text string").coalesce(1)
    i = spark.createDataFrame([(1, "b c"), (2, "c d")], "item_id long, text string")
    index = positional_index.build_index(d)
    assert [r["items"] for r in positional_index.search(index, i).orderBy("doc_id").collect()] == [[], ["2"], [], []]
    assert [r["items"] for r in positional_index.search(index, i, slack=3).orderBy("doc_id").collect()] == [[], ["2"], [], []]


def test_decontamination_of_odd_tables(spark):
    d = spark.createDataFrame([(1, "a b c", "x", 5, "y")], "doc_id long, text string, seg string, at int, items string")
    i = spark.createDataFrame([(1, "B C", 3, "z")], "item_id long, text string, block int, words string")
    assert tuple(positional_index.contaminated(d, i).select("doc_id", "n_words", "n_hit", "n_items").first()) == (1, 3, 2, 1)
    assert positional_index.contaminated(d.limit(0), i).count() == 0
    assert tuple(positional_index.contaminated(d, i.limit(0)).select("n_words", "n_hit", "contaminated").first()) == (3, 0, False)


# --- conversation repair ---


def damage(rows):
    out, said = [], lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        k, r, x = zlib.crc32(f"{said(c)}:{said(t)}".encode()) % 20, said(r), said(x)
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def cheapest(turns):
    """Least (cost, audit, repaired) of all edits one by one, audits as whole texts; two inserts at one place at most, since a third repeats a state."""

    @functools.cache
    def go(at, state, inserted):
        best = [(0, "", ())] if at == len(turns) and state in (0, 3) else []
        after = 3 if state == 2 else 2
        name = "user" if after == 2 else "assistant"
        if at < len(turns):
            initial, fault, role, text = turns[at]
            c, a, r = go(at + 1, state, 0)
            best.append((c + 3, "D" + a, r))
            if fault not in (1, 2):
                more = int(fault == 3)
                to = {"s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(initial)
                if to is not None:
                    c, a, r = go(at + 1, to, 0)
                    best.append((c + more, "K" + a, (f"{role}:{text}", *r)))
                c, a, r = go(at + 1, after, 0)
                best.append((c + 2 + more, "R" + a, (f"{name}:{text}", *r)))
        if inserted < 2:
            c, a, r = go(at, after, inserted + 1)
            best.append((c + 2, "I" + a, (f"{name}:", *r)))
        return min(best) if best else (10**9, "", ())

    return go(0, 0, 0)


def repaired(rows):
    talks = defaultdict(list)
    for c, *_ in rows:
        talks[c] = []
    for r in damage(rows):
        talks[r[0]].append(r)
    out = []
    for c, rs in talks.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, turns = set(), []
        for _, _, r, x in rs:
            core = x.strip(" \t\n\x0b\x0c\r")
            turns.append((r[:1], 1 if not core else 2 if (r, x) in seen else 3 if core[-1] not in ".!?" else 0, r, x))
            seen.add((r, x))
        known = [t for _, t, _, _ in rs if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit, text = cheapest(tuple(turns))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        out.append((c, gaps, *(sum(t[1] == k for t in turns) for k in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(out, key=repr)


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversations(seed):
    rng = random.Random(seed)
    return [(c, rng.choice([k, k, k, None, k + 1]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(["Hi.", "Yes!", "No", "  ", "", None, "Hi.", "x? \n", "ok. "])) for c in [None, *range(80)] for k in range(rng.choice([1, 2, 3, 6, 10, 14]))]


@pytest.mark.parametrize("most, partitions", [(None, "4"), (1, "3"), (3, "7")])
def test_repair(spark, most, partitions):
    """Chunks of a turn, and conversations that lie in several partitions."""
    rows = conversations(most or 0)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = conversation_repair.repair(conversation_repair.damaged(df), df, most).select(RESULT).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=repr) == repaired(rows)


def test_one_conversation_with_many_equal_rows(spark):
    """Copies are counted, not carried; a conversation of thousands of turns is cut into chunks."""
    rows = [(1, 0, "user", "Again.", 5000), (1, 1, "assistant", "Yes.", 1), (1, 2, "user", " ", 700)] + [(2, k, "user" if k % 2 == 0 else "assistant", f"{k}.", 1) for k in range(9000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n long")
    got = {r.conv_id: r for r in conversation_repair.repair(df, df).collect()}
    assert (got[1].audit, got[1].cost, got[1].duplicate, got[1].blank, got[1].illegal) == ("K" + "D" * 4999 + "K" + "D" * 700, 3 * 5699, 4999, 700, 4999 + 699)
    assert (got[2].audit, got[2].cost, got[2].gaps) == ("K" * 9000, 0, 0)
    text = "\n".join(f"{'user' if k % 2 == 0 else 'assistant'}:{k}." for k in range(9000))
    assert got[2].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_repair_of_odd_tables(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversation_repair.repair(conversation_repair.damaged(empty), empty).count() == 0
    gone = next(t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    clash = spark.createDataFrame([(7, gone, "user", "x.", 1, "y", "z")], "conv_id long, turn long, role string, text string, n int, chunk string, fault string")
    assert tuple(conversation_repair.repair(conversation_repair.damaged(clash), clash).select(RESULT).first()) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_macros_are_ordered_and_prefix_free():
    assert conversation_repair.CODES == sorted(conversation_repair.CODES)
    assert not any(a != b and b.startswith(a) for a in conversation_repair.CODES for b in conversation_repair.CODES)


def test_segments_are_told_their_frequent_pairs_in_one_row_a_batch(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", 2000)
    docs = spark.createDataFrame([(k, "en", "aa bb cc dd ee ff. " * 3 + f"w{k} aa") for k in range(400)], "doc_id long, lang string, text string").coalesce(2)
    level2 = collocations.pairs(level1 := collocations.segments(docs), collocations.frequent_words(level1, 10))
    lists = collocations.pair_rows(level2)
    often = {(r.a, r.b): (r.id, r.f) for r in lists.groupBy("a", "b").agg(F.min("code").alias("id"), F.sum("n").alias("f")).where("f >= 10").collect()}
    known = collocations.frequent_pairs(level2, 10).collect()
    assert {(r.a, r.b): (r.id, r.f) for r in known if r.id is not None} == often
    told = {(r.seg << collocations.OF_LIST) + p: i for r in known if r.id is None for p, i in zip(memoryview(r.places).cast("i"), memoryview(r.ids).cast("q"), strict=True)}
    want = {r.code: often[r.a, r.b][0] for r in lists.collect() if (r.a, r.b) in often}
    assert told == want and len(known) < len(want)
