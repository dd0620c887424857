"""The training-data operators against brute force, round trips and edge cases on small fixtures."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from corvane.llm import ann, html_extract, imatch, mixing, packing, queries, shared_windows, simhash, suffix_array, suffix_tree, toxicity, warc
from corvane.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
PASSAGE = " ".join(rng.choice(VOCAB) for _ in range(60))


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [prose(rng.randint(1, 200)) for _ in range(120)]
    texts += [texts[3], texts[3], texts[7] + " end", texts[9].replace("a", "e", 2), "", None, "x", "é" * 60, "é" * 61 + "z", " \t\n", PASSAGE, prose(20) + " " + PASSAGE + "\n" + prose(10), "Ünï " + PASSAGE.upper() + " " + PASSAGE, "ab " * 300, "ab " * 310]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", None, "ß"]), len(t or ""), "more") for i, t in enumerate(texts)]
    rows += [(None, PASSAGE, "en", "a", 1, None), (5, rows[5][1], "en", "a", 1, "again")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def windows(rows, units, n):
    """doc_id, units, which are covered by a window that starts in a smaller document."""
    big = 2**63 - 1
    first: dict = {}
    for d, t in rows:
        u = units(t)
        for k in range(len(u) - n + 1):
            w = tuple(u[k : k + n])
            first[w] = min(first.get(w, big), big if d is None else d)
    for d, t in rows:
        u = units(t)
        gone = np.zeros(len(u), bool)
        for k in range(len(u) - n + 1):
            if first[tuple(u[k : k + n])] < (big if d is None else d):
                gone[k : k + n] = True
        yield d, u, gone


def test_suffix_array(docs):
    want = sorted(((d, len(u), int(g.sum()), len(shared_windows.spans(g)), hashlib.sha256(bytes(np.array(u, np.uint8)[~g])).hexdigest()) for d, u, g in windows(rows_of(docs), lambda t: list(t.encode()), 50)), key=str)
    assert sorted(map(tuple, suffix_array.dedup(docs).collect()), key=str) == want
    assert sum(w[2] for w in want)


def test_suffix_array_splits_hot_minimisers(docs, monkeypatch):
    monkeypatch.setattr(shared_windows, "CHUNK", 2000)
    want = sorted(map(tuple, suffix_array.dedup(docs).collect()), key=str)
    texts = [t.encode() for _, t in rows_of(docs)]
    u = shared_windows.Bytes()
    data, sizes, codes = u.stream(texts)
    for a, z, key, ok, start, n, k in shared_windows.all_runs(u, codes, sizes):
        covered = np.zeros(z - a, int)
        for s, m in zip(start - a, n, strict=True):
            covered[s : s + m] += 1
        assert (covered == ok).all() and (n <= shared_windows.RUN).all()
    assert want


def test_trimmed(docs):
    got = suffix_array.trimmed(docs)
    assert got.columns == docs.columns
    kept = {(r.doc_id, r.extra): r for r in got.collect()}
    assert len(kept) == docs.count() and kept[(None, None)].text == "" and all(r.n_chars == len(r.text) for r in kept.values())
    assert suffix_array.trim("aéb".encode(), np.array([1, 1, 0, 0], bool)) == "éb"


def words_kept(docs):
    return sorted(((d, len(u), int(g.sum()), hashlib.sha256(b" ".join(w for w, x in zip(u, g, strict=True) if not x)).hexdigest()) for d, u, g in windows(rows_of(docs), lambda t: t.encode().split(), 13)), key=str)


def test_suffix_tree(docs):
    assert sorted(map(tuple, suffix_tree.dedup(docs).drop("n_spans").collect()), key=str) == words_kept(docs)


@pytest.mark.parametrize("leaves", [2, 40])
def test_suffix_tree_of_many_chunks_and_groups(docs, monkeypatch, leaves):
    """A string in every chunk, chunks put together over several levels, prefixes over the budget at any depth."""
    for name, value in (("CHUNK", 1500), ("FAN", 3), ("PART", 4000)):
        monkeypatch.setattr(shared_windows, name, value)
    monkeypatch.setattr(suffix_tree, "LEAVES", leaves)
    hot = docs.withColumn("text", F.concat(F.lit(PASSAGE + " "), F.coalesce("text", F.lit(""))))
    assert sorted(map(tuple, suffix_tree.dedup(hot).drop("n_spans").collect()), key=str) == words_kept(hot)


def test_prefix_groups_are_of_bounded_size():
    r = np.random.default_rng(3)
    codes = r.choice(np.array([5, 5, 5, 5, 7, 11, 13], np.uint64), 4000)
    starts = np.arange(len(codes) - 13)
    over = np.zeros((13, 1 << 12), bool)
    for d, h in suffix_tree.prefixes(codes, starts, 13):
        over[d] = np.bincount(suffix_tree.slot(h, 1 << 12), minlength=1 << 12) > 50
    key = suffix_tree.groups(codes, starts, over)
    _, which, n = np.unique(key, return_inverse=True, return_counts=True)
    assert len(n) > 40 and n.max() <= 50
    for g in np.unique(which)[:40]:  # equal windows are never apart
        assert len({tuple(codes[s : s + 13]) for s in starts[which == g]} & {tuple(codes[s : s + 13]) for s in starts[which != g]}) == 0


def test_subtrees():
    r = random.Random(8)
    rows = [[r.choice("ab") for _ in range(6)] for _ in range(300)]
    codes = np.array([[ord(x) for x in row] for row in rows], np.int32)
    group = codes[:, 0].astype(np.uint32)
    leaves, common = suffix_tree.subtrees(codes, group, 6)
    assert [rows[i] for i in leaves] == sorted(rows)
    for i in range(1, len(leaves)):
        a, b = rows[leaves[i - 1]], rows[leaves[i]]
        assert common[i] == (0 if a[0] != b[0] else len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(a, b, strict=True)))))


def test_suffix_array_of_many_chunks(docs, monkeypatch):
    for name, value in (("CHUNK", 1500), ("FAN", 3), ("PART", 4000), ("HOT", 4)):
        monkeypatch.setattr(shared_windows, name, value)
    hot = docs.withColumn("text", F.concat(F.lit(PASSAGE + " "), F.coalesce("text", F.lit(""))))
    want = sorted(((d, len(u), int(g.sum())) for d, u, g in windows(rows_of(hot), lambda t: list(t.encode()), 50)), key=str)
    assert sorted(map(tuple, suffix_array.dedup(hot).select("doc_id", "n_bytes", "n_removed").collect()), key=str) == want


def test_trimmed_keeps_other_columns_as_they_are(spark):
    rows = [(2**63 - 1, PASSAGE), (None, PASSAGE), (1, PASSAGE), (3, "z" * 120_000), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("mine")).withColumn("more", F.lit(1.5)).withColumn("at", F.lit("2024-01-02 03:04:05.678901").cast("timestamp")).withColumn("chunk", F.lit(None).cast("string"))
    got = suffix_array.trimmed(df)
    assert got.schema == df.schema or got.columns == df.columns
    out = got.collect()
    assert {r.doc_id for r in out} == {2**63 - 1, None, 1, 3} and all(r.at.microsecond == 678901 and r.kept == "mine" and r.more == 1.5 and r.chunk is None for r in out)
    assert {r.text for r in out if r.doc_id in (None, 2**63 - 1)} == {""}
    assert suffix_array.trimmed(df.limit(0)).count() == 0
    assert {r.doc_id for r in suffix_array.dedup(df.select("doc_id", "text")).collect()} == {2**63 - 1, None, 1, 3}
    assert suffix_tree.dedup(df.limit(0)).count() == 0 and suffix_tree.kept_text(df).count() == 5


def test_solvers_agree_with_brute_force():
    r = random.Random(1)
    for _ in range(15):
        strings = [bytes(r.choice(b"ab") for _ in range(r.randint(6, 40))) for _ in range(12)]
        ids = np.array([r.randint(0, 20) for _ in strings])
        want = [min(int(i) for i, t in zip(ids, strings, strict=True) if s[k : k + 6] in t) for s in strings for k in range(len(s) - 5)]
        value, n = suffix_array.smallest_ids(6)(strings, ids, np.zeros(len(ids), np.uint32))
        assert value.tolist() == want and n.sum() == len(want)
        starts = [(s[k : k + 6], int(i)) for s, i in zip(strings, ids, strict=True) for k in range(len(s) - 5)]
        words = [np.array(list(w), np.int32).tobytes() for w, _ in starts]
        keys = np.array([w[0] for w, _ in starts], np.uint32)
        assert suffix_tree.smallest_ids(6)(words, np.array([i for _, i in starts]), keys)[0].tolist() == want


def test_strings_alone_with_their_key_are_not_sorted(monkeypatch):
    order, sizes = suffix_array.suffix_order, []
    monkeypatch.setattr(suffix_array, "suffix_order", lambda t, depth: sizes.append(len(t)) or order(t, depth))
    strings = [b"abababab", b"ghijklmn", b"hijklmno", b"pqrstuv"]
    value, n = suffix_array.smallest_ids(6)(strings, np.array([5, 4, 3, 9]), np.array([1, 2, 2, 7], np.uint32))
    assert value.tolist() == [5, 5, 5, 4, 3, 3, 3, 3, 3, 9, 9] and n.tolist() == [3, 3, 3, 2]
    assert sizes == [len(b"ghijklmn-hijklmno--")]
    value, n = suffix_array.smallest_ids(6)(strings[:1], np.array([5]), np.array([1], np.uint32))
    assert value.tolist() == [5, 5, 5] and n.tolist() == [3] and len(sizes) == 1
    r = random.Random(3)
    for _ in range(15):  # keys are the letters of a string
        keys = np.sort(np.array([r.randint(0, 12) for _ in range(14)], np.uint32))
        strings = [bytes(r.choice([65 + 2 * k, 66 + 2 * k]) for _ in range(r.randint(6, 40))) for k in keys.tolist()]
        ids = np.array([r.randint(0, 20) for _ in strings])
        want = [min(int(i) for i, t in zip(ids, strings, strict=True) if s[k : k + 6] in t) for s in strings for k in range(len(s) - 5)]
        assert suffix_array.smallest_ids(6)(strings, ids, keys)[0].tolist() == want


def test_common_prefixes():
    t = np.frombuffer(b"banana$bandana\xff\xfe", np.uint8)
    sa = suffix_array.suffix_order(t, 50)
    text = bytes(t)
    assert sa.tolist() == sorted(range(len(t)), key=lambda i: text[i:])
    lcp = suffix_array.boundaries(t, sa, 3)
    for i in range(1, len(t)):
        a, b = text[sa[i - 1] :], text[sa[i] :]
        n = len(list(itertools.takewhile(lambda p: p[0] == p[1], zip(a, b, strict=False))))
        assert lcp[i] == (n if n < 3 else 255)


def test_masks_cover():
    ms = [m & (2**64 - 1) for m in simhash.masks(4)]
    halves = [m & (2**64 - 1) for m in simhash.masks(11, parts=2)]
    r = random.Random(2)
    for _ in range(300):
        for some, n in ((ms, 4), (halves, 11)):
            x = sum(1 << b for b in r.sample(range(64), n))
            assert any(m & x == 0 for m in some)


def test_simhash(docs, spark):
    def fp(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        s = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = [(d, fp(t)) for d, t in rows_of(docs) if d is not None]
    par = {d: d for d, _ in rows}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for (a, x), (b, y) in itertools.combinations(rows, 2):
        if (x ^ y).bit_count() <= 4 and find(a) != find(b):
            par[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect() if r.doc_id is not None}
    assert all(got[d].fp & (2**64 - 1) == x and got[d].component_id == find(d) for d, x in rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", 8)
    monkeypatch.setattr(simhash, "FEW", 4)
    r = random.Random(3)
    fps = list({r.getrandbits(30) ^ sum(1 << b for b in r.sample(range(64), k % 4)) for k in range(60)} | {sum(1 << b for b in r.sample(range(64), 2)) for _ in range(60)})
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, node long")
    got = {x.node: x.root for x in components(simhash.link_fingerprints(nodes)).collect()}
    par = list(range(len(fps)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 4 and find(a) != find(b):
            par[max(find(a), find(b))] = min(find(a), find(b))
    assert [got.get(i, i) for i in range(len(fps))] == [find(i) for i in range(len(fps))]


def test_components(spark):
    links = [(2, 1), (3, 2), (4, 3), (9, 8), (8, 7), (9, 5), (6, 4), (20, 6), (20, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {2: 1, 3: 1, 4: 1, 6: 1, 20: 1, 9: 1, 8: 1, 7: 1, 5: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_of_each(docs):
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.collect()}
    by_text: dict = {}
    for d, t in rows_of(docs):
        if d is not None:
            by_text.setdefault(t, set()).add(d)
    for ids in by_text.values():
        assert len(got & ids) <= 1
    alone = [min(i) for t, i in by_text.items() if len(t.split()) > 30]
    assert len([i for i in alone if i in got]) >= len(alone) - 6 and None in got
    assert kept.where("doc_id = 5").count() == 1


def test_mix(docs, spark):
    got = [r for r in mixing.mix(docs).collect()]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((d, words(t)) for d, t in rows_of(docs)), key=str)
    total = sum(r.size for r in got)
    by: dict = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, Fraction(total), set(names)
    while True:  # reshare until no target is above its stop
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * by[s][0].source_size}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = Fraction(3 * by[s][0].source_size)
            left -= target[s]
        open_ -= over
    for s, rs in by.items():
        assert abs(rs[0].target - float(target[s])) < 1e-6 * max(1, rs[0].target)
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(3, 0.02 * rs[0].target)
        assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rs)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))
    assert mixing.mix(docs.limit(0)).count() == 0
    out = mixing.mixed(docs.where("doc_id IS NOT NULL"))
    assert out.columns == docs.columns and out.count() > 0


def test_pack(docs):
    got = packing.pack(docs).collect()
    encode = packing.Encoder()
    ids = sorted(([*encode.slow.encode(t, add_special_tokens=False).ids, 1] for _, t in rows_of(docs)), key=str)
    assert all(encode(t).tolist() == encode.slow.encode(t, add_special_tokens=False).ids for _, t in rows_of(docs)) and encode("a <|endoftext|> b").tolist()[2] in (220, 50256)
    assert sum(map(len, ids)) == sum(r.length for r in got)
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for rs in by.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    single = [r for r in got if r.start == 0 and r.length == r.doc_tokens]
    crcs = {zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids}
    assert single and all(r.ids_crc32 in crcs for r in single)
    assert packing.pack(docs.limit(0)).count() == 0


def test_near_equal_windows():
    r = random.Random(4)
    for _ in range(20):
        sizes = np.array([r.randint(1, 512) for _ in range(r.randint(1, 120))])
        items = packing.near_equal_windows(sizes, 2048)
        assert sorted(i for x in items for i in x) == list(range(len(sizes)))
        assert all(sizes[x].sum() <= 2048 for x in items) and len(items) <= -(-sizes.sum() // 2048) + 2
    sums, _ = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sums.tolist()) == [14, 16]  # the classic example


def test_imatch(docs, spark):
    got = {r.doc_id: r for r in imatch.edited_pairs(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()}
    rows = sorted(((d, t) for d, t in set(rows_of(docs)) if d is not None), reverse=True)
    for k, (d, t) in enumerate(rows):
        nxt, half = rows[(k + 1) % len(rows)], len(t) // 2
        assert got[d].edited_sha256 == hashlib.sha256((t[: len(t) - half] + nxt[1][:half]).encode()).hexdigest() and got[d].n_chars == len(t)
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    same: dict = {}
    for d, t in rows:
        same.setdefault(t, set()).add(got[d].fingerprint)
    assert all(len(x) == 1 for x in same.values())
    long = imatch.edited_pairs(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).where("n_chars > 300").collect()
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
    assert imatch.edited_pairs(docs.limit(0)).count() == 0 and imatch.edited_pairs(docs).count() == docs.count()


def test_extract(spark):
    cases = {
        "<html><head><title>t</title><script>var a='<p>'</script></head><body><nav><a href=x>Home</a></nav><div class='ad'>Buy, now, all</div><article><h1>Head &amp; line</h1><p><b>One,  two<br><p>Three</p>short<ul><li>point</ul></article><div id=comments><p>I, a reader, say, so much, and more, and more.</p></div><footer>f</footer>": "Head & line\nOne, two\nThree\nshort\npoint",
        "<div class=top><a href=a>a</a><a href=b>b</a></div><div class=story><p>First long sentence, with commas, and words.</p><p>Second one, also long enough.</p></div><div class=sidebar><p>Other, things, here, many, commas.</p></div>": "First long sentence, with commas, and words.\nSecond one, also long enough.",
        None: "", "": "", "just text": "just text", "<p>a&#233;&nbsp;b": "aé b", "<table><tr><td>x, y<td>z</table>": "x, y\nz", "<div>" * 3000 + "deep": "deep", "<p>cut <a href='": "cut",
    }
    df = spark.createDataFrame([(i, None, h) for i, h in enumerate(cases)], "page_id long, url string, html string")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    for i, want in enumerate(cases.values()):
        assert got[i].text == want and got[i].n_chars == len(want)


def test_warc(spark):
    rows = [(1, "http://a/", "<p>x</p>\r\n\r\nWARC/1.1\r\n", "q"), (2, None, None, "q"), (3, "http://b/ c\r\nd", "", "q"), (4, "x", "<p>x</p>\r\n\r\nWARC/1.1\r\n", None), (None, "y", "zz", None), (6, "u", "é\n" * 5000, None), (4, "x", "<p>x</p>\r\n\r\nWARC/1.1\r\n", None)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string, digest string")).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = next((h or "") for i, _, h, _ in rows if i == r.page_id).encode()
        assert r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert {r.page_id: (r.record_type, r.refers_to) for r in got} == {1: ("revisit", 4), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), None: ("response", None), 6: ("response", None)}
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_records_by_their_length():
    def record(kind, block, length=None, name=b"WARC/1.1"):
        return name + b"\r\nWARC-Type: " + kind + b"\r\nContent-Length: " + str(len(block) if length is None else length).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    blocks = [b"", b"\r\n", b"a\r\n\r\nb", b"x\r\n\r\n", b"\r\n\r\n\r\n", record(b"inner", b"y"), b"z" * 5000, b"end\r"]
    whole = b"".join(record(b"t", x, name=b"WARC/1.0" if k % 2 else b"WARC/1.1") for k, x in enumerate(blocks))
    assert [b for _, b in warc.parse_records(whole)] == blocks
    broken = record(b"a", b"1") + record(b"b", b"22", 99999)[:40] + b"\r\n\r\n" + record(b"c", b"3", "x") + record(b"d", b"4") + record(b"e", b"5" * 50)[:60]
    assert [h["warc-type"] for h, _ in warc.parse_records(broken)][0] == "a" and "d" in [h["warc-type"] for h, _ in warc.parse_records(broken)]


def test_oracles(spark):
    import duckdb

    sf, c = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLES.items():
        rel = c.sql(sql)
        names = [d[0] for d in rel.description]
        got = queries.QUERIES[name](spark, sf)
        assert sorted(got.columns) == sorted(names)
        assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == sorted(rel.fetchall(), key=str), name


def test_toxicity(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        bad = r.random() < 0.3
        text = prose(r.randint(5, 60)) + (f" vilething {prose(3)}" if bad else "") + (" women" if r.random() < (0.8 if bad else 0.05) else "")
        rows.append((i, text))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int"))
    got = {x.doc_id: x for x in toxicity.score(docs, model, ["doc_id"]).select("doc_id", "score", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    test = [(got[i].score, y) for i, y in labels if got[i].h]
    assert all(got[i].h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in labels)
    assert np.mean([(s >= 0.7) == bool(y) for s, y in test]) > 0.95 and got[900].score == got[901].score
    one = model.scorer()
    fair = abs(np.log(one("the women met") / (1 - one("the women met"))) - np.log(one("the men met") / (1 - one("the men met"))))
    loose = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), fairness=0.0).scorer()
    assert fair < abs(np.log(loose("the women met") / (1 - loose("the women met"))) - np.log(loose("the men met") / (1 - loose("the men met")))) / 3
    assert toxicity.fit([(1, np.array([1], np.uint32), [])]).scorer()("x") > 0.5
    assert toxicity.keep_clean(docs.withColumn("score", F.lit(1)), spark.createDataFrame([], "doc_id long, toxic int")).columns == ["doc_id", "text", "score"]


def test_ann(spark):
    g = np.random.default_rng(0)
    x = g.normal(size=(600, 16)).astype(np.float32)
    x[100:180] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (720, [0.0] * 16), (740, [float("nan")] * 16), (760, [1.0] * 3), (780, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.where("vec_id % 20 = 0")).collect()
    by: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 600, 20))
    hit = 0
    for q, rs in by.items():
        s = x.astype(float) @ x[q].astype(float)
        assert [r.rank for r in rs] == list(range(1, 21)) and all(abs(r.score - s[r.vec_id]) < 1e-9 and r.vec_id != q for r in rs)
        assert [(r.vec_id) for r in rs] == [r.vec_id for r in sorted(rs, key=lambda r: (-r.score, r.vec_id))]
        best = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:20]
        hit += len({r.vec_id for r in rs} & set(best))
    assert hit >= 0.9 * 20 * len(by)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    found: dict = {}
    for r in ann.nearest(table, table.where("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = m @ m[i]
        s[i] = -np.inf
        best = set(ids[np.argsort(-s)[:20]].tolist())
        hit, total = hit + len(best & found[int(ids[i])]), total + 20
    print("recall", hit / total)
    assert hit >= 0.9 * total
    few = df.where("vec_id < 5 OR vec_id = 20")
    assert ann.nearest(few, few.where("vec_id % 20 = 0")).count() == 10 and ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    assert 0 < sizes[1] <= sizes[0] <= 200 and sizes[2] == sizes[1] and {"sequence_id", "offset"} <= set(docs.columns)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "suffix_array", "mixing", "packing"]


def test_names():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
