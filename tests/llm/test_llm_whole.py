"""The near-duplicate stage and the classifier against brute force, with the limits of buckets forced small."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corvane.llm import ann, html_extract, imatch, mixing, packing, shared_windows, simhash, suffix_array, suffix_tree, toxicity
from corvane.llm.components import components

rng = random.Random(11)


def shingles(text, n=5):
    w = text.lower().split()
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}


def near(a, b, similarity=0.8):
    a, b = shingles(a), shingles(b)
    return len(a & b) >= similarity * len(a | b)


def stays(texts, joined):
    """The smallest id of each component of the pairs that joined says yes to."""
    par = {d: d for d in texts}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if find(a) != find(b) and joined(a, b):
            par[max(find(a), find(b))] = min(find(a), find(b))
    return {d for d in texts if find(d) == d}


def edited_copies(groups=6, copies=25, words=260):
    """Texts of which each has up to nine words changed: pairs lie on both sides of the similarity of 0.8."""
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 3000)}" for _ in range(words)]
        for _ in range(copies):
            t = list(base)
            for k in rng.sample(range(words), rng.randint(0, 9)):
                t[k] = f"x{rng.randint(0, 10**6)}"
            texts.append(" ".join(t))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("few, crowded, dense", [(16, 16_384, 8), (2, 16_384, 1000), (2, 8, 0), (2, 8, 1)])
def test_every_pair_within_the_radius_is_checked(spark, monkeypatch, few, crowded, dense):
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "DENSE", dense, raising=False)
    texts = edited_copies()
    fp = {d: simhash.simhash(t, 5) & (1 << 64) - 1 for d, t in texts.items()}
    most = stays(texts, lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 11 and near(texts[a], texts[b]))
    least = stays(texts, lambda a, b: near(texts[a], texts[b]))  # a forest may also join similar texts beyond the radius
    got = simhash.keep_one_of_each(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert least <= {r.doc_id for r in got.collect()} <= most


def test_toxicity_features_are_told_apart(spark):
    words = [f"{''.join(rng.choice('abcdefghij') for _ in range(9))}" for _ in range(400)]
    rows = [(i, " ".join(rng.sample(words, 40)) + (" vilething" if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int"))
    known = {h for _, t in rows for w in toxicity.text_words(t) for h in toxicity.word_features(w)}
    assert set(model.index) <= known
    unseen = {"".join(rng.choice("klmnopqrst") for _ in range(12)) for _ in range(20_000)}
    assert not [w for w in unseen if any(h in model.index for h in toxicity.word_features(w))]
    one = model.scorer()
    assert one(" ".join(unseen)) == one("")


def test_labels_without_a_document_use_no_place_in_the_sample(spark):
    rows = [(i, "some plain words here" + (" vilething" if i % 2 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20_000)], "doc_id long, toxic int")
    one = toxicity.train(docs, labels, sample=100).scorer()
    assert one("vilething") > 0.9 and one("some plain words here") < 0.1


CLASHING = ["copies", "copy", "n", "size", "row", "gone_id", "twice_id", "_text", "_toxicity", "fp", "node", "same", "g", "rid", "kept", "bucket", "unit", "html_", "capture", "_size", "_copy", "t", "next"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, repeated rows, ties, a very long text, and columns named like the operators' own."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 120))) for _ in range(60)] + [None, "", " ", "x", " ".join(r.choice(words) for _ in range(60_000))]
    rows = [(i, t, None if i % 9 == 0 else "en", [None, "a", "b", "c"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], "en", "a", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"mine {c}") for c in CLASHING}).cache()


@pytest.fixture(scope="module")
def toxic_labels(spark):
    return spark.createDataFrame([(i, i % 3 == 0) for i in range(60)] + [(None, True), (7, None), (999, True)], "doc_id long, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))


def test_operators_take_odd_tables(spark, odd, toxic_labels):
    n = odd.count()
    assert mixing.mix(odd).count() == packing.pack(odd).select("doc_id").where("start = 0").count() == simhash.near_duplicates(odd).count() == n
    assert suffix_tree.dedup(odd).count() == suffix_array.dedup(odd).count() == imatch.edited_pairs(odd).count() == n
    model = toxicity.train(odd, toxic_labels)
    scores = [r.score for r in toxicity.score(odd, model, ["doc_id"]).collect()]
    assert len(scores) == n and all(0 <= s <= 1 for s in scores)
    assert not any(r.h is None for r in odd.select(toxicity.held_out(F.col("doc_id")).alias("h")).collect())
    for empty in (mixing.mix, packing.pack, simhash.near_duplicates, suffix_tree.dedup, suffix_array.dedup, imatch.edited_pairs):
        assert empty(odd.limit(0)).count() == 0
    assert toxicity.score(odd.limit(0), toxicity.train(odd.limit(0), toxic_labels.limit(0)), ["doc_id"]).count() == 0


@pytest.mark.parametrize("stage", ["toxicity", "simhash", "suffix_array", "mixing", "packing"])
def test_stages_keep_other_columns(spark, odd, toxic_labels, tmp_path, stage):
    import corpus_pipeline

    toxic_labels.write.parquet(f"{tmp_path}/labels.parquet")
    f = dict(corpus_pipeline.STAGES)[stage]
    got = f(spark, odd, str(tmp_path))
    rows = got.collect()
    assert rows and f(spark, odd.limit(0), str(tmp_path)).count() == 0
    if stage != "packing":
        assert got.columns == odd.columns and all(r[c] == f"mine {c}" for r in rows for c in CLASHING)
        assert {r.source for r in rows} <= {None, "a", "b", "c"}


def test_mix_takes_repeated_rows_one_by_one(spark):
    rows = [(1, "a b c", "s")] * 40 + [(k, "a b c d", "t") for k in range(2, 30)] + [(None, "a b", "u")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    took = {r.source: r.n for r in mixing.mixed(df).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    want = {r.source: r.target for r in mixing.mix(df).select("source", "target").distinct().collect()}
    assert all(abs(took[s] - want[s]) <= 4 for s in want)


def test_lexicon_is_exact_and_hashes_are_of_its_subsets(spark, odd, monkeypatch):
    """Fingerprints and likeness by hand; the same when the lexicon meets the terms in a join."""
    docs = odd.select("doc_id", "text").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    terms = {d: {xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[\s!-/:-@\[-`{-~]+", t.lower()) if w} for d, t in texts.items()}
    df: dict = {}
    for ts in terms.values():
        for t in ts:
            df[t] = df.get(t, 0) + 1
    band = {t for t, k in df.items() if max(2, 0.05 * len(texts)) <= k <= 0.3 * len(texts)}

    def fingerprint(ts):
        signed = lambda t: t - (1 << 64) if t >> 63 else t
        kept = sorted(ts & band or ts, key=signed)
        out = []
        for k, bit, n, splits in imatch.LEVELS:
            for j in range(splits):
                for g in range(n):
                    mine, h = [t for t in kept if (t >> (bit + j * k)) & ((1 << k) - 1) == g], 42
                    for t in mine:
                        h = xxhash.xxh64_intdigest(t.to_bytes(8, "little"), h)
                    out.append(f"{h:016x}" if mine else "0" * 16)
        return "".join(out)

    got = {r.doc_id: r for r in imatch.edited_pairs(docs, low=0.05, high=0.3).collect()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: fingerprint(ts) for d, ts in terms.items()}
    order = sorted(texts, reverse=True)
    for d, after in zip(order, order[1:] + order[:1], strict=True):
        a, b = ([x[k : k + 16] for k in range(0, len(x), 16)] for x in (got[d].fingerprint, got[after].fingerprint))
        weight = [1 << k for k, _, n, splits in imatch.LEVELS for _ in range(n * splits)]
        touched = sum(w for x, y, w in zip(a, b, weight, strict=True) if x.strip("0") or y.strip("0"))
        equal = sum(w for x, y, w in zip(a, b, weight, strict=True) if x == y and x.strip("0"))
        assert abs(got[d].near_next - (equal / touched if touched else 1.0)) < 1e-12
    monkeypatch.setattr(imatch, "LITERAL", 0)
    again = {r.doc_id: tuple(r) for r in imatch.edited_pairs(docs, low=0.05, high=0.3).collect()}
    assert again == {d: tuple(r) for d, r in got.items()}


def test_extraction_is_linear_and_keeps_the_article():
    pages = {
        '<div class="content"><p>One, two, three four five six.</p><div class="alert alert-info">Mind the gap, please.</div><p>Seven <math><mi>x</mi></math> eight, nine ten.</p></div><div class="sidebar">Links</div>': "One, two, three four five six.\nMind the gap, please.\nSeven x eight, nine ten.",
        "<article><h1>T</h1><p>A long, long text with commas, and more.</p><div class='ad'>Buy</div><div class='comments'><p>Me, too!</p></div></article>": "T\nA long, long text with commas, and more.",
        "<form><div class='menu'>x</div><main><p>In a page that is one form, really.</p></main></form>": "In a page that is one form, really.",
        "<p>a &lt; b &amp; c <b>bold</b> text<p>next": "a < b & c bold text\nnext",
        "<p>cut off <a href='x": "cut off",
        '<p title="a>b">Quoted, fine.</p><p data-x=it\'s>Odd quote.</p>': "Quoted, fine.\nOdd quote.",
        "<p>one<script>var a='</p>';</script> two</p>": "one two",
        "<ul><li>a, b<li>c</ul><p>Some text that is long enough, to count as prose, here.</p>": "a, b\nc\nSome text that is long enough, to count as prose, here.",
    }
    for html, want in pages.items():
        assert html_extract.main_text(html) == want, html
    import time

    for piece in ("<a ", "<b></i>", "<div>a, b ", "<svg>", '<a b="', "<!-- x", "<li>a ", "<header>a "):
        took = []
        for size in (100_000, 800_000):
            page = piece * (size // len(piece))
            began = time.process_time()
            html_extract.main_text(page)
            took.append(time.process_time() - began)
        assert took[1] < 24 * took[0] + 0.5, piece  # 8 times the page, not 64 times the time


def test_queries_ask_a_few_at_a_time(spark, monkeypatch):
    assert ann._lists([np.array([3, 1]), np.zeros(0, np.int64), np.array([7])]).to_pylist() == [[3, 1], [], [7]] and ann._lists([]).to_pylist() == []
    v = np.random.default_rng(2).normal(size=(300, 8))
    base = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    found = lambda: sorted(map(tuple, ann.nearest(base, base.where("vec_id % 5 = 0"), k=5).collect()))
    want = found()
    monkeypatch.setattr(ann, "ASKED", 7)
    assert found() == want and len(want) == 300


@pytest.mark.parametrize("radius, parts", [(4, 1), (11, 2)])
def test_every_table_has_a_long_key(radius, parts):
    assert min((m & (1 << 64) - 1).bit_count() for m in simhash.masks(radius, parts=parts)) >= 16


def test_roots_are_joined_with_nodes_not_with_bucket_rows(spark, monkeypatch):
    seen = []
    rest = simhash.rest_links
    monkeypatch.setattr(simhash, "rest_links", lambda rows, *a: seen.append(rows._jdf.queryExecution().optimizedPlan().toString()) or rest(rows, *a))
    monkeypatch.setattr(simhash, "FEW", 2)
    monkeypatch.setattr(simhash, "DENSE", 0)
    texts = edited_copies(groups=2, copies=12)
    simhash.keep_one_of_each(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    assert seen and "Join" not in seen[0]


def test_a_pair_of_near_copies_is_a_row_of_one_table(spark):
    """The forests of a group's buckets give each link once, not once in each of the tables where its ends meet."""
    r = random.Random(4)
    base, apart = r.getrandbits(63), [r.getrandbits(63) for _ in range(40)]
    fps = list({base ^ sum(1 << b for b in r.sample(range(63), r.randint(1, 5))) for _ in range(150)} | {*apart})
    nodes = spark.createDataFrame(list(enumerate(fps)), "node long, fp long")
    got = [tuple(x) for x in simhash.bucket_links(simhash.bucket_tables(nodes, 11, 2), 11, 2, every=True).collect()]
    links = [x for x in got if x[1] is not None]
    ends = {x for pair in links for x in pair}
    close = lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 11
    assert len(links) == len({*links}) < len(got) < 25 * len(fps)
    assert ends >= {a for a in range(len(fps)) if any(a != b and close(a, b) for b in range(len(fps)))}
    joined = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(joined.get(a, a) == joined.get(b, b) for a in range(len(fps)) for b in range(a) if close(a, b))


def test_strings_of_op8_are_on_disk_once(spark, monkeypatch):
    """They go from the chunks straight to the places that compare them; where those runs are goes along."""
    tables, plain = [], shared_windows.settle_kinds
    monkeypatch.setattr(shared_windows, "settle_kinds", lambda df, name: tables.append(name) or plain(df, name))
    rows = [(i, f"start {i} " + "a passage of many documents that is long enough to be a window " * 2) for i in range(20)]
    got = {r.doc_id: r.n_removed for r in suffix_array.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert tables == ["windows-chunks"] and got[0] == 0 and all(got[i] > 100 for i in range(1, 20))


def test_sketches_leave_out_no_similar_pair():
    r = np.random.default_rng(4)
    kept = 0
    for _ in range(400):
        x = np.unique(r.integers(0, 1 << 32, r.integers(0, 300), np.uint32))
        y = np.union1d(x[r.random(len(x)) > r.random() * 0.3], r.integers(0, 1 << 32, r.integers(0, 12), np.uint32))
        common = len(np.intersect1d(x, y))
        may = simhash.may_be_similar(np.array([simhash.sketch(x)]).T, np.array([simhash.sketch(y)]).T, 0.8)[0]
        assert may or common < 0.8 * (len(x) + len(y) - common)
        kept += may
    assert 50 < kept < 350
