"""I-Match document fingerprints over an inverse-document-frequency band, with randomised lexicon subsets.

Terms are lower-cased runs without white space and ASCII punctuation. The lexicon holds exactly the terms whose share of
documents lies in a band; a document keeps its distinct terms of the lexicon, sorted (by their 64-bit hash), and each
random subset of the lexicon gives one 64-bit hash of the kept terms that it contains. Subsets hold a half, an eighth, a
32nd, a 128th or a 512th of the lexicon. The likeness of two fingerprints is the share of equal hashes among the subsets
that either document touches, where a subset weighs by the inverse of its share of the lexicon: large subsets tell
whether texts are the same, small ones how much they have in common. One measure, whatever the length of the texts.

A band with a lower share bounds the lexicon by (mean number of terms of a document / share), whatever the number of
documents. It is counted; up to LITERAL terms it travels with the expressions, as sorted hashes in buckets, and a longer
one meets the documents' terms in a join. DataFrame functions only.

Defined cases: null text is empty; a text without lexicon terms keeps all its terms; a text without terms has the
fingerprint of zeros; two fingerprints of zeros have likeness 1; repeated rows each count as a document; an empty table
gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_partitions, settle, small

SPLIT = r"[\s\p{Punct}]+"
#: A lexicon of no more terms than this travels with the expressions, in 2^BUCKETS buckets.
LITERAL, BUCKETS = 1 << 17, 14
#: Subsets of each level: (subsets hold 1 in 2^k terms of the lexicon, first bit of a term's hash that tells which, number of subsets, splits).
LEVELS = ((1, 0, 2, 4), (3, 4, 8, 1), (5, 8, 16, 1), (7, 16, 16, 1), (9, 24, 16, 1))


def let(value: Column, f) -> Column:
    """f(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text, unsorted."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT)
    return F.transform(F.array_distinct(F.filter(words, lambda w: w != "")), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = 2.0**-9, high: float = 2.0**-3, least: int = 2) -> DataFrame:
    """t: hashes of the terms found in at least ``low`` (and ``least`` documents) and at most ``high`` of all documents."""
    n = docs.count()
    df = docs.select(F.explode(terms(F.col(text_col))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    return settle(df.where((F.col("df") >= max(least, low * n)) & (F.col("df") <= high * n)).select("t"), "imatch-lexicon")


def bucketed(lex: DataFrame) -> Column:
    """A literal of the lexicon: in each bucket, by the first bits of the hash, the hashes that fall there."""
    at = F.shiftrightunsigned("t", 64 - BUCKETS)
    every = lex.sparkSession.range(1 << BUCKETS).select(F.col("id").alias("i"), F.lit(None).cast("long").alias("t"))
    found = lex.select(at.alias("i"), "t").unionByName(every).groupBy("i").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    text = found.groupBy().agg(F.array_sort(F.collect_list(F.struct("i", "ts"))).alias("all")).select(F.to_json(F.transform("all", lambda x: x["ts"]))).first()[0]
    return F.from_json(F.lit(text), "array<array<bigint>>")


def with_kept(rows: DataFrame, text_col: str, lex: DataFrame, buckets: Column | None, name: str) -> DataFrame:
    """rows with the sorted hashes of the terms that each text keeps."""

    def keep(ts: Column, known: Column) -> Column:
        return F.array_sort(F.when(F.size(known) > 0, known).otherwise(ts))

    if buckets is not None:
        inside = lambda t, b: F.array_contains(F.element_at(b, (F.shiftrightunsigned(t, 64 - BUCKETS) + 1).cast("int")), t)
        kept = let(buckets, lambda b: let(terms(F.col(text_col)), lambda ts: let(F.filter(ts, lambda t: inside(t, b)), lambda k: keep(ts, k))))
        return rows.withColumn(name, kept)
    rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "imatch-rows")
    pairs = rows.select("_row", F.explode(terms(F.col(text_col))).alias("t")).join(small(lex), "t", "left_semi")
    found = pairs.groupBy("_row").agg(F.collect_list("t").alias("_known"))  # no more than a document's distinct terms
    return rows.join(found, "_row", "left").withColumn(name, keep(terms(F.col(text_col)), F.coalesce("_known", F.array().cast("array<bigint>")))).drop("_row", "_known")


def fingerprint(kept: Column) -> Column:
    """array<bigint>: a hash for each subset, 0 for a subset without terms."""

    def hashed(xs: Column) -> Column:
        return F.when(F.size(xs) == 0, F.lit(0).cast("long")).otherwise(let(F.xxhash64(xs), lambda h: F.when(h == 0, F.lit(1).cast("long")).otherwise(h)))

    def level(xs: Column, k: int, bit: int, n: int) -> Column:
        of = lambda t: F.shiftrightunsigned(t, bit).bitwiseAND((1 << k) - 1)
        numbers = F.sequence(F.lit(0), F.lit(n - 1))
        if n == 1 << k:
            return F.transform(numbers, lambda g: hashed(F.filter(xs, lambda t: of(t) == g)))
        return let(F.filter(xs, lambda t: of(t) < n), lambda ys: F.transform(numbers, lambda g: hashed(F.filter(ys, lambda t: of(t) == g))))

    return let(kept, lambda xs: F.concat(*[level(xs, k, bit + j * k, n) for k, bit, n, splits in LEVELS for j in range(splits)]))


def as_string(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Weighed share of equal subset hashes, 0 to 1, among those that either touches."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), F.lit(0)).when(x == y, F.lit(1)).otherwise(F.lit(2)))

    def share(z: Column) -> Column:
        equal, touched, at = F.lit(0), F.lit(0), 1
        for k, _, n, splits in LEVELS:
            part = F.slice(z, at, n * splits)
            equal += F.size(F.filter(part, lambda v: v == 1)) * (1 << k)
            touched += F.size(F.filter(part, lambda v: v > 0)) * (1 << k)
            at += n * splits
        return F.when(touched > 0, equal / touched).otherwise(F.lit(1.0))

    return let(both, share)


def with_next(docs: DataFrame, payload: list[str], id_col: str = "doc_id") -> DataFrame:
    """docs with ``next``, a struct of the payload of the next document by falling id (after the last: the first).

    Ids are cut into ranges at their own quantiles, and a range is one key of a window. The largest row of each range
    also goes, as a sentinel, to the range above, whose last row it follows. Null ids come last; equal ids follow each
    other by payload. The windows without a key run over one row per range.
    """
    side = max(2, math.isqrt(4 * n_partitions(docs.sparkSession)) + 1)
    i = F.col(id_col)
    cuts = docs.agg(F.percentile_approx(id_col, [k / side**2 for k in range(1, side**2)], 10_000)).first()[0] or [0] * (side**2 - 1)
    arr = lambda xs: F.array(*[F.lit(int(x)).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda x: x < i))
    groups = F.array(*[arr(cuts[k * side : k * side + side - 1]) for k in range(side)])
    part = let(below(arr(cuts[side - 1 :: side])), lambda k: k * side + below(F.element_at(groups, k + 1)))
    keyed = docs.withColumn("part", F.when(i.isNull(), F.lit(-1)).otherwise(part))
    tops = keyed.groupBy("part").agg(F.max(id_col).alias("top"))
    down = Window.orderBy(F.col("part").desc())
    last = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.withColumn("to", F.coalesce(F.lag("part").over(down), F.min("part").over(last)))
    tops = tops.select(F.col("part").alias("t_part"), "top", "to")
    sent = keyed.join(F.broadcast(tops), (F.col("part") == F.col("t_part")) & i.eqNullSafe(F.col("top")), "left")  # at most side^2 + 1 rows
    places = F.array_compact(F.array(F.struct(F.col("part").alias("at"), F.lit(False).alias("sentinel")), F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("at"), F.lit(True).alias("sentinel")))))
    rows = sent.select(*docs.columns, F.explode(places).alias("place")).select(*docs.columns, "place.at", "place.sentinel")
    w = Window.partitionBy("at").orderBy("sentinel", i.desc_nulls_last(), *[F.col(c).desc() for c in payload])
    return rows.withColumn("next", F.lead(F.struct(*payload)).over(w)).where(~F.col("sentinel")).drop("at", "sentinel")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **band) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is the start of the next document."""
    lex = lexicon(docs, text_col, **band)
    buckets = bucketed(lex) if lex.count() <= LITERAL else None
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = with_kept(base, "text", lex, buckets, "kept").select("doc_id", "text", fingerprint(F.col("kept")).alias("fp"))
    pairs = with_next(base, ["text", "fp"], "doc_id")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    pairs = pairs.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.substring(F.col("next.text"), 1, half)))
    pairs = with_kept(pairs.select("doc_id", "n_chars", "edited", "fp", F.col("next.fp").alias("nfp")), "edited", lex, buckets, "kept")
    pairs = pairs.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fp", fingerprint(F.col("kept")).alias("efp"), "nfp")
    return pairs.select("doc_id", "n_chars", "edited_sha256", as_string(F.col("fp")).alias("fingerprint"), as_string(F.col("efp")).alias("edited_fingerprint"),
                        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.col("nfp")).alias("near_next"))
