"""Reports as documents: a row per day or period, its sections with their lines in order, and neighbours; and a writer.

A digest is bounded by its definition: so many lines a section, the rest as a number. All documents of a table come from
one job - ranks and counts by day, then one row each - whatever the number of days. A day's full listing isn't bounded,
so it is a table of lines in order, which the writer streams into files, a task a document.

Defined cases: a day without items has no row, and a period of days shows it with 0; undated items belong to no day;
ties in counts go by name; a section that the order doesn't name comes last.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as T

#: Characters of an excerpt in a listing; of a text without title, and of any label, in a digest.
LISTED, SHORT, LABEL = 700, 280, 300


def address(url: Column) -> Column:
    """A public address as it may stand in a link; null for others."""
    return F.when(url.rlike(r"^https?://[^/?#]"), T.quoted(url))


def label(title: Column, text: Column, chars: int) -> Column:
    """The title, or so many characters of the text."""
    t, x = T.clean(F.coalesce(title, F.lit(""))), T.clean(F.coalesce(text, F.lit("")))
    return F.when(t != "", t).when(x != "", F.concat(F.substring(x, 1, chars), F.when(F.char_length(x) > chars, "…").otherwise("")))


def short_line(items: DataFrame) -> Column:
    """An item in one line of a digest: title, or 280 characters of the text, cut at 300."""
    x = T.clean(F.coalesce("text", F.lit("")))
    said = F.coalesce(F.nullif(T.clean(F.coalesce("title", F.lit(""))), F.lit("")), F.nullif(F.substring(x, 1, SHORT), F.lit("")), F.lit("(no text)"))
    said = F.concat(F.substring(said, 1, LABEL), F.when(F.char_length(said) > LABEL, "…").otherwise(""))
    link = F.coalesce(F.concat(F.lit("[original]("), address(F.col("url")), F.lit(")")), F.lit("no original"))
    return F.concat(F.lit("- **"), T.markdown(F.col("source_name")), F.lit("** · "), T.markdown(_published()), F.lit(" — "), T.markdown(said), F.lit(" · "), link)


def listed_line(redacted: Column) -> Column:
    """An item of a day's listing: who, how trusted, when, a label of 700 characters, and where."""
    said = F.when(redacted, "withheld: it may hold operational detail").otherwise(F.coalesce(label(F.col("title"), F.col("text"), LISTED), F.lit("(no text)")))
    link = F.coalesce(F.concat(F.lit("[original]("), address(F.col("url")), F.lit(")")), F.lit("no original"))
    return F.concat(F.lit("- **"), T.markdown(F.col("source_name")), F.lit("** · `"), T.markdown(F.col("perspective")), F.lit("` · trust `"), T.markdown(F.col("trust")), F.lit("` · "), T.markdown(_published()), F.lit("\n  \n  "), T.markdown(said), F.lit("\n  \n  "), link, F.lit(" · id `"), F.col("item_id").cast("string"), F.lit("`"))


def _published() -> Column:
    return F.coalesce(F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("undated"))


def counted(items: DataFrame, by: list[str], column: str, most: int | None = None) -> DataFrame:
    """by, column as `<column>s`: an array of (name, n), most frequent first."""
    n = items.groupBy(*by, F.coalesce(column, F.lit("unknown")).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    if most:
        n = n.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "name"))).where(F.col("_place") <= most).drop("_place")
    entry = F.struct((-F.col("n")).alias("o"), "name")
    return n.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["name"].alias("name"), (-e["o"]).alias("n"))).alias(f"{column}s"))


def sections(items: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """by, sections: an array of (section, n, more, lines), in order; each with its newest items."""
    place = F.row_number().over(Window.partitionBy(*by, "section").orderBy(F.desc("stamp"), "item_id"))
    top = items.withColumn("_place", place).where(F.col("_place") <= most).groupBy(*by, "section").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", short_line(items).alias("line")))), lambda e: e["line"]).alias("lines"))
    n = items.groupBy(*by, "section").agg(F.count(F.lit(1)).alias("n"))
    j = n.join(top, [*by, "section"])
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in order]), F.col("section")), F.lit(0)), F.lit(len(order) + 1))
    row = F.struct(rank.alias("o"), "section", "n", F.greatest(F.lit(0), F.col("n") - most).alias("more"), "lines")
    return j.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(row)), lambda e: F.struct(e["section"].alias("section"), e["n"].alias("n"), e["more"].alias("more"), e["lines"].alias("lines"))).alias("sections"))


def _assembled(items: DataFrame, by: list[str], order: list[str], most: int, redact: list[str], sources: int) -> DataFrame:
    hidden = F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in redact])), F.lit(False))
    whole = items.groupBy(*by).agg(F.count(F.lit(1)).alias("items"), F.count_distinct("source").alias("n_sources"), F.count_if(hidden).alias("redacted"))
    named = items.withColumn("source_name", F.coalesce("source_name", "source"))
    for part in (counted(named, by, "platform"), counted(named, by, "grp"), counted(named, by, "source_name", sources), sections(named, by, order, most)):
        whole = whole.join(part, by)
    return whole


def daily(items: DataFrame, order: list[str], redact: list[str], most: int = 8) -> DataFrame:
    """A row per local day: items, n_sources, redacted, platforms, grps, source_names, sections, and the days before and
    after that have a document. items: with local_day and section."""
    whole = _assembled(items.where("local_day IS NOT NULL"), ["local_day"], order, most, redact, 25)
    days = whole.select("local_day")  # a row per day
    w = Window.orderBy("local_day")
    near = days.select("local_day", F.lag("local_day").over(w).alias("previous_day"), F.lead("local_day").over(w).alias("next_day"))
    return whole.join(near, "local_day")


def periods(items: DataFrame, start: Column, days: int, order: list[str], redact: list[str], most: int = 8) -> DataFrame:
    """A row per period: start (the expression of its first day from local_day), end, the same counts and sections, and
    per_day: (day, n) of each of its days, those without items too."""
    timed = items.where("local_day IS NOT NULL").withColumn("start", start)
    whole = _assembled(timed, ["start"], order, most, redact, 25)
    n = timed.groupBy("start", "local_day").agg(F.count(F.lit(1)).alias("n")).groupBy("start").agg(F.map_from_entries(F.collect_list(F.struct("local_day", "n"))).alias("_n"))  # no more entries than days
    calendar = F.sequence("start", F.date_add("start", days - 1))
    out = whole.join(n, "start").withColumn("per_day", F.transform(calendar, lambda d: F.struct(d.alias("day"), F.coalesce(F.try_element_at("_n", d), F.lit(0).cast("long")).alias("n"))))
    return out.drop("_n").withColumn("end", F.date_add("start", days - 1))


def _counts(column: str) -> Column:
    return F.array_join(F.transform(column, lambda e: F.concat(e["name"], F.lit(": "), e["n"].cast("string"))), ", ")


def markdown(documents: DataFrame, title: Column, zone: str) -> Column:
    """The text of a digest row."""
    parts = [F.concat(F.lit("# "), title), F.lit(""), F.lit(f"**Time zone:** `{zone}`"), F.lit(""), F.lit("## Coverage"), F.lit("")]
    for name, value in (("Items", F.col("items").cast("string")), ("Sources", F.col("n_sources").cast("string")), ("Platforms", _counts("platforms")), ("Groups", _counts("grps")), ("Withheld excerpts", F.col("redacted").cast("string"))):
        parts.append(F.concat(F.lit(f"- {name}: **"), value, F.lit("**")))
    if "per_day" in documents.columns:
        rows = F.array_join(F.transform("per_day", lambda d: F.concat(F.lit("| "), d["day"].cast("string"), F.lit(" | "), d["n"].cast("string"), F.lit(" |"))), "\n")
        parts += [F.lit(""), F.lit("### By day"), F.lit(""), F.lit("| Day | Items |\n|---|---:|"), rows]
    rows = F.array_join(F.transform("source_names", lambda e: F.concat(F.lit("| "), T.markdown(e["name"]), F.lit(" | "), e["n"].cast("string"), F.lit(" |"))), "\n")
    parts += [F.lit(""), F.lit("## Sources"), F.lit(""), F.lit("| Source | Items |\n|---|---:|"), rows, F.lit("")]
    more = lambda s: F.when(s["more"] > 0, F.concat(F.lit("\n- _"), s["more"].cast("string"), F.lit(" more._"))).otherwise("")
    body = F.array_join(F.transform("sections", lambda s: F.concat(F.lit("## "), s["section"], F.lit("\n\n"), F.array_join(s["lines"], "\n"), more(s))), "\n\n")
    return F.concat(F.array_join(F.array(*[p.cast("string") for p in parts]), "\n"), F.lit("\n"), body, F.lit("\n"))


def listing(items: DataFrame, order: list[str], redact: list[str]) -> DataFrame:
    """name (of the document), at (order within), text: the lines of every day's full listing."""
    hidden = F.coalesce(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in redact])), F.lit(False))
    dated = items.where("local_day IS NOT NULL")
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in order]), F.col("section")), F.lit(0)), F.lit(len(order) + 1)).cast("long")
    name = F.concat(F.col("local_day").cast("string"), F.lit(".md"))
    text = lambda t: F.concat(t, F.lit("\n"))
    lines = dated.select(name.alias("name"), F.struct(rank.alias("section"), F.lit(1).alias("kind"), (-F.unix_micros(F.coalesce("published", "collected"))).alias("time"), F.col("item_id").alias("id")).alias("at"), text(listed_line(hidden)).alias("text"))
    heads = dated.select(name.alias("name"), rank.alias("section"), "section").toDF("name", "rank", "section").distinct().select("name", F.struct(F.col("rank").alias("section"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("time"), F.lit(0).cast("long").alias("id")).alias("at"), text(F.concat(F.lit("\n## "), "section", F.lit("\n"))).alias("text"))
    titles = dated.select(name.alias("name"), "local_day").distinct().select("name", F.struct(F.lit(0).cast("long").alias("section"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("time"), F.lit(0).cast("long").alias("id")).alias("at"), text(F.concat(F.lit("# "), F.col("local_day").cast("string"))).alias("text"))
    return titles.unionByName(heads).unionByName(lines)


def written(parts: DataFrame, root: str) -> DataFrame:
    """Write documents (name, at, text) below a root that workers share: name, bytes, digest of each. One job; a document
    is streamed by one task and appears, or is replaced, as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import uuid

        from corvane.sources.committed import store

        files, base = store(root)
        files.create_dir(base)
        now, out, sha, size, temporary, done = None, None, None, 0, "", []

        def close() -> None:
            if out is not None:
                out.close()
                files.move(temporary, f"{base}/{now}")
                done.append((now, size, sha.hexdigest()))

        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist(), strict=True):
                if "/" in name or name.startswith("."):
                    raise ValueError(f"not a name of a document: {name!r}")
                if name != now:
                    close()
                    now, sha, size, temporary = name, hashlib.sha256(), 0, f"{base}/.{name}.{uuid.uuid4().hex}"
                    out = files.open_output_stream(temporary)
                data = text.encode()
                out.write(data)
                sha.update(data)
                size += len(data)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[j] for d in done], t) for j, t in enumerate((pa.string(), pa.int64(), pa.string()))], ["name", "bytes", "digest"])

    ordered = parts.select("name", "at", "text").repartition("name").sortWithinPartitions("name", "at")
    return ordered.select("name", "text").mapInArrow(run, "name string, bytes long, digest string")


def summary(prep: DataFrame, least: float = 4.0) -> DataFrame:
    """A row per local day: how items fared at the gates, clusters, and the day's primary and watched clusters in order,
    each with its scores, labels and samples. prep: clusters.prepared; it is matched once and written once."""
    from corvane.plans import clusters as C
    from corvane.session import settled

    prep = settled(prep.where("local_day IS NOT NULL"), "prepared")
    candidate = F.col("relevance").isin("relevant", "peripheral")
    gates = prep.groupBy("local_day").agg(F.count(F.lit(1)).alias("items"), F.count_if(candidate & F.col("strict")).alias("accepted"), F.count_if(candidate & ~F.col("strict")).alias("strict_filtered"), *[F.count_if(F.col("relevance") == k).alias(k) for k in ("relevant", "peripheral", "irrelevant", "redacted")])
    r = settled(C.ranked(C.clusters(prep)), "ranked")  # a row per cluster
    chosen = C.primary(r)
    watched = C.watch(r, chosen, least)
    ids = C.samples(C.accepted(prep)).groupBy(*C.KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "item_id"))), lambda s: s["item_id"]).alias("samples"))  # five a cluster
    named = r.select("cluster_id", *C.KEY).join(ids, C.KEY).select("cluster_id", "samples")
    what = r.select("cluster_id", "topic", "locations", "change", "matched_days", "rank", "importance", "novelty", "evidence", C.label(F.col("evidence"), 6.0, 3.2, ("strong", "mixed", "thin")).alias("evidence_label"), "pulse", C.label(F.col("pulse"), 6.0, 3.0, ("high", "medium", "low")).alias("pulse_label"), "items", "families").join(named, "cluster_id")
    of = lambda places, name: places.select("local_day", "place", "cluster_id").join(what, "cluster_id").groupBy("local_day").agg(F.array_sort(F.collect_list(F.struct("place", *[c for c in what.columns]))).alias(name))  # noqa: E731, C416  at most 14 and 6 a day
    n = r.groupBy("local_day").agg(F.count(F.lit(1)).alias("clusters"))
    out = gates.join(n, "local_day", "left").join(of(chosen, "primary"), "local_day", "left").join(of(watched, "watched"), "local_day", "left")
    return out.withColumn("clusters", F.coalesce("clusters", F.lit(0).cast("long")))
