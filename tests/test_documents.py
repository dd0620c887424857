"""Documents: lines and their cuts, sections, neighbours, texts, and the writer."""

import hashlib
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corvane.plans import documents as B

COLS = "item_id long, source string, source_name string, platform string, grp string, perspective string, trust string, published timestamp, collected timestamp, stamp string, title string, text string, url string, tags array<string>, section string, local_day date"


def item(i, day=1, section="map", title="", text="x", tags=(), source="s", url="https://h/p", **kw):
    at = datetime(2026, 1, day) + timedelta(minutes=i)
    return {"item_id": i, "source": source, "source_name": f"Feed {source}", "platform": "web", "grp": "g", "perspective": "p", "trust": "t", "published": at, "collected": at, "stamp": at.isoformat(), "title": title, "text": text, "url": url, "tags": list(tags), "section": section, "local_day": date(2026, 1, day)} | kw


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], COLS)


def test_lines_and_their_cuts(spark):
    rows = [item(1, text="y" * 800), item(2, title="t" * 305, text="y"), item(3, title=" ", text="a_b *c*"), item(4, text=""), item(5, url="ftp://h/"), item(6, published=None), item(7, url="https://h/a b")]
    df = frame(spark, rows)
    short = {r.item_id: r.line for r in df.select("item_id", B.short_line(df).alias("line")).collect()}
    assert short[1] == f"- **Feed s** · 2026-01-01T00:01:00Z — {'y' * 280} · [original](https://h/p)" and f"— {'t' * 300}… ·" in short[2]
    assert r"— a\_b \*c\* ·" in short[3] and "— (no text) ·" in short[4] and short[5].endswith("no original") and "· undated —" in short[6] and "https://h/a%20b" in short[7]
    listed = {r.item_id: r.line for r in df.select("item_id", B.listed_line(F.col("item_id") == 3).alias("line")).collect()}
    assert f"{'y' * 700}…" in listed[1] and "t" * 305 in listed[2] and "withheld" in listed[3] and "a_b" not in listed[3] and listed[1].endswith("id `1`")


def test_daily_documents(spark):
    rows = [item(k, section="map" if k < 10 else "odd", source=f"s{k % 3}", tags=["op"] if k == 1 else []) for k in range(12)] + [item(20, 5, "drones")] + [item(30, local_day=None)]
    got = {r.local_day.day: r for r in B.daily(frame(spark, rows), ["drones", "map"], ["op"]).collect()}
    assert sorted(got) == [1, 5] and (got[1].items, got[1].n_sources, got[1].redacted, got[1].previous_day, got[1].next_day, got[5].previous_day) == (12, 3, 1, None, date(2026, 1, 5), date(2026, 1, 1))
    assert [(s.section, s.n, s.more, len(s.lines)) for s in got[1].sections] == [("map", 10, 2, 8), ("odd", 2, 0, 2)]
    assert "00:09:00Z" in got[1].sections[0].lines[0] and [(c.name, c.n) for c in got[1].source_names] == [("Feed s0", 4), ("Feed s1", 4), ("Feed s2", 4)]


def test_periods_and_their_text(spark):
    rows = [item(k, 5 + k % 2) for k in range(5)] + [item(9, 14)]
    df = B.periods(frame(spark, rows), F.to_date(F.date_trunc("week", "local_day")), 7, ["map"], ["op"])
    got = {r.start.day: r for r in df.withColumn("text", B.markdown(df, F.concat(F.lit("Week of "), F.col("start").cast("string")), "UTC")).collect()}
    assert [d.n for d in got[5].per_day] == [3, 2, 0, 0, 0, 0, 0] and [d.n for d in got[12].per_day] == [0, 0, 1, 0, 0, 0, 0] and got[5].end == date(2026, 1, 11)
    assert got[5].text.startswith("# Week of 2026-01-05\n\n**Time zone:** `UTC`\n\n## Coverage\n\n- Items: **5**\n") and "| 2026-01-05 | 3 |\n| 2026-01-06 | 2 |" in got[5].text and got[5].text.count("- **Feed s**") == 5


def test_documents_are_written_in_one_job(spark, tmp_path):
    rows = [item(k, 1 + k % 4, ["map", "odd"][k % 3 == 0], text=f"text {k}") for k in range(60)]
    root = str(tmp_path / "daily")
    for _ in range(2):  # written again, replaced
        got = {r.name: r for r in B.written(B.listing(frame(spark, rows).repartition(5), ["map"], ["op"]), root).collect()}
    assert sorted(got) == sorted(p.name for p in (tmp_path / "daily").iterdir()) == [f"2026-01-0{d}.md" for d in (1, 2, 3, 4)]
    for name, r in got.items():
        data = (tmp_path / "daily" / name).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.digest)
        day, text = int(name[8:10]), data.decode()
        of = [r for r in rows if r["local_day"].day == day]
        order = [r["item_id"] for r in sorted(of, key=lambda r: (r["section"] != "map", -r["item_id"]))]
        assert text.startswith(f"# {name[:10]}\n\n## map\n") and [int(x.split("`")[0]) for x in text.split("id `")[1:]] == order
    with pytest.raises(Exception, match="not a name"):
        B.written(spark.createDataFrame([("../x", 1, "t")], "name string, at int, text string"), root).collect()
