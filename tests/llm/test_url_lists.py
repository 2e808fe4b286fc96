"""Temporal URL lists: keys, intervals, and the join against a plain version."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.llm import url_lists as U

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(n)


@pytest.mark.parametrize("url, host, keys", [
    ("https://U:p@A.b.org:80/x/y/?q=1#f", "a.b.org",
     ["domain a.b.org", "domain b.org", "domain org", "path a.b.org/x", "path a.b.org/x/y",
      "url a.b.org/x/y/?q=1"]),
    ("http://h.org", "h.org", ["domain h.org", "domain org", "url h.org"]),
    ("//h.org./", "h.org", ["domain h.org", "domain org", "url h.org/"]),
    ("no url", "", None), ("", "", None), (None, None, None)])
def test_keys(spark, url, host, keys):
    df = spark.createDataFrame([(url,)], "u string")
    row = df.select(U.host_of(F.col("u")).alias("h"), U.keys_of(F.col("u")).alias("k")).first()
    assert row.h == host and (sorted(row.k) if row.k else row.k) == keys


def test_very_long_url(spark):
    """All prefixes of a path of a thousand parts, from one URL; its own key matches."""
    url = "http://h.org/" + "/".join(f"part{i}" for i in range(1000)) + "?q=" + "x" * 50_000
    df = spark.createDataFrame([(url, day(3))], "url string, fetch_day date")
    keys = df.select(F.size(U.keys_of(F.col("url")))).first()[0]
    assert keys == 2 + 1000 + 1
    listed = U.listed(df, entries(spark, [("a", "path h.org/part0/part1", day(0), "add")])).first()
    assert (listed.n_entries, listed.lists, listed.nearest) == (1, "a", "path")


def entries(spark, rows):
    return spark.createDataFrame(rows, "list string, key string, day date, action string")


def test_intervals(spark):
    rows = [("a", "k", day(0), "add"), ("a", "k", day(5), "remove"), ("a", "k", day(9), "add"),
            ("a", "k", day(9), "remove"), ("a", "k", day(12), "add"), ("a", "k", day(14), "add"),
            ("a", "k", day(14), "add"), ("b", "k", day(1), "remove"), (None, "k", day(1), "add"),
            ("c", "k", day(1), "other"), ("d", "k", None, "add")]
    got = sorted(tuple(r) for r in U.intervals(entries(spark, rows)).where("valid_to is not null")
                 .collect())
    assert got == [("a", "k", day(0), day(5)), ("a", "k", day(12), day(14))]
    still = U.intervals(entries(spark, rows)).where("valid_to is null").collect()
    assert [tuple(r)[:3] for r in still] == [("a", "k", day(14))]


def test_join_matches_plain_version(spark):
    lists = [("spam", "domain org", day(3), "add"), ("spam", "domain org", day(60), "remove"),
             ("spam", "path a.org/x", day(40), "add"), ("bad", "url a.org/x/y", day(10), "add"),
             ("bad", "url a.org/x/y", day(200), "remove"), ("bad", "domain b.a.org", day(0), "add")]
    urls = ["http://a.org/x/y", "http://b.a.org/", "http://a.com/x", None, "", "http://a.org/x"]
    schema = "url string, fetch_day date, key string, lists int, month string"
    rows = [(u, day(n), "k", 9, "m") for u in urls for n in range(0, 260, 7)]
    rows += rows[:3] + [("http://a.org/x", None, "k", 9, "m"),
                        ("http://a.org/" + "d/" * 500, day(41), "k", 9, "m")]
    df = spark.createDataFrame(rows, schema)
    out = U.listed(df, entries(spark, lists))
    assert out.columns == ["url", "fetch_day", "key", "month", "n_entries", "lists", "nearest"]
    got = out.collect()
    assert len(got) == len(rows)

    def active(key, name, when):
        last = [a for l, k, d, a in sorted(lists, key=lambda e: e[2])
                if (l, k) == (name, key) and d <= when]
        return bool(last) and last[-1] == "add"

    keys = {u: (df.where(F.col("url") == u).select(U.keys_of(F.col("url")).alias("k")).first().k
                if u else None) or [] for u in {r[0] for r in rows}}
    for r in got:
        hits = [(n, k) for n in ("bad", "spam") for k in keys[r.url]
                if r.fetch_day and active(k, n, r.fetch_day)]
        assert r.n_entries == len(hits), r
        assert r.lists == ",".join(sorted({n for n, _ in hits}))
        kinds = [U.KINDS.index(k.split()[0]) for _, k in hits]
        assert r.nearest == (U.KINDS[min(kinds)] if kinds else None)


def test_empty_sides(spark):
    schema = "url string, fetch_day date"
    none = spark.createDataFrame([], schema)
    some = spark.createDataFrame([("http://a.org", DAY)], schema)
    assert U.listed(none, entries(spark, [("a", "domain org", DAY, "add")])).count() == 0
    assert [tuple(r)[2:] for r in U.listed(some, entries(spark, [])).collect()] == [(0, "", None)]
