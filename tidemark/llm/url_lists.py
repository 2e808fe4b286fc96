"""URL filter lists as of the time of each capture.

Dated add and remove entries of a list become validity intervals. Every capture offers all keys
that an entry could name (its URL, its path prefixes, its host and parent domains), and an as-of
join finds, for each of them, the entry that was active when the page was fetched.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stored

ADDRESS = r"(?is)^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?"
KINDS = ("url", "path", "domain")  # most specific first


def host_of(url: Column) -> Column:
    """Lower-case host without user, port or a final dot; empty where there is none."""
    return F.lower(F.regexp_extract(url, ADDRESS + r"([^/:?#\s]*?)\.?(?::\d*)?(?:[/?#\s]|$)", 1))


def path_of(url: Column) -> Column:
    """The path from its first slash, without query and fragment."""
    return F.regexp_extract(url, ADDRESS + r"[^/?#\s]*([^?#\s]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#\s]*)", 1)


def keys_of(url: Column) -> Column:
    """Every key an entry could name: `url host/path?query`, `path host/dir`, `domain host`.

    Path keys are the prefixes that end at a slash or at the end of the path; domain keys are the
    host and its parents. A null URL or one without a host has no key. URLs are read whole; the keys
    of one with n parts of a path hold n prefixes, so their length grows with the square of n.
    """
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    parts = F.split(F.regexp_replace(path, r"^/|/$", ""), "/")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("domain "), F.concat_ws(".", F.slice(labels, i, F.size(labels)))))
    paths = F.when(F.length(F.regexp_replace(path, "/", "")) > 0, F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(
            F.lit("path "), host, F.lit("/"), F.concat_ws("/", F.slice(parts, F.lit(1), i))))
    ).otherwise(F.array().cast("array<string>"))
    whole = F.array(F.concat(F.lit("url "), host, path, query_of(url)))
    return F.when(F.coalesce(host, F.lit("")) != "",
                  F.array_distinct(F.concat(domains, paths, whole)))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from dated entries (list, key, day, action).

    An entry holds from its day until the next entry of the same list and key; valid_to is null
    while it still holds. The last action of a day counts, and `remove` comes after `add`. Adding
    again changes nothing. Rows with a null in any of the four columns or another action are no
    entries. Windows see one row per key and day, so a key's history is bounded by the calendar.
    """
    daily = (entries.where("list is not null and key is not null and day is not null "
                           "and action in ('add', 'remove')")
             .groupBy("list", "key", "day").agg(F.max("action").alias("action")))
    turn = Window.partitionBy("list", "key").orderBy("day")
    return (daily.withColumn("valid_to", F.lead("day").over(turn))
            .where("action = 'add'").select("list", "key", F.col("day").alias("valid_from"),
                                            "valid_to"))


def listed(captures: DataFrame, entries: DataFrame, url_col: str = "url",
           day_col: str = "fetch_day") -> DataFrame:
    """The captures with n_entries, lists and nearest: what was active when they were fetched.

    lists names the lists in order, joined by commas; nearest is the kind of the most specific
    entry. A capture with a null URL, host or day matches nothing (0, empty, null). Repeated rows
    get equal answers. Other columns are returned as they came; the three added ones take the
    place of columns with those names. Empty captures give an empty result; with no entries every
    capture matches nothing.

    Each distinct (URL, day) is judged once. Keys and calendar months are joined by equality, so
    an interval meets only captures of its months, and a host with a third of all captures is a
    plain skewed join side that adaptive execution splits.
    """
    asked = captures.select(F.col(url_col).alias("u"), F.col(day_col).cast("date").alias("t")) \
        .where("u is not null and t is not null").distinct()
    asked = stored(asked)
    keys = asked.select("u", "t", F.trunc("t", "month").alias("month"),
                        F.explode(keys_of(F.col("u"))).alias("key"))
    last = asked.agg(F.max("t").alias("last"))
    spans = intervals(entries).crossJoin(F.broadcast(last))  # one row
    spans = spans.where("valid_from <= last").withColumn("month", F.explode(F.sequence(
        F.trunc("valid_from", "month"),
        F.trunc(F.least(F.coalesce("valid_to", "last"), "last"), "month"),
        F.expr("interval 1 month"))))
    hits = (keys.join(spans, ["key", "month"])
            .where("valid_from <= t and (valid_to is null or t < valid_to)")
            .groupBy("u", "t", "list").agg(
                F.count("*").alias("n"),
                F.min(F.array_position(F.array(*map(F.lit, KINDS)),
                                       F.substring_index("key", " ", 1))).alias("kind")))
    found = hits.groupBy("u", "t").agg(
        F.sum("n").alias("n_entries"),
        F.array_join(F.sort_array(F.collect_list("list")), ",").alias("lists"),
        F.element_at(F.array(*map(F.lit, KINDS)), F.min("kind").cast("int")).alias("nearest"))
    left = captures.drop("n_entries", "lists", "nearest")
    return left.join(found, (left[url_col] == found["u"])
                     & (left[day_col].cast("date") == found["t"]), "left") \
        .select(*[left[c] for c in left.columns], F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
                F.coalesce("lists", F.lit("")).alias("lists"), "nearest")
