"""Raking and sampling against a plain version."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, lang string, topic string, draw string, tokens int"


def plain_rake(cells, targets, sweeps=500):
    weights = dict(cells)
    total = sum(cells.values())
    for _ in range(sweeps):
        for axis, shares in enumerate(targets):
            sums = defaultdict(float)
            for key, w in weights.items():
                sums[key[axis]] += w
            weights = {k: w * total * shares[k[axis]] / sums[k[axis]] if sums[k[axis]] else w
                       for k, w in weights.items()}
    return weights


def smoothed(cells, axis, power):
    sums = defaultdict(float)
    for key, w in cells.items():
        sums[key[axis]] += w
    raw = {k: v ** power for k, v in sums.items() if v > 0}
    return {k: v / sum(raw.values()) for k, v in raw.items()} | {
        k: 0 for k, v in sums.items() if not v}


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_probabilities_match_plain_raking(spark, docs):
    rows = M.mixed(docs).collect()
    assert len(rows) == docs.count() and all(r.converged for r in rows)
    cells = Counter()
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
    assert sum(cells.values()) == sum(len(r.text.split()) for r in docs.collect())
    raked = plain_rake(cells, [smoothed(cells, a, 0.7) for a in range(3)])
    factor = {k: raked[k] / cells[k] for k in cells}
    low, high = 0.0, 1e6
    for _ in range(200):
        rate = (low + high) / 2
        got = sum(cells[k] * min(1, rate * factor[k]) for k in cells)
        low, high = (rate, high) if got < 0.7 * sum(cells.values()) else (low, rate)
    for r in rows:
        want = min(1, rate * factor[r.source, r.lang, r.topic])
        assert r.probability == pytest.approx(want, rel=1e-4)
    taken = sum(r.tokens for r in rows if r.chosen) / sum(cells.values())
    assert 0.5 < taken < 0.9


def test_sample_keeps_rows_as_they_came(docs):
    chosen = {r.doc_id for r in M.mixed(docs).where("chosen").collect()}
    got = M.sampled(docs)
    assert got.columns == docs.columns
    want = {r for r in docs.collect() if r.doc_id in chosen}
    assert set(got.collect()) == want


def test_given_targets_hold(spark):
    cells = spark.createDataFrame(
        [("a", "x", "t", 100.0), ("a", "y", "t", 50.0), ("b", "x", "t", 10.0),
         ("b", "y", "u", 400.0), (None, "x", "u", 30.0), ("a", None, "t", 5.0),
         ("c", "y", "u", 20.0), ("c", "x", "u", 0.0)],
        "source string, lang string, topic string, tokens double")
    given = {"source": {"a": 0.5, "b": 0.3, "missing": 0.1}, "lang": {"x": 0.4}}
    targets = {m: M.given_targets(cells, m, s) for m, s in given.items()}
    out = M.rake(cells, targets, 1e-9).collect()
    assert all(r.converged for r in out)
    by = defaultdict(float)
    for r in out:
        by[r.source] += r.raked / 615
    assert by["a"] == pytest.approx(0.5 / 0.9) and by["b"] == pytest.approx(0.3 / 0.9)
    assert sum(r.raked for r in out if r.lang == "x") == pytest.approx(0.4 * 615)


def test_contradicting_targets_are_reported(spark):
    cells = spark.createDataFrame(
        [("a", "x", "t", 1.0), ("b", "y", "t", 1.0)],
        "source string, lang string, topic string, tokens double")
    targets = {"source": M.given_targets(cells, "source", {"a": 0.9, "b": 0.1}),
               "lang": M.given_targets(cells, "lang", {"x": 0.1, "y": 0.9})}
    assert not any(r.converged for r in M.rake(cells, targets, most_sweeps=8).collect())


def test_odd_rows(spark):
    rows = [(1, None, None, None, "mine", "d", 3), (2, "", "s", "en", "mine", "d", 3),
            (2, "", "s", "en", "mine", "d", 3), (None, "a b", "s", None, "mine", "d", 3),
            (4, "word " * 200_000, "s", "en", "mine", "d", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = M.mixed(docs).collect()
    assert sorted(r.tokens for r in got) == [0, 0, 0, 2, 200_000]
    assert all(0 < r.probability <= 1 for r in got)
    kept = M.sampled(docs)
    assert kept.columns == docs.columns and set(kept.collect()) <= set(docs.collect())
    empty = spark.createDataFrame([], SCHEMA)
    assert M.mixed(empty).count() == 0 and M.sampled(empty).count() == 0


def test_topics(spark):
    texts = {"a | b | c | d": "listing", "A!! B!!": "shouting", "x%%% y###": "marked",
             "few words": "brief", "w " * 500: "prose", "w " * 5000: "long prose", " ": "empty"}
    df = spark.createDataFrame(list(texts.items()), "text string, want string")
    got = df.select("want", M.form_topic(F.col("text"), M.token_count(F.col("text"))).alias("t"))
    assert all(r.want == r.t for r in got.collect())
