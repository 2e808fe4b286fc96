"""SimHash near-duplicates against a plain version."""

import random
from itertools import product

import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash as S

SCHEMA = "doc_id long, text string, fp string, component_id string"


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), seed=42)
              for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def made_texts():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, base = [], [" ".join(draw.choices(words, k=draw.choice([1, 2, 3, 40, 400])))
                      for _ in range(40)]
    for i in range(160):
        text = base[draw.randrange(40)].split(" ")
        if i % 3 and len(text) > 30:
            text[draw.randrange(len(text))] = "edited"
        rows.append(" ".join(text))
    return rows + ["", "   \t\n", None, "ÀÉ Straße ÀÉ", "A b c", "x" * 100_000, "big " * 70_000]


def test_matches_plain_version(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(made_texts())]
    docs = spark.createDataFrame(rows, SCHEMA)
    for bucket in (256, 2):  # with and without the way for crowded buckets
        got = {r.doc_id: r for r in S.simhash_clusters(docs, largest_bucket=bucket).collect()}
        prints = {i: plain_print(t) for i, t, _, _ in rows}
        assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
        assert {i: r.component_id for i, r in got.items()} == plain_components(prints, 2)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_links_of_crowded_fingerprints(spark):
    draw = random.Random(3)
    middle = draw.getrandbits(64)
    values = {middle} | {middle ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
                         for _ in range(120)} | {draw.getrandbits(64) for _ in range(50)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed
            if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    for bucket in (1000, 3, 1):
        assert {tuple(r) for r in S.links(prints, 2, bucket).collect()} == want


def test_thresholds_cover_the_distance_at_the_least_cost():
    costs = [[0, 5, 50, 500], [0, 1, 2, 900], [0, 9, 90, 900]]
    cost, chosen = S.allocate(costs, 2)
    every = [(sum(own[t + 1] for own, t in zip(costs, ts)), list(ts))
             for ts in product(range(-1, 3), repeat=3) if sum(ts) == 0]
    assert (cost, chosen) == min(every)


def test_empty_and_null_ids(spark):
    assert S.simhash_clusters(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame(
        [(None, "a b c d", "", ""), (7, "a b c d", "", ""), (7, "a b c d", "", ""),
         (None, "other words stand here", "", "")], SCHEMA)
    rows = S.simhash_clusters(docs).orderBy(F.col("doc_id").asc_nulls_first(), "component_id")
    assert [(r.doc_id, r.component_id) for r in rows.collect()] == [
        (None, None), (None, 7), (7, 7), (7, 7)]
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect())[-1] == (7, "a b c d")
    assert kept.count() == 2
