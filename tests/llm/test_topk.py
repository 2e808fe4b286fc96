"""Exact top-k search against all pairs in Python integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from checks.compare import compare
from tidemark.llm import topk as K
from tidemark.llm.queries import ORACLES, QUERIES

SHAPE = "vec_id long, embedding array<double>"
LONG = 1 << 63


def plain(rows, every, k):
    sound = {(i, tuple(v)) for i, v in rows if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}
    whole = sorted((i, v, [math.floor(Fraction(x) * 64) for x in v]) for i, v in sound)
    out = []
    for q, own, a in whole:
        if q % every:
            continue
        found = [(-min(max(sum(x * y for x, y in zip(a, b)), -LONG), LONG - 1), i)
                 for i, v, b in whole if (i, v) != (q, own) and len(a) == len(b)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def got(spark, rows, every, k, **options):
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'x' as rep", "1 as score", "2L as key")
    return sorted(map(tuple, K.search(df, every, k, **options).collect()))


def drawn(n, width, seed=3):
    draw = np.random.default_rng(seed)
    return [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(n, width)))]


@pytest.mark.parametrize("n,width,k", [(300, 8, 5), (90, 3, 20), (7, 4, 20), (1, 2, 3), (60, 1, 4)])
def test_all_pairs(spark, n, width, k):
    rows = drawn(n, width)
    assert got(spark, rows, 5, k) == plain(rows, 5, k)


def test_many_runs(spark):
    """Cutoffs hold across runs: here of about 16 rows each."""
    rows = drawn(200, 6)
    assert got(spark, rows, 10, 5, run_numbers=96) == plain(rows, 10, 5)


def test_ties_and_copies(spark):
    same = [(i, [0.5, -0.25]) for i in range(0, 60)]
    ties = [(100 + i, [float(i % 3), 1.0]) for i in range(40)] + same[:3]
    assert got(spark, same + ties, 10, 7) == plain(same + ties, 10, 7)


def test_all_scores_negative(spark):
    rows = [(i, [(-1.0) ** i * (1 + i), 0.1 * i]) for i in range(30)]
    rows = [(i, [abs(a) if i % 5 == 0 else -abs(a), b]) for i, (_, [a, b]) in enumerate(rows)]
    assert got(spark, rows, 5, 4) == plain(rows, 5, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (20, []), (40, []), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 0.0]),
            (120, [None, 1.0]), (None, [1.0, 1.0]), (140, [1.0, 2.0]), (160, [1.0]), (180, [3.0]),
            (200, [1.0, 2.0]), (200, [2.0, 1.0]), (200, [2.0, 1.0]), (5, [-1.0, 2.0]), (-20, [9.0, 9.0])]
    assert got(spark, rows, 20, 3) == plain(rows, 20, 3)


def test_large_numbers(spark):
    big = [1e3, 1e9, 2.0 ** 45, 1e17, 1e25, 1e305, -1e305, -1e17, 0.015625, 7.0]
    rows = [(i, [big[i % 10], big[(3 * i + 1) % 10]]) for i in range(30)]
    assert got(spark, rows, 3, 6) == plain(rows, 3, 6)


def test_empty_table(spark):
    assert got(spark, [], 20, 20) == []
    assert got(spark, [(1, [1.0])], 20, 20) == []


def test_phases_agree_with_all_scores():
    """The cutoff of phase 1 never exceeds the k-th best score; phase 2 and 3 lose no row."""
    draw = np.random.default_rng(5)
    x = np.floor(draw.normal(size=(500, 16)) * 64).astype(np.int16)
    body = dict(kind="h", width=16, low=np.arange(500).tobytes(), rep=np.arange(500).tobytes())
    row = type("Row", (), body | {"body": x.tobytes(), "cutoff": np.zeros(500, np.int64).tobytes()})
    block = K.Block(row)
    q = x.astype(np.float32)
    first = K.gathered(q, q, block, block, 5)
    cutoff = first.sort_values("score", ascending=False).groupby("query")["score"].nth(4)
    scores = x.astype(np.int64) @ x.T.astype(np.int64)
    np.fill_diagonal(scores, -10 ** 9)
    assert (np.sort(scores, axis=1)[:, -5] >= first.groupby("query")["score"].nlargest(5)
            .groupby("query").min().to_numpy()).all() and len(cutoff) == 500
    block.cutoffs = first.groupby("query")["score"].nlargest(5).groupby("query").min().to_numpy()
    rest = K.resolved(q, q, block, block, 5)
    rest = rest[rest["query"] != rest["rep"]]
    best = rest.groupby("query")["score"].nlargest(5).groupby("query").apply(list)
    assert [sorted(b) for b in best] == [sorted(r)[-5:] for r in scores.tolist()]


def test_sql_twin(spark, folder, duck):
    name = "op11_topk"
    verdict = compare(spark, duck, name, QUERIES[name], ORACLES[name], folder)
    assert verdict.startswith("ok"), verdict
