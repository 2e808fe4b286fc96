"""Graph near-duplicates and forest neighbours against brute force."""

import numpy as np
import pytest

from tidemark.llm import forest, graph

SCHEMA = "vec_id long, embedding array<float>, v string, rep int, rank string"


def made(n=900, d=16, seed=2):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, d))
    for i in range(0, n, 3):  # near copies and copies
        x[i] = x[(i // 30) * 3 + 1] * draw.uniform(0.5, 2) + draw.normal(0, 0.2, d)
    x[700:800] = x[5]
    return x.astype(np.float32)


def odd_rows(d):
    bad = [None, [], [0.0] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] + [1.0] * (d - 1),
           [None] + [1.0] * (d - 1), [1.0] * (d + 1)]
    return [(10_000 + 20 * i, b) for i, b in enumerate(bad)] + [(None, [1.0] * d)]


@pytest.fixture(scope="module")
def vectors(spark):
    x = made()
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + odd_rows(x.shape[1])
    return x, spark.createDataFrame([(*r, "", 0, "") for r in rows], SCHEMA)


def plain_links(x, cosine):
    y = x.astype(np.float64)
    s = (y @ y.T) / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1))
    linked = s >= cosine
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    while True:
        new = np.where(linked, root[None, :], len(x)).min(1)
        new = np.minimum(root, new)
        if (new == root).all():
            return linked.sum(1), root
        root = new


def test_links_match_brute_force(vectors):
    x, df = vectors
    got = {r.vec_id: r for r in graph.near_duplicates(df).collect()}
    links, root = plain_links(x, 0.9)
    assert len(got) == len(x) + 8
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert [got[i].component_id for i in range(len(x))] == root.tolist()
    assert all(got[i].kept == (root[i] == i) for i in range(len(x)))
    for i in range(7):
        assert tuple(got[10_000 + 20 * i])[1:4] == (0, 10_000 + 20 * i, True)
    assert tuple(got[None])[1:4] == (0, None, True)


def test_small_shards_blocks_and_turns_give_the_same(vectors, monkeypatch):
    x, df = vectors
    monkeypatch.setattr(graph, "SHARD_ROWS", 200)
    monkeypatch.setattr(graph, "BLOCK_ROWS", 120)
    got = {r.vec_id: r for r in graph.near_duplicates(df).collect()}
    links, root = plain_links(x, 0.9)
    same = np.mean([got[i].n_links == links[i] for i in range(len(x))])
    assert same > 0.98 and all(got[i].audited_recall >= 0.99 for i in range(5))
    assert all(got[i].n_links <= links[i] for i in range(len(x)))


def test_rare_links_are_audited_and_found(spark, monkeypatch):
    draw = np.random.default_rng(14)
    x = draw.standard_normal((1500, 32))
    x[:12] = x[100:112] + draw.normal(0, 0.42, (12, 32))
    x = x.astype(np.float32)
    monkeypatch.setattr(graph, "SHARD_ROWS", 30)
    monkeypatch.setattr(graph, "PROBES", 1)
    links, root = plain_links(x, 0.9)
    assert links.sum() >= 10
    df = spark.createDataFrame([(i, v.tolist(), "", 0, "") for i, v in enumerate(x)], SCHEMA)
    got = {r.vec_id: r for r in graph.near_duplicates(df).collect()}
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert [got[i].component_id for i in range(len(x))] == root.tolist()
    assert got[0].audited_recall >= 0.999


def test_recall_is_measured_where_nothing_links(spark, monkeypatch):
    rows = [(i, np.eye(8)[i].tolist(), "", 0, "") for i in range(8)]
    got = graph.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.n_links == 0 and r.audited_recall == 1.0 for r in got)
    monkeypatch.setattr(graph, "SHARD_ROWS", 20)
    monkeypatch.setattr(graph, "PROBES", 1)
    x = np.random.default_rng(8).standard_normal((1200, 32)).astype(np.float32)
    assert plain_links(x, 0.9)[0].sum() == 0
    df = spark.createDataFrame([(i, v.tolist(), "", 0, "") for i, v in enumerate(x)], SCHEMA)
    got = graph.near_duplicates(df).collect()
    assert len(got) == 1200 and all(r.n_links == 0 and r.audited_recall >= 0.999 for r in got)


def test_each_length_links_among_itself(spark):
    x = made(300)
    rows = [(i, v.tolist(), "", 0, "") for i, v in enumerate(x)]
    rows += [(5_000 + i, [*v[:7].tolist()], "", 0, "") for i, v in enumerate(x[:60])]
    rows += [(6_000, [3.0], "", 0, ""), (6_001, [1.0], "", 0, ""), (6_002, [-1.0], "", 0, "")]
    got = {r.vec_id: r for r in graph.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    for first, part in ((0, x), (5_000, x[:60, :7])):
        links, root = plain_links(part, 0.9)
        assert [got[first + i].n_links for i in range(len(part))] == links.tolist()
        assert [got[first + i].component_id - first for i in range(len(part))] == root.tolist()
    assert [got[i].n_links for i in (6_000, 6_001, 6_002)] == [1, 1, 0]
    near = forest.nearest(spark.createDataFrame(rows, SCHEMA), 20, 5).collect()
    by = {}
    for r in near:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    assert by[6_000] == {6_001, 6_002}
    assert all((v >= 6_000) == (q >= 6_000) and (v >= 5_000) == (q >= 5_000)
               for q, found in by.items() for v in found)


def test_repeated_rows_and_empty_table_of_links(spark):
    rows = [(1, [1.0, 0.0], "", 0, ""), (1, [1.0, 0.0], "", 0, ""), (2, [0.0, 1.0], "", 0, "")]
    got = graph.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(tuple(r)[:4] for r in got) == [
        (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert graph.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    bad = spark.createDataFrame([(4, None, "", 0, "")], SCHEMA)
    assert [tuple(r)[:4] for r in graph.near_duplicates(bad).collect()] == [(4, 0, 4, True)]


def plain_nearest(x, queries, k):
    y = x.astype(np.float64)
    out = {}
    for q in queries:
        s = y @ y[q]
        order = sorted((-s[i], i) for i in range(len(x)) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


def test_neighbours_reach_the_recall(vectors):
    x, df = vectors
    got = forest.nearest(df).collect()
    want = plain_nearest(x, range(0, len(x), 20), 20)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    hit = 0
    y = x.astype(np.float64)
    for q, rows in by.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21))
        assert all(r.score == pytest.approx(y[q] @ y[r.vec_id], rel=1e-12) for r in rows)
        keys = [(-r.score, r.vec_id) for r in rows]
        assert keys == sorted(keys) and q not in {r.vec_id for r in rows}
        hit += len({r.vec_id for r in rows} & set(want[q]))
    assert hit / (20 * len(want)) >= 0.9


def test_copies_ties_and_few_candidates(spark):
    x = np.array([[1.0, 0], [1, 0], [1, 0], [0, 1], [2, 0]], np.float32)
    rows = [(20 * i, v.tolist(), "", 0, "") for i, v in enumerate(x)]
    got = forest.nearest(spark.createDataFrame(rows + rows[:1], SCHEMA)).collect()
    lists = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        lists.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert lists[0] == [(80, 2.0), (20, 1.0), (40, 1.0), (60, 0.0)]
    assert lists[60] == [(0, 0.0), (20, 0.0), (40, 0.0), (80, 0.0)]
    assert set(lists) == {0, 20, 40, 60, 80}
    assert forest.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_forest_blocks_give_the_same(vectors, monkeypatch):
    x, df = vectors
    one = {tuple(r)[:4] for r in forest.nearest(df).collect()}
    monkeypatch.setattr(forest, "GROUP_ROWS", 20)
    assert {tuple(r)[:4] for r in forest.nearest(df).collect()} == one


def recall_of(rows, x, every=20):
    want = plain_nearest(x, range(0, len(x), every), 20)
    by = {}
    for r in rows:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    return np.mean([len(by.get(q, set()) & set(w)) / 20 for q, w in want.items()]), by


def test_answers_come_from_popped_leaves_only(spark):
    """With a sample far smaller than the table one leaf finds little, the audited budget most."""
    x = np.random.default_rng(9).standard_normal((6_000, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "", 0, "") for i, v in enumerate(x)], SCHEMA)
    one, by = recall_of(forest.nearest(df, 100, 20, sample_rows=600, budget=1).collect(), x, 100)
    assert one < 0.5
    few = forest.nearest(df, 100, 20, sample_rows=600).collect()
    many, by = recall_of(few, x, 100)
    assert many >= 0.9 and all(len(found) == 20 for found in by.values())
    assert few[0].popped_leaves > 1 and abs(few[0].audited_recall - many) < 0.08


def test_budget_of_one_leaf_on_a_table_within_the_sample(vectors):
    """The sample holds all rows here; it must not give answers of its own."""
    x, df = vectors
    one, _ = recall_of(forest.nearest(df, budget=1).collect(), x)
    assert one < 0.9


def test_priorities_order_the_leaf_of_the_query_first():
    x = made(2000).astype(np.float64)
    f = forest.fit(x, float(np.linalg.norm(x, axis=1).max()))
    unit = x[:50] / np.linalg.norm(x[:50], axis=1, keepdims=True) * f.scale
    width = 2 ** f.depth
    pr = f.priorities(unit).reshape(50, -1, width)
    assert (pr.argmax(2) == f.leaves(unit)).mean() > 0.99
