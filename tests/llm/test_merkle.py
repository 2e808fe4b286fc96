"""The manifest against a plain tree in lists."""

import hashlib
import zlib

import numpy as np
import pytest

from checks.compare import compare
from tidemark.llm import merkle as M
from tidemark.llm.queries import ORACLES, QUERIES

SHAPE = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def path(level, i):
    """Root and (left, right) of every level."""
    steps = []
    while len(level) > 1:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        steps.append((run[:i % 3], run[i % 3 + 1:]))
        level = [sha("".join(level[k:k + 3])) for k in range(0, len(level), 3)]
        i //= 3
    return level[0], steps


def plain(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for own in trees.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subroots = [path([leaf(r) for r in trees[s]], 0)[0] for s in names]
    out = []
    for k, s in enumerate(names):
        for i, row in enumerate(trees[s]):
            _, low = path([leaf(r) for r in trees[s]], i)
            root, high = path(subroots, k)
            asked = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4]:
                asked = (*row[:4], row[4].replace("\n", ""))
            node = leaf(asked)
            for left, right in low + high:
                node = sha("".join(left) + node + "".join(right))
            proof = "".join("".join(a) + "".join(b) for a, b in low + high)
            out.append((row[0], leaf(row), subroots[k], root, sha(proof), node, node == root,
                        len(proof) // 64))
    return sorted(out, key=repr)


def got(spark, rows, **more):
    docs = spark.createDataFrame(rows, SHAPE)
    for name, value in more.items():
        docs = docs.selectExpr("*", f"{value} AS `{name}`")
    return sorted(map(tuple, M.manifest(docs).collect()), key=repr)


def test_places_are_a_permutation():
    for height in range(M.HEIGHT + 1):
        at = np.concatenate(M.addresses(height))
        assert sorted(at.tolist()) == list(range(M.nodes_of(height + 1)))


def test_halves_stand_together():
    at = M.addresses(3)  # four levels: two above, nine trees of two levels below
    assert sorted([int(at[3][0]), *at[2].tolist()]) == [0, 1, 2, 3]
    for k in range(9):
        own = [int(at[1][k]), *at[0][3 * k:3 * k + 3].tolist()]
        assert sorted(own) == list(range(4 + 4 * k, 8 + 4 * k))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 28])
def test_one_source(spark, size):
    rows = [(i, "web", "en", i, f"line {i}\nmore") for i in range(size)]
    assert got(spark, rows) == plain(rows)


def test_odd_rows(spark):
    long_text = "word\n" * 200_000
    rows = [(None, None, None, None, None), (3, None, "de", 2, "a\nb"), (3, None, "de", 2, "a\nb"),
            (3, "", "de", 2, ""), (4, "é", None, 1, "ü\n"), (-5, "z", "en", 0, None),
            (6, "Z", "en", 5, long_text), (6, "Z", "en", 5, "other\n"), (8, "z", "en", 7, "-")]
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, tree="1", at="doc_id", root="'x'", n="2", leaf="3") == plain(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("height", [1, 2, 3])
def test_recursion_over_block_roots(height):
    rows = [(i, "web" if i % 3 else f"site {i % 60}", "en", i, f"a\n{i}") for i in range(400)]
    assert got_in_process(rows, height) == plain(rows)


def got_in_process(rows, height):
    """The operator's own steps without Spark, on blocks of that height."""
    width = M.FAN ** height

    def tree(digests):
        layers, nodes = [], digests
        while True:
            h = height if len(nodes) > width else M.height_of(len(nodes))
            blocks = [nodes[i:i + width] for i in range(0, len(nodes), width)]
            layers.append([(*M.build(b, h), len(b), h) for b in blocks])
            if len(blocks) == 1:
                return layers
            nodes = [b[1] for b in layers[-1]]

    def steps(layers, i):
        out = []
        for layer in layers:
            body, _, count, h = layer[i // width]
            out += M.sides(body, count, h)[i % width]
            i //= width
        return out

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: s.encode())
    for own in groups.values():
        own.sort(key=lambda r: r[0])
    trees = {s: tree([bytes.fromhex(leaf(r)) for r in groups[s]]) for s in names}
    subroots = [trees[s][-1][0][1] for s in names]
    top = tree(subroots)
    root = top[-1][0][1].hex()
    out = []
    for k, s in enumerate(names):
        for i, row in enumerate(groups[s]):
            way = steps(trees[s], i) + steps(top, k)
            asked = row
            if zlib.crc32(str(row[0]).encode()) % 2 == 0:
                asked = (*row[:4], row[4].replace("\n", ""))
            folded = M.fold(leaf(asked), way)
            proof = "".join(a + b for a, b in way)
            out.append((row[0], leaf(row), subroots[k].hex(), root, sha(proof), folded,
                        folded == root, len(proof) // 64))
    return sorted(out, key=repr)


def test_more_than_one_block_on_spark(spark):
    rows = [(i, "web" if i < 2 * M.WIDTH + 5 else f"s{i}", "en", i, f"{i}\n")
            for i in range(2 * M.WIDTH + 9)]
    assert got(spark, rows) == plain_fast(rows)


def plain_fast(rows):
    """`plain` for one large source: levels are computed once."""
    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k:k + 3])) for k in range(0, len(out[-1]), 3)])
        return out

    def way(tree, i):
        steps = []
        for level in tree[:-1]:
            run = level[i // 3 * 3:i // 3 * 3 + 3]
            steps.append(("".join(run[:i % 3]), "".join(run[i % 3 + 1:])))
            i //= 3
        return steps

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: s.encode())
    trees = {s: levels([leaf(r) for r in groups[s]]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, row in enumerate(groups[s]):
            steps = way(trees[s], i) + way(top, k)
            text = row[4].replace("\n", "") if zlib.crc32(str(row[0]).encode()) % 2 == 0 else row[4]
            node = M.fold(leaf((*row[:4], text)), steps)
            proof = "".join(a + b for a, b in steps)
            out.append((row[0], leaf(row), trees[s][-1][0], top[-1][0], sha(proof), node,
                        node == top[-1][0], len(proof) // 64))
    return sorted(out, key=repr)


def test_sql_twin(spark, folder, duck):
    name = "op12_merkle"
    verdict = compare(spark, duck, name, QUERIES[name], ORACLES[name], folder)
    assert verdict.startswith("ok"), verdict
