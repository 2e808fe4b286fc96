"""Merkle manifest of a table of documents, stored in van Emde Boas order.

Every source is a tree whose runs of three consecutive nodes become one node; the sources' roots
form one more such tree. A tree is cut into aligned blocks of HEIGHT levels above WIDTH leaves, and
the roots of a level of blocks are the leaves of the next one, so each round works on a table that
is WIDTH times smaller. A block is one row: all its nodes in one byte string, laid out by splitting
its height in half again and again (top part first, then its bottom parts from left to right).
`addresses` computes the places, for building and for fetching siblings alike.

Proofs come from the top down: a block's own proof is joined with its nodes, one row per block.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import stored, stored_row
from tidemark.session import inline_rows

FAN = 3  # nodes of a run
HEIGHT = 7
WIDTH = FAN ** HEIGHT  # leaves of a block
DIGEST = 32  # bytes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def nodes_of(levels: int) -> int:
    """Nodes of a full tree with that many levels."""
    return (FAN ** levels - 1) // (FAN - 1)


def place(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where nodes of a full tree stand in van Emde Boas order.

    `depth` counts from the root, `index` from the left of that depth. The upper half of the levels
    comes first as a tree of its own, then every tree that hangs below it.
    """
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return place(top, depth, index)
    below, inside = np.divmod(index, FAN ** (depth - top))
    return (nodes_of(top) + below * nodes_of(levels - top)
            + place(levels - top, depth - top, inside))


@lru_cache(maxsize=HEIGHT + 1)
def addresses(height: int) -> list[np.ndarray]:
    """Places of all nodes of a block, leaves first, for blocks with that many levels of runs."""
    return [place(height + 1, height - k, np.arange(FAN ** (height - k)))
            for k in range(height + 1)]


def height_of(leaves: int) -> int:
    """Levels of runs above that many leaves until one node is left."""
    height, reach = 0, 1
    while reach < leaves:
        height, reach = height + 1, reach * FAN
    return height


def digest_of(texts: list[str]) -> bytes:
    return hashlib.sha256("".join(texts).encode()).digest()


def block_height(tree_leaves: int) -> int:
    """Blocks of a tree with several blocks are full in height, else they end at one node."""
    return HEIGHT if tree_leaves > WIDTH else height_of(tree_leaves)


def build(leaves: list[bytes], height: int) -> tuple[bytes, bytes]:
    """The laid out block and its root. Places of absent nodes hold zeros, the last ones are cut."""
    at = addresses(height)
    space = np.zeros((nodes_of(height + 1), DIGEST), np.uint8)
    level, last = leaves, 0
    for k in range(height + 1):
        own = at[k][:len(level)]
        space[own] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        last = max(last, int(own.max()))
        if k < height:
            texts = [d.hex() for d in level]
            level = [digest_of(texts[i:i + FAN]) for i in range(0, len(texts), FAN)]
    return space[:last + 1].tobytes(), level[0]


def sides(block: bytes, leaves: int, height: int) -> list[tuple[tuple[str, str], ...]]:
    """For every leaf the hex digests left and right of its path, level by level."""
    at = addresses(height)
    levels, count = [], leaves
    for k in range(height):
        texts = [block[DIGEST * p:DIGEST * (p + 1)].hex() for p in at[k][:count].tolist()]
        own = []
        for start in range(0, count, FAN):
            run = texts[start:start + FAN]
            own += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
        levels.append(own)
        count = -(-count // FAN)
    out = []
    for i in range(leaves):
        steps = []
        for own in levels:
            steps.append(own[i])
            i //= FAN
        out.append(tuple(steps))
    return out


def fold(leaf: str, steps) -> str:
    """The root that a leaf leads to beside the given siblings."""
    for left, right in steps:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def leaf_digest(*columns: Column) -> Column:
    """Hex digest of the columns' values, each as its length in UTF-8 bytes, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def leaves_of(docs: DataFrame, fields=FIELDS) -> DataFrame:
    """(source, doc_id, leaf, asked): leaf digests of the rows and of what they are tampered to.

    Rows whose decimal doc_id has an even CRC-32 lose the line feeds of their text; a null doc_id
    has none and a null text stays null.
    """
    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.coalesce(even, F.lit(False)) & F.coalesce(F.instr(text, "\n") > 0, F.lit(False))
    leaf = leaf_digest(*[F.col(c) for c in fields])
    other = leaf_digest(*[F.replace(text, F.lit("\n"), F.lit("")) if c == "text" else F.col(c)
                          for c in fields])
    rows = docs.select(F.col("source").cast("string").alias("source"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(leaf).alias("leaf"),
                       F.when(changed, F.unhex(other)).alias("asked"))
    return rows.withColumn("row", F.monotonically_increasing_id())


def placed(rows: DataFrame, tree: str | None, order: list[str]) -> DataFrame:
    """The rows with `tree` (a number that orders the trees), `n` (its rows) and `at` (from 0).

    Rows are dealt by ranges of (tree, order) and sorted inside them, so a tree with most rows
    spreads over all tasks. Places come from counts per range; only these, one number for each
    range, pass the driver. Columns in `order` must tell all rows apart.
    """
    spark = rows.sparkSession
    name = F.col(tree) if tree else F.lit(0)
    key = [F.col(c) for c in ([tree] if tree else []) + order]
    sorted_rows = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    sorted_rows = stored(sorted_rows.withColumn("__seq", F.monotonically_increasing_id()))
    part, index = F.shiftright("__seq", 33), F.col("__seq").bitwiseAND((1 << 33) - 1)
    ranges = sorted_rows.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = [], 0
    for r in ranges:
        starts.append((r.part, total))
        total += r["count"]
    # One row for each range, so bounded by the number of partitions.
    starts = F.broadcast(inline_rows(spark, {"part": "long", "start": "long"}, starts))
    numbered = (sorted_rows.withColumn("part", part).withColumn("index", index)
                .join(starts, "part").withColumn("__at", F.col("start") + F.col("index"))
                .drop("part", "start", "index", "__seq").withColumn("__name", name))
    trees = numbered.groupBy("__name").agg(F.min("__at").alias("tree"), F.count("*").alias("n")) \
        .withColumnRenamed("__name", "__tree_name")
    return (numbered.join(trees, F.col("__name").eqNullSafe(F.col("__tree_name")))
            .withColumn("at", F.col("__at") - F.col("tree")).drop("__at", "__name", "__tree_name"))


def layers_of(nodes: DataFrame) -> list[DataFrame]:
    """Stored layers (tree, n, block, leaves, nodes, root) of all trees, from the leaves up.

    `nodes` holds (tree, n, at, digest). A group is one block of at most WIDTH nodes.
    """
    def run(rows):
        rows = rows.sort_values("at")
        n = int(rows["n"].iloc[0])
        body, root = build(rows["digest"].tolist(), block_height(n))
        return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "n": [n],
                             "block": [rows["at"].iloc[0] // WIDTH], "leaves": [len(rows)],
                             "nodes": [body], "root": [root]})

    layers = []
    while True:
        block = F.floor(F.col("at") / WIDTH)
        layer = stored(nodes.select("tree", "n", "at", "digest")
                       .groupBy("tree", block.alias("block")).applyInPandas(
            run, "tree long, n long, block long, leaves int, nodes binary, root binary"))
        layers.append(layer)
        largest = stored_row(layer.agg(F.max("n").alias("n"))).n
        if largest is None or largest <= WIDTH:
            return layers
        nodes = layer.where(F.col("n") > WIDTH).select(
            "tree", F.ceil(F.col("n") / WIDTH).alias("n"), F.col("block").alias("at"),
            F.col("root").alias("digest"))


STEPS = "array<struct<left:string,right:string>>"


def roots_of(layers: list[DataFrame]) -> DataFrame:
    """(tree, root)."""
    parts = [layer.where(F.col("n") <= WIDTH).select("tree", "root") for layer in layers]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def steps_down(layers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first layer with `steps`: the siblings from each block's root to the very top.

    `above` holds (tree, steps) from a tree's root on.
    """
    def run(rows):
        out = []
        for r in rows.itertuples(index=False):
            own = sides(r.nodes, r.leaves, block_height(r.n))
            rest = [(s["left"], s["right"]) for s in r.steps]
            out += [(r.tree, r.block * WIDTH + i, [dict(left=a, right=b) for a, b in [*s, *rest]])
                    for i, s in enumerate(own)]
        return pd.DataFrame(out, columns=["tree", "block", "steps"])

    below = None
    for layer in reversed(layers):
        top = layer.where(F.col("n") <= WIDTH).join(above, "tree")
        if below is not None:
            top = top.unionByName(layer.where(F.col("n") > WIDTH).join(below, ["tree", "block"]))
        if layer is layers[0]:
            return top
        below = stored(top.groupBy("tree", "block").applyInPandas(
            run, f"tree long, block long, steps {STEPS}"))
    raise ValueError("no layers")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, proof_length.

    One row for every row of `docs`. Sources are ordered bytewise, a null source first; inside one
    the leaves ascend by doc_id (null first), equal ids by leaf digest; repeated rows are leaves
    each. Null values, empty and very long texts enter their leaf as they are. A source with one row
    has its leaf as subroot, a table with one source its subroot as root; an empty table gives an
    empty result. Other columns are not read.

    `proof_length` counts the siblings. Proof digests and folded roots are recomputed for every
    row from the siblings that the stored blocks hold.
    """
    spark = docs.sparkSession
    shape = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
             "folded_root string, verified boolean, proof_length int")
    rows = stored(placed(stored(leaves_of(docs)), "source", ["doc_id", "leaf", "row"]))
    layers = layers_of(rows.withColumnRenamed("leaf", "digest"))
    subroots = stored(roots_of(layers))
    if subroots.isEmpty():
        return spark.createDataFrame([], shape)
    tops = placed(subroots.withColumnRenamed("tree", "source_tree"), None, ["source_tree"])
    tops = stored(tops)
    upper = layers_of(tops.withColumnRenamed("root", "digest"))
    root = roots_of(upper).collect()[0].root.hex()  # the one tree of all sources

    def spread(blocks):
        out = []
        for r in blocks.itertuples(index=False):
            rest = [(s["left"], s["right"]) for s in r.steps]
            for i, own in enumerate(sides(r.nodes, r.leaves, block_height(r.n))):
                out.append((r.block * WIDTH + i,
                            [dict(left=a, right=b) for a, b in [*own, *rest]]))
        return pd.DataFrame(out, columns=["at", "steps"])

    nothing = tops.select("tree").distinct().withColumn("steps", F.array().cast(STEPS))
    first = steps_down(upper, nothing).groupBy("tree", "block").applyInPandas(
        spread, f"at long, steps {STEPS}")
    above = stored(tops.select("at", "source_tree", "root").join(first, "at").select(
        F.col("source_tree").alias("tree"), "steps", F.col("root").alias("subroot")))
    lowest = steps_down(layers, above.select("tree", "steps")).join(
        above.select("tree", "subroot"), "tree")

    def verify(blocks, members):
        """All proofs of one block. What leads up from one node is folded once."""
        out = []
        members = members.sort_values("at")
        for r in blocks.itertuples(index=False):
            own = sides(r.nodes, r.leaves, block_height(r.n))
            rest = [(s["left"], s["right"]) for s in r.steps]
            tail, subroot = "".join(a + b for a, b in rest), r.subroot.hex()
            longer = sum(len(a) + len(b) for a, b in rest)
            ends: dict[str, str] = {}
            for m, steps in zip(members.itertuples(index=False), own):
                leaf = m.leaf.hex()
                head = "".join(a + b for a, b in steps)
                node = fold(m.asked.hex() if m.asked is not None else leaf, steps)
                if node not in ends:
                    ends[node] = fold(node, rest)
                folded = ends[node]
                out.append((m.doc_id, leaf, subroot, root,
                            hashlib.sha256((head + tail).encode()).hexdigest(), folded,
                            folded == root, (len(head) + longer) // (2 * DIGEST)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in shape.split(", ")]).astype(
            {"doc_id": "Int64"})

    members = rows.select("tree", F.floor(F.col("at") / WIDTH).alias("block"), "at", "doc_id",
                          "leaf", "asked")
    return (lowest.groupBy("tree", "block").cogroup(members.groupBy("tree", "block"))
            .applyInPandas(verify, shape))


def oracle(levels: int = 12) -> str:
    """The same rows in DuckDB: one step for each level, for trees of pos most 3 ** levels leaves."""
    def leaf(text):
        parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' "
                 f"|| CAST({c} AS VARCHAR) END" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    crc = ("xor(list_reduce(list_transform(range(length(CAST(doc_id AS VARCHAR))), "
           "lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER) + 1, 1)) AS BIGINT)), "
           "lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], "
           "lambda x, y: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295), 4294967295)")
    shrunk = "replace(text, chr(10), '')"
    steps = [f"""
b AS MATERIALIZED (SELECT doc_id, coalesce('+' || source, '-') AS source,
  {leaf('text')} AS leaf, CASE WHEN {crc} % 2 = 0 THEN {leaf(shrunk)} ELSE {leaf('text')} END AS asked
  FROM documents),
d0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)
  - 1 AS pos, asked AS folded, '' AS proof FROM b),
v0 AS MATERIALIZED (SELECT source, pos, leaf AS digest FROM d0)"""]

    def climb(prefix, docs, nodes, of):
        """One tree level after the other over `nodes`; `docs` carries proofs and folds."""
        for k in range(levels):
            steps.append(f"""
{prefix}r{k} AS MATERIALIZED (SELECT {of}, pos // 3 AS run, list(digest ORDER BY pos) AS m,
  count(*) OVER (PARTITION BY {of}) = 1 AND count(*) = 1 AS done FROM {nodes}{k} GROUP BY {of}, pos // 3),
{docs}{k + 1} AS MATERIALIZED (SELECT d.* REPLACE (d.pos // 3 AS pos,
  CASE WHEN done THEN d.folded ELSE sha256(array_to_string(
    list_concat(list_concat(m[1:d.pos % 3], [d.folded]), m[d.pos % 3 + 2:]), '')) END AS folded,
  CASE WHEN done THEN d.proof ELSE d.proof || array_to_string(
    list_concat(m[1:d.pos % 3], m[d.pos % 3 + 2:]), '') END AS proof)
  FROM {docs}{k} d JOIN {prefix}r{k} r ON r.{of} = d.{of} AND r.run = d.pos // 3),
{nodes}{k + 1} AS MATERIALIZED (SELECT {of}, run AS pos,
  CASE WHEN done THEN m[1] ELSE sha256(array_to_string(m, '')) END AS digest FROM {prefix}r{k})""")

    climb("x", "d", "v", "source")
    steps.append(f"""
s AS MATERIALIZED (SELECT source, digest AS subroot,
  row_number() OVER (ORDER BY CASE source WHEN '-' THEN 0 ELSE 1 END, encode(source)) - 1 AS place
  FROM v{levels}),
w0 AS MATERIALIZED (SELECT 0 AS top, place AS pos, subroot AS digest FROM s),
e0 AS MATERIALIZED (SELECT d.doc_id, d.leaf, d.folded, d.proof, s.subroot, 0 AS top, s.place AS pos
  FROM d{levels} d JOIN s USING (source))""")
    climb("y", "e", "w", "top")
    return (f"WITH {','.join(steps)}\nSELECT doc_id, leaf, subroot, digest AS root, "
            "sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified, "
            f"CAST(length(proof) // 64 AS INTEGER) AS proof_length FROM e{levels}, w{levels}")
