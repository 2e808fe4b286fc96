"""Nearest neighbours by a forest of random-projection trees.

Every tree halves the space along random directions at medians of a bounded sample; every vector
is indexed in a leaf of every tree. A query keeps one priority queue for all trees, ordered by the
smallest margin on the way to a leaf, and the leaves it pops are reranked exactly.

How many leaves to pop is not guessed: for a bounded number of audit queries the true neighbours
are found by brute force, and the queue position at which the wanted share of them is met is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import fraction, objects, stored, stored_row
from tidemark.llm.vectors import classes_of, lengths_of, matrix, usable_vectors

SAMPLE_ROWS = 16_384  # vectors that the trees are fitted on
TREES = 8
LEAF_ROWS = 32  # of the sample
AUDIT_QUERIES = 64
AUDIT_RECALL = 0.97
LEAVES_PER_GROUP = 16
GROUP_ROWS = 20_000  # vectors or queries that one task holds at a time


@dataclass
class Forest:
    directions: np.ndarray  # tree, node, dimension; unit length
    thresholds: np.ndarray  # tree, node
    depth: int
    scale: float

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with one more component that makes all lengths one: inner products then
        order like angles."""
        y = x / self.scale
        rest = np.sqrt(np.maximum(1 - (y * y).sum(1, keepdims=True), 0))
        return np.hstack([y, rest]).astype(np.float32)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        y = self.lifted(x)
        out = np.zeros((len(x), len(self.directions)), np.int32)
        for t, (w, b) in enumerate(zip(self.directions, self.thresholds)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", y, w[node]) > b[node]
                node = 2 * node + 1 + right
            out[:, t] = node - (2 ** self.depth - 1)
        return out

    def priorities(self, q: np.ndarray) -> np.ndarray:
        """For every query the priority of all leaves, tree after tree: the queue in bulk.

        A leaf's priority never exceeds its ancestors', so popping nodes one by one meets the
        leaves in just this order.
        """
        y = np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])
        out = []
        for w, b in zip(self.directions, self.thresholds):
            margin = y.astype(np.float32) @ w.T - b
            level = np.full((len(q), 1), np.inf, np.float32)
            for d in range(self.depth):
                m = margin[:, 2 ** d - 1:2 ** (d + 1) - 1]
                level = np.stack([np.minimum(level, -m), np.minimum(level, m)], 2)
                level = level.reshape(len(q), -1)
            out.append(level)
        return np.hstack(out)


def fit(sample: np.ndarray, scale: float, trees: int = TREES, seed: int = 7) -> Forest:
    draw = np.random.default_rng(seed)
    depth = max(int(np.log2(max(len(sample), 1) / LEAF_ROWS)), 0)
    nodes = 2 ** depth - 1
    directions = draw.standard_normal((trees, nodes, sample.shape[1] + 1)).astype(np.float32)
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    forest = Forest(directions, np.zeros((trees, nodes), np.float32), depth, scale)
    y = forest.lifted(sample)
    for t in range(trees):
        node = np.zeros(len(y), np.int64)
        for d in range(depth):
            side = np.einsum("ij,ij->i", y, directions[t][node])
            order = np.lexsort((side, node))
            starts = np.searchsorted(node[order], np.arange(2 ** d - 1, 2 ** (d + 1)))
            for k in range(2 ** d):
                own = side[order[starts[k]:starts[k + 1]]]
                if len(own):
                    forest.thresholds[t, 2 ** d - 1 + k] = own[(len(own) - 1) // 2]
            node = 2 * node + 1 + (side > forest.thresholds[t][node])
    return forest


def best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest entries of every row, ties beyond them included."""
    if scores.shape[1] > k:
        floor = np.partition(scores, -k, axis=1)[:, -k][:, None]
        return np.nonzero(scores >= floor)
    return np.nonzero(np.ones_like(scores, bool))


def audit_truth(classes: DataFrame, queries: pd.DataFrame, forest: Forest, k: int) -> pd.DataFrame:
    """The k nearest other classes of the audit queries among all rows, with their leaves."""
    q, own = matrix(queries["v"]), queries["rep"].to_numpy()

    def run(batches):
        for batch in batches:
            x, names = matrix(batch["v"]), batch["rep"].to_numpy()
            scores = q @ x.T
            scores[own[:, None] == names[None, :]] = -np.inf
            i, j = best_of(scores, k)
            yield pd.DataFrame({"i": i, "rep": names[j], "score": scores[i, j],
                                "leaves": objects(forest.leaves(x)[j])})

    found = classes.select("rep", "v").mapInPandas(
        run, "i int, rep long, score double, leaves array<int>")
    turn = Window.partitionBy("i").orderBy(F.desc("score"), "rep")
    return (found.where("score > double('-infinity')").withColumn("at", F.row_number().over(turn))
            .where(F.col("at") <= k).toPandas())  # k rows for each audit query


def queue_positions(forest: Forest, q: np.ndarray, truth: pd.DataFrame) -> np.ndarray:
    """How many leaves a query pops until it meets each of its true neighbours."""
    order = np.argsort(-forest.priorities(q), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], 1)
    width = 2 ** forest.depth
    codes = np.stack(truth["leaves"].to_numpy()) + width * np.arange(len(forest.directions))
    return place[truth["i"].to_numpy()[:, None], codes].min(1) + 1


def audited(classes: DataFrame, asked: DataFrame, forest: Forest, k: int, budget: int | None,
            leaves_in_all: int) -> tuple[int, float | None]:
    """How many leaves to pop, and the share of true neighbours that other queries then meet."""
    drawn = asked.orderBy(fraction(F.col("rep"), F.lit("audit"))).limit(2 * AUDIT_QUERIES).toPandas()
    truth = audit_truth(classes, drawn, forest, k) if len(drawn) else pd.DataFrame()
    if not len(truth):
        return budget or leaves_in_all, None
    needs = queue_positions(forest, matrix(drawn["v"]), truth)
    chosen = truth["i"].to_numpy() % 2 == 0
    if budget is None:
        budget = int(np.quantile(needs[chosen], AUDIT_RECALL, method="higher"))
    others = needs[~chosen] if (~chosen).any() else needs
    return budget, float((others <= budget).mean())


SHAPE = ("query_id long, rank int, vec_id long, score double, popped_leaves int, "
         "audited_recall double")


def nearest(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", sample_rows: int = SAMPLE_ROWS,
            budget: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score, popped_leaves, audited_recall.

    Queries are rows whose id is divisible by `every`, candidates all rows but the query's own.
    Nearness is the inner product in double precision; ties go to the smaller id. Vectors of
    different lengths have no inner product, so each length has a forest of its own. Rows that
    `usable_vectors` leaves out take no part; a repeated row counts once. Equal vectors are indexed
    once and expanded to their smallest ids at the end, so a vector that a third of the rows
    share is one entry. An empty table gives an empty result. Other columns are not read.

    Only rows of popped leaves are candidates. ``budget`` sets how many leaves a query pops; else
    half of the audit queries choose it and the other half measure ``audited_recall``.
    """
    vectors = stored(usable_vectors(rows, id_col, vector_col).distinct())
    out = rows.sparkSession.createDataFrame([], SHAPE)
    for length in lengths_of(vectors):
        own = vectors.where(F.col("length") == length).drop("length")
        out = out.union(nearest_of_length(own, every, k, sample_rows, budget))
    return out


def popped_floor(forest: Forest, chunk: np.ndarray, own: np.ndarray, popped: np.ndarray,
                 known: np.ndarray, known_names: np.ndarray, known_leaves: np.ndarray,
                 k: int) -> np.ndarray:
    """A lower bound of every query's k-th best score among its popped candidates.

    It is the k-th best of the fitting sample's vectors that stand in popped leaves: these are
    candidates themselves, so nothing below the bound can be among the k nearest found.
    """
    width = 2 ** forest.depth
    taken = np.zeros((len(chunk), len(forest.directions) * width), bool)
    np.put_along_axis(taken, popped, True, 1)
    met = np.zeros((len(chunk), len(known)), bool)
    for t in range(len(forest.directions)):
        met |= taken[:, t * width + known_leaves[:, t]]
    scores = chunk @ known.T
    scores[~met | (own[:, None] == known_names[None, :])] = -np.inf
    if scores.shape[1] <= k:
        return np.full(len(chunk), -np.inf)
    # The two ways of summing a product may differ by rounding.
    slack = 1e-9 * np.linalg.norm(chunk, axis=1) * forest.scale
    return np.partition(scores, -k, axis=1)[:, -k] - slack


def nearest_of_length(vectors: DataFrame, every: int, k: int, sample_rows: int,
                      budget: int | None) -> DataFrame:
    """`nearest` among distinct (id, v) of one length, at least one."""
    classes = stored(classes_of(vectors))
    norms = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    row = stored_row(classes.agg(F.count("*").alias("n"), F.max(norms).alias("scale")))
    sample = stored(classes.where(
        fraction(F.col("rep"), F.lit("forest")) < sample_rows / row.n).select("rep", "v"))
    drawn = sample.orderBy("rep").toPandas()  # about sample_rows vectors
    if len(drawn) <= k:
        drawn = classes.select("rep", "v").orderBy("rep").limit(4 * k).toPandas()
    known, known_names = matrix(drawn["v"]), drawn["rep"].to_numpy()
    forest = fit(known, row.scale)
    known_leaves = forest.leaves(known)
    kind = classes.schema["v"].dataType.simpleString()
    groups_wide = max(2 ** forest.depth // LEAVES_PER_GROUP, 1)
    asked = stored(classes.join(
        vectors.where(F.col("id") % every == 0).select("v").distinct(), "v").select("rep", "v"))
    leaves_in_all = len(forest.directions) * 2 ** forest.depth
    budget, recall = audited(classes, asked, forest, k, budget, leaves_in_all)
    row_blocks = int(np.ceil(row.n / groups_wide / GROUP_ROWS))
    query_blocks = int(np.ceil(asked.count() / GROUP_ROWS)) or 1
    shift = int(np.log2(LEAVES_PER_GROUP)) if groups_wide > 1 else forest.depth

    def index(batches):
        for batch in batches:
            codes = forest.leaves(matrix(batch["v"]))
            trees = codes.shape[1]
            yield pd.DataFrame({
                "tree": np.tile(np.arange(trees), len(batch)), "part": codes.ravel() >> shift,
                "leaf": codes.ravel(), "rep": np.repeat(batch["rep"].to_numpy(), trees),
                "v": np.repeat(batch["v"].to_numpy(), trees)})

    def route(batches):
        for batch in batches:
            for at in range(0, len(batch), 1024):
                chunk = batch.iloc[at:at + 1024]
                q = matrix(chunk["v"])
                pr = forest.priorities(q)
                order = np.argsort(-pr, axis=1, kind="stable")[:, :budget]
                floor = popped_floor(forest, q, chunk["rep"].to_numpy(), order, known, known_names,
                                     known_leaves, k)
                i = np.repeat(np.arange(len(q)), order.shape[1])
                tree, leaf = np.divmod(order.ravel(), 2 ** forest.depth)
                flat = pd.DataFrame({"i": i, "tree": tree, "part": leaf >> shift, "leaf": leaf})
                out = flat.groupby(["i", "tree", "part"])["leaf"].agg(list).reset_index()
                i = out.pop("i").to_numpy()
                out["rep"], out["v"] = chunk["rep"].to_numpy()[i], chunk["v"].to_numpy()[i]
                out["floor"] = floor[i]
                yield out

    def salted(df, blocks, name):
        return df.withColumn(name, F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))

    def spread(df, blocks, name):
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    held = classes.select("rep", "v").mapInPandas(
        index, f"tree int, part int, leaf int, rep long, v {kind}")
    held = spread(salted(held, row_blocks, "row_block"), query_blocks, "query_block")
    wanted = asked.mapInPandas(
        route, f"tree int, part int, leaf array<int>, rep long, v {kind}, floor double")
    wanted = spread(salted(wanted, query_blocks, "query_block"), row_blocks, "row_block")
    key = ["tree", "part", "row_block", "query_block"]

    def rerank(members, queries):
        """Exact scores of the popped leaves of one group."""
        found = []
        if len(members) and len(queries):
            x, names, leaf = matrix(members["v"]), members["rep"].to_numpy(), members["leaf"]
            rows_of = {c: np.asarray(r) for c, r in members.groupby("leaf").indices.items()}
            asks = queries[["leaf"]].reset_index(drop=True).explode("leaf")
            q, floor = matrix(queries["v"]), queries["floor"].to_numpy()
            own = queries["rep"].to_numpy()
            for c, i in asks.groupby("leaf").indices.items():
                j = rows_of.get(c)
                if j is None:
                    continue
                i = asks.index.to_numpy()[i]
                for at in range(0, len(i), 2048):
                    a = i[at:at + 2048]
                    rough = q[a] @ x[j].T
                    r, s = np.nonzero(rough >= floor[a][:, None])
                    exact = np.einsum("ij,ij->i", q[a[r]], x[j[s]])
                    found.append(pd.DataFrame({"query": own[a[r]], "rep": names[j[s]],
                                               "score": exact}))
        return pd.concat(found) if found else pd.DataFrame(
            {"query": [], "rep": [], "score": []}).astype({"query": "int64", "rep": "int64"})

    shape = "query long, rep long, score double"
    hits = (held.groupBy(*key).cogroup(wanted.groupBy(*key)).applyInPandas(rerank, shape)
            .groupBy("query", "rep").agg(F.max("score").alias("score")))
    # Only the k nearest classes can matter, with the query's own class k + 1 of them.
    turn = Window.partitionBy("query").orderBy(F.desc("score"))
    hits = hits.withColumn("at", F.rank().over(turn)).where(F.col("at") <= k + 1).drop("at")
    names = classes.select("rep", "v")
    turn = Window.partitionBy("v").orderBy("id")
    members = (vectors.withColumn("at", F.row_number().over(turn)).where(F.col("at") <= k + 1)
               .join(names, "v").select("rep", "id"))
    ids = vectors.where(F.col("id") % every == 0).join(names, "v").select(
        F.col("rep").alias("query"), F.col("id").alias("query_id"))
    turn = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.join(members, "rep").select("query", "score", F.col("id").alias("vec_id"))
            .join(ids, "query").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", F.lit(budget).alias("popped_leaves"),
                    F.lit(recall).alias("audited_recall")))
