"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors are dealt to overlapping shards around cluster centres. Each shard builds a robust-pruned
neighbour graph; the adjacency lists of a vector's copies are united. Every vector then searches
the shards around it: greedily from the shard's medoid, and once within range on through all
neighbours within range. Found links are verified in double precision, and recall is audited by
brute force on vectors drawn until enough true links are met; where too few are, on links planted
for the audit. If recall is too low the search widens and runs again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components, fraction, stored
from tidemark.llm.vectors import (
    bounded_sample, classes_of, lengths_of, matrix, usable_vectors)
from tidemark.session import inline_rows

SAMPLE_ROWS = 16_384  # vectors that cluster centres are fitted on
SHARD_ROWS = 1_000  # wanted vectors at each centre
MOST_CENTRES = 1_024  # beyond, shards are dealt to more blocks of BLOCK_ROWS
BLOCK_ROWS = 4_000  # vectors that one graph holds
OVERLAP = 2  # shards whose graph holds a vector
PROBES = 4  # shards that a vector searches
CANDIDATES, DEGREE, SLACK = 48, 16, 1.2
BEAM = 32
MEDOIDS = 32  # where searches of a shard begin
CHUNK = 1_024
STEP_EDGES = 1 << 19  # edges that one step of a search looks at
AUDIT_ROWS = 64  # vectors of the first block that the audit draws; each further one is twice as large
AUDIT_LINKS = 2_000  # links between classes that show a recall of AUDIT_RECALL
AUDIT_BLOCK, AUDIT_MOST = 1_024, 16_384  # vectors of one pass and of all passes of the audit
AUDIT_RECALL = 0.999
PLANTED = 256  # vectors that are given a neighbour where too few links are met


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres(sample: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means on the sample."""
    draw = np.random.default_rng(seed)
    x = unit(sample).astype(np.float32)
    c = x[draw.choice(len(x), k, replace=False)]
    for _ in range(10):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-9), c)
    return c


def pruned(x: np.ndarray) -> np.ndarray:
    """Robust-pruned neighbours of each vector (rows of indices, -1 where there are fewer).

    From the nearest candidates the nearest one is taken, candidates that are closer to it (times
    the slack) than to the vector are dropped, and so on.
    """
    n = len(x)
    width = min(CANDIDATES, n - 1)
    out = np.full((n, DEGREE), -1, np.int32)
    if width < 1:
        return out
    for at in range(0, n, CHUNK):
        rows = np.arange(at, min(at + CHUNK, n))
        sims = x[rows] @ x.T
        sims[np.arange(len(rows)), rows] = -2
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        own = np.take_along_axis(sims, near, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
        far = np.sqrt(np.maximum(2 - 2 * own, 0))
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("rid,rjd->rij", x[near], x[near]), 0))
        alive = np.ones(near.shape, bool)
        each = np.arange(len(rows))
        for d in range(DEGREE):
            some = alive.any(1)
            pick = alive.argmax(1)  # candidates are in order of distance
            out[rows[some], d] = near[each, pick][some]
            alive &= SLACK * between[each, pick] > far
            alive[each, pick] = False
    return out


def connected(x: np.ndarray, lists: list[np.ndarray], start: int) -> list[np.ndarray]:
    """Lists with reverse edges, and an edge to the nearest reached vector for what the start
    does not reach."""
    n = len(x)
    tail = np.repeat(np.arange(n), [len(a) for a in lists])
    head = np.concatenate(lists) if n else np.zeros(0, int)
    code = np.unique(np.concatenate([tail * n + head, head * n + tail]))
    tail, head = np.divmod(code, n)
    lists = np.split(head, np.searchsorted(tail, np.arange(1, n)))
    reached = np.zeros(n, bool)
    front = np.array([start])
    while True:
        while len(front):
            reached[front] = True
            nxt = np.unique(np.concatenate([lists[i] for i in front]))
            front = nxt[~reached[nxt]] if len(nxt) else nxt
        left = np.flatnonzero(~reached)
        if not len(left):
            return lists
        held = np.flatnonzero(reached)
        j = left[0]
        i = held[(x[held] @ x[j]).argmax()]
        lists[i] = np.append(lists[i], j)
        lists[j] = np.append(lists[j], i)
        front = np.array([j])


@dataclass
class Adjacency:
    """Neighbour lists one after the other: memory follows the edges, not the largest hub."""

    starts: np.ndarray
    degrees: np.ndarray
    heads: np.ndarray

    @classmethod
    def of(cls, lists: list[np.ndarray]) -> Adjacency:
        degrees = np.fromiter(map(len, lists), np.int64, len(lists))
        return cls(np.cumsum(degrees) - degrees, degrees, np.concatenate(lists).astype(np.int64))

    def around(self, rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every (row, neighbour of the row's node)."""
        counts = self.degrees[nodes]
        at = np.arange(counts.sum()) + np.repeat(
            self.starts[nodes] - (np.cumsum(counts) - counts), counts)
        return np.repeat(rows, counts), self.heads[at]

    def pieces(self, nodes: np.ndarray) -> list[np.ndarray]:
        """Positions of the nodes in runs of at most about STEP_EDGES edges."""
        upto = np.cumsum(self.degrees[nodes])
        return np.split(np.arange(len(nodes)), np.flatnonzero(np.diff(upto // STEP_EDGES)) + 1)


def fresh(codes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Codes that were not seen before, once each; marks them."""
    codes = codes[~seen[codes]]
    seen[codes] = True
    return np.unique(codes)


def medoids(x: np.ndarray) -> np.ndarray:
    """The vectors nearest to the middles of a shard's own clusters, the shard's medoid first."""
    middles = centres(x, min(MEDOIDS, len(x)))
    picked = np.append((x @ x.mean(0)).argmax(), (x @ middles.T).argmax(0))
    return picked[np.sort(np.unique(picked, return_index=True)[1])]


def search(q: np.ndarray, x: np.ndarray, graph: Adjacency, starts: np.ndarray, cosine: float,
           beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) within range, by greedy search from the medoids, then expansion.

    All queries of a chunk take a step together. Similarities are computed only for the vectors
    that a query meets.
    """
    n, m = len(q), len(x)
    seen = np.zeros(n * m, bool)
    each = np.arange(n)
    first = q @ x[starts].T
    order = np.argsort(-first, axis=1, kind="stable")[:, :beam]
    best = np.full((n, beam), starts[0])
    score = np.full((n, beam), -3.0, np.float32)
    best[:, :order.shape[1]] = starts[order]
    score[:, :order.shape[1]] = np.take_along_axis(first, order, 1)
    todo = score > -3
    met = each[:, None] * m + starts[None, :]
    seen[met] = True
    hits = [met[first >= cosine]]

    def meet(rows, nodes):
        """Unseen neighbours of the nodes, with their similarity to the row's query."""
        owners, around = graph.around(rows, nodes)
        codes = fresh(owners * m + around, seen)
        i, j = np.divmod(codes, m)
        sims = np.concatenate([np.einsum("ij,ij->i", q[i[a:a + 65536]], x[j[a:a + 65536]])
                               for a in range(0, len(i), 65536)] or [np.zeros(0, np.float32)])
        return i, j, sims

    while todo.any():
        rows = np.flatnonzero(todo.any(1))
        pick = np.where(todo[rows], score[rows], -3).argmax(1)
        nodes = best[rows, pick]
        todo[rows, pick] = False
        i, j, sims = meet(rows, nodes)
        hits.append((i * m + j)[sims >= cosine])
        if not len(i):
            continue
        owners, first, counts = np.unique(i, return_index=True, return_counts=True)
        width = counts.max()
        new_nodes = np.zeros((len(owners), width), np.int64)
        new_score = np.full((len(owners), width), -3, np.float32)
        slot = np.arange(len(i)) - np.repeat(first, counts)
        row = np.repeat(np.arange(len(owners)), counts)
        new_nodes[row, slot], new_score[row, slot] = j, sims
        all_nodes = np.hstack([best[owners], new_nodes])
        all_score = np.hstack([score[owners], new_score])
        all_todo = np.hstack([todo[owners], new_score > -3])
        top = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
        best[owners] = np.take_along_axis(all_nodes, top, 1)
        score[owners] = np.take_along_axis(all_score, top, 1)
        todo[owners] = np.take_along_axis(all_todo, top, 1)
    front = np.concatenate(hits)
    found = [front]
    while len(front):
        grown = []
        nodes = front % m
        for piece in graph.pieces(nodes):
            i, j, sims = meet(front[piece] // m, nodes[piece])
            grown.append((i * m + j)[sims >= cosine])
        front = np.concatenate(grown)
        found.append(front)
    return np.divmod(np.unique(np.concatenate(found)), m)


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def near_duplicates(rows: DataFrame, cosine: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept, audited_recall for every row.

    audited_recall is the share of audited links between classes that were found, for vectors of
    the row's length; it is null only for rows that cannot link.

    A link is a cosine of at least `cosine` between two rows' vectors, in double precision.
    Vectors that `usable_vectors` leaves out link with nothing and stand for themselves; so does a
    row with a null id. Vectors of different lengths do not link: each length has graphs of its
    own. Rows with equal vectors are one class: they link with each other and share all other
    links, so copies cost one search. A repeated row is a copy of itself. An empty table gives an
    empty result. Other columns are not read.

    No pair leaves the task that finds it: tasks return, for each vector, how many rows it links
    with and the smallest name in its local component, and those few rows are joined up.
    """
    vectors = stored(usable_vectors(rows, id_col, vector_col))
    own = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    per_class = None
    for length in lengths_of(vectors):
        classes = stored(classes_of(vectors.where(F.col("length") == length)))
        found, recall = linked_classes(classes, cosine)
        parts = components(found, "rep", "root")
        linked = (classes.join(links_per_class(found), "rep", "left")
                  .join(parts, F.col("rep") == F.col("node"), "left")
                  .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                          F.coalesce("component", "rep").alias("component"),
                          F.lit(recall).cast("double").alias("recall")))
        per_class = linked if per_class is None else per_class.union(linked)
    if per_class is None:
        per_class = own.select("v", F.lit(0).alias("links"), F.col("id").alias("component"),
                               F.lit(None).cast("double").alias("recall")).where("false")
    same = (own["v"] == per_class["v"]) & own["id"].isNotNull()
    return own.join(per_class, same, "left").select(
        F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"),
        F.col("recall").alias("audited_recall"))


def linked_classes(classes: DataFrame, cosine: float) -> tuple[DataFrame, float]:
    """What `searched` finds among classes of one length, and the audited share of links in it."""
    spark = classes.sparkSession
    total = classes.count()
    sample = bounded_sample(classes, total, SAMPLE_ROWS, "graph")
    if not len(sample):
        sample = matrix(classes.select("v").orderBy("rep").limit(100).toPandas()["v"])
    k = int(min(max(total // SHARD_ROWS, 1), MOST_CENTRES, len(sample)))
    middle = centres(sample, k)
    truth, trial = audited(classes, cosine), classes
    natural = sum(truth.values()) >= min(AUDIT_LINKS, PLANTED)
    if not natural:
        trial, more = planted(classes, cosine)
        truth = truth | more
    wanted = sum(truth.values())
    asked = inline_rows(spark, {"rep": "long"}, [(int(r),) for r in truth])
    probes, beam = min(PROBES, k), BEAM
    while True:
        found = stored(searched(trial, middle, cosine, probes, beam))
        got = {r.rep: r.classes for r in found.join(F.broadcast(asked), "rep").groupBy("rep").agg(
            F.sum("classes").alias("classes")).collect()}  # as many rows as `truth`
        recall = sum(min(got.get(r, 0), n) for r, n in truth.items()) / wanted
        if recall >= AUDIT_RECALL or probes == k and beam >= BLOCK_ROWS:
            break
        probes, beam = min(2 * probes, k), 2 * beam
    if not natural:
        found = stored(searched(classes, middle, cosine, probes, beam))
    return found, recall


def planted(classes: DataFrame, cosine: float) -> tuple[DataFrame, dict[int, int]]:
    """The classes with a new neighbour for PLANTED of them, just within the wanted cosine, and
    these neighbours with the one link that each must find.

    The hardest links there are: at the very edge of the range, in directions drawn at random.
    """
    spark = classes.sparkSession
    chosen = classes.orderBy(fraction(F.col("rep"), F.lit("planted")), "rep").limit(PLANTED)
    chosen = chosen.select("rep", "v").toPandas()
    x = unit(matrix(chosen["v"]))
    near = cosine + 1e-4 * (1 - cosine)
    aside = np.random.default_rng(17).standard_normal(x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    # In one dimension nothing is aside: the neighbour is the vector itself, twice as long.
    y = np.where(length > 1e-9, near * x + math.sqrt(1 - near * near) * aside
                 / np.maximum(length, 1e-9), 2 * x)
    first = classes.agg(F.max("rep").alias("m")).collect()[0].m + 1
    names = [first + i for i in range(len(y))]
    more = spark.createDataFrame([(v.tolist(), n, 1) for n, v in zip(names, y)],
                                 classes.select("v", "rep", "n").schema)
    return stored(classes.select("v", "rep", "n").union(more)), {n: 1 for n in names}


def searched(classes: DataFrame, middle: np.ndarray, cosine: float, probes: int,
             beam: int) -> DataFrame:
    """(rep, links, classes, root): for every task and vector with links there, how many rows and
    classes it found and the smallest name of its component in that task.

    A vector is a member of the OVERLAP shards nearest to it, at home in the nearest one, and
    searches the `probes` nearest. Only members at home are found, so no link counts twice.
    """
    kind = classes.schema["v"].dataType.simpleString()
    reach = min(max(OVERLAP, probes), len(middle))

    def assign(batches):
        for batch in batches:
            sims = unit(matrix(batch["v"])).astype(np.float32) @ middle.T
            near = np.argsort(-sims, axis=1, kind="stable")[:, :reach]
            for place in range(reach):
                yield batch.assign(shard=near[:, place], place=place)

    spread = stored(classes.select("rep", "v", "n").mapInPandas(
        assign, f"rep long, v {kind}, n long, shard int, place int"))
    held, asking = F.col("place") < OVERLAP, F.col("place") < probes
    sizes = spread.groupBy("shard").agg(F.count_if(held).alias("held"),
                                        F.count_if(asking).alias("asking")).collect()  # centres
    blocks = inline_rows(classes.sparkSession, {"shard": "int", "blocks": "int", "turns": "int"}, [
        (r.shard, -(-r.held // BLOCK_ROWS) or 1, -(-r.asking // BLOCK_ROWS) or 1) for r in sizes])
    spread = spread.join(F.broadcast(blocks), "shard")  # at most MOST_CENTRES rows

    def salt(count):
        return F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")

    members = spread.where(held).withColumn("block", salt("blocks"))

    def build(key, data):
        x = unit(matrix(data["v"])).astype(np.float32)
        names = data["rep"].to_numpy()
        near = [names[a[a >= 0]] for a in pruned(x)]
        return pd.DataFrame({"rep": names, "near": near})

    lists = members.groupBy("shard", "block").applyInPandas(build, "rep long, near array<long>")
    united = stored(lists.groupBy("rep").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    members = members.join(united, "rep").withColumn("turn", F.explode(F.sequence(
        F.lit(0), F.col("turns") - 1))).select("shard", "block", "turn", "rep", "v", "n",
                                               (F.col("place") == 0).alias("home"), "near")
    queries = spread.where(asking).withColumn("turn", salt("turns")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select(*[F.col(c).alias(c) for c in ("shard", "block", "turn", "rep", "v")])

    def find(data, asks):
        empty = pd.DataFrame({"rep": [], "links": [], "classes": [], "root": []}).astype("int64")
        if not len(data) or not len(asks):
            return empty
        data = data.sort_values("rep", ignore_index=True)
        asks = asks.sort_values("rep", ignore_index=True)
        names, asked = data["rep"].to_numpy(), asks["rep"].to_numpy()
        exact, exact_q = matrix(data["v"]), matrix(asks["v"])
        x, q = unit(exact).astype(np.float32), unit(exact_q).astype(np.float32)
        near = []
        for listed in data["near"]:
            at = np.minimum(np.searchsorted(names, listed), len(names) - 1)
            near.append(at[names[at] == listed])
        starts = medoids(x)
        linked = Adjacency.of(connected(x, near, starts[0]))
        ends = []
        for at in range(0, len(q), CHUNK):
            i, j = search(q[at:at + CHUNK], x, linked, starts, cosine - 1e-3, beam)
            ends.append((i + at, j))
        i, j = (np.concatenate(e) for e in zip(*ends))
        # What one side found holds for the other side too, where both are here.
        back_q = np.minimum(np.searchsorted(asked, names[j]), len(asked) - 1)
        back_x = np.minimum(np.searchsorted(names, asked[i]), len(names) - 1)
        both = (asked[back_q] == names[j]) & (names[back_x] == asked[i])
        code = np.unique(np.concatenate([i * len(names) + j,
                                         back_q[both] * len(names) + back_x[both]]))
        i, j = np.divmod(code, len(names))
        ok = data["home"].to_numpy()[j] & (asked[i] != names[j])
        i, j = i[ok], j[ok]
        lengths, lengths_q = np.linalg.norm(exact, axis=1), np.linalg.norm(exact_q, axis=1)
        sims = np.concatenate([
            np.einsum("ij,ij->i", exact_q[i[a:a + 65536]], exact[j[a:a + 65536]])
            / (lengths_q[i[a:a + 65536]] * lengths[j[a:a + 65536]])
            for a in range(0, len(i), 65536)] or [np.zeros(0)])
        i, j = i[sims >= cosine], j[sims >= cosine]
        if not len(i):
            return empty
        nodes, at = np.unique(np.concatenate([asked[i], names[j]]), return_inverse=True)
        a, b = at[:len(i)], at[len(i):]
        links = np.bincount(a, weights=data["n"].to_numpy()[j], minlength=len(nodes))
        return pd.DataFrame({"rep": nodes, "links": links.astype(np.int64),
                             "classes": np.bincount(a, minlength=len(nodes)),
                             "root": nodes[roots_of(len(nodes), a, b)]})

    key = ["shard", "block", "turn"]
    return members.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(
        find, "rep long, links long, classes long, root long")


def audited(classes: DataFrame, cosine: float) -> dict[int, int]:
    """The audited classes that have links, and with how many other classes each one links.

    Where links are rare a fixed number of vectors would meet none and show nothing. More are drawn
    until AUDIT_LINKS links are met, or AUDIT_MOST vectors were compared with all.
    """
    drawn = classes.select("rep", "v").orderBy(fraction(F.col("rep"), F.lit("audit")), "rep") \
        .limit(AUDIT_MOST).toPandas()
    truth: dict[int, int] = {}
    at, size = 0, AUDIT_ROWS
    while at < len(drawn) and sum(truth.values()) < AUDIT_LINKS:
        truth |= true_links(classes, drawn.iloc[at:at + size], cosine)
        at, size = at + size, min(2 * size, AUDIT_BLOCK)
    return truth


def true_links(classes: DataFrame, audit: pd.DataFrame, cosine: float) -> dict[int, int]:
    """By brute force over all classes: with how many others each audited one links, if any."""
    q, own = unit(matrix(audit["v"])), audit["rep"].to_numpy()

    def run(batches):
        for batch in batches:
            sims = q @ unit(matrix(batch["v"])).T
            sims[own[:, None] == batch["rep"].to_numpy()[None, :]] = -2
            links = (sims >= cosine).sum(1)
            yield pd.DataFrame({"rep": own[links > 0], "links": links[links > 0]})

    found = classes.mapInPandas(run, "rep long, links long").groupBy("rep").agg(
        F.sum("links").alias("links"))
    return {r.rep: r.links for r in found.collect()}


def links_per_class(found: DataFrame) -> DataFrame:
    return found.groupBy("rep").agg(F.sum("links").alias("links"))
