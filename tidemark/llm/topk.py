"""Exact top-k search by inner product of integer vectors, by a uniform threshold in three phases.

The dimensions are cut into SLICES lists of local scores; a score is the sum of its local ones. Rows
are packed into runs of bounded size and queries into tiles; one task holds a tile and a run with
all their slices, so local lists are joined where they arise.

1. Every run hands on the best local scores of each slice, with the whole scores of their rows. The
   k-th best whole score of a query over all runs is a safe cutoff: no row below it can be wanted.
2. The cutoff goes to every run. A row that reaches it must reach a SLICES-th of it in some slice,
   so only such entries are collected. The sum of the collected local scores, and the uniform
   threshold in place of the others, bounds the row's score from above.
3. Rows whose bound reaches the cutoff are resolved: their missing local scores are added, and what
   reaches the cutoff is kept.

Integers are exact at every size: products are taken in the narrowest number type that holds all
partial sums of a tile and a run, beyond 53 bits in integers of any length.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import stored

SLICES = 2
FACTOR = 64
TILE_QUERIES = 4096  # at most; fewer where there are few queries, so that tasks share the work
SMALL_TILE, TASKS = 256, 16
RUN_NUMBERS = 1 << 22  # components of a run
SCORES = 1 << 21  # that a task holds at a time for each slice
LONG = 1 << 63
LOWEST = -(1 << 4096)  # below every inner product of finite vectors
INFINITY = float("inf")
HUGE = 1e300  # components from here on are no longer multiplied as doubles


def usable(rows: DataFrame, id_col: str, vector_col: str, factor: int) -> DataFrame:
    """(id, key, huge): rows with an id and a vector of finite numbers.

    `key` holds floor(factor * x) as doubles, the components themselves if one of them is `huge`.
    """
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITY))
    low = F.transform(v, lambda x: F.when(F.abs(x) < float(1 << 40),
                                          F.floor(x * factor).cast("double")).otherwise(x * factor) + 0.0)
    return rows.select(F.col(id_col).cast("long").alias("id"),
                       F.col(vector_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.coalesce(sound, F.lit(False))) \
        .withColumn("huge", F.exists(v, lambda x: F.abs(x) >= HUGE)) \
        .select("id", F.when(F.col("huge"), v).otherwise(low).alias("key"), "huge").distinct()


def integers(rows: list, huge: list, factor: int) -> np.ndarray:
    """The vectors' integers, in the narrowest type; Python's own where a long is too short."""
    x = np.stack(rows).astype(np.float64)
    if not any(huge) and (not x.size or np.abs(x).max() < LONG // 2):
        x = np.floor(x).astype(np.int64)  # only components from 2**40 on can have a fraction
        high = int(np.abs(x).max()) if x.size else 0
        return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64)
                             if high <= np.iinfo(t).max))
    return np.array([[math.floor(Fraction(c) * (factor if own else 1)) for c in row]
                     for row, own in zip(x.tolist(), huge)], dtype=object)


def scoring_type(a: np.ndarray, b: np.ndarray):
    """The narrowest type in which all sums of products, and of two of them, are exact."""
    def high(x):
        return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0

    bound = high(a) * high(b) * max(a.shape[1], 1)
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 52 else object


def slices_of(width: int) -> list[slice]:
    ends = [width * s // SLICES for s in range(SLICES + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def local_scores(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """One matrix of local scores for every slice."""
    return [q[:, s] @ x[:, s].T for s in slices_of(q.shape[1])]


def best_places(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of k largest entries of every row."""
    if scores.shape[1] > k:
        order = (np.argsort(-scores, axis=1, kind="stable")[:, :k] if scores.dtype == object
                 else np.argpartition(scores, -k, axis=1)[:, -k:])
    else:
        order = np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    return np.repeat(np.arange(len(scores)), order.shape[1]), order.ravel()


def chunks(q: np.ndarray, x: np.ndarray):
    rows = max(SCORES // max(len(q), 1), 64)
    return ((at, x[at:at + rows]) for at in range(0, len(x), rows))


def gathered(q, x, queries, members, k) -> pd.DataFrame:
    """Phase 1: the best local entries of every slice, with the whole scores of their rows."""
    best = {}  # by slice: query, row and local score of its best entries so far
    for at, part in chunks(q, x):
        for s, local in enumerate(local_scores(q, part)):
            i, j = best_places(local, k + 1)
            found = pd.DataFrame({"i": i, "row": at + j, "local": as_long(local[i, j])})
            if s in best:
                found = pd.concat([best[s], found])
            best[s] = found.sort_values("local", ascending=False, kind="stable") \
                .groupby("i").head(k + 1)
    pairs = pd.concat(best.values())[["i", "row"]].drop_duplicates()
    i, j = pairs["i"].to_numpy(), pairs["row"].to_numpy()
    other = queries.names[i] != members.names[j]
    i, j = i[other], j[other]
    return pd.DataFrame({"query": queries.names[i], "rep": members.names[j],
                         "low": members.lows[j], "score": as_long((q[i] * x[j]).sum(1))})


def wide(numbers: np.ndarray) -> np.ndarray:
    return numbers if numbers.dtype == object else numbers.astype(np.float64)


def resolved(q, x, queries, members, k) -> pd.DataFrame:
    """Phases 2 and 3: every row of the run that reaches its query's cutoff, k + 1 at most.

    More than k + 1 rows of a run cannot be wanted: among equal scores the smaller ids win.
    """
    cutoff = [LOWEST if c == -LONG else c for c in queries.cutoffs.tolist()]
    share = [-(-c // SLICES) for c in cutoff]
    if q.dtype == object:
        cutoff, share = (np.array(c, dtype=object) for c in (cutoff, share))
    else:
        cutoff, share = (np.array([-np.inf if c < -LONG else c for c in own], np.float64)
                         for own in (cutoff, share))
    limit = share.astype(q.dtype)[:, None]
    kept, held = [], 0
    for at, part in chunks(q, x):
        local = local_scores(q, part)
        entry = [scores >= limit for scores in local]
        i, j = np.nonzero(np.logical_or.reduce(entry))
        known = [wide(scores[i, j]) for scores in local]
        bound = sum(np.where(e[i, j], scores, share[i]) for e, scores in zip(entry, known))
        open_ = bound >= cutoff[i]
        i, j = i[open_], j[open_]
        score = sum(scores[open_] for scores in known)
        near = score >= cutoff[i]
        i, j, score = i[near], j[near], as_long(score[near])
        kept.append(pd.DataFrame({"query": queries.names[i], "rep": members.names[at + j],
                                  "low": members.lows[at + j], "score": score}))
        held += len(i)
        if held > 1 << 20:
            kept = [leading(pd.concat(kept), k)]
            held = len(kept[0])
    return leading(pd.concat(kept), k)


def leading(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k + 1 best rows of every query; one of them may be the query itself."""
    found = found.sort_values(["score", "low", "rep"], ascending=[False, True, True], kind="stable")
    return found.groupby("query").head(k + 1)


def as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.array([min(max(int(s), -LONG), LONG - 1) for s in scores], np.int64)


def packed(classes: DataFrame, block: str, factor: int) -> DataFrame:
    """The vectors of a block (width, block) in one row: names, smallest ids, cutoffs, integers.

    Integers are bytes of the narrowest type, decimal texts where a long is too short.
    """
    def run(rows):
        x = integers(rows["key"].tolist(), rows["huge"].tolist(), factor)
        body = (",".join(map(str, x.ravel())).encode() if x.dtype == object else x.tobytes())
        return pd.DataFrame({
            "width": [int(rows["width"].iloc[0])], block: [int(rows[block].iloc[0])],
            "kind": [x.dtype.char], "body": [body],
            **{c: [rows[c].to_numpy("int64").tobytes()] for c in ("rep", "low", "cutoff")}})

    return classes.groupBy("width", block).applyInPandas(
        run, f"width int, {block} int, kind string, body binary, rep binary, low binary, cutoff binary")


class Block:
    def __init__(self, row):
        self.names, self.lows, self.cutoffs = (
            np.frombuffer(b, np.int64) for b in (row.rep, row.low, row.cutoff))
        flat = (np.array([int(t) for t in row.body.decode().split(",") if t], dtype=object)
                if row.kind == "O" else np.frombuffer(row.body, row.kind))
        self.x = flat.reshape(len(self.names), row.width)


def search(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", factor: int = FACTOR,
           run_numbers: int = RUN_NUMBERS) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest integer inner product, exactly.

    Components become floor(factor * x). Queries are the rows whose id is divisible by `every`,
    candidates all rows but the query's own; ties go to the smaller id. Rows with a null id, a null
    vector, or a null or non-finite component take no part; zero and empty vectors do. Vectors of
    different lengths have no inner product, so each length is searched by itself. A repeated row
    counts once; rows with one id and different vectors are rows each. Scores beyond the range of a
    long are given, and compared, as its ends. An empty table gives an empty result; other columns
    are not read.

    Equal vectors are scored once and expanded to their k + 1 smallest ids at the end, so a vector
    that a third of the rows share is one entry.
    """
    vectors = stored(usable(rows, id_col, vector_col, factor))
    same = ["key", "huge"]
    classes = stored(vectors.groupBy(*same).agg(F.min("id").alias("low"))
                     .withColumn("rep", F.monotonically_increasing_id())
                     .withColumn("width", F.size("key")))
    members = stored(vectors.join(classes.select(*same, "rep"), same).select("rep", "id"))
    asked = members.where(F.col("id") % every == 0)
    wanted = classes.join(asked.select("rep").distinct(), "rep")
    least = F.greatest("width", F.lit(1))
    runs = classes.groupBy("width").agg(F.count("*").alias("n")).select(
        "width", F.ceil(F.col("n") / F.greatest(F.floor(F.lit(run_numbers) / least), F.lit(1)))
        .cast("int").alias("runs"))
    tiles = wanted.groupBy("width").agg(F.count("*").alias("q")).select("width", F.greatest(
        F.ceil(F.col("q") / TILE_QUERIES), F.least(F.lit(TASKS), F.ceil(F.col("q") / SMALL_TILE)))
        .cast("int").alias("tiles"))
    counts = stored(runs.join(tiles, "width"))  # one row for each length of vectors
    hashed = F.xxhash64("rep")
    held = stored(packed(classes.join(counts, "width").withColumn(
        "run", F.pmod(hashed, F.col("runs")).cast("int")).withColumn("cutoff", F.lit(0)),
        "run", factor))

    def spread(blocks, count, name):
        return blocks.join(counts.select("width", count), "width").withColumn(
            name, F.explode(F.sequence(F.lit(0), F.col(count) - 1))).drop(count)

    grid = ["width", "run", "tile"]

    def pairs(queries, fn):
        """fn on every tile of queries and every run of rows."""
        def run(members, tiles):
            out = [pd.DataFrame({c: [] for c in ("query", "rep", "low", "score")}, dtype="int64")]
            for t in map(Block, tiles.itertuples(index=False)):
                for m in map(Block, members.itertuples(index=False)):
                    kind = scoring_type(t.x, m.x)
                    out.append(fn(t.x.astype(kind), m.x.astype(kind), t, m, k))
            return pd.concat(out)

        own = packed(queries.join(counts, "width").withColumn(
            "tile", F.pmod(hashed, F.col("tiles")).cast("int")), "tile", factor)
        return spread(held, "tiles", "tile").groupBy(*grid).cogroup(
            spread(own, "runs", "run").groupBy(*grid)).applyInPandas(
                run, "query long, rep long, low long, score long")

    wanted = stored(wanted.withColumn("cutoff", F.lit(0)))
    turn = Window.partitionBy("query").orderBy(F.desc("score"))
    cutoffs = (pairs(wanted, gathered).withColumn("at", F.row_number().over(turn))
               .where(F.col("at") == k).select(F.col("query").alias("rep"), "score"))
    # Lists of fewer than k other vectors are all vectors there are: none is cut off.
    wanted = stored(wanted.drop("cutoff").join(cutoffs, "rep", "left")
                    .withColumn("cutoff", F.coalesce("score", F.lit(-LONG))).drop("score"))
    turn = Window.partitionBy("query").orderBy(F.desc("score"), "low", "rep")
    hits = stored(pairs(wanted, resolved).withColumn("at", F.row_number().over(turn))
                  .where(F.col("at") <= k + 1).select("query", "rep", "score"))
    turn = Window.partitionBy("rep").orderBy("id")
    first = members.withColumn("at", F.row_number().over(turn)).where(F.col("at") <= k + 1) \
        .select("rep", F.col("id").alias("vec_id"))
    turn = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.join(first, "rep")
            .join(asked.select(F.col("rep").alias("query"), F.col("id").alias("query_id")), "query")
            .where("query <> rep or vec_id <> query_id")
            .withColumn("rank", F.row_number().over(turn)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
