"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64-bit SimHashes of word shingles. Correlated bits are grouped into partitions,
a dynamic program gives each partition its own threshold from estimated candidate counts, keys
are probed accordingly and every candidate is verified bit by bit.

With m partitions and thresholds t_1..t_m that sum to max_bits - m + 1, two fingerprints within
max_bits differ in at most t_i bits inside some partition i. A threshold of -1 skips a partition.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import components, lean, stored

SEED = 42
BLOCK = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """The SimHash of a text as an unsigned number; zero if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(words_per_shingle, len(words))
    shingles = zip(*(words[i:] for i in range(width)))
    total = len(words) - width + 1
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    hashes = np.fromiter(map(digest, map(b" ".join, shingles)), np.uint64, total)
    counts = np.zeros(64, np.int64)
    for i in range(0, total, BLOCK):
        bits = np.unpackbits(hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(((2 * counts > total).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, words_per_shingle: int, id_col="doc_id", text_col="text"):
    """(id, fp as a signed long) for every row; a null text has no words."""
    @lean
    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, words_per_shingle) for t in batch["t"]]
            yield pd.DataFrame({
                "id": batch["id"], "fp": np.array(prints, np.uint64).view(np.int64)})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")) \
        .mapInPandas(run, "id long, fp long")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together, over all of them."""
    @lean
    def run(batches):
        total = np.zeros((64, 64))
        n = 0
        for batch in batches:
            raw = batch["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        if n:
            i, j = np.divmod(np.arange(64 * 64), 64)
            yield pd.DataFrame({"i": np.append(i, -1), "j": np.append(j, -1),
                                "n": np.append(total.ravel(), n).astype(np.int64)})

    rows = (prints.select("fp").mapInPandas(run, "i int, j int, n long")
            .groupBy("i", "j").agg(F.sum("n").alias("n")).collect())  # 64 x 64 + 1 rows
    together, n = np.zeros((64, 64)), 0
    for r in rows:
        if r.i < 0:
            n = r.n
        else:
            together[r.i, r.j] = r.n
    return n, together


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of nearly equal size, each grown by its most correlated bit."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    free, groups = set(range(64)), []
    for k in range(parts):
        size = 64 // parts + (k < 64 % parts)
        seed = max(sorted(free), key=lambda b: related[b, sorted(free)].sum())
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            best = max(sorted(free), key=lambda b: related[b, group].mean())
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def as_signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def mask_of(bits: list[int]) -> int:
    return as_signed(sum(1 << b for b in bits))


def exact_collisions(prints: DataFrame, groups: list[list[int]]) -> list[float]:
    """Pairs that agree on all bits of a group, counted over all fingerprints."""
    keys = prints.select(F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(mask_of(g))) for g in groups])).alias("part", "key"))
    rows = (keys.groupBy("part", "key").agg(F.count("*").cast("double").alias("c"))
            .groupBy("part").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs"))
            .collect())  # a row per group
    found = {r.part: r.pairs for r in rows}
    return [found.get(i, 0.0) for i in range(len(groups))]


def estimated_candidates(n, together, group, agreeing, max_bits) -> list[float]:
    """Candidates plus probes of a group for thresholds -1, 0, .. max_bits.

    The chance that two fingerprints differ in d bits of the group follows from the bits' own
    frequencies and is scaled to the counted number of pairs that differ in none.
    """
    p = np.diag(together)[group] / max(n, 1)
    chance = np.zeros(max_bits + 1)
    chance[0] = 1.0
    for differs in 2 * p * (1 - p):
        chance[1:] = chance[1:] * (1 - differs) + chance[:-1] * differs
        chance[0] *= 1 - differs
    pairs = n * (n - 1) / 2
    scale = agreeing / (pairs * chance[0]) if agreeing and chance[0] and pairs else 1.0
    costs = [0.0]
    for t in range(max_bits + 1):
        probes = sum(comb(len(group), d) for d in range(t + 1))
        costs.append(pairs * chance[:t + 1].sum() * max(scale, 1.0) + n * probes)
    return costs


def allocate(costs: list[list[float]], max_bits: int) -> tuple[float, list[int]]:
    """Thresholds that sum to max_bits - m + 1 at the least total cost: a dynamic program."""
    best = {0: (0.0, [])}
    for own in costs:
        step = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, max_bits + 1):
                option = (cost + own[t + 1], chosen + [t])
                if used + t not in step or option < step[used + t]:
                    step[used + t] = option
        best = step
    return best[max_bits - len(costs) + 1]


def plan(prints: DataFrame, max_bits: int) -> tuple[list[list[int]], list[int]]:
    """The cheapest grouping into 2 .. max_bits + 2 partitions and its thresholds."""
    n, together = bit_statistics(prints)
    options = [group_bits(n, together, m) for m in range(2, max_bits + 3)]
    agreeing = exact_collisions(prints, [g for o in options for g in o])
    plans, at = [], 0
    for groups in options:
        own = [estimated_candidates(n, together, g, agreeing[at + i], max_bits)
               for i, g in enumerate(groups)]
        at += len(groups)
        plans.append((*allocate(own, max_bits), groups))
    _, thresholds, groups = min(plans)
    return groups, thresholds


def flips(bits: list[int], most: int) -> list[int]:
    """Every pattern that flips up to `most` of the bits."""
    return [mask_of(list(c)) for d in range(most + 1) for c in combinations(bits, d)]


def variants(column: Column, patterns: list[int]) -> Column:
    listed = F.array(*[F.lit(x).cast("long") for x in patterns])
    return F.transform(listed, lambda x: column.bitwiseXOR(x))


def near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(prints: DataFrame, max_bits: int, largest_bucket: int) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints within max_bits of each other.

    Buckets of more than `largest_bucket` fingerprints are not paired within. Their members, and
    those that probe them, go to an exact way without hot keys: each lists every fingerprint
    within half the distance, and two that are near share a listed one. A listed value has at
    most as many holders as the ball around it, whatever the data.
    """
    groups, thresholds = plan(prints, max_bits)
    used = [(i, g, t) for i, (g, t) in enumerate(zip(groups, thresholds)) if t >= 0]
    held = stored(prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(mask_of(g))).alias("key"))
        for i, g, _ in used])).alias("x")).select("fp", "x.part", "x.key"))
    asked = [held.where(F.col("part") == i).select(
        F.col("fp").alias("b"), "part", F.explode(variants(F.col("key"), flips(g, t))).alias("key"))
        for i, g, t in used]
    probes = asked[0]
    for more in asked[1:]:
        probes = probes.union(more)
    sizes = held.groupBy("part", "key").agg(F.count("*").alias("n"))
    large = stored(sizes.where(F.col("n") > largest_bucket).select("part", "key"))
    index = held.withColumnRenamed("fp", "a")
    pairs = (index.join(large, ["part", "key"], "left_anti").join(probes, ["part", "key"])
             .where((F.col("a") != F.col("b")) & near("a", "b", max_bits))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    crowd = (probes.join(large, ["part", "key"], "left_semi").select(F.col("b").alias("fp"))
             .union(held.join(large, ["part", "key"], "left_semi").select("fp")).distinct())
    ball = flips(list(range(64)), (max_bits + 1) // 2)
    listed = stored(crowd.select(F.col("fp").alias("a"),
                                 F.explode(variants(F.col("fp"), ball)).alias("key")))
    close = (listed.join(listed.withColumnRenamed("a", "b"), "key").where("a < b")
             .where(near("a", "b", max_bits)).select("a", "b"))
    return pairs.union(close).distinct()


def simhash_clusters(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 2,
                     largest_bucket: int = 256, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id, kept for every row of `docs`.

    Equal fingerprints are one node, so exact copies cost nothing beyond their own row.
    component_id is the smallest id reachable by links of at most `max_bits` differing bits.
    Null and empty texts have fingerprint zero and are linked like any other. Rows with a null
    id keep their row and never name a component that has an id. Repeated rows are repeated in the
    result. An empty table gives an empty result; other columns are not read.
    """
    rows = stored(fingerprints(docs, words_per_shingle, id_col, text_col))
    nodes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")))
    found = components(links(nodes.select("fp"), max_bits, largest_bucket), "a", "b")
    groups = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    lowest = groups.groupBy("component").agg(F.min("first").alias("component_id"))
    named = groups.join(lowest, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of `docs` for each group: the row with the smallest doc_id.

    Of several rows with that id the one with the smallest text stays (null first), of repeated
    rows one. A group without any id keeps one row in the same way. Null, empty and blank texts have
    one fingerprint, so they are one group. Whole texts of any length are read. All columns are
    returned as they came; an empty table gives an empty result.
    """
    kept = simhash_clusters(docs, **options).where("kept").select("doc_id").distinct()
    turn = Window.partitionBy("doc_id").orderBy("text")
    return (docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
            .withColumn("__turn", F.row_number().over(turn)).where("__turn = 1").drop("__turn"))
