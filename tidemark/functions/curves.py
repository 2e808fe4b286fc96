"""Curves over one ordered series: logs, seasonality, carry-over and saturation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F


def log_level(c: Column) -> Column:
    """Natural log with a floor of 1e-6; null stays null."""
    return F.when(c.isNotNull(), F.ln(F.greatest(c, F.lit(1e-6))))


def log1p_level(c: Column) -> Column:
    """log(1+x) with negatives taken as zero; null stays null."""
    return F.when(c.isNotNull(), F.log1p(F.greatest(c, F.lit(0.0))))


def fourier(t: Column, k: int, period: int) -> tuple[Column, Column]:
    angle = t * F.lit(2 * math.pi * k) / F.lit(period)
    return F.sin(angle), F.cos(angle)


BLOCK = 128  # periods


def adstock(x: Column, decay: Column | float, max_decay: float, keys: list[str],
            order: str) -> Column:
    """Carry-over a[t] = x[t] + d a[t-1] of short series, for any decay, 1 and more included.

    A period's value folds all earlier periods of its series: `adstocked` has linear work.
    """
    d = decay if isinstance(decay, Column) else F.lit(float(decay))
    if max_decay == 0:
        return F.coalesce(x, F.lit(0.0))
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.collect_list(F.coalesce(x, F.lit(0.0))).over(frame)
    return F.aggregate(so_far, F.lit(0.0), lambda carried, now: carried * d + now)


def adstocked(df: DataFrame, outputs: dict[str, tuple[Column, Column | float]], keys: list[str],
              order: str) -> DataFrame:
    """The rows with carry-over columns a[t] = x[t] + d a[t-1], ``outputs`` naming (x, d).

    A null x counts as zero; d may be any number, 1 and more included, and may differ by row. A
    prefix scan in blocks of BLOCK periods: inside a block a period folds the block's earlier
    ones; a block is reduced to a weight and a carry, blocks are scanned the same way, and every
    period takes the carry of the blocks before its own. Work is linear in the periods and no
    row holds more than BLOCK of them, up to BLOCK ** 3 periods a series.
    """
    steps = {name: F.struct(
        (d if isinstance(d, Column) else F.lit(float(d))).cast("double").alias("w"),
        F.coalesce(x.cast("double"), F.lit(0.0)).alias("c")) for name, (x, d) in outputs.items()}
    scanned = _scanned(df.withColumns({f"__s_{n}": s for n, s in steps.items()}),
                       [f"__s_{n}" for n in outputs], keys, order, 2)
    return scanned.withColumns({n: F.col(f"__s_{n}.c") for n in outputs}).drop(
        *[f"__s_{n}" for n in outputs])


def _scanned(df: DataFrame, steps: list[str], keys: list[str], order: str,
             levels: int) -> DataFrame:
    """Every step (w, c) joined with all earlier ones of its series: w the product of weights, c
    the carry c[t] = c + w c[t-1]."""
    def folded(frame) -> dict:
        return {s: F.aggregate(
            F.collect_list(s).over(frame), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("c")),
            lambda a, b: F.struct((a["w"] * b["w"]).alias("w"), (a["c"] * b["w"] + b["c"]).alias("c")))
            for s in steps}

    in_order = Window.partitionBy(*keys).orderBy(order)
    if levels == 0:
        return df.withColumns(folded(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    at, block, after = (f"__{name}{levels}" for name in ("at", "block", "after"))
    placed = df.withColumn(at, F.row_number().over(in_order) - 1).withColumn(
        block, F.floor(F.col(at) / BLOCK))
    inside = Window.partitionBy(*keys, block).orderBy(at)
    inner = placed.withColumns(folded(inside.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = inner.groupBy(*keys, block).agg(*[F.max_by(s, at).alias(s) for s in steps])
    carries = _scanned(blocks, steps, keys, block, levels - 1).select(
        *[F.col(k).alias(f"__key_{k}") for k in keys], (F.col(block) + 1).alias(after),
        *[F.col(s)["c"].alias(f"__carry{i}") for i, s in enumerate(steps)])
    same = F.col(block) == F.col(after)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    joined = inner.join(carries, same, "left")
    return joined.withColumns({
        s: F.struct(F.col(s)["w"].alias("w"), (F.col(s)["c"] + F.col(s)["w"] * F.coalesce(
            f"__carry{i}", F.lit(0.0))).alias("c")) for i, s in enumerate(steps)}).drop(
        at, block, after, *[f"__key_{k}" for k in keys],
        *[f"__carry{i}" for i in range(len(steps))])


def hill(x: Column, alpha: Column, half: Column) -> Column:
    """Diminishing returns x^a / (x^a + K^a)."""
    xa = F.pow(F.greatest(x, F.lit(0.0)), alpha)
    return xa / (xa + F.pow(half, alpha) + F.lit(1e-12))
