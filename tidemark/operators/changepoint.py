"""Change-points: online run-length filtering, peaks, context windows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.curves import log1p_level, log_level


def series_priors(series: DataFrame, keys: list[str], order: str, value: str,
                  train: int = K.TRAIN_PERIODS) -> DataFrame:
    """Mean of the training part, and the population variance of its first differences.

    A training part without differences falls back to its level variance.
    """
    in_order = Window.partitionBy(*keys).orderBy(order)
    steps = series.select(
        *keys, F.col(value).alias("x"), (F.row_number().over(in_order) - 1).alias("t"),
        (F.col(value) - F.lag(value).over(in_order)).alias("dx"))
    inside = F.col("t") < train
    moved = F.coalesce(F.var_pop(F.when(inside, F.col("dx"))), F.lit(0.0))
    return steps.groupBy(*keys).agg(
        F.avg(F.when(inside, F.col("x"))).alias("mu_0"),
        F.when(moved > 0, moved).otherwise(F.var_pop(F.when(inside, F.col("x"))))
        .alias("beta_0"))


def run_length_filter(x: np.ndarray, mu_0: float, beta_0: float, hazard: float,
                      short_run: int = K.CP_SHORT_RUN):
    """Run-length posterior of Adams and MacKay (2007), constant hazard, Normal-Gamma prior.

    Only the current posterior is kept. Per step: P(run <= short_run) and E[run] after the
    observation. Works with logs, so far outliers cannot make every weight vanish.
    """
    n = len(x)
    runs = np.arange(n + 1)
    kappa = 1.0 + runs
    alpha = 1.0 + runs / 2.0
    # Student-t with 2 alpha degrees of freedom: its constant for every run length.
    shape = np.array([
        math.lgamma(a + 0.5) - math.lgamma(a) - 0.5 * math.log(2.0 * math.pi * a)
        for a in alpha])
    mu, beta = np.array([mu_0]), np.array([max(beta_0, 1e-300)])
    weight = np.array([1.0])
    short, expected = np.empty(n), np.empty(n)
    for t in range(n):
        a, k = alpha[: t + 1], kappa[: t + 1]
        spread = beta * (k + 1.0) / (a * k)
        off = (x[t] - mu) ** 2
        log_p = (shape[: t + 1] - 0.5 * np.log(spread)
                 - (a + 0.5) * np.log1p(off / (2.0 * a * spread)))
        with np.errstate(divide="ignore"):
            log_joint = np.log(weight) + log_p
        joint = np.exp(log_joint - log_joint.max())
        weight = np.empty(t + 2)
        weight[0] = joint.sum() / hazard
        weight[1:] = joint * (1.0 - 1.0 / hazard)
        weight /= weight.sum()
        short[t] = weight[: short_run + 1].sum()
        expected[t] = float(runs[: t + 2] @ weight)
        beta = np.concatenate(([max(beta_0, 1e-300)], beta + k * off / (2.0 * (k + 1.0))))
        mu = np.concatenate(([mu_0], (k * mu + x[t]) / (k + 1.0)))
    return short, expected


def change_probabilities(series: DataFrame, keys: list[str], order: str, value: str,
                         hazard: str | float = K.DEFAULT_HAZARD,
                         train: int = K.TRAIN_PERIODS) -> DataFrame:
    """``cp_prob`` and ``exp_run_length`` per period, all series in one job.

    The only grouped-map step: one call per series, over rolled-up periods. Long histories
    cost the square of their periods, never of their detail rows.
    Periods without a value are left out (`missing_periods` counts them); ``t`` counts the others.
    Returns keys, order column, ``t``, value, ``cp_prob``, ``exp_run_length``.
    """
    series = series.where(F.col(value).isNotNull())
    priors = series_priors(series, keys, order, value, train)
    rate = F.col(hazard) if isinstance(hazard, str) else F.lit(float(hazard))
    carried = [hazard] if isinstance(hazard, str) else []
    # Rolled-up series and their priors share the series key, so one shuffle serves both.
    ready = series.select(*keys, order, value, *carried).join(priors, keys).select(
        *keys, order, F.col(value).alias("x"), "mu_0", "beta_0",
        rate.cast("double").alias("hazard"))
    types = {f.name: f.dataType.simpleString() for f in ready.schema}
    kept = [*keys, order]
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    schema += f", t int, `{value}` double, cp_prob double, exp_run_length double"

    def one_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        first = pdf.iloc[0]
        short, expected = run_length_filter(
            pdf["x"].to_numpy(dtype=float), first["mu_0"], first["beta_0"], first["hazard"])
        out = pdf[kept].copy()
        out["t"] = np.arange(len(pdf), dtype=np.int32)
        out[value] = pdf["x"]
        out["cp_prob"] = short
        out["exp_run_length"] = expected
        return out

    return ready.groupBy(*keys).applyInPandas(one_series, schema)


def missing_periods(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Periods per series that have no value: ``keys, n_missing``."""
    return series.groupBy(*keys).agg(F.count_if(F.col(value).isNull()).alias("n_missing"))


def change_candidates(probs: DataFrame, keys: list[str], threshold: float = K.CP_THRESHOLD,
                      distance: int = K.CP_MIN_DISTANCE) -> DataFrame:
    """Peaks of ``cp_prob``: strict local maxima at least ``threshold`` high.

    A flat top counts once, at its middle; a series' ends never count. Of peaks closer than
    ``distance`` the higher stays, the later one on ties. Probabilities are compared at twelve
    digits, so rounding noise makes no peaks.
    """
    in_order = Window.partitionBy(*keys).orderBy("t")
    level = F.round("cp_prob", 12)
    flats = (
        probs.select(*keys, "t", level.alias("p"))
        .withColumn("starts", F.coalesce(
            (F.col("p") != F.lag("p").over(in_order)).cast("int"), F.lit(1)))
        .withColumn("flat", F.sum("starts").over(in_order))
        .groupBy(*keys, "flat").agg(
            F.min("t").alias("t_from"), F.max("t").alias("t_to"), F.first("p").alias("p")))
    by_flat = Window.partitionBy(*keys).orderBy("flat")
    tops = (
        flats.withColumn("left_p", F.lag("p").over(by_flat))
        .withColumn("right_p", F.lead("p").over(by_flat))
        .where((F.col("p") > F.col("left_p")) & (F.col("p") > F.col("right_p"))
               & (F.col("p") >= threshold))
        .withColumn("t", F.floor((F.col("t_from") + F.col("t_to")) / 2).cast("int")))
    ranked = tops.groupBy(*keys).agg(F.sort_array(
        F.collect_list(F.struct("p", "t")), asc=False).alias("peaks"))
    spaced = F.aggregate(
        "peaks", F.array().cast("array<int>"),
        lambda kept, peak: F.when(
            F.exists(kept, lambda k: F.abs(k - peak["t"]) < distance), kept
        ).otherwise(F.array_append(kept, peak["t"])))
    chosen = ranked.select(*keys, F.explode(spaced).alias("t"))
    return probs.join(chosen, [*keys, "t"])


def context_windows(probs: DataFrame, candidates: DataFrame, keys: list[str],
                    half_width: int = K.CP_CONTEXT) -> DataFrame:
    """Rows within ``half_width`` periods of each change-point, clipped at the ends.

    Each change-point names its positions, so the match is an equality join.
    """
    wanted = candidates.select(
        *keys, F.col("t").alias("cp_t"),
        F.explode(F.sequence(F.col("t") - half_width, F.col("t") + half_width)).alias("t"))
    return probs.join(wanted, [*keys, "t"])


def change_deltas(context: DataFrame, keys: list[str], value: str) -> DataFrame:
    """First, last and difference of a value over each context window."""
    return context.groupBy(*keys, "cp_t").agg(
        F.min_by(value, "t").alias("before"), F.max_by(value, "t").alias("after"),
    ).withColumn("delta", F.col("after") - F.col("before"))


def transformed_level(value, skewness):
    """log1p for strongly right-skewed measures, log otherwise."""
    return F.when(F.coalesce(skewness > 1.5, F.lit(False)), log1p_level(value)).otherwise(
        log_level(value))


def long_measures(series: DataFrame, keys: list[str], date: str,
                  measures: list[str]) -> DataFrame:
    """Rolled-up measures stacked, so that every measure is one more series of one job."""
    rows = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
        for m in measures])
    return series.select(*keys, date, F.explode(rows).alias("m")).select(
        *keys, date, "m.measure", "m.value")
