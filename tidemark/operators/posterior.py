"""Posterior draws of the attribution model, and how well their chains agree.

A series reaches its draws as one row of sums of products, whatever its length. Chains are rows of
their own, so all chains of all series are drawn in parallel; the diagnostics are aggregations.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.operators.attribution import (
    CHANNEL_SIGMA, COMPETITOR_SIGMA, CONTROL_SIGMA, INTERCEPT_SIGMA, NOISE_SIGMA, feature_kinds,
    gram_rows)
from tidemark.session import ship_package

CHAINS, TUNE, DRAWS, SEED = 4, 1000, 2000, 42  # fixed values: the batch run's settings


def below_zero(draw: np.random.Generator, mean: float, sd: float) -> float:
    """A draw of N(mean, sd) given that it is at most zero, exact far into the tail as well.

    Near the bulk by rejection, in the tail by Robert's exponential proposals (1995).
    """
    low = mean / sd  # the bound lies so many deviations above the mean when negated
    if low <= 0:
        while True:
            x = mean + sd * draw.standard_normal()
            if x <= 0:
                return x
    rate = (low + math.sqrt(low * low + 4)) / 2
    while True:
        z = low + draw.exponential(1 / rate)
        if draw.random() <= math.exp(-((z - rate) ** 2) / 2):
            return mean - sd * z


def gibbs_chain(n, sum_y, sum_yy, sum_x, sum_xy, gram, kinds, seed, tune=TUNE,
                draws=DRAWS) -> np.ndarray:
    """Draws (rows) of intercept, coefficients and noise from sums of products.

    The model of `attribution.solve_map`. Given the rest, the intercept and the coefficients
    without a sign are jointly normal and drawn together, since trends go along with each other;
    coefficients with a sign are normal cut at zero. The noise variance is proposed from its
    conditional without prior, an inverse gamma, and accepted by the prior's ratio.
    """
    size, draw = len(kinds), np.random.default_rng(seed)
    # Column 0 is the intercept's.
    xx, xy = np.zeros((size + 1, size + 1)), np.append(sum_y, sum_xy)
    upper = np.zeros((size, size))
    upper[np.triu_indices(size)] = gram
    xx[0, 0], xx[0, 1:], xx[1:, 0] = n, sum_x, sum_x
    xx[1:, 1:] = upper + np.triu(upper, 1).T
    sigma_of = {"channel": CHANNEL_SIGMA, "competitor": COMPETITOR_SIGMA, "control": CONTROL_SIGMA}
    precision = np.array([INTERCEPT_SIGMA ** -2, *(sigma_of[k] ** -2 for k in kinds)])
    centre = np.zeros(size + 1)
    centre[0] = sum_y / n
    signed = [j for j, k in enumerate(kinds, 1) if k != "control"]
    free = np.array([0, *(j for j, k in enumerate(kinds, 1) if k == "control")])
    b = np.zeros(size + 1)
    b[0] = centre[0] + 0.1 * draw.standard_normal()
    s2 = NOISE_SIGMA ** 2 * (0.5 + draw.random())
    out = np.empty((draws, size + 2))
    for t in range(-tune, draws):
        for j in signed:
            rest = xy[j] - xx[j] @ b + xx[j, j] * b[j]
            weight = xx[j, j] / s2 + precision[j]
            mean, sd = rest / s2 / weight, weight ** -0.5
            b[j] = (-below_zero(draw, -mean, sd) if kinds[j - 1] == "channel"
                    else below_zero(draw, mean, sd))
        b[free] = 0.0
        low = np.linalg.cholesky(xx[np.ix_(free, free)] / s2 + np.diag(precision[free]))
        pull = (xy[free] - xx[free] @ b) / s2 + precision[free] * centre[free]
        mean = np.linalg.solve(low.T, np.linalg.solve(low, pull))
        b[free] = mean + np.linalg.solve(low.T, draw.standard_normal(len(free)))
        sse = max(sum_yy - 2 * xy @ b + b @ xx @ b, 1e-12)
        proposed = sse / 2 / draw.gamma(max(n - 1, 1) / 2)
        if draw.random() < math.exp(min(0.0, (s2 - proposed) / (2 * NOISE_SIGMA ** 2))):
            s2 = proposed
        if t >= 0:
            out[t, :-1], out[t, -1] = b, math.sqrt(s2)
    return out


def posterior_draws(matrix: DataFrame, config: K.SeriesConfig, keys: list[str],
                    chains: int = CHAINS, tune: int = TUNE, draws: int = DRAWS,
                    seed: int = SEED) -> DataFrame:
    """``keys, parameter, chain, draws``: every chain's draws of a parameter as one array.

    Parameters are ``intercept``, ``sigma`` and the feature names. A chain depends only on the
    series' sums, its number and the seed.
    """
    names = [c[2:] for c in matrix.columns if c.startswith("X_")]
    kind_of = feature_kinds(names, config)
    kinds = [kind_of[c] for c in names]
    grams = gram_rows(matrix, keys).withColumn(
        "chain", F.explode(F.sequence(F.lit(0), F.lit(chains - 1))))
    # Few rows with much work each: one task for each chain of a series, up to the partitions.
    spread = grams.repartition(*keys, "chain")
    types = {f.name: f.dataType.simpleString() for f in grams.schema}
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    parameters = ["intercept", *names, "sigma"]

    def sample(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                r = row._asdict()
                found = gibbs_chain(
                    float(r["n"]), r["sum_y"], r["sum_yy"], np.asarray(r["sum_x"]),
                    np.asarray(r["sum_xy"]), np.asarray(r["gram"]), kinds,
                    [seed, int(r["chain"])], tune, draws)
                yield pd.DataFrame({
                    **{k: [r[k]] * len(parameters) for k in keys}, "parameter": parameters,
                    "chain": int(r["chain"]), "draws": list(found.T)})

    ship_package(matrix.sparkSession)
    return spread.mapInPandas(sample, ", ".join(
        ([schema] if schema else []) + ["parameter string, chain int, draws array<double>"]))


def probit(p: Column) -> Column:
    """Quantile of the standard normal, by Acklam's rational approximations (error below 2e-9)."""
    # Coefficients of the published approximation.
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01, 1.0]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00, 1.0]

    def poly(coefficients, x):
        out = F.lit(coefficients[0])
        for k in coefficients[1:]:
            out = out * x + F.lit(k)
        return out

    q = p - 0.5
    r = q * q
    tail = lambda u: poly(c, F.sqrt(-2 * F.ln(u))) / poly(d, F.sqrt(-2 * F.ln(u)))
    return F.when(p < 0.02425, tail(p)).when(p > 1 - 0.02425, -tail(1 - p)).otherwise(
        poly(a, r) * q / poly(b, r))


def _once(rows: DataFrame, **made: Column) -> DataFrame:
    """More columns, each computed once per row: a generator keeps the optimizer from copying an
    expression into the lambdas that use it, where it would run for every element."""
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("__made")
    return rows.select("*", one).select("*", *[f"__made.{n}" for n in made]).drop("__made")


def diagnostics(draws: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n, mean, sd, rhat, ess_bulk`` from one row per chain with its array ``draws``.

    ``keys`` name the parameter. Chains are split in halves (a middle draw of an odd number is left
    out) and need equal lengths. R-hat compares variances between and within halves; the bulk
    effective sample size uses normal scores of the pooled ranks and sums autocorrelations while
    the sums of neighbouring lags are positive and falling (Vehtari and others, 2021). Null where
    draws are constant or a half has fewer than two.
    """
    half = F.floor(F.size("draws") / 2).cast("int")
    halves = draws.select(*keys, "chain", F.posexplode(F.array(
        F.slice("draws", F.lit(1), half), F.reverse(F.slice(F.reverse("draws"), F.lit(1), half))))
        .alias("half", "x"))
    single = halves.select(*keys, "chain", "half", F.posexplode("x").alias("t", "x"))
    whole = Window.partitionBy(*keys)
    # One parameter's draws: chains times draws, whatever the size of the data.
    place = F.rank().over(whole.orderBy("x"))
    ties = F.count("*").over(Window.partitionBy(*keys, "x"))
    score = probit((place + (ties - 1) / 2 - 0.375) / (F.count("*").over(whole) + 0.25))
    scored = single.withColumn("z", score)
    parts = scored.groupBy(*keys, "chain", "half").agg(
        F.count("*").alias("n"), F.avg("x").alias("m"), F.var_samp("x").alias("v"),
        F.transform(F.array_sort(F.collect_list(F.struct("t", "z"))), lambda s: s["z"]).alias("z"))
    parts = _once(parts, mz=F.aggregate("z", F.lit(0.0), lambda s, x: s + x) / F.size("z"))
    parts = _once(parts, c=F.expr("transform(z, x -> x - mz)"))
    parts = _once(parts, acov=F.expr(
        "transform(sequence(0, n - 1), k -> aggregate(zip_with(slice(c, 1, cast(n - k as int)), "
        "slice(c, cast(k as int) + 1, cast(n - k as int)), (x, y) -> x * y), 0D, "
        "(s, x) -> s + x) / n)"))
    by_lag = parts.select(*keys, "n", F.posexplode("acov").alias("lag", "a")).groupBy(
        *keys, "n", "lag").agg(F.avg("a").alias("a"))
    lags = by_lag.groupBy(*keys, "n").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("lag", "a"))), lambda s: s["a"]).alias("acov"))
    chains = parts.groupBy(*keys, "n").agg(
        F.count("*").alias("halves"), F.avg("m").alias("mean"), F.avg("v").alias("within"),
        F.var_samp("m").alias("between"), F.var_samp("mz").alias("between_z"))
    n = F.col("n")
    joined = chains.join(lags, [*keys, "n"])
    within_z = F.try_divide(F.col("acov")[0] * n, n - 1)
    pooled_z = within_z * (n - 1) / n + F.coalesce("between_z", F.lit(0.0))
    joined = _once(joined, wz=within_z, pz=pooled_z)
    # 1 - (W - mean autocovariance) / pooled variance, in sums of two lags.
    joined = _once(joined, rho=F.expr("transform(acov, (a, i) -> if(i = 0, 1D, 1 - try_divide(wz - a, pz)))"))
    joined = _once(joined, pairs=F.expr(
        "transform(if(n > 1, sequence(0, cast(n div 2 as int) - 1), cast(array() as array<int>)), "
        "i -> rho[2 * i] + rho[2 * i + 1])"))
    tau = F.expr(
        "aggregate(pairs, named_struct('sum', 0D, 'low', 9e99D, 'on', true), "
        "(s, p) -> if(s.on and p > 0, named_struct('sum', s.sum + least(p, s.low), "
        "'low', least(p, s.low), 'on', true), named_struct('sum', s.sum, 'low', s.low, 'on', false)), "
        "s -> 2 * s.sum - 1)")
    pooled = F.col("within") * (n - 1) / n + F.col("between")
    total = F.col("halves") * n
    moving = (n > 1) & (F.col("within") > 0)
    return joined.select(
        *keys, total.alias("n"), "mean", F.sqrt(pooled).alias("sd"),
        F.when(moving, F.sqrt(pooled / F.col("within"))).alias("rhat"),
        # Antithetic chains cannot have more than log10(draws) times the draws.
        F.when(moving & (F.col("pz") > 0), total / F.greatest(
            tau, 1 / F.log10(total.cast("double")))).alias("ess_bulk"))


def posterior_means(draws: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, parameter, mean, sd, rhat, ess_bulk, converged`` by the acceptance limits."""
    found = diagnostics(draws, [*keys, "parameter"])
    agreed = (F.col("rhat") < 1.01) & (F.col("ess_bulk") > 400)  # fixed values: the run's targets
    return found.select(*keys, "parameter", "mean", "sd", "rhat", "ess_bulk",
                        F.coalesce(agreed, F.lit(False)).alias("converged"))
