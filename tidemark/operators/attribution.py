"""Marketing-mix attribution: carry-over, saturation, design, fit, contributions.

One row per series and period in, one job for all series. A series is named by ``keys``. The
fit needs only sums of products, so a series reaches its fit as one row whatever its length.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.curves import adstocked, hill
from tidemark.functions.numbers import column_correlations

CHANNEL_SIGMA, COMPETITOR_SIGMA, CONTROL_SIGMA = 0.5, 0.3, 0.5
INTERCEPT_SIGMA, NOISE_SIGMA = 0.5, 0.3
MOST_SWEEPS = 5000  # coordinate passes of a fit; a fit that needs more says so


def adstocked_channels(series: DataFrame, config: K.SeriesConfig,
                       keys: list[str]) -> DataFrame:
    """Carry-over column ``<channel>_ads`` per field and broadcast channel."""
    decay = {c.name: c.decay for c in config.channels}
    names = [c for c in config.named("field", "broadcast") if c in series.columns]
    return adstocked(series, {f"{c}_ads": (F.col(c), decay[c]) for c in names}, keys, config.week)


def half_saturation(carried: DataFrame, config: K.SeriesConfig, keys: list[str]) -> DataFrame:
    """Median of the positive carry-over per series and channel; 1 where there is none."""
    names = [c for c in config.named("field", "broadcast") if f"{c}_ads" in carried.columns]
    return carried.groupBy(*keys).agg(*[
        F.coalesce(F.percentile(F.when(F.col(f"{c}_ads") > 0, F.col(f"{c}_ads")), 0.5),
                   F.lit(1.0)).alias(f"{c}_half")
        for c in names])


def transform_channels(series: DataFrame, config: K.SeriesConfig,
                       keys: list[str]) -> DataFrame:
    """Carry-over, half-saturation point and saturation for every channel."""
    carried = adstocked_channels(series, config, keys)
    names = [c for c in config.named("field", "broadcast") if c in series.columns]
    halves = half_saturation(carried, config, keys)
    return carried.join(halves, keys).withColumns({
        f"{c}_sat": hill(F.col(f"{c}_ads"), F.lit(float(config.alpha_of(c))),
                         F.col(f"{c}_half"))
        for c in names})


def channel_meta(transformed: DataFrame, config: K.SeriesConfig, keys: list[str]) -> DataFrame:
    """Channel type, decay and saturation per series, as rows."""
    by_name = {c.name: c for c in config.channels}
    names = [c for c in config.named("field", "broadcast")
             if f"{c}_half" in transformed.columns]
    wide = transformed.groupBy(*keys).agg(*[F.first(f"{c}_half").alias(c) for c in names])
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("channel"),
            F.lit("A" if by_name[c].group == "field" else "B").alias("channel_type"),
            F.lit(float(by_name[c].decay)).alias("decay"),
            F.lit(float(config.alpha_of(c))).alias("hill_alpha"),
            F.col(c).alias("hill_k"))
        for c in names])
    return wide.select(*keys, F.explode(rows).alias("m")).select(*keys, "m.*")


def feature_kinds(columns: list[str], config: K.SeriesConfig) -> dict[str, str]:
    """Feature column -> channel, competitor or control, in model order."""
    have = set(columns)
    kinds = {f"{c}_sat": "channel" for c in config.named("field", "broadcast")}
    kinds |= {c: "competitor" for c in config.named("competitor")}
    kinds |= {"lc_num": "control", "week_idx": "control"}
    for k in range(1, config.fourier_k + 1):
        kinds |= {f"sin_{k}": "control", f"cos_{k}": "control"}
    return {c: kind for c, kind in kinds.items() if c in have}


def scaling(design: DataFrame, kinds: dict[str, str], keys: list[str]) -> DataFrame:
    """Mean and population deviation of each feature on training rows; 1 for constants."""
    train = F.col("split") == "train"
    x = {c: F.when(train, F.coalesce(F.col(c).cast("double"), F.lit(0.0))) for c in kinds}
    aggs = []
    for c in kinds:
        spread = F.stddev_pop(x[c])
        aggs += [F.avg(x[c]).alias(f"{c}|mean"),
                 F.when(spread == 0, 1.0).otherwise(spread).alias(f"{c}|std")]
    return design.groupBy(*keys).agg(*aggs)


def model_matrix(transformed: DataFrame, config: K.SeriesConfig, keys: list[str]) -> DataFrame:
    """``keys, week, split, y`` and one standardised ``X_<feature>`` column per feature."""
    kinds = feature_kinds(transformed.columns, config)
    scaled = transformed.join(scaling(transformed, kinds, keys), keys)
    return scaled.select(
        *keys, F.col(config.week).alias("week"), "split",
        F.col(f"log_{config.target}").alias("y"),
        *[((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col(f"{c}|mean"))
           / F.col(f"{c}|std")).alias(f"X_{c}") for c in kinds])


def design_collinearity(matrix: DataFrame, keys: list[str], limit: float = 0.85) -> DataFrame:
    """Feature pairs whose correlation exceeds the limit, per series."""
    names = [c for c in matrix.columns if c.startswith("X_")]
    pairs = column_correlations(matrix, keys, names, 2)
    return pairs.where(F.abs("r") > limit).select(
        *keys, F.regexp_replace("left_name", "^X_", "").alias("left_feature"),
        F.regexp_replace("right_name", "^X_", "").alias("right_feature"), "r")


def gram_rows(matrix: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of products over training rows that have a target, one row per series.

    ``n, sum_y, sum_yy, sum_x[f], sum_xy[f], gram[upper triangle]``.
    """
    names = [c for c in matrix.columns if c.startswith("X_")]
    pairs = list(combinations_with_replacement(names, 2))
    product = lambda a, b: F.sum(F.col(a) * F.col(b))
    return matrix.where("split = 'train' AND y IS NOT NULL").groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("y").alias("sum_y"),
        product("y", "y").alias("sum_yy"),
        F.array(*[F.sum(c) for c in names]).alias("sum_x"),
        F.array(*[product(c, "y") for c in names]).alias("sum_xy"),
        F.array(*[product(a, b) for a, b in pairs]).alias("gram"))


def solve_map(n, sum_y, sum_yy, sum_x, sum_xy, gram, kinds, sweeps=MOST_SWEEPS, tol=1e-11):
    """Mode of the posterior from sums of products, by coordinate steps within sign bounds.

    y ~ N(a + X b, s); a ~ N(mean y, 0.5); channels half-normal(0.5) upwards; competitors
    half-normal(0.3) downwards; controls N(0, 0.5); s half-normal(0.3). Returns a, b, s, the sweeps taken and whether the steps
    became smaller than ``tol``.
    """
    size = len(kinds)
    xx = np.zeros((size, size))
    xx[np.triu_indices(size)] = gram
    xx = xx + np.triu(xx, 1).T
    sigma_of = {"channel": CHANNEL_SIGMA, "competitor": COMPETITOR_SIGMA,
                "control": CONTROL_SIGMA}
    precision = np.array([sigma_of[k] ** -2 for k in kinds])
    lower = np.array([0.0 if k == "channel" else -np.inf for k in kinds])
    upper = np.array([0.0 if k == "competitor" else np.inf for k in kinds])
    mean_y = sum_y / n
    a, b = mean_y, np.zeros(size)
    s2 = min(max(sum_yy / n - mean_y**2, 1e-6), NOISE_SIGMA**2)
    for sweep in range(1, sweeps + 1):
        before = np.append(b, [a, s2])
        for j in range(size):
            rest = sum_xy[j] - a * sum_x[j] - xx[j] @ b + xx[j, j] * b[j]
            b[j] = np.clip((rest / s2) / (xx[j, j] / s2 + precision[j]), lower[j], upper[j])
        pull = INTERCEPT_SIGMA**-2
        a = ((sum_y - sum_x @ b) / s2 + mean_y * pull) / (n / s2 + pull)
        sse = (sum_yy - 2 * a * sum_y - 2 * sum_xy @ b + n * a * a
               + 2 * a * (sum_x @ b) + b @ xx @ b)
        sse = max(sse, 1e-12)
        # d/ds2 of n/2 log s2 + sse/(2 s2) + s2/(2 v) is zero where s2^2/v + n s2 - sse = 0.
        v = NOISE_SIGMA**2
        s2 = max(2.0 * sse / (n + np.sqrt(n * n + 4.0 * sse / v)), 1e-12)
        converged = bool(np.max(np.abs(np.append(b, [a, s2]) - before)) < tol)
        if converged:
            break
    return a, b, float(np.sqrt(s2)), sweep, converged


def map_fit(matrix: DataFrame, config: K.SeriesConfig, keys: list[str],
            sweeps: int = MOST_SWEEPS) -> DataFrame:
    """Coefficients per series and feature: ``keys, feature, kind, beta, intercept, sigma``.

    ``estimator`` says what the numbers are: a posterior mode, not a sampled mean. ``converged``
    is false where ``sweeps`` passes were not enough; ``n_sweeps`` counts them.
    """
    names = [c[2:] for c in matrix.columns if c.startswith("X_")]
    kind_of = feature_kinds(names, config)
    kinds = [kind_of[c] for c in names]
    grams = gram_rows(matrix, keys)
    types = {f.name: f.dataType.simpleString() for f in grams.schema}
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    schema += (", feature string, kind string, beta double, intercept double, sigma double, "
               "estimator string, n_sweeps int, converged boolean")

    def solve(batches):
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                r = row._asdict()
                a, b, s, taken, converged = solve_map(
                    float(r["n"]), r["sum_y"], r["sum_yy"], np.asarray(r["sum_x"]),
                    np.asarray(r["sum_xy"]), np.asarray(r["gram"]), kinds,
                    sweeps)
                yield pd.DataFrame({
                    **{k: [r[k]] * len(names) for k in keys}, "feature": names, "kind": kinds,
                    "beta": b, "intercept": a, "sigma": s, "estimator": "map",
                    "n_sweeps": taken, "converged": converged})

    return grams.mapInPandas(solve, schema)


def long_matrix(matrix: DataFrame, keys: list[str]) -> DataFrame:
    names = [c for c in matrix.columns if c.startswith("X_")]
    rows = F.array(*[F.struct(F.lit(c[2:]).alias("feature"), F.col(c).alias("x"))
                     for c in names])
    return matrix.select(*keys, "week", "split", "y", F.explode(rows).alias("f")).select(
        *keys, "week", "split", "y", "f.feature", "f.x")


def contributions(matrix: DataFrame, betas: DataFrame, keys: list[str]) -> DataFrame:
    """Long: ``keys, week, split, y, feature, kind, intercept, contribution``."""
    return long_matrix(matrix, keys).join(
        betas.select(*keys, "feature", "kind", "beta", "intercept"), [*keys, "feature"]
    ).select(*keys, "week", "split", "y", "feature", "kind", "intercept",
             (F.col("beta") * F.col("x")).alias("contribution"))


def fitted_values(contribs: DataFrame, keys: list[str]) -> DataFrame:
    """Prediction, residual and its z score over the whole series, one row per period."""
    rows = contribs.groupBy(*keys, "week", "split").agg(
        F.first("y").alias("y_actual"), F.first("intercept").alias("baseline"),
        F.sum("contribution").alias("attributed"))
    fitted = rows.withColumn("y_predicted", F.col("baseline") + F.col("attributed")).withColumn(
        "residual", F.col("y_actual") - F.col("y_predicted"))
    whole = Window.partitionBy(*keys)
    return fitted.withColumn(
        "residual_z", (F.col("residual") - F.avg("residual").over(whole))
        / (F.stddev_samp("residual").over(whole) + 1e-9))


def wide_contributions(contribs: DataFrame, keys: list[str],
                       features: list[str]) -> DataFrame:
    """``contrib_<feature>`` columns beside the fitted values."""
    pivoted = contribs.groupBy(*keys, "week").pivot("feature", features).agg(
        F.first("contribution"))
    renamed = pivoted.select(*keys, "week", *[F.col(f"`{f}`").alias(f"contrib_{f}")
                                              for f in features])
    return fitted_values(contribs, keys).join(renamed, [*keys, "week"])


def mape(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """Mean absolute percentage error on the original scale, by split."""
    actual, predicted = F.exp("y_actual"), F.exp("y_predicted")
    return fitted.groupBy(*keys, "split").agg(
        (100 * F.avg(F.abs(actual - predicted) / (actual + 1e-9))).alias("mape"),
        F.count("*").alias("n"))
