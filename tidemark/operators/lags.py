"""Lag structure of a series: partial autocorrelation and starting orders of seasonal models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.gate import lag_correlation

SIGNIFICANT = 1.96  # standard errors of a partial correlation of noise


def partial_autocorrelations(acf: Column) -> Column:
    """Partial autocorrelations of lags 1 to K from an array of the K correlations.

    The Durbin-Levinson recursion as one fold: the state holds the last prediction's weights. From
    the first missing correlation on, or where an earlier lag explains all, they are null.
    """
    nothing = F.array().cast("array<double>")
    start = F.struct(nothing.alias("phi"), nothing.alias("pacf"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        before = F.slice(acf, F.lit(1), k - 1)
        top = F.element_at(acf, k) - dot(phi, F.reverse(before))
        found = F.try_divide(top, 1 - dot(phi, before))
        # One element, so that the weights below read it and do not compute it again.
        made = F.transform(F.array(found), lambda a: F.struct(
            F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - a * y), F.array(a)).alias("phi"),
            F.concat(state["pacf"], F.array(a)).alias("pacf")))
        return made[0]

    lags = F.when(F.size(acf) > 0, F.sequence(F.lit(1), F.size(acf))).otherwise(
        F.array().cast("array<int>"))
    return F.aggregate(lags, start, step)["pacf"]


def lag_profile(series: DataFrame, date: str, value: str, keys: list[str],
                lags: int) -> DataFrame:
    """``keys, n, lag, acf, pacf`` of lags 1 to ``lags`` of every series."""
    found = lag_correlation(series, date, value, keys, list(range(1, lags + 1)))
    rows = found.groupBy(*keys, "n").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"]).alias("acfs"))
    rows = rows.withColumn("pacfs", partial_autocorrelations(F.col("acfs")))
    both = F.arrays_zip(F.col("acfs").alias("acf"), F.col("pacfs").alias("pacf"))
    return rows.select(*keys, "n", F.posexplode(both).alias("i", "z")).select(
        *keys, "n", (F.col("i") + 1).alias("lag"), F.col("z.acf").alias("acf"),
        F.col("z.pacf").alias("pacf"))


def order_hints(profile: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, p, q``: the last lag before the first insignificant (partial) correlation."""
    limit = F.lit(SIGNIFICANT) / F.sqrt(F.col("n"))

    def reach(c: str) -> Column:
        weak = F.min(F.when(F.coalesce(F.abs(c) <= limit, F.lit(True)), F.col("lag")))
        return (F.coalesce(weak, F.max("lag") + 1) - 1).cast("int")

    return profile.groupBy(*keys).agg(reach("pacf").alias("p"), reach("acf").alias("q"))
