"""Profiles that add up: a state per load of a table, merged without reading the rows again.

A state has a row per column: counts, centred moments, limits, and sketches of the distinct values
and of the quantiles. Moments merge exactly; sketches have the stated errors. `column_profile` is
the exact way and stays the default.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.names import type_family
from tidemark.functions.numbers import native_keys, number_of

HLL_BITS = 14  # standard error of the distinct count about 0.8 %
KLL_SIZE = 400  # error of a quantile's rank below 1 % at 99 % confidence
KEYS = ["dataset", "name"]


def profile_state(df: DataFrame, dataset: str, measures: list[str],
                  load: str | Column = "") -> DataFrame:
    """The state of one load, in one pass: a row per column.

    ``load`` names the part, for instance a day, so that a stored part can be replaced. Given as a
    column, it names each row's part, and the states of all loads come from that one pass.
    Moments and quantile sketches are those of the measures; texts that are no numbers count as
    missing there. A load without rows has rows with zero counts if it is named by a text.
    Distinct values are told apart by hashes of the values themselves, not of their texts, so a
    column must have one type in all loads, and states stored with hashes of texts do not merge.
    """
    # Taken once per row, before the aggregates read them.
    taken = {"load": load.cast("string") if isinstance(load, Column) else F.lit(load)}
    parts = [F.count("*").alias("rows")]
    for i, (c, (_, key)) in enumerate(zip(df.columns, native_keys(df, df.columns))):
        taken[f"key{i}"] = F.when(key.isNotNull(), F.xxhash64(key))
        parts += [F.count(f"key{i}").alias(f"filled{i}"),
                  F.hll_sketch_agg(f"key{i}", HLL_BITS).alias(f"seen{i}")]
        if c in measures:
            taken[f"x{i}"] = number_of(F.col(f"`{c}`"), type_family(df.schema[c].dataType) == "string")
            x = F.col(f"x{i}")
            sd = F.sqrt(F.var_pop(x))
            parts += [F.struct(
                F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
                (F.skewness(x) * F.count(x) * sd * sd * sd).alias("m3"),
                ((F.kurtosis(x) + 3) * F.count(x) * sd * sd * sd * sd).alias("m4"),
                F.min(x).alias("lo"), F.max(x).alias("hi")).alias(f"moments{i}"),
                F.kll_sketch_agg_double(x, KLL_SIZE).alias(f"ranks{i}")]
    rows = df.select(*[value.alias(name) for name, value in taken.items()])
    if isinstance(load, Column):
        wide = rows.groupBy("load").agg(*parts)
    else:
        wide = rows.agg(*parts).withColumn("load", F.lit(load))
    nothing = "struct<n:bigint,mean:double,m2:double,m3:double,m4:double,lo:double,hi:double>"
    columns = F.array(*[
        F.struct(
            F.lit(c).alias("name"), F.lit(i).alias("ordinal"), F.col(f"filled{i}").alias("n_filled"),
            F.col(f"seen{i}").alias("seen"),
            (F.col(f"moments{i}").cast(nothing) if c in measures else F.lit(None).cast(nothing))
            .alias("moments"),
            (F.col(f"ranks{i}") if c in measures else F.lit(None).cast("binary")).alias("ranks"))
        for i, c in enumerate(df.columns)])
    return wide.select(F.lit(dataset).alias("dataset"), "load",
                       F.col("rows").alias("n_rows"), F.explode(columns).alias("r")).select(
        "dataset", "load", "n_rows", "r.name", "r.ordinal", "r.n_filled", "r.seen", "r.moments.*",
        "r.ranks")


def merged_profile(states: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One profile row per column from the states of all its loads.

    ``dataset, name, n_rows, null_pct, n, mean, std, skewness, kurtosis, value_min, value_max,
    about_distinct, about_quantiles``. Moments are null for fewer than two numbers, as in
    `column_profile`.
    """
    some = F.col("n") > 0
    part = states.withColumns({c: F.when(some, F.col(c)) for c in ("mean", "m2")}).withColumns(
        {c: F.when(some, F.coalesce(c, F.lit(0.0))) for c in ("m3", "m4")})
    sums = part.groupBy(*KEYS).agg(
        F.min("ordinal").alias("ordinal"), F.sum("n_rows").alias("n_rows"),
        F.sum("n_filled").alias("n_filled"), F.sum("n").alias("all"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(some, F.col("n")))).alias("centre"),
        F.min("lo").alias("value_min"), F.max("hi").alias("value_max"),
        F.hll_sketch_estimate(F.hll_union_agg("seen")).alias("about_distinct"),
        F.kll_merge_agg_double(F.when(some, F.col("ranks"))).alias("ranks"))
    # A row per column, so a few beside the states.
    d = F.col("mean") - F.col("centre")
    n = F.col("n")
    moved = part.join(F.broadcast(sums.select(*KEYS, "centre")), KEYS).groupBy(*KEYS).agg(
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d)
        .alias("m4"))
    several = F.col("all") > 1
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    var = F.col("m2") / F.col("all")
    return sums.join(moved, KEYS).select(
        *KEYS, "ordinal", "n_rows",
        (1 - F.try_divide(F.col("n_filled"), F.col("n_rows"))).alias("null_pct"),
        F.coalesce("all", F.lit(0)).alias("n"), F.when(several, F.col("centre")).alias("mean"),
        F.when(several, F.sqrt(F.col("m2") / (F.col("all") - 1))).alias("std"),
        F.when(several, F.try_divide(F.col("m3") / F.col("all"), F.pow(var, F.lit(1.5)))).alias("skewness"),
        F.when(several, F.try_divide(F.col("m4") / F.col("all"), var * var) - 3).alias("kurtosis"),
        F.when(several, F.col("value_min")).alias("value_min"),
        F.when(several, F.col("value_max")).alias("value_max"), "about_distinct",
        F.when(several, F.kll_sketch_get_quantile_double("ranks", at)).alias("about_quantiles"))


def merged_states(states: list[DataFrame]) -> DataFrame:
    """Loads of one or many tables side by side; of a load that comes twice the last one counts."""
    return reduce(
        lambda old, new: old.join(new.select("dataset", "load").distinct(), ["dataset", "load"],
                                  "left_anti").unionByName(new), states)
