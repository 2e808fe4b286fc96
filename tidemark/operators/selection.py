"""Choosing the date axis and the measures, and slicing to a recent window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.numbers import column_correlations
from tidemark.session import inline_rows


def date_scores(specs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Score of every date column; higher makes a better time axis."""
    stats = profiles.select("dataset", "name", "null_pct", "unique_count", "date_grain")
    source = F.col("match_source")
    base = (
        F.when(source == "heuristic_dtype", 3.0)
        .when(source.isin("candidate_list", "abbreviation_expanded"), 2.0)
        .when(source == "heuristic_token", 1.0).otherwise(0.0)
        + 0.5 * F.col("confidence"))
    profiled = (
        -5.0 * F.col("null_pct")
        + F.when(F.col("date_grain").isNotNull(), 1.0).otherwise(0.0)
        + F.when(F.col("unique_count") > 52, 0.5)
        .when(F.col("unique_count") > 12, 0.3).otherwise(0.0))
    return specs.where("subtype = 'date'").join(stats, ["dataset", "name"], "left").select(
        "dataset", "ordinal", "name", "match_source", "date_grain",
        (base + F.coalesce(profiled, F.lit(0.0))).alias("score"))


def best_date(specs: DataFrame, profiles: DataFrame) -> DataFrame:
    first = Window.partitionBy("dataset").orderBy(F.desc("score"), "ordinal")
    return (
        date_scores(specs, profiles)
        .withColumn("place", F.row_number().over(first)).where("place = 1")
        .select("dataset", F.col("name").alias("date_column"), "score", "date_grain",
                (F.col("match_source") == "heuristic_token").alias("low_confidence")))


def ranked_measures(specs: DataFrame, profiles: DataFrame) -> DataFrame:
    """All measures, known ones first, the rest by how well they behave as a series."""
    stats = profiles.select("dataset", "name", "null_pct", "unique_count", "mean", "std",
                            "skewness", "value_max")
    spread = F.when(F.abs("mean") > 1e-6, F.try_divide(F.col("std"), F.abs("mean")))
    skew, unique = F.col("skewness"), F.col("unique_count")
    profiled = (
        -3.0 * F.col("null_pct")
        + F.when(spread < 0.02, -1.0)
        .when(spread.isNotNull(), 0.5 * F.least(spread, F.lit(2.0))).otherwise(0.0)
        + F.when(unique <= 2, -3.0).when(unique <= 5, -1.0).when(unique > 50, 0.5)
        .when(unique > 10, 0.2).otherwise(0.0)
        + F.when(skew.between(0.3, 15), 0.4).when(skew > 15, 0.2)
        .when(F.abs(skew) <= 1.5, 0.2).otherwise(0.0)
        + F.when(F.col("value_max") > 0, 0.1).otherwise(0.0))
    hinted = F.when(F.col("business_hint").isNotNull(), 2.0).otherwise(0.0)
    score = F.when(F.col("subtype") == "measure", F.lit(float("inf"))).otherwise(
        hinted + F.coalesce(profiled, F.lit(0.0)))
    order = Window.partitionBy("dataset").orderBy(F.desc("score"), "ordinal")
    return (
        specs.where("subtype IN ('measure', 'unclassified_metric')")
        .join(stats, ["dataset", "name"], "left")
        .withColumn("score", score)
        .select("dataset", "ordinal", "name", "subtype", "score",
                F.row_number().over(order).alias("measure_rank")))


def best_measure(specs: DataFrame, profiles: DataFrame) -> DataFrame:
    return ranked_measures(specs, profiles).where("measure_rank = 1").select(
        "dataset", F.col("name").alias("measure"), "subtype", "score",
        (F.col("subtype") != "measure").alias("needs_review"))


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of every column pair, ``left_name, right_name, r``, in one pass."""
    if len(columns) < 2:
        return inline_rows(df.sparkSession, {
            "left_name": "string", "right_name": "string", "r": "double"}, [])
    return column_correlations(df, [], columns).select("left_name", "right_name", "r")


def dedup_measures(df: DataFrame, ranked: list[str], threshold: float = 0.85) -> DataFrame:
    """Walk the ranked measures and drop each that moves with one already kept.

    Returns ``name, measure_rank, kept``.
    """
    place = {c: i for i, c in enumerate(ranked)}
    rank_map = F.create_map(*[F.lit(x) for item in place.items() for x in item])
    near = (
        pair_correlations(df, ranked).where(F.abs("r") > threshold)
        .select(F.struct(rank_map[F.col("left_name")].alias("a"),
                         rank_map[F.col("right_name")].alias("b")).alias("pair"))
        .agg(F.collect_set("pair").alias("near")))
    kept = F.aggregate(
        F.sequence(F.lit(0), F.lit(len(ranked) - 1)),
        F.array().cast("array<int>"),
        lambda chosen, i: F.when(
            F.exists(chosen, lambda k: F.array_contains(
                F.col("near"), F.struct(k.alias("a"), i.alias("b")))), chosen
        ).otherwise(F.array_append(chosen, i)))
    names = F.array(*[
        F.struct(F.lit(c).alias("name"), F.lit(i + 1).alias("measure_rank"),
                 F.array_contains("chosen", i).alias("kept"))
        for c, i in place.items()
    ])
    return near.select(kept.alias("chosen")).select(F.explode(names).alias("n")).select("n.*")


def recent_window(df: DataFrame, date: str, years: int) -> DataFrame:
    """Rows of the last ``years`` before the newest date; all rows when no date is known.

    The newest date is a scalar subquery, so the filter reaches the scan.
    """
    if years <= 0:
        return df
    newest = df.select(F.max(F.col(date).cast("date"))).scalar()
    cutoff = F.add_months(newest, -12 * years)
    return df.where((F.col(date).cast("date") >= cutoff) | newest.isNull())


def candidate_windows(calendar: DataFrame, windows: dict[str, int]) -> DataFrame:
    """Window per model from a one-row-per-date rollup (``date, n_rows``)."""
    windows = {m: y for m, y in windows.items() if y > 0}
    newest = calendar.select(F.max("date")).scalar()
    dated = calendar.withColumn("newest", newest)
    cutoff = {m: F.add_months(F.col("newest"), -12 * y) for m, y in windows.items()}
    counted = dated.agg(F.max("newest").alias("newest"), *[
        F.sum(F.when(F.col("date") >= cutoff[m], F.col("n_rows"))).alias(f"rows_{m}")
        for m in windows])
    rows = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(y).alias("years"),
                 cutoff[m].alias("cutoff_date"), F.col("newest").alias("max_date"),
                 F.col(f"rows_{m}").alias("n_rows"))
        for m, y in windows.items()
    ])
    return counted.where("newest IS NOT NULL").select(F.explode(rows).alias("w")).select("w.*")
