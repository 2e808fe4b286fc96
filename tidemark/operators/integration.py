"""Why a series changed: contributions before and after each change-point."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import knowledge as K


def binned_range_join(points: DataFrame, rows: DataFrame, keys: list[str], low: str,
                      high: str, at: str, days: int) -> DataFrame:
    """Rows whose date ``at`` lies in a point's half-open range [low, high).

    The calendar is cut into bins of ``days``; a point lists the few bins it touches, so the
    match is an equality join on keys and bin, and the range is checked within the bin.
    """
    epoch = F.lit("1970-01-01").cast("date")
    bin_of = lambda c: F.floor(F.datediff(c, epoch) / F.lit(days)).cast("int")
    spread = points.withColumn(
        "range_bin", F.explode(F.sequence(bin_of(F.col(low)), bin_of(F.col(high)))))
    binned = rows.withColumn("range_bin", bin_of(F.col(at)))
    return spread.join(binned, [*keys, "range_bin"]).where(
        (F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("range_bin")


def _around(changes: DataFrame, rows: DataFrame, keys: list[str], pre: int,
            post: int) -> DataFrame:
    points = changes.select(
        *keys, "cp_week", F.date_sub("cp_week", 7 * pre).alias("range_from"),
        F.date_add("cp_week", 7 * post).alias("range_to"))
    return binned_range_join(points, rows, keys, "range_from", "range_to", "week",
                             7 * max(pre, post)).withColumn(
        "is_post", F.col("week") >= F.col("cp_week"))


def contribution_shifts(changes: DataFrame, contribs: DataFrame, keys: list[str],
                        pre: int = K.PRE_WEEKS, post: int = K.POST_WEEKS) -> DataFrame:
    """Mean contribution per feature before and after each change-point, and its shift."""
    rows = contribs.select(*keys, "week", "feature", "kind", "contribution")
    return (
        _around(changes, rows, keys, pre, post)
        .groupBy(*keys, "cp_week", "feature", "kind").agg(
            F.avg(F.when(~F.col("is_post"), F.col("contribution"))).alias("pre"),
            F.avg(F.when(F.col("is_post"), F.col("contribution"))).alias("post"))
        .withColumn("shift_rel", (F.col("post") - F.col("pre")) / (F.abs("pre") + 1e-9)))


def residual_levels(changes: DataFrame, fitted: DataFrame, keys: list[str],
                    post: int = K.POST_WEEKS) -> DataFrame:
    """Mean residual z in the weeks from each change-point on."""
    rows = fitted.select(*keys, "week", "residual_z")
    return (
        _around(changes, rows, keys, 0, post).groupBy(*keys, "cp_week")
        .agg(F.avg("residual_z").alias("residual_z_post")))


def root_cause():
    """Cause of one change-point from its shifts."""
    field, total = F.col("field_contrib_shift_rel"), F.col("total_contrib_shift_rel")
    # try_divide: a total shift of exactly -1e-9 must not stop the job under ANSI.
    mostly_field = F.try_divide(field, total + 1e-9) > 0.7
    return (
        F.when(F.col("residual_z_post") > K.RESIDUAL_Z_LIMIT, "artifact_trx_spike_candidate")
        .when((field > K.CONTRIB_SHIFT_LIMIT) & mostly_field, "new_channel_spike_candidate")
        .when(field > K.CONTRIB_SHIFT_LIMIT, "legit_spike_candidate")
        .when(F.coalesce("lifecycle_shift", F.lit(0.0)) > 0.5, "organic_lifecycle_event")
        .when(F.coalesce("competitor_shift_rel", F.lit(0.0)) > 0.3, "competitive_spend_event")
        .otherwise("unclassified"))


def integration_report(changes: DataFrame, contribs: DataFrame, fitted: DataFrame,
                       config: K.SeriesConfig, keys: list[str]) -> DataFrame:
    """One row per change-point: shifts, residual level and cause.

    ``changes`` has keys and ``cp_week`` and may carry more columns, which are kept.
    """
    shifts = contribution_shifts(changes, contribs, keys)
    fields = [f"{c}_sat" for c in config.named("field")]
    rivals = config.named("competitor")
    rival = rivals[0] if rivals else None
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    is_channel = F.col("kind") == "channel"
    is_field = is_channel & F.col("feature").isin(fields)
    of = lambda test, side: F.sum(F.when(test, zero(side)).otherwise(0.0))
    sums = shifts.groupBy(*keys, "cp_week").agg(
        of(is_channel, "pre").alias("total_pre"), of(is_channel, "post").alias("total_post"),
        of(is_field, "pre").alias("field_pre"), of(is_field, "post").alias("field_post"),
        F.max(F.when(F.col("feature") == "lc_num", zero("post") - zero("pre")))
        .alias("lifecycle"),
        F.max(F.when(F.col("feature") == rival,
                     (zero("post") - zero("pre")) / (F.abs(zero("pre")) + 1e-9)))
        .alias("competitor") if rival else F.lit(None).cast("double").alias("competitor"))
    shift = lambda pre, post: F.round(
        (zero(post) - zero(pre)) / (F.abs(zero(pre)) + 1e-9), 4)
    return (
        changes.join(sums, [*keys, "cp_week"], "left")
        .join(residual_levels(changes, fitted, keys), [*keys, "cp_week"], "left")
        .select(
            *changes.columns,
            shift("total_pre", "total_post").alias("total_contrib_shift_rel"),
            shift("field_pre", "field_post").alias("field_contrib_shift_rel"),
            F.round("lifecycle", 4).alias("lifecycle_shift"),
            F.round("competitor", 4).alias("competitor_shift_rel"),
            F.round(F.coalesce("residual_z_post", F.lit(0.0)), 4).alias("residual_z_post"))
        .withColumn("classification", root_cause()))


def cause_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("classification").agg(F.count("*").alias("n"))


def recent_trends(contribs: DataFrame, keys: list[str], n_weeks: int = 12) -> DataFrame:
    """Mean contribution and share of the attributed total over the last weeks."""
    newest_first = Window.partitionBy(*keys, "feature").orderBy(F.desc("week"))
    recent = (
        contribs.withColumn("age", F.row_number().over(newest_first))
        .where(F.col("age") <= n_weeks)
        .groupBy(*keys, "feature").agg(F.avg("contribution").alias("mean_contribution"),
                                       F.min("week").alias("from_week"),
                                       F.max("week").alias("to_week")))
    total = F.sum("mean_contribution").over(Window.partitionBy(*keys))
    biggest = Window.partitionBy(*keys).orderBy(F.desc(F.abs("mean_contribution")), "feature")
    return recent.withColumn(
        "share_pct", F.col("mean_contribution") / (F.abs(total) + 1e-9) * 100).withColumn(
        "trend_rank", F.row_number().over(biggest))
