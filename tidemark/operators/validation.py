"""Acceptance checks of a finished run against known incidents and known effects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.operators.integration import binned_range_join

BIN_DAYS = 84


def _row(name, passed: Column, metric: Column) -> list[Column]:
    name = name if isinstance(name, Column) else F.lit(name)
    return [name.alias("check_name"),
            F.when(passed, "PASS").otherwise("FAIL").alias("status"),
            metric.cast("double").alias("metric")]


def _skip(spark, name: str) -> DataFrame:
    return spark.sql("SELECT 1 AS one").select(
        F.lit(name).alias("check_name"), F.lit("SKIP").alias("status"),
        F.lit(None).cast("double").alias("metric"))


def hits_per_incident(incidents: DataFrame, candidates: DataFrame, slack_days: int,
                      mondays_only: bool = False) -> DataFrame:
    """Number of change-points within each incident, widened by a slack on both sides."""
    ranges = incidents.select(
        "incident_id", F.date_sub("week_start", slack_days).alias("range_from"),
        F.date_add("week_end", slack_days + 1).alias("range_to"))
    weeks = candidates.select(F.col("week").cast("date").alias("week"))
    if mondays_only:
        weeks = weeks.where(F.dayofweek("week") == 2)
    found = binned_range_join(ranges, weeks, [], "range_from", "range_to", "week", BIN_DAYS)
    n = found.groupBy("incident_id").agg(F.count("*").alias("n"))
    return incidents.select("incident_id").join(n, "incident_id", "left").select(
        "incident_id", F.coalesce("n", F.lit(0)).alias("n"))


def incident_residuals(incidents: DataFrame, fitted: DataFrame) -> DataFrame:
    """Mean absolute residual z inside each incident; 0 where no week falls in it."""
    ranges = incidents.select("incident_id", F.col("week_start").alias("range_from"),
                              F.date_add("week_end", 1).alias("range_to"))
    rows = fitted.select(F.col("week").cast("date").alias("week"), "residual_z")
    found = binned_range_join(ranges, rows, [], "range_from", "range_to", "week", BIN_DAYS)
    z = found.groupBy("incident_id").agg(F.avg(F.abs("residual_z")).alias("z"))
    return incidents.select("incident_id").join(z, "incident_id", "left").select(
        "incident_id", F.coalesce("z", F.lit(0.0)).alias("z"))


def recovery(betas: DataFrame, true_effects: DataFrame) -> DataFrame:
    """Mean relative error of channel coefficients and whether their order is right."""
    joined = betas.where("kind = 'channel'").select(
        F.regexp_replace("feature", "_sat$", "").alias("channel"),
        (F.col("beta") / F.col("x_std")).alias("found")).join(true_effects, "channel")
    by_found, by_true = Window.orderBy("found", "channel"), Window.orderBy("effect", "channel")
    return (  # one row per channel: bounded by the schema
        joined.withColumn("found_rank", F.row_number().over(by_found))
        .withColumn("true_rank", F.row_number().over(by_true))
        .agg(F.avg(F.abs(F.col("found") - F.col("effect")) / (F.abs("effect") + 1e-12))
             .alias("mean_error"),
             F.count_if(F.col("found_rank") != F.col("true_rank")).alias("misplaced"),
             F.count("*").alias("n")))


def validation_checks(candidates: DataFrame, fitted: DataFrame, errors: DataFrame,
                      incidents: DataFrame, artifact: str, events: list[str],
                      organic: list[tuple[str, str]] = (), betas: DataFrame | None = None,
                      true_effects: DataFrame | None = None) -> DataFrame:
    """Checks V-01 to V-10 as rows (check_name, status, metric) for one series.

    ``artifact`` names the incident that is only a data error, ``events`` those that are real.
    ``errors`` has ``split, mape``.
    """
    spark = candidates.sparkSession
    out = []
    for number, place in (("V-01", 0), ("V-02", 1)):
        if place >= len(organic):
            out.append(_skip(spark, f"{number} organic change-point found"))
            continue
        name, day = organic[place]
        near = candidates.agg(F.count_if(
            F.abs(F.datediff("week", F.lit(day).cast("date"))) <= K.LAG_TOLERANCE_DAYS)
            .alias("n"))
        out.append(near.select(*_row(f"{number} {name} found", F.col("n") > 0, F.col("n"))))
    is_artifact = F.col("incident_id") == artifact
    is_event = F.col("incident_id").isin(events)
    quiet = hits_per_incident(incidents.where(is_artifact), candidates, 0, mondays_only=True)
    out.append(quiet.select(*_row("V-03 no change-point in artifact", F.col("n") == 0,
                                  F.col("n"))))
    loud = hits_per_incident(incidents.where(is_event), candidates, K.LAG_TOLERANCE_DAYS)
    named = lambda text: F.concat(F.lit(text + " "), F.col("incident_id"))
    out.append(loud.select(*_row(named("V-04 change-point in"), F.col("n") > 0, F.col("n"))))
    z = incident_residuals(incidents, fitted)
    out.append(z.where(is_artifact).select(*_row(
        "V-05 artifact residual is large", F.col("z") > K.RESIDUAL_ARTIFACT_LIMIT,
        F.round("z", 4))))
    out.append(z.where(is_event).select(*_row(
        named("V-06 residual is low in"), F.col("z") < K.RESIDUAL_ARTIFACT_LIMIT,
        F.round("z", 4))))
    if betas is None or true_effects is None:
        out += [_skip(spark, "V-07 coefficient order"), _skip(spark, "V-08 recovery error")]
    else:
        found = recovery(betas, true_effects)
        out.append(found.select(*_row("V-07 coefficient order", F.col("misplaced") == 0,
                                      F.col("misplaced"))))
        out.append(found.select(*_row(
            "V-08 recovery error", F.col("mean_error") < K.RECOVERY_MEAN_LIMIT,
            F.round("mean_error", 4))))
    for name, part, limit in (("V-09 in-sample error", "train", 10.0),
                              ("V-10 hold-out error", "test", 15.0)):
        out.append(errors.where(F.col("split") == part).select(
            *_row(name, F.col("mape") < limit, F.round("mape", 4))))
    return reduce(DataFrame.unionByName, out)


def validation_counts(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status").agg(F.count("*").alias("n"))
