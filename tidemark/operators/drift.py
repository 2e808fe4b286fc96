"""Population drift between the first and the last quarter of a table's date range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numbers import clean_float, exact_quantiles

FLOOR = 1e-6


def drift_band(psi: Column) -> Column:
    return F.when(psi < 0.1, "stable").when(psi <= 0.2, "moderate").otherwise("significant")


def marked_periods(df: DataFrame, date: str) -> DataFrame:
    """``period`` is reference in the first quarter of the range, comparison in the last."""
    day = F.col(date).cast("date")
    first = df.select(F.min(day)).scalar()
    span = df.select(F.datediff(F.max(day), F.min(day))).scalar()
    passed = F.datediff(day, first)
    period = F.when(passed <= span * 0.25, "reference").when(passed >= span * 0.75, "comparison")
    return df.withColumn("period", period).where("period IS NOT NULL")


def _psi(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of (p-q) ln(p/q) over buckets (``reference, comparison`` counts per bucket)."""
    # Totals by partial sums, so a column with very many buckets never meets in one task.
    totals = counts.groupBy(*keys).agg(
        F.sum("comparison").alias("all_comparison"), F.sum("reference").alias("all_reference"))
    share = lambda c: F.greatest(F.try_divide(F.col(c), F.col(f"all_{c}")), F.lit(FLOOR))
    shares = counts.join(F.broadcast(totals), keys).withColumn("p", share("comparison")).withColumn("q", share("reference"))
    return shares.groupBy(*keys).agg(
        F.sum((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))).alias("psi"),
        F.count("*").alias("n_buckets"),
    ).withColumn("band", drift_band(F.col("psi")))


def _two_sided() -> list[Column]:
    return [F.count_if(F.col("period") == p).alias(p) for p in ("reference", "comparison")]


def segment_psi(df: DataFrame, date: str, segments: list[str]) -> DataFrame:
    """Drift of every segment column's mix: ``name, psi, n_buckets, band``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("bucket"))
                      for c in segments])
    counts = (
        marked_periods(df, date).select("period", F.explode(pairs).alias("p"))
        .select("period", "p.*").where("bucket IS NOT NULL")
        .groupBy("name", "bucket").agg(*_two_sided()))
    return _psi(counts, ["name"])


def measure_psi(df: DataFrame, date: str, measures: list[str], n_bins: int = 10) -> DataFrame:
    """Drift of every measure over bins cut at the reference period's quantiles."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"),
                               clean_float(F.col(c).cast("double")).alias("value"))
                      for c in measures])
    values = marked_periods(df, date).select("period", F.explode(pairs).alias("p")).select(
        "period", "p.*").where("value IS NOT NULL")
    probs = [round(i / n_bins, 10) for i in range(1, n_bins)]
    cuts = exact_quantiles(values.where("period = 'reference'"), ["name"], "value", probs)
    edges = cuts.groupBy("name").agg(F.sort_array(F.collect_set("quantile")).alias("edges"))
    # At most n_bins - 1 cuts per measure column: bounded by the schema.
    counts = (
        values.join(F.broadcast(edges), "name")
        .withColumn("bucket", F.size(F.filter(
            "edges", lambda e: e < F.col("value"))))
        .groupBy("name", "bucket").agg(*_two_sided()))
    return _psi(counts, ["name"])
