"""Suggested transforms applied to whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.curves import log1p_level
from tidemark.functions.numbers import exact_quantiles, long_values
from tidemark.session import stage


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """One row with ``<column>|<i>`` for the i-th probability."""
    found = exact_quantiles(long_values(df, columns), ["name"], "value", probs)
    return found.agg(*[
        F.max(F.when((F.col("name") == c) & (F.col("prob") == p), F.col("quantile")))
        .alias(f"{c}|{i}")
        for c in columns for i, p in enumerate(probs)
    ])


def _as_struct(one_row: DataFrame):
    """A one-row result as one scalar; stored, so that its passes run once for all uses."""
    return stage(one_row).select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns])).scalar()


def clip_to_quantiles(df: DataFrame, columns: list[str], low: float = 0.01,
                      high: float = 0.99) -> DataFrame:
    """Columns limited to their own exact quantiles, all in one set of passes."""
    limits = _as_struct(column_quantiles(df, columns, [low, high]))
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.greatest(
            limits[f"{c}|0"], F.least(limits[f"{c}|1"], F.col(c))))
        for c in columns})


def fill_median(df: DataFrame, columns: list[str]) -> DataFrame:
    middles = _as_struct(column_quantiles(df, columns, [0.5]))
    return df.withColumns({c: F.coalesce(F.col(c), middles[f"{c}|0"]) for c in columns})


def fill_forward_by_date(df: DataFrame, columns: list[str], date: str) -> DataFrame:
    """Missing values of detail rows take the last known value up to their date.

    The value known on a date is the largest of that date, so the result does not hang on row
    order. Only one row per date is put in order and joined back.
    """
    day = F.col(date).cast("date")
    known = df.groupBy(day.alias("fill_day")).agg(*[F.max(c).alias(f"{c}|known")
                                                    for c in columns])
    so_far = Window.orderBy("fill_day").rowsBetween(Window.unboundedPreceding, 0)
    carried = known.select("fill_day", *[
        F.last(f"{c}|known", ignorenulls=True).over(so_far).alias(f"{c}|known")
        for c in columns])
    # One row per calendar day: bounded by the date range.
    joined = df.withColumn("fill_day", day).join(F.broadcast(carried), "fill_day", "left")
    return joined.select(*[
        (F.coalesce(F.col(c), F.col(f"{c}|known")).alias(c) if c in columns else F.col(c))
        for c in df.columns
    ])


def apply_transforms(df: DataFrame, steps: dict[str, list[str]],
                     date: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Apply transform names per column: log1p, clip, ffill, median.

    Steps at the same place in their column's list run together, so columns share passes.
    ``ffill`` carries values along ``date``: within each rolled-up series when ``keys`` name
    one, else over the dates of the whole table.
    """
    for i in range(max((len(s) for s in steps.values()), default=0)):
        now = {c: s[i] for c, s in steps.items() if len(s) > i}
        wants = lambda step: [c for c, s in now.items() if s == step]
        if wants("log1p"):
            df = df.withColumns({c: log1p_level(F.col(c)) for c in wants("log1p")})
        if wants("clip"):
            df = clip_to_quantiles(df, wants("clip"))
        if wants("ffill") and not keys:
            df = fill_forward_by_date(df, wants("ffill"), date)
        elif wants("ffill"):
            so_far = Window.partitionBy(*keys).orderBy(date).rowsBetween(
                Window.unboundedPreceding, 0)
            df = df.withColumns({
                c: F.last(c, ignorenulls=True).over(so_far) for c in wants("ffill")})
        if wants("median"):
            df = fill_median(df, wants("median"))
    return df


# Words in a suggestion that call for a step, per model.
STEP_WORDS = {
    "BOCPD": [("log1p", "log1p"), ("clip at 1st/99th", "clip")],
    "MMM": [("log1p", "log1p"), ("clip at 1st/99th", "clip")],
    "PSI": [("forward-fill or median", "median")],
    "ARIMA": [("log1p", "log1p"), ("clip at 1st/99th", "clip"), ("forward-fill", "ffill")],
}


def steps_for(model: str, suggestions: list[str]) -> list[str]:
    """Transform names a model takes from a column's suggestions, in their order."""
    return [step for text in suggestions for word, step in STEP_WORDS[model] if word in text]
