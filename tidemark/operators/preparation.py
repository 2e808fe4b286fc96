"""Per-model preparation: which columns go in, which transforms apply, what to tune."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import knowledge as K
from tidemark.functions.names import type_family
from tidemark.operators.rollup import saturday_weeks
from tidemark.operators.transforms import apply_transforms, steps_for

# Column meanings each model keeps, in output order.
KEPT_SUBTYPES = {
    "BOCPD": [("date",), ("measure", "unclassified_metric"), ("geography",)],
    "MMM": [("date",), ("measure", "unclassified_metric"), ("segment",), ("geography",)],
    "PSI": [("date",), ("measure", "unclassified_metric"), ("segment",)],
    "ARIMA": [("date",), ("measure", "unclassified_metric")],
}


def kept_columns(model: str, subtypes: dict[str, str]) -> list[str]:
    return [c for group in KEPT_SUBTYPES[model] for c, s in subtypes.items() if s in group]


def prepare(df: DataFrame, model: str, subtypes: dict[str, str]) -> DataFrame:
    """Only the columns a model reads; column pruning reaches the scan."""
    return df.select(*[c for c in kept_columns(model, subtypes) if c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if type_family(f.dataType) == "numeric"]


def transform(df: DataFrame, model: str, suggestions: dict[str, list[str]],
              daily_date: str | None = None) -> DataFrame:
    """Suggested transforms of the numeric columns; daily change-point input goes weekly.

    Forward fills run along the table's date column.
    """
    date = next((c for c in df.columns
                 if type_family(df.schema[c].dataType) == "date"), None)
    steps = {c: steps_for(model, suggestions.get(c, [])) for c in numeric_columns(df)}
    out = apply_transforms(df, {c: s for c, s in steps.items() if s}, date)
    if model == "BOCPD" and daily_date:
        out = saturday_weeks(out, daily_date, numeric_columns(df))
    return out


# The settings each model starts from.
START_SETTINGS = {
    "BOCPD": {"hazard": "0.004", "truncate": "500", "observation_model": "StudentT",
              "note": "Tune hazard based on expected changepoint frequency; 1/250 ≈ one change "
                      "per ~5 years weekly."},
    "MMM": {"baseline_formula": "intercept + seasonality",
            "note": "Add adstock/lag transforms for spend columns before fitting."},
    "PSI": {"reference_period": "first quartile of date range",
            "comparison_period": "last quartile of date range", "n_bins": "10",
            "psi_threshold": "0.2",
            "note": "PSI < 0.1 = stable; 0.1–0.2 = moderate shift; > 0.2 = significant drift."},
    "ARIMA": {"order_p": "check PACF", "order_d": "1", "order_q": "check ACF",
              "seasonal_period": "52",
              "framework_options": "statsmodels SARIMA, Prophet, NeuralProphet",
              "note": "Run ADF test on target series first; d=1 if non-stationary."},
}


def tune_hints(df: DataFrame, model: str) -> dict[str, str]:
    """Starting settings of a model as text pairs, with what the prepared columns suggest."""
    numbers = numeric_columns(df)
    first = numbers[0] if numbers else ""
    if model == "BOCPD":
        found = {"suggested_columns": ",".join(numbers)}
    elif model == "MMM":
        channels = [c for c in numbers[1:] if any(w in c.lower() for w in K.SPEND_WORDS)]
        found = {"kpi": first, "channels": ",".join(channels)}
    elif model == "PSI":
        dates = [c for c in df.columns if "date" in c.lower() or "period" in c.lower()]
        found = {"date_column": dates[0] if dates else ""}
    else:
        found = {"suggested_target": first}
    return START_SETTINGS[model] | found


def profiled_suggestions(profiles: DataFrame) -> dict[str, dict[str, list[str]]]:
    """dataset -> column -> the transforms its profile suggests; a row per column."""
    found: dict[str, dict[str, list[str]]] = {}
    for r in profiles.select("dataset", "name", "suggested_transforms").collect():
        found.setdefault(r["dataset"], {})[r["name"]] = list(r["suggested_transforms"])
    return found


def daily_dates(profiles: DataFrame) -> dict[str, str]:
    """dataset -> its first date column with a grain, where that grain is daily."""
    dated = profiles.where("date_grain is not null").groupBy("dataset").agg(
        F.min_by(F.struct("name", "date_grain"), "ordinal").alias("first"))
    return {r["dataset"]: r["name"] for r in
            dated.where("first.date_grain = 'daily'").select("dataset", "first.name").collect()}


def prepared(tables: dict[str, tuple[DataFrame, dict[str, str], list[str]]],
             profiles: DataFrame) -> dict[tuple[str, str], DataFrame]:
    """(dataset, model) -> the model's input, prepared by the table's own profile.

    ``tables`` are (table, subtypes, models). Suggested transforms and the daily grain come from
    ``profiles``; both are names and come to the driver once for all tables.
    """
    suggested, daily = profiled_suggestions(profiles), daily_dates(profiles)
    return {(n, m): transform(prepare(df, m, subtypes), m, suggested.get(n, {}), daily.get(n))
            for n, (df, subtypes, models) in tables.items() for m in models}


def model_summary(df: DataFrame, dataset: str, model: str, subtypes: dict[str, str],
                  suggestions: dict[str, list[str]], daily_date: str | None = None) -> DataFrame:
    """Prepare, transform and count: one row per dataset and model."""
    ready = transform(prepare(df, model, subtypes), model, suggestions, daily_date)
    hints = [F.lit(x) for item in tune_hints(ready, model).items() for x in item]
    return ready.agg(F.count("*").alias("row_count")).select(
        F.lit(dataset).alias("dataset"), F.lit(model).alias("model"), "row_count",
        F.array(*[F.lit(c) for c in ready.columns]).alias("columns_used"),
        F.create_map(*hints).alias("model_params"))
