"""The report document: one nested row per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import knowledge as K

# Display order of column meanings.
SUBTYPE_ORDER = ["date", "measure", "channel", "segment", "geography", "key", "flag",
                 "unclassified_metric", "dimension_attribute", "unknown"]


def in_order(items, field: str):
    """An array of structs sorted by one field; the others may hold maps."""
    return F.array_sort(items, lambda a, b: F.when(a[field] < b[field], -1)
                        .when(a[field] > b[field], 1).otherwise(0))


def sorted_list(order, value):
    """Values collected in a given order."""
    pairs = F.collect_list(F.struct(order.alias("o"), value.alias("v")))
    return F.transform(in_order(pairs, "o"), lambda s: s["v"])


def collected_map(key: str, value):
    """A map from a name to a struct, in name order."""
    return F.map_from_entries(in_order(F.collect_list(F.struct(key, value)), key))


def column_section(specs: DataFrame, profiles: DataFrame) -> DataFrame:
    """``dataset, columns``: every column with its meaning and profile."""
    stats = profiles.select("dataset", "name", F.struct(
        F.round("null_pct", 4).alias("null_pct"), "unique_count",
        F.round("skewness", 4).alias("skewness"), F.round("kurtosis", 4).alias("kurtosis"),
        "date_grain", "value_max").alias("profile"))
    joined = specs.join(stats, ["dataset", "name"], "left")
    return joined.groupBy("dataset").agg(sorted_list(F.col("ordinal"), F.struct(
        "name", "dtype", "subtype", F.round("confidence", 4).alias("confidence"),
        "match_source", "profile")).alias("columns"))


def display_columns(specs: DataFrame) -> DataFrame:
    """Columns in the order a report shows them."""
    places = [F.lit(x) for i, s in enumerate(SUBTYPE_ORDER) for x in (s, i)]
    place = F.coalesce(F.create_map(*places)[F.col("subtype")], F.lit(len(SUBTYPE_ORDER)))
    return specs.withColumn("display_group", place).select(
        "dataset", "display_group", "ordinal", "name", "subtype")


def transform_section(profiles: DataFrame) -> DataFrame:
    return profiles.where(F.size("suggested_transforms") > 0).groupBy("dataset").agg(
        sorted_list(F.col("ordinal"), F.struct(
            F.col("name").alias("column"), F.col("suggested_transforms").alias("suggestions")))
        .alias("transform_context"))


def gate_section(checks: DataFrame, decisions: DataFrame, overall: DataFrame) -> DataFrame:
    per_check = checks.groupBy("dataset", "model").agg(collected_map(
        "check_name", F.struct("status", "metric", "detail")).alias("checks"))
    per_model = decisions.join(per_check, ["dataset", "model"]).groupBy("dataset").agg(
        collected_map("model", F.struct("decision", "skip_reason", "checks"))
        .alias("per_model"))
    return per_model.join(overall, "dataset").select(
        "dataset", F.struct("overall_decision", "per_model").alias("quality_gate"))


def change_signals(changes, strip_series: bool) -> DataFrame:
    """Per dataset and measure: change-points, their context and the probability series.

    Lists hold rolled-up periods of one series, so their size is that of the calendar.
    """
    keys = ["dataset", "measure"]
    lists = lambda df, order, value, name: df.groupBy(*keys).agg(
        sorted_list(order, value).alias(name))
    found = lists(changes.candidates, -F.col("cp_prob"), F.struct(
        "date", "cp_prob", "exp_run_length", "log_value", F.col("t").alias("week_idx")),
        "cp_candidates")
    rows = changes.context.groupBy(*keys, "cp_t").agg(sorted_list(F.col("t"), F.struct(
        "date", F.round("log_value", 4).alias("log_value"), F.round("value", 2).alias("value"),
        F.round("cp_prob", 4).alias("cp_prob"),
        F.round("exp_run_length", 2).alias("exp_run_length"))).alias("series"))
    at = changes.candidates.select(
        *keys, F.col("t").alias("cp_t"), F.col("date").alias("changepoint_date"), "cp_prob",
        "exp_run_length", F.col("log_value").alias("log_value_at_cp"),
        F.round("value", 2).alias("value_at_cp"))
    context = lists(at.join(rows, [*keys, "cp_t"]), -F.col("cp_prob"), F.struct(
        "changepoint_date", "cp_prob", "exp_run_length", "log_value_at_cp", "value_at_cp",
        F.lit(K.CP_CONTEXT).alias("window_periods"), "series"), "cp_context_windows")
    signals = changes.priors.select(*keys, F.struct(
        F.round("mu_0", 6).alias("mu_0"), F.round("beta_0", 8).alias("beta_0"),
        F.col("hazard").alias("hazard_lam"), F.lit(K.CP_THRESHOLD).alias("threshold"),
        F.lit(K.CP_MIN_DISTANCE).alias("min_dist"), "target_transform").alias("model_params"))
    signals = signals.join(found, keys, "left").join(context, keys, "left")
    if not strip_series:
        signals = signals.join(lists(changes.probs, F.col("t"), F.struct(
            "date", "cp_prob", "exp_run_length"), "cp_probs_series"), keys, "left")
    size = F.coalesce(F.size("cp_candidates"), F.lit(0))
    fields = [c for c in signals.columns if c not in keys]
    return signals.select(*keys, F.to_json(F.struct(
        F.greatest(size, F.lit(0)).alias("n_changepoints"), *fields)).alias("signal"))


def mix_signals(mix) -> DataFrame:
    """Per dataset and measure: channel settings, fit errors and contributions."""
    keys = ["dataset", "measure"]
    meta = mix.meta.groupBy(*keys).agg(collected_map(
        "channel", F.struct("channel_type", "decay", "hill_alpha", "hill_k"))
        .alias("channel_meta"))
    weekly = mix.contribs.groupBy(*keys, "week").agg(collected_map(
        "feature", F.col("contribution")).alias("contributions"))
    rows = weekly.join(mix.fitted.drop("attributed"), [*keys, "week"]).groupBy(*keys).agg(
        sorted_list(F.col("week"), F.struct(
            "week", "baseline", "contributions", "y_actual", "y_predicted", "residual",
            "split")).alias("channel_contributions"),
        F.count_if(F.col("split") == "train").alias("n_train_rows"))
    fit = mix.errors.where("split = 'train'").select(*keys, F.struct(
        F.lit("map").alias("estimator"), F.round("mape", 4).alias("in_sample_mape"))
        .alias("model_fit"))
    joined = meta.join(rows, keys).join(fit, keys, "left")
    listed = F.create_map(*[x for n, own in mix.features.items()
                            for x in (F.lit(n), F.array(*[F.lit(c) for c in own]))])
    return joined.select(*keys, F.to_json(F.struct(
        "channel_meta", listed[F.col("dataset")].alias("feature_cols"),
        "n_train_rows", "model_fit", "channel_contributions")).alias("signal"))
