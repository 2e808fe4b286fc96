"""Report documents of a run, and the routing documents of a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import gate as G
from tidemark.operators import payload as P
from tidemark.plans.insights import Metadata, Run, model_outcomes, union
from tidemark.sources.tables import write_json_documents


def routing_documents(metadata: Metadata) -> DataFrame:
    """One row per dataset: type, catalog match, routes and warnings."""
    routes = metadata.routes.groupBy("dataset").agg(P.sorted_list(
        F.col("route_rank"), F.struct(
            "model", "confidence", "use_cases", "join_keys", "dimension_tables",
            F.col("flagged_unclassified").alias("flagged_unclassified_columns")))
        .alias("model_configs"))
    warnings = metadata.specs.groupBy("dataset").agg(F.array_compact(
        P.sorted_list(F.col("ordinal"), F.col("warning"))).alias("warnings"))
    flags = metadata.duplicates.select("dataset", "is_duplicate_signal", "signal_group_primary")
    return (
        metadata.classes.join(routes, "dataset", "left").join(warnings, "dataset", "left")
        .join(flags, "dataset", "left")
        .select("dataset", "table_type", F.col("matched_datamart").alias("catalog_match"),
                "match_score", "model_configs", "warnings",
                F.coalesce("is_duplicate_signal", F.lit(False)).alias("is_duplicate_signal"),
                "signal_group_primary"))


def signal_section(run: Run, strip_series: bool) -> DataFrame:
    """``dataset, model_signals``: outcome per model with its per-measure signals."""
    parts = []
    if run.mix is not None:
        parts.append(P.mix_signals(run.mix).withColumn("model", F.lit("MMM")))
    if run.changes is not None:
        parts.append(P.change_signals(run.changes, strip_series).withColumn(
            "model", F.lit("BOCPD")))
    outcomes = model_outcomes(run)
    if parts:
        grouped = union(parts).groupBy("dataset", "model").agg(F.array_sort(F.collect_list(
            F.struct("measure", "signal"))).alias("found"))
        outcomes = outcomes.join(grouped, ["dataset", "model"], "left").withColumn(
            "by_measure", F.map_from_entries(F.transform("found", lambda s: F.struct(
                s["measure"], F.parse_json(s["signal"])))))
    else:
        outcomes = outcomes.withColumn("by_measure", F.lit(None).cast("map<string,variant>"))
    window = F.when(F.col("cutoff_date").isNotNull(), F.struct(
        "years", "cutoff_date", "max_date", "n_rows"))
    signal = F.struct(
        "ran", F.col("decision").alias("quality_decision"), window.alias("candidate_window"),
        F.when(F.col("by_measure").isNotNull(), F.struct("by_measure")).alias("signals"),
        "reason")
    return outcomes.select("dataset", "model", F.to_json(signal).alias("signal")).groupBy(
        "dataset").agg(F.array_sort(F.collect_list(F.struct("model", "signal"))).alias("s")
    ).select("dataset", F.map_from_entries(F.transform("s", lambda x: F.struct(
        x["model"], F.parse_json(x["signal"])))).alias("model_signals"))


def payloads(run: Run, strip_series: bool = False, generated_at: str | None = None) -> DataFrame:
    """One nested row per dataset that was routed; ``generated_at`` is now unless given."""
    if not run.known.facts:
        raise ValueError("no dataset has a route to the chosen models")
    at = (F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if generated_at is None
          else F.lit(generated_at))
    profiles = run.known.profiles
    docs = routing_documents(run.metadata)
    best = F.col("model_configs")[0]
    routing = F.struct(
        best["model"].alias("top_model"), best["confidence"].alias("confidence"),
        F.transform("model_configs", lambda m: F.struct(
            m["model"].alias("model"), m["confidence"].alias("confidence")))
        .alias("all_candidates"))
    metadata = docs.select(
        "dataset", "warnings", best["use_cases"].alias("use_cases"), "catalog_match",
        F.struct(
            "table_type", routing.alias("routing"),
            F.struct(F.col("catalog_match").alias("entry"),
                     F.round("match_score", 4).alias("score")).alias("catalog_match"),
            F.struct(best["dimension_tables"].alias("dimension_tables"),
                     best["join_keys"].alias("join_keys")).alias("star_schema"),
            F.col("is_duplicate_signal").alias("duplicate_signal"),
            "signal_group_primary").alias("metadata"))
    datamarts = run.metadata.datamarts
    if datamarts is not None:
        metadata = metadata.join(datamarts.select(
            F.col("name").alias("catalog_match"), "category", "description"),
            "catalog_match", "left")
    else:
        metadata = metadata.withColumns({
            "category": F.lit(None).cast("string"),
            "description": F.lit(None).cast("string")})
    overall = G.overall_decisions(run.decisions)
    return (
        metadata
        .join(P.column_section(run.metadata.specs, profiles), "dataset")
        .join(P.gate_section(run.checks, run.decisions, overall), "dataset")
        .join(signal_section(run, strip_series), "dataset")
        .join(P.transform_section(profiles), "dataset", "left")
        .select(
            F.col("dataset").alias("dataset_name"),
            at.alias("generated_at"),
            "metadata", "columns", "quality_gate", "model_signals", "transform_context",
            "warnings",
            F.struct(F.col("catalog_match").alias("matched_datamart"), "category",
                     "description", "use_cases").alias("knowledge_base_context")))


def payload_json(run: Run, strip_series: bool = False,
                 generated_at: str | None = None) -> DataFrame:
    rows = payloads(run, strip_series, generated_at)
    return rows.select(F.col("dataset_name").alias("dataset"),
                       F.to_json(F.struct(*rows.columns)).alias("payload"))


def write_payloads(run: Run, folder: str, strip_series: bool = False) -> None:
    payload_json(run, strip_series).write.mode("overwrite").partitionBy("dataset").text(folder)


def write_routing(metadata: Metadata, folder: str) -> None:
    write_json_documents(routing_documents(metadata), folder)
