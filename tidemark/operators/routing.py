"""Star-join keys, model routes and duplicate signals, all on metadata rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.names import strip_one_suffix


def star_keys(specs: DataFrame, classes: DataFrame) -> DataFrame:
    """Key pairs (fact, dimension, fact_key, dimension_key, matched_by).

    Equal names first; only fact and dimension pairs without any equal name are tried again
    with one known ending removed. Every key of a stem is kept.
    """
    typed = specs.where("subtype = 'key'").join(
        classes.select("dataset", "table_type"), "dataset").select(
        "dataset", "table_type", "name", F.lower("name").alias("lower_name"),
        strip_one_suffix(F.lower("name"), K.KEY_SUFFIXES).alias("stem"))
    side = lambda kind, label: typed.where(F.col("table_type") == kind).select(
        F.col("dataset").alias(label), F.col("name").alias(f"{label}_key"), "lower_name", "stem")
    facts, dims = side("fact", "fact"), side("dimension", "dimension")
    pair = ["fact", "dimension", "fact_key", "dimension_key"]
    equal = facts.drop("stem").join(dims.drop("stem"), "lower_name").select(*pair)
    stemmed = lambda df: df.where("stem <> ''").drop("lower_name")
    stripped = (
        stemmed(facts).join(stemmed(dims), "stem")
        .join(equal.select("fact", "dimension").distinct(), ["fact", "dimension"], "left_anti")
        .select(*pair))
    return equal.withColumn("matched_by", F.lit("name")).unionByName(
        stripped.withColumn("matched_by", F.lit("stem")))


def _rules(rules):
    text = lambda items: F.array(*[F.lit(i) for i in items]).cast("array<string>")
    return F.array(*[
        F.struct(
            F.lit(i).alias("rule_ordinal"), F.lit(r.model).alias("model"),
            text(r.required).alias("required"), text(r.optional).alias("optional"),
            text(r.preferred).alias("preferred"), text(r.accepts).alias("accepts"),
            text(r.use_cases).alias("use_cases"))
        for i, r in enumerate(rules)
    ])


def model_routes(specs: DataFrame, classes: DataFrame, datamarts: DataFrame | None = None,
                 rules=None, keys: DataFrame | None = None) -> DataFrame:
    """Models that fit each fact, best first.

    A fact also has the meanings of dimensions one join away. A rule applies when all it needs
    is there; its score is 1 per need, 0.3 per extra, 0.5 per preferred measure, over the most
    it could reach.
    """
    keys = keys if keys is not None else star_keys(specs, classes)
    own = specs.groupBy("dataset").agg(
        F.collect_set("subtype").alias("own_subtypes"),
        F.flatten(F.collect_list(F.when(
            F.col("subtype").isin("measure", "unclassified_metric"),
            F.array_compact(F.array(F.lower("name"), F.lower("expanded_name"))))))
        .alias("measure_names"),
        F.transform(
            F.array_sort(F.collect_list(F.when(
                F.col("subtype") == "unclassified_metric", F.struct("ordinal", "name")))),
            lambda s: s["name"]).alias("unclassified"))
    inherited = (
        keys.select("fact", "dimension").distinct()
        .join(specs.select(F.col("dataset").alias("dimension"), "subtype"), "dimension")
        .where("subtype <> 'unknown'")
        .groupBy("fact").agg(F.collect_set("subtype").alias("inherited")))
    joined_by = (
        keys.groupBy("fact", "fact_key")
        .agg(F.max_by("dimension_key", "dimension").alias("dimension_key"))
        .groupBy("fact").agg(F.map_from_entries(F.array_sort(F.collect_list(
            F.struct("fact_key", "dimension_key")))).alias("join_keys")))
    dims = keys.groupBy("fact").agg(
        F.array_sort(F.collect_set("dimension")).alias("dimension_tables"))
    facts = (
        classes.where("table_type = 'fact'").select("dataset", "matched_datamart")
        .join(own, "dataset")
        .join(inherited.withColumnRenamed("fact", "dataset"), "dataset", "left")
        .join(joined_by.withColumnRenamed("fact", "dataset"), "dataset", "left")
        .join(dims.withColumnRenamed("fact", "dataset"), "dataset", "left"))
    if datamarts is None:
        facts = facts.withColumn("description", F.lit(None).cast("string"))
    else:
        facts = facts.join(
            datamarts.select(F.col("name").alias("matched_datamart"), "description"),
            "matched_datamart", "left")
    no_text = F.array().cast("array<string>")
    scored = (
        facts.withColumn("subtypes", F.array_union(
            "own_subtypes", F.coalesce("inherited", no_text)))
        .withColumn("rule", F.explode(_rules(rules or K.ROUTE_RULES)))
        .select("*", "rule.*")
        .where(F.size(F.array_except("required", "subtypes")) == 0)
    )
    got = (
        F.size("required") + 0.3 * F.size(F.array_intersect("optional", "subtypes"))
        + 0.5 * F.size(F.array_intersect("preferred", "measure_names")))
    most = F.size("required") + 0.3 * F.size("optional") + 0.5 * F.size("preferred")
    best_first = Window.partitionBy("dataset").orderBy(F.desc("confidence"), "rule_ordinal")
    described = F.when(F.coalesce(F.col("description"), F.lit("")) != "",
                       F.array("description")).otherwise(no_text)
    return (
        scored.withColumn("confidence", F.round(got / most, 3))
        .withColumn("route_rank", F.row_number().over(best_first))
        .select(
            "dataset", "model", "confidence", "route_rank",
            F.coalesce("dimension_tables", no_text).alias("dimension_tables"),
            F.coalesce("join_keys", F.create_map().cast("map<string,string>"))
            .alias("join_keys"),
            F.concat(described, F.col("use_cases")).alias("use_cases"),
            F.when(F.array_contains("accepts", "unclassified_metric"), F.col("unclassified"))
            .otherwise(no_text).alias("flagged_unclassified"))
    )


def model_use_cases(specs: DataFrame, rules=None) -> DataFrame:
    """Use-case wording per dataset and model from the column names that are present."""
    names = specs.groupBy("dataset").agg(F.flatten(F.collect_list(F.array_compact(
        F.array(F.lower("name"), F.lower("expanded_name"))))).alias("expanded_names"),
        F.collect_list(F.lower("name")).alias("plain_names"))
    offered = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(i).alias("case_order"),
                 F.array(*[F.lit(w) for w in words]).cast("array<string>").alias("words"),
                 F.lit(text).alias("use_case"))
        for m, i, words, text in (rules or K.USE_CASES)
    ])
    cases = names.withColumn("o", F.explode(offered)).select("*", "o.*")
    present = F.when(F.col("model") == "BOCPD", F.col("expanded_names")).otherwise(
        F.col("plain_names"))
    fits = F.arrays_overlap("words", present)
    by_model = Window.partitionBy("dataset", "model")
    return (
        cases.withColumn("fits", fits)
        .withColumn("any_fits", F.max(F.col("fits").cast("int")).over(by_model) == 1)
        .where(F.col("fits") | (~F.col("any_fits") & (F.size("words") == 0)))
        .select("dataset", "model", "case_order", "use_case"))


def routing_signatures(specs: DataFrame) -> DataFrame:
    return specs.groupBy("dataset").agg(F.array_sort(F.collect_set(F.when(
        F.col("subtype").isin(*K.SIGNAL_SUBTYPES), F.col("subtype")))).alias("signature"))


def duplicate_signals(specs: DataFrame, classes: DataFrame, routes: DataFrame) -> DataFrame:
    """Facts that carry the same signal as a wider fact with the same best model."""
    top = routes.where("route_rank = 1").select("dataset", F.col("model").alias("top_model"))
    facts = classes.where("table_type = 'fact'").join(top, "dataset").join(
        routing_signatures(specs), "dataset")
    widest = Window.partitionBy("signature", "top_model").orderBy(
        F.desc("n_columns"), "dataset")
    return (
        facts.withColumn("primary", F.first("dataset").over(widest))
        .withColumn("is_duplicate_signal", F.col("dataset") != F.col("primary"))
        .select("dataset", "top_model", "signature", "is_duplicate_signal",
                F.when(F.col("is_duplicate_signal"), F.col("primary"))
                .alias("signal_group_primary")))


def join_dimension(fact: DataFrame, dimension: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Fact rows with a dimension's columns; size decides whether Spark broadcasts it."""
    if not keys:
        raise ValueError("no join keys")
    marked = dimension
    for fact_key, dim_key in keys.items():
        marked = marked.withColumnRenamed(dim_key, fact_key)
    extra = [c for c in marked.columns if c in keys or c not in fact.columns]
    return fact.join(marked.select(*extra), list(keys), "left")
