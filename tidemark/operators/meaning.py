"""What each column means and what kind of table its columns make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions import names as N
from tidemark.session import inline_rows

MAX_ATTRIBUTE_VALUES = 50


def name_dictionary(spark, lists=None) -> DataFrame:
    """Known names with their meaning and its rank."""
    lists = lists or K.SUBTYPE_LISTS
    rows = [(subtype, rank, candidate)
            for rank, (subtype, names) in enumerate(lists) for candidate in names]
    return inline_rows(
        spark, {"subtype": "string", "subtype_rank": "int", "candidate": "string"}, rows)


def dictionary_hits(names: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Best exact, subset and shared-word hit per name.

    A known name can only fit when it shares a word with the column name, so the match is an
    equality join on words. ``names`` has ``matched_name, is_index, has_date_word``.
    """
    words = names.select(
        "matched_name", "is_index", "has_date_word",
        F.size(N.tokens(F.col("matched_name"))).alias("n_words"),
        F.explode(N.tokens(F.col("matched_name"))).alias("word"))
    known = dictionary.select(
        "subtype", "subtype_rank", "candidate",
        F.size(N.tokens(F.col("candidate"))).alias("n_known"),
        F.explode(N.tokens(F.col("candidate"))).alias("word"))
    shared = (
        words.join(known, "word")
        .where(~((F.col("subtype") == "date") & F.col("is_index")))
        .groupBy("matched_name", "has_date_word", "n_words", "n_known", "candidate", "subtype",
                 "subtype_rank")
        .agg(F.count("*").alias("n_shared"))
    )
    is_same = F.col("candidate") == F.col("matched_name")
    is_subset = (F.col("n_shared") == F.col("n_known")) | (F.col("n_shared") == F.col("n_words"))
    may_overlap = (F.col("subtype") != "date") | F.col("has_date_word")
    best = lambda test: F.min_by(F.when(test, F.col("subtype")),
                                 F.when(test, F.col("subtype_rank")))
    return shared.groupBy("matched_name").agg(
        best(is_same).alias("exact_subtype"),
        best(~is_same & is_subset).alias("subset_subtype"),
        best(may_overlap).alias("overlap_subtype"))


def column_subtypes(catalog: DataFrame, dictionary: DataFrame | None = None,
                    abbreviations: dict | None = None,
                    hints: dict | None = None) -> DataFrame:
    """Meaning, confidence and source for every row of a column catalog.

    Order: key ending, flag affix, date ending, known name, known name inside, date type,
    shared word, number, text with few values, unknown.
    """
    spark = catalog.sparkSession
    dictionary = dictionary if dictionary is not None else name_dictionary(spark)
    short = inline_rows(spark, {"norm": "string", "expanded_name": "string"},
                        (abbreviations or K.ABBREVIATIONS).items())
    hint_map = [F.lit(x) for item in (hints or {}).items() for x in item]
    named = (
        catalog.withColumn("norm", N.normal_name(F.col("name")))
        .join(short, "norm", "left")
        .withColumn("matched_name",
                    F.coalesce(N.normal_name(F.col("expanded_name")), F.col("norm")))
    )
    m = F.col("matched_name")
    featured = named.select(
        "*",
        N.ends_with_any(m, K.KEY_SUFFIXES).alias("is_key"),
        (N.starts_with_any(m, K.FLAG_PREFIXES) | N.ends_with_any(m, K.FLAG_SUFFIXES))
        .alias("is_flag"),
        F.element_at(F.split(m, "_"), -1).isin(K.DATE_ENDINGS).alias("date_ending"),
        m.rlike(K.ROLLING_WINDOW_PATTERN).alias("is_rolling"),
        (N.ends_with_any(m, K.INDEX_SUFFIXES) | N.starts_with_any(m, K.INDEX_PREFIXES))
        .alias("is_index"),
        F.arrays_overlap(N.tokens(m), F.lit(K.DATE_WORDS)).alias("has_date_word"),
    )
    hits = dictionary_hits(
        featured.select("matched_name", "is_index", "has_date_word").distinct(), dictionary)
    joined = featured.join(hits, "matched_name", "left")

    def outcome(subtype, confidence, source):
        subtype = subtype if isinstance(subtype, Column) else F.lit(subtype)
        return F.struct(subtype.alias("subtype"), F.lit(confidence).alias("confidence"),
                        F.lit(source).alias("source"))

    plain = ~F.col("is_rolling")
    by_name = (
        F.when(F.col("is_key"), outcome("key", 1.0, "candidate_list"))
        .when(F.col("is_flag"), outcome("flag", 1.0, "candidate_list"))
        .when(F.col("date_ending"), outcome("date", 0.8, "candidate_list"))
        .when(plain & F.col("exact_subtype").isNotNull(),
              outcome(F.col("exact_subtype"), 1.0, "candidate_list"))
        .when(plain & F.col("subset_subtype").isNotNull(),
              outcome(F.col("subset_subtype"), 0.8, "candidate_list"))
    )
    family = F.col("dtype_family")
    by_content = (
        F.when((family == "date") & ~F.col("is_index"),
               outcome("date", 0.9, "heuristic_dtype"))
        .when(plain & F.col("overlap_subtype").isNotNull(),
              outcome(F.col("overlap_subtype"), 0.6, "heuristic_token"))
        .when((family == "numeric") & ~F.col("is_key"),
              outcome("unclassified_metric", 0.5, "guardrail_metric"))
        .when((family == "string") & F.col("n_distinct").between(1, MAX_ATTRIBUTE_VALUES),
              outcome("dimension_attribute", 0.4, "heuristic_cardinality"))
        .otherwise(outcome("unknown", 0.0, "unmatched"))
    )
    expanded = F.col("expanded_name").isNotNull() & F.col("by_name").isNotNull()
    hint = (F.coalesce(F.create_map(*hint_map)[F.col("name")],
                       F.create_map(*hint_map)[F.col("norm")])
            if hint_map else F.lit(None).cast("string"))
    decided = joined.withColumn("by_name", by_name).withColumn(
        "found", F.coalesce(F.col("by_name"), by_content))
    source = F.when(expanded, F.lit("abbreviation_expanded")).otherwise(F.col("found.source"))
    told = F.concat(F.lit("Column '"), F.col("name"), F.lit("' (dtype="), F.col("dtype"))
    return decided.select(
        "dataset", "ordinal", "name", "dtype", "dtype_family", "n_distinct",
        F.col("found.subtype").alias("subtype"),
        F.when(expanded, F.least(F.col("found.confidence"), F.lit(0.8)))
        .otherwise(F.col("found.confidence")).alias("confidence"),
        source.alias("match_source"),
        "expanded_name",
        hint.alias("business_hint"),
        F.when(source == "guardrail_metric", F.concat(told, F.lit(
            ") matched no known meaning; kept as unclassified_metric for models that take "
            "generic measures.")))
        .when(source == "unmatched", F.concat(told, F.lit(
            ") could not be classified; it is left out of model routing.")))
        .alias("warning"),
    )


def scrub_dead_columns(specs: DataFrame, profiles: DataFrame) -> DataFrame:
    """Columns without a single value become unknown, dates and keys excepted."""
    nulls = profiles.select("dataset", "name", "null_pct")
    dead = (F.col("null_pct") >= 1.0) & ~F.col("subtype").isin("date", "key")
    return (
        specs.join(nulls, ["dataset", "name"], "left")
        .withColumn("confidence", F.when(dead, 0.0).otherwise(F.col("confidence")))
        .withColumn("subtype", F.when(dead, "unknown").otherwise(F.col("subtype")))
        .select(*specs.columns)
    )


def datamart_overlap(specs: DataFrame, datamarts: DataFrame) -> DataFrame:
    """Jaccard overlap of each dataset's column names with each datamart's, where not zero.

    ``datamarts`` has ``name, columns``. Shared names are counted by an equality join.
    """
    own = (
        specs.select("dataset", F.explode(F.array_compact(F.array(
            F.lower("name"), F.lower("expanded_name")))).alias("column_name"))
        .distinct()
    )
    listed = datamarts.select(
        F.col("name").alias("datamart"),
        F.explode(F.transform("columns", F.lower)).alias("column_name")).distinct()
    n_own = own.groupBy("dataset").agg(F.count("*").alias("n_own"))
    n_listed = listed.groupBy("datamart").agg(F.count("*").alias("n_listed"))
    shared = own.join(listed, "column_name").groupBy("dataset", "datamart").agg(
        F.count("*").alias("n_shared"))
    union = F.col("n_own") + F.col("n_listed") - F.col("n_shared")
    return shared.join(n_own, "dataset").join(n_listed, "datamart").select(
        "dataset", "datamart", (F.col("n_shared") / union).alias("score"))


def hinted_type(name: Column) -> Column:
    lower = F.lower(name)
    return F.when(N.ends_with_any(lower, K.FACT_ENDINGS), "fact").when(
        N.ends_with_any(lower, K.DIMENSION_ENDINGS), "dimension")


def table_classes(specs: DataFrame, datamarts: DataFrame | None = None) -> DataFrame:
    """fact, dimension or unknown per dataset, with the closest datamart."""
    has = lambda *subtypes: F.max(F.col("subtype").isin(*subtypes).cast("int")) == 1
    shape = specs.groupBy("dataset").agg(
        F.count("*").alias("n_columns"),
        has("date").alias("has_date"),
        has("measure", "unclassified_metric").alias("has_metric"),
        has("key").alias("has_key"),
        F.avg(F.col("subtype").isin("dimension_attribute", "flag", "key", "segment")
              .cast("double")).alias("attribute_share"))
    structural = (
        F.when(F.col("has_date") & F.col("has_metric"), "fact")
        .when(F.col("has_key") & (F.col("attribute_share") >= 0.5), "dimension")
        .otherwise("unknown"))
    if datamarts is None:
        best = shape.select("dataset", F.lit(None).cast("string").alias("datamart"),
                            F.lit(0.0).alias("score"))
    else:
        best_first = Window.partitionBy("dataset").orderBy(F.desc("score"), "datamart")
        best = (
            datamart_overlap(specs, datamarts)
            .withColumn("place", F.row_number().over(best_first)).where("place = 1")
            .select("dataset", "datamart", "score"))
    hinted = F.when(F.col("score") >= 0.5, hinted_type(F.col("datamart")))
    final = F.coalesce(hinted, structural)
    return shape.join(best, "dataset", "left").select(
        "dataset", "n_columns",
        F.when(final == "unknown", F.coalesce(hinted_type(F.col("dataset")), final))
        .otherwise(final).alias("table_type"),
        F.col("datamart").alias("matched_datamart"),
        F.coalesce("score", F.lit(0.0)).alias("match_score"))
