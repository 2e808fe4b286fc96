"""Features of rolled-up market series, and the channels and roles behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.curves import fourier, log_level
from tidemark.functions.names import contains_any, type_family
from tidemark.functions.numbers import clean_float, distinct_counts
from tidemark.session import inline_rows


def period_index(series: DataFrame, date: str, keys: list[str], name: str = "week_idx"):
    in_order = Window.partitionBy(*keys).orderBy(date)
    return series.withColumn(name, F.row_number().over(in_order) - 1)


def market_features(series: DataFrame, config: K.SeriesConfig,
                    keys: list[str] | None = None) -> DataFrame:
    """Log target, lifecycle number, index, seasonality, event flags, logs, split."""
    keys = keys or []
    out = period_index(series, config.week, keys)
    added = {f"log_{config.target}": log_level(F.col(config.target))}
    if config.lifecycle in series.columns:
        stages = [F.lit(x) for item in K.LIFECYCLE_ORDER.items() for x in item]
        added["lc_num"] = F.coalesce(F.create_map(*stages)[F.col(config.lifecycle)],
                                     F.lit(K.LIFECYCLE_DEFAULT))
    for name, since in config.organic_cps:
        added[f"flag_{name}"] = (F.col(config.week) >= F.lit(since).cast("date")).cast("int")
    for k in range(1, config.fourier_k + 1):
        added[f"sin_{k}"], added[f"cos_{k}"] = fourier(
            F.col("week_idx"), k, config.fourier_period)
    for c in config.named("broadcast"):
        if c in series.columns:
            added[f"{c}_log"] = F.log1p(c)
    added["split"] = F.when(F.col("week_idx") < config.train_weeks, "train").otherwise("test")
    return out.withColumns(added)


def channel_variation(df: DataFrame, week: str, channels: list[str]) -> DataFrame:
    """Mean within-week coefficient of variation per channel."""
    weekly = df.groupBy(week).agg(*[
        F.try_divide(F.stddev_samp(clean_float(F.col(c))),
                     F.abs(F.avg(clean_float(F.col(c)))) + 1e-9).alias(c)
        for c in channels])
    means = weekly.agg(*[F.avg(c).alias(c) for c in channels])
    rows = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("cv"))
                     for c in channels])
    return means.select(F.explode(rows).alias("r")).select("r.*")


def _grouped(rows: DataFrame) -> DataFrame:
    is_field = F.col("channel_group") == "field"
    decays = [F.lit(x) for item in K.DEFAULT_DECAY.items() for x in item]
    return rows.withColumn("agg", F.when(is_field, "sum").otherwise("mean")).withColumn(
        "decay", F.create_map(*decays)[F.col("channel_group")])


def channel_groups(df: DataFrame, week: str, channels: list[str]) -> DataFrame:
    """Competitor by name, market constant by variation below 1 %, else field activity."""
    varied = channel_variation(df, week, channels)
    return _grouped(varied.withColumn(
        "channel_group",
        F.when(contains_any(F.lower("channel"), K.COMPETITOR_HINTS), "competitor")
        .when(F.col("cv") < 0.01, "broadcast").otherwise("field")))


def channel_groups_by_name(specs: DataFrame) -> DataFrame:
    """Channel columns grouped by name hints; text columns cannot carry over and are skipped."""
    lower = F.lower("channel")
    rows = specs.where("subtype = 'channel' AND dtype_family <> 'string'").select(
        "dataset", "ordinal", F.col("name").alias("channel"))
    return _grouped(rows.withColumn(
        "channel_group",
        F.when(contains_any(lower, K.COMPETITOR_HINTS), "competitor")
        .when(contains_any(lower, K.BROADCAST_HINTS), "broadcast").otherwise("field")))


def find_roles(df: DataFrame, target: str | None = None) -> dict[str, str | None]:
    """Role -> column by name hints, the best hint first."""
    by_lower = {}
    for c in df.columns:
        by_lower.setdefault(c.lower(), c)
    roles = {role: next((by_lower[h] for h in hints if h in by_lower), None)
             for role, hints in K.ROLE_HINTS.items()}
    roles["week"] = roles["week"] or "week"
    if target:
        roles["target"] = target
    if roles["target"] is None:
        taken = {v for r, v in roles.items() if r != "target"}
        roles["target"] = next(
            (f.name for f in df.schema
             if type_family(f.dataType) == "numeric" and f.name not in taken), None)
    return roles


def few_valued_text(df: DataFrame, week: str, below: int = 20) -> DataFrame:
    """Text columns with fewer than ``below`` distinct values, in column order."""
    texts = [f.name for f in df.schema
             if type_family(f.dataType) == "string" and f.name != week]
    order = inline_rows(df.sparkSession, {"name": "string", "ordinal": "int"},
                        [(c, i) for i, c in enumerate(texts)])
    return order.join(distinct_counts(df, texts), "name").where(F.col("n_distinct") < below)


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value; the smallest on ties."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(1))


def dataset_roles(df: DataFrame, target: str | None = None) -> DataFrame:
    """Roles as rows (role, column_name), with the value the product filter uses."""
    roles = find_roles(df, target)
    rows = inline_rows(df.sparkSession, {"role": "string", "column_name": "string"},
                       sorted((r, c) for r, c in roles.items() if c is not None))
    if roles["product"] is None:
        product = few_valued_text(df, roles["week"]).orderBy("ordinal").limit(1).select(
            F.lit("product").alias("role"), F.col("name").alias("column_name"))
        return rows.unionByName(product).withColumn("value", F.lit(None).cast("string"))
    top = most_frequent(df, roles["product"]).select(F.col("value").cast("string")).scalar()
    return rows.withColumn("value", F.when(F.col("role") == "product", top))


def detect_config(df: DataFrame, target: str | None = None) -> K.SeriesConfig:
    """Settings of an engagement fact from its names and its within-week variation.

    Only one row per role and channel comes to the driver.
    """
    roles = find_roles(df, target)
    if roles["product"] is None:
        first = few_valued_text(df, roles["week"]).orderBy("ordinal").head()
        roles["product"] = first["name"] if first else None
    if roles["target"] is None:
        raise ValueError("no target column found; pass target=")
    taken = {c for c in roles.values() if c} | set(K.SECONDARY_TARGETS)
    numeric = [f.name for f in df.schema
               if type_family(f.dataType) == "numeric" and f.name not in taken]
    top = most_frequent(df, roles["product"]).head() if roles["product"] else None
    if roles["entity"] and roles["week"] in df.columns:
        groups = channel_groups(df, roles["week"], numeric)
    else:
        rows = inline_rows(df.sparkSession, {"channel": "string"}, [(c,) for c in numeric])
        groups = _grouped(rows.withColumn(
            "channel_group", F.when(contains_any(F.lower("channel"), K.COMPETITOR_HINTS),
                                    "competitor").otherwise("field")))
    found = {r["channel"]: r for r in groups.collect()}
    return K.SeriesConfig(
        target=roles["target"], week=roles["week"], entity=roles["entity"],
        product=roles["product"], product_value=str(top["value"]) if top else None,
        anomaly=roles["anomaly"], lifecycle=roles["lifecycle"],
        channels=tuple(
            K.Channel(c, found[c]["channel_group"], found[c]["agg"], found[c]["decay"])
            for c in numeric))
