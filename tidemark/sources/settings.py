"""Dataset settings stored as JSON documents."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import SparkSession, functions as F

from tidemark.knowledge import Channel, SeriesConfig
from tidemark.session import inline_rows

CONFIG_SCHEMA = """
target_col string, week_col string, hcp_id_col string, product_col string,
product_value string, is_anomaly_col string, lifecycle_col string, fourier_k int,
fourier_period int, hill_alpha_field double, hill_alpha_broadcast double, train_weeks int,
organic_cps map<string,string>, true_effects map<string,double>,
channels array<struct<name string, `group` string, agg string, decay double,
hill_alpha double>>
"""


def load_config(spark: SparkSession, path: str) -> SeriesConfig:
    """One dataset's settings; absent fields take their defaults."""
    row = spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True).head()
    values = {
        "target": row["target_col"], "week": row["week_col"], "entity": row["hcp_id_col"],
        "product": row["product_col"], "product_value": row["product_value"],
        "anomaly": row["is_anomaly_col"], "lifecycle": row["lifecycle_col"],
        "fourier_k": row["fourier_k"], "fourier_period": row["fourier_period"],
        "hill_alpha_field": row["hill_alpha_field"],
        "hill_alpha_broadcast": row["hill_alpha_broadcast"],
        "train_weeks": row["train_weeks"],
    }
    return SeriesConfig(
        **{k: v for k, v in values.items() if v is not None},
        channels=tuple(Channel(**c.asDict()) for c in row["channels"] or []),
        organic_cps=tuple((row["organic_cps"] or {}).items()),
        true_effects=tuple((row["true_effects"] or {}).items()),
    )


def save_config(spark: SparkSession, config: SeriesConfig, path: str) -> None:
    """Write settings as one JSON document that ``load_config`` reads back."""
    channels = inline_rows(
        spark, {"name": "string", "group": "string", "agg": "string", "decay": "double",
                "hill_alpha": "double"},
        [tuple(asdict(c).values()) for c in config.channels])
    packed = channels.agg(F.collect_list(F.struct("*")).alias("channels"))

    def as_map(pairs, kind):
        if not pairs:
            return F.lit(None).cast(f"map<string,{kind}>")
        return F.create_map(*[F.lit(x) for pair in pairs for x in pair]).cast(
            f"map<string,{kind}>")

    packed.select(
        F.lit(config.target).alias("target_col"), F.lit(config.week).alias("week_col"),
        F.lit(config.entity).alias("hcp_id_col"), F.lit(config.product).alias("product_col"),
        F.lit(config.product_value).alias("product_value"),
        F.lit(config.anomaly).alias("is_anomaly_col"),
        F.lit(config.lifecycle).alias("lifecycle_col"),
        F.lit(config.fourier_k).alias("fourier_k"),
        F.lit(config.fourier_period).alias("fourier_period"),
        F.lit(config.hill_alpha_field).alias("hill_alpha_field"),
        F.lit(config.hill_alpha_broadcast).alias("hill_alpha_broadcast"),
        F.lit(config.train_weeks).alias("train_weeks"),
        as_map(config.organic_cps, "string").alias("organic_cps"),
        as_map(config.true_effects, "double").alias("true_effects"),
        "channels",
    ).write.mode("overwrite").json(path)


def channel_rows(spark: SparkSession, config: SeriesConfig):
    """Channels with their resolved saturation shape, one row each."""
    return inline_rows(
        spark, {"channel": "string", "channel_group": "string", "agg": "string",
                "decay": "double", "hill_alpha": "double", "ordinal": "int"},
        [(c.name, c.group, c.agg, c.decay, config.alpha_of(c.name), i)
         for i, c in enumerate(config.channels)])
