"""Engagement, activity and provider tables built from the order tables.

They give the jobs the shapes they are made for: an entity x product x week fact with channels,
a daily event fact, and a dimension that joins to the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.dates import week_start
from tidemark.knowledge import Channel, SeriesConfig
from tidemark.session import ship_package, stored_table

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Order priority that stands for each channel.
PRIORITY_OF = {"f2f": "1-URGENT", "samples": "2-HIGH", "email_opens": "3-MEDIUM",
               "speaker": "4-NOT SPECIFIED", "phone_call": "5-LOW"}

# The meaning of the engagement columns, in column order.
ENGAGEMENT_SUBTYPES = {
    "week": "date", "hcp_id": "key", "product": "segment", "segment": "segment",
    "region": "geography", "sales": "measure", "trx": "measure", "f2f": "channel",
    "samples": "channel", "email_opens": "channel", "speaker": "channel",
    "phone_call": "channel", "tv_grps": "channel", "competitor_spend": "measure",
    "is_anomaly": "flag", "lifecycle_stage": "segment",
}

CONFIG = SeriesConfig(
    target="sales", week="week", entity="hcp_id", product="product", anomaly="is_anomaly",
    lifecycle="lifecycle_stage",
    channels=(
        *[Channel(c, "field", "sum", 0.30) for c in PRIORITY_OF],
        Channel("tv_grps", "broadcast", "mean", 0.60),
        Channel("competitor_spend", "competitor", "mean", 0.0),
    ),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: table(spark, folder, name) for name in TABLES}


def gold_engagement(spark: SparkSession, folder: str) -> DataFrame:
    """Entity x product x week engagement.

    Lines are merged to one row per week, entity and product before the entity's own columns
    are joined, and the week's totals come from the merged rows, so a hot entity or week only
    ever adds to partial sums. AQE splits a hot part or order in the two large joins.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority",
        week_start(F.col("o_orderdate")).alias("week"))
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    merged = (
        lines.join(orders, "l_orderkey").join(parts, "l_partkey")
        .groupBy("week", F.col("o_custkey").alias("hcp_id"), "product")
        .agg(
            F.round(F.sum("l_extendedprice"), 2).alias("sales"),
            F.count("*").alias("trx"),
            *[F.sum(F.when(F.col("o_orderpriority") == p, F.col("l_quantity")).otherwise(0.0))
              .alias(c) for c, p in PRIORITY_OF.items()],
            F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"),
            F.max((F.col("l_orderkey") % 97 == 0).cast("int")).alias("is_anomaly"))
    )
    merged = stored_table(merged)  # read twice below; the three-table join runs once
    weekly = merged.groupBy("week").agg(
        F.round(100 * F.sum("discount"), 4).alias("tv_grps"),
        F.round(10000 * F.sum("tax") / F.sum("trx"), 6).alias("competitor_spend"))
    # Five regions and twenty-five nations, whatever the scale.
    nations = table(spark, folder, "nation").join(
        F.broadcast(table(spark, folder, "region")),
        F.col("n_regionkey") == F.col("r_regionkey"))
    people = (
        table(spark, folder, "customer")
        .join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("hcp_id"), F.col("c_mktsegment").alias("segment"),
                F.col("r_name").alias("region")))
    year = F.year("week")
    stage = (F.when(year <= 1995, "pre_launch").when(year == 1996, "launch")
             .when(year <= 1998, "growth").when(year <= 2000, "maturity").otherwise("decline"))
    # One row per calendar week: bounded by the date range, not by the rows.
    return (
        merged.join(people, "hcp_id").join(F.broadcast(weekly), "week")
        .withColumn("lifecycle_stage", stage)
        .select(*ENGAGEMENT_SUBTYPES))


def gold_engagement_step(spark: SparkSession, folder: str, factor: float = 1.6,
                         since: str = "1999-01-04") -> DataFrame:
    """The engagement fact with a planted rise of sales."""
    raised = F.when(F.col("week") >= F.lit(since).cast("date"), F.col("sales") * factor)
    return gold_engagement(spark, folder).withColumn(
        "sales", F.coalesce(raised, F.col("sales")))


def gold_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.to_date("ts").alias("activity_date"), "user_id", "event_type",
        F.col("value").alias("amount"))


EVENT_SUBTYPES = {"activity_date": "date", "user_id": "key", "event_type": "segment",
                  "amount": "measure"}


def dim_hcp(spark: SparkSession, folder: str, key: str = "hcp_id") -> DataFrame:
    return (
        table(spark, folder, "customer")
        .join(F.broadcast(table(spark, folder, "nation")),
              F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias(key), F.col("c_mktsegment").alias("segment"),
                F.col("n_name").alias("country_name"),
                (F.col("c_acctbal") > 0).alias("is_active")))
