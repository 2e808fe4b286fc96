"""Reading and writing stored stages: a table name on a cluster, a path elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def is_path(ref: str) -> bool:
    return "/" in ref


def read_stage(spark: SparkSession, ref: str) -> DataFrame:
    return spark.read.parquet(ref) if is_path(ref) else spark.table(ref)


def write_stage(df: DataFrame, ref: str) -> None:
    """Replace a stored stage, schema included."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    if is_path(ref):
        writer.option("compression", "snappy").parquet(ref)
    else:
        writer.saveAsTable(ref)


def read_csv_stage(spark: SparkSession, ref: str) -> DataFrame:
    if not is_path(ref):
        return spark.table(ref)
    return spark.read.option("header", True).option("inferSchema", True).csv(ref)


def write_csv_stage(df: DataFrame, ref: str) -> None:
    if is_path(ref):
        df.write.mode("overwrite").option("header", True).csv(ref)
    else:
        write_stage(df, ref)


def schema_sample(df: DataFrame, fraction: float = 0.10, seed: int = 42) -> DataFrame:
    """The random sample meant for quick schema detection; the jobs read whole tables."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def write_json_documents(df: DataFrame, folder: str, by: str = "dataset") -> None:
    """One folder of JSON documents per dataset."""
    df.withColumn(by + "_folder", F.col(by)).write.mode("overwrite").partitionBy(
        by + "_folder").json(folder)
