"""Finding datasets in a folder or a Spark schema, and describing their columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.names import type_family
from tidemark.functions.numbers import clean_float, number_of, value_key
from tidemark.session import inline_rows


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Datasets of a folder as (dataset, format, path), parquet before csv for one name."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    base = hadoop.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    for rank, ending in enumerate(("parquet", "csv")):
        statuses = fs.globStatus(hadoop.Path(base, f"*.{ending}")) or []
        for path in sorted(s.getPath().toString() for s in statuses):
            name = path.rsplit("/", 1)[-1][: -len(ending) - 1]
            found.setdefault(name, (name, ending, path, rank))
    rows = sorted(found.values(), key=lambda r: (r[3], r[0]))
    return inline_rows(spark, {"dataset": "string", "format": "string", "path": "string"},
                       [r[:3] for r in rows])


def read_dataset(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """One dataset of a folder by name; parquet wins over csv."""
    row = list_files(spark, folder).where(F.col("dataset") == dataset).head()
    if row is None:
        raise FileNotFoundError(f"no parquet or csv named {dataset!r} in {folder}")
    if row["format"] == "parquet":
        return clean_nan(spark.read.parquet(row["path"]))
    return clean_nan(
        spark.read.option("header", True).option("inferSchema", True).csv(row["path"]))


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """A catalog table; ``limit`` gives a quick look, as in SELECT * ... LIMIT n."""
    df = spark.table(name)
    return df if limit is None else df.limit(limit)


def read_external_table(spark: SparkSession, url: str, table: str,
                        **options: str) -> DataFrame:
    """A table of an outside database; filters and limits are pushed down by the source."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def clean_nan(df: DataFrame) -> DataFrame:
    """Floating columns with NaN turned into null."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
    return df.select(*[
        (clean_float(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`"))
        for c in df.columns
    ])


def column_catalog(spark: SparkSession, datasets: dict[str, DataFrame],
                   promote: bool = True) -> DataFrame:
    """One row per column: dataset, ordinal, name, dtype, dtype_family, n_distinct.

    Names and types come from the schemas. Distinct counts are taken for text columns, the only
    ones whose meaning depends on them. With ``promote``, text columns without nulls in which
    at least nine of ten values are numbers count as numeric.
    """
    rows = [
        (name, i, f.name, f.dataType.simpleString(), type_family(f.dataType))
        for name, df in datasets.items() for i, f in enumerate(df.schema)
    ]
    schema = inline_rows(spark, {
        "dataset": "string", "ordinal": "int", "name": "string", "dtype": "string",
        "dtype_family": "string"}, rows)
    texts = {name: df for name, df in datasets.items() if text_columns(df)}
    if not texts:
        return schema.withColumn("n_distinct", F.lit(None).cast("bigint"))
    stats = text_stats(texts)
    # One row per text column of the catalog: as bounded as the schema rows themselves.
    joined = schema.join(F.broadcast(stats), ["dataset", "name"], "left")
    numeric = F.coalesce(
        (F.col("n_null") == 0) & (F.col("numeric_share") >= 0.9), F.lit(False))
    family = F.when(numeric, "numeric").otherwise(F.col("dtype_family"))
    dtype = F.when(numeric, "double").otherwise(F.col("dtype"))
    return joined.select(
        "dataset", "ordinal", "name",
        (dtype if promote else F.col("dtype")).alias("dtype"),
        (family if promote else F.col("dtype_family")).alias("dtype_family"),
        "n_distinct",
    )


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if type_family(f.dataType) == "string"]


def text_stats(datasets: dict[str, DataFrame]) -> DataFrame:
    """Per text column: rows, nulls, share of values that are numbers, distinct values.

    The text columns of all datasets are stacked first, so the whole catalog costs two shuffles
    of merged values however many tables it has.
    """
    stacked = []
    for dataset, df in datasets.items():
        pairs = F.array(*[
            F.struct(F.lit(c).alias("name"), value_key(F.col(f"`{c}`")).alias("value"),
                     F.when(F.length(f"`{c}`") > 64,
                            number_of(F.col(f"`{c}`"), is_text=True).isNotNull()).alias("is_number"))
            for c in text_columns(df)
        ])
        stacked.append(df.select(F.lit(dataset).alias("dataset"), F.explode(pairs).alias("p"))
                       .select("dataset", "p.*"))
    merged = reduce(DataFrame.union, stacked).groupBy(
        "dataset", "name", "value", "is_number").agg(F.count("*").alias("c"))
    # Short values stand whole in their keys, so they are read as numbers once each.
    merged = merged.withColumn("is_number", F.coalesce(
        "is_number", number_of(F.col("value"), is_text=True).isNotNull()))
    return merged.groupBy("dataset", "name").agg(
        F.sum("c").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("c"))), F.lit(0)).alias("n_null"),
        (F.sum(F.when(F.col("is_number"), F.col("c")).otherwise(0)) / F.sum("c"))
        .alias("numeric_share"),
        F.count("value").alias("n_distinct"),
    )
