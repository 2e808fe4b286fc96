"""Helpers shared by the operators: stored steps, connected components, stable fractions."""

from __future__ import annotations

import ctypes
import gc
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import stored_table


def stored(df: DataFrame) -> DataFrame:
    """Write a step to the shared folder and read it back: cut lineage, survive lost executors."""
    return stored_table(df)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go, which stay until the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Hand memory that is no longer used back to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """`run` over a task's batches, after which its worker gives back what it no longer uses.

    Workers are reused: what one step leaves would add to the memory of the next ones.
    """
    @wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def stored_row(df: DataFrame):
    """The single row of an aggregate."""
    return df.collect()[0]


def objects(values) -> pd.Series:
    """Texts or lists as a column that keeps its type even when there are none."""
    return pd.Series(list(values), dtype=object)


def fraction(*columns: Column) -> Column:
    """A number in [0, 1) that depends only on the columns' values, equal on every engine.

    Nulls count as the empty text. The first 13 hex digits of an MD5 give 52 bits.
    """
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    Returns (node, component) for every node that occurs in a link, where component is the
    smallest node reachable. Each round is a distributed union step over edges, whose number
    never grows; rounds grow with the logarithm of the longest path. A hub's edges meet its
    minimum in a plain join, which adaptive execution splits; minima are partially aggregated.
    Links with a null end and links to oneself are ignored; repeated links count once.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        large = stored(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v > m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        edges = stored(small.distinct())
        row = stored_row(edges.agg(F.count("*").alias("n"),
                                   F.sum(F.hash("u", "v").cast("long")).alias("s")))
        if mark == (row.n, row.s):
            break
        mark = (row.n, row.s)
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return ends.union(roots)
