"""What the two vector operators share: valid vectors, classes of equal ones, bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import fraction

INFINITY = float("inf")


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, length) of the rows that can be compared with vectors of their own length.

    Left out are rows with a null id, null, empty and zero vectors, and those with a null or
    non-finite component.
    """
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INFINITY)) \
        & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")) \
        .where(F.col("id").isNotNull() & F.coalesce(sound, F.lit(False))) \
        .withColumn("length", F.size("v"))


def lengths_of(vectors: DataFrame) -> list[int]:
    """The lengths that occur; an index is built for each, as for a table of its own."""
    return sorted(r.length for r in vectors.select("length").distinct().collect())


def classes_of(vectors: DataFrame) -> DataFrame:
    """(rep, v, n): every distinct vector once, named by its smallest id, with its rows."""
    return vectors.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n"))


def matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


def bounded_sample(classes: DataFrame, total: int, rows: int, salt: str) -> np.ndarray:
    """About `rows` vectors, chosen by a hash of their name, for fitting an index."""
    share = rows / max(total, 1)
    chosen = classes.where(fraction(F.col("rep"), F.lit(salt)) < share).orderBy("rep")
    return matrix(chosen.select("v").toPandas()["v"])


