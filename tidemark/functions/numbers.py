"""Number helpers that stay safe under ANSI mode and at any row count."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import inline_rows, ship_package

BINS = 4096
PICK = 16384  # values that are sorted at once: one pass over all rows less for tens of millions
EPSILON = float(np.finfo(float).eps)


def clean_float(c: Column) -> Column:
    """NaN counts as missing everywhere, as it does in pandas."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


# Fixed pattern: what counts as a number in a text. Java's own reading would also take 1d or 1f.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_of(c: Column, is_text: bool = False) -> Column:
    """A column as double; texts that are no numbers and NaN become null."""
    if is_text:
        c = F.when(c.rlike(NUMBER_PATTERN), c)
    return clean_float(c.try_cast("double"))


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def safe_corr(x: Column, y: Column, min_rows: int = 3) -> Column:
    """Pearson r over rows where both sides are present; null on constants or too few rows."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    r = ratio(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
    return F.when(F.count(F.when(both, F.lit(1))) >= min_rows, r)


class Moments:
    """Means and centred sums of products of every pair of columns, over rows that have both.

    ``mean[i, j]`` and ``square[i, j]`` are those of column i over the rows of pair (i, j).
    """

    def __init__(self, x: np.ndarray):
        there, whole = ~np.isnan(x), np.isfinite(x)
        seen = np.where(whole, x, 0.0)
        few = np.maximum(whole.sum(0), 1)
        low = np.where(whole, x, np.inf).min(0, initial=np.inf)
        high = np.where(whole, x, -np.inf).max(0, initial=-np.inf)
        # Sums are taken from a column's mean, or its only value: then they are exactly zero.
        start = np.where(low < high, seen.sum(0) / few, np.where(low == high, low, 0.0))
        y, m = np.where(whole, x - start, 0.0), there.astype(float)
        self.n = m.T @ m
        n = np.maximum(self.n, 1)
        total, squares = y.T @ m, (y * y).T @ m
        self.mean = start[:, None] + total / n
        self.square = squares - total * total / n
        # What is left of equal values by rounding is no spread.
        self.square[self.square <= 4 * n * EPSILON * squares] = 0.0
        self.product = y.T @ y - total * total.T / n
        endless = (there & ~whole).astype(float).T @ m > 0
        self.square[endless] = np.nan
        self.product[endless | endless.T] = np.nan

    def add(self, other: Moments) -> None:
        n = np.maximum(self.n + other.n, 1)
        step = other.mean - self.mean
        step[(self.n == 0) | (other.n == 0)] = 0.0
        weight = self.n * other.n / n
        self.mean = np.where(self.n == 0, other.mean, self.mean + step * other.n / n)
        self.square += other.square + step * step * weight
        self.product += other.product + step * step.T * weight
        self.n = self.n + other.n


def moment_rows(key_names: list[str], width: int):
    """A task's function: the moments of its rows, a row per key and pair of columns."""
    left, right = np.triu_indices(width, 1)

    def run(batches):
        held: dict[tuple, Moments] = {}
        for batch in batches:
            columns = [batch.column(len(key_names) + i) for i in range(width)]
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])
            groups = {(): slice(None)}
            if key_names:
                # Codes of the keys' few values instead of a Python object for every row.
                coded = [batch.column(i).dictionary_encode("encode") for i in range(len(key_names))]
                code = np.zeros(len(x), dtype=np.int64)
                for part in coded:
                    code = code * len(part.dictionary) + part.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(code, kind="stable")
                starts = np.flatnonzero(np.diff(code[order], prepend=-1))
                groups = {tuple(part[int(rows[0])].as_py() for part in coded): rows
                          for rows in np.split(order, starts[1:]) if len(rows)}
            for key, rows in groups.items():
                key = tuple(None if k is None or k != k else k for k in key)
                found = Moments(x[rows])
                if key in held:
                    held[key].add(found)
                else:
                    held[key] = found
        for key, m in held.items():
            yield pa.RecordBatch.from_pydict({
                **{k: [v] * len(left) for k, v in zip(key_names, key)},
                "a": pa.array(left, pa.int32()), "b": pa.array(right, pa.int32()),
                "n": m.n[left, right], "mx": m.mean[left, right], "my": m.mean[right, left],
                "xx": m.square[left, right], "yy": m.square[right, left],
                "xy": m.product[left, right]})

    return run


MERGED_MOMENTS = """aggregate(parts, named_struct('n', 0D, 'mx', 0D, 'my', 0D, 'xx', 0D, 'yy', 0D, 'xy', 0D),
  (s, p) -> if(p.n = 0, s, if(s.n = 0, p, named_struct('n', s.n + p.n,
    'mx', s.mx + (p.mx - s.mx) * (p.n / (s.n + p.n)), 'my', s.my + (p.my - s.my) * (p.n / (s.n + p.n)),
    'xx', s.xx + p.xx + (p.mx - s.mx) * (p.mx - s.mx) * (s.n * p.n / (s.n + p.n)),
    'yy', s.yy + p.yy + (p.my - s.my) * (p.my - s.my) * (s.n * p.n / (s.n + p.n)),
    'xy', s.xy + p.xy + (p.mx - s.mx) * (p.my - s.my) * (s.n * p.n / (s.n + p.n))))))"""


def column_correlations(df: DataFrame, keys: list[str], columns: list[str],
                        min_rows: int = 3) -> DataFrame:
    """Pearson r of every pair of columns over rows where both are present.

    Every task reduces its rows, batch by batch, to matrices of means and centred products, one
    set per key (keys name metadata-sized things). What moves is a small row per key, pair and
    task; these are merged without losing digits to large means.
    Returns ``keys, left_name, right_name, r, n_pairs``.
    """
    texts = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    names = F.array(*[F.lit(c) for c in columns])
    wide = df.select(*keys, *[number_of(F.col(f"`{c}`"), c in texts).alias(f"__x{i}")
                              for i, c in enumerate(columns)])
    shape = ", ".join([f"`{k}` {wide.schema[k].dataType.simpleString()}" for k in keys]
                      + ["a int, b int"] + [f"{c} double" for c in ("n", "mx", "my", "xx", "yy", "xy")])
    ship_package(df.sparkSession)
    parts = wide.mapInArrow(moment_rows(keys, len(columns)), shape)
    whole = parts.groupBy(*keys, "a", "b").agg(
        F.collect_list(F.struct("n", "mx", "my", "xx", "yy", "xy")).alias("parts"))  # one per task
    merged = whole.withColumn("m", F.expr(MERGED_MOMENTS))
    r = ratio(F.col("m.xy"), F.sqrt("m.xx") * F.sqrt("m.yy"))
    return merged.select(*keys, names[F.col("a")].alias("left_name"),
                         names[F.col("b")].alias("right_name"),
                         F.when(F.col("m.n") >= min_rows, r).alias("r"),
                         F.col("m.n").cast("long").alias("n_pairs"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles, exact, with no task ever holding a whole group.

    ``keys`` must name metadata-sized things (a dataset, a column): one row per key and wanted
    rank comes to the driver in each pass. Returns ``keys, prob, quantile``.

    A radix selection over the digits of a double, highest first. The first pass counts values by
    sign and exponent. Later passes cut the bin that holds a wanted rank into ``BINS`` even parts,
    which inside one exponent are the next 12 bits of the mantissa. The bins of a pass do not
    overlap, so a row is counted once, however many ranks and columns are wanted. Once every bin
    left holds at most ``PICK`` values, they are sorted and the ranks picked. The 53 bits of a
    mantissa last for five passes, so six do for any values; even ones take three.
    """
    base = df.select(*keys, clean_float(F.col(value)).alias("v")).where("v IS NOT NULL")
    types = {k: base.schema[k].dataType.simpleString() for k in keys}
    found = {(tuple(r[k] for k in keys), r["rank"]): r for r in _by_exponent(base, keys, probs)}
    counts = {key: r["n"] for (key, _), r in found.items()}
    while True:
        spans: dict[tuple, list[int]] = {}
        for (key, rank), r in found.items():
            if r["lo"] != r["hi"]:
                spans.setdefault((*key, r["lo"], r["hi"], r["before"], r["c"]), []).append(rank)
        if not spans:
            break
        step = _picked if all(span[-1] <= PICK for span in spans) else _narrowed
        brackets = inline_rows(
            df.sparkSession,
            types | {"lo": "double", "hi": "double", "before": "bigint", "at": "int",
                     "ranks": "array<bigint>"},
            [(*span[:-1], i, ranks) for i, (span, ranks) in enumerate(spans.items())])
        # A row per open bracket: bounded by the keys and the wanted ranks.
        inside = base.join(F.broadcast(brackets), keys).where(
            F.col("v").between(F.col("lo"), F.col("hi")))
        keys_of = [span[:len(keys)] for span in spans]
        found.update({(keys_of[r["at"]], r["rank"]): r for r in step(inside)})
    out = []
    for key, n in counts.items():
        for p in probs:
            target = p * (n - 1)
            q0, q1 = (found[key, f(target)]["lo"] for f in (math.floor, math.ceil))
            # Equal ends need no step: infinities would give inf - inf.
            step = (q1 - q0) * (target - math.floor(target)) if q0 != q1 else 0.0
            out.append((*key, float(p), q0 + step))
    return inline_rows(df.sparkSession, types | {"prob": "double", "quantile": "double"}, out)


def _by_exponent(base: DataFrame, keys: list[str], probs: list[float]) -> list:
    """For every wanted rank the values of its sign and exponent: ``rank, lo, hi, before, c, n``."""
    v = F.col("v")
    size = F.when(v == 0, 0).when(F.abs(v) == float("inf"), 4096).otherwise(
        F.floor(F.log2(F.abs(v))) + 2048)
    bins = base.groupBy(*keys, F.when(v < 0, -size).otherwise(size).alias("bin")).agg(
        F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    by_bin = Window.partitionBy(*keys).orderBy("bin")  # at most two rows per exponent
    bins = bins.withColumn("n", F.sum("c").over(Window.partitionBy(*keys))) \
        .withColumn("upto", F.sum("c").over(by_bin))
    target = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(t).cast("long") for t in target for f in (F.floor, F.ceil)]))
    return _with_ranks(bins, ranks).select(*keys, "rank", "lo", "hi", "before", "c", "n").collect()


def _with_ranks(bins: DataFrame, ranks: Column) -> DataFrame:
    """The bins that hold a wanted rank, a row for each."""
    before = F.col("upto") - F.col("c")
    return bins.withColumn("rank", F.explode(F.filter(
        ranks, lambda r: (r >= before) & (r < F.col("upto"))))).withColumn("before", before)


def _narrowed(inside: DataFrame) -> list:
    """For every open rank the part of its bracket that holds it: ``at, rank, lo, hi, before, c``."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    part = F.floor((v - lo) / (hi - lo) * BINS).cast("int")
    bins = inside.groupBy("at", "before", "ranks", F.least(part, F.lit(BINS - 1)).alias("bin")).agg(
        F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    by_bin = Window.partitionBy("at").orderBy("bin")  # at most BINS rows
    bins = bins.withColumn("upto", F.col("before") + F.sum("c").over(by_bin)).drop("before")
    return _with_ranks(bins, F.col("ranks")).select("at", "rank", "lo", "hi", "before", "c").collect()


def _picked(inside: DataFrame) -> list:
    """For every open rank its value, from brackets of at most PICK values."""
    held = inside.groupBy("at", "before", "ranks").agg(F.sort_array(F.collect_list("v")).alias("all"))
    found = F.col("all")[(F.col("rank") - F.col("before")).cast("int")]
    return held.select("at", "before", "all", F.explode("ranks").alias("rank")).select(
        "at", "rank", found.alias("lo"), found.alias("hi"), "before", F.lit(1).alias("c")).collect()


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns stacked as (name, value); text that is no number becomes null."""
    texts = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    pairs = F.array(*[
        F.struct(F.lit(c).alias("name"),
                 number_of(F.col(f"`{c}`"), c in texts).alias("value"))
        for c in columns
    ])
    return df.select(F.explode(pairs).alias("p")).select("p.name", "p.value")


def value_key(c: Column) -> Column:
    """A short text that identifies a value, so long texts are not shuffled whole."""
    text = c.cast("string")
    return F.when(F.length(text) <= 64, text).otherwise(
        F.concat(F.lit("#"), F.sha2(text, 256), F.lit(":"), F.length(text).cast("string"))
    )


def distinct_keys(df: DataFrame, columns: list[str]) -> list[Column]:
    """A comparable short value for each column."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
    # Adding zero makes -0.0 and 0.0 one value.
    return [value_key(clean_float(F.col(f"`{c}`")) + F.lit(0.0)) if c in floats
            else value_key(F.col(f"`{c}`")) for c in columns]


def native_keys(df: DataFrame, columns: list[str]) -> list[tuple[str, Column]]:
    """(kind, value) of each column; values of one kind are told apart without writing them as text.

    Two values are equal here exactly if `distinct_keys` gives them the same text.
    """
    keys = []
    for c, text in zip(columns, distinct_keys(df, columns)):
        value, kind = F.col(f"`{c}`"), df.schema[c].dataType.typeName()
        if kind in ("float", "double"):
            keys.append(("double", clean_float(value) + F.lit(0.0)))
        elif kind in ("byte", "short", "integer", "long"):
            keys.append(("bigint", value.cast("bigint")))
        elif kind == "boolean":
            keys.append(("bigint", value.cast("int").cast("bigint")))
        elif kind == "date":
            keys.append(("bigint", F.unix_date(value).cast("bigint")))
        elif kind in ("timestamp", "timestamp_ntz"):
            # As written in the session's time zone.
            keys.append(("timestamp_ntz", value.cast("timestamp_ntz")))
        else:
            keys.append(("string", text))
    return keys


def count_distinct_keys(pairs: list[DataFrame], keys: list[str]) -> DataFrame:
    """Distinct non-null ``value`` per key, by two partial aggregations.

    ``pairs`` are stacks of one kind of values each; all values of a key are in one of them.
    """
    counted = []
    for stack in pairs:
        seen = stack.groupBy(*keys, "value").agg(F.lit(1).alias("one"))
        counted.append(seen.groupBy(*keys).agg(F.count("value").alias("n_distinct")))
    return reduce(DataFrame.unionByName, counted)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per column as (name, n_distinct).

    Columns of one kind are stacked and merged by value in two partial aggregations, so neither a
    wide expand over every column nor a hot column ends up in one task.
    """
    kinds: dict[str, list[Column]] = {}
    for i, (kind, key) in enumerate(native_keys(df, columns)):
        kinds.setdefault(kind, []).append(F.struct(F.lit(i).alias("place"), key.alias("value")))
    stacks = [df.select(F.explode(F.array(*rows)).alias("p")).select("p.place", "p.value")
              for rows in kinds.values()]
    names = F.array(*[F.lit(c) for c in columns])
    return count_distinct_keys(stacks, ["place"]).select(
        names[F.col("place")].alias("name"), "n_distinct")
