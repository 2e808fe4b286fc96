"""Column profiles in distributed passes: shape, spread, distinct values, date grain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import knowledge as K
from tidemark.functions.dates import gaps_by, moment_of
from tidemark.functions.names import contains_any, type_family
from tidemark.functions.numbers import (
    clean_float, count_distinct_keys, exact_quantiles, long_values, native_keys, number_of)
from tidemark.session import inline_rows


def column_shapes(df: DataFrame, measures: list[str]) -> DataFrame:
    """Null share for every column and moments for the measures, in one pass."""
    types = {f.name: f.dataType for f in df.schema}

    def value(c):
        if types[c].typeName() in ("float", "double"):
            return clean_float(F.col(f"`{c}`"))
        return F.col(f"`{c}`")

    aggs = [F.count("*").alias("rows")]
    for c in df.columns:
        aggs.append(F.count(value(c)).alias(f"{c}|n"))
    for c in measures:
        x = number_of(F.col(f"`{c}`"), type_family(types[c]) == "string")
        aggs += [
            F.count(x).alias(f"{c}|numbers"), F.skewness(x).alias(f"{c}|skewness"),
            F.kurtosis(x).alias(f"{c}|kurtosis"), F.max(x).alias(f"{c}|max"),
            F.avg(x).alias(f"{c}|mean"), F.stddev_samp(x).alias(f"{c}|std")]
    wide = df.agg(*aggs)
    nothing = F.lit(None).cast("double")

    def stat(c, label):
        if c not in measures:
            return nothing
        return F.when(F.col(f"`{c}|numbers`") > 1, F.col(f"`{c}|{label}`"))

    rows = F.array(*[
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(c).alias("name"),
            F.lit(types[c].simpleString()).alias("dtype"),
            F.lit(type_family(types[c])).alias("dtype_family"),
            (1 - F.try_divide(F.col(f"`{c}|n`"), F.col("rows"))).alias("null_pct"),
            stat(c, "skewness").alias("skewness"), stat(c, "kurtosis").alias("kurtosis"),
            stat(c, "max").alias("value_max"), stat(c, "mean").alias("mean"),
            stat(c, "std").alias("std"))
        for i, c in enumerate(df.columns)
    ])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def outlier_rates(df: DataFrame, measures: list[str],
                  quartiles: DataFrame | None = None) -> DataFrame:
    """Median, quartiles and the share of values beyond 1.5 interquartile ranges."""
    values = long_values(df, measures).where("value IS NOT NULL")
    return outliers_by(values, ["name"], quartiles)


def outliers_by(values: DataFrame, keys: list[str],
                quartiles: DataFrame | None = None) -> DataFrame:
    """`outlier_rates` of stacked values, per key."""
    if quartiles is None:
        quartiles = exact_quantiles(values, keys, "value", [0.25, 0.5, 0.75])
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    wide = quartiles.groupBy(*keys).agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    outside = (F.col("value") < F.col("q1") - reach) | (F.col("value") > F.col("q3") + reach)
    # One row per measure column: bounded by the schema.
    return (
        values.join(F.broadcast(wide), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(F.avg(outside.cast("double")).alias("outlier_rate")))


def suggested_transforms(profile_subtype: Column, rules=None) -> Column:
    """Suggestions whose thresholds a profile row exceeds, in rule order."""
    over = lambda c, limit: F.coalesce(F.col(c) > limit, F.lit(False))
    fired = []
    for rule in rules or K.TRANSFORM_RULES:
        test = profile_subtype.isin(*rule.subtypes)
        if rule.skewness_gt is not None:
            test = test & over("skewness", rule.skewness_gt)
        if rule.kurtosis_gt is not None:
            test = test & over("kurtosis", rule.kurtosis_gt)
        if rule.null_pct_gt is not None:
            test = test & over("null_pct", rule.null_pct_gt)
        if rule.unique_gt is not None:
            test = test & over("unique_count", rule.unique_gt)
        if rule.max_gt is not None:
            test = test & over("value_max", rule.max_gt)
        if rule.grain is not None:
            test = test & F.coalesce(F.col("date_grain") == rule.grain, F.lit(False))
        if rule.strings_only:
            test = test & (F.col("dtype_family") == "string")
        if rule.name_contains:
            test = test & contains_any(F.lower("name"), rule.name_contains)
        fired.append(F.when(test, F.lit(f"[{rule.name}] {rule.suggestion}")))
    return F.array_compact(F.array(*fired))


def column_profile(df: DataFrame, subtypes: dict[str, str], dataset: str,
                   spread: bool = True) -> DataFrame:
    """One profile row per column. ``subtypes`` maps column names to their meaning.

    Without ``spread`` the quantile passes are left out (median and outlier rate are null).
    """
    return column_profiles({dataset: (df, subtypes)}, spread)


MEASURES = ("measure", "unclassified_metric")
AT = ["spot"]  # a column of one of the tables, numbered: a short key for the passes over all rows


def column_profiles(tables: dict[str, tuple[DataFrame, dict[str, str]]],
                    spread: bool = True) -> DataFrame:
    """`column_profile` of many tables, each (table, subtypes), with as many jobs as of one.

    Columns share positions and rows carry their table's name, so every statistic is one
    aggregation for all tables. The driver handles names only.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    kinds = {n: {f.name: f.dataType for f in df.schema} for n, (df, _) in tables.items()}
    measures = {n: [c for c in df.columns if subtypes.get(c) in MEASURES]
                for n, (df, subtypes) in tables.items()}
    columns = inline_rows(
        spark, {"spot": "int", "dataset": "string", "ordinal": "int", "name": "string",
                "dtype": "string", "dtype_family": "string", "subtype": "string", "place": "int"},
        [(spot, n, i, c, kinds[n][c].simpleString(), type_family(kinds[n][c]),
          subtypes.get(c, "unknown"), measures[n].index(c) if c in measures[n] else None)
         for spot, (n, i, c, subtypes) in enumerate(
             (n, i, c, subtypes) for n, (df, subtypes) in tables.items()
             for i, c in enumerate(df.columns))])
    stats = columns.join(F.broadcast(_shapes(tables, measures)), "dataset", "left")
    here = lambda group, i: F.get(F.col(group), F.col(i))
    moments = here("moments", "place")
    several = moments["numbers"] > 1
    stats = stats.withColumn(
        "null_pct", 1 - F.try_divide(here("filled", "ordinal"), F.col("rows"))).withColumns(
        {c: F.when(several, moments[c])
         for c in ("skewness", "kurtosis", "value_max", "mean", "std")})
    # What is joined below has a row per column: bounded by the schemas.
    native = {n: native_keys(df, df.columns) for n, (df, _) in tables.items()}
    distinct = count_distinct_keys([
        _stacked(tables, lambda n, df: [(i, k) for i, (of, k) in enumerate(native[n]) if of == kind])
        for kind in dict.fromkeys(of for keys in native.values() for of, _ in keys)], AT)
    stats = stats.join(F.broadcast(distinct), AT, "left")
    if spread and any(measures.values()):
        values = _stacked(tables, lambda n, df: [
            (df.columns.index(c), _number(df, c)) for c in measures[n]])
        stats = stats.join(F.broadcast(outliers_by(values.where("value IS NOT NULL"), AT)),
                           AT, "left")
    else:
        stats = stats.withColumns({c: F.lit(None).cast("double")
                                   for c in ("median", "outlier_rate")})
    dates = {n: [c for c in df.columns if subtypes.get(c) == "date"]
             for n, (df, subtypes) in tables.items()}
    if any(dates.values()):
        moments = _stacked(tables, lambda n, df: [
            (df.columns.index(c), moment_of(df, c)) for c in dates[n]])
        grains = gaps_by(moments.withColumnRenamed("value", "at"), AT)
        stats = stats.join(F.broadcast(grains.select(*AT, "date_grain")), AT, "left")
    else:
        stats = stats.withColumn("date_grain", F.lit(None).cast("string"))
    return stats.select(
        "dataset", "ordinal", "name", "dtype", "dtype_family", "subtype", "null_pct",
        F.coalesce("n_distinct", F.lit(0)).alias("unique_count"), "skewness", "kurtosis",
        "value_max", "mean", "median", "std", "outlier_rate", "date_grain",
    ).withColumn("suggested_transforms", suggested_transforms(F.col("subtype")))


def _number(df: DataFrame, column: str) -> Column:
    is_text = type_family(df.schema[column].dataType) == "string"
    return number_of(F.col(f"`{column}`"), is_text)


def _stacked(tables, values) -> DataFrame:
    """(spot, value) rows of what ``values(name, table)`` lists by position."""
    parts, start = [], 0
    for n, (df, _) in tables.items():
        listed = values(n, df)
        if listed:
            rows = F.array(*[F.struct(F.lit(start + i).alias("spot"), v.alias("value"))
                             for i, v in listed])
            parts.append(df.select(F.explode(rows).alias("r")).select("r.*"))
        start += len(df.columns)
    return reduce(DataFrame.union, parts)


def _shapes(tables, measures: dict[str, list[str]]) -> DataFrame:
    """Per table: rows, filled rows of its columns, and moments of its measures, in one pass."""
    wide = max(len(df.columns) for df, _ in tables.values())
    deep = max(map(len, measures.values()))
    nothing = F.lit(None).cast("double")

    def filled(df, i):
        if i >= len(df.columns):
            return F.lit(None).cast("boolean")
        c = F.col(f"`{df.columns[i]}`")
        if df.dtypes[i][1] in ("float", "double"):
            c = clean_float(c)
        return F.when(c.isNotNull(), True)

    stacked = reduce(DataFrame.union, [
        df.select(F.lit(n).alias("dataset"), *[filled(df, i).alias(f"f{i}") for i in range(wide)],
                  *[(_number(df, measures[n][k]) if k < len(measures[n]) else nothing)
                    .alias(f"x{k}") for k in range(deep)])
        for n, (df, _) in tables.items()])

    def moments(x):
        return F.struct(F.count(x).alias("numbers"), F.skewness(x).alias("skewness"),
                        F.kurtosis(x).alias("kurtosis"), F.max(x).alias("value_max"),
                        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))

    shape = ("array<struct<numbers:bigint,skewness:double,kurtosis:double,value_max:double,"
             "mean:double,std:double>>")
    return stacked.groupBy("dataset").agg(
        F.count("*").alias("rows"), F.array(*[F.count(f"f{i}") for i in range(wide)]).alias("filled"),
        F.array(*[moments(F.col(f"x{k}")) for k in range(deep)]).cast(shape).alias("moments"))
