"""Rolling detail rows up to one row per period, and filling the calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.dates import week_end_saturday
from tidemark.functions.names import rolled_by_mean
from tidemark.functions.numbers import clean_float


def clean_rows(df: DataFrame, config: K.SeriesConfig, all_products: bool = True) -> DataFrame:
    """Rows not marked as anomalies, optionally of the configured product only."""
    if config.anomaly and config.anomaly in df.columns:
        df = df.where(F.col(config.anomaly) == 0)
    if not all_products and config.product in df.columns and config.product_value is not None:
        df = df.where(F.col(config.product) == config.product_value)
    return df


def clean_row_stats(df: DataFrame, config: K.SeriesConfig) -> DataFrame:
    """Rows, marked rows, clean rows and distinct entities in clean rows, in one job."""
    marked = F.col(config.anomaly) == 1
    clean = F.col(config.anomaly) == 0
    # Merged per entity first, so the distinct count is a plain count afterwards.
    per_entity = df.groupBy(config.entity).agg(
        F.count("*").alias("n"), F.count_if(marked).alias("n_marked"),
        F.count_if(clean).alias("n_clean"))
    return per_entity.agg(
        F.sum("n").alias("n_rows"), F.sum("n_marked").alias("n_anomaly"),
        F.sum("n_clean").alias("n_clean"),
        F.count_if((F.col("n_clean") > 0) & F.col(config.entity).isNotNull())
        .alias("n_entities"))


def market_rollup(df: DataFrame, config: K.SeriesConfig, by_product: bool = True,
                  all_products: bool = True) -> DataFrame:
    """One row per week (and product): volumes summed, market constants averaged.

    Without ``all_products`` only rows of the configured product count. A sum over no values is 0. The lifecycle stage is that of the smallest entity that has one.
    """
    have = set(df.columns)
    extra = [c for c in ("trx", "nrx") if c != config.target]
    summed = [c for c in [*config.rolled_by("sum"), config.target, *extra] if c in have]
    meaned = [c for c in config.rolled_by("mean") if c in have]
    keys = [config.week]
    if by_product and config.product in have:
        keys.append(config.product)
    aggs = [F.coalesce(F.sum(clean_float(F.col(c))), F.lit(0.0)).alias(c) for c in summed]
    aggs += [F.avg(clean_float(F.col(c))).alias(c) for c in meaned]
    if config.lifecycle in have:
        order = F.col(config.entity) if config.entity in have else F.col(config.lifecycle)
        aggs.append(F.min_by(config.lifecycle, F.when(F.col(config.lifecycle).isNotNull(), order))
                    .alias(config.lifecycle))
    return clean_rows(df, config, all_products).groupBy(*keys).agg(*aggs)


def date_rollup(df: DataFrame, date: str, measures: list[str]) -> DataFrame:
    """One row per date with a row count; ratios averaged, volumes summed."""
    return df.where(F.col(date).isNotNull()).groupBy(date).agg(
        *[_rolled(c) for c in measures], F.count("*").alias("n_obs"))


def segment_rollup(df: DataFrame, date: str, measures: list[str],
                   grain: list[str]) -> DataFrame:
    """One row per date through one row per date and segment.

    Ratios become the mean of segment means. ``n_<first grain column>`` counts its distinct
    values per date. Rows without a segment are left out.
    """
    keyed = df.where(F.col(date).isNotNull())
    for c in grain:
        keyed = keyed.where(F.col(c).isNotNull())
    first = grain[0]
    cells = keyed.groupBy(date, *grain).agg(*[_rolled(c) for c in measures])
    # Means must stay means of cells, so each date carries sums and cell counts per first key.
    partial = cells.groupBy(date, first).agg(
        *[F.sum(c).alias(c) for c in measures],
        *[F.count(c).alias(f"{c}|cells") for c in measures if _is_mean(c)])
    return partial.groupBy(date).agg(
        *[(F.try_divide(F.sum(c), F.sum(f"{c}|cells")) if _is_mean(c)
           else F.coalesce(F.sum(c), F.lit(0.0))).alias(c) for c in measures],
        F.count(first).alias(f"n_{first}"))


def _is_mean(name: str) -> bool:
    return rolled_by_mean(name, K.RATE_WORDS)


def _rolled(name: str):
    value = clean_float(F.col(name))
    if _is_mean(name):
        return F.avg(value).alias(name)
    return F.coalesce(F.sum(value), F.lit(0.0)).alias(name)


def monthly_grain(series: DataFrame, date: str, measures: list[str]) -> DataFrame:
    """A weekly series as one row per month, dated by its last week.

    A series whose median gap is 25 days or more is already monthly and keeps its rows.
    """
    in_order = Window.orderBy(date)  # one row per period: calendar-sized
    gap = series.select(F.datediff(date, F.lag(date).over(in_order)).alias("gap")).select(
        F.percentile("gap", 0.5)).scalar()
    is_fine = F.coalesce(gap < 25, F.lit(False))
    period = F.when(is_fine, F.trunc(date, "MM")).otherwise(F.col(date).cast("date"))
    return series.withColumn("period", period).groupBy("period").agg(
        F.max(date).alias(date), *[_rolled(c) for c in measures]).drop("period")


def saturday_weeks(df: DataFrame, date: str, measures: list[str]) -> DataFrame:
    """Daily rows summed into weeks that end on Saturday; weeks without rows are 0."""
    weeks = df.where(F.col(date).isNotNull()).groupBy(
        week_end_saturday(F.col(date)).alias(date)
    ).agg(*[F.sum(clean_float(F.col(c))).alias(c) for c in measures])
    return spine(weeks, date).join(weeks, date, "left").select(
        date, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in measures])


def spine(series: DataFrame, date: str, keys: list[str] | None = None,
          days: int = 7) -> DataFrame:
    """Every period between a series' first and last date."""
    limits = series.groupBy(*(keys or [])).agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    step = F.make_interval(days=F.lit(days))
    return limits.where("lo IS NOT NULL").select(
        *(keys or []), F.explode(F.sequence(
            F.col("lo").cast("date"), F.col("hi").cast("date"), step)).alias(date))


def fill_forward(series: DataFrame, date: str, columns: list[str],
                 keys: list[str] | None = None) -> DataFrame:
    """Missing values take the last known one of their series."""
    so_far = Window.partitionBy(*(keys or [])).orderBy(date).rowsBetween(
        Window.unboundedPreceding, 0)
    return series.select(*[
        (F.last(c, ignorenulls=True).over(so_far).alias(c) if c in columns else F.col(c))
        for c in series.columns
    ])


def spine_filled(series: DataFrame, date: str, keys: list[str], columns: list[str],
                 days: int = 7) -> DataFrame:
    """A gapless series: missing periods appear and repeat the last known values.

    Only the given rows are moved and sorted, once; each then repeats itself in place up to its
    next one, so the filled calendar is never shuffled. Rows beside the periods, which start at a
    series' first date, do not count, nor do rows with a null key, whose periods stay empty.
    """
    own, others = [F.col(f"`{k}`") for k in keys], [
        c for c in series.columns if c not in (*keys, date)]
    at, whole = F.col("__at"), Window.partitionBy(*own)
    in_order = whole.orderBy(at)
    known = series.where(F.col(date).isNotNull()).withColumn("__at", F.col(date)).withColumns({
        "__day": at.cast("date"), "__lo": F.min(at).over(whole).cast("date"),
        "__hi": F.max(at).over(whole).cast("date"), "__row": F.row_number().over(in_order)})
    on_period = (F.col("__day") == at) & (F.datediff("__day", "__lo") % days == 0)
    hit = reduce(lambda a, k: a & k.isNotNull(), own, on_period)
    # A series without a row at its first period starts with an empty one.
    known = known.withColumn("__hit", hit).where(F.col("__hit") | (F.col("__row") == 1))
    known = known.withColumns({c: F.when(F.col("__hit"), F.col(f"`{c}`")) for c in others})
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    known = known.withColumns({
        "__next": F.lead("__day").over(in_order),
        "__last": F.struct(F.lit(True).alias("_"), *[
            F.last(F.col(f"`{c}`"), ignorenulls=True).over(so_far).alias(c)
            for c in others if c in columns])})
    more = F.coalesce(F.datediff("__next", "__day") - 1, F.datediff("__hi", "__day"))
    steps = F.sequence(F.lit(0), F.greatest(F.floor(more / days).cast("int"), F.lit(0)))
    return known.withColumn("__step", F.explode(steps)).select(
        *own, F.date_add("__day", F.col("__step") * days).alias(date),
        *[(F.col("__last")[c] if c in columns
           else F.when(F.col("__step") == 0, F.col(f"`{c}`"))).alias(c) for c in others])


def calendar_rollup(df: DataFrame, date: str, measures: list[str]) -> DataFrame:
    """``date, n_rows`` and measure sums: the calendar-sized base of windows and gates."""
    return df.where(F.col(date).isNotNull()).groupBy(
        F.col(date).cast("date").alias("date")).agg(
        F.count("*").alias("n_rows"), *[_rolled(c) for c in measures])


def calendars(tables: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """``dataset, date, n_rows, v0, v1, ..`` of many tables, each (table, date column, measures).

    The measures of all tables share positions, so one rollup does for any number of tables;
    `calendar_of` gives one table's with its own names. Its size is the calendar's.
    """
    width = max([len(measures) for _, _, measures in tables.values()], default=0)
    nothing = F.lit(None).cast("double")
    stacked = reduce(DataFrame.union, [
        df.where(F.col(date).isNotNull()).select(
            F.lit(name).alias("dataset"), F.col(date).cast("date").alias("date"),
            *[(clean_float(F.col(f"`{measures[i]}`")) if i < len(measures) else nothing)
              .alias(f"x{i}") for i in range(width)])
        for name, (df, date, measures) in tables.items()])

    def rolled(i):
        by_mean = [n for n, (_, _, measures) in tables.items()
                   if i < len(measures) and _is_mean(measures[i])]
        there = [n for n, (_, _, measures) in tables.items() if i < len(measures)]
        total = F.when(F.col("dataset").isin(*there), F.coalesce(F.sum(f"x{i}"), F.lit(0.0)))
        return (F.when(F.col("dataset").isin(*by_mean), F.avg(f"x{i}")).otherwise(total)
                if by_mean else total).alias(f"v{i}")

    return stacked.groupBy("dataset", "date").agg(
        F.count("*").alias("n_rows"), *[rolled(i) for i in range(width)])


def calendar_of(stacked: DataFrame, dataset: str, measures: list[str]) -> DataFrame:
    """One table's calendar: ``date, n_rows`` and its measures."""
    return stacked.where(F.col("dataset") == dataset).select(
        "date", "n_rows", *[F.col(f"v{i}").alias(c) for i, c in enumerate(measures)])
