"""Quality checks: one row (dataset, model, check_name, status, metric, detail) per check.

Profile checks read profile rows. Data checks share two rollups: one row per date, and one
pass with every model's window as a condition. Each check is one plan for all datasets and
models, so the number of jobs does not grow with either.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import knowledge as K
from tidemark.functions.numbers import column_correlations, number_of, safe_corr
from tidemark.session import inline_rows

CHECK_COLUMNS = ["dataset", "model", "check_name", "status", "metric", "detail"]


def limits_for(model: str, limits: dict | None = None) -> dict:
    """A model's thresholds over the global ones."""
    return {"window_years": 0, **K.GLOBAL_LIMITS,
            **((limits or K.MODEL_LIMITS).get(model) or {})}


@dataclass
class Table:
    """A dataset as the checks see it; ``newest`` is its last date."""

    name: str
    df: DataFrame
    date: str
    subtypes: dict[str, str]
    models: list[str]
    newest: datetime.date | None = None

    def of(self, *kinds: str) -> list[str]:
        return [c for c, s in self.subtypes.items() if s in kinds and c in self.df.columns]

    @property
    def metrics(self) -> list[str]:
        return self.of("measure", "channel", "unclassified_metric")

    @property
    def measure(self) -> str | None:
        return next(iter(self.of("measure")), None)

    def number(self, column: str) -> Column:
        return number_of(F.col(f"`{column}`"), self.df.schema[column].dataType.typeName() == "string")

    def day(self) -> Column:
        return F.col(f"`{self.date}`").cast("date")

    def start(self, years: int) -> Column:
        """First day of a window of so many years; null when it is open. A constant, so a filter
        by it reaches the scan."""
        if not years or self.newest is None:
            return F.lit(None).cast("date")
        return F.add_months(F.lit(self.newest), -12 * years)

    def within(self, years: int) -> Column:
        """Whether a row is in such a window; all rows are when it is open."""
        if not years or self.newest is None:
            return F.lit(True)
        return F.coalesce(self.day() >= self.start(years), F.lit(False))


def newest_dates(calendar: DataFrame) -> dict[str, datetime.date]:
    """The last date of every dataset of a stacked calendar; one row each."""
    return {r["dataset"]: r["d"] for r in
            calendar.groupBy("dataset").agg(F.max("date").alias("d")).collect()}


def _result(check: str, status: Column, metric: Column, detail: Column) -> list[Column]:
    return [F.col("dataset"), F.col("model"), F.lit(check).alias("check_name"),
            status.alias("status"), metric.cast("double").alias("metric"),
            detail.alias("detail")]


def _per_model(facts: DataFrame, limits: dict[str, dict], **columns) -> DataFrame:
    """Facts repeated per model, with limits as columns (name -> function of the limits)."""
    offers = F.array(*[
        F.struct(F.lit(m).alias("model"), *[F.lit(make(lim)).alias(c)
                                            for c, make in columns.items()])
        for m, lim in limits.items()
    ])
    return facts.withColumn("offer", F.explode(offers)).select("*", "offer.*").drop("offer")


def _percent(c: Column) -> Column:
    return F.format_string("%.0f%%", c * 100)


def fill_rate(profiles: DataFrame, limits: dict[str, dict]) -> DataFrame:
    """The best-filled date and the best-filled measure or channel must be filled enough."""
    is_date = F.col("subtype") == "date"
    is_metric = F.col("subtype").isin("measure", "unclassified_metric", "channel")
    alive = is_metric & (F.col("null_pct") < 1.0)
    fill = 1.0 - F.col("null_pct")
    # First column wins among equally filled ones.
    best = lambda test: F.max_by(F.when(test, F.col("name")),
                                 F.when(test, F.struct(fill.alias("f"), -F.col("ordinal"))))
    facts = profiles.groupBy("dataset").agg(
        F.max(F.when(is_date, fill)).alias("date_fill"), best(is_date).alias("date_name"),
        F.max(F.when(alive, fill)).alias("metric_fill"), best(alive).alias("metric_name"),
        F.count_if(is_metric & (F.col("null_pct") >= 1.0)).alias("dead"),
        F.count_if(is_metric).alias("metrics"), F.count_if(is_date).alias("dates"))
    facts = _per_model(facts, limits, low=lambda x: x["min_fill_rate"],
                       floor=lambda x: x["fail_fill_rate"])
    low, floor = F.col("low"), F.col("floor")
    d, m = F.col("date_fill"), F.col("metric_fill")
    all_dead = m.isNull() & (F.col("dead") > 0)
    nothing = (F.col("metrics") == 0) & (F.col("dates") == 0)
    status = (
        F.when(nothing, "WARN").when(d < floor, "FAIL").when(all_dead, "FAIL")
        .when(m < floor, "FAIL").when(d < low, "WARN").when(m < low, "WARN").otherwise("PASS"))
    metric = (
        F.when(nothing, F.lit(None).cast("double")).when(d < floor, F.round(d, 4))
        .when(all_dead, 0.0).when(m < floor, F.round(m, 4)).when(d < low, F.round(d, 4))
        .otherwise(F.round(F.coalesce(m, d), 4)))
    say = lambda what, name, x: F.concat(F.lit(what + " '"), F.col(name), F.lit("' fill "),
                                         _percent(x))
    detail = (
        F.when(nothing, "no date, measure or channel column")
        .when((d < floor) | ((d < low) & ~(m < floor) & ~all_dead),
              say("best date column", "date_name", d))
        .when(all_dead, F.concat(F.lit("all "), F.col("dead").cast("string"),
                                 F.lit(" measure and channel columns are empty")))
        .when(m.isNotNull(), say("best measure or channel", "metric_name", m))
        .otherwise("date columns filled"))
    return facts.select(*_result("fill_rate", status, metric, detail))


def distribution_shape(profiles: DataFrame, limits: dict[str, dict]) -> DataFrame:
    """At least one measure must be neither constant nor binary."""
    spread = F.when(F.abs("mean") > 1e-9, F.try_divide(F.col("std"), F.abs("mean")))
    dull = (F.col("unique_count") <= 2) | F.coalesce(spread < 0.02, F.lit(False))
    is_measure = F.col("subtype").isin("measure", "unclassified_metric")
    alive = is_measure & (F.col("null_pct") < 1.0)
    facts = profiles.groupBy("dataset").agg(
        F.count_if(is_measure).alias("measures"),
        F.count_if(alive & dull).alias("dull"),
        F.count_if(alive & ~dull).alias("healthy"),
        F.min_by(F.when(alive & ~dull, F.struct("name", "unique_count")),
                 F.when(alive & ~dull, F.col("ordinal"))).alias("first"))
    facts = _per_model(facts, limits, enough=lambda x: x["min_measure_unique_count"])
    few = F.col("first.unique_count") < F.col("enough")
    failed = (F.col("healthy") == 0) & (F.col("dull") > 0)
    status = (F.when(F.col("measures") == 0, "WARN").when(failed, "FAIL")
              .when((F.col("healthy") > 0) & few, "WARN").otherwise("PASS"))
    metric = (F.when(F.col("measures") == 0, F.lit(None).cast("double"))
              .when(failed, F.col("dull").cast("double"))
              .when((F.col("healthy") > 0) & few, F.col("first.unique_count").cast("double"))
              .otherwise(F.col("healthy").cast("double")))
    detail = (F.when(F.col("measures") == 0, "no measure columns")
              .when(failed, "every measure is constant or binary")
              .when((F.col("healthy") > 0) & few, F.concat(
                  F.lit("best measure '"), F.col("first.name"), F.lit("' has few values")))
              .otherwise(F.concat(F.col("healthy").cast("string"),
                                  F.lit(" measure column(s) with a healthy shape"))))
    return facts.select(*_result("distribution_shape", status, metric, detail))


def cutoff(years) -> Column:
    """First day of a window that ends at ``newest``; open when it has no length."""
    years = years if isinstance(years, Column) else F.lit(years)
    return F.when(years > 0, F.add_months(F.col("newest"), -12 * years)).otherwise(
        F.lit("0001-01-01").cast("date"))


def windowed(calendar: DataFrame, years: int) -> DataFrame:
    """Rows of a stacked calendar inside a model's window."""
    return _with_newest(calendar).where(F.col("date") >= cutoff(years)).drop("newest")


def _with_newest(calendar: DataFrame) -> DataFrame:
    newest = calendar.groupBy("dataset").agg(F.max("date").alias("newest"))
    return calendar.join(F.broadcast(newest), "dataset")  # one row per dataset


def window_spreads(tables: list[Table], limits: dict[str, dict]) -> DataFrame:
    """Coefficient of variation of every metric in every model's window.

    One pass over the tables, however many models and columns:
    ``dataset, model, ordinal, name, cv``.
    """
    models = list(limits)
    rows = reduce(DataFrame.union, [
        t.df.select(
            F.lit(t.name).alias("dataset"),
            F.array(*[t.within(limits[m]["window_years"]) for m in models]).alias("inside"),
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("name"), t.number(c).alias("x"))
                for i, c in enumerate(t.metrics)])).alias("m"))
        for t in tables]).select("dataset", "inside", "m.*")
    offers = []
    for k, m in enumerate(models):
        x = F.when(F.col("inside")[k], F.col("x"))
        offers.append(F.struct(F.lit(m).alias("model"), (
            F.stddev_samp(x) / (F.abs(F.avg(x)) + 1e-12)).alias("cv")))
    wide = rows.groupBy("dataset", "ordinal", "name").agg(F.array(*offers).alias("offers"))
    return wide.select("dataset", "ordinal", "name", F.explode("offers").alias("o")).select(
        "dataset", "ordinal", "name", "o.*")


def zero_variance(spreads: DataFrame, limits: dict[str, dict]) -> DataFrame:
    """Columns whose spread is below 1 % of their mean, in the model's window."""
    limit = F.lit(None).cast("double")
    for m, lim in limits.items():
        limit = F.when(F.col("model") == m, F.lit(lim["zero_variance_cv"])).otherwise(limit)
    flat = F.col("cv") < limit
    facts = spreads.groupBy("dataset", "model").agg(
        F.array_sort(F.collect_list(F.when(flat, F.struct("ordinal", "name", "cv"))))
        .alias("flat"))
    some = F.size("flat") > 0
    return facts.select(*_result(
        "zero_variance", F.when(some, "WARN").otherwise("PASS"),
        F.when(some, F.round(F.try_element_at("flat", F.lit(1))["cv"], 6)),
        F.when(some, F.concat(F.lit("near-constant columns: "), F.array_join(
            F.transform("flat", lambda s: s["name"]), ", ")))
        .otherwise("every measure and channel varies")))


def _periods_needed(lim: dict, grain: Column, typical: Column) -> Column:
    if isinstance(lim.get("min_periods"), dict):
        needs = [F.lit(x) for item in lim["min_periods"].items() for x in item]
        return F.coalesce(F.create_map(*needs)[grain], F.lit(lim["min_periods"]["default"]))
    if "min_years" in lim:
        per_year = (F.when(typical <= 2, 365).when(typical <= 9, 52).when(typical <= 35, 12)
                    .otherwise(4))
        return F.floor(per_year * F.lit(lim["min_years"])).cast("int")
    return F.lit(lim.get("min_weeks", lim["min_row_count"]))


def _stepped(calendar: DataFrame, limits: dict[str, dict], *values: str) -> DataFrame:
    """Calendar rows per model window with the previous row where it is in the window too."""
    in_order = Window.partitionBy("dataset").orderBy("date")  # one row per date: calendar-sized
    stepped = _with_newest(calendar).select(
        "dataset", "newest", "date", *values, F.lag("date").over(in_order).alias("before"),
        *[F.lag(v).over(in_order).alias(f"{v}|before") for v in values])
    repeated = _per_model(stepped, limits, years=lambda x: x["window_years"])
    start = cutoff(F.col("years"))
    return repeated.where(F.col("date") >= start).withColumn(
        "paired", F.coalesce(F.col("before") >= start, F.lit(False)))


def date_continuity(calendar: DataFrame, grains: DataFrame, limits: dict[str, dict]) -> DataFrame:
    """Enough periods for the grain, and no gap longer than the allowed periods.

    ``calendar`` has one row per dataset and date, ``grains`` the profiled grain (or null) as
    ``given`` of every dataset, those without any date included.
    """
    gap = F.when(F.col("paired"), F.datediff("date", "before"))
    seen = _stepped(calendar, limits).withColumn("gap", gap).groupBy("dataset", "model").agg(
        F.count("*").alias("n"), F.percentile("gap", 0.5).alias("median_gap"),
        F.max("gap").alias("max_gap"), F.collect_list("gap").alias("gaps"))
    # A window without any date still has to fail.
    seen = _per_model(grains, limits).join(seen, ["dataset", "model"], "left")
    known = F.col("given").isin(*K.GRAIN_DAYS)
    days = [F.lit(x) for item in K.GRAIN_DAYS.items() for x in item]
    typical = (F.when(known, F.create_map(*days)[F.col("given")])
               .when(F.col("median_gap") > 0, F.col("median_gap")).otherwise(7.0))
    named = (F.when(known, F.col("given")).when(F.coalesce("median_gap", F.lit(0)) <= 0, None)
             .when(typical <= 2, "daily").when(typical <= 9, "weekly")
             .when(typical <= 35, "monthly").when(typical <= 100, "quarterly"))
    facts = seen.withColumn("n", F.coalesce("n", F.lit(0))).withColumns(
        {"typical": typical, "grain": named})
    need, allowed = F.lit(None).cast("int"), F.lit(None).cast("double")
    for m, lim in limits.items():
        here = F.col("model") == m
        need = F.when(here, _periods_needed(lim, F.col("grain"), F.col("typical"))).otherwise(need)
        allowed = F.when(here, F.lit(float(lim.get("max_gap_periods", 4)))).otherwise(allowed)
    facts = facts.withColumns({
        "need": need, "allowed": allowed,
        "widest": F.col("max_gap") / F.col("typical"),
        "label": F.coalesce("grain", F.format_string("~%.0f-day", F.col("typical"))),
    }).withColumn("n_wide", F.size(F.filter(
        "gaps", lambda g: g / F.col("typical") > F.col("allowed"))))
    short, single = F.col("n") < F.col("need"), F.col("n") < 2
    wide = F.col("widest") > F.col("allowed")
    return facts.select(*_result(
        "date_continuity",
        F.when(short, "FAIL").when(single, "PASS").when(wide, "WARN").otherwise("PASS"),
        F.when(short | single, F.col("n").cast("double"))
        .when(wide, F.round("widest", 2)).otherwise(0.0),
        F.when(short, F.format_string("%d %s dates, %d needed", "n", "label", "need"))
        .when(single, "single date")
        .when(wide, F.format_string("%d gap(s) above the allowed periods", "n_wide"))
        .otherwise(F.format_string("no wide gap in %d %s dates", "n", "label"))))


def channel_collinearity(tables: list[Table], limits: dict[str, dict]) -> DataFrame:
    """Pairwise correlation of channels over rows where every channel is present."""
    spark = tables[0].df.sparkSession
    notes, parts, asked = [], [], []
    width = max(len(t.of("channel")) for t in tables)
    for t in tables:
        channels = t.of("channel")
        models = [m for m in t.models if m in limits]
        for m in models:
            need = limits[m]["min_channel_count"]
            if len(channels) < need:
                notes.append((t.name, m, "channel_collinearity", "FAIL", float(len(channels)),
                              f"{len(channels)} channel column(s), {need} needed"))
            elif len(channels) < 2:
                notes.append((t.name, m, "channel_collinearity", "PASS", None, "single channel"))
            else:
                asked.append((t.name, m, limits[m]["collinearity_threshold"]))
        models = [m for n, m, _ in asked if n == t.name]
        if models:
            whole = t.df.select(
                F.array(*[F.when(t.within(limits[m]["window_years"]), F.lit(m)) for m in models])
                .alias("inside"), *[t.number(c).alias(f"x{i}") for i, c in enumerate(channels)])
            whole = whole.dropna(subset=[f"x{i}" for i in range(len(channels))])
            parts.append(whole.select(
                F.lit(t.name).alias("dataset"),
                F.explode(F.array_compact("inside")).alias("model"),
                *[(F.col(f"x{i}") if i < len(channels) else F.lit(None).cast("double"))
                  .alias(f"x{i}") for i in range(width)]))
    found = inline_rows(spark, CHECK_SHAPE, notes)
    if not parts:
        return found
    asked = inline_rows(spark, {"dataset": "string", "model": "string", "limit": "double"}, asked)
    pairs = column_correlations(reduce(DataFrame.union, parts), ["dataset", "model"],
                                [f"x{i}" for i in range(width)])
    facts = asked.join(pairs, ["dataset", "model"], "left").groupBy("dataset", "model").agg(
        F.max("n_pairs").alias("n"), F.max(F.abs("r")).alias("most"),
        F.count_if(F.abs("r") > F.col("limit")).alias("n_high"))
    few, high = F.coalesce("n", F.lit(0)) < 3, F.col("n_high") > 0
    return found.unionByName(facts.select(*_result(
        "channel_collinearity", F.when(few | high, "WARN").otherwise("PASS"),
        F.when(~few, F.round("most", 4)),
        F.when(few, "too few complete rows").otherwise(F.concat(
            F.col("n_high").cast("string"), F.lit(" channel pair(s) above the limit"))))))


def segment_sizes(tables: list[Table], limits: dict[str, dict]) -> DataFrame:
    """Smallest, largest and number of groups per segment column and model, in one pass."""
    models = list(limits)
    rows = reduce(DataFrame.union, [
        t.df.select(
            F.lit(t.name).alias("dataset"),
            F.array(*[t.within(limits[m]["window_years"]) for m in models]).alias("inside"),
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("name"),
                         F.col(f"`{c}`").cast("string").alias("value"))
                for i, c in enumerate(t.of("segment"))])).alias("p"))
        for t in tables]).select("dataset", "inside", "p.*").where("value IS NOT NULL")
    offers = F.array(*[F.struct(F.lit(m).alias("model"), F.count_if(F.col("inside")[k]).alias("n"))
                       for k, m in enumerate(models)])
    groups = rows.groupBy("dataset", "ordinal", "name", "value").agg(offers.alias("offers")).select(
        "dataset", "ordinal", "name", F.explode("offers").alias("o")).select(
        "dataset", "ordinal", "name", "o.*").where("n > 0")
    return groups.groupBy("dataset", "model", "ordinal", "name").agg(
        F.count("*").alias("n_groups"), F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
    ).withColumn("imbalance", F.col("largest") / (F.col("smallest") + F.lit(1e-9)))


def segment_balance(tables: list[Table], limits: dict[str, dict]) -> DataFrame:
    """The first segment column with large enough groups decides."""
    spark = tables[0].df.sparkSession
    notes = [(t.name, m, "segment_balance", "WARN", None, "no segment column")
             for t in tables if not t.of("segment") for m in t.models if m in limits]
    having = [t for t in tables if t.of("segment")]
    found = inline_rows(spark, CHECK_SHAPE, notes)
    if not having:
        return found
    asked = _per_model(inline_rows(spark, {"dataset": "string"}, [(t.name,) for t in having]),
                       limits, least=lambda x: x["min_segment_size"],
                       uneven=lambda x: float(x["max_imbalance_ratio"]))
    sizes = asked.join(segment_sizes(having, limits), ["dataset", "model"], "left")
    there = F.col("name").isNotNull()
    big = F.col("smallest") >= F.col("least")
    row = F.struct("name", "n_groups", "smallest", "imbalance")
    facts = sizes.groupBy("dataset", "model", "uneven").agg(
        F.min_by(F.when(big, row), F.when(big, F.col("ordinal"))).alias("first"),
        F.max_by(F.when(there, row), F.when(there, F.struct("smallest", -F.col("ordinal"))))
        .alias("best"))
    chosen, none = F.col("first").isNotNull(), F.col("best").isNull()
    even = F.col("first.imbalance") <= F.col("uneven")
    return found.unionByName(facts.select(*_result(
        "segment_balance",
        F.when(none, "WARN").when(chosen & even, "PASS").when(chosen, "WARN").otherwise("FAIL"),
        F.when(chosen, F.round("first.imbalance", 2))
        .otherwise(F.col("best.smallest").cast("double")),
        F.when(none, "no segment column in the data")
        .when(chosen, F.format_string("'%s': %d groups, ratio %.1f", "first.name",
                                      "first.n_groups", "first.imbalance"))
        .otherwise(F.format_string("best segment '%s' has a group of %d rows", "best.name",
                                   "best.smallest")))))


def lag_correlation(series: DataFrame, date: str, value: str, keys: list[str] | None = None,
                    lags: list[int] = (1,)) -> DataFrame:
    """Pearson r of a series with itself some periods earlier, per series and lag."""
    in_order = Window.partitionBy(*(keys or [])).orderBy(date)
    present = series.where(F.col(value).isNotNull())
    lagged = present.select(*(keys or []), F.col(value).alias("x"), *[
        F.lag(value, k).over(in_order).alias(f"x{k}") for k in lags])
    wide = lagged.groupBy(*(keys or [])).agg(
        F.count("*").alias("n"),
        *[safe_corr(F.col("x"), F.col(f"x{k}"), 2).alias(f"r{k}") for k in lags])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"r{k}").alias("acf"))
                     for k in lags])
    return wide.select(*(keys or []), "n", F.explode(rows).alias("a")).select(
        *(keys or []), "n", "a.lag", "a.acf")


def autocorrelation(calendar: DataFrame, limits: dict[str, dict]) -> DataFrame:
    """Lag-1 correlation of the rolled-up measure (``value``) in the model's window."""
    stepped = _stepped(calendar.where("value IS NOT NULL"), limits, "value")
    earlier = F.when(F.col("paired"), F.col("value|before"))
    facts = stepped.groupBy("dataset", "model").agg(
        F.count("*").alias("n"), safe_corr(F.col("value"), earlier, 2).alias("acf"))
    facts = _per_model(facts.withColumnRenamed("model", "of"), limits,
                       weakest=lambda x: x["min_acf_lag1"]).where(F.col("of") == F.col("model"))
    few = (F.col("n") < 10) | F.col("acf").isNull()
    weak = F.abs("acf") < F.col("weakest")
    return facts.select(*_result(
        "autocorrelation", F.when(few | weak, "WARN").otherwise("PASS"),
        F.when(~few, F.round("acf", 4)),
        F.when(few, "too few periods").otherwise(F.format_string("lag-1 r=%.3f", "acf"))))


def min_row_count(calendar: DataFrame, names: DataFrame, limits: dict[str, dict]) -> DataFrame:
    """Rows in the model's window; ``names`` lists the datasets, those without a date included."""
    counted = _with_newest(calendar).groupBy("dataset").agg(F.array(*[
        F.sum(F.when(F.col("date") >= cutoff(lim["window_years"]), F.col("n_rows")))
        for lim in limits.values()]).alias("counts"))
    offers = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(m).alias("model"), F.lit(lim.get(
            "min_rows", lim.get("min_weeks", lim["min_row_count"]))).alias("need"))
        for i, (m, lim) in enumerate(limits.items())])
    facts = names.join(counted, "dataset", "left").withColumn("r", F.explode(offers)).select(
        "dataset", "r.*", F.coalesce(F.get("counts", F.col("r.place")), F.lit(0)).alias("n"))
    return facts.select(*_result(
        "min_row_count", F.when(F.col("n") < F.col("need"), "FAIL").otherwise("PASS"),
        F.col("n"), F.format_string("%d rows, %d needed", "n", "need")))


CHECK_SHAPE = {"dataset": "string", "model": "string", "check_name": "string",
               "status": "string", "metric": "double", "detail": "string"}


def quality_checks(tables: list[Table], profiles: DataFrame, calendar: DataFrame,
                   limits: dict | None = None) -> DataFrame:
    """Every check of every table and model as rows.

    ``profiles`` and ``calendar`` hold all tables; they are read by many checks and should be
    stored stages. The calendar's ``value`` is the rolled-up `Table.measure`.
    """
    spark = calendar.sparkSession
    all_limits = {m: limits_for(m, limits) for t in tables for m in t.models}
    wanting = lambda check: {m: lim for m, lim in all_limits.items()
                             if check in (lim.get("checks") or [])}
    names = inline_rows(spark, {"dataset": "string", "date_column": "string"},
                        [(t.name, t.date) for t in tables])
    notes = []

    def either(there, check, status, text, make):
        """The check of tables that have what it reads; a note for the others."""
        having = [t for t in tables if there(t)]
        notes.extend((t.name, m, check, status, None, text)
                     for t in tables if t not in having for m in t.models if m in wanting(check))
        return make(having) if having else inline_rows(spark, CHECK_SHAPE, [])

    def grains():
        found = profiles.select("dataset", F.col("name").alias("date_column"),
                                F.col("date_grain").alias("given"))
        return names.join(found, ["dataset", "date_column"], "left").drop("date_column")

    makers = {
        "fill_rate": lambda x: fill_rate(profiles, x),
        "distribution_shape": lambda x: distribution_shape(profiles, x),
        "zero_variance": lambda x: either(
            lambda t: t.metrics, "zero_variance", "PASS", "no measure or channel columns",
            lambda having: zero_variance(window_spreads(having, x), x)),
        "date_continuity": lambda x: date_continuity(calendar, grains(), x),
        "channel_collinearity": lambda x: channel_collinearity(tables, x),
        "segment_balance": lambda x: segment_balance(tables, x),
        "autocorrelation": lambda x: either(
            lambda t: t.measure, "autocorrelation", "WARN", "no measure column",
            lambda having: autocorrelation(calendar, x)),
        "min_row_count": lambda x: min_row_count(calendar, names.select("dataset"), x),
    }
    rows = [make(wanting(check)).select(*CHECK_COLUMNS)
            for check, make in makers.items() if wanting(check)]
    for t in tables:
        for m in t.models:
            checks = all_limits[m].get("checks") or []
            if not checks:
                notes.append((t.name, m, "no_checks", "PASS", None, "no checks configured"))
            notes += [(t.name, m, c, "WARN", None, "unknown check")
                      for c in checks if c not in makers]
    # Limits are by model: rows of models that a table is not routed to go.
    routed = inline_rows(spark, {"dataset": "string", "model": "string"},
                         [(t.name, m) for t in tables for m in t.models])
    every = reduce(DataFrame.unionByName, [*rows, inline_rows(spark, CHECK_SHAPE, notes)])
    return every.join(F.broadcast(routed), ["dataset", "model"], "left_semi").select(*CHECK_COLUMNS)


def _worst(status: Column) -> Column:
    """FAIL over WARN over PASS."""
    level = F.when(status == "FAIL", 2).when(status == "WARN", 1).otherwise(0)
    return F.element_at(F.array(F.lit("PASS"), F.lit("WARN"), F.lit("FAIL")),
                        F.max(level) + 1)


def model_decisions(checks: DataFrame, order: dict[str, list[str]] | None = None) -> DataFrame:
    """Worst status per model, and the first failed check as the reason."""
    order = order or {m: lim["checks"] for m, lim in K.MODEL_LIMITS.items()}
    places = [F.lit(x) for m, names in order.items() for i, n in enumerate(names)
              for x in (f"{m}|{n}", i)]
    place = F.coalesce(F.create_map(*places)[F.concat_ws("|", "model", "check_name")], F.lit(-1))
    failed = F.col("status") == "FAIL"
    return checks.groupBy("dataset", "model").agg(
        _worst(F.col("status")).alias("decision"),
        F.min_by(F.when(failed, F.col("detail")), F.when(failed, place)).alias("skip_reason"))


def overall_decisions(decisions: DataFrame) -> DataFrame:
    """A dataset passes when any of its models does."""
    has = lambda s: F.max((F.col("decision") == s).cast("int")) == 1
    return decisions.groupBy("dataset").agg(
        F.when(has("PASS"), "PASS").when(has("WARN"), "WARN").otherwise("FAIL")
        .alias("overall_decision"))
