"""The whole run: describe tables, route models, gate them, run them, explain, report.

Only metadata comes to the driver: column names with their meaning, routes and gate decisions,
a handful of rows per dataset. Data stays in DataFrames; the series of all datasets and measures
go through one change-point job.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import knowledge as K
from tidemark.functions.dates import hazard_of, with_all_dates
from tidemark.functions.numbers import column_correlations
from tidemark.operators import attribution as A
from tidemark.operators import changepoint as C
from tidemark.operators import gate as G
from tidemark.operators.features import channel_groups_by_name, market_features
from tidemark.operators.meaning import column_subtypes, scrub_dead_columns, table_classes
from tidemark.operators.profiling import column_profiles
from tidemark.operators.rollup import calendars
from tidemark.operators.routing import duplicate_signals, model_routes, star_keys
from tidemark.operators.selection import best_date, ranked_measures
from tidemark.session import inline_rows, stage
from tidemark.sources.catalog import column_catalog

RUNNERS = ("BOCPD", "MMM")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass
class Metadata:
    """Metadata tables of one catalog, each made when it is first asked for.

    Those that others read (a row per column or less) are stored once.
    """

    spark: SparkSession
    datasets: dict[str, DataFrame]
    datamarts: DataFrame | None = None
    hints: dict | None = None

    @cached_property
    def catalog(self) -> DataFrame:
        return column_catalog(self.spark, self.datasets)

    @cached_property
    def specs(self) -> DataFrame:
        return stage(column_subtypes(self.catalog, hints=self.hints))

    @cached_property
    def classes(self) -> DataFrame:
        return stage(table_classes(self.specs, self.datamarts))

    @cached_property
    def keys(self) -> DataFrame:
        return stage(star_keys(self.specs, self.classes))

    @cached_property
    def routes(self) -> DataFrame:
        return stage(model_routes(self.specs, self.classes, self.datamarts, keys=self.keys))

    @cached_property
    def duplicates(self) -> DataFrame:
        return duplicate_signals(self.specs, self.classes, self.routes)


def describe(spark: SparkSession, datasets: dict[str, DataFrame],
             datamarts: DataFrame | None = None, hints: dict | None = None) -> Metadata:
    return Metadata(spark, datasets, datamarts, hints)


@dataclass
class Fact:
    """What the driver knows of one routed fact: names, and its last date."""

    dataset: str
    df: DataFrame
    subtypes: dict[str, str]
    models: list[str]
    date: str | None = None
    measures: list[str] = field(default_factory=list)
    newest: datetime.date | None = None

    def table(self) -> G.Table:
        return G.Table(self.dataset, self.df, self.date, self.subtypes, self.models, self.newest)


@dataclass
class Facts:
    """All routed facts with their stored profiles and calendars, one table for all of each.

    Every step below is one plan over these, so the number of jobs is that of a single fact.
    """

    facts: list[Fact]
    profiles: DataFrame | None = None
    calendar: DataFrame | None = None

    @property
    def dated(self) -> list[Fact]:
        return [f for f in self.facts if f.date]


class Errors(list):
    """(dataset, model, text) of what failed; one broken dataset must not end the run."""

    def attempt(self, dataset: str, models: list[str], make):
        """The result, or None with the error noted for each model."""
        try:
            return make()
        except (PySparkException, Py4JJavaError, ValueError) as error:
            text = str(error).strip()
            self.extend((dataset, m, text) for m in models)
            return None

    def together(self, parts: dict[str, list[str]], make):
        """``make(names)`` for all parts (name -> models) in one go.

        Only if that fails is every part tried alone, and the sound ones made together again; the
        errors of the others are noted. None if no part is sound.
        """
        if not parts:
            return None
        found = Errors().attempt("", [""], lambda: make(list(parts)))
        if found is not None:
            return found
        sound = [n for n, models in parts.items()
                 if self.attempt(n, models, lambda: [make([n])]) is not None]
        return make(sound) if sound else None

    def rows(self, spark: SparkSession) -> DataFrame:
        return inline_rows(spark, {"dataset": "string", "model": "string", "error": "string"}, self)


def routed_facts(metadata: Metadata, datasets: dict[str, DataFrame],
                 models: list[str] | None = None, errors: Errors | None = None) -> Facts:
    """Facts with a route to one of the chosen models, profiled, with ranked measures.

    Only ``datasets`` take part, whatever else is described. Date columns of any kind become
    dates first. A fact without a usable date column is kept;
    its ``date`` is None and `gate` says so in the outcomes.
    """
    errors = Errors() if errors is None else errors
    specs = metadata.specs.orderBy("dataset", "ordinal").collect()
    routes = metadata.routes.orderBy("dataset", "route_rank").collect()
    facts = {}
    for name in dict.fromkeys(r["dataset"] for r in routes):
        chosen = [r["model"] for r in routes
                  if r["dataset"] == name and (not models or r["model"] in models)]
        if chosen and name in datasets:
            subtypes = {s["name"]: s["subtype"] for s in specs if s["dataset"] == name}
            facts[name] = Fact(name, datasets[name], subtypes, chosen)
    dated = errors.together({n: f.models for n, f in facts.items()}, lambda names: with_all_dates({
        n: (facts[n].df, [c for c, s in facts[n].subtypes.items() if s == "date"])
        for n in names})) or {}
    facts = {n: replace(facts[n], df=df) for n, df in dated.items()}
    known = {n: f.models for n, f in facts.items()}

    def profiled(names):
        return names, stage(column_profiles({n: (facts[n].df, facts[n].subtypes) for n in names}))

    found = errors.together(known, profiled)
    if found is None:
        return Facts([])
    names, profiles = found
    alive = scrub_dead_columns(metadata.specs, profiles)
    dates = {r["dataset"]: r["date_column"] for r in best_date(alive, profiles).collect()}
    ranked = ranked_measures(alive, profiles).orderBy("dataset", "measure_rank").collect()
    dead = {(r["dataset"], r["name"]) for r in alive.where("subtype = 'unknown'").collect()}
    for n in names:
        f = facts[n]
        f.date = dates.get(n)
        f.measures = [r["name"] for r in ranked if r["dataset"] == n]
        f.subtypes = {c: ("unknown" if (n, c) in dead else s) for c, s in f.subtypes.items()}
    dated = {n: known[n] for n in names if facts[n].date}
    found = errors.together(dated, lambda own: (own, stage(calendars(
        {n: (facts[n].df, facts[n].date, facts[n].measures) for n in own}))))
    rolled, calendar = found or ([], None)
    newest = G.newest_dates(calendar) if rolled else {}
    for n in rolled:
        facts[n].newest = newest.get(n)
    return Facts([facts[n] for n in names if n in rolled or not facts[n].date], profiles, calendar)


WINDOW_SHAPE = {"dataset": "string", "model": "string", "years": "int", "cutoff_date": "date",
                "max_date": "date", "n_rows": "bigint"}
NO_DATE = "no usable date column"


def measure_value(facts: list[Fact], chosen) -> Column:
    """The calendar's value of one measure per fact; ``chosen(fact)`` names it or is None."""
    value = F.lit(None).cast("double")
    for f in facts:
        if chosen(f) in f.measures:
            value = F.when(F.col("dataset") == f.dataset,
                           F.col(f"v{f.measures.index(chosen(f))}")).otherwise(value)
    return value


def gate(spark: SparkSession, known: Facts, limits: dict | None = None) -> DataFrame:
    """Every check of every routed model; one row each. A fact without a date fails them all."""
    rows = inline_rows(spark, G.CHECK_SHAPE, [
        (f.dataset, m, "date_column", "FAIL", None, NO_DATE)
        for f in known.facts if not f.date for m in f.models])
    tables = [f.table() for f in known.dated]
    if not tables:
        return rows
    here = F.col("dataset").isin(*[t.name for t in tables])
    measures = {t.name: t.measure for t in tables}
    calendar = known.calendar.where(here).select("dataset", "date", "n_rows", measure_value(
        known.dated, lambda f: measures[f.dataset]).alias("value"))
    return rows.unionByName(
        G.quality_checks(tables, known.profiles.where(here), calendar, limits))


def windows(spark: SparkSession, known: Facts) -> DataFrame:
    """Date window per dataset and model that has one."""
    years = {m: G.limits_for(m).get("window_years", 0) for f in known.dated for m in f.models}
    offers = [(f.dataset, m, years[m], f.newest) for f in known.dated for m in f.models
              if years[m] > 0 and f.newest]
    if not offers:
        return inline_rows(spark, WINDOW_SHAPE, [])
    asked = inline_rows(spark, {"dataset": "string", "model": "string", "years": "int",
                                "max_date": "date"}, offers)
    asked = asked.withColumn("cutoff_date", F.add_months("max_date", -12 * F.col("years")))
    # A row per dataset and model beside one per date.
    return known.calendar.join(F.broadcast(asked), "dataset").groupBy(
        "dataset", "model", "years", "cutoff_date", "max_date").agg(
        F.coalesce(F.sum(F.when(F.col("date") >= F.col("cutoff_date"), F.col("n_rows"))), F.lit(0))
        .cast("bigint").alias("n_rows"))


def kept_measures(facts: list[Fact], thresholds: dict[str, float]) -> dict[tuple[str, str], list[str]]:
    """(dataset, model) -> the ranked measures that do not move with a better one.

    Correlations of all facts' rows, each inside its model's window, come from one plan; pairs of
    column names above the threshold come to the driver.
    """
    asked = {(f.dataset, m): f for f in facts if f.date for m in thresholds
             if m in f.models and f.measures}
    kept = {key: list(f.measures) for key, f in asked.items()}
    several = {key: f for key, f in asked.items() if len(f.measures) > 1}
    if not several:
        return kept
    width = max(len(f.measures) for f in several.values())
    parts = []
    for f in {f.dataset: f for f in several.values()}.values():
        t, models = f.table(), [m for n, m in several if n == f.dataset]
        inside = F.array_compact(F.array(*[
            F.when(t.within(G.limits_for(m)["window_years"]), F.lit(m)) for m in models]))
        parts.append(f.df.select(
            F.lit(f.dataset).alias("dataset"), F.explode(inside).alias("model"),
            *[(t.number(f.measures[i]) if i < len(f.measures) else F.lit(None).cast("double"))
              .alias(f"x{i}") for i in range(width)]))
    pairs = column_correlations(reduce(DataFrame.union, parts), ["dataset", "model"],
                                [f"x{i}" for i in range(width)])
    limit = F.create_map(*[F.lit(x) for item in thresholds.items() for x in item])
    near = {(r["dataset"], r["model"], int(r["left_name"][1:]), int(r["right_name"][1:]))
            for r in pairs.where(F.abs("r") > limit[F.col("model")]).collect()}
    for (dataset, model), f in several.items():
        chosen: list[int] = []
        for i in range(len(f.measures)):
            if not any((dataset, model, k, i) in near for k in chosen):
                chosen.append(i)
        kept[dataset, model] = [f.measures[i] for i in chosen]
    return kept


def change_series(known: Facts, facts: list[Fact]) -> DataFrame:
    """Long series (dataset, measure, date, value, log_value, hazard) of facts' measures."""
    spark = known.calendar.sparkSession
    kept = kept_measures(facts, {"BOCPD": 0.85})
    rows = [(f.dataset, f.date, f.measures.index(c), c)
            for f in facts for c in kept.get((f.dataset, "BOCPD"), [])]
    series = inline_rows(spark, {"dataset": "string", "date_column": "string", "place": "int",
                                 "measure": "string"}, rows)
    shapes = known.profiles.select("dataset", "name", "skewness", "date_grain")
    # A row per column of the facts.
    series = series.join(shapes.select("dataset", F.col("name").alias("measure"), "skewness"),
                         ["dataset", "measure"]).join(
        shapes.select("dataset", F.col("name").alias("date_column"), "date_grain"),
        ["dataset", "date_column"])
    width = sum(c.startswith("v") for c in known.calendar.columns)
    values = F.array(*[F.col(f"v{i}").cast("double") for i in range(width)])
    rolled = G.windowed(known.calendar, G.limits_for("BOCPD")["window_years"])
    return rolled.select("dataset", "date", values.alias("values")).join(
        F.broadcast(series), "dataset").withColumn("value", F.get("values", F.col("place"))).select(
        "dataset", "measure", "date", "value",
        C.transformed_level(F.col("value"), F.col("skewness")).alias("log_value"),
        F.when(F.coalesce(F.col("skewness") > 1.5, F.lit(False)), "log1p")
        .otherwise("log").alias("target_transform"),
        hazard_of(F.col("date_grain")).alias("hazard"))


@dataclass
class ChangeRun:
    series: DataFrame
    probs: DataFrame
    candidates: DataFrame
    context: DataFrame
    priors: DataFrame


SERIES = ["dataset", "measure"]


def run_change_points(known: Facts, facts: list[Fact]) -> ChangeRun | None:
    """One job over every measure of every fact that passed its gate."""
    facts = [f for f in facts if f.measures]
    if not facts:
        return None
    return change_run(stage(change_series(known, facts)))


def change_run(series: DataFrame) -> ChangeRun:
    """Change-points of stored long series as `change_series` gives them."""
    probs = C.change_probabilities(
        series.select(*SERIES, "date", "log_value", "hazard"), SERIES, "date", "log_value",
        hazard="hazard")
    probs = stage(probs.join(series.select(*SERIES, "date", "value"), [*SERIES, "date"]))
    candidates = C.change_candidates(probs, SERIES)
    priors = C.series_priors(series, SERIES, "date", "log_value").join(
        series.groupBy(*SERIES).agg(F.first("hazard").alias("hazard"),
                                    F.first("target_transform").alias("target_transform")),
        SERIES)
    return ChangeRun(series, probs, candidates,
                     C.context_windows(probs, candidates, SERIES), priors)


@dataclass
class MixRun:
    """Attribution of every kept measure of every fact; ``features`` in each fact's own order."""

    features: dict[str, list[str]]
    meta: DataFrame
    contribs: DataFrame
    fitted: DataFrame
    betas: DataFrame
    errors: DataFrame


@dataclass
class Slots:
    """Columns that the facts' channels share: the i-th channel of a kind is one column for all."""

    config: K.SeriesConfig
    taken: dict[str, list[tuple[str, str]]]  # dataset -> (slot, channel) in the fact's order

    def names(self, spark: SparkSession, ending: str = "") -> DataFrame:
        """(dataset, slot, name) of the taken slots."""
        return inline_rows(spark, {"dataset": "string", "slot": "string", "name": "string"}, [
            (n, slot + ending, channel + ending)
            for n, pairs in self.taken.items() for slot, channel in pairs])


def mix_slots(metadata: Metadata, facts: list[Fact]) -> Slots:
    """Channels of all facts grouped by their names; one row per channel column."""
    rows = channel_groups_by_name(metadata.specs.where(
        F.col("dataset").isin(*[f.dataset for f in facts]))).orderBy("dataset", "ordinal").collect()
    taken: dict[str, list[tuple[str, str]]] = {}
    channels: dict[str, K.Channel] = {}
    for f in facts:
        seen: dict[str, int] = {}
        for r in rows:
            if r["dataset"] == f.dataset and f.subtypes.get(r["channel"]) == "channel":
                group = r["channel_group"]
                slot = f"{group}_{seen.get(group, 0)}"
                seen[group] = seen.get(group, 0) + 1
                # How a channel is rolled up and carried over follows from its kind.
                channels[slot] = K.Channel(slot, group, r["agg"], r["decay"])
                taken.setdefault(f.dataset, []).append((slot, r["channel"]))
    order = sorted(channels, key=lambda c: (c.rsplit("_", 1)[0], int(c.rsplit("_", 1)[1])))
    return Slots(K.SeriesConfig(target="target", week="date",
                                channels=tuple(channels[c] for c in order)), taken)


def mix_series(facts: list[Fact], slots: Slots, targets: dict[str, list[str]]) -> DataFrame:
    """One row per dataset, target and period: channels rolled up once, targets stacked."""
    config, nothing = slots.config, F.lit(None).cast("double")
    width = max(len(targets[f.dataset]) for f in facts)
    parts, measures = [], []
    for f in facts:
        held = {slot: F.col(f"`{c}`").cast("double") for slot, c in slots.taken[f.dataset]}
        own = targets[f.dataset]
        measures += [(f.dataset, i, c) for i, c in enumerate(own)]
        inside = f.table().within(G.limits_for("MMM")["window_years"])
        parts.append(f.df.where(inside & F.col(f"`{f.date}`").isNotNull()).select(
            F.lit(f.dataset).alias("dataset"), F.col(f"`{f.date}`").cast("date").alias("date"),
            *[held.get(c.name, nothing).alias(c.name) for c in config.channels],
            *[(F.col(f"`{own[i]}`").cast("double") if i < len(own) else nothing).alias(f"target{i}")
              for i in range(width)]))
    rolled = reduce(DataFrame.union, parts).groupBy("dataset", "date").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in config.rolled_by("sum")],
        *[F.avg(c).alias(c) for c in config.rolled_by("mean")],
        F.array(*[F.coalesce(F.sum(f"target{i}"), F.lit(0.0)) for i in range(width)]).alias("targets"))
    # A row per modelled measure.
    listed = inline_rows(facts[0].df.sparkSession, {
        "dataset": "string", "place": "int", "measure": "string"}, measures)
    return rolled.join(F.broadcast(listed), "dataset").select(
        "dataset", "measure", "date", *[c.name for c in config.channels],
        F.get("targets", F.col("place")).alias("target"))


def run_mixes(metadata: Metadata, facts: list[Fact], targets: dict[str, list[str]]) -> MixRun | None:
    """Attribution of every kept measure of all facts as one set of jobs.

    Slots that a fact has no channel for are zero throughout, have a coefficient of zero, and do
    not show in the results.
    """
    slots = mix_slots(metadata, [f for f in facts if targets.get(f.dataset)])
    facts = [f for f in facts if targets.get(f.dataset) and slots.taken.get(f.dataset)]
    if not facts:
        return None
    spark, config = facts[0].df.sparkSession, slots.config
    featured = market_features(mix_series(facts, slots, targets), config, SERIES)
    transformed = A.transform_channels(featured, config, SERIES)
    matrix = stage(A.model_matrix(transformed, config, SERIES))
    fitted_betas = stage(A.map_fit(matrix, config, SERIES))
    features = [c[2:] for c in matrix.columns if c.startswith("X_")]
    kinds = A.feature_kinds(features, config)
    common = [c for c in features if kinds[c] == "control"]
    carried = {c.name for c in config.channels if f"{c.name}_sat" in features}
    own = {f.dataset: [
        *[(f"{s}_sat", f"{c}_sat") for s, c in slots.taken[f.dataset] if s in carried],
        *[(s, c) for s, c in slots.taken[f.dataset] if s in features],
        *[(c, c) for c in common]] for f in facts}
    names = inline_rows(spark, {"dataset": "string", "feature": "string", "name": "string"}, [
        (n, slot, c) for n, pairs in own.items() for slot, c in pairs])

    def renamed(df: DataFrame) -> DataFrame:
        out = df.join(F.broadcast(names), ["dataset", "feature"])  # a row per fact and feature
        return out.withColumn("feature", F.col("name")).select(*df.columns)

    contribs = renamed(A.contributions(matrix, fitted_betas, SERIES))
    fitted = A.fitted_values(contribs, SERIES)
    meta = A.channel_meta(transformed, config, SERIES)
    channels = slots.names(spark).select("dataset", F.col("slot").alias("channel"), "name")
    meta = meta.join(F.broadcast(channels), ["dataset", "channel"]).withColumn(
        "channel", F.col("name")).select(*meta.columns)
    return MixRun({n: [c for _, c in pairs] for n, pairs in own.items()}, meta, contribs, fitted,
                  renamed(fitted_betas), A.mape(fitted, SERIES))


@dataclass
class Run:
    """Every table of a finished run."""

    metadata: Metadata
    known: Facts
    checks: DataFrame
    decisions: DataFrame
    windows: DataFrame
    changes: ChangeRun | None
    mix: MixRun | None
    errors: DataFrame


def run_insights(spark: SparkSession, datasets: dict[str, DataFrame],
                 datamarts: DataFrame | None = None, models: list[str] | None = None,
                 limits: dict | None = None, names: list[str] | None = None,
                 suppress_duplicates: bool = False) -> Run:
    """Describe, route, gate, then run the models whose gate did not fail.

    With ``models`` only those are gated and run; datasets without one of them have no rows. With
    ``names`` only those datasets are described; an unknown name is an error. Facts that carry the
    same signal as a wider one are marked in ``metadata.duplicates`` and, if they are to be
    suppressed, take no further part.
    """
    if names is not None:
        unknown = [n for n in names if n not in datasets]
        if unknown:
            raise ValueError(f"unknown datasets: {', '.join(unknown)}")
        datasets = {n: datasets[n] for n in names}
    metadata = describe(spark, datasets, datamarts)
    errors = Errors()
    suppressed = set()
    if suppress_duplicates:
        marked = metadata.duplicates.where("is_duplicate_signal")
        suppressed = {r["dataset"] for r in marked.select("dataset").collect()}
    known = routed_facts(metadata, {n: df for n, df in datasets.items() if n not in suppressed},
                         models, errors)
    by_name = {f.dataset: f for f in known.facts}
    routed = {n: f.models for n, f in by_name.items()}

    def subset(names):
        return Facts([by_name[n] for n in names], known.profiles, known.calendar)

    checks = errors.together(routed, lambda names: stage(gate(spark, subset(names), limits)))
    if checks is None:
        checks = inline_rows(spark, G.CHECK_SHAPE, [])
    decisions = stage(G.model_decisions(checks))
    passed = {(r["dataset"], r["model"]) for r in decisions.where("decision <> 'FAIL'").collect()}
    mixed = [n for n in by_name if (n, "MMM") in passed]
    targets = errors.together(
        {n: ["MMM"] for n in mixed},
        lambda names: kept_measures([by_name[n] for n in names], {"MMM": 0.90})) or {}
    chosen = {n: targets[n, "MMM"] for n in mixed if targets.get((n, "MMM"))}
    mix = errors.together({n: ["MMM"] for n in chosen}, lambda names: run_mixes(
        metadata, [by_name[n] for n in names], chosen))
    watched = {n: ["BOCPD"] for n in by_name if (n, "BOCPD") in passed and by_name[n].measures}
    changes = errors.together(
        watched, lambda names: run_change_points(known, [by_name[n] for n in names]))
    return Run(metadata, known, checks, decisions, windows(spark, known), changes, mix,
               errors.rows(spark))


def measure_rows(run: Run) -> DataFrame:
    """(dataset, model, measure) for everything that was modelled."""
    parts = []
    if run.changes is not None:
        parts.append(run.changes.priors.select(
            "dataset", F.lit("BOCPD").alias("model"), "measure"))
    if run.mix is not None:
        parts.append(run.mix.betas.select("dataset", F.lit("MMM").alias("model"), "measure").distinct())
    if not parts:
        spark = run.checks.sparkSession
        return inline_rows(spark, {"dataset": "string", "model": "string",
                                   "measure": "string"}, [])
    return union(parts)


def measure_model_map(run: Run) -> DataFrame:
    """Models that ran on each measure; measures without a model have an empty list."""
    known = run.metadata.specs.where("subtype = 'measure'").select(
        "dataset", F.col("name").alias("measure"))
    ran = measure_rows(run).groupBy("dataset", "measure").agg(
        F.array_sort(F.collect_set("model")).alias("models"))
    return known.join(ran, ["dataset", "measure"], "full").select(
        "dataset", "measure", F.coalesce("models", F.array().cast("array<string>"))
        .alias("models"))


def model_outcomes(run: Run) -> DataFrame:
    """Per dataset and model: decision, window, and whether and why not it ran."""
    ran = measure_rows(run).select("dataset", "model", F.lit(True).alias("has_rows")).distinct()
    failed = run.errors.groupBy("dataset", "model").agg(F.min("error").alias("error"))
    joined = run.decisions.join(run.windows, ["dataset", "model"], "left").join(
        ran, ["dataset", "model"], "left").join(failed, ["dataset", "model"], "full")
    known = F.col("model").isin(*RUNNERS)
    return joined.withColumn("ran", F.coalesce("has_rows", F.lit(False))).withColumn(
        "reason", F.when(F.col("ran"), None)
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("decision") == "FAIL", F.coalesce("skip_reason", F.lit("quality gate FAIL")))
        .when(~known, F.concat(F.lit("no runner for model '"), F.col("model"), F.lit("'")))
        .otherwise("no viable measure or channel columns")).drop("has_rows", "error")


def candidate_list(run: Run) -> DataFrame:
    """Models that had a date window, with what became of them."""
    return model_outcomes(run).where("cutoff_date IS NOT NULL").select(
        "dataset", "model", F.concat(
            F.col("years").cast("string"), F.lit("yr  "), F.col("cutoff_date").cast("string"),
            F.lit(" → "), F.col("max_date").cast("string")).alias("label"),
        F.col("n_rows").alias("rows"), "ran", F.col("decision").alias("quality"))
