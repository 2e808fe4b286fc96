"""Every registered query: a function of (spark, folder) that returns a DataFrame.

All of them read the whole tables of the folder. Where a later stage is checked on its own, its
change-points or coefficients are given, so that the check does not hang on an earlier stage.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import knowledge as K
from tidemark.functions import curves as CV
from tidemark.functions import dates as D
from tidemark.functions.numbers import distinct_counts, long_values
from tidemark.operators import attribution as A
from tidemark.operators import changepoint as C
from tidemark.operators import drift
from tidemark.operators import features as X
from tidemark.operators import gate as G
from tidemark.operators import integration as I
from tidemark.operators import lags as LG
from tidemark.operators import meaning as M
from tidemark.operators import online as ON
from tidemark.operators import payload as P
from tidemark.operators import posterior as PO
from tidemark.operators import preparation as PR
from tidemark.operators import profile_states as PS
from tidemark.operators import profiling as PF
from tidemark.operators import rollup as R
from tidemark.operators import routing as RT
from tidemark.operators import selection as S
from tidemark.operators import transforms as T
from tidemark.operators import validation as V
from tidemark.plans import insights, report
from tidemark.plans.gold import (
    CONFIG, ENGAGEMENT_SUBTYPES, EVENT_SUBTYPES, dim_hcp, gold_engagement,
    gold_engagement_step, gold_events, table, tables)
from tidemark.session import inline_rows, stage, stage_folder, stored_table, write_text
from tidemark.sources.catalog import column_catalog, text_stats
from tidemark.sources.datamart_spec import parse_spec
from tidemark.sources.settings import channel_rows

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# --- given values -----------------------------------------------------------------------

GIVEN_CHANGES = ["1996-01-01", "1997-03-03", "1999-01-04", "2000-06-05", "2001-06-04"]
GIVEN_BETAS = {
    "f2f_sat": 0.08, "samples_sat": 0.06, "email_opens_sat": 0.04, "speaker_sat": 0.05,
    "phone_call_sat": 0.03, "tv_grps_sat": 0.10, "competitor_spend": -0.02, "lc_num": 0.12,
    "week_idx": -0.05, "sin_1": 0.01, "cos_1": 0.02, "sin_2": -0.01, "cos_2": 0.005,
}
GIVEN_INTERCEPT = 14.5
INCIDENTS = [("INC-001", "1997-03-03", "1997-03-24"), ("INC-002", "1999-01-04", "1999-01-25"),
             ("INC-003", "2000-06-05", "2000-06-26")]
TRUE_EFFECTS = {"f2f": 0.5, "samples": 0.4, "email_opens": 0.3, "speaker": 0.35,
                "phone_call": 0.2, "tv_grps": 0.6}

# A small catalog of known datamarts: name, category, description, columns.
DATAMARTS = [
    ("engagement_fact", "Engagement", "Weekly engagement per provider",
     ["week", "hcp_id", "product", "sales", "trx", "f2f", "samples", "speaker", "phone_call"]),
    ("provider_dim", "Reference", "Providers and where they work",
     ["hcp_id", "segment", "country_name", "specialty"]),
    ("order_line_summary", "Orders", "",
     ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
      "l_discount", "l_tax", "l_returnflag", "l_linestatus"]),
    ("activity_log", "Engagement", "Daily activity", ["activity_date", "user_id", "channel"]),
]

EVENT_METRICS = ["amount"]
FACT_METRICS = ["sales", "trx", "competitor_spend"]


def datamart_rows(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, {"name": "string", "category": "string", "description": "string",
                               "columns": "array<string>"}, DATAMARTS)


def gold_catalog(spark, d) -> dict[str, DataFrame]:
    """The given tables, the tables built from them, and a narrower copy of the events."""
    return {
        **tables(spark, d),
        "gold_engagement": gold_engagement(spark, d),
        "gold_events": gold_events(spark, d),
        "gold_daily": gold_events(spark, d).select(
            "activity_date", F.col("user_id").alias("member_id"), "event_type", "amount",
            F.col("amount").alias("points")),
        "dim_hcp": dim_hcp(spark, d),
        "dim_hcp_sk": dim_hcp(spark, d, "user_sk"),
    }


def dull_orders(spark, d) -> DataFrame:
    """Orders with a constant measure, a mostly empty one and a text date: fails its checks."""
    return table(spark, d, "orders").select(
        F.to_date("o_orderdate").alias("activity_date"),
        F.lit(5.0).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("revenue"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("segment"),
        F.col("o_totalprice").alias("f2f"))


DULL_SUBTYPES = {"activity_date": "date", "amount": "measure", "revenue": "measure",
                 "segment": "segment", "f2f": "channel"}


def market(spark, d, step: bool = False, by_product: bool = False) -> DataFrame:
    """Weekly series of the engagement fact."""
    fact = gold_engagement_step(spark, d) if step else gold_engagement(spark, d)
    return R.market_rollup(fact, CONFIG, by_product)


def matrix(spark, d, step: bool = True) -> DataFrame:
    featured = X.market_features(market(spark, d, step), CONFIG).withColumn(
        "series", F.lit("market"))
    return A.model_matrix(A.transform_channels(featured, CONFIG, ["series"]), CONFIG, ["series"])


def given_betas(spark) -> DataFrame:
    kinds = X_KINDS
    return inline_rows(spark, {"series": "string", "feature": "string", "kind": "string",
                               "beta": "double", "intercept": "double"},
                       [("market", f, kinds[f], b, GIVEN_INTERCEPT)
                        for f, b in GIVEN_BETAS.items()])


X_KINDS = A.feature_kinds(list(GIVEN_BETAS), CONFIG)


def given_contributions(spark, d) -> DataFrame:
    return A.contributions(matrix(spark, d), given_betas(spark), ["series"])


def given_changes(spark) -> DataFrame:
    return inline_rows(spark, {"series": "string", "cp_week": "string"},
                       [("market", w) for w in GIVEN_CHANGES]).withColumn(
        "cp_week", F.to_date("cp_week"))


def incidents(spark) -> DataFrame:
    return inline_rows(spark, {"incident_id": "string", "week_start": "string",
                               "week_end": "string"}, INCIDENTS).withColumns({
        "week_start": F.to_date("week_start"), "week_end": F.to_date("week_end")})


def product_probs(spark, d) -> DataFrame:
    series = market(spark, d, step=True, by_product=True).select(
        "product", "week", "sales", X.log_level(F.col("sales")).alias("log_sales"))
    probs = C.change_probabilities(series, ["product"], "week", "log_sales")
    return probs.join(series.select("product", "week", "sales"), ["product", "week"])


# --- roll-ups and features --------------------------------------------------------------

@query
def market_rollup(spark, d):
    """One row per week and product."""
    out = market(spark, d, by_product=True)
    return rounded(out, sales=2, trx=2, f2f=2, samples=2, email_opens=2, speaker=2,
                   phone_call=2, tv_grps=3, competitor_spend=6)


@query
def product_rollup(spark, d):
    """Weekly series of one product only."""
    config = replace(CONFIG, product_value="PROMO")
    out = R.market_rollup(gold_engagement(spark, d), config, all_products=False)
    return rounded(out.select("week", "product", "sales", "f2f", "tv_grps"),
                   sales=2, f2f=2, tv_grps=3)


def texted_events(spark, d) -> DataFrame:
    """The activity fact with its date as a text of one of five kinds, one of them unreadable."""
    day = F.col("activity_date")
    quarter = F.concat(F.lit("Q"), F.quarter(day))
    kind = F.col("user_id") % 5
    return gold_events(spark, d).withColumn("activity_date", F.when(
        kind == 0, F.concat_ws(" ", F.year(day), quarter))
        .when(kind == 1, F.concat_ws("/", quarter, F.year(day)))
        .when(kind == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 3, F.year(day).cast("string")).otherwise("n/a"))


@query
def text_dates_run(spark, d):
    """Calendar of a fact whose dates are texts, with the rows whose date cannot be read."""
    raw = texted_events(spark, d)
    calendar = R.calendar_rollup(D.with_dates(raw, ["activity_date"]), "activity_date", ["amount"])
    unread = D.unparsed_dates(raw, ["activity_date"]).select("n_unparsed").scalar()
    return rounded(calendar, amount=2).withColumn("n_unparsed", unread)


@query
def text_dates_outcomes(spark, d):
    """The whole run on a fact with text dates, for one model: what became of each dataset."""
    run = insights.run_insights(spark, {"gold_events": texted_events(spark, d),
                                        "dim_hcp": dim_hcp(spark, d)}, models=["BOCPD"])
    return insights.model_outcomes(run).select("dataset", "model", "ran")


@query
def clean_row_stats(spark, d):
    return R.clean_row_stats(gold_engagement(spark, d), CONFIG)


@query
def market_features(spark, d):
    out = X.market_features(market(spark, d), CONFIG)
    return rounded(out.select("week", "week_idx", "log_sales", "lc_num", "tv_grps_log",
                              "split"), log_sales=6, tv_grps_log=6)


@query
def fourier_terms(spark, d):
    out = X.market_features(market(spark, d), CONFIG)
    return rounded(out.select("week", "sin_1", "cos_1", "sin_2", "cos_2"),
                   sin_1=6, cos_1=6, sin_2=6, cos_2=6)


@query
def train_split(spark, d):
    out = X.market_features(market(spark, d), CONFIG)
    return out.groupBy("split").agg(F.count("*").alias("n"), F.min("week").alias("first_week"),
                                    F.max("week").alias("last_week"))


@query
def organic_flags(spark, d):
    config = replace(CONFIG, organic_cps=(("launch", "1997-01-06"), ("shift", "1999-01-04")))
    return X.market_features(market(spark, d), config).select(
        "week", "flag_launch", "flag_shift")


@query
def segment_rollup(spark, d):
    """Daily activity through event type and user."""
    out = R.segment_rollup(
        gold_events(spark, d).withColumn("amount_share", F.col("amount") / 100),
        "activity_date", ["amount", "amount_share"], ["event_type", "user_id"])
    return rounded(out, amount=2, amount_share=6)


@query
def date_rollup(spark, d):
    return rounded(R.date_rollup(gold_engagement(spark, d), "week", ["sales", "trx"]),
                   sales=2)


@query
def weekly_sat(spark, d):
    return rounded(R.saturday_weeks(gold_events(spark, d), "activity_date", ["amount"]),
                   amount=2)


@query
def monthly_grain(spark, d):
    out = R.monthly_grain(market(spark, d), "week", ["sales", "trx", "f2f"])
    return rounded(out, sales=2, trx=2, f2f=2)


def gappy_weeks(spark, d) -> DataFrame:
    """The largest order per customer and week: most weeks of a customer have none."""
    return table(spark, d, "orders").groupBy(
        "o_custkey", D.week_start(F.col("o_orderdate")).alias("week")).agg(
        F.max("o_totalprice").alias("largest"))


@query
def spine_ffill(spark, d):
    """Every customer's latest weekly maximum, carried over weeks without orders, by week."""
    full = R.spine_filled(gappy_weeks(spark, d), "week", ["o_custkey"], ["largest"])
    return full.groupBy("week").agg(
        F.count("*").alias("n_customers"), F.count("largest").alias("n_known"),
        F.sum(F.round(F.col("largest") * 100).cast("long")).alias("carried_cents"))


# --- profiles ----------------------------------------------------------------------------

PROFILE_COLUMNS = ["name", "null_pct", "unique_count", "skewness", "kurtosis", "value_max",
                   "mean", "median", "std", "outlier_rate", "date_grain"]
PROFILE_DIGITS = dict(null_pct=6, skewness=4, kurtosis=4, value_max=4, mean=4, median=4, std=4,
                      outlier_rate=6)


@query
def column_profile(spark, d):
    fact = stored_table(gold_engagement(spark, d))
    out = PF.column_profile(fact, ENGAGEMENT_SUBTYPES, "gold_engagement")
    return rounded(out.select(*PROFILE_COLUMNS), **PROFILE_DIGITS)


LINE_SUBTYPES = {"l_quantity": "measure", "l_extendedprice": "unclassified_metric",
                 "l_discount": "unclassified_metric", "l_tax": "unclassified_metric",
                 "l_shipdate": "date"}


@query
def lineitem_profile(spark, d):
    out = PF.column_profile(table(spark, d, "lineitem"), LINE_SUBTYPES, "lineitem")
    return rounded(out.select(*PROFILE_COLUMNS), **PROFILE_DIGITS)


@query
def distinct_values(spark, d):
    lines = table(spark, d, "lineitem")
    return distinct_counts(lines, lines.columns)


@query
def outlier_rate(spark, d):
    out = PF.outlier_rates(table(spark, d, "lineitem"),
                           ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(out, q1=4, median=4, q3=4, outlier_rate=6)


@query
def date_grain(spark, d):
    parts = [
        D.median_gaps(table(spark, d, "events"), ["ts"]),
        D.median_gaps(table(spark, d, "orders"), ["o_orderdate"]),
        D.median_gaps(table(spark, d, "lineitem"), ["l_shipdate"]),
        D.median_gaps(gold_engagement(spark, d), ["week"]),
        D.median_gaps(table(spark, d, "orders").select(
            F.trunc("o_orderdate", "MM").alias("month"),
            F.trunc("o_orderdate", "quarter").alias("quarter"),
            F.trunc("o_orderdate", "year").alias("year")), ["month", "quarter", "year"]),
    ]
    return insights.union(parts)


@query
def numeric_promotion(spark, d):
    """Orders kept as texts: clean numbers, numbers with some junk, with more, with nulls."""
    total = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    texts = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("clean"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), "n/a")
        .otherwise(total).alias("some_junk"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "12d").otherwise(total)
        .alias("more_junk"),
        F.when(F.col("o_orderstatus") != "P", total).alias("with_nulls"),
        "o_orderpriority")
    stats = text_stats({"orders_as_text": texts})
    return stats.select("name", "n_rows", "n_null", F.round("numeric_share", 6)
                        .alias("numeric_share"),
                        ((F.col("n_null") == 0) & (F.col("numeric_share") >= 0.9))
                        .alias("promoted"))


def _suggestions(spark, d) -> DataFrame:
    sparse = table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("ship_date"),
        F.when(F.col("l_returnflag") != "R", F.exp(F.col("l_quantity") / 10)).alias("amount"),
        F.pow(F.col("l_quantity") / 10, 6).alias("total_volume"),
        (F.col("l_discount") * 20).alias("market_share"),
        F.col("l_orderkey").cast("string").alias("category"))
    subtypes = {"ship_date": "date", "amount": "measure", "total_volume": "measure",
                "market_share": "measure", "category": "segment"}
    return insights.union([
        PF.column_profile(sparse, subtypes, "sparse_lines"),
        PF.column_profile(gold_events(spark, d), EVENT_SUBTYPES, "gold_events"),
    ])


@query
def suggested_transforms(spark, d):
    return _suggestions(spark, d).select(
        "dataset", "name", F.array_join("suggested_transforms", " | ").alias("suggestions"))


# --- metadata ----------------------------------------------------------------------------

def _described(spark, d, with_datamarts: bool = False):
    return insights.describe(spark, gold_catalog(spark, d),
                             datamart_rows(spark) if with_datamarts else None)


@query
def column_subtypes(spark, d):
    return _described(spark, d).specs.select(
        "dataset", "ordinal", "name", "dtype_family", "subtype", "confidence", "match_source",
        "expanded_name")


@query
def abbreviated_subtypes(spark, d):
    """Columns of the event and order tables under shortened names."""
    frames = {
        "events_short": table(spark, d, "events").select(
            F.col("ts").alias("SVC_DT"), F.col("user_id").alias("npi_vod"),
            F.col("event_type").alias("G1 Meeting-Type"), F.col("value").alias("rx"),
            F.col("props").alias("pt_note")),
        "orders_short": table(spark, d, "orders").select(
            F.col("o_orderdate").alias("wk_end"), F.col("o_totalprice").alias("spend_last_90d"),
            F.col("o_orderkey").alias("week_idx"), F.col("o_orderpriority").alias("terr"),
            F.col("o_orderstatus").alias("first_name"), F.col("o_custkey").alias("call_rate"),
            F.col("o_orderdate").alias("order_num")),
    }
    specs = M.column_subtypes(column_catalog(spark, frames),
                              hints={"spend_last_90d": "spend of the last quarter"})
    return specs.select("dataset", "name", "subtype", "confidence", "match_source",
                        "expanded_name", "business_hint")


@query
def table_classes(spark, d):
    out = _described(spark, d, True).classes
    return rounded(out, match_score=6)


@query
def datamart_jaccard(spark, d):
    out = M.datamart_overlap(_described(spark, d).specs, datamart_rows(spark))
    return rounded(out, score=6)


@query
def star_keys(spark, d):
    return _described(spark, d).keys


@query
def model_routes(spark, d):
    return _described(spark, d).routes.select(
        "dataset", "model", "confidence", "route_rank",
        F.array_join("dimension_tables", ",").alias("dimension_tables"),
        F.array_join("flagged_unclassified", ",").alias("flagged_unclassified"))


@query
def route_use_cases(spark, d):
    return _described(spark, d, True).routes.select(
        "dataset", "model", F.array_join("use_cases", " | ").alias("use_cases"))


@query
def duplicate_signal(spark, d):
    return _described(spark, d).duplicates.select(
        "dataset", "top_model", F.array_join("signature", ",").alias("signature"),
        "is_duplicate_signal", "signal_group_primary")


@query
def use_cases(spark, d):
    return RT.model_use_cases(_described(spark, d).specs)


@query
def display_columns(spark, d):
    return P.display_columns(_described(spark, d).specs)


@query
def fact_dim_join(spark, d):
    joined = RT.join_dimension(gold_engagement(spark, d), dim_hcp(spark, d),
                               {"hcp_id": "hcp_id"})
    return joined.groupBy("country_name", "is_active").agg(
        F.count("*").alias("n"), F.round(F.sum("sales"), 2).alias("sales"))


# --- selection ---------------------------------------------------------------------------

def _dated_lines(spark, d) -> DataFrame:
    """Lines with their order date: two date columns and no known measure but one."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_totalprice")
    return table(spark, d, "lineitem").join(orders, "l_orderkey").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("ship_date"),
        "o_orderdate", "l_extendedprice", "l_discount", "l_tax", "l_linenumber",
        F.col("o_totalprice"))


def _selection_inputs(spark, d):
    frames = {"dated_lines": stored_table(_dated_lines(spark, d)),
              "gold_engagement": stored_table(gold_engagement(spark, d))}
    specs = M.column_subtypes(column_catalog(spark, frames))
    lines = {"ship_date": "date", "o_orderdate": "date", "l_extendedprice": "unclassified_metric",
             "l_discount": "unclassified_metric", "l_tax": "unclassified_metric",
             "l_linenumber": "unclassified_metric", "o_totalprice": "unclassified_metric"}
    profiles = insights.union([
        PF.column_profile(frames["dated_lines"], lines, "dated_lines"),
        PF.column_profile(frames["gold_engagement"], ENGAGEMENT_SUBTYPES, "gold_engagement")])
    return specs, profiles


@query
def best_date(spark, d):
    return rounded(S.best_date(*_selection_inputs(spark, d)), score=4)


@query
def ranked_measures(spark, d):
    out = S.ranked_measures(*_selection_inputs(spark, d))
    known = F.col("score") == float("inf")
    return out.select("dataset", "name", "measure_rank",
                      F.when(~known, F.round("score", 3)).alias("score"))


@query
def best_measure(spark, d):
    return S.best_measure(*_selection_inputs(spark, d)).select(
        "dataset", "measure", "subtype", "needs_review")


@query
def dead_columns(spark, d):
    """Meanings after columns without any value are set aside."""
    frame = table(spark, d, "orders").select(
        F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("sales"),
        F.when(F.col("o_totalprice") < 0, F.col("o_totalprice")).alias("revenue"),
        F.when(F.col("o_totalprice") < 0, F.col("o_orderkey")).alias("claim_id"))
    specs = M.column_subtypes(column_catalog(spark, {"orders_dead": frame}))
    shapes = PF.column_shapes(frame, []).select(F.lit("orders_dead").alias("dataset"), "*")
    return M.scrub_dead_columns(specs, shapes).select("name", "subtype", "confidence")


@query
def pair_correlations(spark, d):
    out = S.pair_correlations(gold_engagement(spark, d), [
        "sales", "trx", "competitor_spend", "f2f", "samples", "tv_grps", "is_anomaly"])
    return rounded(out, r=6)


@query
def dedup_measures(spark, d):
    return S.dedup_measures(gold_engagement(spark, d), [
        "sales", "trx", "competitor_spend", "f2f", "samples"], 0.5)


@query
def candidate_window(spark, d):
    calendar = R.calendar_rollup(gold_engagement(spark, d), "week", [])
    return S.candidate_windows(calendar, {
        m: lim["window_years"] for m, lim in K.MODEL_LIMITS.items()})


@query
def recent_sales(spark, d):
    """Sales by product in the last year of the fact."""
    return S.recent_window(gold_engagement(spark, d), "week", 1).groupBy("product").agg(
        F.count("*").alias("n"), F.round(F.sum("sales"), 2).alias("sales"))


# --- quality gate ------------------------------------------------------------------------

def _gate_inputs(spark, d):
    fact = stored_table(gold_engagement(spark, d))
    events, dull = gold_events(spark, d), dull_orders(spark, d)
    return [("gold_engagement", fact, "week", ENGAGEMENT_SUBTYPES),
            ("gold_events", events, "activity_date", EVENT_SUBTYPES),
            ("dull_orders", dull, "activity_date", DULL_SUBTYPES)]


def _checks(spark, d, only: list[str] | None = None) -> DataFrame:
    """Checks of three facts. ``only`` leaves out the models that do not need the check."""
    models = [m for m, lim in K.MODEL_LIMITS.items()
              if not only or set(only) & set(lim["checks"])]
    limits = {m: {**lim, "checks": [c for c in lim["checks"] if not only or c in only]}
              for m, lim in K.MODEL_LIMITS.items()}
    tables = [G.Table(name, df, date, subtypes, models)
              for name, df, date, subtypes in _gate_inputs(spark, d)]
    profiles = PF.column_profiles({t.name: (t.df, t.subtypes) for t in tables}, spread=False)
    if not only or set(only) & {"fill_rate", "distribution_shape", "date_continuity"}:
        profiles = stage(profiles)
    calendar = stage(R.calendars({t.name: (t.df, t.date, [t.measure]) for t in tables}))
    newest = G.newest_dates(calendar)
    for t in tables:
        t.newest = newest.get(t.name)
    return G.quality_checks(tables, profiles, calendar.withColumnRenamed("v0", "value"), limits)


def _check(name: str):
    def run(spark, d):
        return _checks(spark, d, [name]).select("dataset", "model", "check_name", "status",
                                                "metric")
    return run


for _query, _name in [
    ("gate_fill_rate", "fill_rate"), ("gate_shape", "distribution_shape"),
    ("gate_variance", "zero_variance"), ("gate_continuity", "date_continuity"),
    ("gate_collinearity", "channel_collinearity"), ("gate_balance", "segment_balance"),
    ("gate_autocorr", "autocorrelation"), ("gate_rows", "min_row_count"),
]:
    QUERIES[_query] = _check(_name)


@query
def gate_decision(spark, d):
    return G.model_decisions(_checks(spark, d)).select("dataset", "model", "decision")


@query
def gate_overall(spark, d):
    return G.overall_decisions(G.model_decisions(_checks(spark, d)))


# --- transforms --------------------------------------------------------------------------

@query
def clip_1_99(spark, d):
    out = T.clip_to_quantiles(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"])
    return out.select("l_orderkey", "l_linenumber",
                      F.round("l_extendedprice", 3).alias("l_extendedprice"),
                      F.round("l_quantity", 3).alias("l_quantity"))


@query
def quarter_parse(spark, d):
    """Order dates written five ways, with some that are no dates."""
    day = F.col("o_orderdate")
    year, quarter = F.year(day).cast("string"), F.quarter(day).cast("string")
    written = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(year, F.lit(" Q"), quarter))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(year, F.lit("q"), quarter))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("Q"), quarter, F.lit("/"),
                                                             year))
        .when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), "soon")
        .when(F.col("o_orderstatus") == "F", year)
        .otherwise(F.date_format(day, "yyyy-MM-dd")))
    return table(spark, d, "orders").select(
        "o_orderkey", D.parse_date(written).alias("parsed"))


@query
def apply_transforms(spark, d):
    """Log, clip and median fill of event values that are missing for one event type."""
    events = gold_events(spark, d).withColumns({
        "filled": F.when(F.col("event_type") != "error", F.col("amount")),
        "carried": F.when(F.dayofmonth("activity_date") % 4 != 3, F.col("amount")),
        "clipped": F.col("amount")})
    out = T.apply_transforms(events, {
        "amount": ["log1p", "clip"], "filled": ["median"], "clipped": ["clip"],
        "carried": ["ffill"]}, "activity_date")
    return out.groupBy("activity_date", "event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("amount"), 4).alias("amount"),
        F.round(F.sum("filled"), 3).alias("filled"),
        F.round(F.sum("carried"), 3).alias("carried"),
        F.round(F.sum("clipped"), 3).alias("clipped"))


# --- channels and roles ------------------------------------------------------------------

CHANNELS = [c.name for c in CONFIG.channels]


@query
def channel_groups(spark, d):
    out = X.channel_groups(gold_engagement(spark, d), "week", CHANNELS)
    return rounded(out, cv=4)


@query
def channel_groups_by_name(spark, d):
    specs = M.column_subtypes(column_catalog(
        spark, {"gold_engagement": gold_engagement(spark, d)}))
    return X.channel_groups_by_name(specs).drop("ordinal")


@query
def dataset_roles(spark, d):
    return X.dataset_roles(gold_engagement(spark, d))


@query
def channel_params(spark, d):
    """Channel settings beside what each channel carried in total."""
    totals = gold_engagement(spark, d).agg(*[F.round(F.sum(c), 1).alias(c) for c in CHANNELS])
    rows = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("total"))
                     for c in CHANNELS])
    return totals.select(F.explode(rows).alias("r")).select("r.*").join(
        channel_rows(spark, CONFIG).drop("ordinal"), "channel")


# --- attribution -------------------------------------------------------------------------

@query
def adstock(spark, d):
    out = A.adstocked_channels(market(spark, d), CONFIG, [])
    return out.select("week", *[F.round(f"{c}_ads", 4).alias(f"{c}_ads") for c in
                                ("f2f", "samples", "tv_grps")])


@query
def adstock_decays(spark, d):
    """Carry-over of weekly visits without decay, nearly whole, and whole."""
    decays = {"none": 0.0, "most": 0.99, "whole": 1.0}
    out = CV.adstocked(market(spark, d), {n: (F.col("f2f"), x) for n, x in decays.items()},
                       [], "week")
    return out.select("week", *[F.round(n, 3).alias(n) for n in decays])


@query
def mmm_optimum(spark, d):
    """How far each coefficient is from meeting the condition of an optimum: zero everywhere.

    The slope of the log posterior must vanish; at a bound it may point out of the allowed side.
    """
    m = stage(matrix(spark, d))
    fit = stage(A.map_fit(m, CONFIG, ["series"]))
    rows = A.long_matrix(m, ["series"]).where("split = 'train' AND y IS NOT NULL")
    fitted = rows.join(fit, ["series", "feature"]).groupBy("series", "week").agg(
        F.sum(F.col("beta") * F.col("x")).alias("effect"))
    slopes = rows.join(fitted, ["series", "week"]).join(fit, ["series", "feature"]).groupBy(
        "feature", "kind", "beta", "sigma", "converged").agg(F.sum(
            F.col("x") * (F.col("y") - F.col("intercept") - F.col("effect"))).alias("pull"))
    prior = F.when(F.col("kind") == "competitor", A.COMPETITOR_SIGMA).otherwise(A.CHANNEL_SIGMA)
    slope = F.col("pull") / F.pow("sigma", F.lit(2)) - F.col("beta") / F.pow(prior, F.lit(2))
    off = (F.when((F.col("kind") == "channel") & (F.col("beta") == 0), F.greatest(slope, F.lit(0.0)))
           .when((F.col("kind") == "competitor") & (F.col("beta") == 0),
                 F.least(slope, F.lit(0.0))).otherwise(slope))
    return slopes.select("feature", "converged", (F.round(off, 3) + F.lit(0.0)).alias("off"))


@query
def hill(spark, d):
    featured = market(spark, d).withColumn("series", F.lit("market"))
    out = A.transform_channels(featured, CONFIG, ["series"])
    return out.select("week", *[F.round(f"{c}_sat", 6).alias(f"{c}_sat") for c in
                                ("f2f", "email_opens", "tv_grps")])


@query
def channel_meta(spark, d):
    featured = market(spark, d).withColumn("series", F.lit("market"))
    out = A.channel_meta(A.transform_channels(featured, CONFIG, ["series"]), CONFIG, ["series"])
    return rounded(out.drop("series"), hill_k=4)


@query
def model_matrix(spark, d):
    out = matrix(spark, d)
    return out.select("week", "split", *[F.round(c, 5).alias(c) for c in out.columns
                                         if c.startswith("X_") or c == "y"])


@query
def gram_matrix(spark, d):
    out = A.gram_rows(matrix(spark, d), ["series"])
    return out.select(
        "n", F.round("sum_y", 3).alias("sum_y"), F.round("sum_yy", 3).alias("sum_yy"),
        F.round(F.aggregate("sum_xy", F.lit(0.0), lambda a, x: a + x), 3).alias("sum_xy"),
        F.round(F.aggregate("gram", F.lit(0.0), lambda a, x: a + x), 2).alias("gram"))


@query
def design_collinearity(spark, d):
    out = A.design_collinearity(matrix(spark, d), ["series"], 0.3)
    return rounded(out.drop("series"), r=5)


@query
def mmm_map(spark, d):
    return A.map_fit(matrix(spark, d), CONFIG, ["series"])


def _fit(spark, d):
    m = matrix(spark, d)
    return A.contributions(m, A.map_fit(m, CONFIG, ["series"]), ["series"])


@query
def contributions(spark, d):
    return A.wide_contributions(_fit(spark, d), ["series"], list(GIVEN_BETAS))


@query
def mape(spark, d):
    return A.mape(A.fitted_values(_fit(spark, d), ["series"]), ["series"])


@query
def given_fit(spark, d):
    """Prediction and residual under given coefficients."""
    out = A.fitted_values(given_contributions(spark, d), ["series"])
    return out.select("week", "split", *[F.round(c, 5).alias(c) for c in
                                         ("y_actual", "y_predicted", "residual", "residual_z")])


@query
def given_mape(spark, d):
    out = A.mape(A.fitted_values(given_contributions(spark, d), ["series"]), ["series"])
    return rounded(out.drop("series"), mape=4)


# --- change-points -----------------------------------------------------------------------

@query
def series_priors(spark, d):
    series = market(spark, d, step=True, by_product=True).withColumn(
        "log_sales", X.log_level(F.col("sales")))
    out = C.series_priors(series, ["product"], "week", "log_sales")
    return rounded(out, mu_0=6, beta_0=6)


@query
def bocpd_probs(spark, d):
    return product_probs(spark, d).select(
        "product", "week", "t", F.round("log_sales", 6).alias("log_sales"),
        F.round("cp_prob", 6).alias("cp_prob"),
        F.round("exp_run_length", 4).alias("exp_run_length"))


@query
def cp_candidates(spark, d):
    out = C.change_candidates(product_probs(spark, d), ["product"])
    return out.select("product", "week", "t", F.round("cp_prob", 6).alias("cp_prob"),
                      F.round("exp_run_length", 4).alias("exp_run_length"))


@query
def change_payload(spark, d):
    """The report's change-point part per product, read back: candidates by probability."""
    series = stage(market(spark, d, step=True, by_product=True).select(
        F.lit("gold_engagement").alias("dataset"), F.col("product").alias("measure"),
        F.col("week").alias("date"), F.col("sales").alias("value"),
        X.log_level(F.col("sales")).alias("log_value"), F.lit("log").alias("target_transform"),
        D.hazard_of(F.lit("weekly")).alias("hazard")))
    signals = P.change_signals(insights.change_run(series), strip_series=True)
    said = lambda path: F.get_json_object("signal", path)
    found = F.coalesce(F.from_json(said("$.cp_candidates"), "array<struct<date:date,week_idx:int>>"),
                       F.array().cast("array<struct<date:date,week_idx:int>>"))
    around = F.coalesce(F.from_json(said("$.cp_context_windows"),
                                    "array<struct<series:array<struct<date:date>>>>"),
                        F.array().cast("array<struct<series:array<struct<date:date>>>>"))
    return signals.select(
        "dataset", "measure", said("$.n_changepoints").cast("int").alias("n_changepoints"),
        said("$.model_params.hazard_lam").cast("int").alias("hazard"),
        F.round(said("$.model_params.mu_0").cast("double"), 5).alias("mu_0"),
        F.array_join(F.transform(found, lambda c: c["date"].cast("string")), ",").alias("by_probability"),
        F.array_join(F.transform(around, lambda c: F.size(c["series"]).cast("string")), ",")
        .alias("context_sizes"))


@query
def cp_context(spark, d):
    probs = product_probs(spark, d)
    out = C.context_windows(probs, C.change_candidates(probs, ["product"]), ["product"])
    return out.select("product", "cp_t", "t", "week", F.round("sales", 2).alias("sales"),
                      F.round("cp_prob", 4).alias("cp_prob"))


@query
def cp_deltas(spark, d):
    probs = product_probs(spark, d)
    context = C.context_windows(probs, C.change_candidates(probs, ["product"]), ["product"])
    return rounded(C.change_deltas(context, ["product"], "sales"), before=2, after=2, delta=2)


# --- integration, validation, drift ------------------------------------------------------

def _given_report(spark, d):
    contribs = given_contributions(spark, d)
    return I.integration_report(given_changes(spark), contribs,
                                A.fitted_values(contribs, ["series"]), CONFIG, ["series"])


@query
def integration_report(spark, d):
    out = _given_report(spark, d).drop("series")
    return rounded(out, total_contrib_shift_rel=2, field_contrib_shift_rel=2,
                   lifecycle_shift=3, competitor_shift_rel=2, residual_z_post=3)


@query
def root_cause_counts(spark, d):
    return I.cause_counts(_given_report(spark, d))


@query
def channel_shifts(spark, d):
    out = I.contribution_shifts(given_changes(spark), given_contributions(spark, d), ["series"])
    return out.select("cp_week", "feature", "kind", F.round("pre", 5).alias("pre"),
                      F.round("post", 5).alias("post"))


@query
def recent_trends(spark, d):
    out = I.recent_trends(given_contributions(spark, d), ["series"])
    return rounded(out.drop("series"), mean_contribution=5, share_pct=2)


def _validated(spark, d):
    featured = X.market_features(market(spark, d, step=True), CONFIG).withColumn(
        "series", F.lit("market"))
    transformed = stage(A.transform_channels(featured, CONFIG, ["series"]))
    scaled = A.model_matrix(transformed, CONFIG, ["series"])
    fitted = stage(A.fitted_values(
        A.contributions(scaled, given_betas(spark), ["series"]), ["series"]))
    probs = stage(C.change_probabilities(transformed, ["series"], "week", "log_sales"))
    scale = A.scaling(transformed, A.feature_kinds(transformed.columns, CONFIG), ["series"])
    stds = F.create_map(*[x for f in GIVEN_BETAS for x in (F.lit(f), F.col(f"{f}|std"))])
    betas = given_betas(spark).join(scale, "series").withColumn("x_std", stds[F.col("feature")])
    effects = inline_rows(spark, {"channel": "string", "effect": "double"},
                          TRUE_EFFECTS.items())
    return V.validation_checks(
        C.change_candidates(probs, ["series"]), fitted, A.mape(fitted, ["series"]),
        incidents(spark), "INC-001", ["INC-002", "INC-003"],
        [("planted step", "1999-01-04")], betas, effects)


@query
def validation_checks(spark, d):
    return rounded(_validated(spark, d), metric=3)


@query
def validation_counts(spark, d):
    return V.validation_counts(_validated(spark, d))


@query
def psi_segment(spark, d):
    out = drift.segment_psi(gold_engagement(spark, d), "week",
                            ["product", "segment", "lifecycle_stage"])
    return rounded(out, psi=5)


@query
def psi_many(spark, d):
    """Drift over a column with very many values."""
    return rounded(drift.segment_psi(gold_events(spark, d), "activity_date", ["user_id"]), psi=5)


@query
def psi_numeric(spark, d):
    fact = stored_table(gold_engagement(spark, d))
    out = drift.measure_psi(gold_events(spark, d), "activity_date", ["amount"]).unionByName(
        drift.measure_psi(fact, "week", ["sales", "trx"]))
    return rounded(out, psi=5)


@query
def acf_hints(spark, d):
    """Correlation of weekly sales with themselves one to six weeks earlier, per product."""
    out = G.lag_correlation(market(spark, d, by_product=True), "week", "sales", ["product"],
                            [1, 2, 3, 4, 5, 6])
    return rounded(out, acf=5)


@query
def tune_hints(spark, d):
    """Settings per model beside the number of prepared rows."""
    parts = []
    for name, df, subtypes in [
        ("gold_engagement", gold_engagement(spark, d), ENGAGEMENT_SUBTYPES),
        ("gold_events", gold_events(spark, d), EVENT_SUBTYPES),
    ]:
        for model in K.MODEL_LIMITS:
            daily = "activity_date" if name == "gold_events" else None
            parts.append(PR.model_summary(df, name, model, subtypes, {}, daily))
    return insights.union(parts).select(
        "dataset", "model", "row_count", F.array_join("columns_used", ",").alias("columns_used"),
        F.array_join(F.transform(F.array_sort(F.map_entries("model_params")),
                                 lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
        .alias("params"))


# --- the whole run -----------------------------------------------------------------------

def _run(spark, d) -> insights.Run:
    return insights.run_insights(
        spark, {"gold_engagement": stored_table(gold_engagement(spark, d)),
                "gold_events": gold_events(spark, d), "dim_hcp": dim_hcp(spark, d)},
        datamart_rows(spark))


@query
def payload_json(spark, d):
    return report.payload_json(_run(spark, d), strip_series=True,
                               generated_at="2024-01-01T00:00:00")


@query
def measure_model_map(spark, d):
    return insights.measure_model_map(_run(spark, d)).select(
        "dataset", "measure", F.array_join("models", ",").alias("models"))


@query
def candidate_list(spark, d):
    return insights.candidate_list(_run(spark, d))


@query
def routing_documents(spark, d):
    return report.routing_documents(_described(spark, d, True))


@query
def suppressed_run(spark, d):
    """The run on three chosen datasets without those that repeat another one's signal."""
    catalog = gold_catalog(spark, d)
    run = insights.run_insights(spark, catalog, models=["PSI"], suppress_duplicates=True,
                                names=["gold_events", "gold_daily", "dim_hcp"])
    return insights.model_outcomes(run).select("dataset", "model", "ran", "reason")


# --- dates by vote, lags, chains, streams, states ----------------------------------------

WRITTEN = {"named": "dd-MMM-yyyy", "month": "yyyy-MM", "day_first": "dd/MM/yyyy",
           "month_first": "MM/dd/yyyy", "name_year": "MMM yyyy", "long": "MMMM d, yyyy",
           "short": "dd.MM.yy"}


@query
def date_forms(spark, d):
    """Order dates written in seven ways and read back, each column by its own vote."""
    written = table(spark, d, "orders").select(*[
        F.date_format("o_orderdate", form).alias(name) for name, form in WRITTEN.items()])
    read = D.with_dates(written, list(WRITTEN))
    rows = F.array(*[F.struct(F.lit(c).alias("form"), F.col(c).alias("day")) for c in WRITTEN])
    return read.select(F.explode(rows).alias("r")).select("r.*").groupBy("form", "day").agg(
        F.count("*").alias("n"))


def _lags(spark, d):
    return LG.lag_profile(market(spark, d, by_product=True), "week", "sales", ["product"], 6)


@query
def pacf_hints(spark, d):
    return rounded(_lags(spark, d), acf=5, pacf=5)


@query
def order_hints(spark, d):
    """Starting orders of a seasonal model per product, from its correlations."""
    return LG.order_hints(_lags(spark, d), ["product"])


def given_chains(spark, d) -> DataFrame:
    """Weekly orders and their value, a chain for each priority: draws of two parameters."""
    orders = table(spark, d, "orders")
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    weekly = orders.groupBy(D.week_start(F.col("o_orderdate")).alias("week")).agg(
        F.array(*[F.struct(
            F.lit(p).alias("chain"), F.count_if(F.col("o_orderpriority") == p).cast("double")
            .alias("n_orders"), F.coalesce(F.sum(F.when(F.col("o_orderpriority") == p,
                                                        F.col("o_totalprice"))), F.lit(0.0))
            .alias("value")) for p in names]).alias("c"))
    single = weekly.select("week", F.explode("c").alias("c")).select("week", "c.*")
    both = F.array(*[F.struct(F.lit(c).alias("parameter"), F.col(c).alias("x"))
                     for c in ("n_orders", "value")])
    return single.select("week", "chain", F.explode(both).alias("p")).groupBy(
        "p.parameter", "chain").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("week", "p.x"))), lambda s: s["x"]).alias("draws"))


@query
def chain_diagnostics(spark, d):
    out = PO.diagnostics(given_chains(spark, d), ["parameter"])
    return rounded(out, mean=3, sd=3, rhat=6, ess_bulk=2)


@query
def mmm_posterior(spark, d):
    """Sampled coefficients of the market with their diagnostics."""
    m = stage(matrix(spark, d))
    draws = stage(PO.posterior_draws(m, CONFIG, ["series"]))
    return PO.posterior_means(draws, ["series"])


@query
def online_probs(spark, d):
    """The change-point filter as a stream over files of half a year, in their order."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ON.STATE_STORE)
    series = stage(market(spark, d, step=True, by_product=True).select(
        "product", "week", X.log_level(F.col("sales")).alias("log_sales")))
    priors = stage(C.series_priors(series, ["product"], "week", "log_sales"))
    files = f"{stage_folder(spark)}/online/{uuid.uuid4().hex}"
    half = F.year("week") * 2 + (F.month("week") > 6).cast("int")
    for r in series.select(half.alias("half")).distinct().orderBy("half").collect():
        # Calendar-sized: one file for each half year, written one after the other.
        series.where(half == r["half"]).coalesce(1).write.mode("append").parquet(f"{files}/in")
    stream = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 4).parquet(
        f"{files}/in")
    found = ON.online_probabilities(stream, priors, ["product"], "week", "log_sales")
    run = (found.writeStream.format("parquet").option("path", f"{files}/out")
           .option("checkpointLocation", f"{files}/state").trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.parquet(f"{files}/out").select(
        "product", "week", F.col("t").cast("int").alias("t"), F.round("log_sales", 6).alias("log_sales"),
        F.round("cp_prob", 6).alias("cp_prob"), F.round("exp_run_length", 4).alias("exp_run_length"))


@query
def merged_profile(spark, d):
    """A profile of the lines put together from one state for each year of shipping.

    Sketches are checked against exact values: ranks within one per cent, distinct values within
    three standard errors.
    """
    lines = table(spark, d, "lineitem").drop("l_comment")
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    year = F.coalesce(F.year("l_shipdate").cast("string"), F.lit("None"))
    states = stage(PS.profile_state(lines, "lineitem", measures, year))
    merged = stage(PS.merged_profile(states))
    exact = distinct_counts(lines, lines.columns)
    middles = stage(merged.where("about_quantiles is not null").select(
        "name", F.col("about_quantiles")[1].alias("middle")))
    values = long_values(lines, measures).where("value is not null")
    # A row per measure.
    ranks = values.join(F.broadcast(middles), "name").groupBy("name").agg(
        F.avg((F.col("value") < F.col("middle")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("middle")).cast("double")).alias("upto"))
    near = (F.col("below") <= 0.51) & (F.col("upto") >= 0.49)
    alike = F.abs(F.col("about_distinct") - F.col("n_distinct")) <= 3 * 0.0082 * F.col("n_distinct") + 1
    out = merged.join(exact, "name").join(ranks, "name", "left").select(
        "name", "n_rows", "null_pct", "n", "mean", "std", "skewness", "kurtosis", "value_min",
        "value_max", alike.alias("distinct_near"), near.alias("median_near"))
    return rounded(out, null_pct=6, mean=4, std=4, skewness=4, kurtosis=4, value_min=4, value_max=4)


@query
def spec_sheet(spark, d):
    """A spec sheet written from the given orders: priorities as datamarts side by side."""
    orders = table(spark, d, "orders")
    listed = orders.select("o_orderpriority", F.year("o_orderdate").alias("y"),
                           "o_orderstatus").distinct().groupBy("o_orderpriority").agg(
        F.array_sort(F.collect_set(F.concat(F.lit("y"), "y", F.lit("_"), F.lower("o_orderstatus"))))
        .alias("columns")).orderBy("o_orderpriority").collect()  # five priorities
    names = [r["o_orderpriority"].lower().replace(" ", "_") for r in listed]
    depth = max(len(r["columns"]) for r in listed)
    lines = ["Category,Datamart,Description"]
    lines += [f'Orders,{n},"Columns, by year and status, of {n}"' for n in names] + [""]
    lines += ["Datamarts with granularity example", ",".join(names)]
    lines += [",".join(r["columns"][i] if i < len(r["columns"]) else "" for r in listed)
              for i in range(depth)] + ["", "not a column"]
    path = f"{stage_folder(spark)}/sheets/{uuid.uuid4().hex}.csv"
    write_text(spark, path, "\n".join(lines))
    return parse_spec(spark, path).select(
        "name", "category", "description", F.array_join("columns", ",").alias("columns"))


@query
def profiled_preparation(spark, d):
    """Tables prepared for each model by what their own profiles suggest: sums of the inputs."""
    fact = stored_table(gold_engagement(spark, d))
    frames = {"gold_engagement": (fact, ENGAGEMENT_SUBTYPES, list(K.MODEL_LIMITS)),
              "dull_orders": (dull_orders(spark, d), DULL_SUBTYPES, list(K.MODEL_LIMITS))}
    profiles = stage(PF.column_profiles({n: (df, s) for n, (df, s, _) in frames.items()}))
    parts = []
    for (name, model), df in PR.prepared(frames, profiles).items():
        numbers = PR.numeric_columns(df)
        rows = F.array(*[F.struct(F.lit(c).alias("name"), F.count(c).alias("n"),
                                  F.round(F.avg(c), 4).alias("mean")) for c in numbers])
        parts.append(df.agg(rows.alias("r")).select(
            F.lit(name).alias("dataset"), F.lit(model).alias("model"), F.explode("r").alias("r"))
            .select("dataset", "model", "r.*"))
    return insights.union(parts)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Change-points of weekly sales per product."""
    return cp_candidates(spark, folder)
