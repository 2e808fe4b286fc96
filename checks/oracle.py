"""SQL twins of the registered queries, for DuckDB over the same tables.

Written from the definitions, not from the Spark plans: set predicates on lists instead of word
joins, self-joins instead of sliding windows, a recursive query instead of the grouped step.
"""

from __future__ import annotations

from checks.oracle_metadata import METADATA_ORACLES
from tidemark.plans.queries import (
    GIVEN_BETAS, GIVEN_CHANGES, GIVEN_INTERCEPT, INCIDENTS, TRUE_EFFECTS)

ORACLES: dict[str, str] = dict(METADATA_ORACLES)

GOLD = """
gold_lines AS (
  SELECT date_trunc('week', o_orderdate)::DATE AS week, o_custkey AS hcp_id, p_type AS product,
         round(sum(l_extendedprice), 2) AS sales, count(*) AS trx,
         sum(CASE WHEN o_orderpriority = '1-URGENT' THEN l_quantity ELSE 0 END) AS f2f,
         sum(CASE WHEN o_orderpriority = '2-HIGH' THEN l_quantity ELSE 0 END) AS samples,
         sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN l_quantity ELSE 0 END) AS email_opens,
         sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN l_quantity ELSE 0 END)
           AS speaker,
         sum(CASE WHEN o_orderpriority = '5-LOW' THEN l_quantity ELSE 0 END) AS phone_call,
         max(CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END) AS is_anomaly
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
gold_weeks AS (
  SELECT date_trunc('week', o_orderdate)::DATE AS week,
         round(100 * sum(l_discount), 4) AS tv_grps,
         round(10000 * sum(l_tax) / count(*), 6) AS competitor_spend
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
gold AS (
  SELECT week, hcp_id, product, c_mktsegment AS segment, r_name AS region, sales, trx, f2f,
         samples, email_opens, speaker, phone_call, tv_grps, competitor_spend, is_anomaly,
         CASE WHEN year(week) <= 1995 THEN 'pre_launch' WHEN year(week) = 1996 THEN 'launch'
              WHEN year(week) <= 1998 THEN 'growth' WHEN year(week) <= 2000 THEN 'maturity'
              ELSE 'decline' END AS lifecycle_stage
  FROM gold_lines JOIN gold_weeks USING (week) JOIN customer ON c_custkey = hcp_id
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
"""

STEP = GOLD + """,
step AS (SELECT * REPLACE (CASE WHEN week >= DATE '1999-01-04' THEN sales * 1.6 ELSE sales END
                           AS sales) FROM gold)
"""

EVENTS = """
gold_events AS (SELECT ts::DATE AS activity_date, user_id, event_type, value AS amount
                FROM events)
"""

ROLLED = """sum(sales) AS sales, sum(trx) AS trx, sum(f2f) AS f2f, sum(samples) AS samples,
  sum(email_opens) AS email_opens, sum(speaker) AS speaker, sum(phone_call) AS phone_call,
  avg(tv_grps) AS tv_grps, avg(competitor_spend) AS competitor_spend,
  min(lifecycle_stage) AS lifecycle_stage"""


def market(source: str = "gold", by: str = "week") -> str:
    return f"mk AS (SELECT {by}, {ROLLED} FROM {source} WHERE is_anomaly = 0 GROUP BY {by})"


FEATURES = """
ft AS (
  SELECT *, row_number() OVER (ORDER BY week) - 1 AS week_idx,
         ln(greatest(sales, 1e-6)) AS log_sales,
         CASE lifecycle_stage WHEN 'pre_launch' THEN 0 WHEN 'launch' THEN 1
              WHEN 'maturity' THEN 3 WHEN 'decline' THEN 4 ELSE 2 END AS lc_num
  FROM mk),
fx AS (
  SELECT *, sin(2 * pi() * week_idx / 52) AS sin_1, cos(2 * pi() * week_idx / 52) AS cos_1,
         sin(4 * pi() * week_idx / 52) AS sin_2, cos(4 * pi() * week_idx / 52) AS cos_2,
         CASE WHEN week_idx < 180 THEN 'train' ELSE 'test' END AS split
  FROM ft)
"""

CARRIED = {"f2f": (0.3, 0.8), "samples": (0.3, 0.8), "email_opens": (0.3, 0.8),
           "speaker": (0.3, 0.8), "phone_call": (0.3, 0.8), "tv_grps": (0.6, 2.0)}

CARRY = "ad AS (SELECT a.week_idx, " + ", ".join(
    f"sum(b.{c} * pow({d}, a.week_idx - b.week_idx)) AS {c}_ads" for c, (d, _) in CARRIED.items()
) + " FROM fx a JOIN fx b ON b.week_idx <= a.week_idx GROUP BY a.week_idx)"

HALF = "hf AS (SELECT " + ", ".join(
    f"coalesce(quantile_cont({c}_ads, 0.5) FILTER ({c}_ads > 0), 1.0) AS {c}_half"
    for c in CARRIED) + " FROM ad)"

SAT = "st AS (SELECT fx.*, ad.* EXCLUDE (week_idx), hf.*, " + ", ".join(
    f"pow(greatest({c}_ads, 0), {a}) / (pow(greatest({c}_ads, 0), {a}) + pow({c}_half, {a}) "
    f"+ 1e-12) AS {c}_sat" for c, (_, a) in CARRIED.items()
) + " FROM fx JOIN ad USING (week_idx) CROSS JOIN hf)"

FEATURE_NAMES = list(GIVEN_BETAS)

SCALE = "sc AS (SELECT " + ", ".join(
    f"avg({c}::DOUBLE) FILTER (split = 'train') AS {c}_mean, "
    f"CASE WHEN stddev_pop({c}::DOUBLE) FILTER (split = 'train') = 0 THEN 1.0 "
    f"ELSE stddev_pop({c}::DOUBLE) FILTER (split = 'train') END AS {c}_std"
    for c in FEATURE_NAMES) + " FROM st)"

MATRIX = "mx AS (SELECT week, split, log_sales AS y, " + ", ".join(
    f'({c} - {c}_mean) / {c}_std AS "X_{c}"' for c in FEATURE_NAMES
) + " FROM st CROSS JOIN sc)"


def attributed(source: str = "step") -> str:
    parts = [STEP, market(source), FEATURES, CARRY, HALF, SAT, SCALE, MATRIX]
    return "WITH " + ",\n".join(parts)


KIND = {c: ("channel" if c.endswith("_sat") else
            "competitor" if c == "competitor_spend" else "control") for c in FEATURE_NAMES}

CONTRIBS = "cb AS (" + " UNION ALL ".join(
    f"SELECT week, split, y, '{c}' AS feature, '{KIND[c]}' AS kind, "
    f'{b} * "X_{c}" AS contribution FROM mx' for c, b in GIVEN_BETAS.items()) + ")"

FITTED = f"""
fv AS (SELECT week, split, y AS y_actual, {GIVEN_INTERCEPT} + sum(contribution) AS y_predicted
       FROM cb GROUP BY week, split, y),
fr AS (SELECT *, y_actual - y_predicted AS residual FROM fv),
fz AS (SELECT *, (residual - avg(residual) OVER ()) / (stddev_samp(residual) OVER () + 1e-9)
         AS residual_z FROM fr),
er AS (SELECT split, 100 * avg(abs(exp(y_actual) - exp(y_predicted)) / (exp(y_actual) + 1e-9))
         AS mape, count(*) AS n FROM fv GROUP BY split)
"""

CHANGES = "cp AS (SELECT unnest([" + ", ".join(f"DATE '{w}'" for w in GIVEN_CHANGES) + \
    "]) AS cp_week)"

SHIFTS = """
sh AS (SELECT cp_week, feature, kind,
         avg(contribution) FILTER (week < cp_week) AS pre,
         avg(contribution) FILTER (week >= cp_week) AS post
       FROM cp JOIN cb ON week >= cp_week - 56 AND week < cp_week + 56
       GROUP BY cp_week, feature, kind)
"""

# --- roll-ups and features --------------------------------------------------------------

ORACLES["market_rollup"] = f"""WITH {GOLD}, {market(by='week, product')}
SELECT week, product, round(sales, 2) AS sales, round(trx::DOUBLE, 2) AS trx,
  round(f2f, 2) AS f2f, round(samples, 2) AS samples, round(email_opens, 2) AS email_opens,
  round(speaker, 2) AS speaker, round(phone_call, 2) AS phone_call,
  round(tv_grps, 3) AS tv_grps, round(competitor_spend, 6) AS competitor_spend,
  lifecycle_stage FROM mk"""

ORACLES["clean_row_stats"] = f"""WITH {GOLD}
SELECT count(*) AS n_rows, count(*) FILTER (is_anomaly = 1) AS n_anomaly,
  count(*) FILTER (is_anomaly = 0) AS n_clean,
  count(DISTINCT hcp_id) FILTER (is_anomaly = 0) AS n_entities FROM gold"""

BASE = f"WITH {GOLD}, {market()}, {FEATURES}"
ORACLES["market_features"] = f"""{BASE}
SELECT week, week_idx, round(log_sales, 6) AS log_sales, lc_num,
  round(ln(1 + tv_grps), 6) AS tv_grps_log, split FROM fx"""
ORACLES["fourier_terms"] = f"""{BASE}
SELECT week, round(sin_1, 6) AS sin_1, round(cos_1, 6) AS cos_1, round(sin_2, 6) AS sin_2,
  round(cos_2, 6) AS cos_2 FROM fx"""
ORACLES["train_split"] = f"""{BASE}
SELECT split, count(*) AS n, min(week) AS first_week, max(week) AS last_week FROM fx
GROUP BY split"""
ORACLES["organic_flags"] = f"""{BASE}
SELECT week, (week >= DATE '1997-01-06')::INT AS flag_launch,
  (week >= DATE '1999-01-04')::INT AS flag_shift FROM fx"""

ORACLES["segment_rollup"] = f"""WITH {EVENTS},
cells AS (SELECT activity_date, event_type, user_id, sum(amount) AS amount,
            avg(amount / 100) AS amount_share FROM gold_events GROUP BY ALL)
SELECT activity_date, round(sum(amount), 2) AS amount,
  round(avg(amount_share), 6) AS amount_share, count(DISTINCT event_type) AS n_event_type
FROM cells GROUP BY activity_date"""

ORACLES["date_rollup"] = f"""WITH {GOLD}
SELECT week, round(sum(sales), 2) AS sales, sum(trx)::DOUBLE AS trx, count(*) AS n_obs
FROM gold GROUP BY week"""

ORACLES["weekly_sat"] = f"""WITH {EVENTS},
w AS (SELECT activity_date + ((6 - dayofweek(activity_date)))::INT AS activity_date,
        sum(amount) AS amount FROM gold_events GROUP BY 1),
s AS (SELECT unnest(generate_series(min(activity_date), max(activity_date),
        INTERVAL 7 DAY))::DATE AS activity_date FROM w)
SELECT activity_date, round(coalesce(amount, 0), 2) AS amount
FROM s LEFT JOIN w USING (activity_date)"""

ORACLES["monthly_grain"] = f"""WITH {GOLD}, {market()}
SELECT max(week) AS week, round(sum(sales), 2) AS sales, round(sum(trx)::DOUBLE, 2) AS trx,
  round(sum(f2f), 2) AS f2f FROM mk GROUP BY date_trunc('month', week)"""

ORACLES["spine_ffill"] = """
WITH g AS (SELECT o_custkey, date_trunc('week', o_orderdate)::DATE AS week,
             max(o_totalprice) AS largest FROM orders GROUP BY 1, 2),
s AS (SELECT o_custkey, unnest(generate_series(min(week), max(week),
        INTERVAL 7 DAY))::DATE AS week FROM g GROUP BY 1),
f AS (SELECT s.week, last_value(g.largest IGNORE NULLS) OVER (
        PARTITION BY s.o_custkey ORDER BY s.week) AS largest
      FROM s LEFT JOIN g ON g.o_custkey = s.o_custkey AND g.week = s.week)
SELECT week, count(*) AS n_customers, count(largest) AS n_known,
  CAST(sum(CAST(round(largest * 100) AS BIGINT)) AS BIGINT) AS carried_cents FROM f GROUP BY week"""


# --- profiles ----------------------------------------------------------------------------

def moments(c: str, name: str, source: str) -> str:
    """One profile row of a measure with population moments written out."""
    return f"""SELECT '{name}' AS name,
  round(1 - count({c}) / count(*), 6) AS null_pct, count(DISTINCT {c}) AS unique_count,
  round((avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5)), 4) AS skewness,
  round((avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2)) - 3, 4) AS kurtosis,
  round(max({c}), 4) AS value_max, round(avg({c}), 4) AS mean,
  round(quantile_cont({c}, 0.5), 4) AS median, round(stddev_samp({c}), 4) AS std,
  round(avg(CASE WHEN {c} IS NULL THEN NULL WHEN {c} < q1 - 1.5 * (q3 - q1)
    OR {c} > q3 + 1.5 * (q3 - q1) THEN 1.0 ELSE 0.0 END), 6) AS outlier_rate,
  NULL::VARCHAR AS date_grain
FROM (SELECT {c}::DOUBLE AS {c} FROM {source}), (SELECT avg({c}::DOUBLE) AS m,
  quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3
  FROM {source})"""


def plain(c: str, source: str, grain: str = "NULL") -> str:
    return f"""SELECT '{c}' AS name, round(1 - count({c}) / count(*), 6) AS null_pct,
  count(DISTINCT {c}) AS unique_count, NULL::DOUBLE AS skewness, NULL::DOUBLE AS kurtosis,
  NULL::DOUBLE AS value_max, NULL::DOUBLE AS mean, NULL::DOUBLE AS median,
  NULL::DOUBLE AS std, NULL::DOUBLE AS outlier_rate, {grain}::VARCHAR AS date_grain
FROM {source}"""


GRAIN = """CASE WHEN g <= 2 THEN 'daily' WHEN g BETWEEN 5 AND 9 THEN 'weekly'
  WHEN g BETWEEN 25 AND 35 THEN 'monthly' WHEN g BETWEEN 80 AND 100 THEN 'quarterly' END"""


def gap_query(c: str, source: str) -> str:
    """Distinct moments and their median whole-day gap."""
    return f"""(SELECT count(*) AS n, median(floor((epoch_us(d) - epoch_us(p)) / 86400000000))
  AS g FROM (SELECT d, lag(d) OVER (ORDER BY d) AS p FROM (SELECT DISTINCT {c}::TIMESTAMP AS d
  FROM {source} WHERE {c} IS NOT NULL)))"""


def grain_of(c: str, source: str) -> str:
    return f"(SELECT {GRAIN} FROM {gap_query(c, source)})"


GOLD_MEASURES = ["sales", "trx", "competitor_spend"]
GOLD_COLUMNS = ("week hcp_id product segment region sales trx f2f samples email_opens speaker "
                "phone_call tv_grps competitor_spend is_anomaly lifecycle_stage").split()
ORACLES["column_profile"] = f"WITH {GOLD}\n" + "\nUNION ALL\n".join(
    moments(c, c, "gold") if c in GOLD_MEASURES
    else plain(c, "gold", grain_of("week", "gold") if c == "week" else "NULL")
    for c in GOLD_COLUMNS)

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_COLUMNS = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
                "l_discount l_tax l_returnflag l_linestatus l_shipdate").split()
ORACLES["lineitem_profile"] = "\nUNION ALL\n".join(
    moments(c, c, "lineitem") if c in LINE_MEASURES
    else plain(c, "lineitem",
               grain_of("l_shipdate", "lineitem") if c == "l_shipdate" else "NULL")
    for c in LINE_COLUMNS)

ORACLES["distinct_values"] = " UNION ALL ".join(
    f"SELECT '{c}' AS name, count(DISTINCT {c}) AS n_distinct FROM lineitem"
    for c in LINE_COLUMNS)

ORACLES["outlier_rate"] = " UNION ALL ".join(f"""
SELECT '{c}' AS name, round(q1, 4) AS q1, round(m, 4) AS median, round(q3, 4) AS q3,
  round(avg(CASE WHEN {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1) THEN 1.0
            ELSE 0.0 END), 6) AS outlier_rate
FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m,
  quantile_cont({c}, 0.75) AS q3 FROM lineitem) GROUP BY q1, m, q3""" for c in LINE_MEASURES)

ORACLES["date_grain"] = f"WITH {GOLD}, cal AS (SELECT date_trunc('month', o_orderdate) AS month, " \
    "date_trunc('quarter', o_orderdate) AS quarter, date_trunc('year', o_orderdate) AS year " \
    "FROM orders)\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS name, n AS n_moments, g AS median_gap, {GRAIN} AS date_grain "
        f"FROM {gap_query(c, t)}"
        for c, t in [("ts", "events"), ("o_orderdate", "orders"), ("l_shipdate", "lineitem"),
                     ("week", "gold"), ("month", "cal"), ("quarter", "cal"), ("year", "cal")])

TEXTS = """tx AS (SELECT o_orderkey::VARCHAR AS clean,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'n/a'
       ELSE o_totalprice::DECIMAL(18,2)::VARCHAR END AS some_junk,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '12d'
       ELSE o_totalprice::DECIMAL(18,2)::VARCHAR END AS more_junk,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice::DECIMAL(18,2)::VARCHAR END AS with_nulls,
  o_orderpriority FROM orders)"""
ORACLES["numeric_promotion"] = f"WITH {TEXTS}\n" + " UNION ALL ".join(f"""
SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
  round(count(try_cast({c} AS DOUBLE)) / count(*), 6) AS numeric_share,
  count({c}) = count(*) AND count(try_cast({c} AS DOUBLE)) / count(*) >= 0.9 AS promoted
FROM tx""" for c in ["clean", "some_junk", "more_junk", "with_nulls", "o_orderpriority"])

LOG_TEXT = "[log_transform] log1p(column) — right-skewed distribution detected"
CLIP_TEXT = "[outlier_clip] clip at 1st/99th percentile before further transforms"
NULL_TEXT = "[null_imputation] forward-fill or median imputation — null rate exceeds 5%"
WEEK_TEXT = ("[weekly_aggregation] resample to W-SAT, aggregate measures by sum "
             "(or mean for ratios)")
MANY_TEXT = ("[high_cardinality_encode] consider target encoding or embedding — "
             "high-cardinality categorical")
RATIO_TEXT = ("[ratio_bound_check] values > 1.0 found in ratio column — check for scale "
              "mismatch (may need /100)")


def measure_suggestions(dataset: str, c: str, source: str, is_ratio: bool = False) -> str:
    ratio = f"CASE WHEN max(x) > 1.0 THEN '{RATIO_TEXT}' END" if is_ratio else "NULL"
    return f"""SELECT '{dataset}' AS dataset, '{c}' AS name, concat_ws(' | ',
  CASE WHEN avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5) > 1.5 THEN '{LOG_TEXT}' END,
  CASE WHEN avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3 > 5 THEN '{CLIP_TEXT}' END,
  CASE WHEN 1 - count(x) / count(*) > 0.05 THEN '{NULL_TEXT}' END, {ratio}) AS suggestions
FROM (SELECT {c} AS x FROM {source}), (SELECT avg({c}) AS m FROM {source})"""


def other_suggestions(dataset: str, c: str, source: str, kind: str) -> str:
    if kind == "date":
        text = f"CASE WHEN {grain_of(c, source)} = 'daily' THEN '{WEEK_TEXT}' END"
    elif kind == "segment":
        text = f"CASE WHEN count(DISTINCT {c}) > 50 THEN '{MANY_TEXT}' END"
    else:
        text = "NULL"
    return (f"SELECT '{dataset}' AS dataset, '{c}' AS name, concat_ws(' | ', t, NULL) "
            f"AS suggestions FROM (SELECT max({text}) AS t FROM {source})" if kind != "segment"
            else f"SELECT '{dataset}' AS dataset, '{c}' AS name, concat_ws(' | ', {text}, NULL) "
                 f"AS suggestions FROM {source}")


ORACLES["suggested_transforms"] = f"""WITH {EVENTS}, sparse AS (
  SELECT l_shipdate::DATE AS ship_date,
    CASE WHEN l_returnflag <> 'R' THEN exp(l_quantity / 10) END AS amount,
    pow(l_quantity / 10, 6) AS total_volume, l_discount * 20 AS market_share,
    l_orderkey::VARCHAR AS category FROM lineitem)
""" + "\nUNION ALL\n".join([
    other_suggestions("sparse_lines", "ship_date", "sparse", "date"),
    measure_suggestions("sparse_lines", "amount", "sparse"),
    measure_suggestions("sparse_lines", "total_volume", "sparse"),
    measure_suggestions("sparse_lines", "market_share", "sparse", True),
    other_suggestions("sparse_lines", "category", "sparse", "segment"),
    other_suggestions("gold_events", "activity_date", "gold_events", "date"),
    other_suggestions("gold_events", "user_id", "gold_events", "key"),
    other_suggestions("gold_events", "event_type", "gold_events", "segment"),
    measure_suggestions("gold_events", "amount", "gold_events"),
])

ORACLES["fact_dim_join"] = f"""WITH {GOLD}
SELECT n_name AS country_name, c_acctbal > 0 AS is_active, count(*) AS n,
  round(sum(sales), 2) AS sales
FROM gold LEFT JOIN customer ON c_custkey = hcp_id LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2"""

# --- selection ---------------------------------------------------------------------------

ORACLES["pair_correlations"] = f"WITH {GOLD}\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS left_name, '{b}' AS right_name, round(corr({a}, {b}), 6) AS r FROM gold"
    for i, a in enumerate(["sales", "trx", "competitor_spend", "f2f", "samples", "tv_grps",
                           "is_anomaly"])
    for b in ["sales", "trx", "competitor_spend", "f2f", "samples", "tv_grps",
              "is_anomaly"][i + 1:])

ORACLES["dedup_measures"] = f"""WITH RECURSIVE {GOLD},
n AS (SELECT unnest(['sales', 'trx', 'competitor_spend', 'f2f', 'samples']) AS name,
        unnest([1, 2, 3, 4, 5]) AS measure_rank),
r AS (""" + " UNION ALL ".join(
    f"SELECT {i + 1} AS i, {j + 1} AS j, abs(corr({a}, {b})) > 0.5 AS near FROM gold"
    for j, b in enumerate(["sales", "trx", "competitor_spend", "f2f", "samples"])
    for i, a in enumerate(["sales", "trx", "competitor_spend", "f2f", "samples"][:j])) + """),
bad AS (SELECT j, list(i) AS near FROM r WHERE near GROUP BY j),
k AS (SELECT 0 AS step, []::INT[] AS kept UNION ALL
  SELECT step + 1, CASE WHEN list_has_any(kept, coalesce((SELECT near FROM bad
    WHERE j = step + 1), []::INT[])) THEN kept ELSE list_append(kept, step + 1) END
  FROM k WHERE step < 5)
SELECT name, measure_rank, list_contains((SELECT kept FROM k WHERE step = 5), measure_rank)
  AS kept FROM n"""

ORACLES["candidate_window"] = f"""WITH {GOLD}, m AS (SELECT max(week) AS max_date FROM gold),
w AS (SELECT unnest(['BOCPD', 'MMM', 'PSI', 'ARIMA']) AS model, unnest([2, 1, 1, 3]) AS years)
SELECT model, years, (max_date - to_years(years))::DATE AS cutoff_date, max_date,
  (SELECT count(*) FROM gold WHERE week >= max_date - to_years(years)) AS n_rows FROM w, m"""

ORACLES["recent_sales"] = f"""WITH {GOLD}
SELECT product, count(*) AS n, round(sum(sales), 2) AS sales FROM gold
WHERE week >= (SELECT max(week) - INTERVAL 1 YEAR FROM gold) GROUP BY product"""

DATED = """dl AS (SELECT CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS ship_date,
  o_orderdate, l_extendedprice, l_discount, l_tax, l_linenumber, o_totalprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def date_score(dataset: str, ordinal: int, c: str, source: str, base: float) -> str:
    return f"""SELECT '{dataset}' AS dataset, {ordinal} AS ordinal, '{c}' AS date_column,
  {base} - 5 * (1 - count({c}) / count(*)) + CASE WHEN max(g) IS NULL THEN 0 ELSE 1 END
  + CASE WHEN count(DISTINCT {c}) > 52 THEN 0.5 WHEN count(DISTINCT {c}) > 12 THEN 0.3
         ELSE 0 END AS score, max(g) AS date_grain
FROM {source}, (SELECT {grain_of(c, source)} AS g)"""


ORACLES["best_date"] = f"""WITH {GOLD}, {DATED}, sc AS (
{date_score('dated_lines', 0, 'ship_date', 'dl', 2 + 0.5 * 0.8)} UNION ALL
{date_score('dated_lines', 1, 'o_orderdate', 'dl', 3 + 0.5 * 0.9)} UNION ALL
{date_score('gold_engagement', 0, 'week', 'gold', 2 + 0.5 * 1.0)})
SELECT dataset, date_column, round(score, 4) AS score, date_grain, false AS low_confidence
FROM sc QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY score DESC, ordinal) = 1"""


def measure_score(ordinal: int, c: str) -> str:
    return f"""SELECT 'dated_lines' AS dataset, {ordinal} AS ordinal, '{c}' AS name,
  -3 * (1 - count(x) / count(*))
  + CASE WHEN cv < 0.02 THEN -1 ELSE 0.5 * least(cv, 2) END
  + CASE WHEN count(DISTINCT x) <= 2 THEN -3 WHEN count(DISTINCT x) <= 5 THEN -1
         WHEN count(DISTINCT x) > 50 THEN 0.5 WHEN count(DISTINCT x) > 10 THEN 0.2 ELSE 0 END
  + CASE WHEN sk BETWEEN 0.3 AND 15 THEN 0.4 WHEN sk > 15 OR abs(sk) <= 1.5 THEN 0.2 ELSE 0 END
  + CASE WHEN max(x) > 0 THEN 0.1 ELSE 0 END AS score
FROM (SELECT {c}::DOUBLE AS x FROM dl), (SELECT stddev_samp(v) / abs(avg(v)) AS cv,
  avg(pow(v - m, 3)) / pow(avg(pow(v - m, 2)), 1.5) AS sk FROM (SELECT {c}::DOUBLE AS v FROM dl),
  (SELECT avg({c}::DOUBLE) AS m FROM dl)) GROUP BY cv, sk"""


RANKED = f"""WITH {GOLD}, {DATED}, rm AS (""" + " UNION ALL ".join(
    measure_score(i + 2, c) for i, c in enumerate(
        ["l_extendedprice", "l_discount", "l_tax", "l_linenumber", "o_totalprice"])) + """
UNION ALL SELECT 'gold_engagement', i, c, 'inf'::DOUBLE FROM (SELECT unnest([5, 6, 13]) AS i,
  unnest(['sales', 'trx', 'competitor_spend']) AS c) WHERE (SELECT count(*) FROM gold) > 0),
rk AS (SELECT dataset, name, score, row_number() OVER (PARTITION BY dataset
  ORDER BY score DESC, ordinal) AS measure_rank FROM rm)
"""
ORACLES["ranked_measures"] = f"""{RANKED} SELECT dataset, name, measure_rank,
  CASE WHEN score < 'inf'::DOUBLE THEN round(score, 3) END AS score FROM rk"""
ORACLES["best_measure"] = f"""{RANKED} SELECT dataset, name AS measure,
  CASE WHEN score < 'inf'::DOUBLE THEN 'unclassified_metric' ELSE 'measure' END AS subtype,
  score < 'inf'::DOUBLE AS needs_review FROM rk WHERE measure_rank = 1"""

# --- quality gate ------------------------------------------------------------------------

DULL = """dull AS (SELECT o_orderdate::DATE AS activity_date, 5.0::DOUBLE AS amount,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS revenue,
  CASE WHEN o_totalprice > 250000 THEN o_orderpriority END AS segment,
  o_totalprice AS f2f FROM orders)"""
GATED = f"WITH RECURSIVE {GOLD}, {EVENTS}, {DULL}\n"
YEARS = {"BOCPD": 2, "MMM": 1, "PSI": 1, "ARIMA": 3}
HAS = {
    "fill_rate": list(YEARS), "zero_variance": list(YEARS), "min_row_count": list(YEARS),
    "distribution_shape": ["BOCPD", "MMM", "ARIMA"], "date_continuity": ["BOCPD", "ARIMA"],
    "channel_collinearity": ["MMM"], "segment_balance": ["PSI"], "autocorrelation": ["ARIMA"],
}
GOLD_CHANNELS = ["f2f", "samples", "email_opens", "speaker", "phone_call", "tv_grps"]
# dataset: source, date, measures, channels in column order, segments
GATE_TABLES = {
    "gold_engagement": ("gold", "week", GOLD_MEASURES, GOLD_CHANNELS,
                        ["product", "segment", "lifecycle_stage"],
                        ["sales", "trx", *GOLD_CHANNELS, "competitor_spend"]),
    "gold_events": ("gold_events", "activity_date", ["amount"], [], ["event_type"], ["amount"]),
    "dull_orders": ("dull", "activity_date", ["amount", "revenue"], ["f2f"], ["segment"],
                    ["amount", "revenue", "f2f"]),
}


def recent(source: str, date: str, model: str) -> str:
    return (f"(SELECT * FROM {source} WHERE {date} >= (SELECT max({date}) - "
            f"INTERVAL {YEARS[model]} YEAR FROM {source}))")


def check_fill(dataset, model):
    source, date, measures, channels, _, _ = GATE_TABLES[dataset]
    fills = ", ".join(f"nullif(count({c}) / count(*), 0)" for c in measures + channels)
    return f"""SELECT CASE WHEN d < 0.5 OR m IS NULL OR m < 0.5 THEN 'FAIL'
  WHEN d < 0.8 OR m < 0.8 THEN 'WARN' ELSE 'PASS' END AS status,
  round(CASE WHEN d < 0.5 THEN d WHEN m IS NULL THEN 0 WHEN m < 0.5 THEN m
    WHEN d < 0.8 THEN d ELSE m END, 4) AS metric
FROM (SELECT count({date}) / count(*) AS d, greatest({fills}) AS m FROM {source})"""


def check_shape(dataset, model):
    source, _, measures, _, _, _ = GATE_TABLES[dataset]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, count(DISTINCT {c}) AS u, count({c}) AS n, "
        f"stddev_samp({c}) / nullif(abs(avg({c})), 0) AS cv FROM {source}"
        for i, c in enumerate(measures))
    return f"""SELECT CASE WHEN h = 0 AND k > 0 THEN 'FAIL' WHEN h > 0 AND u < 5 THEN 'WARN'
  ELSE 'PASS' END AS status, CASE WHEN h = 0 AND k > 0 THEN k WHEN h > 0 AND u < 5 THEN u
  ELSE h END::DOUBLE AS metric
FROM (SELECT count(*) FILTER (n > 0 AND u > 2 AND coalesce(cv, 1) >= 0.02) AS h,
  count(*) FILTER (n > 0 AND NOT (u > 2 AND coalesce(cv, 1) >= 0.02)) AS k,
  min_by(u, i) FILTER (n > 0 AND u > 2 AND coalesce(cv, 1) >= 0.02) AS u FROM ({rows}))"""


def check_variance(dataset, model):
    source, date, _, _, _, metrics = GATE_TABLES[dataset]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, stddev_samp({c}) / (abs(avg({c})) + 1e-12) AS cv "
        f"FROM {recent(source, date, model)}" for i, c in enumerate(metrics))
    return f"""SELECT CASE WHEN count(*) FILTER (cv < 0.01) > 0 THEN 'WARN' ELSE 'PASS' END
  AS status, round(min_by(cv, i) FILTER (cv < 0.01), 6) AS metric FROM ({rows})"""


def check_continuity(dataset, model):
    source, date, *_ = GATE_TABLES[dataset]
    need = {"BOCPD": "30 WHEN 'weekly' THEN 8 WHEN 'monthly' THEN 12 WHEN 'quarterly' THEN 4 "
                     "ELSE 8",
            "ARIMA": "120 WHEN 'weekly' THEN 16 WHEN 'monthly' THEN 24 WHEN 'quarterly' THEN 8 "
                     "ELSE 16"}[model]
    return f"""SELECT CASE WHEN n < need THEN 'FAIL' WHEN n < 2 THEN 'PASS'
  WHEN g / days > 4 THEN 'WARN' ELSE 'PASS' END AS status,
  CASE WHEN n < need OR n < 2 THEN n WHEN g / days > 4 THEN round(g / days, 2) ELSE 0 END::DOUBLE
    AS metric
FROM (SELECT n, g, CASE label WHEN 'daily' THEN {need} END AS need,
  CASE label WHEN 'daily' THEN 1 WHEN 'weekly' THEN 7 WHEN 'monthly' THEN 30.5 ELSE 91.25 END
  AS days FROM (SELECT count(*) AS n, max(gap) AS g FROM (SELECT d - lag(d) OVER (ORDER BY d)
  AS gap FROM (SELECT DISTINCT {date} AS d FROM {recent(source, date, model)}))),
  (SELECT {grain_of(date, source)} AS label))"""


def check_collinearity(dataset, model):
    source, date, _, channels, _, _ = GATE_TABLES[dataset]
    if len(channels) < 2:
        return f"SELECT 'FAIL' AS status, {len(channels)}::DOUBLE AS metric"
    rows = " UNION ALL ".join(
        f"SELECT abs(corr({a}, {b})) AS r FROM {recent(source, date, model)}"
        for i, a in enumerate(channels) for b in channels[i + 1:])
    return f"""SELECT CASE WHEN max(r) > 0.85 THEN 'WARN' ELSE 'PASS' END AS status,
  round(max(r), 4) AS metric FROM ({rows})"""


def check_balance(dataset, model):
    source, date, _, _, segments, _ = GATE_TABLES[dataset]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, min(n) AS lo, max(n) / (min(n) + 1e-9) AS ratio FROM (SELECT "
        f"count(*) AS n FROM {recent(source, date, model)} WHERE {c} IS NOT NULL GROUP BY {c})"
        for i, c in enumerate(segments))
    return f"""SELECT CASE WHEN f IS NULL THEN 'FAIL' WHEN f <= 10 THEN 'PASS' ELSE 'WARN' END
  AS status, coalesce(round(f, 2), lo::DOUBLE) AS metric
FROM (SELECT min_by(ratio, i) FILTER (lo >= 30) AS f, max(lo) AS lo FROM ({rows}))"""


def check_autocorr(dataset, model):
    source, date, measures, *_ = GATE_TABLES[dataset]
    return f"""SELECT CASE WHEN n < 10 OR r IS NULL OR abs(r) < 0.1 THEN 'WARN' ELSE 'PASS' END
  AS status, CASE WHEN n >= 10 THEN round(r, 4) END AS metric
FROM (SELECT count(*) AS n, CASE WHEN stddev_pop(x) FILTER (p IS NOT NULL) > 0
    AND stddev_pop(p) > 0 THEN corr(x, p) END AS r FROM
  (SELECT x, lag(x) OVER (ORDER BY d) AS p FROM (SELECT {date} AS d, sum({measures[0]}) AS x
   FROM {recent(source, date, model)} GROUP BY 1)))"""


def check_rows(dataset, model):
    source, date, *_ = GATE_TABLES[dataset]
    need = 100 if model == "MMM" else 8
    return (f"SELECT CASE WHEN count(*) < {need} THEN 'FAIL' ELSE 'PASS' END AS status, "
            f"count(*)::DOUBLE AS metric FROM {recent(source, date, model)}")


CHECKS = {"fill_rate": check_fill, "distribution_shape": check_shape,
          "zero_variance": check_variance, "date_continuity": check_continuity,
          "channel_collinearity": check_collinearity, "segment_balance": check_balance,
          "autocorrelation": check_autocorr, "min_row_count": check_rows}


def check_rows_of(*names: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, '{model}' AS model, '{name}' AS check_name, status, "
        f"metric FROM ({CHECKS[name](dataset, model)})"
        for name in names for dataset in GATE_TABLES for model in HAS[name])


for _query, _name in [
    ("gate_fill_rate", "fill_rate"), ("gate_shape", "distribution_shape"),
    ("gate_variance", "zero_variance"), ("gate_continuity", "date_continuity"),
    ("gate_collinearity", "channel_collinearity"), ("gate_balance", "segment_balance"),
    ("gate_autocorr", "autocorrelation"), ("gate_rows", "min_row_count"),
]:
    ORACLES[_query] = GATED + check_rows_of(_name)

DECIDED = f"""SELECT dataset, model, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL'
  WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS decision
FROM ({check_rows_of(*CHECKS)}) GROUP BY dataset, model"""
ORACLES["gate_decision"] = GATED + DECIDED
ORACLES["gate_overall"] = GATED + f"""SELECT dataset, CASE WHEN bool_or(decision = 'PASS')
  THEN 'PASS' WHEN bool_or(decision = 'WARN') THEN 'WARN' ELSE 'FAIL' END AS overall_decision
FROM ({DECIDED}) GROUP BY dataset"""


ORACLES["candidate_list"] = GATED + f""", dn AS ({DECIDED}),
rg AS (SELECT 'gold_engagement' AS dataset, week AS day FROM gold
       UNION ALL SELECT 'gold_events', activity_date FROM gold_events),
mm AS (SELECT dataset, max(day) AS max_date FROM rg GROUP BY dataset),
yy AS (SELECT unnest({list(YEARS)}) AS model, unnest({list(YEARS.values())}) AS years)
SELECT dn.dataset, dn.model, years || 'yr  ' || (max_date - to_years(years))::DATE || ' → '
    || max_date AS label,
  (SELECT count(*) FROM rg WHERE rg.dataset = dn.dataset AND day >= max_date - to_years(years))
    AS rows, decision <> 'FAIL' AND dn.model IN ('BOCPD', 'MMM') AS ran, decision AS quality
FROM dn JOIN mm ON mm.dataset = dn.dataset JOIN yy ON yy.model = dn.model
WHERE NOT (dn.dataset = 'gold_events' AND dn.model = 'MMM')"""

# --- transforms --------------------------------------------------------------------------

ORACLES["clip_1_99"] = """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a,
  quantile_cont(l_extendedprice, 0.99) AS b, quantile_cont(l_quantity, 0.01) AS c,
  quantile_cont(l_quantity, 0.99) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, round(greatest(a, least(b, l_extendedprice)), 3)
  AS l_extendedprice, round(greatest(c, least(d, l_quantity)), 3) AS l_quantity
FROM lineitem, q"""

ORACLES["quarter_parse"] = """SELECT o_orderkey, CASE
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    THEN date_trunc('quarter', o_orderdate)::DATE
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
  WHEN o_orderstatus = 'F' THEN date_trunc('year', o_orderdate)::DATE
  ELSE o_orderdate::DATE END AS parsed FROM orders"""

ORACLES["apply_transforms"] = f"""WITH {EVENTS},
l AS (SELECT *, ln(1 + greatest(amount, 0)) AS la,
        CASE WHEN event_type <> 'error' THEN amount END AS f,
        CASE WHEN day(activity_date) % 4 <> 3 THEN amount END AS g FROM gold_events),
k AS (SELECT activity_date, last_value(v IGNORE NULLS) OVER (ORDER BY activity_date) AS v
      FROM (SELECT activity_date, max(g) AS v FROM l GROUP BY 1)),
q AS (SELECT quantile_cont(la, 0.01) AS a, quantile_cont(la, 0.99) AS b,
        quantile_cont(amount, 0.01) AS c, quantile_cont(amount, 0.99) AS d,
        quantile_cont(f, 0.5) AS m FROM l)
SELECT activity_date, event_type, count(*) AS n,
  round(sum(greatest(a, least(b, la))), 4) AS amount, round(sum(coalesce(f, m)), 3) AS filled,
  round(sum(coalesce(g, v)), 3) AS carried,
  round(sum(greatest(c, least(d, amount))), 3) AS clipped
FROM l JOIN k USING (activity_date), q GROUP BY activity_date, event_type"""

# --- channels and roles ------------------------------------------------------------------

ALL_CHANNELS = [*GOLD_CHANNELS, "competitor_spend"]
ORACLES["channel_groups"] = f"WITH {GOLD}, v AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS channel, avg(s / (abs(m) + 1e-9)) AS cv FROM (SELECT stddev_samp({c}) "
    f"AS s, avg({c}) AS m FROM gold GROUP BY week)" for c in ALL_CHANNELS) + """),
g AS (SELECT *, CASE WHEN channel LIKE '%compet%' THEN 'competitor' WHEN cv < 0.01
        THEN 'broadcast' ELSE 'field' END AS channel_group FROM v)
SELECT channel, round(cv, 4) AS cv, channel_group,
  CASE WHEN channel_group = 'field' THEN 'sum' ELSE 'mean' END AS agg,
  CASE channel_group WHEN 'field' THEN 0.3 WHEN 'broadcast' THEN 0.6 ELSE 0.0 END::DOUBLE
    AS decay FROM g"""

ORACLES["dataset_roles"] = f"""WITH {GOLD}
SELECT unnest(['anomaly', 'entity', 'lifecycle', 'product', 'target', 'week']) AS role,
  unnest(['is_anomaly', 'hcp_id', 'lifecycle_stage', 'product', 'sales', 'week'])
    AS column_name,
  unnest([NULL, NULL, NULL, (SELECT product FROM gold GROUP BY product
    ORDER BY count(*) DESC, product LIMIT 1), NULL, NULL]) AS value"""

ORACLES["channel_params"] = f"WITH {GOLD}\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS channel, round(sum({c}), 1) AS total, '{g}' AS channel_group, "
    f"'{a}' AS agg, {d}::DOUBLE AS decay, {h}::DOUBLE AS hill_alpha FROM gold"
    for c, g, a, d, h in [
        *[(c, "field", "sum", 0.3, 0.8) for c in GOLD_CHANNELS[:5]],
        ("tv_grps", "broadcast", "mean", 0.6, 2.0),
        ("competitor_spend", "competitor", "mean", 0.0, 2.0)])

# --- attribution -------------------------------------------------------------------------

PLAIN = f"WITH {GOLD}, {market()}, {FEATURES}, {CARRY}, {HALF}, {SAT}"
ORACLES["adstock"] = f"""{PLAIN} SELECT week, round(f2f_ads, 4) AS f2f_ads,
  round(samples_ads, 4) AS samples_ads, round(tv_grps_ads, 4) AS tv_grps_ads FROM st"""
ORACLES["hill"] = f"""{PLAIN} SELECT week, round(f2f_sat, 6) AS f2f_sat,
  round(email_opens_sat, 6) AS email_opens_sat, round(tv_grps_sat, 6) AS tv_grps_sat FROM st"""
ORACLES["channel_meta"] = f"{PLAIN} " + " UNION ALL ".join(
    f"SELECT '{c}' AS channel, '{'B' if c == 'tv_grps' else 'A'}' AS channel_type, "
    f"{d}::DOUBLE AS decay, {a}::DOUBLE AS hill_alpha, round({c}_half, 4) AS hill_k FROM hf"
    for c, (d, a) in CARRIED.items())
ORACLES["model_matrix"] = f"{attributed()} SELECT week, split, round(y, 5) AS y, " + ", ".join(
    f'round("X_{c}", 5) AS "X_{c}"' for c in FEATURE_NAMES) + " FROM mx"

_PAIRS = [(a, b) for i, a in enumerate(FEATURE_NAMES) for b in FEATURE_NAMES[i:]]
ORACLES["gram_matrix"] = f"{attributed()} SELECT count(*) AS n, round(sum(y), 3) AS sum_y, " \
    "round(sum(y * y), 3) AS sum_yy, round(" + " + ".join(
        f'sum("X_{c}" * y)' for c in FEATURE_NAMES) + ", 3) AS sum_xy, round(" + " + ".join(
        f'sum("X_{a}" * "X_{b}")' for a, b in _PAIRS) + \
    ", 2) AS gram FROM mx WHERE split = 'train'"
ORACLES["design_collinearity"] = f"{attributed()} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, "
    f'round(corr("X_{a}", "X_{b}"), 5) AS r FROM mx'
    for a, b in _PAIRS if a != b) + ") WHERE abs(r) > 0.3"

GIVEN = f"{attributed()}, {CONTRIBS}, {FITTED}, {CHANGES}, {SHIFTS}"
ORACLES["given_fit"] = f"""{GIVEN} SELECT week, split, round(y_actual, 5) AS y_actual,
  round(y_predicted, 5) AS y_predicted, round(residual, 5) AS residual,
  round(residual_z, 5) AS residual_z FROM fz"""
ORACLES["given_mape"] = f"{GIVEN} SELECT split, round(mape, 4) AS mape, n FROM er"

# --- change-points -----------------------------------------------------------------------

PRIORS = """
sr AS (SELECT product, week, sales, ln(greatest(sales, 1e-6)) AS x,
         row_number() OVER (PARTITION BY product ORDER BY week) - 1 AS t FROM mk),
df AS (SELECT *, x - lag(x) OVER (PARTITION BY product ORDER BY t) AS dx FROM sr),
pr AS (SELECT product, avg(x) FILTER (t < 180) AS mu_0,
         CASE WHEN var_pop(dx) FILTER (t < 180) > 0 THEN var_pop(dx) FILTER (t < 180)
              ELSE var_pop(x) FILTER (t < 180) END AS beta_0 FROM df GROUP BY product)
"""

FILTER = """
rc AS (
  SELECT product, -1::BIGINT AS t, [1.0::DOUBLE] AS r, [mu_0] AS mu, [beta_0] AS beta,
         mu_0, beta_0 FROM pr
  UNION ALL
  SELECT product, t, list_transform(list_concat([list_sum(joint) / 52],
           list_transform(joint, lambda v: v * (1 - 1.0 / 52))),
           lambda v: v / list_sum(joint)) AS r,
         list_concat([mu_0], list_transform(mu, lambda m, i: (i * m + x) / (i + 1))) AS mu,
         list_concat([beta_0], list_transform(beta, lambda b, i: b + i * (x - mu[i]) ** 2
           / (2 * (i + 1)))) AS beta, mu_0, beta_0
  FROM (SELECT rc.product, sr.t, sr.x, rc.mu, rc.beta, rc.mu_0, rc.beta_0,
          list_transform(rc.r, lambda v, i: v * exp(
            lgamma(1 + (i - 1) / 2.0 + 0.5) - lgamma(1 + (i - 1) / 2.0)
            - 0.5 * ln(2 * pi() * (1 + (i - 1) / 2.0))
            - 0.5 * ln(rc.beta[i] * (i + 1) / ((1 + (i - 1) / 2.0) * i))
            - (1 + (i - 1) / 2.0 + 0.5) * ln(1 + (sr.x - rc.mu[i]) ** 2
              / (2 * (1 + (i - 1) / 2.0) * rc.beta[i] * (i + 1)
                 / ((1 + (i - 1) / 2.0) * i))))) AS joint
        FROM rc JOIN sr ON sr.product = rc.product AND sr.t = rc.t + 1)),
pb AS (SELECT product, sr.week, t, sr.sales, sr.x AS log_sales, list_sum(r[1:4]) AS cp_prob,
         list_sum(list_transform(r, lambda v, i: (i - 1) * v)) AS exp_run_length
       FROM rc JOIN sr USING (product, t))
"""

PEAKS = """
lv AS (SELECT product, t, round(cp_prob, 12) AS p FROM pb),
fl AS (SELECT *, sum(s) OVER (PARTITION BY product ORDER BY t) AS f FROM (SELECT *,
         CASE WHEN p = lag(p) OVER (PARTITION BY product ORDER BY t) THEN 0 ELSE 1 END AS s
       FROM lv)),
ff AS (SELECT product, f, min(t) AS a, max(t) AS b, min(p) AS p FROM fl GROUP BY product, f),
tp AS (SELECT product, p, (a + b) // 2 AS t FROM (SELECT *,
         lag(p) OVER (PARTITION BY product ORDER BY f) AS l,
         lead(p) OVER (PARTITION BY product ORDER BY f) AS n FROM ff)
       WHERE p > l AND p > n AND p >= 0.3),
rk AS (SELECT *, row_number() OVER (PARTITION BY product ORDER BY p DESC, t DESC) AS k
       FROM tp),
kp AS (SELECT product, 0::BIGINT AS k, []::BIGINT[] AS kept FROM pr UNION ALL
  SELECT kp.product, rk.k, CASE WHEN len(list_filter(kept, lambda o: abs(o - rk.t) < 8)) > 0
    THEN kept ELSE list_append(kept, rk.t) END
  FROM kp JOIN rk ON rk.product = kp.product AND rk.k = kp.k + 1),
cc AS (SELECT product, unnest(kept) AS t FROM (SELECT product, max_by(kept, k) AS kept
       FROM kp GROUP BY product))
"""

SERIES = f"WITH RECURSIVE {STEP}, {market('step', 'week, product')}, {PRIORS}"
ORACLES["series_priors"] = f"""{SERIES} SELECT product, round(mu_0, 6) AS mu_0,
  round(beta_0, 6) AS beta_0 FROM pr"""
ORACLES["bocpd_probs"] = f"""{SERIES}, {FILTER} SELECT product, week, t,
  round(log_sales, 6) AS log_sales, round(cp_prob, 6) AS cp_prob,
  round(exp_run_length, 4) AS exp_run_length FROM pb"""
ORACLES["cp_candidates"] = f"""{SERIES}, {FILTER}, {PEAKS} SELECT product, week, t,
  round(cp_prob, 6) AS cp_prob, round(exp_run_length, 4) AS exp_run_length
FROM pb JOIN cc USING (product, t)"""
ORACLES["cp_context"] = f"""{SERIES}, {FILTER}, {PEAKS} SELECT pb.product, cc.t AS cp_t, pb.t,
  week, round(sales, 2) AS sales, round(cp_prob, 4) AS cp_prob
FROM pb JOIN cc ON cc.product = pb.product AND pb.t BETWEEN cc.t - 8 AND cc.t + 8"""
ORACLES["cp_deltas"] = f"""{SERIES}, {FILTER}, {PEAKS} SELECT pb.product, cc.t AS cp_t,
  round(min_by(sales, pb.t), 2) AS before, round(max_by(sales, pb.t), 2) AS after,
  round(max_by(sales, pb.t) - min_by(sales, pb.t), 2) AS delta
FROM pb JOIN cc ON cc.product = pb.product AND pb.t BETWEEN cc.t - 8 AND cc.t + 8
GROUP BY pb.product, cc.t"""

# --- integration, validation, drift ------------------------------------------------------

REPORT = """
zr AS (SELECT cp_week, coalesce(sum(pre) FILTER (kind = 'channel'), 0) AS tp,
  coalesce(sum(post) FILTER (kind = 'channel'), 0) AS tq,
  coalesce(sum(pre) FILTER (kind = 'channel' AND feature <> 'tv_grps_sat'), 0) AS fp,
  coalesce(sum(post) FILTER (kind = 'channel' AND feature <> 'tv_grps_sat'), 0) AS fq,
  max(coalesce(post, 0) - coalesce(pre, 0)) FILTER (feature = 'lc_num') AS lc,
  max((coalesce(post, 0) - coalesce(pre, 0)) / (abs(coalesce(pre, 0)) + 1e-9))
    FILTER (feature = 'competitor_spend') AS cs FROM sh GROUP BY cp_week),
zz AS (SELECT cp_week, avg(residual_z) AS z FROM cp JOIN fz ON week >= cp_week
  AND week < cp_week + 56 GROUP BY cp_week),
rp AS (SELECT cp_week, round((tq - tp) / (abs(tp) + 1e-9), 4) AS total_contrib_shift_rel,
  round((fq - fp) / (abs(fp) + 1e-9), 4) AS field_contrib_shift_rel,
  round(lc, 4) AS lifecycle_shift, round(cs, 4) AS competitor_shift_rel,
  round(coalesce(z, 0), 4) AS residual_z_post
  FROM cp LEFT JOIN zr USING (cp_week) LEFT JOIN zz USING (cp_week)),
cl AS (SELECT *, CASE WHEN residual_z_post > 2.5 THEN 'artifact_trx_spike_candidate'
  WHEN field_contrib_shift_rel > 0.1 AND field_contrib_shift_rel /
    (total_contrib_shift_rel + 1e-9) > 0.7 THEN 'new_channel_spike_candidate'
  WHEN field_contrib_shift_rel > 0.1 THEN 'legit_spike_candidate'
  WHEN lifecycle_shift > 0.5 THEN 'organic_lifecycle_event'
  WHEN competitor_shift_rel > 0.3 THEN 'competitive_spend_event'
  ELSE 'unclassified' END AS classification FROM rp)
"""
ORACLES["integration_report"] = f"""{GIVEN}, {REPORT} SELECT cp_week,
  round(total_contrib_shift_rel, 2) AS total_contrib_shift_rel,
  round(field_contrib_shift_rel, 2) AS field_contrib_shift_rel,
  round(lifecycle_shift, 3) AS lifecycle_shift,
  round(competitor_shift_rel, 2) AS competitor_shift_rel,
  round(residual_z_post, 3) AS residual_z_post, classification FROM cl"""
ORACLES["root_cause_counts"] = f"""{GIVEN}, {REPORT}
SELECT classification, count(*) AS n FROM cl GROUP BY classification"""
ORACLES["channel_shifts"] = f"""{GIVEN} SELECT cp_week, feature, kind, round(pre, 5) AS pre,
  round(post, 5) AS post FROM sh"""
ORACLES["recent_trends"] = f"""{GIVEN},
rw AS (SELECT * FROM cb WHERE week IN (SELECT week FROM fv ORDER BY week DESC LIMIT 12)),
rm AS (SELECT feature, avg(contribution) AS m, min(week) AS from_week, max(week) AS to_week
       FROM rw GROUP BY feature)
SELECT feature, round(m, 5) AS mean_contribution, from_week, to_week,
  round(m / (abs(sum(m) OVER ()) + 1e-9) * 100, 2) AS share_pct,
  row_number() OVER (ORDER BY abs(m) DESC, feature) AS trend_rank FROM rm"""

VALIDATED = "WITH RECURSIVE " + attributed()[5:] + f""", {CONTRIBS}, {FITTED},
sr AS (SELECT 'market' AS product, week, sales, log_sales AS x, week_idx AS t FROM fx),
df AS (SELECT *, x - lag(x) OVER (ORDER BY t) AS dx FROM sr),
pr AS (SELECT product, avg(x) FILTER (t < 180) AS mu_0, var_pop(dx) FILTER (t < 180) AS beta_0
       FROM df GROUP BY product),
{FILTER}, {PEAKS},
cw AS (SELECT week FROM pb JOIN cc USING (product, t)),
inc AS (""" + " UNION ALL ".join(
    f"SELECT '{i}' AS id, DATE '{a}' AS a, DATE '{b}' AS b" for i, a, b in INCIDENTS) + """),
hit AS (SELECT id, (SELECT count(*) FROM cw WHERE week BETWEEN a - 42 AND b + 42) AS n,
          (SELECT count(*) FROM cw WHERE week BETWEEN a AND b AND dayofweek(week) = 1) AS q,
          (SELECT coalesce(avg(abs(residual_z)), 0) FROM fz WHERE week BETWEEN a AND b) AS z
        FROM inc),
tr AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS channel, {e} AS effect, {GIVEN_BETAS[c + '_sat']} / (SELECT {c}_sat_std "
    f"FROM sc) AS found" for c, e in TRUE_EFFECTS.items()) + """),
tk AS (SELECT *, row_number() OVER (ORDER BY found, channel) AS fk,
         row_number() OVER (ORDER BY effect, channel) AS ek FROM tr),
rv AS (SELECT avg(abs(found - effect) / (abs(effect) + 1e-12)) AS err,
         count(*) FILTER (fk <> ek) AS wrong FROM tk),
vc AS (
  SELECT 'V-01 planted step found' AS check_name, n > 0 AS ok, n::DOUBLE AS metric FROM
    (SELECT count(*) AS n FROM cw WHERE abs(week - DATE '1999-01-04') <= 42)
  UNION ALL SELECT 'V-02 organic change-point found', NULL, NULL
  UNION ALL SELECT 'V-03 no change-point in artifact', q = 0, q FROM hit WHERE id = 'INC-001'
  UNION ALL SELECT 'V-04 change-point in ' || id, n > 0, n FROM hit WHERE id <> 'INC-001'
  UNION ALL SELECT 'V-05 artifact residual is large', z > 3, round(z, 4) FROM hit
    WHERE id = 'INC-001'
  UNION ALL SELECT 'V-06 residual is low in ' || id, z < 3, round(z, 4) FROM hit
    WHERE id <> 'INC-001'
  UNION ALL SELECT 'V-07 coefficient order', wrong = 0, wrong FROM rv
  UNION ALL SELECT 'V-08 recovery error', err < 0.25, round(err, 4) FROM rv
  UNION ALL SELECT 'V-09 in-sample error', mape < 10, round(mape, 4) FROM er
    WHERE split = 'train'
  UNION ALL SELECT 'V-10 hold-out error', mape < 15, round(mape, 4) FROM er
    WHERE split = 'test'),
vs AS (SELECT check_name, CASE WHEN ok THEN 'PASS' WHEN NOT ok THEN 'FAIL' ELSE 'SKIP' END
         AS status, round(metric, 3) AS metric FROM vc)
"""
ORACLES["validation_checks"] = f"{VALIDATED} SELECT * FROM vs"
ORACLES["validation_counts"] = f"{VALIDATED} SELECT status, count(*) AS n FROM vs GROUP BY status"


def periods(source: str, date: str) -> str:
    span = f"(SELECT max({date}) - min({date}) FROM {source})"
    first = f"(SELECT min({date}) FROM {source})"
    return (f"(SELECT *, CASE WHEN {date} - {first} <= {span} * 0.25 THEN 'reference' "
            f"WHEN {date} - {first} >= {span} * 0.75 THEN 'comparison' END AS period "
            f"FROM {source})")


def psi(name: str, bucketed: str) -> str:
    return f"""SELECT '{name}' AS name, sum((p - q) * ln(p / q)) AS psi, count(*) AS n_buckets
FROM (SELECT greatest(c / sum(c) OVER (), 1e-6) AS p, greatest(r / sum(r) OVER (), 1e-6) AS q
  FROM (SELECT bucket, count(*) FILTER (period = 'reference') AS r,
    count(*) FILTER (period = 'comparison') AS c FROM ({bucketed}) GROUP BY bucket))"""


BANDED = ("SELECT name, round(psi, 5) AS psi, n_buckets, CASE WHEN psi < 0.1 THEN 'stable' "
          "WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS band FROM (")
ORACLES["psi_segment"] = f"WITH {GOLD} {BANDED}" + " UNION ALL ".join(
    psi(c, f"SELECT period, {c} AS bucket FROM {periods('gold', 'week')} "
           f"WHERE period IS NOT NULL AND {c} IS NOT NULL")
    for c in ["product", "segment", "lifecycle_stage"]) + ")"

TENTHS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"


def numeric_psi(c: str, source: str, date: str) -> str:
    p = periods(source, date)
    edges = (f"(SELECT list_distinct(quantile_cont({c}::DOUBLE, {TENTHS})) FROM {p} "
             f"WHERE period = 'reference')")
    return psi(c, f"SELECT period, len(list_filter(e, lambda x: x < {c})) AS bucket FROM {p}, "
                  f"(SELECT {edges} AS e) WHERE period IS NOT NULL")


ORACLES["psi_numeric"] = f"WITH {GOLD}, {EVENTS} {BANDED}" + " UNION ALL ".join([
    numeric_psi("amount", "gold_events", "activity_date"),
    numeric_psi("sales", "gold", "week"), numeric_psi("trx", "gold", "week")]) + ")"

ORACLES["acf_hints"] = f"WITH {GOLD}, {market(by='week, product')}\n" + " UNION ALL ".join(
    f"SELECT product, count(*) AS n, {k} AS lag, round(corr(x, p), 5) AS acf FROM (SELECT "
    f"product, sales AS x, lag(sales, {k}) OVER (PARTITION BY product ORDER BY week) AS p "
    f"FROM mk) GROUP BY product" for k in range(1, 7))

_FACT = "week,sales,trx,competitor_spend"
_SETTINGS = {
    "BOCPD": "hazard=0.004;note=Tune hazard based on expected changepoint frequency; 1/250 ≈ one "
             "change per ~5 years weekly.;observation_model=StudentT;suggested_columns={n};"
             "truncate=500",
    "MMM": "baseline_formula=intercept + seasonality;channels={c};kpi={k};"
           "note=Add adstock/lag transforms for spend columns before fitting.",
    "PSI": "comparison_period=last quartile of date range;date_column={d};n_bins=10;"
           "note=PSI < 0.1 = stable; 0.1–0.2 = moderate shift; > 0.2 = significant drift.;"
           "psi_threshold=0.2;reference_period=first quartile of date range",
    "ARIMA": "framework_options=statsmodels SARIMA, Prophet, NeuralProphet;"
             "note=Run ADF test on target series first; d=1 if non-stationary.;"
             "order_d=1;order_p=check PACF;order_q=check ACF;seasonal_period=52;"
             "suggested_target={k}",
}


def _settings(dataset: str, model: str) -> str:
    numbers = "sales,trx,competitor_spend" if dataset == "gold_engagement" else "amount"
    return _SETTINGS[model].format(
        n=numbers, k=numbers.split(",")[0],
        c="competitor_spend" if dataset == "gold_engagement" else "",
        d="" if dataset == "gold_engagement" else "activity_date")


_USED = {
    ("gold_engagement", "BOCPD"): _FACT + ",region",
    ("gold_engagement", "MMM"): _FACT + ",product,segment,lifecycle_stage,region",
    ("gold_engagement", "PSI"): _FACT + ",product,segment,lifecycle_stage",
    ("gold_engagement", "ARIMA"): _FACT,
    ("gold_events", "BOCPD"): "activity_date,amount",
    ("gold_events", "MMM"): "activity_date,amount,event_type",
    ("gold_events", "PSI"): "activity_date,amount,event_type",
    ("gold_events", "ARIMA"): "activity_date,amount",
}
ORACLES["tune_hints"] = f"WITH {GOLD}, {EVENTS}, sat AS (SELECT (max(w) - min(w)) // 7 + 1 AS n " \
    "FROM (SELECT activity_date + (6 - dayofweek(activity_date))::INT AS w FROM gold_events))\n" \
    + " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{m}' AS model, "
        + ("(SELECT n FROM sat)" if (t, m) == ("gold_events", "BOCPD") else
           f"(SELECT count(*) FROM {'gold' if t == 'gold_engagement' else 'gold_events'})")
        + f"::BIGINT AS row_count, '{used}' AS columns_used, '{_settings(t, m)}' AS params"
        for (t, m), used in _USED.items())

# --- product filter, text dates, any decay, optimum, many buckets ------------------------

ORACLES["product_rollup"] = f"""WITH {GOLD}
SELECT week, product, round(coalesce(sum(sales), 0), 2) AS sales,
  round(coalesce(sum(f2f), 0), 2) AS f2f, round(avg(tv_grps), 3) AS tv_grps
FROM gold WHERE is_anomaly = 0 AND product = 'PROMO' GROUP BY week, product"""

ORACLES["text_dates_run"] = f"""WITH {EVENTS},
t AS (SELECT amount, CASE user_id % 5
    WHEN 0 THEN date_trunc('quarter', activity_date)::DATE
    WHEN 1 THEN date_trunc('quarter', activity_date)::DATE
    WHEN 2 THEN activity_date
    WHEN 3 THEN date_trunc('year', activity_date)::DATE END AS date FROM gold_events)
SELECT date, count(*) AS n_rows, round(coalesce(sum(amount), 0), 2) AS amount,
  (SELECT count(*) FROM t WHERE date IS NULL) AS n_unparsed
FROM t WHERE date IS NOT NULL GROUP BY date"""

ORACLES["adstock_decays"] = f"""WITH {GOLD}, {market()},
n AS (SELECT week, f2f, row_number() OVER (ORDER BY week) AS i FROM mk)
SELECT a.week, round(a.f2f, 3) AS none, round(sum(b.f2f * power(0.99, a.i - b.i)), 3) AS most,
  round(sum(b.f2f), 3) AS whole
FROM n a JOIN n b ON b.i <= a.i GROUP BY a.week, a.f2f"""

ORACLES["mmm_optimum"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, true AS converged, 0.0::DOUBLE AS off" for c in FEATURE_NAMES)

ORACLES["psi_many"] = f"WITH {EVENTS} {BANDED}" + psi(
    "user_id", f"SELECT period, user_id AS bucket FROM {periods('gold_events', 'activity_date')} "
               "WHERE period IS NOT NULL AND user_id IS NOT NULL") + ")"

# --- dates by vote, lags, chains, streams, states ----------------------------------------

ORACLES["date_forms"] = "WITH o AS (SELECT o_orderdate::DATE AS day FROM orders)\n" + " UNION ALL ".join(
    f"SELECT '{form}' AS form, {day}::DATE AS day, count(*) AS n FROM o GROUP BY 2"
    for form, day in {"named": "day", "day_first": "day", "month_first": "day", "long": "day",
                      "short": "day", "month": "date_trunc('month', day)",
                      "name_year": "date_trunc('month', day)"}.items())

LAGS = f"""WITH RECURSIVE {GOLD}, {market(by='week, product')},
lg AS (""" + " UNION ALL ".join(
    f"SELECT product, count(*) AS n, {k} AS lag, corr(x, p) AS acf FROM (SELECT "
    f"product, sales AS x, lag(sales, {k}) OVER (PARTITION BY product ORDER BY week) AS p "
    f"FROM mk) GROUP BY product" for k in range(1, 7)) + """),
ac AS (SELECT product, n, list(acf ORDER BY lag) AS r FROM lg GROUP BY product, n),
dl AS (
  SELECT product, n, r, 1 AS k, [r[1]] AS phi, r[1] AS pacf FROM ac
  UNION ALL
  SELECT product, n, r, k + 1,
    list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a * phi[k + 1 - j]), a), a
  FROM (SELECT *, (r[k + 1] - list_dot_product(phi, list_reverse(r[1:k])))
          / (1 - list_dot_product(phi, r[1:k])) AS a FROM dl WHERE k < 6)),
pf AS (SELECT product, n, k AS lag, r[k] AS acf, pacf FROM dl)"""
ORACLES["pacf_hints"] = f"""{LAGS}
SELECT product, n, lag, round(acf, 5) AS acf, round(pacf, 5) AS pacf FROM pf"""
ORACLES["order_hints"] = f"""{LAGS}
SELECT product,
  (coalesce(min(lag) FILTER (abs(pacf) <= 1.96 / sqrt(n)), 7) - 1)::INTEGER AS p,
  (coalesce(min(lag) FILTER (abs(acf) <= 1.96 / sqrt(n)), 7) - 1)::INTEGER AS q
FROM pf GROUP BY product"""

_A = "-3.969683028665376e+01 2.209460984245205e+02 -2.759285104469687e+02 1.383577518672690e+02 " \
     "-3.066479806614716e+01 2.506628277459239e+00"
_B = "-5.447609879822406e+01 1.615858368580409e+02 -1.556989798598866e+02 6.680131188771972e+01 " \
     "-1.328068155288572e+01 1.0"
_C = "-7.784894002430293e-03 -3.223964580411365e-01 -2.400758277161838e+00 " \
     "-2.549732539343734e+00 4.374664141464968e+00 2.938163982698783e+00"
_D = "7.784695709041462e-03 3.224671290700398e-01 2.445134137142996e+00 3.754408661907416e+00 1.0"


def _poly(coefficients: str, x: str) -> str:
    return " + ".join(f"{c}::DOUBLE * pow({x}, {len(coefficients.split()) - 1 - i})"
                      for i, c in enumerate(coefficients.split()))


def _tail(p: str) -> str:
    u = f"sqrt(-2 * ln({p}))"
    return f"(({_poly(_C, u)}) / ({_poly(_D, u)}))"


ORACLES["chain_diagnostics"] = f"""
WITH w AS (SELECT date_trunc('week', o_orderdate)::DATE AS week, o_orderpriority AS chain,
    count(*)::DOUBLE AS n_orders, sum(o_totalprice) AS value FROM orders GROUP BY ALL),
g AS (SELECT week, chain FROM (SELECT DISTINCT week FROM w), (SELECT unnest(
    ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']) AS chain)),
a AS (SELECT chain, week, unnest(['n_orders', 'value']) AS parameter,
    unnest([coalesce(n_orders, 0), coalesce(value, 0)]) AS x FROM g LEFT JOIN w USING (week, chain)),
o AS (SELECT *, row_number() OVER (PARTITION BY parameter, chain ORDER BY week) AS i,
    count(*) OVER (PARTITION BY parameter, chain) AS m FROM a),
s AS (SELECT parameter, chain || CASE WHEN i <= m // 2 THEN 'a' ELSE 'b' END AS half,
    CASE WHEN i <= m // 2 THEN i ELSE i - (m - m // 2) END AS t, x, m // 2 AS n
  FROM o WHERE i <= m // 2 OR i > m - m // 2),
q AS (SELECT *, (rank() OVER (PARTITION BY parameter ORDER BY x)
      + (count(*) OVER (PARTITION BY parameter, x) - 1) / 2 - 0.375)
    / (count(*) OVER (PARTITION BY parameter) + 0.25) AS p FROM s),
z AS (SELECT *, CASE WHEN p < 0.02425 THEN {_tail('p')} WHEN p > 1 - 0.02425 THEN -{_tail('(1 - p)')}
    ELSE ({_poly(_A, '((p - 0.5) * (p - 0.5))')}) * (p - 0.5)
      / ({_poly(_B, '((p - 0.5) * (p - 0.5))')}) END AS z FROM q),
c AS (SELECT *, z - avg(z) OVER (PARTITION BY parameter, half) AS c FROM z),
v AS (SELECT u.parameter, u.half, u.n, w.t - u.t AS lag, sum(u.c * w.c) / max(u.n) AS a
  FROM c u JOIN c w ON w.parameter = u.parameter AND w.half = u.half AND w.t >= u.t GROUP BY ALL),
l AS (SELECT parameter, n, lag, avg(a) AS a FROM v GROUP BY ALL),
h AS (SELECT parameter, half, n, avg(x) AS m, var_samp(x) AS v, avg(z) AS mz FROM z GROUP BY ALL),
k AS (SELECT parameter, n, count(*) AS halves, avg(m) AS mean, avg(v) AS within,
    var_samp(m) AS between, var_samp(mz) AS between_z FROM h GROUP BY ALL),
r AS (SELECT l.parameter, lag, k.*, CASE WHEN lag = 0 THEN 1 ELSE
    1 - (a0 * n / (n - 1) - a) / (a0 + between_z) END AS rho
  FROM l JOIN k USING (parameter, n) JOIN (SELECT parameter, a AS a0 FROM l WHERE lag = 0) USING (parameter)),
e AS (SELECT parameter, lag // 2 AS i, sum(rho) AS pair FROM r WHERE lag < n - n % 2 GROUP BY ALL),
f AS (SELECT parameter, i, min(pair) OVER (PARTITION BY parameter ORDER BY i) AS low FROM e),
t AS (SELECT parameter, 2 * sum(low) - 1 AS tau FROM f f1
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.parameter = f1.parameter AND e.i <= f1.i AND e.pair <= 0)
  GROUP BY parameter)
SELECT parameter, halves * n AS n, round(mean, 3) AS mean,
  round(sqrt(within * (n - 1) / n + between), 3) AS sd,
  round(sqrt((within * (n - 1) / n + between) / within), 6) AS rhat,
  round(halves * n / greatest(tau, 1 / log10(halves * n)), 2) AS ess_bulk
FROM k JOIN t USING (parameter)"""

ORACLES["online_probs"] = ORACLES["bocpd_probs"]

_LINE_TYPES = [("l_orderkey", 0), ("l_partkey", 0), ("l_suppkey", 0), ("l_linenumber", 0),
               ("l_quantity", 1), ("l_extendedprice", 1), ("l_discount", 1), ("l_tax", 1),
               ("l_returnflag", 0), ("l_linestatus", 0), ("l_shipdate", 0)]
ORACLES["merged_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) AS n_rows, round(1 - count({c}) / count(*), 6) AS null_pct, "
    + (f"count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
       f"round(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5), 4) AS skewness, "
       f"round(avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2) - 3, 4) AS kurtosis, "
       f"round(min({c}), 4) AS value_min, round(max({c}), 4) AS value_max, "
       f"true AS distinct_near, true AS median_near FROM (SELECT {c}::DOUBLE AS {c} FROM lineitem), "
       f"(SELECT avg({c}::DOUBLE) AS m FROM lineitem)" if measure else
       "0 AS n, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS skewness, "
       "NULL::DOUBLE AS kurtosis, NULL::DOUBLE AS value_min, NULL::DOUBLE AS value_max, "
       "true AS distinct_near, NULL::BOOLEAN AS median_near FROM lineitem")
    for c, measure in _LINE_TYPES)

ORACLES["spec_sheet"] = """
SELECT name, 'Orders' AS category, 'Columns, by year and status, of ' || name AS description,
  string_agg(c, ',' ORDER BY c) AS columns
FROM (SELECT DISTINCT replace(lower(o_orderpriority), ' ', '_') AS name,
        'y' || year(o_orderdate) || '_' || lower(o_orderstatus) AS c FROM orders) GROUP BY name"""

# --- what becomes of whole runs ----------------------------------------------------------

ORACLES["text_dates_outcomes"] = f"""
SELECT 'gold_events' AS dataset, 'BOCPD' AS model, count(date) >= 8 AS ran
FROM ({ORACLES["text_dates_run"]})"""

# The narrower of two facts with one signal takes no part; no runner exists for its best model.
ORACLES["suppressed_run"] = """
SELECT 'gold_daily' AS dataset, 'PSI' AS model, count(*) < 0 AS ran,
  'no runner for model ''PSI''' AS reason FROM events"""

# Measures in their order: one goes if it moves with a better one inside the model's window.
ORACLES["measure_model_map"] = f"""
WITH dc AS ({ORACLES["gate_decision"]}), {GOLD},
w AS (SELECT model, t, abs(corr(sales, trx)) AS st, abs(corr(sales, competitor_spend)) AS sc,
    abs(corr(trx, competitor_spend)) AS tc
  FROM gold, (VALUES ('BOCPD', 0.85, 24), ('MMM', 0.90, 12)) AS p(model, t, months)
  WHERE week >= (SELECT max(week) FROM gold) - to_months(months) GROUP BY ALL),
k AS (SELECT model, unnest(['sales', 'trx', 'competitor_spend']) AS measure,
    unnest([true, NOT coalesce(st > t, false), NOT coalesce(sc > t, false)
      AND (coalesce(st > t, false) OR NOT coalesce(tc > t, false))]) AS kept FROM w),
r AS (SELECT 'gold_engagement' AS dataset, measure, model FROM k JOIN dc USING (model)
    WHERE kept AND dataset = 'gold_engagement' AND decision <> 'FAIL'
  UNION ALL SELECT dataset, 'amount', model FROM dc
    WHERE dataset = 'gold_events' AND model = 'BOCPD' AND decision <> 'FAIL'),
m AS (SELECT unnest(['gold_engagement', 'gold_engagement', 'gold_engagement', 'gold_events']) AS dataset,
    unnest(['sales', 'trx', 'competitor_spend', 'amount']) AS measure)
SELECT dataset, measure, coalesce(string_agg(model, ',' ORDER BY model), '') AS models
FROM m LEFT JOIN r USING (dataset, measure) GROUP BY ALL"""

ORACLES["change_payload"] = f"""{SERIES}, {FILTER}, {PEAKS},
cw AS (SELECT cc.product, cc.t, count(*) AS n FROM cc JOIN pb
    ON pb.product = cc.product AND pb.t BETWEEN cc.t - 8 AND cc.t + 8 GROUP BY ALL),
cl AS (SELECT product, count(*) AS n, string_agg(week::VARCHAR, ',' ORDER BY cp_prob DESC, t) AS listed,
    string_agg(cw.n::VARCHAR, ',' ORDER BY cp_prob DESC, t) AS sizes
  FROM cc JOIN pb USING (product, t) JOIN cw USING (product, t) GROUP BY product)
SELECT 'gold_engagement' AS dataset, pr.product AS measure, coalesce(n, 0)::INTEGER AS n_changepoints,
  52 AS hazard, round(mu_0, 5) AS mu_0, coalesce(listed, '') AS by_probability,
  coalesce(sizes, '') AS context_sizes
FROM pr LEFT JOIN cl ON cl.product = pr.product"""
