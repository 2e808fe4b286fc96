"""SQL twins of the metadata queries: column meanings, table types, keys and routes."""

from __future__ import annotations

import re

from tidemark import knowledge as K
from tidemark.plans.queries import DATAMARTS

# Table: column -> type family, as the parquet files declare them.
SCHEMAS = {
    "region": "r_regionkey:n r_name:s",
    "nation": "n_nationkey:n n_name:s n_regionkey:n",
    "customer": "c_custkey:n c_name:s c_nationkey:n c_acctbal:n c_mktsegment:s",
    "supplier": "s_suppkey:n s_name:s s_nationkey:n s_acctbal:n",
    "part": "p_partkey:n p_name:s p_brand:s p_type:s p_size:n p_retailprice:n",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:s o_totalprice:n o_orderdate:d "
              "o_orderpriority:s",
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:n "
                "l_extendedprice:n l_discount:n l_tax:n l_returnflag:s l_linestatus:s "
                "l_shipdate:d",
    "events": "event_id:n ts:d user_id:n event_type:s value:n props:s",
    "documents": "doc_id:n text:s lang:s source:s n_chars:n",
    "embeddings": "vec_id:n embedding:o label:n",
    "pages": "page_id:n url:s html:s",
    "benchmark": "item_id:n text:s",
    "labels": "doc_id:n quality:n toxic:n",
    "conversations": "conv_id:n turn:n role:s text:s",
}
BUILT = {
    "gold_engagement": "week:d hcp_id:n product:s segment:s region:s sales:n trx:n f2f:n "
                       "samples:n email_opens:n speaker:n phone_call:n tv_grps:n "
                       "competitor_spend:n is_anomaly:n lifecycle_stage:s",
    "gold_events": "activity_date:d user_id:n event_type:s amount:n",
    "gold_daily": "activity_date:d member_id:n event_type:s amount:n points:n",
    "dim_hcp": "hcp_id:n segment:s country_name:s is_active:o",
    "dim_hcp_sk": "user_sk:n segment:s country_name:s is_active:o",
}
FAMILY = {"n": "numeric", "s": "string", "d": "date", "o": "other"}

# Distinct texts of the built tables, from the tables they are built from.
BUILT_COUNTS = {
    ("gold_engagement", "product"): "SELECT count(DISTINCT p_type) FROM part",
    ("gold_engagement", "segment"): "SELECT count(DISTINCT c_mktsegment) FROM customer",
    ("gold_engagement", "region"): "SELECT count(DISTINCT r_name) FROM region",
    ("gold_engagement", "lifecycle_stage"):
        "SELECT count(DISTINCT year(date_trunc('week', o_orderdate))) FROM orders",
    ("gold_events", "event_type"): "SELECT count(DISTINCT event_type) FROM events",
    ("gold_daily", "event_type"): "SELECT count(DISTINCT event_type) FROM events",
    **{(t, c): f"SELECT count(DISTINCT {x}) FROM customer JOIN nation ON "
               f"c_nationkey = n_nationkey"
       for t in ("dim_hcp", "dim_hcp_sk")
       for c, x in (("segment", "c_mktsegment"), ("country_name", "n_name"))},
}


def quoted(items) -> str:
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]::VARCHAR[]"


def catalog_rows(tables: dict[str, str], counts) -> str:
    rows = []
    for dataset, columns in tables.items():
        for i, column in enumerate(columns.split()):
            name, kind = column.split(":")
            n = f"({counts(dataset, name)})" if kind == "s" else "NULL"
            rows.append(f"SELECT '{dataset}' AS dataset, {i} AS ordinal, '{name}' AS name, "
                        f"'{FAMILY[kind]}' AS dtype_family, {n} AS n_distinct")
    return "ct AS (" + " UNION ALL ".join(rows) + ")"


def full_counts(dataset: str, name: str) -> str:
    return BUILT_COUNTS.get((dataset, name), f"SELECT count(DISTINCT {name}) FROM {dataset}")


WORDS = "list_filter(list_distinct(string_split({}, '_')), lambda w: w <> '')"

DICTIONARY = "dc AS (SELECT *, " + WORDS.format("cand") + " AS cw FROM (" + " UNION ALL ".join(
    f"SELECT '{s}' AS st, {i} AS rk, unnest({quoted(names)}) AS cand"
    for i, (s, names) in enumerate(K.SUBTYPE_LISTS)) + "))"
SHORT = (f"ab AS (SELECT unnest({quoted(K.ABBREVIATIONS)}) AS norm, "
         f"unnest({quoted(K.ABBREVIATIONS.values())}) AS expanded_name)")


def ends(c: str, items) -> str:
    return "(" + " OR ".join(f"ends_with({c}, '{i}')" for i in items) + ")"


def starts(c: str, items) -> str:
    return "(" + " OR ".join(f"starts_with({c}, '{i}')" for i in items) + ")"


MEANING = f"""{DICTIONARY}, {SHORT},
nm AS (SELECT ct.*, trim(regexp_replace(lower(trim(name)), '[^a-z0-9]+', '_', 'g'), '_') AS norm
       FROM ct),
ex AS (SELECT nm.*, expanded_name, coalesce(expanded_name, norm) AS m FROM nm
       LEFT JOIN ab USING (norm)),
fe AS (SELECT *, {WORDS.format('m')} AS w, {ends('m', K.KEY_SUFFIXES)} AS is_key,
         {starts('m', K.FLAG_PREFIXES)} OR {ends('m', K.FLAG_SUFFIXES)} AS is_flag,
         list_contains({quoted(K.DATE_ENDINGS)}, list_last(string_split(m, '_'))) AS date_end,
         regexp_matches(m, '{K.ROLLING_WINDOW_PATTERN}') AS rolling,
         {ends('m', K.INDEX_SUFFIXES)} OR {starts('m', K.INDEX_PREFIXES)} AS is_index
       FROM ex),
ht AS (SELECT dataset, ordinal,
         min_by(st, rk) FILTER (cand = m) AS exact_st,
         min_by(st, rk) FILTER (cand <> m AND (list_has_all(w, cw) OR list_has_all(cw, w)))
           AS part_st,
         min_by(st, rk) FILTER (list_has_any(w, cw) AND
           (st <> 'date' OR list_has_any(w, {quoted(K.DATE_WORDS)}))) AS word_st
       FROM fe, dc WHERE NOT (st = 'date' AND is_index) GROUP BY dataset, ordinal),
nn AS (SELECT fe.*, CASE WHEN is_key THEN 'key' WHEN is_flag THEN 'flag'
         WHEN date_end THEN 'date' WHEN rolling THEN NULL
         ELSE coalesce(exact_st, part_st) END AS named,
         CASE WHEN is_key OR is_flag THEN 1.0 WHEN date_end THEN 0.8
         WHEN exact_st IS NOT NULL THEN 1.0 ELSE 0.8 END AS named_conf, exact_st, part_st, word_st
       FROM fe LEFT JOIN ht USING (dataset, ordinal)),
sp AS (SELECT dataset, ordinal, name, dtype_family, n_distinct, expanded_name,
         CASE WHEN named IS NOT NULL THEN named
           WHEN dtype_family = 'date' AND NOT is_index THEN 'date'
           WHEN NOT rolling AND word_st IS NOT NULL THEN word_st
           WHEN dtype_family = 'numeric' THEN 'unclassified_metric'
           WHEN dtype_family = 'string' AND n_distinct BETWEEN 1 AND 50
             THEN 'dimension_attribute' ELSE 'unknown' END AS subtype,
         (CASE WHEN named IS NOT NULL THEN
             least(named_conf, CASE WHEN expanded_name IS NULL THEN 1.0 ELSE 0.8 END)
           WHEN dtype_family = 'date' AND NOT is_index THEN 0.9
           WHEN NOT rolling AND word_st IS NOT NULL THEN 0.6
           WHEN dtype_family = 'numeric' THEN 0.5
           WHEN dtype_family = 'string' AND n_distinct BETWEEN 1 AND 50 THEN 0.4
           ELSE 0.0 END)::DOUBLE AS confidence,
         CASE WHEN named IS NOT NULL THEN CASE WHEN expanded_name IS NULL
             THEN 'candidate_list' ELSE 'abbreviation_expanded' END
           WHEN dtype_family = 'date' AND NOT is_index THEN 'heuristic_dtype'
           WHEN NOT rolling AND word_st IS NOT NULL THEN 'heuristic_token'
           WHEN dtype_family = 'numeric' THEN 'guardrail_metric'
           WHEN dtype_family = 'string' AND n_distinct BETWEEN 1 AND 50
             THEN 'heuristic_cardinality' ELSE 'unmatched' END AS match_source
       FROM nn)"""

FULL = "WITH " + catalog_rows({**SCHEMAS, **BUILT}, full_counts) + ", " + MEANING

DATAMART_ROWS = "dm AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS datamart, '{desc}' AS description, unnest({quoted(columns)}) AS col"
    for n, _, desc, columns in DATAMARTS) + ")"

HINT = lambda c: (f"CASE WHEN {ends(c, K.FACT_ENDINGS)} THEN 'fact' "
                  f"WHEN {ends(c, K.DIMENSION_ENDINGS)} THEN 'dimension' END")


def classes(with_datamarts: bool) -> str:
    best = (f"""{DATAMART_ROWS},
own AS (SELECT DISTINCT dataset, unnest([lower(name), lower(expanded_name)]) AS col FROM sp),
jc AS (SELECT dataset, datamart, s / (a + b - s) AS score FROM (SELECT dataset, datamart,
    (SELECT count(*) FROM dm WHERE dm.datamart = d.datamart AND col IN
      (SELECT col FROM own WHERE own.dataset = t.dataset AND col IS NOT NULL)) AS s,
    (SELECT count(*) FROM own WHERE own.dataset = t.dataset AND col IS NOT NULL) AS a,
    (SELECT count(*) FROM dm WHERE dm.datamart = d.datamart) AS b
  FROM (SELECT DISTINCT dataset FROM sp) t, (SELECT DISTINCT datamart FROM dm) d)
  WHERE s > 0),
be AS (SELECT dataset, arg_min(datamart, (-score, datamart)) AS datamart, max(score) AS score
       FROM jc GROUP BY dataset)""" if with_datamarts else
            "be AS (SELECT dataset, NULL::VARCHAR AS datamart, 0.0 AS score FROM sp "
            "GROUP BY dataset)")
    return f"""{best},
tc0 AS (SELECT sp.dataset, count(*) AS n_columns, CASE
    WHEN bool_or(subtype = 'date') AND bool_or(subtype IN ('measure', 'unclassified_metric'))
      THEN 'fact'
    WHEN bool_or(subtype = 'key') AND avg((subtype IN ('dimension_attribute', 'flag', 'key',
      'segment'))::INT) >= 0.5 THEN 'dimension' ELSE 'unknown' END AS structural
  FROM sp GROUP BY sp.dataset),
tc AS (SELECT dataset, n_columns, coalesce(CASE WHEN score >= 0.5 THEN {HINT('datamart')} END,
    structural) AS t0, CASE WHEN t0 = 'unknown' THEN coalesce({HINT('dataset')}, t0) ELSE t0 END
    AS table_type, datamart AS matched_datamart, coalesce(score, 0) AS match_score
  FROM tc0 LEFT JOIN be USING (dataset))"""


KEYS = f"""
ky AS (SELECT sp.dataset, table_type, name, lower(name) AS low,
         regexp_replace(lower(name), '(_sk|_id|_npi|_code|_key|_vid)$', '') AS stem
       FROM sp JOIN tc USING (dataset) WHERE subtype = 'key'),
pp AS (SELECT f.dataset AS fact, d.dataset AS dimension, f.name AS fact_key,
         d.name AS dimension_key, f.low = d.low AS same, f.stem = d.stem AND f.stem <> '' AS near
       FROM ky f, ky d WHERE f.table_type = 'fact' AND d.table_type = 'dimension'),
sk AS (SELECT fact, dimension, fact_key, dimension_key, 'name' AS matched_by FROM pp WHERE same
  UNION ALL SELECT fact, dimension, fact_key, dimension_key, 'stem' FROM pp p WHERE near AND
    NOT EXISTS (SELECT 1 FROM pp q WHERE q.same AND q.fact = p.fact
                AND q.dimension = p.dimension))
"""

RULES = "ru AS (" + " UNION ALL ".join(
    f"SELECT {i} AS o, '{r.model}' AS model, {quoted(r.required)} AS req, "
    f"{quoted(r.optional)} AS opt, {quoted(r.preferred)} AS pre, {quoted(r.use_cases)} AS uc"
    for i, r in enumerate(K.ROUTE_RULES)) + ")"

ROUTES = f"""{RULES},
su AS (SELECT dataset, list_distinct(list(subtype)) AS st, list_filter(list_concat(
         list(lower(name)) FILTER (subtype IN ('measure', 'unclassified_metric')),
         list(lower(expanded_name)) FILTER (subtype IN ('measure', 'unclassified_metric'))),
         lambda x: x IS NOT NULL) AS ms,
         coalesce(string_agg(name, ',' ORDER BY ordinal) FILTER
           (subtype = 'unclassified_metric'), '') AS flagged
       FROM sp GROUP BY dataset),
ih AS (SELECT fact AS dataset, list_distinct(list(subtype)) AS ist,
         string_agg(DISTINCT dimension, ',' ORDER BY dimension) AS dims
       FROM sk JOIN sp ON sp.dataset = sk.dimension WHERE subtype <> 'unknown' GROUP BY fact),
rt AS (SELECT tc.dataset, model, o, uc, matched_datamart, coalesce(dims, '')
         AS dimension_tables, flagged AS flagged_unclassified,
         list_concat(st, coalesce(ist, []::VARCHAR[])) AS eff,
         round((len(req) + 0.3 * len(list_filter(opt, lambda x: list_contains(eff, x)))
           + 0.5 * len(list_filter(pre, lambda x: list_contains(ms, x))))
           / (len(req) + 0.3 * len(opt) + 0.5 * len(pre)), 3)::DOUBLE AS confidence
       FROM tc JOIN su USING (dataset) LEFT JOIN ih USING (dataset), ru
       WHERE table_type = 'fact'
         AND list_has_all(list_concat(st, coalesce(ist, []::VARCHAR[])), req)),
rr AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY confidence DESC, o)
         AS route_rank FROM rt)"""

METADATA_ORACLES = {
    "column_subtypes": f"""{FULL} SELECT dataset, ordinal, name, dtype_family, subtype,
  confidence, match_source, expanded_name FROM sp""",
    "table_classes": f"""{FULL}, {classes(True)} SELECT dataset, n_columns, table_type,
  matched_datamart, round(match_score, 6) AS match_score FROM tc""",
    "datamart_jaccard": f"""{FULL}, {classes(True)} SELECT dataset, datamart,
  round(score, 6) AS score FROM jc""",
    "star_keys": f"{FULL}, {classes(False)}, {KEYS} SELECT * FROM sk",
    "model_routes": f"""{FULL}, {classes(False)}, {KEYS}, {ROUTES} SELECT dataset, model,
  confidence, route_rank, dimension_tables, flagged_unclassified FROM rr""",
    "route_use_cases": f"""{FULL}, {classes(True)}, {KEYS}, {ROUTES} SELECT dataset, model,
  CASE WHEN coalesce(d.description, '') <> '' THEN d.description || ' | ' ELSE '' END
    || array_to_string(uc, ' | ') AS use_cases
FROM rr LEFT JOIN (SELECT DISTINCT datamart, description FROM dm) d
  ON d.datamart = rr.matched_datamart""",
    "duplicate_signal": f"""{FULL}, {classes(False)}, {KEYS}, {ROUTES},
sg AS (SELECT dataset, string_agg(DISTINCT subtype, ',' ORDER BY subtype) AS signature FROM sp
       WHERE subtype IN ('date', 'measure', 'geography', 'segment', 'channel', 'key', 'flag')
       GROUP BY dataset),
tt AS (SELECT rr.dataset, model AS top_model, signature, n_columns,
         first_value(rr.dataset) OVER (PARTITION BY signature, model
           ORDER BY n_columns DESC, rr.dataset) AS main
       FROM rr JOIN sg USING (dataset) JOIN tc USING (dataset) WHERE route_rank = 1)
SELECT dataset, top_model, signature, dataset <> main AS is_duplicate_signal,
  CASE WHEN dataset <> main THEN main END AS signal_group_primary FROM tt""",
    "use_cases": f"""{FULL}, uc AS (""" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, {i} AS case_order, {quoted(w)} AS words, '{t}' AS use_case"
        for m, i, w, t in K.USE_CASES) + """),
cn AS (SELECT dataset, list(lower(name)) AS pn, list_filter(list_concat(list(lower(name)),
         list(lower(expanded_name))), lambda x: x IS NOT NULL) AS en FROM sp GROUP BY dataset),
ft AS (SELECT dataset, model, case_order, use_case, len(words) AS n, list_has_any(words,
         CASE WHEN model = 'BOCPD' THEN en ELSE pn END) AS ok FROM cn, uc)
SELECT dataset, model, case_order, use_case FROM ft WHERE ok OR (n = 0 AND NOT EXISTS
  (SELECT 1 FROM ft o WHERE o.dataset = ft.dataset AND o.model = ft.model AND o.ok))""",
    "display_columns": f"""{FULL} SELECT dataset, list_position({quoted(
        ["date", "measure", "channel", "segment", "geography", "key", "flag",
         "unclassified_metric", "dimension_attribute", "unknown"])}, subtype) - 1
  AS display_group, ordinal, name, subtype FROM sp""",
    "abbreviated_subtypes": "WITH " + catalog_rows(
        {"events_short": "SVC_DT:d npi_vod:n G1~Meeting-Type:s rx:n pt_note:s",
         "orders_short": "wk_end:d spend_last_90d:n week_idx:n terr:s first_name:s call_rate:n "
                         "order_num:d"},
        lambda t, c: {"G1~Meeting-Type": "SELECT count(DISTINCT event_type) FROM events",
                      "pt_note": "SELECT count(DISTINCT props) FROM events",
                      "terr": "SELECT count(DISTINCT o_orderpriority) FROM orders",
                      "first_name": "SELECT count(DISTINCT o_orderstatus) FROM orders"}[c]
    ).replace("~", " ") + f""", {MEANING} SELECT dataset, name, subtype, confidence,
  match_source, expanded_name, CASE WHEN name = 'spend_last_90d'
    THEN 'spend of the last quarter' END AS business_hint FROM sp""",
    "dead_columns": "WITH " + catalog_rows(
        {"orders_dead": "order_date:d sales:n revenue:n claim_id:n"}, None) +
    f""", {MEANING}, nl AS (SELECT count(*) FILTER (o_totalprice < 0) = 0 AS dead FROM orders)
SELECT name, CASE WHEN name = 'revenue' AND dead THEN 'unknown' ELSE subtype END AS subtype,
  CASE WHEN name = 'revenue' AND dead THEN 0.0 ELSE confidence END AS confidence
FROM sp, nl""",
    "channel_groups_by_name": "WITH " + catalog_rows(
        {"gold_engagement": BUILT["gold_engagement"]}, full_counts) + f""", {MEANING},
g AS (SELECT dataset, name AS channel, CASE WHEN regexp_matches(lower(name),
    '{"|".join(K.COMPETITOR_HINTS)}') THEN 'competitor' WHEN regexp_matches(lower(name),
    '{"|".join(K.BROADCAST_HINTS)}') THEN 'broadcast' ELSE 'field' END AS channel_group
  FROM sp WHERE subtype = 'channel' AND dtype_family <> 'string')
SELECT dataset, channel, channel_group, CASE WHEN channel_group = 'field' THEN 'sum'
  ELSE 'mean' END AS agg, CASE channel_group WHEN 'field' THEN 0.3 WHEN 'broadcast' THEN 0.6
  ELSE 0.0 END::DOUBLE AS decay FROM g""",
}

# Steps that others read several times are computed once, however a caller wraps the query.
for _name in ("column_subtypes", "display_columns"):
    METADATA_ORACLES[_name] = re.sub(
        r"\b(\w+) AS \((?=\s*SELECT)", r"\1 AS MATERIALIZED (", METADATA_ORACLES[_name])
