"""Rule tables: which column names mean what, which models need what, and when a check trips.

Every table here is small and fixed, so the DataFrames made from it are safe to broadcast.
Callers may pass their own tables in place of any of these.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------
# Names per column meaning. The order of the meanings decides ties.
# ---------------------------------------------------------------------------------------
CHANNEL_NAMES = """
f2f face_to_face f2f_short_call f2f_accompanied phone_call remote_call rte total_rte in_person
samples sample_drop drug_samples
speaker speaker_program msl peer_interaction
email_delivered email_opens email_clicks email_clicked
tp_email_delivered tp_email_opens tp_email_clicked tp_email_clicks
doximity doximity_opens epocrates epocrates_opens sermo sermo_impressions ehr_impressions ehr
impressions clicks grps tv_grps audio_impressions display_impressions video_impressions
standard_display_impressions standard_display_clicks programmatic_display_impressions
programmatic_video_impressions social_impressions social_clicks
channel_spend media_spend promo_spend detailing
""".split()

DATE_NAMES = """
week_end_date week_start_date month_end_date month_start_date period
fill_date fill_month fill_year fill_quarter service_date switch_date
first_diagnosis_date first_rx_date latest_rx_date date week month year quarter
rx_date event_date start_date end_date report_date as_of_date snapshot_date activity_date
invoice_date diagnosis_date yearmonth
""".split()

GEOGRAPHY_NAMES = """
territory terr zip zip_code region state country market territory_id geo district area zone
brick alignment
""".split()

MEASURE_NAMES = """
persistency trx nrx nbrx total_claims adherence_ratio fulfillment_rate rejection_rate
reversal_rate approval_rate market_share trx_count nrx_count patient_count net_flow
persistence_days gap_days total_fills total_days_supply avg_days_supply quantity days_supply
patient_oop patient_responsibility total_oop avg_oop total_patient_responsibility days_to_fill
total_patients diagnosed_patients treated_patients unprojected_market_size
projected_market_size share_of_new_patients drug_holiday_patients days_on_source_drug
gap_days_before_event persistency_at_switch time_in_line_days paid_claims rejected_claims
reversed_claims days_on_therapy dot sales revenue total_sales total_revenue spend total_spend
net_sales gross_sales competitor_spend baseline n_hcps n_patients n_rows n_weeks total_rte
total_calls total_samples total_touches f2f_calls virtual_calls email_touches active_days
channel_mix rte_delivered rte_opened rte_clicked days_since_previous_touch
num_of_additional_attendees total_adjusted_qty_sold amount wac total_volume
non_hemodialysis_volume non_hemodialysis_claims ic_vials eligible_vials ttd_vials
baseline_vials volume_potential goals points orders
""".split()

SEGMENT_NAMES = """
patient_status treatment_status line_of_therapy segment seg cohort category payer_channel
plan_type specialty indication_flag event_type previous_status lifecycle_stage anomaly_type
bucket meeting_type call_type call_channel interaction_type presc_or_non_presc hcp_segment
account_type decile product_type alignment_type
""".split()

SUBTYPE_LISTS = [
    ("channel", CHANNEL_NAMES),
    ("date", DATE_NAMES),
    ("geography", GEOGRAPHY_NAMES),
    ("measure", MEASURE_NAMES),
    ("segment", SEGMENT_NAMES),
]

# Name affixes and token sets.
KEY_SUFFIXES = ["_sk", "_id", "_npi", "_code", "_key", "_vid"]
FLAG_PREFIXES = ["is_", "has_"]
FLAG_SUFFIXES = ["_flag", "_indicator", "_ind", "_yn"]
INDEX_SUFFIXES = ["_idx", "_index", "_num", "_rank", "_bin", "_order", "_seq"]
INDEX_PREFIXES = ["n_", "num_"]
DATE_ENDINGS = ["date", "dt", "datetime", "timestamp", "ts"]
DATE_WORDS = [
    "date", "dt", "day", "week", "wk", "month", "mth",
    "year", "yr", "quarter", "qtr", "period", "time",
]
ROLLING_WINDOW_PATTERN = r"_last_\d+[dD]$"
RATE_WORDS = ["rate", "ratio", "pct", "percent", "share", "avg", "mean"]

# Abbreviation -> full name.
ABBREVIATIONS = {
    "wk_end": "week_end_date", "wk": "week", "mth": "month", "qtr": "quarter", "yr": "year",
    "trx": "trx", "nbrx": "nbrx", "nbx": "nbrx", "rx": "trx", "prod": "product",
    "pt": "patient", "hcp": "provider", "geo": "territory", "terr": "territory",
    "prdct": "product", "prscbr": "prescriber", "phrmcy": "pharmacy", "pat": "patient",
    "diag": "diagnosis", "dx": "diagnosis", "ndx": "nbrx", "payer_chnl": "payer_channel",
    "chnl": "channel", "mkt": "market", "seg": "segment", "rx_dt": "fill_date",
    "svc_dt": "service_date", "fill_dt": "fill_date", "srvc_dt": "service_date",
    "persistency_pct": "persistency", "adhr": "adherence_ratio", "adh": "adherence_ratio",
    "dot": "days_on_therapy", "lot": "line_of_therapy", "npi_vod": "npi_id",
    "crm_user_id": "crm_user_id", "g1_meeting_type": "meeting_type",
    "g1_interaction_type": "interaction_type",
}

# Table-name endings that hint at the table type.
FACT_ENDINGS = ["_fact", "_claims", "_fact_table"]
DIMENSION_ENDINGS = ["_dim", "_dimension", "_summary", "_lookup", "_ref", "_map"]


@dataclass(frozen=True)
class RouteRule:
    """What one model needs from a fact table."""

    model: str
    required: tuple
    optional: tuple
    preferred: tuple
    accepts: tuple
    use_cases: tuple


# Routing rules, in tie-break order.
ROUTE_RULES = [
    RouteRule(
        "BOCPD", ("date", "measure"), ("geography", "segment"),
        ("persistency", "trx", "nrx", "nbrx", "adherence_ratio", "total_claims"),
        ("unclassified_metric",),
        ("Weekly persistency trend across territory (Patient Analytics)",
         "Weekly TRx/NRx trend across territory (Provider Analytics)"),
    ),
    RouteRule(
        "MMM", ("date", "measure", "channel"), ("geography", "segment"),
        ("trx", "nrx", "sales", "total_sales", "market_share"),
        ("unclassified_metric",),
        ("Decompose sales/TRx drivers across promotional channels",
         "Estimate ROI and optimal channel mix",
         "Quantify HCP reach, frequency, and engagement saturation"),
    ),
    RouteRule(
        "PSI", ("date", "measure", "segment"), ("geography",),
        ("patient_count", "total_patients", "treated_patients", "net_flow"),
        ("unclassified_metric",),
        ("Detect shifts in patient segment distribution over time",
         "Monitor drug holiday or LOT progression drift"),
    ),
    RouteRule(
        "ARIMA", ("date", "measure"), ("geography",),
        ("trx", "nrx", "persistency", "market_share", "patient_count", "sales"),
        ("unclassified_metric",),
        ("Forecast weekly TRx over next N periods",
         "Decompose seasonality in market size"),
    ),
]

SIGNAL_SUBTYPES = ["date", "measure", "geography", "segment", "channel", "key", "flag"]


@dataclass(frozen=True)
class TransformRule:
    """A suggestion that fires when every threshold that is set is exceeded."""

    name: str
    subtypes: tuple
    suggestion: str
    skewness_gt: float | None = None
    kurtosis_gt: float | None = None
    null_pct_gt: float | None = None
    unique_gt: int | None = None
    max_gt: float | None = None
    grain: str | None = None
    strings_only: bool = False
    name_contains: tuple = ()


# Transform suggestions, in output order.
TRANSFORM_RULES = [
    TransformRule("log_transform", ("measure", "unclassified_metric"),
                  "log1p(column) — right-skewed distribution detected", skewness_gt=1.5),
    TransformRule("outlier_clip", ("measure", "unclassified_metric"),
                  "clip at 1st/99th percentile before further transforms", kurtosis_gt=5.0),
    TransformRule("weekly_aggregation", ("date",),
                  "resample to W-SAT, aggregate measures by sum (or mean for ratios)",
                  grain="daily"),
    TransformRule("null_imputation", ("measure", "unclassified_metric", "date"),
                  "forward-fill or median imputation — null rate exceeds 5%",
                  null_pct_gt=0.05),
    TransformRule("high_cardinality_encode", ("dimension_attribute", "segment"),
                  "consider target encoding or embedding — high-cardinality categorical",
                  unique_gt=50, strings_only=True),
    TransformRule("ratio_bound_check", ("measure",),
                  "values > 1.0 found in ratio column — check for scale mismatch "
                  "(may need /100)",
                  max_gt=1.0, name_contains=("rate", "ratio", "pct", "share")),
]

# Quality thresholds.
GLOBAL_LIMITS = {
    "min_fill_rate": 0.80,
    "fail_fill_rate": 0.50,
    "zero_variance_cv": 0.01,
    "min_row_count": 8,
    "min_measure_unique_count": 5,
}
MODEL_LIMITS = {
    "BOCPD": {
        "window_years": 2,
        "checks": ["fill_rate", "zero_variance", "date_continuity", "min_row_count",
                   "distribution_shape"],
        "min_periods": {"daily": 30, "weekly": 8, "monthly": 12, "quarterly": 4, "default": 8},
        "max_gap_periods": 4,
    },
    "MMM": {
        "window_years": 1,
        "checks": ["fill_rate", "zero_variance", "channel_collinearity", "min_row_count",
                   "distribution_shape"],
        "collinearity_threshold": 0.85,
        "min_channel_count": 2,
        "min_rows": 100,
        "target_grain": "auto",
    },
    "PSI": {
        "window_years": 1,
        "checks": ["fill_rate", "zero_variance", "segment_balance", "min_row_count"],
        "max_imbalance_ratio": 10.0,
        "min_segment_size": 30,
    },
    "ARIMA": {
        "window_years": 3,
        "checks": ["fill_rate", "zero_variance", "date_continuity", "min_row_count",
                   "autocorrelation", "distribution_shape"],
        "min_periods": {"daily": 120, "weekly": 16, "monthly": 24, "quarterly": 8,
                        "default": 16},
        "max_gap_periods": 4,
        "min_acf_lag1": 0.10,
    },
}
GRAIN_DAYS = {"daily": 1.0, "weekly": 7.0, "monthly": 30.5, "quarterly": 91.25}
HAZARD_BY_GRAIN = {"daily": 365, "weekly": 52, "monthly": 12}
DEFAULT_HAZARD = 52

# Change-point, attribution and validation constants.
TRAIN_PERIODS = 180
CP_THRESHOLD = 0.30
CP_MIN_DISTANCE = 8
CP_SHORT_RUN = 3
CP_CONTEXT = 8
PRE_WEEKS = 8
POST_WEEKS = 8
RESIDUAL_Z_LIMIT = 2.5
CONTRIB_SHIFT_LIMIT = 0.10
LAG_TOLERANCE_DAYS = 42
RESIDUAL_ARTIFACT_LIMIT = 3.0
RECOVERY_MEAN_LIMIT = 0.25
LIFECYCLE_ORDER = {"pre_launch": 0, "launch": 1, "growth": 2, "maturity": 3, "decline": 4}
LIFECYCLE_DEFAULT = 2
DEFAULT_DECAY = {"field": 0.30, "broadcast": 0.60, "competitor": 0.0}
BROADCAST_HINTS = ["impression", "grp", "tv", "display", "programmatic", "social", "digital",
                   "banner"]
COMPETITOR_HINTS = ["competitor", "compet", "rival", "generic"]

# Column-name hints for dataset roles, best hint first.
ROLE_HINTS = {
    "week": ["week", "date", "period", "week_ending", "week_start"],
    "entity": ["hcp_id", "doctor_id", "physician_id", "npi", "rep_id"],
    "product": ["product", "brand", "drug", "therapy", "molecule"],
    "anomaly": ["is_anomaly", "anomaly", "is_flagged", "flag"],
    "lifecycle": ["lifecycle_stage", "lifecycle", "phase", "stage", "lc_stage"],
    "target": ["sales", "revenue", "trx", "units", "scripts", "rx", "nrx"],
}
SECONDARY_TARGETS = ["trx", "nrx", "revenue", "units", "scripts", "rx"]

# Use-case wording by column names present.
# (model, order, any of these names, text); an empty list marks the default text.
USE_CASES = [
    ("BOCPD", 1, ["persistency", "adherence_ratio", "persistence_days"],
     "Weekly persistency trend monitoring across territory (Patient Analytics)"),
    ("BOCPD", 2, ["trx", "nrx", "nbrx", "trx_count", "nrx_count"],
     "Weekly TRx/NRx trend monitoring across territory (Provider Analytics)"),
    ("BOCPD", 99, [], "General time-series changepoint detection on available measures"),
    ("MMM", 1, ["channel", "payer_channel", "chnl", "payer", "fulfillment", "rejection"],
     "Decompose TRx/sales drivers across payer channels"),
    ("MMM", 2, ["spend", "cost", "budget", "investment", "detailing", "sample"],
     "Estimate ROI and contribution of promotional spend"),
    ("MMM", 99, [], "Marketing mix decomposition on available measures"),
    ("PSI", 1, ["line_of_therapy", "lot"],
     "LOT / drug holiday progression drift (Patient Analytics)"),
    ("PSI", 2, ["patient_status", "treatment_status"],
     "Patient segment distribution drift over time"),
    ("PSI", 3, ["payer_channel"], "Payer channel mix drift"),
    ("PSI", 99, [], "General population stability monitoring across segments"),
    ("ARIMA", 1, ["trx", "nrx", "nbrx", "trx_count", "nrx_count"],
     "Forecast weekly TRx/NRx over next N periods"),
    ("ARIMA", 2, ["market_share", "market_size", "projected_market_size"],
     "Decompose and forecast seasonality in market size / share"),
    ("ARIMA", 3, ["patient_count", "total_patients"],
     "Patient count trend forecasting with seasonal decomposition"),
    ("ARIMA", 99, [], "General seasonal trend modeling on available time-series measures"),
]
SPEND_WORDS = ["channel", "payer_channel", "chnl", "payer", "fulfillment", "rejection",
               "spend", "cost", "budget", "investment", "detailing", "sample"]


@dataclass(frozen=True)
class Channel:
    """One marketing channel: how it is rolled up and how long it carries over."""

    name: str
    group: str
    agg: str
    decay: float
    hill_alpha: float | None = None


@dataclass(frozen=True)
class SeriesConfig:
    """Column roles of one engagement fact and the settings of its time-series jobs."""

    target: str
    week: str = "week"
    entity: str | None = None
    product: str | None = None
    product_value: str | None = None
    anomaly: str | None = None
    lifecycle: str | None = None
    channels: tuple = field(default_factory=tuple)
    fourier_k: int = 2
    fourier_period: int = 52
    hill_alpha_field: float = 0.8
    hill_alpha_broadcast: float = 2.0
    train_weeks: int = TRAIN_PERIODS
    organic_cps: tuple = ()
    true_effects: tuple = ()

    def named(self, *groups):
        return [c.name for c in self.channels if c.group in groups]

    def rolled_by(self, agg):
        return [c.name for c in self.channels if c.agg == agg]

    def alpha_of(self, name):
        for c in self.channels:
            if c.name == name:
                if c.hill_alpha is not None:
                    return c.hill_alpha
                return self.hill_alpha_field if c.group == "field" else self.hill_alpha_broadcast
        return self.hill_alpha_field
