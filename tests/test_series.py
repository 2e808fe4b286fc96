"""Change-points, attribution, integration and the gate on small made series."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.knowledge import Channel, SeriesConfig
from tidemark.operators import attribution as A
from tidemark.operators import changepoint as C
from tidemark.operators import gate as G
from tidemark.operators import integration as I
from tidemark.operators import rollup as R
from tidemark.operators.selection import dedup_measures, recent_window
from tidemark.operators.transforms import apply_transforms, steps_for
from tidemark.session import inline_rows


def slow_filter(x, mu_0, beta_0, hazard):
    """The recursion written out for one run length at a time."""
    runs = {0: (1.0, mu_0, beta_0)}
    out = []
    for v in x:
        new, change = {}, 0.0
        for n, (w, mu, beta) in runs.items():
            k, a = 1.0 + n, 1.0 + n / 2
            s = beta * (k + 1) / (a * k)
            p = math.exp(math.lgamma(a + .5) - math.lgamma(a)) / math.sqrt(
                2 * math.pi * a * s) * (1 + (v - mu) ** 2 / (2 * a * s)) ** (-a - .5)
            change += w * p / hazard
            new[n + 1] = (w * p * (1 - 1 / hazard), (k * mu + v) / (k + 1),
                          beta + k * (v - mu) ** 2 / (2 * (k + 1)))
        new[0] = (change, mu_0, beta_0)
        total = sum(w for w, _, _ in new.values())
        runs = {n: (w / total, m, b) for n, (w, m, b) in new.items()}
        out.append((sum(w for n, (w, _, _) in runs.items() if n <= 3),
                    sum(n * w for n, (w, _, _) in runs.items())))
    return np.array(out)


def stepped(n=80, at=50, size=1.0):
    noise = np.sin(np.arange(n) * 1.7) * 0.05
    return 5 + noise + np.where(np.arange(n) >= at, size, 0.0)


def test_filter_matches_plain_recursion():
    x = stepped()
    short, expected = C.run_length_filter(x, x.mean(), 0.01, 52.0)
    slow = slow_filter(x, x.mean(), 0.01, 52.0)
    assert np.allclose(short, slow[:, 0], atol=1e-12)
    assert np.allclose(expected, slow[:, 1], atol=1e-9)
    assert ((short >= 0) & (short <= 1 + 1e-12)).all()


def test_filter_survives_outliers_and_constants():
    for x in ([1.0] * 30, [0.0] * 20 + [1e9] + [0.0] * 20):
        short, expected = C.run_length_filter(np.array(x), 0.0, 1e-6, 52.0)
        assert np.isfinite(short).all() and np.isfinite(expected).all()


def test_step_is_found_in_every_series(spark):
    rows = [(s, t, float(v)) for s, size in (("up", 1.0), ("down", -1.0))
            for t, v in enumerate(stepped(size=size))]
    series = inline_rows(spark, {"series": "string", "week": "int", "x": "double"}, rows)
    probs = C.change_probabilities(series, ["series"], "week", "x")
    found = C.change_candidates(probs, ["series"]).collect()
    assert {r["series"] for r in found} == {"up", "down"}
    assert all(abs(r["t"] - 50) <= 6 for r in found)
    again = C.change_probabilities(series.repartition(5), ["series"], "week", "x")
    assert again.exceptAll(probs).count() == 0


def test_peak_rules(spark):
    p = [0.9, 0.1, 0.5, 0.5, 0.5, 0.1, 0.2, 0.1, 0.6, 0.1, 0.1, 0.1, 0.1, 0.7, 0.2, 0.95]
    probs = inline_rows(spark, {"s": "string", "t": "int", "cp_prob": "double"},
                        [("a", t, v) for t, v in enumerate(p)])
    # Ends never count, the flat top counts at its middle, 0.2 is too low;
    # of 0.6 at 8 and 0.7 at 13 the higher stays, 0.5 at 3 is far enough from 13.
    found = C.change_candidates(probs, ["s"]).orderBy("t").collect()
    assert [r["t"] for r in found] == [3, 13]


def test_context_is_clipped_at_the_ends(spark):
    probs = inline_rows(spark, {"s": "string", "t": "int", "value": "double"},
                        [("a", t, float(t)) for t in range(20)])
    near = probs.where("t = 2").select("s", "t")
    rows = C.context_windows(probs, near, ["s"])
    assert rows.count() == 11
    delta = C.change_deltas(rows, ["s"], "value").head()
    assert (delta["before"], delta["after"], delta["delta"]) == (0.0, 10.0, 10.0)


CONFIG = SeriesConfig(
    target="sales", channels=(Channel("calls", "field", "sum", 0.3),
                              Channel("tv", "broadcast", "mean", 0.6),
                              Channel("rival", "competitor", "mean", 0.0)))


def made_matrix(spark, n=220, series=("a", "b")):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 4))
    beta = {"a": np.array([0.3, 0.2, -0.2, 0.1]), "b": np.array([0.1, 0.4, -0.1, -0.2])}
    noise = rng.normal(scale=0.02, size=n)
    rows = []
    for s in series:
        y = 4.0 + x @ beta[s] + noise
        for i in range(n):
            rows.append((s, dt.date(2020, 1, 6) + dt.timedelta(weeks=i),
                         "train" if i < 180 else "test", float(y[i]), *map(float, x[i])))
    names = {"X_calls_sat": "double", "X_tv_sat": "double", "X_rival": "double",
             "X_week_idx": "double"}
    return beta, inline_rows(spark, {"series": "string", "week": "date", "split": "string",
                                     "y": "double", **names}, rows)


def test_map_recovers_known_coefficients(spark):
    beta, matrix = made_matrix(spark)
    found = {(r["series"], r["feature"]): r for r in A.map_fit(matrix, CONFIG, ["series"]).collect()}
    for s in ("a", "b"):
        for f, b in zip(["calls_sat", "tv_sat", "rival", "week_idx"], beta[s]):
            assert found[s, f]["beta"] == pytest.approx(b, abs=0.01)
        assert found[s, "tv_sat"]["sigma"] == pytest.approx(0.02, abs=0.005)


def test_map_keeps_signs_and_is_a_maximum():
    rng = np.random.default_rng(5)
    x, n = rng.normal(size=(120, 3)), 120
    y = 2.0 + x @ np.array([-0.4, 0.3, 0.2]) + rng.normal(scale=0.1, size=n)
    kinds = ["channel", "competitor", "control"]
    gram = (x.T @ x)[np.triu_indices(3)]
    a, b, s, _, converged = A.solve_map(n, y.sum(), y @ y, x.sum(0), x.T @ y, gram, kinds)
    assert b[0] == 0.0 and b[1] == 0.0 and b[2] > 0.1

    def cost(a, b, s):
        r = y - a - x @ b
        return (r @ r / (2 * s * s) + n * math.log(s) + s * s / (2 * 0.3**2)
                + (a - y.mean()) ** 2 / (2 * 0.25) + b[0]**2 / 0.5 + b[1]**2 / 0.18
                + b[2]**2 / 0.5)
    best = cost(a, b, s)
    for step in (1e-3, -1e-3):
        assert cost(a + step, b, s) > best and cost(a, b, s + step) > best
        assert cost(a, b + np.array([0, 0, step]), s) > best
    assert cost(a, b + np.array([1e-3, 0, 0]), s) > best
    assert cost(a, b - np.array([0, 1e-3, 0]), s) > best


def test_contributions_add_up(spark):
    _, matrix = made_matrix(spark)
    betas = A.map_fit(matrix, CONFIG, ["series"])
    wide = A.wide_contributions(A.contributions(matrix, betas, ["series"]), ["series"],
                                ["calls_sat", "tv_sat", "rival", "week_idx"])
    total = F.col("baseline") + F.col("residual")
    for f in ["calls_sat", "tv_sat", "rival", "week_idx"]:
        total = total + F.col(f"contrib_{f}")
    assert wide.where(F.abs(total - F.col("y_actual")) > 1e-9).count() == 0
    errors = {r["split"]: r["mape"] for r in A.mape(
        wide.where("series = 'a'"), ["series"]).collect()}
    assert errors["train"] < 3 and errors["test"] < 3


def test_range_join_equals_brute_force(spark):
    points = inline_rows(spark, {"s": "string", "lo": "date", "hi": "date"}, [
        ("a", dt.date(2020, 1, 1), dt.date(2020, 3, 1)),
        ("a", dt.date(1969, 12, 1), dt.date(1970, 2, 1)),
        ("b", dt.date(2020, 2, 1), dt.date(2020, 2, 2))])
    days = [dt.date(1969, 11, 1) + dt.timedelta(days=11 * i) for i in range(30)]
    days += [dt.date(2019, 12, 20) + dt.timedelta(days=3 * i) for i in range(40)]
    rows = inline_rows(spark, {"s": "string", "d": "date"},
                       [(s, d) for s in "ab" for d in days])
    joined = I.binned_range_join(points, rows, ["s"], "lo", "hi", "d", 56)
    brute = points.alias("p").join(rows.alias("r"), F.expr(
        "p.s = r.s AND r.d >= p.lo AND r.d < p.hi")).count()
    assert joined.count() == brute > 0


@pytest.mark.parametrize("z,field,total,lc,comp,expected", [
    (2.6, 0.0, 0.0, 0.0, 0.0, "artifact_trx_spike_candidate"),
    (0.0, 0.2, 0.21, 0.0, 0.0, "new_channel_spike_candidate"),
    (0.0, 0.2, 0.9, 0.0, 0.0, "legit_spike_candidate"),
    (0.0, 0.1, 0.1, 0.6, 0.0, "organic_lifecycle_event"),
    (0.0, 0.0, 0.0, None, 0.4, "competitive_spend_event"),
    (0.0, 0.2, -1e-9, 0.0, 0.0, "legit_spike_candidate"),
    (0.0, 0.0, 0.0, None, None, "unclassified")])
def test_root_cause(spark, z, field, total, lc, comp, expected):
    row = inline_rows(spark, {
        "residual_z_post": "double", "field_contrib_shift_rel": "double",
        "total_contrib_shift_rel": "double", "lifecycle_shift": "double",
        "competitor_shift_rel": "double"}, [(z, field, total, lc, comp)])
    assert row.select(I.root_cause()).head()[0] == expected


def test_dedup_keeps_the_better_ranked(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2 + 1).cast("double").alias("b"),
        (F.col("id") % 7).cast("double").alias("c"), F.lit(4.0).alias("d"),
        F.lit(None).cast("double").alias("e"))
    rows = dedup_measures(df, ["a", "b", "c", "d", "e"]).orderBy("measure_rank").collect()
    assert [r["kept"] for r in rows] == [True, False, True, True, True]


def test_recent_window_on_leap_day(spark):
    df = spark.sql("SELECT d FROM VALUES (DATE'2024-02-29'), (DATE'2023-02-28'), "
                   "(DATE'2023-02-27') t(d)")
    assert recent_window(df, "d", 1).count() == 2


def test_transform_steps(spark):
    assert steps_for("ARIMA", ["[a] log1p(column)", "[b] forward-fill or median"]) == [
        "log1p", "ffill"]
    assert steps_for("PSI", ["[a] log1p(column)", "[b] forward-fill or median"]) == ["median"]
    df = spark.sql("SELECT d, x FROM VALUES (DATE'2024-01-01', 1D), (DATE'2024-01-02', NULL), "
                   "(DATE'2024-01-03', 9D) t(d, x)")
    filled = apply_transforms(df, {"x": ["ffill"]}, "d").orderBy("d").collect()
    assert [r["x"] for r in filled] == [1.0, 1.0, 9.0]
    keyed = apply_transforms(df.selectExpr("1 AS k", "*"), {"x": ["ffill"]}, "d", ["k"])
    assert [r["x"] for r in keyed.orderBy("d").collect()] == [1.0, 1.0, 9.0]
    middle = apply_transforms(df, {"x": ["median"]}).orderBy("d").collect()
    assert [r["x"] for r in middle] == [1.0, 5.0, 9.0]


def test_segment_rollup_averages_cells(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (DATE'2024-01-01', 'a', 1D, 0.1D), (DATE'2024-01-01', 'a', 1D, 0.3D),
        (DATE'2024-01-01', 'b', 5D, 0.8D), (DATE'2024-01-01', NULL, 9D, 0.9D)
        t(d, seg, amount, win_rate)""")
    row = R.segment_rollup(df, "d", ["amount", "win_rate"], ["seg"]).head()
    assert row["amount"] == 7.0 and row["n_seg"] == 2
    assert row["win_rate"] == pytest.approx((0.2 + 0.8) / 2)


def test_gap_check_and_decisions(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(20) if not 5 < i < 12]
    calendar = inline_rows(
        spark, {"dataset": "string", "date": "date", "n_rows": "bigint", "value": "double"},
        [("t", d, 5, float(i)) for i, d in enumerate(days)])
    limits = {"BOCPD": G.limits_for("BOCPD"), "ARIMA": G.limits_for("ARIMA")}
    grains = inline_rows(spark, {"dataset": "string", "given": "string"}, [("t", "weekly")])
    checks = G.date_continuity(calendar, grains, limits)
    found = {r["model"]: (r["status"], r["metric"]) for r in checks.collect()}
    assert found == {"BOCPD": ("WARN", 7.0), "ARIMA": ("FAIL", 14.0)}
    assert G.autocorrelation(calendar, {"ARIMA": limits["ARIMA"]}).head()["status"] == "PASS"
    decided = G.model_decisions(checks.unionByName(
        G.min_row_count(calendar, grains.select("dataset"), limits)))
    assert {r["model"]: r["decision"] for r in decided.collect()} == {
        "BOCPD": "WARN", "ARIMA": "FAIL"}
    assert G.overall_decisions(decided).head()["overall_decision"] == "WARN"


def test_whole_run(spark, folder, tmp_path):
    import json

    from tidemark.plans import insights, report
    from tidemark.plans.gold import gold_engagement
    from tidemark.session import stored_table

    fact = stored_table(gold_engagement(spark, folder))
    run = insights.run_insights(spark, {"gold_engagement": fact})
    doc = json.loads(report.payload_json(run).head()["payload"])
    assert doc["metadata"]["routing"]["top_model"] == "MMM"
    assert set(doc["quality_gate"]["per_model"]) == {"MMM", "PSI", "ARIMA", "BOCPD"}
    sales = doc["model_signals"]["BOCPD"]["signals"]["by_measure"]["sales"]
    assert len(sales["cp_probs_series"]) > 50
    mix = doc["model_signals"]["MMM"]["signals"]["by_measure"]["sales"]
    assert mix["model_fit"]["estimator"] == "map" and mix["channel_contributions"]
    stripped = json.loads(report.payload_json(run, strip_series=True).head()["payload"])
    assert "cp_probs_series" not in stripped["model_signals"]["BOCPD"]["signals"][
        "by_measure"]["sales"]
    report.write_payloads(run, str(tmp_path / "out"))
    report.write_routing(run.metadata, str(tmp_path / "routes"))
    assert (tmp_path / "out" / "dataset=gold_engagement").exists()
    assert (tmp_path / "routes").exists()
