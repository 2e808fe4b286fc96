"""Linear carry-over, quantile passes, correlations, dates by vote, lags, chains, streams, states."""

import json
import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import curves, dates, numbers
from tidemark.operators import changepoint as C
from tidemark.operators import gate as G
from tidemark.operators import lags as LG
from tidemark.operators import online as ON
from tidemark.operators import posterior as PO
from tidemark.operators import preparation as PR
from tidemark.operators import profile_states as PS
from tidemark.operators import profiling as PF
from tidemark.plans import insights
from tidemark.plans.gold import dim_hcp, gold_engagement, gold_events
from tidemark.session import (
    StageRun, abandoned_runs, inline_rows, read_published, stage, stage_folder, stored_table)
from tidemark.sources import catalog, tables as stages


# --- carry-over --------------------------------------------------------------------------

def test_carry_over_of_any_series_and_decay(spark):
    rows = [(s, t, None if t % 7 == 0 else float(t % 5), 0.1 + (t % 3) / 3)
            for s in ("a", "b", None) for t in range(300 if s == "a" else 3)]
    df = spark.createDataFrame(rows, "s string, t int, x double, d double")
    decays = {"none": 0.0, "half": 0.5, "whole": 1.0, "more": 1.01, "own": F.col("d")}
    out = curves.adstocked(df, {n: (F.col("x"), d) for n, d in decays.items()}, ["s"], "t")
    assert out.columns == [*df.columns, *decays]
    found = {(r["s"], r["t"]): r for r in out.collect()}
    for s in ("a", "b", None):
        for name, decay in decays.items():
            carried = 0.0
            for _, t, x, d in [r for r in rows if r[0] == s]:
                carried = (x or 0.0) + carried * (d if name == "own" else decay)
                assert found[s, t][name] == pytest.approx(carried, rel=1e-9), (s, t, name)


def test_carry_over_of_a_hundred_thousand_periods(spark):
    df = spark.range(100_000).select(F.col("id").alias("t"), (F.col("id") % 101).cast("double").alias("x"))
    out = curves.adstocked(df, {"y": (F.col("x"), 0.9)}, [], "t")
    got = out.where("t % 9973 = 0 or t = 99999").orderBy("t").collect()
    x = np.arange(100_000) % 101
    carried, want = 0.0, []
    for t in range(100_000):
        carried = x[t] + 0.9 * carried
        if t % 9973 == 0 or t == 99_999:
            want.append(carried)
    assert [r["y"] for r in got] == pytest.approx(want, rel=1e-12)


def test_carry_over_of_nothing(spark):
    df = spark.createDataFrame([], "t int, x double")
    assert curves.adstocked(df, {"y": (F.col("x"), 0.5)}, [], "t").count() == 0


# --- quantiles and correlations ----------------------------------------------------------

def test_quantiles_take_six_passes_at_most(spark, monkeypatch):
    """Values from 1e-300 to 1e300, of both signs, with ties and neighbours one digit apart."""
    draw = np.random.default_rng(1)
    x = np.concatenate([10.0 ** draw.uniform(-300, 300, 6000), -(10.0 ** draw.uniform(-300, 300, 3000)),
                        np.full(4000, 7.0), np.nextafter(7.0, 8) + np.zeros(3000),
                        1e5 + np.arange(9000) * 2.0 ** -36, np.zeros(50), [5e-324, -5e-324]])
    passes = []
    for name in ("_by_exponent", "_narrowed", "_picked"):
        made = getattr(numbers, name)
        monkeypatch.setattr(numbers, name, lambda *a, made=made: passes.append(1) or made(*a))
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "x": x}))
    probs = [0.0, 0.01, 0.25, 0.4, 0.5, 0.6, 0.75, 0.99, 1.0]
    got = {r["prob"]: r["quantile"] for r in numbers.exact_quantiles(df, ["k"], "x", probs).collect()}
    ordered = np.sort(x)
    for p in probs:
        at = p * (len(x) - 1)
        a, b = ordered[math.floor(at)], ordered[math.ceil(at)]
        assert got[p] == a + (b - a) * (at - math.floor(at)), p
    assert len(passes) <= 6


def test_correlations_of_odd_columns(spark):
    draw = np.random.default_rng(2)
    n = 500
    a = draw.normal(1e6, 1, n)
    a = [float(v) for v in a]
    rows = [(f"k{i % 3}", a[i], float(2 * a[i] + draw.normal()), None if i % 4 else a[i] - 1e6, 0.1,
             str(a[i]), float("nan") if i % 50 == 0 else float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, d double, e string, f double")
    df = df.repartition(7)
    plan = numbers.column_correlations(df, ["k"], list("abcdef"))
    assert "Generate" not in plan._jdf.queryExecution().executedPlan().toString()
    got = {(r["k"], r["left_name"], r["right_name"]): r for r in plan.collect()}
    frame = pd.DataFrame(rows, columns=list("kabcdef")).astype({"e": float})
    assert len(got) == 3 * 15
    for (k, x, y), r in got.items():
        part = frame[frame["k"] == k][[x, y]].dropna()
        assert r["n_pairs"] == len(part)
        if "d" in (x, y):
            assert r["r"] is None
        else:
            x, y = (part[c] - part[c].mean() for c in (x, y))
            assert r["r"] == pytest.approx((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()), abs=1e-9)


def test_correlations_with_infinite_values_and_none(spark):
    rows = [(1.0, 2.0, float("inf")), (2.0, 4.1, 1.0), (3.0, 5.9, 2.0), (4.0, 8.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["left_name"], r["right_name"]): r["r"]
           for r in numbers.column_correlations(df, [], ["a", "b", "c"]).collect()}
    assert got["a", "b"] > 0.99 and math.isnan(got["a", "c"]) and math.isnan(got["b", "c"])
    assert numbers.column_correlations(df.where("a > 9"), [], ["a", "b"]).collect() == []


# --- dates by vote -----------------------------------------------------------------------

@pytest.mark.parametrize("text,expected", [
    ("17-Jan-1997", "1997-01-17"), ("17 JAN 1997", "1997-01-17"), ("17-jan-97", "1997-01-17"),
    ("1997-01", "1997-01-01"), ("1997/1", "1997-01-01"), ("19970117", "1997-01-17"),
    ("17/01/1997", "1997-01-17"), ("01/17/1997", "1997-01-17"), ("17.01.1997", "1997-01-17"),
    ("Jan 1997", "1997-01-01"), ("January 1997", "1997-01-01"), ("Jan 17, 1997", "1997-01-17"),
    ("January 17, 1997", "1997-01-17"), ("17 January 1997", "1997-01-17"),
    ("1997/01/17", "1997-01-17"), ("1/17/97", "1997-01-17"), ("31/02/1997", None),
    ("May 5 2001", "2001-05-05"), ("5/5/68", "2068-05-05"), ("5/5/69", "1969-05-05"),
    ("Foo 1997", None), ("12/2001", None), ("99999999", None)])
def test_text_forms(spark, text, expected):
    df = inline_rows(spark, {"d": "string"}, [(text,)])
    assert df.select(dates.parse_date(F.col("d")).cast("string")).head()[0] == expected


def test_the_column_decides_what_comes_first(spark):
    rows = [("03/04/1997", "03/04/1997", "x"), ("25/12/1997", "12/25/1997", None),
            ("01/02/1998", "01/02/1998", "03/04/1997")]
    df = spark.createDataFrame(rows, "eu string, us string, one string")
    out = dates.with_dates(df, ["eu", "us", "one"]).collect()
    assert [str(r["eu"]) for r in out] == ["1997-04-03", "1997-12-25", "1998-02-01"]
    assert [str(r["us"]) for r in out] == ["1997-03-04", "1997-12-25", "1998-01-02"]
    assert [str(r["one"]) for r in out] == ["None", "None", "1997-03-04"]
    forms = dates.date_forms({"t": (df, ["eu", "us", "one"]), "u": (df.limit(0), ["eu"])})
    assert forms["t", "eu"][0] == "day first" and forms["t", "us"][0] == "month first"
    assert forms.get(("u", "eu"), []) == []


# --- lags --------------------------------------------------------------------------------

def test_partial_correlations_solve_the_yule_walker_equations(spark):
    r = [0.6, 0.4, 0.2, 0.1, -0.05]
    df = spark.createDataFrame([(r,), ([],), ([0.5, None, 0.1],), ([1.0, 1.0],)], "r array<double>")
    got = [row[0] for row in df.select(LG.partial_autocorrelations(F.col("r"))).collect()]
    full = np.array([1.0, *r])
    for k in range(1, 6):
        m = np.array([[full[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[0][k - 1] == pytest.approx(np.linalg.solve(m, full[1:k + 1])[-1], rel=1e-10)
    assert got[1] == [] and got[2] == [0.5, None, None] and got[3] == [1.0, None]


def test_order_hints_of_known_processes(spark):
    draw = np.random.default_rng(6)
    noise = draw.normal(size=3000)
    ar = np.zeros(3000)
    for t in range(2, 3000):
        ar[t] = 0.5 * ar[t - 1] + 0.3 * ar[t - 2] + noise[t]
    ma = noise[1:] + 0.8 * noise[:-1]
    rows = [("ar", t, float(v)) for t, v in enumerate(ar)] + [("ma", t, float(v)) for t, v in enumerate(ma)]
    series = spark.createDataFrame(rows, "s string, t int, x double")
    hints = {r["s"]: r for r in LG.order_hints(LG.lag_profile(series, "t", "x", ["s"], 6), ["s"]).collect()}
    assert hints["ar"]["p"] == 2 and hints["ma"]["q"] == 1


# --- chains ------------------------------------------------------------------------------

def plain_diagnostics(chains):
    """R-hat and bulk effective sample size written out with numpy."""
    from statistics import NormalDist
    half = len(chains[0]) // 2
    x = np.array([c for chain in chains for c in (chain[:half], chain[len(chain) - half:])])
    ranks = pd.Series(x.ravel()).rank().to_numpy().reshape(x.shape)
    z = np.vectorize(NormalDist().inv_cdf)((ranks - 0.375) / (x.size + 0.25))

    def pooled(v):
        w = v.var(axis=1, ddof=1).mean()
        return w, w * (half - 1) / half + v.mean(axis=1).var(ddof=1)

    w, p = pooled(x)
    wz, pz = pooled(z)
    c = z - z.mean(axis=1, keepdims=True)
    acov = [np.mean([(u[:half - k] * u[k:]).sum() / half for u in c]) for k in range(half)]
    rho = [1.0] + [1 - (wz - a) / pz for a in acov[1:]]
    total, low = 0.0, math.inf
    for i in range(half // 2):
        pair = rho[2 * i] + rho[2 * i + 1]
        if pair <= 0:
            break
        low = min(low, pair)
        total += low
    return math.sqrt(p / w), x.size / max(2 * total - 1, 1 / math.log10(x.size))


def test_diagnostics_match_numpy(spark):
    draw = np.random.default_rng(3)
    walk = [np.convolve(draw.normal(size=160), np.ones(6), "valid")[:151] for _ in range(4)]
    cases = {"walk": walk, "apart": [draw.normal(i, 1, 151) for i in range(4)],
             "ties": [np.round(draw.normal(size=151)) for _ in range(4)]}
    rows = [(name, i, c.tolist()) for name, chains in cases.items() for i, c in enumerate(chains)]
    rows += [("flat", i, [1.0] * 151) for i in range(4)] + [("short", i, [1.0, 2.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "parameter string, chain int, draws array<double>")
    got = {r["parameter"]: r for r in PO.diagnostics(df, ["parameter"]).collect()}
    for name, chains in cases.items():
        rhat, ess = plain_diagnostics(chains)
        assert got[name]["rhat"] == pytest.approx(rhat, rel=1e-9)
        assert got[name]["ess_bulk"] == pytest.approx(ess, rel=1e-6)
    assert got["apart"]["rhat"] > 1.1
    assert got["flat"]["rhat"] is None and got["short"]["rhat"] is None


def test_draws_below_zero():
    draw = np.random.default_rng(1)
    for mean, sd in ((-1.0, 1.0), (0.0, 2.0), (2.0, 1.0), (8.0, 1.0)):
        x = np.array([PO.below_zero(draw, mean, sd) for _ in range(20_000)])
        low = mean / sd
        hazard = math.exp(-low * low / 2) / math.sqrt(2 * math.pi) / (0.5 * math.erfc(low / math.sqrt(2)))
        assert x.max() <= 0 and x.mean() == pytest.approx(mean - sd * hazard, abs=0.03 * sd)


def test_posterior_agrees_with_the_mode_where_signs_do_not_bind(spark):
    draw = np.random.default_rng(5)
    n = 400
    x = draw.normal(size=(n, 4))
    y = 3 + x @ np.array([0.4, 0.3, -0.25, 0.1]) + draw.normal(0, 0.1, n)
    config = insights.K.SeriesConfig(target="t", week="week", channels=(
        insights.K.Channel("f2f", "field", "sum", 0.3), insights.K.Channel("tv", "broadcast", "mean", 0.6),
        insights.K.Channel("rival", "competitor", "mean", 0.0)))
    df = spark.createDataFrame(
        [("s", i, "train", float(y[i]), *map(float, x[i])) for i in range(n)],
        "series string, week int, split string, y double, X_f2f_sat double, X_tv_sat double, "
        "X_rival double, X_lc_num double")
    from tidemark.operators import attribution as A
    mode = {r["feature"]: r for r in A.map_fit(df, config, ["series"]).collect()}
    draws = stage(PO.posterior_draws(df, config, ["series"], tune=300, draws=800))
    assert draws.count() == 4 * 6
    found = {r["parameter"]: r for r in PO.posterior_means(draws, ["series"]).collect()}
    for feature, row in mode.items():
        assert found[feature]["mean"] == pytest.approx(row["beta"], abs=0.004)
        assert found["intercept"]["mean"] == pytest.approx(row["intercept"], abs=0.004)
    assert all(r["rhat"] < 1.01 and r["ess_bulk"] > 400 and r["converged"] for r in found.values())
    again = stage(PO.posterior_draws(df, config, ["series"], tune=300, draws=800))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, draws.collect()))


# --- streams -----------------------------------------------------------------------------

def test_stream_equals_batch_and_counts_late_periods(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ON.STATE_STORE)
    draw = np.random.default_rng(7)
    rows = [(s, t, None if t == 9 else float(draw.normal(3 * (t > 60), 1))) for s in "ab" for t in range(120)]
    series = spark.createDataFrame(rows, "s string, t0 int, x double")
    batch = {(r["s"], r["t0"]): r for r in C.change_probabilities(series, ["s"], "t0", "x", train=40).collect()}
    priors = stage(C.series_priors(series.where("x is not null"), ["s"], "t0", "x", 40))
    folder = str(tmp_path)
    for low, high in ((0, 50), (50, 51), (51, 120), (30, 40)):
        series.where(f"t0 >= {low} and t0 < {high}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    found = ON.online_probabilities(stream, priors, ["s"], "t0", "x")
    run = (found.writeStream.format("parquet").option("path", f"{folder}/out")
           .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start())
    run.awaitTermination()
    got = spark.read.parquet(f"{folder}/out").collect()
    assert len(got) == len(batch) == 2 * 119
    for r in got:
        want = batch[r["s"], r["t0"]]
        assert r["t"] == want["t"] and abs(r["cp_prob"] - want["cp_prob"]) < 1e-9
        assert abs(r["exp_run_length"] - want["exp_run_length"]) < 1e-9 * 120
    assert max(r["pruned_in_all"] for r in got) < 119 * ON.PRUNE
    assert all(r["late"] == 0 for r in got)


def test_pruned_mass_is_bounded_and_reported():
    draw = np.random.default_rng(8)
    held = ON.RunLengths(0.0, 1.0)
    lost = 0.0
    for t in range(400):
        _, _, gone = held.observe(float(draw.normal(4 * (t > 200), 1)), 0.0, 1.0, 250.0, 1e-6)
        assert gone <= 1e-6
        lost += gone
    assert held.pruned == pytest.approx(lost) and 0 < lost and len(held.runs) < 399
    assert held.weight.sum() == pytest.approx(1.0)
    back = ON.RunLengths.of(held.state())
    assert back.state() == held.state()


# --- profile states ----------------------------------------------------------------------

def test_merged_states_equal_one_pass(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn(
        "nothing", F.lit(None).cast("double"))
    measures = ["l_quantity", "l_extendedprice", "nothing"]
    parts = [PS.profile_state(lines.where(F.col("l_orderkey") % 5 == k), "lines", measures, str(k))
             for k in range(5)] + [PS.profile_state(lines.limit(0), "lines", measures, "none")]
    states = stage(PS.merged_states([insights.union(parts), parts[2]]))
    got = {r["name"]: r for r in PS.merged_profile(states).collect()}
    subtypes = {c: "measure" for c in measures}
    want = {r["name"]: r for r in PF.column_profile(lines, subtypes, "lines").collect()}
    assert set(got) == set(want)
    for c, w in want.items():
        for mine, theirs in (("null_pct", "null_pct"), ("mean", "mean"), ("std", "std"),
                             ("skewness", "skewness"), ("kurtosis", "kurtosis"), ("value_max", "value_max")):
            assert (got[c][mine] is None and w[theirs] is None) or got[c][mine] == pytest.approx(
                w[theirs], rel=1e-9, abs=1e-9), (c, mine)
        assert abs(got[c]["about_distinct"] - w["unique_count"]) <= 0.03 * w["unique_count"] + 1
    price = np.sort([r[0] for r in lines.select("l_extendedprice").collect()])
    for q, about in zip((0.25, 0.5, 0.75), got["l_extendedprice"]["about_quantiles"]):
        assert np.searchsorted(price, about) / len(price) == pytest.approx(q, abs=0.01)
    assert got["nothing"]["mean"] is None and got["nothing"]["n"] == 0


# --- stages with an end ------------------------------------------------------------------

def test_a_run_leaves_nothing_but_what_it_publishes(spark):
    root = stage_folder(spark).removeprefix("file:")
    with StageRun(spark) as run:
        one = stored_table(spark.range(5).toDF("a"))
        two = stage(one.where("a > 1"))
        assert two.count() == 3 and len(run.manifest["stages"]) == 2
        assert run.manifest["status"] == "running"
        assert not any(run.id in path for path in abandoned_runs(spark))
        run.publish(two, "kept")
    assert not os.path.exists(run.folder.removeprefix("file:"))
    assert read_published(spark, "kept").count() == 3
    with pytest.raises(ValueError):
        with StageRun(spark) as failed:
            stage(spark.range(9).toDF("a"))
            failed.publish(stage(spark.range(2).toDF("a")), "other")
            raise ValueError("broken")
    assert not os.path.exists(failed.folder.removeprefix("file:"))
    assert read_published(spark, "kept").count() == 3  # the last good one
    with pytest.raises(Exception):
        with StageRun(spark) as failed:
            failed.publish(spark.range(4).select(F.raise_error(F.lit("no")).alias("a")), "kept")
    assert read_published(spark, "kept").count() == 3
    with StageRun(spark) as third:
        third.publish(spark.range(7).toDF("a"), "kept")
    assert read_published(spark, "kept").count() == 7
    left = [p for p in os.listdir(f"{root}/published") if p.startswith("kept-")]
    assert len(left) == 1 and json.loads(open(f"{root}/published/kept.json").read())["run"] == third.id
    with pytest.raises(FileNotFoundError):
        read_published(spark, "never")


# --- one run for all facts ---------------------------------------------------------------

def jobs_of(spark, make):
    """Jobs that a call submits, counted by Spark's own status tracker."""
    context = spark.sparkContext
    group = f"jobs-{os.urandom(4).hex()}"
    context.setJobGroup(group, group)
    make()
    found = len(context.statusTracker().getJobIdsForGroup(group))
    context.setJobGroup("none", "none")
    return found


def test_jobs_do_not_grow_with_the_facts(spark, folder):
    events = gold_events(spark, folder)

    def run(n):
        tables_ = {f"gold_events_{i}": events.withColumn("amount", F.col("amount") + i) for i in range(n)}
        found = insights.run_insights(spark, tables_, models=["BOCPD"])
        assert len(found.known.facts) == n
        assert insights.model_outcomes(found).where("ran").count() == n
        assert found.changes.probs.select("dataset").distinct().count() == n

    run(2)
    assert jobs_of(spark, lambda: run(8)) <= jobs_of(spark, lambda: run(2)) + 4


def test_attribution_of_many_facts_is_that_of_each(spark, folder):
    """Facts with different channels share slots; each gets what it gets alone."""
    fact = stored_table(gold_engagement(spark, folder))
    facts = {"gold_one": fact.drop("tv_grps", "trx"), "gold_two": fact.drop("f2f", "samples", "trx")
             .withColumnRenamed("speaker", "webinar_calls")}
    limits = {"MMM": {"checks": ["min_row_count"], "min_row_count": 1}}

    def run(names):
        found = insights.run_insights(spark, {n: facts[n] for n in names}, models=["MMM"], limits=limits)
        betas = {(r["dataset"], r["measure"], r["feature"]): r["beta"] for r in found.mix.betas.collect()}
        meta = {(r["dataset"], r["measure"], r["channel"]): (r["decay"], r["hill_k"])
                for r in found.mix.meta.collect()}
        return found, betas, meta

    both, betas, meta = run(facts)
    alone = [run([n]) for n in facts]
    assert set(betas) == {k for _, b, _ in alone for k in b}
    for _, b, m in alone:
        assert all(betas[k] == pytest.approx(v, abs=1e-6) for k, v in b.items())
        assert all(meta[k] == pytest.approx(v) for k, v in m.items())
    assert len(meta) == sum(len(m) for _, _, m in alone)
    assert "tv_grps_sat" in both.mix.features["gold_two"]
    assert "tv_grps_sat" not in both.mix.features["gold_one"]


def test_a_broken_dataset_does_not_end_the_run(spark, folder):
    events = gold_events(spark, folder)
    broken = events.withColumn("amount", F.when(F.col("user_id") >= 0, F.raise_error(F.lit("bad\nrow")))
                               .cast("double"))
    run = insights.run_insights(spark, {"gold_events": events, "gold_broken": broken}, models=["BOCPD"])
    got = {r["dataset"]: r for r in insights.model_outcomes(run).collect()}
    assert got["gold_events"]["ran"] and not got["gold_broken"]["ran"]
    assert "bad\nrow" in got["gold_broken"]["reason"]


def test_chosen_datasets_and_suppressed_duplicates(spark, folder):
    events = gold_events(spark, folder)
    wide = events.withColumn("points", F.col("amount"))
    catalog_ = {"gold_events": events, "gold_wide": wide, "dim_hcp": dim_hcp(spark, folder)}
    run = insights.run_insights(spark, catalog_, models=["PSI"], suppress_duplicates=True)
    assert [f.dataset for f in run.known.facts] == ["gold_wide"]
    run = insights.run_insights(spark, catalog_, models=["PSI"], names=["gold_events"])
    assert [f.dataset for f in run.known.facts] == ["gold_events"]
    with pytest.raises(ValueError, match="unknown datasets: nothing"):
        insights.run_insights(spark, catalog_, names=["nothing"])


def test_metadata_is_made_when_asked_for(spark, folder):
    metadata = insights.describe(spark, {"gold_events": gold_events(spark, folder)})
    assert set(vars(metadata)) == {"spark", "datasets", "datamarts", "hints"}
    assert metadata.specs.count() == 4 and "routes" not in vars(metadata)


# --- small functions that had no test ----------------------------------------------------

@pytest.mark.parametrize("grain, periods", [("daily", 365), ("weekly", 52), ("monthly", 12),
                                            ("quarterly", 52), (None, 52)])
def test_hazard_of_a_grain(spark, grain, periods):
    df = inline_rows(spark, {"g": "string"}, [(grain,)])
    assert df.select(dates.hazard_of(F.col("g"))).head()[0] == periods


def test_preparation_follows_the_profile(spark):
    rows = [(f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", float(math.exp(i / 10)), None if i % 5 else 1.0)
            for i in range(112)]
    df = spark.createDataFrame(rows, "d string, sales double, odds double").withColumn(
        "d", F.to_date("d"))
    subtypes = {"d": "date", "sales": "measure", "odds": "measure"}
    profiles = stage(PF.column_profiles({"t": (df, subtypes)}))
    suggested = PR.profiled_suggestions(profiles)["t"]
    assert any("log1p" in s for s in suggested["sales"])
    assert PR.daily_dates(profiles) == {"t": "d"}
    ready = PR.prepared({"t": (df, subtypes, ["BOCPD", "ARIMA", "PSI"])}, profiles)
    logs = ready["t", "ARIMA"].agg(F.max("sales")).head()[0]
    assert logs < 12 and ready["t", "BOCPD"].count() == 18
    assert ready["t", "PSI"].where("odds is null").count() == 0


def test_tune_hints_carry_notes(spark):
    df = spark.createDataFrame([], "week date, sales double")
    arima = PR.tune_hints(df, "ARIMA")
    assert "ADF" in arima["note"] and "Prophet" in arima["framework_options"]
    assert all(PR.tune_hints(df, m)["note"] for m in ("BOCPD", "MMM", "PSI"))


def test_tables_of_a_schema_and_limits(spark):
    spark.range(30).createOrReplaceTempView("thirty_rows")
    assert catalog.list_tables(spark, "default") == sorted(catalog.list_tables(spark, "default"))
    assert catalog.read_table(spark, "thirty_rows", 4).count() == 4
    assert catalog.read_table(spark, "thirty_rows").count() == 30


def test_schema_sample_is_a_repeatable_share(spark):
    df = spark.range(20_000)
    one = stages.schema_sample(df)
    assert 1_700 < one.count() < 2_300
    assert one.count() == stages.schema_sample(df).count()


def test_detected_config_names_the_columns(spark, folder):
    from tidemark.operators import features as X
    found = X.detect_config(gold_engagement(spark, folder), target="sales")
    assert (found.target, found.week, found.entity, found.product) == ("sales", "week", "hcp_id", "product")
    assert found.anomaly == "is_anomaly" and found.lifecycle == "lifecycle_stage"
    groups = {c.name: c.group for c in found.channels}
    assert groups["f2f"] == "field" and groups["tv_grps"] == "broadcast"
    assert groups["competitor_spend"] == "competitor"
