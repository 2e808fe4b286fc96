"""Whole runs on odd catalogs, and Python steps started from another folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changepoint as C
from tidemark.plans import insights
from tidemark.plans.gold import dim_hcp, gold_events
from tidemark.plans.queries import texted_events

REPO = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def outcomes(spark, folder):
    def run(models, **datasets):
        run = insights.run_insights(spark, {**datasets, "dim_hcp": dim_hcp(spark, folder)},
                                    models=models)
        return {(r["dataset"], r["model"]): r for r in insights.model_outcomes(run).collect()}
    return run


def test_text_dates_and_model_subset(spark, folder, outcomes):
    got = outcomes(["BOCPD"], gold_events=texted_events(spark, folder))
    assert set(got) == {("gold_events", "BOCPD")}


def test_no_dataset_has_the_chosen_model(spark, folder, outcomes):
    assert outcomes(["nothing"], gold_events=gold_events(spark, folder)) == {}


def test_fact_whose_dates_cannot_be_read_stays_with_a_reason(spark, folder, outcomes):
    unread = gold_events(spark, folder).withColumn("activity_date", F.lit("n/a"))
    for r in outcomes(None, gold_events=unread).values():
        assert not r["ran"] and r["reason"]


def test_periods_without_a_value_do_not_spoil_the_rest(spark):
    rows = [("s", t, None if t == 20 else float(t % 5) + (9.0 if t > 60 else 0.0))
            for t in range(100)]
    series = spark.createDataFrame(rows, "k string, t0 int, x double")
    out = C.change_probabilities(series, ["k"], "t0", "x", train=40).collect()
    assert len(out) == 99 and all(r["cp_prob"] is not None for r in out)
    assert C.missing_periods(series, ["k"], "x").head()["n_missing"] == 1


def test_python_steps_run_from_another_folder(tmp_path, folder):
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
import __spark_entry__ as entry
from tidemark.session import local_session
spark = local_session("2", "2g")
print("rows", entry.queries()["bocpd_probs"](spark, {folder!r}).count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          timeout=300, env={k: v for k, v in os.environ.items()
                                            if k != "PYTHONPATH"})
    assert "rows " in done.stdout, done.stderr[-2000:]
