"""Quantiles, gaps, curves and parsing against plain computations."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import curves, dates
from tidemark.functions.dates import unparsed_dates, with_dates
from tidemark.functions.numbers import exact_quantiles, number_of, safe_corr
from tidemark.session import inline_rows


def quantiles(spark, values, probs):
    df = inline_rows(spark, {"k": "string", "x": "double"}, [("a", v) for v in values])
    return {r["prob"]: r["quantile"] for r in exact_quantiles(df, ["k"], "x", probs).collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_quantiles_of_any_list(spark, values):
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = quantiles(spark, values, probs)
    for p in probs:
        assert found[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("shape", ["even", "skewed", "mostly_one", "two_values"])
def test_quantiles_of_many_values(spark, shape):
    """More rows than the sketch keeps exactly, so the brackets and bins are used."""
    i = F.col("id").cast("double")
    value = {"even": i, "skewed": F.exp(i / 5000), "mostly_one":
             F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(i),
             "two_values": (F.col("id") % 2).cast("double")}[shape]
    df = spark.range(60000).select(F.lit("a").alias("k"), value.alias("x"))
    plain = np.array([r["x"] for r in df.select("x").collect()])
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    for r in exact_quantiles(df, ["k"], "x", probs).collect():
        assert r["quantile"] == pytest.approx(float(np.quantile(plain, r["prob"])), rel=1e-12)


def test_quantiles_ignore_nulls_and_nan(spark):
    df = spark.sql("SELECT 'a' k, x FROM VALUES (1D), (2D), (NULL), (double('NaN')) t(x)")
    assert exact_quantiles(df, ["k"], "x", [0.5]).head()["quantile"] == 1.5


@pytest.mark.parametrize("step,grain", [(1, "daily"), (7, "weekly"), (30, "monthly"),
                                        (91, "quarterly"), (15, None)])
def test_grain_bands(spark, step, grain):
    df = spark.range(12).select(
        F.expr(f"date_add(DATE'2024-01-01', CAST(id AS INT) * {step})").alias("d"))
    row = dates.median_gaps(df.union(df), ["d"]).head()
    assert row["date_grain"] == grain and row["n_moments"] == 12


def test_gaps_count_whole_days(spark):
    df = spark.sql("""SELECT t FROM VALUES (TIMESTAMP_NTZ'2024-01-01 22:00:00'),
        (TIMESTAMP_NTZ'2024-01-08 21:00:00'), (TIMESTAMP_NTZ'2024-01-15 21:00:00') x(t)""")
    assert dates.median_gaps(df, ["t"]).head()["median_gap"] == 6.5


def test_one_date_has_no_grain(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS d")
    row = dates.median_gaps(df, ["d"]).head()
    assert row["median_gap"] is None and row["date_grain"] is None


@pytest.mark.parametrize("text,expected", [
    ("2025 Q4", "2025-10-01"), ("2025Q1", "2025-01-01"), ("Q4 2025", "2025-10-01"),
    ("Q2/2024", "2024-04-01"), ("Q3-2024", "2024-07-01"), ("2024-05-06", "2024-05-06"),
    ("2024-05-06 10:00:00", "2024-05-06"), ("1999", "1999-01-01"), ("bad", None),
    ("2025 Q7", None), (None, None)])
def test_parse_date(spark, text, expected):
    df = inline_rows(spark, {"d": "string"}, [(text,)])
    found = df.select(dates.parse_date(F.col("d")).cast("string")).head()[0]
    assert found == expected


@pytest.mark.parametrize("text,ok", [("1", True), (" -2.5e3 ", True), (".5", True),
                                     ("12d", False), ("x", False), ("", False)])
def test_number_of(spark, text, ok):
    df = inline_rows(spark, {"t": "string"}, [(text,)])
    assert (df.select(number_of(F.col("t"), True)).head()[0] is not None) == ok


def test_adstock_by_hand(spark):
    df = inline_rows(spark, {"s": "string", "t": "int", "x": "double"},
                     [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 4.0), ("b", 0, 3.0)])
    out = df.withColumn("y", curves.adstock(F.col("x"), 0.5, 0.5, ["s"], "t"))
    assert [r["y"] for r in out.orderBy("s", "t").collect()] == [1.0, 2.5, 5.25, 3.0]


def test_adstock_equals_recursion_on_long_series(spark):
    x = [float((i * 37) % 101) for i in range(400)]
    df = inline_rows(spark, {"t": "int", "x": "double"}, list(enumerate(x)))
    rows = df.withColumn("y", curves.adstock(F.col("x"), 0.8, 0.8, [], "t")).orderBy("t").collect()
    carried = 0.0
    for r, v in zip(rows, x):
        carried = v + 0.8 * carried
        assert r["y"] == pytest.approx(carried, rel=1e-13)


def test_hill_and_logs(spark):
    row = spark.sql("SELECT 3D x, 0D z, -1D n").select(
        curves.hill(F.col("x"), F.lit(0.8), F.lit(3.0)).alias("half"),
        curves.log_level(F.col("z")).alias("floor"),
        curves.log1p_level(F.col("n")).alias("zero"),
        curves.log_level(F.lit(None).cast("double")).alias("none")).head()
    assert row["half"] == pytest.approx(0.5) and row["floor"] == pytest.approx(math.log(1e-6))
    assert row["zero"] == 0.0 and row["none"] is None


def test_safe_corr_on_constants(spark):
    df = spark.sql("SELECT 1D a, x b FROM VALUES (1D), (2D), (3D) t(x)")
    assert df.agg(safe_corr(F.col("a"), F.col("b"))).head()[0] is None


def test_adstock_of_any_decay(spark):
    df = spark.createDataFrame([("a", t, float(t % 3)) for t in range(50)], "s string, t int, x double")
    for decay in (0.0, 0.5, 0.99, 1.0, 1.1):
        rows = df.withColumn("y", curves.adstock(F.col("x"), decay, decay, ["s"], "t")).orderBy("t")
        carried = 0.0
        for r in rows.collect():
            carried = carried * decay + r["x"]
            assert r["y"] == pytest.approx(carried)


def test_dates_of_any_kind(spark):
    df = spark.createDataFrame(
        [("1997 Q2", 1997, "x"), ("Q4/1998", 1998, "x"), ("1999-05-06", None, "x"),
         ("n/a", 12, "x"), (None, 2001, "x")], "d string, y long, z string")
    out = with_dates(df, ["d", "y"]).collect()
    assert [str(r["d"]) for r in out] == ["1997-04-01", "1998-10-01", "1999-05-06", "None", "None"]
    assert [str(r["y"]) for r in out] == ["1997-01-01", "1998-01-01", "None", "None", "2001-01-01"]
    found = {r["name"]: (r["n_values"], r["n_unparsed"])
             for r in unparsed_dates(df, ["d", "y"]).collect()}
    assert found == {"d": (4, 1), "y": (4, 1)}


def test_drift_totals_and_infinite_quantiles(spark):
    rows = [("k", v) for v in [float("-inf"), 1.0, 2.0, 3.0, float("inf")]]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(df, ["k"], "x", [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: float("-inf"), 0.5: 2.0, 1.0: float("inf")}
