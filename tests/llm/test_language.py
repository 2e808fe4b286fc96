"""Language identification by held-out accuracy and on odd rows."""

import weakref

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import common, language as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) > 0.97
    assert {r.lang_pred for r in rows} <= {"de", "en", "es", "fr", "und"}
    assert all(0 <= r.score <= 1 for r in rows)


def test_training_ignores_held_out_and_unlabelled_rows(spark):
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"), F.lit("some words here").alias("text"),
        F.when(L.held_out("id"), F.lit("xx")).when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("en")).alias("lang"))
    assert L.fit(docs).members == {"germanic": ["en"]}


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, id string, x string, out string"
    texts = [("the cat and the dog sat with them", "en"), ("der hund und die katze sind da", "de"),
             ("le chien et les chats sont ici", "fr"), ("el perro y los gatos que son", "es")]
    rows = [(i, f"{texts[i % 4][0]} {i}", texts[i % 4][1], "", "", "") for i in range(200)]
    odd = [(1000, None, "en", "", "", ""), (1001, "", "en", "", "", ""),
           (1002, "123 !! ²", "de", "", "", ""), (None, "der hund und die katze", None, "", "", ""),
           (1003, "the cat and " * 300_000, None, "", "", ""), (3, rows[3][1], "es", "", "", "")]
    docs = spark.createDataFrame(rows + odd, schema)
    got = L.identify(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + len(odd)
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(by[i].score == 0 for i in (1000, 1001, 1002))
    assert by[None].lang_pred == "de" and by[None].held_out
    assert by[1003].lang_pred == "en"
    assert np.mean([by[i].lang_pred == texts[i % 4][1] for i in range(200)]) == 1
    kept = L.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 3


def test_empty_and_unlabelled_tables(spark):
    schema = "doc_id long, text string, lang string"
    assert L.identify(spark.createDataFrame([], schema)).count() == 0
    got = L.identify(spark.createDataFrame([(1, "words", None)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_a_batch_is_decided_in_parts(monkeypatch):
    alive, most, plain = [0], [0], L.trigrams

    def counted(text):
        vector = plain(text)
        if vector is not None:
            alive[0] += 1
            most[0] = max(most[0], alive[0])
            weakref.finalize(vector, lambda: alive.__setitem__(0, alive[0] - 1))
        return vector

    texts = [None, "", "12", *(f"words of text number {'abcdefghij'[i % 10] * 9}" for i in range(200))]
    x = np.stack([plain(t) for t in texts[3:]])
    model = L.Model(["only en"], {"only en": ["en"]}, np.zeros((L.DIMENSIONS + 1, 1), np.float32))
    assert (model.predict(x)[0] == "en").all()
    monkeypatch.setattr(L, "trigrams", counted)
    monkeypatch.setattr(L, "PART", 8)
    assert L.likely(pd.Series(texts), model, 0.2).tolist() == [False] * 3 + [True] * 200
    assert most[0] <= 16


def test_workers_give_memory_back_after_the_last_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    double = common.lean(lambda batches: (2 * b for b in batches))
    assert list(double([1, 2])) == [2, 4] and calls == [1]
    early = double([1, 2])
    next(early)
    early.close()
    assert calls == [1, 1]
