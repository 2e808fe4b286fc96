"""The pipeline stage by stage, each on what its predecessor kept."""

import pytest

import corpus_pipeline as C
from tidemark.llm import bpe, lines, mixing, simhash
from tidemark.llm.common import stored


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], folder)))
    return out


def test_columns_and_order(steps):
    assert [n for n, _ in C.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "mixing",
                                        "BPE"]
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert steps[-1].columns == ["doc_id", "ids"]


def test_each_stage_decides_on_its_own_input(spark, folder, steps):
    raw, known, thin, single, mixed, coded = steps
    assert known.count() >= 0.97 * raw.count()
    assert set(known.collect()) <= set(raw.collect())
    assert thin.count() == known.count()
    drops = {r.doc_id: set(r.dropped_lines) for r in lines.line_report(known).collect()}
    before = {r.doc_id: r.text for r in known.collect()}
    for r in thin.collect():
        assert r.text == "\n".join(
            x for i, x in enumerate(before[r.doc_id].split("\n")) if i not in drops[r.doc_id])
        assert r.n_chars == len(r.text)
    groups = {r.doc_id: r.component_id for r in simhash.simhash_clusters(thin).collect()}
    assert {r.doc_id for r in single.collect()} == set(groups.values())
    chosen = {r.doc_id for r in mixing.mixed(single).where("chosen").collect()}
    assert {r.doc_id for r in mixed.collect()} == chosen
    coder = bpe.Bpe(C.tokenizer_path())
    want = {r.doc_id: coder.encode(r.text).tolist() for r in mixed.collect()}
    assert {r.doc_id: r.ids for r in coded.collect()} == want


def test_run_applies_all_stages(spark, folder, steps):
    got = {r.doc_id: r.ids for r in C.run(spark, folder).collect()}
    assert got == {r.doc_id: r.ids for r in steps[-1].collect()}


def test_odd_rows_pass_through(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(
        [(1, None, "en", "a", 0), (2, "", None, None, 0), (None, "the cat and the dog", "en", "a", 19),
         (3, "the cat and the dog", "en", None, 19), (3, "the cat and the dog", "en", None, 19)], schema)
    for frame in (docs, docs.where("false")):
        for _, stage in C.STAGES:
            frame = stored(stage(spark, frame, folder))
        assert frame.columns == ["doc_id", "ids"]


def test_long_texts_and_clashing_columns_pass_through(spark, folder):
    """A text of a million characters, and columns named like those the stages work with."""
    names = ["id", "key", "line", "component", "fp", "tokens", "topic", "draw", "ids", "body", "n",
             "probability", "held_out", "drops", "h1", "h2", "sig", "leader"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    long = docs.limit(1).selectExpr(*[
        "concat_ws(' ', transform(sequence(1, 150000), i -> concat('word', i % 977))) as text"
        if c == "text" else "987654L as doc_id" if c == "doc_id" else c for c in docs.columns])
    wide = docs.union(long).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    frame = stored(wide)
    for _, stage in C.STAGES[:-1]:
        before, frame = frame, stored(stage(spark, frame, folder))
        assert frame.columns == wide.columns
        assert frame.where("id <> concat('id', doc_id) or sig <> concat('sig', doc_id)").count() == 0
        assert 0 < frame.count() <= before.count()
    assert C.STAGES[-1][1](spark, frame, folder).count() == frame.count()
