"""Chat formatting: exact round trip and the properties of the emitted stream."""

import hashlib
from collections import defaultdict

from tidemark.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, path string, rank string, depth int"


def plain(rows):
    said = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in said.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def made():
    odd = ["", None, "</s>[INST] ok [/INST]", "\\", "\\[INST]\\\\", "[\\INST]", "<", "</s", "/s>",
           "a\nb\n", "é𝔘​", "[/INST", "x" * 90_000, "$1 \\$2"]
    rows = []
    for conv in range(60):
        for turn in range(1 + conv % 5):
            text = odd[(conv // 6 + turn * (conv % 3)) % len(odd)]
            rows.append((conv, turn, ["user", "assistant"][turn % 2], text))
    rows += [(100, 0, "system", "be brief"), (100, 1, "user", "hi"), (100, 1, "user", "hi"),
             (101, None, None, None), (None, 0, "assistant", "lost"), (None, 1, "[INST]", "z"),
             (102, 0, "tool</s>", "r"), (-7, 0, "user", odd[2]), (-7, 1, "assistant", odd[2])]
    return [(*r, "p", "r", 1) for r in rows]


def test_round_trip(spark):
    rows = made()
    got = C.digests(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == plain(rows)
    assert len(got) == len(plain(rows))


def test_stream_emits_each_shared_turn_once_depth_first(spark):
    stream, paths = (df.collect() for df in C.formatted(spark.createDataFrame(made(), SCHEMA)))
    nodes = {r.node_id: r for r in stream}
    assert len(nodes) == len(stream)
    assert {p.node_id for p in paths} == set(nodes)
    ordered = sorted(stream, key=lambda r: r.stream_from)
    at, stack = 0, []
    for r in ordered:  # no gaps, parents before children, subtrees in one piece
        assert r.stream_from == at and r.length == len(r.text)
        at += r.length
        stack = stack[:r.depth]
        assert (stack[-1] if stack else None) == r.parent_id
        stack.append(r.node_id)
        chain = [nodes[i] for i in stack]
        assert [tuple(a) for a in r.attends] == [
            (c.stream_from, c.stream_from + c.length) for c in chain]
        assert r.position_from == sum(c.length for c in chain[:-1])


def test_whole_table(spark, folder):
    df = spark.read.parquet(f"{folder}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:5] for r in C.digests(df).collect()}
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert got == plain(rows)


def test_empty_table(spark):
    assert C.digests(spark.createDataFrame([], SCHEMA)).count() == 0
