"""BPE against the public tokenizers library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    ids = B.loaded(PATH).encode(text).tolist()
    assert ids == plain(text)
    assert B.loaded(PATH).decode(ids) == PLAIN.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", " ", "  two\n\n\tand  ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext",
    "x" * 5000, "ab" * 4001, "𝔘ñï©ødé ąęß 汉字かな", "don't WE'LL I'd 'tis", "1234567 1,000.50",
    "\x1c\x1d\x85   z", "\0\x7f​", "queue" * 700, "=" * 999 + "\n" * 77])
def test_odd_texts(text):
    assert B.loaded(PATH).encode(text).tolist() == plain(text)


def test_every_code_point():
    """Letters, numbers and spaces are those of the library's version of Unicode."""
    coder = B.loaded(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 1 << 16):
        texts = [f"!{chr(c)}'s {chr(c)}1a" for c in points[at:at + (1 << 16)]]
        want = PLAIN.encode_batch_fast(texts, add_special_tokens=False)
        assert [i.tolist() for i in coder.encode_all(texts)] == [e.ids for e in want]


def test_decoding_of_any_ids():
    draw = random.Random(3)
    lists = [[draw.randrange(50257) for _ in range(draw.randrange(9))] for _ in range(300)]
    lists += [None, [], [50256], [0] * 5]
    got = B.decoder_of(PATH).texts(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    vocabulary = B.read_vocabulary(PATH)[2]
    assert got == [None if i is None else B.joined(vocabulary, i) for i in lists]
    cut = pa.array(lists, pa.list_(pa.int32())).slice(7, 20)
    assert B.decoder_of(PATH).texts(cut).to_pylist() == got[7:27]


def test_exact_merging_is_needed_and_used():
    draw = random.Random(1)
    coder = B.Bpe(PATH)
    letters = "etaoinshrdlu"
    for _ in range(300):
        text = " ".join("".join(draw.choices(letters, k=draw.randrange(2, 14)))
                        for _ in range(30))
        assert coder.encode(text).tolist() == plain(text)
    assert coder.exact_words > 0


def test_small_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(B, "CACHED_WORDS", 3)
    coder = B.Bpe(PATH)
    for text in ("one two three four five six one", "six seven one two", "one " * 9):
        assert coder.encode(text).tolist() == plain(text)


def test_whole_table_round_trip(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in B.digests(docs, PATH).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = plain(text or "")
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(
            ",".join(map(str, ids)).encode()).hexdigest()
        back = PLAIN.decode(ids, skip_special_tokens=False)
        assert got[doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_nulls_repeats_extra_columns_and_empty_table(spark, monkeypatch):
    schema = "doc_id long, text string, ids string, __text string"
    docs = spark.createDataFrame(
        [(1, None, "a", "b"), (1, None, "a", "b"), (None, "", "", ""), (2, "x " * 90_000, "", "")],
        schema)
    rows = sorted((r.doc_id or 0, r.n_tokens) for r in B.digests(docs, PATH).collect())
    assert rows == [(0, 0), (1, 0), (1, 0), (2, len(plain("x " * 90_000)))]
    assert B.digests(spark.createDataFrame([], schema), PATH).count() == 0


def test_one_scan_proposes_the_longest_tokens_of_every_word():
    draw = random.Random(7)
    coder = B.loaded(PATH)
    known = set(coder.bytes)
    words = ["".join(draw.choices("etaoinshr aélx0 \n", k=draw.randrange(1, 40))).encode()
             for _ in range(400)]
    tokens, counts = coder.longest_matches(words)
    got = iter(tokens.tolist())
    for word, n in zip(words, counts.tolist()):
        want, i = [], 0
        while i < len(word):
            k = max(k for k in range(1, len(word) - i + 1) if word[i:i + k] in known)
            want.append(word[i:i + k])
            i += k
        assert [coder.bytes[next(got)] for _ in range(n)] == want


def test_both_ways_of_merging_agree():
    draw = random.Random(8)
    coder = B.loaded(PATH)
    for _ in range(500):
        word = "".join(draw.choices("etaoinshr aélx", k=draw.randrange(1, 40))).encode()
        assert coder.merge(word) == coder.merge_long(word)


def test_pairs_stay_apart_exactly_if_merging_keeps_them():
    draw = random.Random(9)
    coder = B.loaded(PATH)
    kept = 0
    for _ in range(30_000):
        left, right = draw.randrange(256 if _ % 3 else 50_256), draw.randrange(50_256)
        whole = coder.bytes[left] + coder.bytes[right]
        want = coder.merge_long(whole) == [left, right]
        assert coder.stay_apart(left, right) == want, (left, right)
        kept += want
    assert kept > 1000
    for token in range(0, 50_256, 7):
        own = coder.merge_long(coder.bytes[token]) == [token]
        assert (coder.tree(token) is not None) == own


def test_caches_end_with_the_task_and_stay_bounded(spark, monkeypatch):
    bpe = B.loaded(PATH)
    texts = [f"word{i} an{i}other, unlike{i * 7}the rest" for i in range(300)]
    want = [bpe.encode(t).tolist() for t in texts]
    assert len(bpe.verdicts) > 40
    monkeypatch.setattr(B, "CACHED_VERDICTS", 40)
    bpe.forget()
    assert not bpe.cache and not bpe.verdicts
    assert [bpe.encode(t).tolist() for t in texts] == want and len(bpe.verdicts) < 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: list(r.ids) for r in B.encode(docs, PATH).collect()} == dict(enumerate(want))

    def held(batches):
        for batch in batches:
            known = B.loaded(PATH)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(known.cache) + len(known.verdicts)] * len(batch), pa.int64())], ["n"])

    left = spark.range(0, 32, 1, 8).mapInArrow(held, "n long").collect()
    assert {r.n for r in left} == {0}
