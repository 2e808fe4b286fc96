"""Alignment against a plain version over every pair of tokens."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment as L
from tidemark.llm.bpe import byte_symbols

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
SHAPE = "doc_id long, text string"


def spans(ids, length):
    out, at = [], 0
    for i in ids:
        out.append((at, at + length(i), i))
        at += length(i)
    return out


def plain(rows):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    symbols = byte_symbols()

    def bytes_a(i):
        return bytes(symbols[c] for c in a.id_to_token(i))

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    made, links = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if b"".join(map(bytes_a, ids_a)) != raw or b"".join(map(bytes_b, ids_b)) != raw:
            made.append((doc_id, [], [], [], ""))
            continue
        x, y = spans(ids_a, lambda i: len(bytes_a(i))), spans(ids_b, lambda i: len(bytes_b(i)))
        own, first = [], 0
        for s, e, i in x:
            while first < len(y) and y[first][1] <= s:
                first += 1
            k = first
            while k < len(y) and y[k][0] < e:
                own.append((i, y[k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        groups, i, j = [], 0, 0
        for cut in cuts:
            left, right = [], []
            while i < len(x) and x[i][1] <= cut:
                left.append(str(x[i][2]))
                i += 1
            while j < len(y) and y[j][1] <= cut:
                right.append(str(y[j][2]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        made.append((doc_id, x, y, own, ";".join(groups)))
        links.update(own)
    best = Counter()
    for (_, right), n in links.items():
        best[right] = max(best[right], n)
    return sorted(((doc_id, len(x), len(y), len(groups.split(";")) if groups else 0, len(own),
                    sum(links[p] == best[p[1]] for p in own), sum(links[p] for p in own),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                   for doc_id, x, y, own, groups in made), key=repr), links


def got(spark, rows):
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as row", "'p' as pair", "2 as bits")
    return sorted(map(tuple, L.report(df, *PATHS).collect()), key=repr)


ODD = ["", None, " ", "  two  spaces ", "a", "é𝔘​", "<|endoftext|> <s> </s> <unk>", "▁",
       "tab\tline\n\n\nend", "\0\x7f", "漢字かな交じり文 with words", "don't WE'LL", "x" * 3000,
       "word " * 9000, " non breaking", "é ﬁ ½ ＡＢＣ", "the the the the", "\r\n\r\n",
       "🙂🙂 👩‍👩‍👧 ok", "1234567890 3.14", "=" * 777]


def test_odd_texts(spark):
    rows = [*enumerate(ODD), (None, "a null id"), (3, "  two  spaces "), (3, "  two  spaces ")]
    assert got(spark, rows) == plain(rows)[0]


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, "")]) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_whole_table_and_pair_counts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    expected, links = plain(rows)
    assert sorted(map(tuple, L.report(docs, *PATHS).collect()), key=repr) == expected
    counts = L.pair_counts(L.align(docs, *PATHS), L.loaded(*PATHS).size_b).collect()
    assert {(r.a, r.b): r.n_links for r in counts} == dict(links)
    assert max(r.n_docs for r in counts) <= len(rows)


def test_small_chunks_give_the_same(folder):
    """Bitmaps of several runs and flushes add up to the same counts."""
    draw = np.random.default_rng(4)
    keys = [draw.integers(0, 40, 5000) << L.CHUNK_BITS | draw.integers(0, 3000, 5000)
            for _ in range(3)]
    whole = Counter(np.concatenate(keys).tolist())
    back, docs = Counter(), Counter()
    for batch in L.index_rows(7, keys):
        rows, found = L.documents_of(batch["bits"], batch["docs"].to_numpy())
        pairs, planes = batch["pair"].to_numpy(), batch["plane"].to_numpy()
        assert set(batch["row"].to_pylist()) == {7}
        for p, d, s in zip(pairs[rows].tolist(), found.tolist(), planes[rows].tolist()):
            back[p << L.CHUNK_BITS | d] += 1 << s
        for p, n in zip(pairs.tolist(), batch["pair_docs"].to_pylist()):
            docs[p] += n
    assert back == whole
    assert docs == Counter(k >> L.CHUNK_BITS for k in whole)


@pytest.mark.parametrize("counts", [[1], [L.LISTED], [L.LISTED + 1], [3, L.LISTED + 9, 2, L.CHUNK]])
def test_bitmaps_round_trip(counts):
    draw = np.random.default_rng(2)
    lists = [np.sort(draw.choice(L.CHUNK, n, replace=False)) for n in counts]
    rows = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum([0, *counts[:-1]])
    bits = L.bitmaps(rows, np.concatenate(lists), starts)
    assert max(len(b) for b in bits.to_pylist()) <= L.FULL
    back, docs = L.documents_of(pa.concat_arrays([bits]), np.array(counts))
    assert [sorted(docs[back == i].tolist()) for i in range(len(counts))] \
        == [own.tolist() for own in lists]
