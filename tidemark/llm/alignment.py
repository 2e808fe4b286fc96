"""Alignment of two tokenizers' tokens, with an inverted index of document bitmaps per token pair.

Both tokenizations cover the same bytes of a document, so every border of either one ends exactly
one overlapping pair of tokens: a link. Borders that both share cut the tokens into groups.

The index holds, for every linked pair of ids and every chunk of CHUNK documents, compressed
bitmaps: plane p has the documents whose number of links of that pair has bit p set. A bitmap is a
list of 16 bit numbers while that is shorter than its bits. Runs of texts are OR-merged into their
chunk's bitmaps inside the task that reads them. Popcounts give document counts (over the planes'
union) and link counts (weighted by plane); Spark adds them over chunks. The postings then carry
the pairs' scores back to the documents, chunk by chunk.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.bpe import Bpe, Decoder, runs_of
from tidemark.llm.common import stored

CHUNK_BITS = 13
CHUNK = 1 << CHUNK_BITS  # documents of a bitmap
FULL = CHUNK // 8  # bytes of a bitmap that is not a list
LISTED = FULL // 2  # documents of the longest list
HELD_LINKS = 1 << 22  # of one chunk in a task's memory; then its bitmaps so far are handed on
BUCKETS = 4  # parts of a chunk's pairs when scores are returned
SPACE = "▁"  # fixed value: the mark that stands for a space in pieces


class Pair:
    """The two tokenizers with the bytes of every id, and texts of ids with what follows them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = Bpe(path_a)
        self.a.split_added = None  # strings of special tokens are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_a = self.a.bytes
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                   for i, p in ((i, self.b.id_to_piece(i)) for i in range(len(self.b)))]
        self.size_a, self.size_b = len(bytes_a), len(bytes_b)
        self.of_a, self.of_b = Decoder(bytes_a), Decoder(bytes_b)
        self.written = Decoder([f"{i}{mark}".encode() for size, marks in (
            (self.size_a, ",|"), (self.size_b, ",;")) for mark in marks for i in range(size)])

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both for every text; none where the tokens' bytes are not the text's own."""
        spaced = [" " + t for t in texts]
        found = self.a.encode_all(spaced)
        other = [np.array(ids, np.int64) for ids in self.b.encode(texts, num_threads=1)]
        wanted = [t.encode() for t in spaced]
        good = [bool(t) for t in texts]
        for listed, decoder in ((found, self.of_a), (other, self.of_b)):
            sizes = np.cumsum([0, *map(len, listed)])
            body, ends = decoder.joined(np.concatenate(listed))
            cuts = np.append(0, ends)[sizes].tolist()
            good = [g and body[i:j] == w for g, i, j, w in zip(good, cuts, cuts[1:], wanted)]
        nothing = np.zeros(0, np.int64)
        return ([ids if g else nothing for ids, g in zip(found, good)],
                [ids if g else nothing for ids, g in zip(other, good)])


@lru_cache(maxsize=1)
def loaded(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Aligned:
    """Links and groups of a run of texts, all in one go: texts stand one after the other."""

    def __init__(self, pair: Pair, found: list[np.ndarray], other: list[np.ndarray]):
        self.n_a, self.n_b = (np.array([*map(len, ids)], np.int64) for ids in (found, other))
        a, b = (np.concatenate(ids).astype(np.int64) for ids in (found, other))
        ends_a, ends_b = np.cumsum(pair.of_a.lengths[a]), np.cumsum(pair.of_b.lengths[b])
        # 1 where a token of the first ends, 2 where one of the second does.
        marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] |= 2
        ends = np.flatnonzero(marks)
        marks = marks[ends]
        here_a, here_b, shared = marks & 1 == 1, marks & 2 == 2, marks == 3
        upto_a, upto_b, upto = (np.cumsum(x) for x in (here_a, here_b, shared))
        at_a, at_b = upto_a - here_a, upto_b - here_b
        self.pairs = a[at_a] * pair.size_b + b[at_b]
        texts = np.arange(len(found))
        self.link_text = np.repeat(texts, self.n_a)[at_a]
        self.n_links = np.bincount(self.link_text, minlength=len(found))
        self.n_groups = np.bincount(self.link_text[shared], minlength=len(found))
        group = upto - shared
        # A group's tokens of the first come behind all tokens of earlier groups.
        before_b = np.concatenate([[0], upto_b[shared]])
        through_a = np.concatenate([upto_a[shared], [0]])
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b[group[here_a]]] = a + pair.size_a * shared[here_a]
        order[np.arange(len(b)) + through_a[group[here_b]]] = \
            b + pair.size_b * shared[here_b] + 2 * pair.size_a
        said, ends = pair.written.joined(order)
        cuts = np.append(0, ends)[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        self.groups = [said[i:j - 1] if j > i else b"" for i, j in zip(cuts, cuts[1:])]


def bitmaps(rows: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bitmap of every row: documents docs[starts[i]:starts[i + 1]], ascending."""
    counts = np.diff(starts, append=len(docs))
    sizes = np.where(counts > LISTED, FULL, 2 * counts)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    body = np.zeros(offsets[-1], np.uint8)
    full = (counts > LISTED)[rows]
    place = offsets[rows] + 2 * (np.arange(len(docs)) - starts[rows])
    body[place[~full]] = docs[~full] & 255
    body[place[~full] + 1] = docs[~full] >> 8
    np.add.at(body, offsets[rows[full]] + (docs[full] >> 3),
              (1 << (docs[full] & 7)).astype(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(counts),
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body)])


def documents_of(bits: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, document) of all postings of bitmaps that hold `counts` documents."""
    if not len(counts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(bits.buffers()[1], np.int32, len(bits) + 1, 4 * bits.offset)
    body = np.frombuffer(bits.buffers()[2], np.uint8)
    offsets = offsets.astype(np.int64)
    full = counts > LISTED
    rows = np.repeat(np.arange(len(counts)), np.where(full, 0, counts))
    before = np.cumsum(np.where(full, 0, counts)) - np.where(full, 0, counts)
    place = offsets[rows] + 2 * (np.arange(len(rows)) - before[rows])
    docs = body[place].astype(np.int64) | body[place + 1].astype(np.int64) << 8
    wide = np.flatnonzero(full)
    if not len(wide):
        return rows, docs
    whole = np.stack([body[offsets[i]:offsets[i] + FULL] for i in wide])
    i, more = np.nonzero(np.unpackbits(whole, axis=1, bitorder="little"))
    return np.concatenate([rows, wide[i]]), np.concatenate([docs, more])


SHAPE = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
         "groups_sha256 string, pair long, plane int, docs int, pair_docs int, bits binary")


def batch_of(n: int, **columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names = [c.split() for c in SHAPE.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], kinds[t]) if c in columns and not isinstance(columns[c], pa.Array)
         else columns[c] if c in columns else pa.nulls(n, kinds[t]) for c, t in names],
        [c for c, _ in names])


def index_rows(chunk: int, keys: list[np.ndarray]):
    """Bitmaps of one chunk from its links, each given as pair << CHUNK_BITS | document."""
    postings, times = np.unique(np.concatenate(keys), return_counts=True)
    pairs, docs = postings >> CHUNK_BITS, postings & (CHUNK - 1)
    distinct, pair_docs = np.unique(pairs, return_counts=True)
    for plane in range(int(times.max(initial=0)).bit_length()):
        on = times >> plane & 1 == 1
        own, starts, rows, counts = np.unique(pairs[on], return_index=True, return_inverse=True,
                                              return_counts=True)
        # The documents of a pair are counted once, with its lowest plane.
        first = np.zeros(len(distinct), bool)
        at = np.searchsorted(distinct, own)
        if plane == 0:
            seen = np.zeros(len(distinct), bool)
        first[at] = ~seen[at]
        seen[at] = True
        yield batch_of(len(own), row=np.full(len(own), chunk), pair=own,
                       plane=np.full(len(own), plane), docs=counts,
                       pair_docs=np.where(first[at], pair_docs[at], 0),
                       bits=bitmaps(rows, docs[on], starts))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Stored rows of two kinds: one per document, and the index's bitmaps (`pair` not null).

    `row` numbers the documents, or the chunk of a bitmap.
    """
    def run(batches):
        pair = loaded(path_a, path_b)
        chunk, keys, held = None, [], 0
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for start, texts in runs_of(batch.column(2)):
                own = numbers[start:start + len(texts)]
                found = Aligned(pair, *pair.tokens(texts))
                yield batch_of(
                    len(own), row=own, doc_id=batch.column(1).slice(start, len(own)),
                    n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups, n_links=found.n_links,
                    groups_sha256=[hashlib.sha256(g).hexdigest() if g else ""
                                   for g in found.groups])
                linked = own[found.link_text]
                for c in np.unique(own >> CHUNK_BITS).tolist():
                    if keys and (c != chunk or held > HELD_LINKS):
                        yield from index_rows(chunk, keys)
                        keys, held = [], 0
                    here = linked >> CHUNK_BITS == c
                    keys.append(found.pairs[here] << CHUNK_BITS | linked[here] & (CHUNK - 1))
                    chunk, held = c, held + len(keys[-1])
        if keys:
            yield from index_rows(chunk, keys)

    return stored(docs.select(F.monotonically_increasing_id().alias("row"),
                              F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).cast("string").alias("text")).mapInArrow(run, SHAPE))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best) of all linked pairs of ids, over all documents.

    `best` tells whether no other pair of the same b has more links.
    """
    counts = aligned.where("pair is not null").groupBy("pair").agg(
        F.sum("pair_docs").alias("n_docs"),
        F.sum(F.expr("shiftleft(cast(docs as long), plane)")).alias("n_links"))
    counts = counts.select("pair", F.expr(f"pair div {size_b}").alias("a"),
                           (F.col("pair") % size_b).alias("b"), "n_docs", "n_links")
    highest = counts.groupBy("b").agg(F.max("n_links").alias("high"))
    return counts.join(highest, "b").select("pair", "a", "b", "n_docs", "n_links",
                                            (F.col("n_links") == F.col("high")).alias("best"))


def returned(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum): the pairs' scores added up along the postings of every document.

    A group has the bitmaps of one chunk for a part of the pairs, and these pairs' scores.
    """
    bucket = F.pmod(F.xxhash64("pair"), F.lit(BUCKETS))
    held = aligned.where("pair is not null").select(
        F.col("row").alias("chunk"), bucket.alias("bucket"), "pair", "plane", "docs", "bits")
    scores = held.select("chunk", "pair").distinct().join(
        counts.select("pair", "n_links", "best"), "pair").select(
            F.col("chunk").alias("of_chunk"), bucket.alias("of_bucket"),
            F.col("pair").alias("of_pair"), "n_links", F.col("best").cast("long").alias("best"))

    def run(bitmaps_here: pa.Table, scores_here: pa.Table) -> pa.Table:
        bitmaps_here = bitmaps_here.combine_chunks()
        scores_here = scores_here.sort_by("of_pair")
        known = scores_here["of_pair"].to_numpy()
        at = np.searchsorted(known, bitmaps_here["pair"].to_numpy())
        bits = bitmaps_here["bits"]
        bits = bits.chunk(0) if bits.num_chunks else pa.array([], pa.binary())
        rows, docs = documents_of(bits, bitmaps_here["docs"].to_numpy())
        times = np.left_shift(1, bitmaps_here["plane"].to_numpy().astype(np.int64))
        sums = {}
        for name in ("n_links", "best"):
            sums[name] = np.zeros(CHUNK, np.int64)
            np.add.at(sums[name], docs, (times * scores_here[name].to_numpy()[at])[rows])
        met = np.flatnonzero(sums["n_links"])
        chunk = bitmaps_here["chunk"][0].as_py() if len(bitmaps_here) else 0
        return pa.table({"row": (chunk << CHUNK_BITS) + met, "n_best": sums["best"][met],
                         "count_sum": sums["n_links"][met]})

    parts = held.groupBy("chunk", "bucket").cogroup(
        scores.groupBy("of_chunk", "of_bucket")).applyInArrow(
            run, "row long, n_best long, count_sum long")
    return parts.groupBy("row").agg(F.sum("n_best").alias("n_best"),
                                    F.sum("count_sum").alias("count_sum"))


def report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row.

    A null or empty text, and one whose tokens do not spell it byte by byte (with the space put
    before it), has no tokens: zeros and an empty digest. Strings of special tokens are plain
    text. Repeated rows, null and equal ids are documents each; an empty table gives an empty
    result; other columns are not read. Whole texts are read, of any length.
    """
    aligned = align(docs, path_a, path_b)
    counts = stored(pair_counts(aligned, loaded(path_a, path_b).size_b))
    own = aligned.where("pair is null").drop("pair", "plane", "docs", "pair_docs", "bits")
    return own.join(returned(aligned, counts), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
