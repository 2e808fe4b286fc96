"""Byte-level BPE encoding by speculation and verification, and decoding.

Per batch, greedy longest matches propose tokens for every new word. An encoding is right exactly
if every two adjacent tokens, merged on their own, stay those two tokens. That is looked up for
all adjacent pairs of the batch in one vectorised pass, and only words with a failing pair go
through exact merging.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import give_back, lean

# Fixed value: the published pre-tokenisation pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_WORDS = 300_000  # per task; a bound on memory, not on results
CACHED_VERDICTS = 400_000
CACHED_LENGTH = 64
RUN_CHARACTERS = 1 << 20  # of the texts that are encoded together
DECODED_IDS = 1 << 20  # that are decoded together
SHORT_WORD = 256  # bytes; longer words are merged by a heap
BITS = 20  # of a token's number
MASK = (1 << BITS) - 1
BORDER = "\u0100"  # no byte, so in no token
NEVER = 1 << 60


def byte_symbols() -> dict[str, int]:
    """The published byte alphabet: printable bytes stand for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@lru_cache(maxsize=1)
def other_classes() -> dict[int, str]:
    """Code points that this regex module puts in another class than the tokenizers library, each
    with a character that both put where the library does.

    The two follow different versions of Unicode. The library's own engine classes every code
    point here, so the words are cut as the library cuts them.
    """
    from tokenizers import Regex, pre_tokenizers
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    classes = {r"\p{L}": "a", r"\p{N}": "0", r"\s": "\t"}
    kept = np.full(len(every), "!")
    ours = np.full(len(every), "!")
    for pattern, stands in classes.items():
        inside = np.ones(len(every), bool)
        rest = pre_tokenizers.Split(Regex(f"{pattern}+"), "removed").pre_tokenize_str(every)
        for _, (start, end) in rest:
            inside[start:end] = False
        kept[inside] = stands
        for found in regex.finditer(f"{pattern}+", every):
            ours[found.start():found.end()] = stands
    return {ord(every[i]): kept[i] for i in np.flatnonzero(kept != ours).tolist()}


class Bpe:
    """Encoder and decoder for one byte-level tokenizer file.

    Tokens are numbers throughout. `steps` maps a pair of tokens to its merge as one number, the
    rank above the merged token, so the smallest number is the merge of the lowest rank.
    """

    def __init__(self, path: str):
        spec, added, self.bytes = read_vocabulary(path)
        self.size = len(self.bytes)
        ids = {t: i for i, t in enumerate(self.bytes) if t and i not in added.values()}
        symbols = byte_symbols()

        def number(token):
            return ids[bytes(symbols[c] for c in token)]

        self.steps = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.steps[number(a) << BITS | number(b)] = rank << BITS | number(a + b)
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.matcher = ahocorasick.Automaton()
        for token, i in ids.items():
            self.matcher.add_word(token.decode("latin-1"), i)
        self.matcher.make_automaton()
        self.added = added
        longest_first = sorted(added, key=len, reverse=True)
        self.split_added = regex.compile(
            "(" + "|".join(map(regex.escape, longest_first)) + ")").split if added else None
        self.pattern = regex.compile(PATTERN)
        self.moved = other_classes()
        self.odd = np.zeros(sys.maxunicode + 1, bool)
        self.odd[list(self.moved)] = True
        self.cache: dict[str, bytes] = {}
        self.verdicts: dict[int, bool] = {}
        self.trees: dict[int, tuple[int, int, int] | None] = {}
        self.exact_words = 0

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, leftmost on ties."""
        return self.merge_long(word) if len(word) > SHORT_WORD else self.merge_short(word)[0]

    def merge_short(self, word: bytes) -> tuple[list[int], tuple[int, int, int] | None]:
        """The tokens, and the last merge as (left, right, rank)."""
        parts = [self.byte_ids[b] for b in word]
        step = self.steps.get
        next_steps = [step(a << BITS | b, NEVER) for a, b in zip(parts, parts[1:])]
        last = None
        while next_steps:
            low = min(next_steps)
            if low == NEVER:
                break
            i = next_steps.index(low)
            new = low & MASK
            last = (parts[i], parts[i + 1], low >> BITS)
            parts[i] = new
            del parts[i + 1], next_steps[i]
            if i:
                next_steps[i - 1] = step(parts[i - 1] << BITS | new, NEVER)
            if i < len(next_steps):
                next_steps[i] = step(new << BITS | parts[i + 1], NEVER)
        return parts, last

    def merge_long(self, word: bytes) -> list[int]:
        """Exact merging by a heap over linked parts, for words of any length."""
        parts = [self.byte_ids[b] for b in word]
        end = len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        steps = self.steps
        keys = (a << BITS | b for a, b in zip(parts, parts[1:]))
        heap = [(steps[k], i, k) for i, k in enumerate(keys) if k in steps]
        heapq.heapify(heap)
        while heap:
            low, i, key = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j >= end or parts[i] << BITS | parts[j] != key:
                continue
            parts[i], parts[j] = low & MASK, -1
            after[i] = after[j]
            if after[j] < end:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < end:
                    key = parts[a] << BITS | parts[after[a]]
                    if key in steps:
                        heapq.heappush(heap, (steps[key], a, key))
        return [t for t in parts if t >= 0]

    def longest_matches(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest tokens of all words in one scan, and how many each word has.

        Words are joined by a character that is in no token, so no token runs over a word's end.
        """
        text = BORDER.join(w.decode("latin-1") for w in words)
        found = np.fromiter(chain.from_iterable(self.matcher.iter_long(text)), np.int64)
        ends, tokens = found[::2], found[1::2]
        borders = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        return tokens, np.diff(np.searchsorted(ends, borders), prepend=0)

    def tree(self, token: int) -> tuple[int, int, int] | None:
        """The last merge (left, right, rank) of a token's own bytes; rank -1 for a byte. None if
        merging those bytes gives something else."""
        if token not in self.trees:
            raw = self.bytes[token]
            parts, last = self.merge_short(raw)
            self.trees[token] = (last or (0, 0, -1)) if parts == [token] else None
        return self.trees[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives just these two tokens.

        Each token grows by its own merges. Going back in time from the finished tokens, the later
        of the two last merges is undone, so every two parts that ever touch at the border are
        met. They would merge if their rank comes before the merges that end them; on equal ranks
        the leftmost pair wins.
        """
        a, b = self.tree(left), self.tree(right)
        if a is None or b is None:
            return False
        left_end = right_end = NEVER
        while True:
            rank = self.steps.get(left << BITS | right, NEVER)
            if rank != NEVER and rank >> BITS < left_end and rank >> BITS <= right_end:
                return False
            if a[2] < 0 and b[2] < 0:
                return True
            if a[2] >= b[2]:
                left, left_end = a[1], a[2]
                a = self.tree(left)
            else:
                right, right_end = b[0], b[2]
                b = self.tree(right)
            if a is None or b is None:
                return False

    def compatible(self, codes: np.ndarray) -> np.ndarray:
        """The verdict on each code, computed once per distinct one.

        A code is left * (size + 1) + right; right = size asks whether the left token is its own
        encoding.
        """
        distinct, at = np.unique(codes, return_inverse=True)
        verdicts = self.verdicts
        if len(verdicts) > CACHED_VERDICTS:
            verdicts.clear()
        listed = distinct.tolist()
        for code in listed:
            if code not in verdicts:
                left, right = divmod(code, self.size + 1)
                verdicts[code] = (self.tree(left) is not None if right == self.size
                                  else self.stay_apart(left, right))
        return np.fromiter(map(verdicts.__getitem__, listed), bool, len(listed))[at]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words that are not empty, as packed 32-bit numbers."""
        raw = [w.encode("utf-8", "replace") for w in words]
        flat, lengths = self.longest_matches(raw)
        ends = np.cumsum(lengths)
        right = np.append(flat[1:], self.size)
        asked = np.ones(len(flat), bool)
        asked[ends - 1] = lengths == 1  # a lone token must be its own encoding
        right[ends - 1] = self.size
        good = np.ones(len(flat), bool)
        good[asked] = self.compatible(flat[asked] * (self.size + 1) + right[asked])
        whole = np.logical_and.reduceat(good, ends - lengths)
        packed = flat.astype(np.int32).tobytes()
        starts = (4 * (ends - lengths)).tolist()
        out = {w: packed[a:b] for w, a, b in zip(words, starts, (4 * ends).tolist())}
        for k in np.flatnonzero(~whole).tolist():
            out[words[k]] = np.array(self.merge(raw[k]), np.int32).tobytes()
            self.exact_words += 1
        return out

    def words(self, text: str) -> list[str]:
        """The text cut into words, as the library's version of Unicode has it."""
        if text.isascii() or not self.odd[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            return self.pattern.findall(text)
        plain = text.translate(self.moved)
        return [text[m.start():m.end()] for m in self.pattern.finditer(plain)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts; the strings of added tokens in them become those tokens.

        Words that are new to the cache are proposed, verified and merged together.
        """
        split = self.split_added or (lambda text: [text])
        pieces = [split(t) for t in texts]
        plain = [[self.words(p) for p in parts[::2]] for parts in pieces]
        used = set().union(*chain.from_iterable(plain))
        cache = self.cache
        new = [w for w in used if w not in cache]
        if len(cache) + len(new) > CACHED_WORDS:
            cache.clear()
            new = list(used)
        if new:
            cache.update(self.encode_words(new))
        get = cache.__getitem__
        out = []
        for parts, words in zip(pieces, plain):
            packed = [b"".join(map(get, words[0]))]
            for token, more in zip(parts[1::2], words[1:]):
                packed += [np.int32(self.added[token]).tobytes(), *map(get, more)]
            out.append(np.frombuffer(b"".join(packed), np.int32))
        for w in new:
            if len(w) > CACHED_LENGTH:
                del cache[w]
        return out

    def forget(self) -> None:
        """Empty the caches, which a reused worker would hold through steps that do not encode."""
        self.cache, self.verdicts = {}, {}

    def decode(self, ids: list[int]) -> str:
        return joined(self.bytes, ids)


def read_vocabulary(path: str) -> tuple[dict, dict[str, int], list[bytes]]:
    """The file, its added tokens, and the bytes of every id."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    symbols = byte_symbols()
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that strip or need word ends are not supported")
    vocabulary = spec["model"]["vocab"]
    listed = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
    for token, i in vocabulary.items():
        listed[i] = bytes(symbols[c] for c in token)
    for token, i in added.items():
        listed[i] = token.encode()
    return spec, added, listed


def joined(vocabulary: list[bytes], ids: list[int]) -> str:
    return b"".join(map(vocabulary.__getitem__, ids)).decode("utf-8", "replace")


class Decoder:
    """All tokens' bytes in one buffer, so that a batch of ids is decoded by one gathering."""

    def __init__(self, vocabulary: list[bytes]):
        self.bytes = np.frombuffer(b"".join(vocabulary), np.uint8)
        self.lengths = np.array([*map(len, vocabulary)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def joined(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids one after the other, and where each id's end."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.bytes[at].tobytes(), ends

    def texts(self, ids: pa.ListArray) -> pa.Array:
        """The text of every list of ids, null for a null list, in runs of DECODED_IDS."""
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        stops, out, first = np.cumsum(sizes), [], 0
        while first < len(sizes):
            low = stops[first] - sizes[first]
            last = max(int(np.searchsorted(stops, low + DECODED_IDS, "right")), first + 1)
            body, ends = self.joined(flat[low:stops[last - 1]])
            cuts = np.concatenate([[0], ends])[np.concatenate([[low], stops[first:last]]) - low]
            cuts = cuts.tolist()
            out += [body[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
            first = last
        nothing = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array(out, pa.string(), mask=nothing if nothing.any() else None)


@lru_cache(maxsize=2)
def decoder_of(path: str) -> Decoder:
    return Decoder(read_vocabulary(path)[2])


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    bpe = Bpe(path)
    give_back()  # classing all code points takes much more than it leaves
    return bpe


def runs_of(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts (null: empty) in runs that end once they have RUN_CHARACTERS, with where they start."""
    start, texts, size = 0, [], 0
    for i, text in enumerate(column):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= RUN_CHARACTERS or i == len(column) - 1:
            yield start, texts
            start, texts, size = i + 1, [], 0


def encode(docs: DataFrame, path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row: the whole text's tokens, no special tokens added.

    A null or empty text has no tokens. Repeated rows are encoded each; an empty table gives an
    empty result; no other column is read. Rows are independent, so nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    @lean
    def run(batches):
        bpe = loaded(path)
        try:
            for batch in batches:
                for start, texts in runs_of(batch.column(1)):
                    ids = bpe.encode_all(texts)
                    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, len(ids)),
                         pa.ListArray.from_arrays(ends, np.concatenate(ids))], [id_col, "ids"])
        finally:
            bpe.forget()

    return docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(id, ids, text): every row's ids and the text they stand for, special tokens included.

    Null ids give a null text, an empty list an empty one. Bytes that are no UTF-8 become
    replacement characters. An empty table gives an empty result; no other column is read.
    """
    kind = tokens.schema[id_col].dataType.simpleString()

    @lean
    def run(batches):
        table = decoder_of(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, table.texts(batch.column(1))], [id_col, "ids", "text"])

    return tokens.select(F.col(id_col), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"`{id_col}` {kind}, ids array<int>, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text decoded from them."""
    back = decode(encode(docs, path), path)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(listed, 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))
