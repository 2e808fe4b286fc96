"""Language identification in two steps: family first, then languages within the family.

A softmax regression over letter trigrams names the family. Within a family every two languages
have their own linear support vector machine and the most votes win, so machines only ever
separate close relatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import fraction, lean, objects, stored
from tidemark.session import inline_rows

UNKNOWN = "und"
DIMENSIONS = 2048  # hashed letter trigrams
SAMPLE_ROWS = 6000  # expected bound on labelled rows that models are fitted on, all languages
SLICE = 1 << 20
PART = 512  # texts whose vectors are held at a time
STEPS = 300

#: Families of language codes; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be bg pl cs sk sl hr sr bs mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "indic": "hi bn mr ne pa gu ur",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

LETTERS = regex.compile(r"\p{L}+").findall


def family(code: str) -> str:
    return FAMILY_OF.get(code, f"only {code}")


def trigrams(text: str | None) -> np.ndarray | None:
    """Unit vector of square roots of hashed trigram counts over all of the text's letters.

    Words are lower-cased runs of letters; everything else is a word end. None without a letter.
    """
    words = LETTERS((text or "").lower())
    if not words:
        return None
    raw = np.frombuffer(f" {' '.join(words)} ".encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(DIMENSIONS, np.int64)
    for i in range(0, len(raw) - 2, SLICE):
        b = raw[i:i + SLICE + 2].astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) \
            ^ (b[2:] * np.uint32(0xC2B2AE3D))
        counts += np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(DIMENSIONS - 1),
                              minlength=DIMENSIONS)
    vector = np.sqrt(counts)
    return (vector / np.linalg.norm(vector)).astype(np.float32)


def _descend(x, loss_slope, outputs, penalty):
    """Accelerated gradient descent on weights for rows x (last column: the constant 1)."""
    n = len(x)
    probe = np.ones(x.shape[1])
    for _ in range(20):
        probe = x.T @ (x @ probe)
        probe /= np.linalg.norm(probe)
    step = 1 / (2 * np.linalg.norm(x @ probe) ** 2 / n + penalty)
    w = ahead = np.zeros((x.shape[1], outputs))
    for k in range(STEPS):
        new = ahead - step * (x.T @ loss_slope(x @ ahead) / n + penalty * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    wanted = np.eye(classes)[y]
    weight = (len(y) / classes / np.maximum(np.bincount(y, minlength=classes), 1))[y][:, None]

    def slope(z):
        e = np.exp(z - z.max(1, keepdims=True))
        return weight * (e / e.sum(1, keepdims=True) - wanted)

    return _descend(x, slope, classes, 1e-4)


def fit_svm(x: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Squared-hinge support vector machine; both classes weigh the same."""
    weight = np.where(sign > 0, len(sign) / 2 / max((sign > 0).sum(), 1),
                      len(sign) / 2 / max((sign < 0).sum(), 1))

    def slope(z):
        return -2 * (weight * sign * np.maximum(0, 1 - sign * z[:, 0]))[:, None]

    return _descend(x, slope, 1, 1e-4)[:, 0]


@dataclass
class Model:
    """Family weights and pairwise machines; small: languages and pairs, not rows."""

    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    root: np.ndarray | None = None
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Languages and scores in [0, 1] for trigram vectors."""
        if not self.families:
            return np.full(len(x), UNKNOWN, object), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        z = x @ self.root
        e = np.exp(z - z.max(1, keepdims=True))
        chance = e / e.sum(1, keepdims=True)
        best = chance.argmax(1)
        names, scores = np.empty(len(x), object), chance[np.arange(len(x)), best]
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            codes = self.members[name]
            if not len(rows):
                continue
            if len(codes) == 1:
                names[rows] = codes[0]
                continue
            votes, trust = np.zeros((2, len(rows), len(codes)))
            for a, b in combinations(range(len(codes)), 2):
                margin = x[rows] @ self.pairs[codes[a], codes[b]]
                sure = 1 / (1 + np.exp(-3 * margin))
                votes[:, a] += margin >= 0
                votes[:, b] += margin < 0
                trust[:, a] += sure
                trust[:, b] += 1 - sure
            trust /= len(codes) - 1
            won = (votes + trust / 2).argmax(1)
            names[rows] = np.array(codes, object)[won]
            scores[rows] *= trust[np.arange(len(rows)), won]
        return names, np.clip(scores, 0, 1)


def held_out(id_col: str) -> Column:
    """Rows that no model is fitted on: one in five by the id's checksum, and rows without id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
                  sample_rows: int) -> DataFrame:
    """A bounded sample of labelled rows as vectors: about as many of each language.

    Counts cover all labelled rows; the sample is chosen by a hash of the id.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"), held_out(id_col).alias("out")) \
        .where("not out and lang is not null and text is not null").drop("out")
    counts = rows.groupBy("lang").count().collect()  # a row per language
    share = inline_rows(docs.sparkSession, {"lang": "string", "share": "double"}, [
        (r["lang"], sample_rows / len(counts) / r["count"]) for r in counts])
    chosen = rows.join(share, "lang").where(
        fraction(F.col("id"), F.lit("language")) < F.col("share"))

    def run(batches):
        for batch in batches:
            vectors = [trigrams(t) for t in batch["text"]]
            keep = [i for i, v in enumerate(vectors) if v is not None]
            yield pd.DataFrame({"id": batch["id"].iloc[keep], "lang": batch["lang"].iloc[keep],
                                "x": objects(vectors[i] for i in keep).set_axis(batch.index[keep])})

    return chosen.select("id", "text", "lang").mapInPandas(
        run, "id long, lang string, x array<float>")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit family weights and all pairwise machines, each in a task of its own."""
    rows = stored(training_rows(docs, id_col, text_col, lang_col, sample_rows))
    codes = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not codes:
        return Model()
    members: dict[str, list[str]] = {}
    for code in codes:
        members.setdefault(family(code), []).append(code)
    families = sorted(members)
    tasks = [("", "", code) for code in codes]
    for listed in members.values():
        for a, b in combinations(listed, 2):
            tasks += [(a, b, a), (a, b, b)]
    wanted = inline_rows(docs.sparkSession, {"a": "string", "b": "string", "lang": "string"},
                         tasks)

    def fit_one(key, data):
        data = data.sort_values(["id", "lang"])
        x = np.hstack([np.stack(data["x"]).astype(np.float64), np.ones((len(data), 1))])
        if key[0]:
            w = fit_svm(x, np.where(data["lang"] == key[0], 1.0, -1.0))
        else:
            y = data["lang"].map(lambda c: families.index(family(c))).to_numpy()
            w = fit_softmax(x, y, len(families)).ravel()
        return pd.DataFrame({"a": [key[0]], "b": [key[1]], "w": [w]})

    fitted = (rows.join(wanted, "lang").groupBy("a", "b")
              .applyInPandas(fit_one, "a string, b string, w array<double>").collect())
    weights = {(r.a, r.b): np.array(r.w, np.float32) for r in fitted}
    root = weights.pop(("", "")).reshape(DIMENSIONS + 1, len(families))
    return Model(families, members, root, weights)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from its text alone.

    A null text and one without a letter, an empty one too, give `und` with score 0, as does
    every row where no labelled text was there to learn from. Repeated rows get equal answers; an
    empty table gives an empty result.
    """
    @lean
    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), PART):
                part = batch.iloc[i:i + PART]
                vectors = [trigrams(t) for t in part["text"]]
                known = [k for k, v in enumerate(vectors) if v is not None]
                names, scores = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
                if known:
                    names[known], scores[known] = model.predict(
                        np.stack([vectors[k] for k in known]))
                yield pd.DataFrame({"doc_id": part["id"], "held_out": part["out"],
                                    "lang_pred": names, "score": scores})

    return docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("out"),
                       F.col(text_col).alias("text")).mapInPandas(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Learn from the labelled rows of `docs`, then predict every row."""
    return predict(docs, fit(docs, sample_rows=sample_rows))


def keep_known(docs: DataFrame, lowest: float = 0.2, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of `docs` whose language is recognised with a score of at least `lowest`.

    Decided row by row inside one map, so texts are not shuffled. All columns are kept as they
    came, whatever they are named; `lang` is not an input of the decision. Rows whose text is null,
    empty or without a letter go; whole texts of any length are read; repeated rows are decided
    alike, and every one of them stays or goes. Where no row has a language to learn from, and in
    an empty table, nothing is recognised and the result is empty.
    """
    model = fit(docs, sample_rows=sample_rows)

    @lean
    def decided(batches):
        for texts in batches:
            yield pd.Series(likely(texts, model, lowest))

    @F.pandas_udf("boolean")
    def recognised(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return decided(batches)

    return docs.where(recognised(docs["text"]))


def likely(texts: pd.Series, model: Model, lowest: float) -> np.ndarray:
    """Which texts the model recognises, PART of them at a time."""
    keep = np.zeros(len(texts), bool)
    for i in range(0, len(texts), PART):
        vectors = [trigrams(t) for t in texts.iloc[i:i + PART]]
        known = [k for k, v in enumerate(vectors) if v is not None]
        if known:
            names, scores = model.predict(np.stack([vectors[k] for k in known]))
            keep[np.array(known) + i] = (names != UNKNOWN) & (scores >= lowest)
    return keep
