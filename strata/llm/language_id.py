"""Language identification with string kernels.

The kernel of two texts is the blended spectrum of presence bits: the number of
character n-grams (n = 1, 2, 3) that both hold, over the geometric mean of the
numbers each holds.  N-grams are taken from lower-cased letters, every other
run counting as one space, and hashed to ``N_BITS`` presence bits.

Learning: a bounded sample (``PER_LANGUAGE`` documents a language, fewer when
there are very many languages) of the learnable documents gives presence bits;
some of them, spread over the languages, are Nystroem landmarks; one-versus-rest
kernel ridge regression is solved in the landmarks' feature space.  Scoring: a
block of texts becomes a matrix of presence bits; one product with the
landmarks' bits gives all kernels and a second one all languages' scores.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when nothing could be learned; equal texts get equal
answers; ties go to the alphabetically first language; repeated rows each get
their own result.  Only the text is read by a prediction; whether a document
is held out follows from its id; a null id is not held out, and rows with a null
id, text or language are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import id_crc, slices

HELD_OUT_MOD, HELD_OUT = 3, 1  # fixed by the contract
UNKNOWN = "und"  # fixed by the contract

N_BITS = 1 << 14
ORDERS = (1, 2, 3)
PER_LANGUAGE = 400
MAX_SAMPLE = 8192
N_LANDMARKS = 160
RIDGE = 1e-3
BLOCK = 128
_LONG = 1 << 16  # characters turned into n-grams at a time
_SALTS = 16  # tasks that share the rows of one language


class _Letters(dict):
    """Character code -> code of the lower-case letter, or of a space."""

    def __missing__(self, code: int) -> int:
        ch = chr(code)
        low = ch.lower()
        value = (ord(low[0]) if low[0].isalpha() else 32) if ch.isalpha() else 32
        if len(self) < 1 << 16:
            self[code] = value
        return value


class Presence:
    """Presence bits of texts."""

    def __init__(self) -> None:
        self._letters = _Letters()
        self._table = np.array([self._letters[c] for c in range(0x3000)], np.uint32)

    def codes(self, text: str) -> np.ndarray:
        """Codes of the letters, each other run as one space, with a space at both ends."""
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        low = self._table[np.minimum(raw, len(self._table) - 1)]
        if len(raw) and raw.max() >= len(self._table):
            for at in np.flatnonzero(raw >= len(self._table)):
                low[at] = self._letters[int(raw[at])]
        low = np.concatenate([[np.uint32(32)], low, [np.uint32(32)]]).astype(np.uint32)
        keep = np.ones(len(low), bool)
        keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
        return low[keep]

    def bits(self, text: str | None) -> np.ndarray | None:
        """The presence bits of a whole text; None without a letter."""
        codes = self.codes(text or "")
        if len(codes) < 2:
            return None
        out = np.zeros(N_BITS, bool)
        for start in range(0, len(codes), _LONG):
            part = codes[start:start + _LONG + max(ORDERS) - 1]
            mixed = np.zeros(len(part), np.uint32)
            for n in ORDERS:
                m = len(part) - n + 1
                if m <= 0:
                    break
                mixed = (mixed[:m] * np.uint32(0x01000193) ^ part[n - 1:]) * np.uint32(0x9E3779B1) + np.uint32(n)
                out[(mixed ^ mixed >> np.uint32(15)) & np.uint32(N_BITS - 1)] = True
        return out


@dataclass(frozen=True)
class KernelModel:
    """Landmarks' presence bits (unit length rows, transposed) and one weight column per language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def kernels(self, bits: np.ndarray) -> np.ndarray:
        """Kernel of every row of presence bits with every landmark."""
        size = np.sqrt(np.maximum(bits.sum(axis=1, dtype=np.float32), 1))
        return (bits.astype(np.float32) @ self.landmarks) / size[:, None]

    def predict(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language's number and its score for every row."""
        scores = np.round(self.kernels(bits) @ self.weights, 5)
        best = scores.argmax(axis=1)
        return best, np.clip(scores[np.arange(len(best)), best], 0.0, 1.0)


def fit_kernel(bits: np.ndarray, languages: list[str], n_landmarks: int = N_LANDMARKS) -> KernelModel:
    """Landmarks and one-versus-rest ridge weights from a sample's presence bits."""
    names = sorted(set(languages))
    if not names:
        return KernelModel([], np.zeros((N_BITS, 1), np.float32), np.zeros((1, 1), np.float32))
    label = np.array([names.index(x) for x in languages])
    turn = np.zeros(len(label), np.int64)  # how many of its language come before a row
    for k in range(len(names)):
        turn[label == k] = np.arange((label == k).sum())
    chosen = np.lexsort((label, turn))[:max(n_landmarks, len(names))]
    unit = bits.astype(np.float32) / np.sqrt(np.maximum(bits.sum(axis=1, keepdims=True), 1))
    landmarks = unit[chosen]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    use = values > 1e-6 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])  # W ** -1/2 on the span of the landmarks
    features = (unit @ landmarks.T).astype(np.float64) @ root
    targets = (label[:, None] == np.arange(len(names))).astype(np.float64)
    balance = 1.0 / np.bincount(label)[label][:, None]  # every language weighs the same
    gram = features.T @ (features * balance) + RIDGE * np.eye(features.shape[1])
    weights = root @ np.linalg.solve(gram, features.T @ (targets * balance))
    return KernelModel(names, np.ascontiguousarray(landmarks.T), weights.astype(np.float32))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(id_crc(doc_id) % HELD_OUT_MOD == HELD_OUT, F.lit(False))


def learning_sample(documents: DataFrame) -> DataFrame:
    """``text, lang`` of a bounded sample: for each language the documents of least id hash.

    Languages are counted first; the choice is made on distinct ids and languages alone,
    first in each task (by Spark), then in ``_SALTS`` parts of each language cut by the id
    hash, and last among what the parts kept, so that no task gets a whole hot language.
    The chosen ids are broadcast to one scan of the texts.  An id that repeats counts once
    for each of its languages, with its least text.
    """
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                           & ~is_held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.xxhash64(F.col("doc_id").cast("string")).alias("_order")).distinct()
    n_languages = max(1, rows.select("_lang").distinct().count())
    each = max(1, min(PER_LANGUAGE, MAX_SAMPLE // n_languages))
    chosen = rows
    for part in (["_lang", F.pmod("_order", F.lit(_SALTS))], ["_lang"]):
        place = F.row_number().over(Window.partitionBy(*part).orderBy("_order", "_id"))
        chosen = chosen.withColumn("_n", place).where(F.col("_n") <= each)
    chosen = chosen.orderBy("_order", "_id", "_lang").limit(MAX_SAMPLE)
    texts = documents.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"), F.col("lang").alias("_own")).where("_text IS NOT NULL")
    return texts.join(F.broadcast(chosen.select("_id", "_lang")),
                      (F.col("_doc") == F.col("_id")) & (F.col("_own") == F.col("_lang"))).groupBy("_id", "_lang").agg(
        F.min("_text").alias("_text")).select("_id", "_text", "_lang")


def train(documents: DataFrame, n_landmarks: int = N_LANDMARKS) -> KernelModel:
    """Fit to the bounded sample; presence bits are made on the executors."""
    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Presence()
        for b in batches:
            packed = [None if (x := make.bits(t)) is None else np.packbits(x).tobytes() for t in b["_text"]]
            yield pd.DataFrame({"id": b["_id"], "lang": b["_lang"], "bits": packed})

    rows = learning_sample(documents).mapInPandas(presence, "id long, lang string, bits binary").where("bits IS NOT NULL")
    got = sorted((r["id"], r["lang"], bytes(r["bits"])) for r in rows.collect())
    bits = np.unpackbits(np.frombuffer(b"".join(g[2] for g in got), np.uint8)).reshape(-1, N_BITS).astype(bool)
    return fit_kernel(bits, [g[1] for g in got], n_landmarks)


def language(model: KernelModel, text: Column) -> Column:
    """Struct of ``lang_pred`` and ``score`` for every whole text."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        make = Presence()
        for texts in batches:
            names = np.full(len(texts), UNKNOWN, object)
            scores = np.zeros(len(texts))
            values = texts.tolist()
            for a, b in slices(len(values) if model.languages else 0, BLOCK):
                rows = [(i, x) for i in range(a, b) if (x := make.bits(values[i])) is not None]
                if rows:
                    at = [i for i, _ in rows]
                    best, scores[at] = model.predict(np.stack([x for _, x in rows]))
                    names[at] = [model.languages[k] for k in best]
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(F.coalesce(text, F.lit("")))


def identify(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``documents``."""
    model = train(documents)
    found = documents.select("doc_id", language(model, F.col("text")).alias("_found"))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "_found.lang_pred", "_found.score")
