"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A bounded, documented sample of labelled documents is turned into tf-idf rows
over hashed terms (words, word shapes, pairs of shapes, repeated words), and a
truncated SVD of those rows gives the latent space.  Every document is
projected into it, and exact cosine products with *all* labelled vectors are
computed block by block; the nearest ``k`` vote with weights that grow with
their similarity.

What is broadcast is bounded by parameters and not by the data: a
``n_terms x n_dims`` projection and at most ``2 * per_class`` labelled vectors
(with the defaults 1.0 MB and 0.8 MB).

Defined results:

* null and empty texts, and texts without words, have no terms: their score is
  the sample's share of label 1;
* no labelled sample at all: every score is 0.5;
* the whole of a text is read, however long, as counts of a fixed number of terms;
* neighbours that tie for the last vote (cosines are compared to five places) vote in the
  order of the sample: least id first, then label 0, then the least term counts;
* equal texts get equal scores; repeated rows each get their own result row;
* columns other than the id and the text are never read by a score, and are
  kept as they are by :func:`with_quality_score`.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_crc, slices

THRESHOLD = 0.3  # fixed by the contract: predicted 1 from this score on
HELD_OUT_MOD = 5  # fixed by the contract: labels of ids with crc32 mod 5 = 0 are never learned

N_TERMS = 4096
N_DIMS = 64
PER_CLASS = 1600
NEIGHBOURS = 15
BLOCK = 256
WORD_CACHE = 400_000


class _Kinds(dict):
    """Character code -> its kind: A, a, 9 or the character itself."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        kind = "A" if ch.isupper() else "a" if ch.isalpha() else "9" if ch.isdigit() else ch
        if len(self) < 1 << 16:
            self[code] = kind
        return kind


_KINDS = _Kinds()
_RUN = re.compile(r"(.)\1+", re.DOTALL)


def word_shape(word: str) -> str:
    """Runs of capitals, small letters and digits as one A, a and 9; other characters once per run."""
    return _RUN.sub(r"\1", word.translate(_KINDS))


class Terms(dict):
    """Hashed term counts of texts; remembers the packed terms of words it has met (bounded)."""

    def __init__(self, n_terms: int = N_TERMS):
        super().__init__()
        self.n_terms = n_terms
        self._shapes: dict[str, int] = {}

    def _slot(self, kind: str, value: str) -> int:
        return zlib.crc32(f"{kind}:{value}".encode("utf-8", "replace")) % self.n_terms

    def __missing__(self, word: str) -> int:
        """Word slot and shape slot in one integer."""
        shape = word_shape(word)
        slot = self._shapes.get(shape)
        if slot is None:
            if len(self._shapes) >= WORD_CACHE:
                self._shapes.clear()
            slot = self._slot("shape", shape)
            if len(shape) <= 64:
                self._shapes[shape] = slot
        found = zlib.crc32(word.lower().encode("utf-8", "replace")) % self.n_terms << 16 | slot
        if len(self) >= WORD_CACHE:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found

    def counts(self, text: str | None) -> np.ndarray:
        """Term counts of one whole text, as a float32 row."""
        words = (text or "").split()
        if not words:
            return np.zeros(self.n_terms, np.float32)
        packed = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        word, shape = packed >> 16, packed & 0xFFFF
        shape_pair = (shape[:-1] * 31 + shape[1:] * 17 + 7) % self.n_terms
        of_words = np.bincount(word, minlength=self.n_terms)
        row = of_words + np.bincount(shape, minlength=self.n_terms) + np.bincount(shape_pair, minlength=self.n_terms)
        row[self._slot("again", "word")] += int((word[1:] == word[:-1]).sum())
        # how often the commonest word recurs, in steps of an eighth of the text
        row[self._slot("share", str(8 * int(of_words.max()) // len(words)))] += len(words) // 8 + 1
        return row.astype(np.float32)

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        return np.stack([self.counts(t) for t in texts]) if texts else np.zeros((0, self.n_terms), np.float32)


@functools.lru_cache(maxsize=1)
def terms_of(n_terms: int) -> Terms:
    """The word terms that this Python worker remembers."""
    return Terms(n_terms)


@dataclass(frozen=True)
class KnnModel:
    """Projection and labelled vectors; ``vectors`` has unit rows (or zero rows)."""

    n_terms: int
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int
    prior: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts) * self.idf) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Scores of a block of documents: exact cosines with every labelled vector, then votes."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        steps = np.rint((self.embed(counts) @ self.vectors.T) * 1e5).astype(np.int64)
        n = steps.shape[1]
        k = min(self.k, n)
        # no two keys are equal, so ties for the last vote go to the first in the sample
        near = np.argpartition(np.arange(n) - steps * n, k - 1, axis=1)[:, :k]
        weight = (np.clip(np.take_along_axis(steps, near, axis=1), 0, None) / 1e5) ** 8
        votes = (weight * self.labels[near]).sum(axis=1)
        total = weight.sum(axis=1)
        smooth = 1e-6
        return np.clip((votes + smooth * self.prior) / (total + smooth), 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def latent_projection(rows: np.ndarray, n_dims: int, rounds: int = 4, seed: int = 7) -> np.ndarray:
    """Right singular vectors of ``rows`` by subspace iteration (``terms x n_dims``)."""
    n_dims = max(1, min(n_dims, *rows.shape))
    rng = np.random.default_rng(seed)
    basis = rng.standard_normal((rows.shape[1], min(rows.shape[1], n_dims + 16))).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, vt = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ vt[:n_dims].T).astype(np.float32)


def fit_knn(counts: np.ndarray, labels: np.ndarray, n_dims: int = N_DIMS, k: int = NEIGHBOURS) -> KnnModel:
    """Fit idf, projection and labelled vectors to the sample's term counts."""
    n_terms = counts.shape[1]
    if not len(labels):
        return KnnModel(n_terms, np.ones(n_terms, np.float32), np.zeros((n_terms, 1), np.float32),
                        np.zeros((0, 1), np.float32), np.zeros(0), k, 0.5)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    rows = _unit(np.log1p(counts) * idf)
    projection = latent_projection(rows, n_dims)
    return KnnModel(n_terms, idf, projection, _unit(rows @ projection), labels.astype(np.float64), k,
                    float(labels.mean()))


def labelled_sample(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", per_class: int = PER_CLASS) -> DataFrame:
    """At most ``per_class`` documents of each label, least hash of the id first.

    The choice is made on distinct ids and labels alone; the chosen ids (at most
    ``2 * per_class``) are broadcast to one scan of the texts.  An id that repeats
    counts once for each of its labels, with its least text.  Rows with a
    null id, label or text, and held-out ids, are never learned from.
    """
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).where(
        F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & (id_crc(F.col("_id")) % HELD_OUT_MOD != 0)).distinct()
    rows = rows.withColumn("_order", F.xxhash64(F.col("_id").cast("string")))
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col("_label") == value).orderBy("_order", "_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    return texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id", "_label").agg(
        F.min("_text").alias("_text")).select("_id", "_text", "_label")


def train(documents: DataFrame, labels: DataFrame, *, n_terms: int = N_TERMS, n_dims: int = N_DIMS,
          k: int = NEIGHBOURS, **sample) -> KnnModel:
    """Fit a model to the bounded labelled sample; term counts are made on the executors."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = terms_of(n_terms)
        for b in batches:
            packed = []
            for text in b["_text"]:
                row = terms.counts(text)
                at = np.flatnonzero(row)
                packed.append(at.astype("<u4").tobytes() + row[at].astype("<f4").tobytes())
            yield pd.DataFrame({"id": b["_id"], "label": b["_label"].astype("int32"), "row": packed})

    sample_rows = labelled_sample(documents, labels, **sample)
    got = sorted((r["id"], r["label"], bytes(r["row"])) for r in
                 sample_rows.mapInPandas(count, "id long, label int, row binary").collect())
    counts = np.zeros((len(got), n_terms), np.float32)
    for i, (_, _, row) in enumerate(got):
        half = len(row) // 2
        counts[i, np.frombuffer(row[:half], "<u4")] = np.frombuffer(row[half:], "<f4")
    return fit_knn(counts, np.array([g[1] for g in got], np.float64), n_dims, k)


def quality_score(model: KnnModel, text: Column) -> Column:
    """Score of every whole text, by Arrow batches."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = terms_of(model.n_terms)
        for texts in batches:
            values = texts.tolist()
            parts = [model.score(terms.matrix(values[a:b])) for a, b in slices(len(values), BLOCK)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.coalesce(text, F.lit("")))


def with_quality_score(documents: DataFrame, model: KnnModel, out_col: str = "score", text_col: str = "text") -> DataFrame:
    """``documents`` with a score column; one pass, no shuffle."""
    return documents.withColumn(out_col, quality_score(model, F.col(text_col)))


def classify(documents: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``."""
    model = train(documents, labels, **sample)
    rows = with_quality_score(documents.select("doc_id", "text"), model, "score")
    return rows.select("doc_id", F.coalesce(id_crc(F.col("doc_id")) % HELD_OUT_MOD == 0, F.lit(False)).alias("held_out"),
                       "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, **sample) -> DataFrame:
    """The documents predicted 1, with their own columns."""
    model = train(documents, labels, **sample)
    kept = documents.where(quality_score(model, F.col("text")) >= THRESHOLD)
    return kept
