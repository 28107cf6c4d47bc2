"""Quality rules: base rules on repetition, and a hashed n-gram log-likelihood ratio.

Two multinomials over ``N_BUCKETS`` hashed n-grams are counted over *all*
documents: the raw corpus, and the trusted target (documents labelled good and
not toxic).  A document's ratio is the mean over its n-grams of
``log(target / raw)``, and a document is kept when the base rules pass and the
mean ratio reaches ``MIN_RATIO``; nothing is drawn at random.

N-grams: every word, every pair of neighbouring words, and the last two
characters of every word; word ends carry over to words never seen.

Only DataFrame functions are used.  The counting pass explodes n-grams and sums
them map-side into at most ``N_BUCKETS`` sums per task, so the shuffle does not
grow with a frequent n-gram; the model that every task gets back is one array of
``N_BUCKETS`` doubles.  Whether a document is trusted is a shuffled hash join on
the id, the one time that texts move.

Defined results: a null text counts as empty; an empty text has zero counts,
ratio 0 and fails the base rules (fewer than 50 words); repeated rows each get
their own result; a null id is never trusted; with no trusted document, or an
empty corpus, every ratio is 0; when labels of one id differ, the id is trusted
only if all of them are good.  Other columns are not read, and
:func:`keep_passing` returns them untouched whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import words_of

N_BUCKETS = 1 << 14
SMOOTHING = 1.0  # added to the expected count of a bucket, see log_ratios
MIN_RATIO = -0.3  # nats per n-gram
PLACE_BITS = 24  # windows are sorted by a hash with their places behind it; longer texts as text
# Fixed by the task.
SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _hash(kind: str, *parts: Column) -> Column:
    return F.xxhash64(F.lit(kind), *parts)


def _bucket(hashed: Column) -> Column:
    """A hash modulo ``N_BUCKETS``, a power of two."""
    return hashed.bitwiseAND(F.lit(N_BUCKETS - 1))


def _end(word: Column) -> Column:
    return F.substring(word, -2, 2)


def _neighbours(array: Column) -> tuple[Column, Column]:
    """The elements of an array that have one behind them, and those behind them."""
    n = F.greatest(F.size(array) - 1, F.lit(0))
    return F.slice(array, 1, n), F.slice(array, 2, n)


def with_words(documents: DataFrame, *keep: Column, text_col: str = "text") -> DataFrame:
    """``keep`` columns, the text and its words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(*keep, text.alias("_text"), words_of(text).alias("_words"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids all of whose labels are good and not toxic, as ``_trusted_id``."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    ids = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_trusted_id")).agg(
        F.min(F.coalesce(good, F.lit(False))).alias("_good"))
    return ids.where("_good").drop("_good")


def count_ngrams(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, raw, target``: counts over all documents, and over the trusted ones."""
    # the same plan at every size: ids are hashed, texts are shuffled once and not sorted
    ids = trusted_ids(labels).hint("shuffle_hash")
    rows = documents.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_trusted_id"), "left")
    words = F.col("_words")
    split = with_words(rows, F.col("_trusted_id").isNotNull().cast("bigint").alias("_t"))
    # the outer forms, because for the inner ones Spark adds a filter on the array and makes it twice
    pairs = split.select("_t", F.inline_outer(F.arrays_zip(words.alias("w"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("next"))))
    grams = pairs.where("w IS NOT NULL").select("_t", F.explode_outer(F.array(
        _bucket(_hash("word", F.col("w"))), _bucket(_hash("end", _end(F.col("w")))),
        F.when(F.col("next").isNotNull(), _bucket(_hash("pair", F.col("w"), F.col("next")))))).alias("bucket"))
    return grams.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_t").alias("target"))


def log_ratios(counts: list[tuple[int, int, int]]) -> np.ndarray:
    """``log(target / raw)`` per bucket, both smoothed towards the raw shares."""
    raw, target = np.zeros(N_BUCKETS), np.zeros(N_BUCKETS)
    for bucket, r, t in counts:
        raw[bucket], target[bucket] = r, t
    if not target.sum():
        return np.zeros(N_BUCKETS)
    share = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    prior = SMOOTHING * N_BUCKETS * share
    return np.log((target + prior) / (target + prior).sum()) - np.log(share)


def fit(documents: DataFrame, labels: DataFrame) -> np.ndarray:
    """The model: one log ratio per bucket (at most ``N_BUCKETS`` sums reach the driver)."""
    return log_ratios([(r["bucket"], r["raw"], r["target"]) for r in count_ngrams(documents, labels).collect()])


def _sum_of(values: Column, weights: Column, start: Column, hashed: Callable[[Column], Column] = lambda x: x) -> Column:
    """``start`` plus the weights of the buckets of an array's elements, in order."""
    return F.aggregate(values, start, lambda acc, x: acc + weights[_bucket(hashed(x))])


def _window_hashes(pairs: Column) -> Column:
    """Hashes of all windows of three words from those of their pairs; 40 bits, so that a place fits behind them."""
    return F.zip_with(*_neighbours(pairs), lambda p, q: F.shiftleft(p.bitwiseXOR(F.shiftrightunsigned(q, 13)), PLACE_BITS))


def _placed(hashes: Column) -> Column:
    """Hashes with their places behind them, ascending."""
    # numbers that are never null are sorted as such
    return F.sort_array(F.transform(hashes, lambda h, i: F.coalesce(h.bitwiseOR(i.cast("bigint")), F.lit(0).cast("bigint"))))


def _equal_hashes(placed: Column) -> Column:
    """Starts ``(i, k)`` of windows that are neighbours among those with one hash."""
    place, none = F.lit((1 << PLACE_BITS) - 1), F.lit(-1).cast("bigint")
    both = F.zip_with(*_neighbours(placed), lambda x, y: F.when(
        F.shiftright(x.bitwiseXOR(y), PLACE_BITS) == 0,
        F.shiftleft(x.bitwiseAND(place), PLACE_BITS).bitwiseOR(y.bitwiseAND(place))).otherwise(none))
    return F.transform(F.array_except(both, F.array(none)), lambda x: F.struct(
        F.shiftright(x, PLACE_BITS).cast("int").alias("i"), x.bitwiseAND(place).cast("int").alias("k")))


def _differ(words: Column, equal: Column) -> Column:
    """Whether some of the windows that :func:`_equal_hashes` gives have different words."""
    return F.exists(equal, lambda p: functools.reduce(
        Column.__or__, [F.get(words, p["i"] + j) != F.get(words, p["k"] + j) for j in range(3)]))


def _windows(words: Column) -> Column:
    """All windows of three words, as text, with their starts."""
    starts = F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("i")))


def _equal_windows(at: Column) -> Column:
    """Starts ``(i, k)`` of neighbours in the sorted windows ``at`` that are equal."""
    return F.filter(F.zip_with(*_neighbours(at), lambda x, y: F.when(
        x["g"] == y["g"], F.struct(x["i"].alias("i"), y["i"].alias("k")))), lambda p: p.isNotNull())


def _covered_words(starts: Column) -> Column:
    """Number of words in the windows that start at ``starts``."""
    return F.size(F.array_distinct(F.concat(starts, F.transform(starts, lambda i: i + 1), F.transform(starts, lambda i: i + 2))))


def with_rules(documents: DataFrame, model: np.ndarray, *keep: Column) -> DataFrame:
    """``keep`` columns plus the base counts, ``base_failed``, ``ratio`` and ``kept``.

    Built in layers, so that the words, and the repeated windows, of a text are
    made once and then read by several columns.  Windows are compared by hashes;
    those with one hash are then compared by their words, and where these differ
    the whole text's windows are sorted as text.  The last step passes each row
    through a one-element ``inline``: a filter on its columns then runs on the
    finished values and is not pushed down into copies of the expressions.
    """
    weights = F.lit(np.asarray(model, dtype=np.float64))
    words, pairs, hashes, equal = F.col("_words"), F.col("_pairs"), F.col("_hashes"), F.col("_equal")
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(HAS_WORD))
    names = [f"_k{i}" for i in range(len(keep))]
    out = with_words(documents, *[k.alias(n) for k, n in zip(keep, names, strict=True)]).select(
        *names, "_words", F.size(words).cast("bigint").alias("n_words"),
        F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"), F.zip_with(*_neighbours(words), lambda a, b: _hash("pair", a, b)).alias("_pairs"),
        _sum_of(words, weights, _sum_of(words, weights, F.lit(0.0), lambda w: _hash("word", w)), lambda w: _hash("end", _end(w))).alias("_sum"))
    counts = [*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "ratio"]
    n_grams = 2 * F.size(words) + F.size(pairs)
    out = out.select(
        *names, "_words", "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n_grams > 0, _sum_of(pairs, weights, F.col("_sum")) / n_grams).otherwise(F.lit(0.0)).alias("ratio"),
        _window_hashes(pairs).alias("_hashes"))
    # windows with different hashes differ, so most texts need no exact comparison
    out = out.select(*counts, "_words", F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _placed(hashes)).alias("_placed"))
    out = out.select(*counts, "_words", _equal_hashes(F.col("_placed")).alias("_equal"))
    certain = (F.size(words) < 1 << PLACE_BITS) & ~_differ(words, equal)
    out = out.select(*counts, "_equal", F.when(equal.isNotNull() & ~certain, F.sort_array(_windows(words))).alias("_sorted"))
    out = out.select(*counts, F.when(F.col("_sorted").isNull(), equal).otherwise(_equal_windows(F.col("_sorted"))).alias("_equal"))
    out = out.select(*counts, F.array_union(equal["i"], equal["k"]).alias("_starts"))
    out = out.select(*counts, F.when(F.col("_starts").isNull(), 0).otherwise(_covered_words(F.col("_starts"))).cast("bigint").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= MIN_RATIO))
    return out.select(F.inline_outer(F.array(F.struct(*[F.col(c) for c in out.columns]))))


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The base counts and the verdict for every row of ``documents``."""
    out = with_rules(documents, fit(documents, labels), F.col("doc_id"))
    return out.select(F.col("_k0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "ratio")


def keep_passing(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    out = with_rules(documents, fit(documents, labels), row)
    return out.where("kept").select("_k0.*")
