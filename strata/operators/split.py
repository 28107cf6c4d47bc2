"""Splitting a result into parts.

* :func:`keyed_split` - Bernoulli per key with weights: a hash of ``seed|key`` falls
  into the parts' shares.  A row's part depends on its key, the seed and the weights
  alone, not on partitions or reruns; :func:`random_split` gives its parts as frames.
* :func:`hash_split` - reproducible bucket from an md5 of ``seed|key``; the
  same expression runs in any SQL engine with ``md5``.
* :func:`balanced_split` - the distinct keys, in md5 order, are cut into ``n``
  parts whose sizes differ by at most one (``ntile`` semantics).  The cut points are
  found by radix selection (:func:`cut_points`), and each row's part is then a
  comparison with them: nothing is ranked, sorted or joined.
"""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

ORDER_BITS = 32  # of md5_order
RADIX_BITS = 12  # of the order that one pass of the selection resolves


def keyed_split(df: DataFrame, key: Column | str, weights: Sequence[float] = (0.5, 0.5), seed: int | None = None,
                col: str = "part") -> DataFrame:
    """Add ``col``: part ``i`` with a chance of its share of the ``weights``; rows of a key move together; no shuffle.

    Without a seed one is drawn, once.
    """
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError(f"weights must be non-negative and not all 0: {list(weights)}")
    bounds = [round((1 << ORDER_BITS) * total / sum(weights)) for total in accumulate(weights)]
    at = md5_order(key, secrets.randbits(31) if seed is None else seed)
    last = max(i for i, w in enumerate(weights) if w > 0)
    part = F.lit(last)
    for i in reversed(range(last)):
        part = F.when(at < bounds[i], F.lit(i)).otherwise(part)
    return df.withColumn(col, part.cast("bigint"))


def random_split(df: DataFrame, weights: Sequence[float] = (0.5, 0.5), seed: int | None = None, key: Column | str | None = None) -> list[DataFrame]:
    """:func:`keyed_split` as one frame a part; without a key a row's values are its key (equal rows move together)."""
    rows = keyed_split(df, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if key is None else key, weights, seed, "_part")
    return [rows.where(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def md5_order(key: Column | str, seed: int = 42) -> Column:
    """First 32 bits of ``md5(seed|key)`` as a non-negative bigint."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(k.cast("string"), F.lit(""))))  # a null key has a bucket too
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column | str, n: int = 2, seed: int = 42) -> Column:
    """Bucket ``0..n-1`` of ``key``."""
    return F.pmod(md5_order(key, seed), F.lit(n))


def hash_split(df: DataFrame, key: str, n: int = 2, seed: int = 42, col: str = "part") -> DataFrame:
    """Add ``col`` = :func:`hash_bucket` of ``key``; no shuffle."""
    return df.withColumn(col, hash_bucket(key, n, seed))


def cut_points(keys: DataFrame, key: str, ranks: Sequence[int], seed: int = 42) -> list[tuple[int, object]]:
    """``(order, key)`` of the distinct ``keys`` that stand at the 0-based ``ranks`` in (md5 order, key), null key first.

    Radix selection: each pass counts the keys by the next bits of their order, only
    in the ranges that still hold a wanted rank (at most as many counts as
    ``2**RADIX_BITS`` for each rank), until the order is known in full.  Keys that
    share all its bits are very few and are sorted among themselves.
    """
    ordered = keys.select(F.col(key).alias("key"), md5_order(key, seed).alias("order"))
    found = [(0, rank) for rank in ranks]  # the bits known so far, the rank inside the range that they give
    known = 0
    while known < ORDER_BITS:
        step = min(RADIX_BITS, ORDER_BITS - known)
        prefix = F.shiftright("order", ORDER_BITS - known - step)
        held = F.shiftright("order", ORDER_BITS - known).isin(sorted({bits for bits, _ in found}))
        counts = dict(ordered.where(held).groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect())
        found = [_narrowed(counts, bits << step, step, rank) for bits, rank in found]
        known += step
    return [(order, ordered.where(F.col("order") == order).orderBy(F.col("key").asc_nulls_first()).limit(rank + 1).select(
        "key").collect()[rank][0]) for order, rank in found]


def _narrowed(counts: dict[int, int], first: int, step: int, rank: int) -> tuple[int, int]:
    for bits in range(first, first + (1 << step)):
        if rank < counts.get(bits, 0):
            return bits, rank
        rank -= counts.get(bits, 0)
    raise IndexError("a rank beyond the last key")


def balanced_split(df: DataFrame, key: str, n: int = 2, seed: int = 42, col: str = "part") -> DataFrame:
    """Add ``col``: keys in the order of (md5 order, key), cut into ``n`` near-equal parts.

    The distinct keys are written once to the shared checkpoint folder and selected from.
    """
    path = scratch_path(df.sparkSession, "split-keys")
    df.select(key).distinct().write.parquet(path)
    keys = df.sparkSession.read.parquet(path)
    each, over = divmod(keys.count(), n)
    starts = [i * each + min(i, over) for i in range(1, n) if i * each + min(i, over) < n * each + over]
    part = F.lit(0)
    at, own = md5_order(key, seed), F.col(key)
    for order, cut in cut_points(keys, key, starts, seed):
        tie = F.lit(True) if cut is None else F.coalesce(own >= F.lit(cut), F.lit(False))
        part = part + F.when((at > order) | ((at == order) & tie), 1).otherwise(0)
    return df.withColumn(col, part.cast("bigint"))
