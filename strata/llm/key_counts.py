"""Counting integer keys over a whole corpus with a compact shuffle.

A task counts its own keys first (sorted, equal ones summed) and deals them into
``ranges`` by remainder.  A range of a task is one row: the ascending quotients as
differences, laid out in byte planes, so that the planes that are zero take next to
nothing in Spark's compressed shuffle.  A range is merged by one task; ranges are
even because a key's remainder has nothing to do with how often it occurs, and
frequent keys are summed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RANGES_PER_PARTITION = 4  # several to a partition, so that partitions are even
DEALT = "range int, n int, keys binary, counts binary"


def n_ranges(spark: SparkSession) -> int:
    return RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys and their summed counts, as unsigned 64-bit numbers."""
    if not len(keys):
        return keys.astype(np.uint64), counts.astype(np.uint64)
    free = 64 - int(keys.max()).bit_length()
    if int(counts.max()).bit_length() <= free < 64:  # key and count in one number: sorting numbers is much faster than an order
        both = np.sort(keys.astype(np.uint64) << np.uint64(free) | counts.astype(np.uint64))
        keys, counts = both >> np.uint64(free), both & np.uint64((1 << free) - 1)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order].astype(np.uint64), counts[order].astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def planes(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, four or eight."""
    kind = "<u4" if not len(values) or values.max() < 1 << 32 else "<u8"
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T).tobytes()


def from_planes(data: bytes, n: int) -> np.ndarray:
    width = len(data) // n if n else 4
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.uint64)


def dealt(keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    """One row (:data:`DEALT`) for each range that the distinct ascending ``keys`` touch."""
    of = (keys % np.uint64(ranges)).astype(np.uint16 if ranges <= 1 << 16 else np.int64)  # short numbers sort faster
    order = np.argsort(of, kind="stable")  # stays ascending inside a range
    of, quotient, counts = of[order], keys[order] // np.uint64(ranges), counts[order]
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(of))
    rows = [(int(of[a]), int(b - a), planes(np.diff(quotient[a:b], prepend=np.uint64(0))), planes(counts[a:b].astype(np.uint64)))
            for a, b in zip(starts, ends, strict=True)] if len(of) else []
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()),
                                       pa.array(cols[3], pa.binary())], names=["range", "n", "keys", "counts"])


def merged(rows: DataFrame, ranges: int, least: int = 1) -> DataFrame:
    """``key, n`` summed over all ``rows`` (:data:`DEALT`), keys of fewer than ``least`` left out.  Keys are the bits of a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def total(of: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            quotient, n = summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            keep = n >= least
            keys = quotient[keep] * np.uint64(ranges) + np.uint64(of)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["key", "n"])

        current, held = None, []
        for batch in batches:
            for of, n, keys, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if of != current and held:
                    yield total(current, held)
                    held = []
                current = of
                held.append((np.cumsum(from_planes(keys, n), dtype=np.uint64), from_planes(counts, n)))
                if len(held) >= 64:  # copies of a key from many tasks are summed on the way
                    held = [summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))]
        if held:
            yield total(current, held)

    together = rows.repartition("range").sortWithinPartitions("range")
    return together.mapInArrow(run, "key long, n long")


class Tally:
    """Sums the keys of a task and gives rows for the shuffle whenever ``most`` are held."""

    def __init__(self, ranges: int, most: int = 1 << 22):
        self.ranges, self.most = ranges, most
        self._keys: list[np.ndarray] = []
        self._counts: list[np.ndarray] = []
        self._held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._keys.append(keys), self._counts.append(counts)
        self._held += len(keys)
        if self._held >= self.most:
            keys, counts = summed(np.concatenate(self._keys), np.concatenate(self._counts))
            if 2 * len(keys) > self.most:
                yield dealt(keys, counts, self.ranges)
                keys, counts = keys[:0], counts[:0]
            self._keys, self._counts, self._held = [keys], [counts], len(keys)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._held:
            yield dealt(*summed(np.concatenate(self._keys), np.concatenate(self._counts)), self.ranges)


def count_keys(df: DataFrame, keys_of: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], least: int = 1) -> DataFrame:
    """``key, n`` of the keys and counts that ``keys_of`` takes from each batch of ``df``."""
    ranges = n_ranges(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(ranges)
        for batch in batches:
            yield from tally.add(*keys_of(batch))
        yield from tally.rest()

    return merged(df.mapInArrow(run, DEALT), ranges, least)
