"""Best-fit packing by length patterns fitted with non-negative least squares.

1. Documents become pieces of at most ``SEQUENCE`` tokens (only longer documents
   are cut; their first piece may be shorter).
2. The histogram of piece lengths, at most ``SEQUENCE`` sums, goes to the driver.
   Few-document patterns, the multisets of up to ``MAX_PARTS`` lengths that fill
   a sequence exactly, are enumerated, and non-negative repeat counts are fitted
   to the histogram by accelerated projected gradients over the sparse pattern
   matrix.  Counts are rounded down to what the histogram still holds.
3. The residual lengths are packed best-fit decreasing, on counts, not on rows.
4. The plan says, for the r-th piece of each length, its sequence and place.
   Pieces get their rank among equal lengths from per-task counters and a
   prefix sum over tasks, so a length that a third of all pieces share is never
   gathered, and the plan is looked up by binary search in each task.

The plan's size is bounded by the histogram (``SEQUENCE`` bins and the patterns
over them), not by the number of documents.

Defined results: a null text counts as empty, and every document ends with the
end id, so an empty one is a piece of length 1; a null doc_id keeps its rows;
repeated rows are separate documents; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.tokens import byte_encoder, tokenizer_path
from strata.operators.sizing import broadcast_if_small

SEQUENCE = 1024  # fixed by the task
END_ID = 2  # fixed by the task
VOCABULARY = "byte_bpe_50k.json"
MAX_PARTS = 3
ROUNDS = 400


# --- 1: pieces --------------------------------------------------------------

def piece_table(documents: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, task, rank``: all pieces of all documents.

    ``rank`` counts the pieces of equal length that the same task has made before.
    """
    path = path or tokenizer_path(VOCABULARY)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder = byte_encoder(path)
        seen = np.zeros(sequence + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text).tobytes() + end
                total = len(ids) // 4
                first = total % sequence or sequence
                start, piece, length = 0, 0, min(first, total)
                while start < total:
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]),
                                 task, int(seen[length])))
                    seen[length] += 1
                    start, piece, length = start + length, piece + 1, sequence
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


# --- 2, 3: the plan ---------------------------------------------------------

def patterns(lengths: np.ndarray, sequence: int, max_parts: int = MAX_PARTS) -> np.ndarray:
    """Rows of ``max_parts`` lengths (descending, 0 for none) from ``lengths`` that sum to ``sequence``."""
    have = np.zeros(sequence + 1, bool)
    have[lengths] = True
    found = [np.zeros((0, max_parts), np.int64)]

    def extend(left: int, most: int, parts: int, head: tuple[int, ...]) -> None:
        if parts == 1:
            if 0 < left <= most and have[left]:
                found.append(np.array([head + (left,) + (0,) * (max_parts - len(head) - 1)]))
            return
        if parts == 2:  # all pairs at once
            a = np.arange((left + 1) // 2, min(most, left - 1) + 1)
            a = a[have[a] & have[left - a]] if len(a) else a
            if len(a):
                block = np.zeros((len(a), max_parts), np.int64)
                block[:, :len(head)] = head
                block[:, len(head)], block[:, len(head) + 1] = a, left - a
                found.append(block)
            return
        for a in np.flatnonzero(have[:min(most, left - 1) + 1])[::-1]:
            if a * parts < left:
                break
            extend(left - int(a), int(a), parts - 1, head + (int(a),))

    for parts in range(1, max_parts + 1):
        extend(sequence, sequence, parts, ())
    return np.concatenate(found)


def fit_repeats(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares of repeat counts: ``min |A x - histogram|, x >= 0``.

    ``A`` is applied by gathers and bin counts; it is never made dense.  Length
    errors are weighted by the length, so that long pieces are fitted first.
    """
    if not len(rows):
        return np.zeros(0)
    weight = np.sqrt(np.arange(len(histogram)) / len(histogram))
    weight[0] = 0.0
    goal = weight * histogram

    def apply(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(histogram))
        for c in range(rows.shape[1]):
            total += np.bincount(rows[:, c], weights=x, minlength=len(histogram))
        return weight * total

    def back(r: np.ndarray) -> np.ndarray:
        wr = weight * r
        return wr[rows].sum(axis=1)

    v = np.ones(len(rows))  # largest eigenvalue of A'A by power iteration, for the step size
    for _ in range(12):
        v = back(apply(v))
        v /= np.linalg.norm(v)
    step = 1.0 / (1.05 * np.linalg.norm(back(apply(v))))
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * back(apply(y) - goal))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


@dataclass(frozen=True)
class Plan:
    """Slots sorted by (length, first rank): pieces of ``length`` with ranks from
    ``rank`` on go to sequences from ``sequence`` on, at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        span = int(rank.max(initial=0)) + int(self.rank.max(initial=0)) + 2
        at = np.searchsorted(self.length * span + self.rank, length * span + rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def best_fit_decreasing(left: np.ndarray, sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack the histogram ``left``, longest first, into the fullest bin that fits; ``(lengths, repeats)``.

    Equal bins are kept as one entry with a count, so the work follows the
    number of different lengths and not the number of pieces.
    """
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # free space -> bins
    for length in np.flatnonzero(left)[::-1]:
        length, count = int(length), int(left[length])
        free = length
        while count and free <= sequence:
            if not open_bins.get(free):
                free += 1
                continue
            held, n = open_bins[free].pop()
            # a bin takes as many of this length as fit
            each = min(free // length, max(1, count))
            use = min(n, max(1, count // each))
            if use * each > count:
                each = 1
            if use < n:
                open_bins[free].append((held, n - use))
            open_bins.setdefault(free - each * length, []).append((held + (length,) * each, use))
            count -= use * each
        if count:
            each = sequence // length
            full, rest = divmod(count, each)
            if full:
                open_bins.setdefault(sequence - each * length, []).append(((length,) * each, full))
            if rest:
                open_bins.setdefault(sequence - rest * length, []).append(((length,) * rest, 1))
    return [b for bins in open_bins.values() for b in bins]


def make_plan(histogram: np.ndarray, max_parts: int = MAX_PARTS) -> Plan:
    """The packing plan for a histogram of lengths (index = length)."""
    sequence = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []
    rows = patterns(np.flatnonzero(left), sequence, max_parts)
    repeats = fit_repeats(rows, left.astype(float))
    for i in np.argsort(-repeats, kind="stable"):
        if repeats[i] < 1:
            break
        parts, need = np.unique(rows[i][rows[i] > 0], return_counts=True)
        n = int(min(np.floor(repeats[i]), (left[parts] // need).min()))
        if n > 0:
            left[parts] -= n * need
            chosen.append((tuple(int(p) for p in rows[i] if p), n))
    chosen += best_fit_decreasing(left, sequence)
    used = np.zeros(sequence + 1, np.int64)
    slots: list[tuple[int, int, int, int]] = []
    first = 0
    for lengths, n in chosen:
        offset = 0
        for length in lengths:
            slots.append((length, int(used[length]), first, offset))
            used[length] += n
            offset += length
        first += n
    slots.sort()
    cols = np.array(slots, np.int64).reshape(-1, 4)
    return Plan(cols[:, 0], cols[:, 1], cols[:, 2], cols[:, 3], first)


# --- 4: placement -----------------------------------------------------------

def pack(documents: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece."""
    pieces = written(piece_table(documents, path, sequence), "pieces")
    per_task = pieces.groupBy(F.col("task").alias("of_task"), F.col("length").alias("of_length")).agg(F.count(F.lit(1)).alias("n"))
    per_task = written(per_task, "piece-counts")
    histogram = np.zeros(sequence + 1, np.int64)
    for row in per_task.groupBy("of_length").agg(F.sum("n").alias("n")).collect():
        histogram[row["of_length"]] = row["n"]
    plan = make_plan(histogram)
    before = Window.partitionBy("of_length").orderBy("of_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = broadcast_if_small(per_task.select(
        "of_task", "of_length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    ranked = pieces.join(offsets, (F.col("task") == F.col("of_task")) & (F.col("length") == F.col("of_length"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("earlier")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, offset = plan.place(batch.column(3).to_numpy(), batch.column(5).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:5], pa.array(at, pa.int64()), pa.array(offset, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
