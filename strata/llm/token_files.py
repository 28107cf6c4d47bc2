"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Writing (:func:`write_ids`): texts are encoded once to a written table of packed
ids; ids are counted over all documents (summed map-side, at most one sum per id
of the vocabulary reaches the driver); package-merge gives code lengths of at
most ``MAX_BITS``; documents are coded once to a written table, its rows are range-partitioned by
doc_id, and each task writes its documents in order as blocks of about
``BLOCK_IDS`` ids.

The format: a folder with two Parquet tables, so that any store and Spark's
commit protocol serve it.

* ``codes``: ``id, bits``.  Codes are canonical: ascending by (bits, id).
* ``blocks``: ``part, block, before`` (ids earlier in the same part), ``n_ids``,
  ``doc_ids``, ``doc_lengths`` (ids per document, in order), ``payload`` (the code
  bits, most significant bit first, padded with zeros to a byte), ``checkpoints``
  (the bit offset of every ``STRIDE``-th id).  Parts and blocks ascend with
  doc_id, null first; a document lies whole in one block and begins at a byte.

Reading (:func:`read_ids`): every block is decoded alone.  Its checkpoints are
lanes that advance together through one lookup table of ``2 ** MAX_BITS`` entries.

Defined results: a null text counts as empty; every document ends with the end
id, so an empty one has one id; documents that repeat an id stand next to each
other, ordered by a hash of their coded bytes and by the bytes; an empty table gives empty files and no rows.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.tokens import tokenizer_path, word_encoder
from strata.operators.sizing import broadcast_if_small

VOCABULARY = "word_bpe_49k.json"
END_ID = 2  # fixed by the task
MAX_BITS = 20
PACKED, ID_BYTES = "<u2", 2  # ids between the stages; this vocabulary has fewer than 65,536
BLOCK_IDS = 1 << 18
STRIDE = 256
_ENCODE_IDS = 1 << 16  # ids whose bits are laid out at a time


# --- codes ------------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive ``counts`` (package-merge).

    Level by level, packages of two are merged with the single symbols; which
    entries of a merged list are single symbols is all that is remembered.  From
    the last level back, the chosen prefix of each list says how many of the
    rarest symbols get one more bit.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids do not fit codes of {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    single = np.asarray(counts, np.float64)[order]
    is_single = []
    level = single
    for _ in range(max_bits):
        is_single.append(np.ones(n, bool) if len(is_single) == 0 else flags)
        packages = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([single, packages])
        by_weight = np.argsort(merged, kind="stable")
        level, flags = merged[by_weight], by_weight < n
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for flags in reversed(is_single):
        chosen = int(flags[:take].sum())
        lengths[order[:chosen]] += 1
        take = 2 * (min(take, len(flags)) - chosen)
    return lengths


@dataclass(frozen=True)
class Codes:
    """Canonical codes for the ids that occur, with both lookup directions."""

    ids: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(ids: np.ndarray, bits: np.ndarray) -> "Codes":
        order = np.lexsort((ids, bits))
        return Codes(np.asarray(ids, np.int64)[order], np.asarray(bits, np.int64)[order])

    def encoder(self) -> tuple[np.ndarray, np.ndarray]:
        """``code, bits`` by id."""
        first = np.concatenate([[0], np.cumsum(1 << (MAX_BITS - self.bits))[:-1]]) >> (MAX_BITS - self.bits) if len(self.ids) else self.bits
        size = int(self.ids.max(initial=0)) + 1
        code, bits = np.zeros(size, np.uint32), np.zeros(size, np.int64)
        code[self.ids], bits[self.ids] = first, self.bits
        return code, bits

    def decoder(self) -> tuple[np.ndarray, np.ndarray]:
        """``id, bits`` by the next ``MAX_BITS`` bits."""
        width = 1 << (MAX_BITS - self.bits)
        ids, bits = np.zeros(1 << MAX_BITS, np.uint32), np.ones(1 << MAX_BITS, np.uint8)  # small tables stay in the cache
        ids[:width.sum()], bits[:width.sum()] = np.repeat(self.ids, width), np.repeat(self.bits, width)
        return ids, bits


def encode_documents(documents: list[np.ndarray], code: np.ndarray, bits: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """``payload, checkpoints`` of each document, checkpoints counted from its own first bit."""
    if not documents:
        return []
    ids = np.concatenate(documents)
    sizes = np.array([len(d) for d in documents])
    length = bits[ids]
    ends = np.cumsum(length)
    doc_end = ends[np.cumsum(sizes) - 1]
    doc_bits = np.diff(doc_end, prepend=0)
    padding = np.cumsum(-doc_bits % 8) - (-doc_bits % 8)  # bits of padding before each document
    start = ends - length + np.repeat(padding, sizes)
    total = int(doc_end[-1] + padding[-1] + (-doc_bits[-1]) % 8)
    # a code touches one or two 32-bit words; codes share no bit, so sums (exact in doubles) put them together
    word, shift = start >> 5, 32 - (start & 31) - length
    value = code[ids].astype(np.int64)
    high = np.where(shift >= 0, value << np.maximum(shift, 0), value >> np.maximum(-shift, 0))
    low = np.where(shift >= 0, 0, (value << np.clip(32 + shift, 0, 31)) & 0xFFFFFFFF)
    n_words = total // 32 + 2
    words = np.bincount(word, weights=high, minlength=n_words) + np.bincount(word + 1, weights=low, minlength=n_words)
    packed = words.astype(np.uint32).astype(">u4").tobytes()
    out, first = [], 0
    for size, n in zip(sizes, doc_bits, strict=True):
        begin = int(start[first])
        out.append((packed[begin // 8:(begin + int(n) + 7) // 8], start[first:first + size:STRIDE] - begin))
        first += size
    return out


def decode_block(payload: bytes, checkpoints: np.ndarray, lengths: np.ndarray, ids_of: np.ndarray, bits_of: np.ndarray) -> np.ndarray:
    """The ids of one block's documents: all checkpoints advance together, one id a step."""
    raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    lanes = -(-lengths // STRIDE)  # checkpoints of each document
    left = np.full(int(lanes.sum()), STRIDE)  # ids behind each checkpoint
    left[np.cumsum(lanes) - 1] = lengths - STRIDE * (lanes - 1)
    order = np.argsort(-left, kind="stable")  # so that lanes still open stand in front
    at = np.asarray(checkpoints, np.int64)[order]
    open_ = len(left) - np.searchsorted(left[order][::-1], np.arange(STRIDE), side="right")
    steps = np.zeros((STRIDE, len(left)), np.uint32)
    for step in range(STRIDE):
        n = open_[step]
        if not n:
            break
        key = (window[at[:n] >> 3] << (at[:n] & 7).astype(np.uint32)) >> np.uint32(32 - MAX_BITS)
        steps[step, :n] = ids_of[key]
        at[:n] += bits_of[key]
    out = np.empty((len(left), STRIDE), np.uint32)
    out[order] = steps.T
    return out[np.arange(STRIDE) < left[:, None]]


# --- writing ----------------------------------------------------------------

def id_table(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids``: packed ids of every document, the end id included."""
    path = path or tokenizer_path(VOCABULARY)
    end = np.array([END_ID], PACKED).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path, PACKED)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                packed = [encoder.encode(t) + end for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def count_ids(ids: DataFrame) -> DataFrame:
    """``id, n`` over all documents; each task sums its own ids first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                packed = b"".join(batch.column(0).slice(start, 1024).to_pylist())
                n = np.bincount(np.frombuffer(packed, PACKED), minlength=len(total))
                n[:len(total)] += total
                total = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def coded_table(ids: DataFrame, codes: Codes) -> DataFrame:
    """``doc_id, n, payload, checkpoints`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, bits = codes.encoder()

        def coded(doc_ids: list, held: list[np.ndarray]) -> pa.RecordBatch:
            done = encode_documents(held, code, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([len(h) for h in held], pa.int64()), pa.array([d[0] for d in done], pa.binary()),
                 pa.array([d[1] for d in done], pa.list_(pa.int64()))], names=["doc_id", "n", "payload", "checkpoints"])

        for batch in batches:
            doc_ids, held, size = [], [], 0
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                doc_ids.append(doc_id), held.append(np.frombuffer(packed, PACKED))
                size += len(held[-1])
                if size >= _ENCODE_IDS:
                    yield coded(doc_ids, held)
                    doc_ids, held, size = [], [], 0
            if held:
                yield coded(doc_ids, held)

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, n long, payload binary, checkpoints array<long>")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` body: ordered coded documents to blocks."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    docs: list[int | None] = []
    lengths: list[int] = []
    payload: list[bytes] = []
    marks: list[int] = []
    number = before = size = at = 0

    def block() -> pa.RecordBatch:
        cols = [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([before], pa.int64()), pa.array([size], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([b"".join(payload)], pa.binary()), pa.array([marks], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(cols, names=["part", "block", "before", "n_ids", "doc_ids", "doc_lengths",
                                                       "payload", "checkpoints"])

    for batch in batches:
        for doc_id, n, bits, own in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            docs.append(doc_id), lengths.append(n), payload.append(bits)
            marks += [at + m for m in own]
            at, size = at + 8 * len(bits), size + n
            if size >= BLOCK_IDS:
                yield block()
                number, before = number + 1, before + size
                docs, lengths, payload, marks, size, at = [], [], [], [], 0, 0
    if docs:
        yield block()


def write_ids(documents: DataFrame, folder: str, path: str | None = None) -> None:
    """Encode ``documents`` and write them in this module's format to ``folder``."""
    spark = documents.sparkSession
    table = written(id_table(documents, path), "ids", "zstd")
    counts = sorted((r["id"], r["n"]) for r in count_ids(table).collect())  # at most one row per id of the vocabulary
    ids = np.array([c[0] for c in counts], np.int64)
    bits = code_lengths(np.array([c[1] for c in counts], np.int64))
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, bits, strict=True)], "id long, bits int").coalesce(1).write.parquet(f"{folder}/codes")
    coded = written(coded_table(table, Codes.of(ids, bits)), "coded")  # range bounds are sampled from it
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("payload")]  # the hash cuts an id that repeats over many rows
    ordered = coded.repartitionByRange(*order).sortWithinPartitions(*order, "payload")
    ordered.mapInArrow(_blocks,
                       "part int, block long, before long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
                       "payload binary, checkpoints array<long>").write.parquet(f"{folder}/blocks")


# --- reading ----------------------------------------------------------------

def decoded(spark: SparkSession, folder: str, per_document: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """``doc_id, start, n_tokens, value`` where value (SQL type ``kind``) is ``per_document(ids)``."""
    stored = sorted((r["id"], r["bits"]) for r in spark.read.parquet(f"{folder}/codes").collect())
    codes = Codes.of(np.array([s[0] for s in stored], np.int64), np.array([s[1] for s in stored], np.int64))
    blocks = spark.read.parquet(f"{folder}/blocks")
    up_to = Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy(F.col("part").alias("of_part")).agg(F.sum("n_ids").alias("n"))  # one row per written part
    parts, _ = broadcast_if_small(parts.select("of_part", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("earlier")))
    value_type = pa.list_(pa.int64()) if kind == "array<long>" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bits_of = codes.decoder()
        for batch in batches:
            for i in range(batch.num_rows):
                part, before, docs, lengths, payload, marks = (batch.column(c)[i].as_py() for c in range(6))
                sizes = np.array(lengths, np.int64)
                ids = decode_block(payload, marks, sizes, ids_of, bits_of)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                values = [per_document(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(starts + before, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(values, value_type)],
                    names=["part", "doc_id", "start", "n_tokens", "value"])

    rows = blocks.select("part", "before", "doc_ids", "doc_lengths", "payload", "checkpoints").mapInArrow(
        run, f"part int, doc_id long, start long, n_tokens long, value {kind}")
    return rows.join(parts, F.col("part") == F.col("of_part")).select(
        "doc_id", (F.col("start") + F.col("earlier")).alias("start"), "n_tokens", "value")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in ``folder``."""
    return decoded(spark, folder, lambda ids: ids.astype(np.int64), "array<long>").withColumnRenamed("value", "ids")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in ``folder``."""
    return decoded(spark, folder, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "long").withColumnRenamed("value", "ids_crc32")
