"""Distributed numbering without a single-partition window.

``row_number() over (partition by k order by o)`` sends each ``k`` to one
task, and with no ``k`` the whole table to one task.  Here the table is
range-partitioned on ``(k, o)`` instead, so one ``k`` holding a third of the
rows is cut across many tasks.  Each row's number is then

    weight of the same k in earlier range partitions  +  weight before it in its own

The first term comes from a small table with one row per (partition, k),
which a window over ``k`` turns into prefix sums; it has at most
``partitions + distinct k`` rows and is broadcast only below a checked size
(bytes, measured first).  The sorted, numbered rows are checkpointed to the
shared checkpoint folder, so both reads see the same numbering and lineage
is cut.

Rows should be distinct on ``(k, o)``: equal rows fall in one partition and
are numbered in an arbitrary order.  Callers with repeated rows combine them
first and pass the repeat count as ``weight`` (see ``nest_paged``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.sizing import broadcast_if_small, broadcast_threshold
from strata.session import checkpoint_dir

# The offsets table has about (range partitions + keys) rows.  Its only
# alternative to a broadcast is a join that shuffles the big side, so it is
# broadcast up to this many bytes (or the session threshold, if higher).
OFFSETS_BROADCAST_BYTES = 256 << 20


def _weighted_positions(weight_col: str):
    """``mapInArrow`` body: partition id and the exclusive running sum of ``weight_col``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        carried = 0
        for batch in batches:
            w = batch.column(weight_col).cast(pa.int64())
            inclusive = pc.cumulative_sum(w)
            before = pc.add(pc.subtract(inclusive, w), carried)
            if len(batch):
                carried += pc.sum(w).as_py() or 0
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [pa.array([pid] * len(batch), pa.int32()), before],
                names=list(batch.schema.names) + ["_pid", "_pos"])

    return run


def cumulative_by_range(
    df: DataFrame,
    order: Sequence[Column],
    partition_by: Sequence[str] = (),
    *,
    weight: str | None = None,
    out_col: str = "rn",
    num_partitions: int | None = None,
    broadcast_bytes: int = OFFSETS_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``out_col`` (bigint): total ``weight`` of the rows before this one within
    ``partition_by`` in ``order``.  Without ``weight`` every row weighs 1, so
    ``out_col`` is the 0-based row number.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    keys = [F.col(k).asc_nulls_first() for k in partition_by] + list(order)
    # without an explicit count AQE may merge small adjacent ranges; merged
    # partitions are still contiguous ranges in order, which is all we need
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys)
    if weight is None:
        # row index inside the partition: the low 33 bits of the generated id
        mid = F.monotonically_increasing_id()
        positioned = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
            "_pos", mid - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
        weight_expr = F.lit(1).cast("bigint")
    else:
        out_schema = T.StructType(df.schema.fields + [
            T.StructField("_pid", T.IntegerType()), T.StructField("_pos", T.LongType())])
        positioned = ranged.mapInArrow(_weighted_positions(weight), out_schema)
        weight_expr = F.col(weight).cast("bigint")
    ordered = positioned.checkpoint(eager=True)

    pk = list(partition_by)
    # the offsets table carries its own column names, so the self-join is unambiguous
    renamed = {k: f"_k{i}" for i, k in enumerate(pk)}
    counts = ordered.groupBy(F.col("_pid").alias("_opid"), *[F.col(k).alias(v) for k, v in renamed.items()]).agg(
        F.min("_pos").alias("_first"), F.sum(weight_expr).alias("_n"))
    w = Window.partitionBy(*renamed.values()).orderBy("_opid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    offsets, _ = broadcast_if_small(offsets, max(broadcast_bytes, broadcast_threshold(offsets)))
    cond = F.col("_pid") == F.col("_opid")
    for k, v in renamed.items():
        cond = cond & F.col(k).eqNullSafe(F.col(v))
    joined = ordered.join(offsets, cond, "inner")
    rn = (F.col("_before") + F.col("_pos") - F.col("_first")).cast("bigint")
    keep = [c for c in ordered.columns if c not in ("_pid", "_pos")]
    return joined.select(*keep, rn.alias(out_col))


def row_number_by_range(
    df: DataFrame,
    order: Sequence[Column],
    partition_by: Sequence[str] = (),
    *,
    out_col: str = "rn",
    num_partitions: int | None = None,
    broadcast_bytes: int = OFFSETS_BROADCAST_BYTES,
) -> DataFrame:
    """0-based ``row_number`` within ``partition_by`` in ``order``, computed by range."""
    return cumulative_by_range(df, order, partition_by, out_col=out_col, num_partitions=num_partitions,
                               broadcast_bytes=broadcast_bytes)
