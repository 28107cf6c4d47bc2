"""Size checks before an explicit broadcast.

A broadcast hint is given only after the side's size is measured: one
aggregation returns its row count and an estimate of its bytes (string and
binary columns by their actual lengths, other types by their fixed width).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_OVERHEAD = 16  # per-row bookkeeping in a broadcast hash relation, roughly

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _width(field: T.StructField) -> F.Column:
    dt = field.dataType
    c = F.col(f"`{field.name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    for typ, size in _FIXED.items():
        if isinstance(dt, typ):
            return F.lit(size)
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))  # nested: its JSON size


def measure(df: DataFrame) -> tuple[int, int]:
    """``(rows, estimated bytes)`` of ``df`` in one aggregation."""
    per_row = F.lit(ROW_OVERHEAD)
    for f in df.schema.fields:
        per_row = per_row + _width(f)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(per_row).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def broadcast_threshold(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    t = str(raw).strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    return int(float(t[:-1]) * units[t[-1]]) if t and t[-1] in units else int(t)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(df, True)`` with a broadcast hint when its measured size is within
    ``max_bytes`` (default: the session's broadcast threshold), else
    ``(df, False)`` untouched, for Spark to join by shuffle."""
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    if limit < 0:
        return df, False
    _, size = measure(df)
    return (F.broadcast(df), True) if size <= limit else (df, False)
