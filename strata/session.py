"""Session helpers: the shared checkpoint folder and a local test session."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    It is read from the session.  Only when a local session names none (a test)
    is a folder of our own created and set; on a cluster, where such a folder
    would be another one on every machine, its absence is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        conf = conf or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local(\[.*\])?$", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="strata-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", conf)
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return conf


def default_parallelism(spark: SparkSession) -> int:
    """Cores the session schedules on (falls back to the shuffle partition count)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


DEFAULT_SHUFFLE_PARTITIONS = "200"


def size_for_input(spark: SparkSession, input_bytes: int, *,
                   target_partition_bytes: int = 256 << 20, max_partitions: int = 100_000) -> int:
    """Size shuffles and splits for an input of ``input_bytes``.

    Sets the shuffle partition count to about one per ``target_partition_bytes``
    of input (at least two per core, at most ``max_partitions``) unless the
    session already chose one, and makes the same size AQE's coalescing
    target and the scan split size.  Returns the shuffle partition count in
    effect.  The filter and projection shrink the data before the first
    shuffle, so AQE coalesces the post-shuffle partitions further.
    """
    current = spark.conf.get("spark.sql.shuffle.partitions")
    if current != DEFAULT_SHUFFLE_PARTITIONS:
        return int(current)
    n = -(-int(input_bytes) // target_partition_bytes)
    n = max(2 * default_parallelism(spark), min(max_partitions, n))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    return n


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for the jobs of a ``with`` block; the session's own come back after it."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """Session for tests and local benches: UI off, AQE on, UTC."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
