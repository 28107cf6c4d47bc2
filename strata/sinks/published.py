"""Results that are replaced as a whole.

``mode("overwrite")`` removes the old files before the new ones are there: a reader in
between sees nothing or a part.  Here every result is written to a folder of its own
under ``path``, and a manifest (a small table that is only ever appended to, by Spark's
commit protocol) then names it as the live one.  A reader takes the newest entry, so it
sees the old result or the new one, and a write that fails is never seen.  Replaced
results stay until their folders are removed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.json_lines import write_parts

MANIFEST = "manifest"
_ENTRY = "version bigint, folder string, parts map<string,string>"


def _entries(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest's entries; None where there is no manifest yet."""
    jvm, where = spark.sparkContext._jvm, f"{path.rstrip('/')}/{MANIFEST}"
    at = jvm.org.apache.hadoop.fs.Path(where)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(_ENTRY).parquet(where) if there else None


def live(spark: SparkSession, path: str) -> tuple[int, str, dict[str, str]] | None:
    """``(version, folder, {part: folder})`` of the live result under ``path``; None before the first."""
    entries = _entries(spark, path)
    newest = None if entries is None else entries.orderBy(F.col("version").desc(), F.col("folder").desc()).first()
    return None if newest is None else (newest["version"], newest["folder"], newest["parts"])


def publish_parts(df: DataFrame, path: str, *, part_col: str = "part", files_per_part: int | None = None) -> dict[str, str]:
    """Write ``df`` as JSON lines in one folder a part, and make that the live result under ``path``."""
    spark, base = df.sparkSession, path.rstrip("/")
    folder = f"{base}/result-{uuid.uuid4().hex[:12]}"
    parts = write_parts(df, folder, part_col=part_col, files_per_part=files_per_part)
    before = live(spark, base)
    entry = [((before[0] if before else 0) + 1, folder, parts)]
    spark.createDataFrame(entry, _ENTRY).coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")
    return parts


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """``part, value, file`` of every line of the live result under ``path``."""
    found = live(spark, path)
    if found is None:
        raise FileNotFoundError(f"nothing was published under {path}")
    lines = [spark.read.text(folder).select(F.lit(part).alias("part"), "value", F.col("_metadata.file_name").alias("file"))
             for part, folder in sorted(found[2].items())]
    empty = spark.createDataFrame([], "part string, value string, file string")
    for frame in lines:
        empty = empty.unionByName(frame)
    return empty
