"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: Fixed by the task: words are runs of characters other than these six separators.
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor reaches, so that a lost
    executor costs the re-read of a file and not the work behind it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Array of the words of a non-null text, in order (empty for a text without words)."""
    return F.array_remove(F.split(text, WORD_SPLIT), "")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id written as decimal text."""
    return F.crc32(doc_id.cast("string"))


def slices(n: int, size: int) -> Iterator[tuple[int, int]]:
    """``(start, stop)`` pairs that cover ``range(n)`` in steps of ``size``."""
    for start in range(0, n, size):
        yield start, min(n, start + size)
