"""Tagging sources, unioning them and the checks around the union."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ColumnMismatch(ValueError):
    """Sources do not carry the same columns."""


def tag(df: DataFrame, value: str | None, col: str = "city") -> DataFrame:
    """Add a constant tag column (null for a source without a tag)."""
    return df.withColumn(col, F.lit(value).cast("string"))


def assert_same_columns(frames: Mapping[str, DataFrame] | Iterable[DataFrame],
                        *, ordered: bool = False) -> list[str]:
    """Raise :class:`ColumnMismatch` unless all frames have the same column names.

    Only the analysed schemas are compared: no job runs.  With
    ``ordered=False`` (the default) the order may differ, because the union is
    by name.  Returns the column list of the first frame.
    """
    items = list(frames.items()) if isinstance(frames, Mapping) else list(enumerate(frames))
    if not items:
        raise ColumnMismatch("no sources")
    first_name, first = items[0]
    ref = first.columns
    for name, df in items[1:]:
        cols = df.columns
        same = cols == ref if ordered else sorted(cols) == sorted(ref)
        if not same:
            missing = sorted(set(ref) - set(cols))
            extra = sorted(set(cols) - set(ref))
            raise ColumnMismatch(
                f"source {name!r} differs from {first_name!r}: missing {missing}, extra {extra}"
                + ("" if missing or extra else ", order differs"))
    return list(ref)


def same_columns_by_source(headers: DataFrame, expected: Iterable[str], source_col: str = "city",
                           header_col: str = "header", ordered: bool = False) -> DataFrame:
    """V1 over files: per source, do all its files' headers hold exactly ``expected``?

    ``headers`` has one row per file (``source_col``, ``header_col`` with
    names joined by U+001F, as :func:`strata.sources.records.header_rows`
    gives).  Returns ``source_col, n_files, same_columns``; one aggregation.
    """
    names = F.split(F.col(header_col), "\x1f")
    want = F.array(*[F.lit(c) for c in expected])
    match = (names == want) if ordered else (F.array_sort(names) == F.array_sort(want))
    return headers.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("n_files"), F.bool_and(match).alias("same_columns"))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name (never by position)."""
    return reduce(lambda a, b: a.unionByName(b), list(frames))


def tagged_union(frames: Mapping[str, DataFrame], col: str = "city") -> DataFrame:
    """Check the columns, tag each frame with its key, union by name.

    One branch per tag, so a filter on the tag removes whole branches.
    """
    assert_same_columns(frames)
    return union_all(tag(df, t, col) for t, df in frames.items())


def source_counts(frames: Mapping[str, DataFrame], tag_col: str = "city") -> DataFrame:
    """``(tag_col, n_expected)``: row count of every source frame, before any union."""
    return union_all(df.agg(F.count(F.lit(1)).alias("n_expected"))
                     .select(F.lit(t).cast("string").alias(tag_col), "n_expected") for t, df in frames.items())


def reconcile_counts(df: DataFrame, tag_col: str = "city",
                     expected: DataFrame | None = None) -> DataFrame:
    """Per-tag row counts plus a grand total, in one aggregation pass.

    Returns ``(tag_col, n_rows)`` rows and one row with a null tag holding the
    total (``rollup``); rows without a tag have a row of their own, with a null tag
    too.  With ``expected`` (``tag_col, n_expected``) the result also has
    ``n_expected`` and ``ok`` (see :func:`source_counts`).
    """
    counts = df.rollup(tag_col).agg(F.count(F.lit(1)).alias("n_rows"), F.grouping(tag_col).alias("_total"))
    if expected is None:
        return counts.drop("_total")
    exp = expected.rollup(tag_col).agg(F.sum("n_expected").alias("n_expected"), F.grouping(tag_col).alias("_total"))
    joined = counts.join(exp, counts[tag_col].eqNullSafe(exp[tag_col]) & (counts["_total"] == exp["_total"]), "full_outer").select(
        F.coalesce(counts[tag_col], exp[tag_col]).alias(tag_col),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_expected", F.lit(0)).alias("n_expected"))
    return joined.withColumn("ok", F.col("n_rows") == F.col("n_expected"))


def content_sums(df: DataFrame, tag_col: str = "city", columns: Iterable[str] | None = None) -> DataFrame:
    """``tag_col, n_rows, content``: per tag the number of rows and the sum of their hashes, whatever their order.

    ``content`` is the pair of sums of two 64-bit hashes of the ``columns`` (all but the tag), as
    text: one lost row and one that came twice leave the count alone but not the sums.
    """
    cols = [c for c in df.columns if c != tag_col] if columns is None else list(columns)
    # nulls leave Spark's hashes as they are, so each column says whether it is null
    row = [x for c in cols for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return df.groupBy(tag_col).agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws(":", *sums).alias("content"))


def reconcile_contents(df: DataFrame, expected: DataFrame, tag_col: str = "city", columns: Iterable[str] | None = None) -> DataFrame:
    """``tag_col, n_rows, n_expected, ok``: per tag, whether ``df`` and ``expected`` hold the same bag of rows.

    Rows of a null tag are a group of their own.  One aggregation of each side, summed map-side.
    """
    cols = [c for c in df.columns if c != tag_col] if columns is None else list(columns)
    have = content_sums(df, tag_col, cols)
    want = content_sums(expected, tag_col, cols).select(
        F.col(tag_col).alias("_tag"), F.col("n_rows").alias("n_expected"), F.col("content").alias("_content"))
    return have.join(want, have[tag_col].eqNullSafe(want["_tag"]), "full_outer").select(
        F.coalesce(tag_col, "_tag").alias(tag_col), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_expected", F.lit(0)).alias("n_expected"), F.col("content").eqNullSafe(F.col("_content")).alias("ok"))
