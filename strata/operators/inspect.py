"""Post-filter inspection as data: distinct values, sorted, first N."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column (partial aggregation before the shuffle)."""
    return df.select(col).distinct()


def distinct_sorted(df: DataFrame, col: str, descending: bool = True) -> DataFrame:
    """Distinct values, sorted (text in code-point order); desc puts null last."""
    order = F.col(col).desc_nulls_last() if descending else F.col(col).asc_nulls_first()
    return df.select(col).distinct().orderBy(order)


def top_n(df: DataFrame, col: str, n: int = 100, descending: bool = True) -> DataFrame:
    """First ``n`` distinct values in sort order (planned as ``TakeOrderedAndProject``)."""
    return distinct_sorted(df, col, descending).limit(n)
