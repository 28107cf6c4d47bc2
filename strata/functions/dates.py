"""ROC-calendar dates.

Transaction dates are integers ``yyyMMdd`` counted from ROC year 1 (= 1912),
e.g. ``1080415`` is 2019-04-15 and ``990101`` is 2010-01-01.  Adding
19110000 gives a Gregorian ``yyyyMMdd`` number, parsed strictly: an
impossible day or month (``1080231``, ``1080000``), text, or null gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.operators.project import integral
from strata.schema import ROC_OFFSET


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def roc_to_date(roc: Column | str) -> Column:
    """ROC ``yyyMMdd`` (int or text, ``1080415.0`` too) -> ``date``; null when not a valid day."""
    gregorian = F.try_add(integral(_col(roc), "bigint"), F.lit(ROC_OFFSET))  # a number out of range gives null
    return F.try_to_date(gregorian.cast("string"), "yyyyMMdd")


def date_to_roc(d: Column | str) -> Column:
    """Inverse of :func:`roc_to_date` for dates from 1912 on: ``date`` -> int."""
    c = _col(d)
    return ((F.year(c) - ROC_OFFSET // 10000) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
