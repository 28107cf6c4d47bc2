"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schema


def high_rise_condition(
    use: Column | str = schema.COL_USE,
    building_type: Column | str = schema.COL_TYPE,
    floors: Column | str = "Floors",
    *,
    use_value: str = schema.RESIDENTIAL,
    type_part: str = schema.TOWER,
    min_floors: int = schema.MIN_FLOORS,
) -> Column:
    """use == ``use_value`` AND type contains ``type_part`` AND floors >= ``min_floors``.

    Null use or type fails the test (the row is dropped), as in SQL.  The two
    text tests are plain comparisons, so Catalyst pushes them into the scan
    (``EqualTo`` / ``StringContains``) below any computed column.
    """
    u = F.col(use) if isinstance(use, str) else use
    t = F.col(building_type) if isinstance(building_type, str) else building_type
    f = F.col(floors) if isinstance(floors, str) else floors
    return (u == F.lit(use_value)) & t.contains(type_part) & (f >= F.lit(min_floors))


def high_rise(df: DataFrame, **kwargs) -> DataFrame:
    """Keep residential high-rise rows; see :func:`high_rise_condition`."""
    return df.filter(high_rise_condition(**kwargs))
