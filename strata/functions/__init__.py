"""Scalar column functions: numeral floors and ROC dates."""

from strata.functions.dates import date_to_roc, roc_to_date
from strata.functions.numerals import (
    decode_floor_series,
    decode_floor_text,
    floor_text,
    floors,
    floors_pandas_udf,
    floors_udf,
)

__all__ = [
    "date_to_roc",
    "decode_floor_series",
    "decode_floor_text",
    "floor_text",
    "floors",
    "floors_pandas_udf",
    "floors_udf",
    "roc_to_date",
]
