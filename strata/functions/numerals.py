"""Chinese-numeral floor text -> integer.

The floor count arrives as text such as ``十三層`` ("13 storeys").  The rule
(``compat`` mode, the behaviour the output must match):

* null -> 0;
* drop one trailing ``層``;
* if ``十`` occurs, the tens digit is the character just before its first
  occurrence, 1 when that character is missing or not a digit;
* the ones digit is the *last* character when it is one of 一..九, else 0;
* everything else (``百``, ``零``, ASCII digits, words) is ignored, so
  ``一百零一層`` decodes to 1.

``full`` mode adds 100 x the digit before the first ``百`` (1 when missing)
when ``百`` occurs, so ``一百零一層`` -> 101 and ``九百九十九層`` -> 999.

Three implementations with the same result:

* :func:`floors` - native Column expression (stays in whole-stage codegen);
* :func:`floors_udf` - scalar UDF on Arrow arrays, with Arrow's kernels (parity surface);
* :func:`floors_pandas_udf` - Arrow-batched pandas UDF, vectorised with
  pandas string methods (parity surface).
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schema import FLOOR_SUFFIX, NUMERAL_DIGITS, NUMERAL_HUNDRED, NUMERAL_TEN, NUMERAL_ZERO

MODES = ("compat", "full")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _digit_map() -> Column:
    """Literal map 一..九 -> 1..9 (constant-folded by Catalyst)."""
    kv = []
    for i, ch in enumerate(NUMERAL_DIGITS):
        kv += [F.lit(ch), F.lit(i + 1)]
    return F.create_map(*kv)


def _digit_or(ch: Column, default: int) -> Column:
    """Value of a one-character digit, ``default`` for anything else (incl. empty)."""
    return F.coalesce(F.try_element_at(_digit_map(), ch), F.lit(default))


def _weighted_digit_before(s: Column, marker: str, weight: int) -> Column:
    """``weight`` x (digit just before the first ``marker``, 1 if none); 0 without ``marker``.

    ``^[^M]*?([^M]?)M`` captures the character right before the first M, or
    the empty string when M comes first.
    """
    before = F.regexp_extract(s, f"^[^{marker}]*?([^{marker}]?){marker}", 1)
    return F.when(s.contains(marker), _digit_or(before, 1) * weight).otherwise(F.lit(0))


def floors(text: Column | str, mode: str = "compat") -> Column:
    """Native decode of floor text to ``int`` (see module doc).

    The input is read once (one suffix strip), so the expression stays small
    even when ``text`` is itself a large expression.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    s = F.regexp_replace(_col(text), f"{FLOOR_SUFFIX}\\z", "")
    value = _weighted_digit_before(s, NUMERAL_TEN, 10) + _digit_or(F.substring(s, -1, 1), 0)
    if mode == "full":
        value = value + _weighted_digit_before(s, NUMERAL_HUNDRED, 100)
    # null text: every term above is null-safe except the sum, which coalesces to 0
    return F.coalesce(value, F.lit(0)).cast(T.IntegerType())


# --- Python helpers for the UDF surfaces -----------------------------------

_DIGIT_VALUE = {ch: i + 1 for i, ch in enumerate(NUMERAL_DIGITS)}


def _marked(text: str, marker: str, weight: int) -> int:
    """What the first ``marker`` is worth: the digit before it (1 without one) times ``weight``."""
    head, found, _ = text.partition(marker)
    return weight * _DIGIT_VALUE.get(head[-1:], 1) if found else 0


def decode_floor_text(text: str | None, mode: str = "compat") -> int:
    """Pure-Python decode of one value, the plain statement of the rule."""
    digits = (text or "").removesuffix(FLOOR_SUFFIX)
    hundreds = _marked(digits, NUMERAL_HUNDRED, 100) if mode == "full" else 0
    return hundreds + _marked(digits, NUMERAL_TEN, 10) + _DIGIT_VALUE.get(digits[-1:], 0)


def decode_floor_series(texts: pd.Series, mode: str = "compat") -> pd.Series:
    """Vectorised decode of a pandas Series (used by :func:`floors_pandas_udf`)."""
    s = texts.astype("string")
    s = s.where(~s.str.endswith(FLOOR_SUFFIX, na=False), s.str.slice(0, -1))
    digit_map = pd.Series(_DIGIT_VALUE, dtype="Int64")
    value = s.str.slice(-1).map(digit_map).fillna(0).astype("Int64")
    for marker, weight, enabled in ((NUMERAL_TEN, 10, True), (NUMERAL_HUNDRED, 100, mode == "full")):
        if not enabled:
            continue
        # text before the first marker (NaN when the marker is absent)
        prefix = s.str.extract(f"^([^{marker}]*){marker}", expand=False)
        d = prefix.str.slice(-1).map(digit_map).fillna(1).astype("Int64")
        value = value + prefix.notna().astype("Int64") * weight * d
    return value.where(texts.notna(), 0).astype("int32")


def decode_floor_array(texts: pa.Array, mode: str = "compat") -> pa.Array:
    """Decode of an Arrow array with Arrow's own kernels (used by :func:`floors_udf`)."""
    def digit_or(chars: pa.Array, other: int) -> pa.Array:
        at = pc.index_in(chars, value_set=pa.array(list(NUMERAL_DIGITS)))
        return pc.fill_null(pc.add(at, 1), other)

    s = pc.replace_substring_regex(pc.fill_null(texts, ""), pattern=f"{FLOOR_SUFFIX}$", replacement="")
    value = digit_or(pc.utf8_slice_codeunits(s, start=-1), 0)
    for marker, weight in ((NUMERAL_TEN, 10), (NUMERAL_HUNDRED, 100))[:MODES.index(mode) + 1]:
        head = pc.struct_field(pc.extract_regex(s, pattern=f"(?s)^(?P<head>[^{marker}]*){marker}"), "head")
        worth = pc.multiply(digit_or(pc.utf8_slice_codeunits(head, start=-1), 1), weight)
        value = pc.add(value, pc.if_else(pc.is_valid(head), worth, 0))
    return value.cast(pa.int32())


def floors_udf(text: Column | str, mode: str = "compat") -> Column:
    """Scalar UDF on Arrow arrays (parity surface): one call a batch, no Python per row."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")

    @F.arrow_udf(T.IntegerType())
    def decode(texts: pa.Array) -> pa.Array:
        return decode_floor_array(texts, mode)

    return decode(_col(text))


def floors_pandas_udf(text: Column | str, mode: str = "compat") -> Column:
    """Arrow-batched pandas UDF (parity surface)."""

    @F.pandas_udf(T.IntegerType())
    def _decode(texts: pd.Series) -> pd.Series:
        return decode_floor_series(texts, mode)

    return _decode(_col(text))


def floor_text(n: Column | str) -> Column:
    """Integer 1..999 -> floor text in the usual written form (``13`` -> ``十三層``,
    ``101`` -> ``一百零一層``); the inverse of ``floors(mode="full")``.

    Used to write test inputs; 0 gives ``層`` and values outside 0..999 null.
    """
    v = F.col(n) if isinstance(n, str) else n
    h = F.floor(v / 100).cast("int")
    t = F.pmod(F.floor(v / 10), F.lit(10)).cast("int")
    o = F.pmod(v, F.lit(10)).cast("int")

    def d(x: Column) -> Column:
        return F.substring(F.lit(NUMERAL_DIGITS), x, 1)

    hundreds = F.when(h > 0, F.concat(d(h), F.lit(NUMERAL_HUNDRED))).otherwise(F.lit(""))
    tens = (F.when(t > 0, F.concat(F.when((t == 1) & (h == 0), F.lit("")).otherwise(d(t)), F.lit(NUMERAL_TEN)))
            .when((h > 0) & (o > 0), F.lit(NUMERAL_ZERO)).otherwise(F.lit("")))
    ones = F.when(o > 0, d(o)).otherwise(F.lit(""))
    text = F.concat(hundreds, tens, ones, F.lit(FLOOR_SUFFIX))
    return F.when((v >= 0) & (v <= 999), text)
