"""Record schema of the per-city transaction files.

Everything in the "fixed values" block below must equal the source data's
own names: the column headers of the city files, the English names used in
the output documents, the city tags and the filter constants.  The Spark
types are our choice (the source data declares none); they are applied with
``try_cast`` so a dirty value becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# (source column, output name, Spark type), in output order: the 28 event
# fields of the full document.
RECORD_FIELDS: list[tuple[str, str, str]] = [
    ("鄉鎮市區", "district", "string"),
    ("交易標的", "transaction_sign", "string"),
    ("土地區段位置建物區段門牌", "number_plate", "string"),
    ("土地移轉總面積平方公尺", "square_meter", "double"),
    ("都市土地使用分區", "use_zoning", "string"),
    ("非都市土地使用分區", "non_metropolis_district", "string"),
    ("非都市土地使用編定", "non_metropolis_land_use", "string"),
    ("交易年月日", "transaction_date", "int"),
    ("交易筆棟數", "transaction_number", "string"),
    ("移轉層次", "shifting", "string"),
    ("總樓層數", "total_floor", "string"),
    ("建物型態", "type", "string"),
    ("主要用途", "main_use", "string"),
    ("主要建材", "main_materials", "string"),
    ("建築完成年月", "complete_date", "string"),
    ("建物移轉總面積平方公尺", "total_area", "double"),
    ("建物現況格局-房", "room", "int"),
    ("建物現況格局-廳", "hall", "int"),
    ("建物現況格局-衛", "health", "int"),
    ("建物現況格局-隔間", "compartmented", "string"),
    ("有無管理組織", "organization", "string"),
    ("總價元", "price", "bigint"),
    ("單價元平方公尺", "unit_price", "double"),
    ("車位類別", "berth", "string"),
    ("車位移轉總面積平方公尺", "berth_area", "double"),
    ("車位總價元", "berth_price", "bigint"),
    ("備註", "note", "string"),
    ("編號", "number", "string"),
]

# The short document keeps two event fields.
SHORT_EVENT_FIELDS: list[str] = ["district", "type"]

# City tag by file letter (file name pattern "{letter}_lvr_land_A.csv").
CITY_BY_LETTER: dict[str, str] = {
    "A": "台北市",
    "B": "台中市",
    "E": "高雄市",
    "F": "新北市",
    "H": "桃園市",
}
CITY_FILE_PATTERN = "{letter}_lvr_land_A.csv"

# Filter constants: use must equal RESIDENTIAL, building type must contain
# TOWER, floor count at least MIN_FLOORS.
RESIDENTIAL = "住家用"
TOWER = "住宅大樓"
MIN_FLOORS = 13

# Column names the filter, the date and the floors decoder read.
COL_DISTRICT = "鄉鎮市區"
COL_DATE = "交易年月日"
COL_FLOORS_TEXT = "總樓層數"
COL_TYPE = "建物型態"
COL_USE = "主要用途"

# Chinese numerals in floor texts: the digits 1..9 in order (position =
# value), ten, hundred, zero, and the floor suffix.
NUMERAL_DIGITS = "一二三四五六七八九"
NUMERAL_TEN = "十"
NUMERAL_HUNDRED = "百"
NUMERAL_ZERO = "零"
FLOOR_SUFFIX = "層"

# ROC calendar: year 1 is 1912, so yyyMMdd + 19110000 is the Gregorian yyyyMMdd.
ROC_OFFSET = 19110000

# Text tokens pandas reads as missing by default; the source files were
# rewritten through pandas, so these arrived as empty (null) values.
NA_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# --- end of fixed values ----------------------------------------------------

SOURCE_COLUMNS: list[str] = [src for src, _, _ in RECORD_FIELDS]
ALIAS_BY_SOURCE: dict[str, str] = {src: dst for src, dst, _ in RECORD_FIELDS}
TYPE_BY_SOURCE: dict[str, str] = {src: typ for src, _, typ in RECORD_FIELDS}
FULL_EVENT_FIELDS: list[str] = [dst for _, dst, _ in RECORD_FIELDS]


def event_fields(n_fields: int) -> list[str]:
    """Event field names of the 2- or 28-field document."""
    if n_fields == 2:
        return list(SHORT_EVENT_FIELDS)
    if n_fields == 28:
        return list(FULL_EVENT_FIELDS)
    raise ValueError(f"documents have 2 or 28 event fields, not {n_fields}")


def required_columns(n_fields: int) -> list[str]:
    """Source columns the job reads for a 2- or 28-field document."""
    if n_fields == 28:
        return list(SOURCE_COLUMNS)
    need = {COL_DISTRICT, COL_DATE, COL_FLOORS_TEXT, COL_TYPE, COL_USE}
    by_alias = {dst: src for src, dst, _ in RECORD_FIELDS}
    need |= {by_alias[f] for f in event_fields(n_fields)}
    return [c for c in SOURCE_COLUMNS if c in need]


def text_schema(columns: list[str] | None = None) -> T.StructType:
    """All-string schema, the shape of a CSV read before typing."""
    cols = SOURCE_COLUMNS if columns is None else columns
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
