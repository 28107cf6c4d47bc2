"""Fixture city files, written as the source files are: UTF-8 with BOM, header, alias row."""

from __future__ import annotations

import csv
import io
import os

T = "住宅大樓(11層含以上有電梯)"
COLS = ["鄉鎮市區", "交易年月日", "總樓層數", "建物型態", "主要用途", "備註"]
ALIAS = ["The villages and towns urban district", "transaction year month and day",
         "total floor number", "building state", "main use purpose", "the note"]
ROWS = [
    ["甲區", "1080415", "十三層", T, "住家用", ""],
    ["甲區", "1080415", "二十三層", T, "住家用", 'say "hi", ok'],
    ["乙區", "990101", "二十層", T, "住家用", "line1\nline2"],
    ["乙區", "1080416", "十二層", T, "住家用", "below 13: out"],
    ["乙區", "1080416", "十五層", "公寓", "住家用", "wrong type: out"],
    ["丙區", "1080416", "十五層", T, "商業用", "wrong use: out"],
    ["丙區", "1080416", "", T, "住家用", "floors 0: out"],
    ["丙區", "", "十四層", T, "住家用", "null date: kept, slot last"],
    ["丁區", "1080231", "十四層", T, "住家用", "invalid date -> null date"],
    ["丁區", "1080417", "一百零一層", T, "住家用", "compat 1: out; full 101: in"],
]

EXPECTED_TAIPEI = (
    '{"city":"台北市","time_slots":[{"date":"2019-04-15","events":[{"district":"甲區","type":"T"},'
    '{"district":"甲區","type":"T"}]},{"date":"2010-01-01","events":[{"district":"乙區","type":"T"}]},'
    '{"events":[{"district":"丁區","type":"T"},{"district":"丙區","type":"T"}]}]}'
).replace('"T"', '"' + T + '"')


def csv_text(cols=COLS, alias=ALIAS, rows=ROWS) -> str:
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(cols)
    if alias is not None:
        w.writerow(alias)
    for r in rows:
        w.writerow(r)
    return buf.getvalue()


def write_city(folder: str, letter: str = "A", *, cols=COLS, alias=ALIAS, rows=ROWS) -> str:
    path = os.path.join(folder, f"{letter}_lvr_land_A.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as fh:
        fh.write(csv_text(cols, alias, rows))
    return path


def reorder(cols_order: list[str]):
    idx = [COLS.index(c) for c in cols_order]
    return ([COLS[i] for i in idx], [ALIAS[i] for i in idx], [[r[i] for i in idx] for r in ROWS])
