import json
import os

from pyspark.sql import functions as F

from fixtures import COLS, EXPECTED_TAIPEI, ROWS, T, write_city
from strata.plans.job import run, transform
from strata.sources.records import read_tagged


def test_expected_document_line(spark, tmp_dir):
    p = write_city(tmp_dir)
    recs = read_tagged(spark, {p: "台北市"}, require=COLS)
    doc = transform(recs, max_events_per_line=None)
    lines = [r.j for r in doc.select(F.to_json(F.struct("city", "time_slots")).alias("j")).collect()]
    assert lines == [EXPECTED_TAIPEI]


def test_full_mode_keeps_101_floors(spark, tmp_dir):
    p = write_city(tmp_dir)
    recs = read_tagged(spark, {p: "台北市"}, require=COLS)
    doc = transform(recs, floors_mode="full", max_events_per_line=None).first()
    dates = [s["date"] for s in doc.time_slots]
    assert any(d is not None and d.isoformat() == "2019-04-17" for d in dates)


def test_combined_equals_plain(spark, tmp_dir):
    p = write_city(tmp_dir)
    recs = read_tagged(spark, {p: "台北市"}, require=COLS)
    a = transform(recs, combine_copies=False, max_events_per_line=None).select(F.to_json("time_slots")).first()[0]
    b = transform(recs, combine_copies=True, max_events_per_line=None).select(F.to_json("time_slots")).first()[0]
    assert a == b


def test_run_writes_disjoint_parts_of_valid_json(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    paths = {write_city(src, letter): city for letter, city in
             [("A", "台北市"), ("B", "台中市"), ("E", "高雄市"), ("F", "新北市"), ("H", "桃園市")]}
    out = os.path.join(tmp_dir, "out")
    parts = run(spark, paths, out, require=COLS, files_per_part=1, max_events_per_line=None)
    seen = []
    lines = {}
    for folder in parts.values():
        files = [f for f in os.listdir(folder) if f.endswith(".json")]
        assert len(files) == 1
        for line in open(os.path.join(folder, files[0]), encoding="utf-8"):
            city = json.loads(line)["city"]
            seen.append(city)
            lines[city] = line.rstrip("\n")
    assert sorted(seen) == sorted(paths.values())  # every city once, across the parts
    assert lines["台北市"] == EXPECTED_TAIPEI  # the written bytes, order inside arrays included


def test_28_field_document(spark, tmp_dir):
    from strata import schema

    cols = schema.SOURCE_COLUMNS
    row = {c: "" for c in cols}
    row.update({"鄉鎮市區": "甲區", "交易年月日": "1080415", "總樓層數": "十五層", "建物型態": T,
                "主要用途": "住家用", "建物現況格局-房": "3", "總價元": "12000000", "備註": "x"})
    p = write_city(tmp_dir, cols=cols, alias=[schema.ALIAS_BY_SOURCE[c] for c in cols],
                   rows=[[row[c] for c in cols]])
    recs = read_tagged(spark, {p: "台北市"})
    ev = transform(recs, n_fields=28, max_events_per_line=None).first().time_slots[0].events[0]
    assert ev["room"] == 3 and ev["price"] == 12000000 and ev["health"] is None
    assert list(ev.asDict()) == schema.FULL_EVENT_FIELDS
    assert len(ROWS) > 0
