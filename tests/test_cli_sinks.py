import json
import os
import zipfile

from pyspark.sql import functions as F

from fixtures import COLS, ROWS, write_city
from strata.__main__ import main
from strata.sinks.json_lines import write_json_lines, write_parts
from strata.sources.records import read_tagged


def _cities(folder):
    out = []
    for f in sorted(os.listdir(folder)):
        if f.endswith(".json"):
            out += [json.loads(line)["city"] for line in open(os.path.join(folder, f), encoding="utf-8")]
    return out


def test_cli_folder_and_zip(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for letter in "ABEFH":
        write_city(src, letter)
    parts = main([src, os.path.join(tmp_dir, "out"), "--split", "balanced", "--whole-cities"])
    seen = sum((_cities(p) for p in parts.values()), [])
    assert sorted(seen) == sorted(["台北市", "台中市", "高雄市", "新北市", "桃園市"])
    archive = os.path.join(tmp_dir, "a.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for letter in "ABEFH":
            zf.write(os.path.join(src, f"{letter}_lvr_land_A.csv"), f"{letter}_lvr_land_A.csv")
    zparts = main([archive, os.path.join(tmp_dir, "outz"), "--zip", "--alias-row", "positional", "--whole-cities"])
    assert sorted(sum((_cities(p) for p in zparts.values()), [])) == sorted(seen)


def test_many_files_tag_by_join(spark, tmp_dir):
    a = write_city(tmp_dir, "A")
    b = write_city(tmp_dir, "B")
    df = read_tagged(spark, {a: "x", b: "y"}, require=COLS, branch_tag_limit=1)
    counts = {r.city: r["count"] for r in df.groupBy("city").count().collect()}
    assert counts == {"x": len(ROWS), "y": len(ROWS)}


def test_json_lines_single_file_and_parts(spark, tmp_dir):
    df = spark.range(50).select((F.col("id") % 3).alias("part"), F.col("id").alias("v"))
    out = write_json_lines(df.select("v"), os.path.join(tmp_dir, "one"), n_files=1)
    files = [f for f in os.listdir(out) if f.endswith(".json")]
    assert len(files) == 1
    parts = write_parts(df, os.path.join(tmp_dir, "parts"), files_per_part=2)
    assert sorted(parts) == ["0", "1", "2"]
    total = 0
    for folder in parts.values():
        for f in os.listdir(folder):
            if f.endswith(".json"):
                total += sum(1 for _ in open(os.path.join(folder, f)))
    assert total == 50


def test_size_for_input(spark):
    from strata.session import size_for_input

    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        n = size_for_input(spark, 100 * (256 << 20))
        assert n == 100 and spark.conf.get("spark.sql.shuffle.partitions") == "100"
        assert size_for_input(spark, 10) == 100  # a session that chose already keeps its choice
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_big_multiline_file_warns(spark, tmp_dir):
    import warnings

    from strata.sources.records import read_records

    p = write_city(tmp_dir)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            read_records(spark, [p], require=COLS)
        assert any("multiLine" in str(w.message) for w in caught)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_records_csv_has_bom_header_and_alias_row(spark, tmp_dir):
    from strata.sinks.records_csv import write_records_csv

    df = spark.createDataFrame([("台北市", "甲區", "1080415"), ("台北市", "乙區", "990101")],
                               "city string, `鄉鎮市區` string, `交易年月日` string")
    out = write_records_csv(df, os.path.join(tmp_dir, "csv"))
    folder = os.path.join(out, "city=台北市")
    rows = []
    for f in sorted(os.listdir(folder)):
        if f.endswith(".csv"):
            raw = open(os.path.join(folder, f), "rb").read()
            assert raw.startswith(b"\xef\xbb\xbf")
            lines = raw.decode("utf-8-sig").splitlines()
            assert lines[:2] == ["鄉鎮市區,交易年月日", "district,transaction_date"]  # one alias row at the head of every file
            rows += lines[2:]
    assert sorted(rows) == sorted(["甲區,1080415", "乙區,990101"])


def test_cli_paged_pages_concatenate_to_document(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    write_city(src, "A")
    full = main([src, os.path.join(tmp_dir, "full"), "--whole-cities"])
    paged = main([src, os.path.join(tmp_dir, "paged"), "--max-events-per-line", "2"])

    def lines(parts):
        out = []
        for folder in parts.values():
            for f in sorted(os.listdir(folder)):
                if f.endswith(".json"):
                    out += [json.loads(x) for x in open(os.path.join(folder, f), encoding="utf-8")]
        return out

    doc = lines(full)[0]
    pages = sorted(lines(paged), key=lambda d: d["page"])
    assert all(sum(len(s["events"]) for s in p["time_slots"]) <= 2 for p in pages)
    merged = []
    for p in pages:
        for s in p["time_slots"]:
            if merged and merged[-1].get("date") == s.get("date"):
                merged[-1]["events"] += s["events"]
            else:
                merged.append({k: (list(v) if k == "events" else v) for k, v in s.items()})
    assert merged == doc["time_slots"]


def test_write_parts_of_an_empty_result(spark, tmp_dir):
    df = spark.range(0).select(F.col("id").alias("part"), F.col("id").alias("v"))
    assert write_parts(df, os.path.join(tmp_dir, "empty")) == {}


def test_cli_named_part_paths(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for letter in "ABEFH":
        write_city(src, letter)
    p1, p2 = os.path.join(tmp_dir, "output1.json"), os.path.join(tmp_dir, "output2.json")
    main([src, tmp_dir, "--part-paths", f"{p1},{p2}", "--files-per-part", "1", "--split", "balanced", "--whole-cities"])
    c1, c2 = _cities(p1), _cities(p2)
    assert not set(c1) & set(c2) and sorted(c1 + c2) == sorted(["台北市", "台中市", "高雄市", "新北市", "桃園市"])
    assert len([f for f in os.listdir(p1) if f.endswith(".json")]) == 1
    assert "part" not in json.loads(open(os.path.join(p1, [f for f in os.listdir(p1) if f.endswith(".json")][0]),
                                         encoding="utf-8").readline())


def test_cli_events_table_gives_the_same_document(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for letter in "AB":
        write_city(src, letter)
    direct = main([src, os.path.join(tmp_dir, "direct"), "--whole-cities"])
    staged = main([src, os.path.join(tmp_dir, "staged"), "--events-dir", os.path.join(tmp_dir, "events"), "--whole-cities"])

    def docs(parts):
        out = {}
        for folder in parts.values():
            for f in os.listdir(folder):
                if f.endswith(".json"):
                    for line in open(os.path.join(folder, f), encoding="utf-8"):
                        d = json.loads(line)
                        out[d["city"]] = d
        return out

    assert docs(direct) == docs(staged) and len(docs(direct)) == 2
    assert os.path.isdir(os.path.join(tmp_dir, "events", "city_dir=台北市"))


def test_cli_stream_mode_resumes(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    write_city(landing, "A")
    events = os.path.join(tmp_dir, "events")
    first = main([landing, os.path.join(tmp_dir, "out1"), "--stream", "--events-dir", events, "--whole-cities"])
    assert sorted(sum((_cities(p) for p in first.values()), [])) == ["台北市"]
    write_city(landing, "B")  # a new file lands; the rerun ingests only it
    second = main([landing, os.path.join(tmp_dir, "out2"), "--stream", "--whole-cities", "--events-dir", events,
                   "--max-files-per-trigger", "1"])
    assert sorted(sum((_cities(p) for p in second.values()), [])) == sorted(["台北市", "台中市"])
    assert spark.read.parquet(events).count() == 10


def test_named_parts_refuse_to_leave_a_part_out(spark, tmp_dir):
    import pytest

    from strata.sinks.json_lines import write_named_parts

    df = spark.range(10).select((F.col("id") % 2).alias("part"), F.col("id").alias("v"))
    with pytest.raises(ValueError, match="no path for part"):
        write_named_parts(df, {0: os.path.join(tmp_dir, "only0")})
    out = write_named_parts(df, {0: os.path.join(tmp_dir, "p0"), 1: os.path.join(tmp_dir, "p1")})
    total = sum(sum(1 for f in os.listdir(p) if f.endswith(".json") for _ in open(os.path.join(p, f)))
                for p in out.values())
    assert total == 10


def test_records_csv_of_few_tags_is_written_without_a_sort(spark, tmp_dir):
    """The tasks keep a file open for each tag, an alias row first in each; more tags than said are an error."""
    import csv
    import glob

    import pytest

    from strata.sinks.records_csv import write_records_csv

    key = "spark.sql.maxConcurrentOutputFileWriters"
    rows = spark.range(30_000, numPartitions=2).selectExpr(
        "if(id % 5 = 4, null, concat('c', id % 5)) AS city", "cast(id AS string) AS `編號`", "concat('a, \"', id, '\"\nb') AS `備註`")
    before = spark.conf.get(key)
    out = write_records_csv(rows, os.path.join(tmp_dir, "few"), n_tags=5)
    assert spark.conf.get(key) == before
    files = glob.glob(f"{out}/city=*/*.csv")
    assert len(files) == 10
    for path in files:
        with open(path, encoding="utf-8-sig", newline="") as fh:
            head, alias, *data = csv.reader(fh)
        ids = [int(r[0]) for r in data]
        assert head == ["編號", "備註"] and not alias[0].isdigit() and len(ids) == 3_000
        assert ids == sorted(ids) and all(r[1] == f'a, "{r[0]}"\nb' for r in data)  # in the rows' order: a sort of texts or by tag gives another
    sorted_out = write_records_csv(rows, os.path.join(tmp_dir, "sorted"))
    assert len(glob.glob(f"{sorted_out}/city=*/*.csv")) == 10
    with pytest.raises(Exception, match="more than the 3 tags"):
        write_records_csv(rows, os.path.join(tmp_dir, "wrong"), n_tags=3)
