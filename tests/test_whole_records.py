"""No record is lost in silence: alias rows, missing tokens, foreign files, odd paths, out-of-range numbers."""

from __future__ import annotations

import os
import warnings
import zipfile

import pytest
from fixtures import ALIAS, COLS, ROWS, T, csv_text, write_city
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from strata import session
from strata.__main__ import main
from strata.functions.dates import roc_to_date
from strata.functions.numerals import decode_floor_text, floors
from strata.operators.split import hash_split
from strata.sinks.json_lines import write_parts
from strata.sources.paths import filesystem_of, open_path, store_uri
from strata.sources.records import city_files, discover, read_records
from strata.sources.zip_members import read_zip_members, tag_by_member
from strata.streaming.arrivals import arrivals, foreign_files, ingest_arrivals, tag_by_folder

DATES = ["1080415", "NA", "", "108/04/16"]
DIRTY = [["甲區", d, "十五層", T, "住家用", f"n{i}"] for i, d in enumerate(DATES)]


@pytest.mark.parametrize("mode", ["positional", "typed"])
def test_dirty_dates_are_all_kept(spark, tmp_dir, mode):
    p = write_city(tmp_dir, rows=DIRTY)
    assert sorted(r["備註"] for r in read_records(spark, [p], require=COLS, alias_row=mode).collect()) == ["n0", "n1", "n2", "n3"]


def test_typed_keeps_a_first_record_and_drops_nothing_else(spark, tmp_dir):
    without = write_city(tmp_dir, "A", alias=None, rows=DIRTY)
    assert read_records(spark, [without], require=["備註"], alias_row="typed").count() == 4
    second = write_city(tmp_dir, "B", rows=[DIRTY[0], ALIAS])  # alias text further down is data
    assert read_records(spark, [second], require=["備註"], alias_row="typed").count() == 2


def test_foreign_members_and_files_are_reported(spark, tmp_dir):
    archive = os.path.join(tmp_dir, "a.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for letter in "AC":
            zf.writestr(f"{letter}_lvr_land_A.csv", "\ufeff" + csv_text())
    names = {"A_lvr_land_A.csv": "台北市"}
    with pytest.warns(UserWarning, match="1 archive member"):
        rows = tag_by_member(read_zip_members(spark, archive, names=names, columns=COLS), names)
    assert {r["city"]: r["count"] for r in rows.groupBy("city").count().collect()} == {"台北市": len(ROWS)}
    with warnings.catch_warnings(record=True):
        warnings.simplefilter("always")
        parts = main([archive, os.path.join(tmp_dir, "out"), "--zip", "--no-sizing"])
    assert all("HIVE" not in f for f in parts.values())

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    write_city(landing, "A"), write_city(landing, "C")
    with pytest.warns(UserWarning, match="1 CSV file"):
        assert list(city_files(spark, landing).values()) == ["台北市"]
    assert [r["path"].rsplit("/", 1)[-1] for r in foreign_files(spark, landing).collect()] == ["C_lvr_land_A.csv"]
    events = os.path.join(tmp_dir, "events")
    ingest_arrivals(spark, landing, events, checkpoint=os.path.join(tmp_dir, "ckpt"), n_fields=2, columns=COLS).awaitTermination()
    assert {r["city"] for r in spark.read.parquet(events).collect()} == {"台北市"}


def test_stream_reads_percent_signs_in_folder_names(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    folder = os.path.join(landing, "city=a%3Ab")
    os.makedirs(folder)
    write_city(folder, "A")
    rows = arrivals(spark, landing, columns=COLS, tagger=tag_by_folder("city"))
    q = rows.writeStream.format("memory").queryName("percent").trigger(availableNow=True).option(
        "checkpointLocation", os.path.join(tmp_dir, "ckpt")).start()
    q.awaitTermination()
    assert {(r["city"], r["n"]) for r in spark.sql("SELECT city, count(*) AS n FROM percent GROUP BY city").collect()} == {("a:b", len(ROWS))}


@pytest.mark.parametrize("name", ["台北市", "a b", "50%", "a+b", "a%20b"])
def test_paths_of_other_stores(tmp_dir, name):
    folder = os.path.join(tmp_dir, name)
    os.makedirs(folder)
    path = os.path.join(folder, "x.csv")
    with open(path, "w") as fh:
        fh.write("hello")
    filesystem, inner = filesystem_of("file://" + path)  # the way of every store that is not local
    assert filesystem.open_input_file(inner).read() == b"hello"
    assert open_path("file:" + path).read() == open_path(path, seek=True).read() == b"hello"
    assert store_uri(f"s3a://bucket/{name}/x").startswith("s3://bucket/")
    assert isinstance(filesystem, pafs.LocalFileSystem)


def test_long_headers_are_read_to_their_end(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide.csv")
    names = [f"column \n {i} " + "x" * 90 for i in range(1500)]
    with open(path, "w", encoding="utf-8-sig", newline="") as fh:
        fh.write(csv_text(cols=[*names, "備註"], alias=None, rows=[["v"] * 1500 + ["end"]]))
    assert len(next(iter(discover(spark, [path]))).split("\x1f")) == 1501


def test_numbers_out_of_range_give_null(spark):
    df = spark.createDataFrame([("9223372036854775807",), ("-9223372036854775808",), ("1080415",)], "d string")
    assert [str(r[0]) for r in df.coalesce(1).select(roc_to_date("d")).collect()] == ["None", "None", "2019-04-15"]


def test_null_keys_get_a_part(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "city string, v int")
    written = write_parts(hash_split(df, "city", 2), os.path.join(tmp_dir, "parts"))
    assert sum(spark.read.json(f).count() for f in written.values()) == 3
    raw = df.withColumn("part", F.when(F.col("city").isNotNull(), 0))
    assert sorted(write_parts(raw, os.path.join(tmp_dir, "null"))) == ["0", "None"]


def test_no_own_checkpoint_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_row_decoder_equals_the_native_one(spark):
    texts = [None, "", "層", "五層", "十層", "十二", "二十三層", "三十層以上", "地下一層", "015", "一百層", "一百零一層", "一百二十層"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for mode in ("compat", "full"):
        native = {r["i"]: r["v"] for r in df.select("i", floors("t", mode).alias("v")).collect()}
        assert [decode_floor_text(t, mode) for t in texts] == [native[i] for i in range(len(texts))]
