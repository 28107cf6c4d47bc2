import os
import zipfile

import pytest
from pyspark.sql import functions as F

from fixtures import ALIAS, COLS, ROWS, csv_text, write_city
from strata.sources.zip_members import read_zip_members, tag_by_member
from strata.streaming.arrivals import document_from_events, ingest_arrivals


def _archive(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text.encode("utf-8-sig"))
    return path


def test_zip_members_two_archives(spark, tmp_dir):
    text = csv_text()
    a = _archive(os.path.join(tmp_dir, "a.zip"), {"A_lvr_land_A.csv": text, "B_lvr_land_A.csv": text,
                                                  "readme.txt": "not csv", "other.csv": text})
    b = _archive(os.path.join(tmp_dir, "b.zip"), {"dir/E_lvr_land_A.csv": text})
    rows = read_zip_members(spark, [a, b], member_pattern="?_lvr_land_A.csv", columns=COLS)
    tagged = tag_by_member(rows, {"A_lvr_land_A.csv": "台北市", "B_lvr_land_A.csv": "台中市",
                                  "E_lvr_land_A.csv": "高雄市"})
    counts = {r.city: r["count"] for r in tagged.groupBy("city").count().collect()}
    assert counts == {"台北市": len(ROWS), "台中市": len(ROWS), "高雄市": len(ROWS)}
    notes = {r[0] for r in tagged.select("備註").collect()}
    assert 'say "hi", ok' in notes and "line1\nline2" in notes


def test_stream_picks_up_only_new_files(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    events = os.path.join(tmp_dir, "events")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write_city(landing, "A")
    kw = dict(checkpoint=ckpt, n_fields=2, columns=COLS)
    ingest_arrivals(spark, landing, events, **kw).awaitTermination()
    first = spark.read.parquet(events).count()
    write_city(landing, "B")
    ingest_arrivals(spark, landing, events, **kw).awaitTermination()
    df = spark.read.parquet(events)
    assert first == 5 and df.count() == 10
    assert {r.city for r in df.select("city").distinct().collect()} == {"台北市", "台中市"}
    doc = document_from_events(spark, events, n_fields=2, max_events_per_line=None)
    assert doc.count() == 2
    assert doc.filter(F.col("city") == "台北市").first().time_slots[-1]["date"] is None


def test_zip_member_missing_column_fails(spark, tmp_dir):
    import pytest

    text = csv_text(cols=COLS[:-1] + ["other"])
    a = _archive(os.path.join(tmp_dir, "bad.zip"), {"A_lvr_land_A.csv": text})
    with pytest.raises(Exception, match="A_lvr_land_A.csv"):
        read_zip_members(spark, [a], columns=COLS).collect()


def test_zip_one_archive_many_members_in_parallel(spark, tmp_dir):
    from strata.sources.zip_members import zip_member_list

    text = csv_text()
    members = {f"{letter}_lvr_land_A.csv": text for letter in "ABEFH"}
    a = _archive(os.path.join(tmp_dir, "big.zip"), members)
    listed = zip_member_list(spark, [a], "*.csv").collect()
    assert sorted(r.member for r in listed) == sorted(members)
    rows = read_zip_members(spark, [a], columns=COLS)
    assert rows.count() == 5 * len(ROWS)
    assert rows.filter(F.col("_row") == 0).count() == 0  # each member's alias row (row 0) dropped
    assert {r["_member"]: r["m"] for r in rows.groupBy("_member").agg(F.max("_row").alias("m")).collect()} == \
        {m: len(ROWS) for m in members}


def test_stream_binds_columns_by_name_and_fails_on_missing_ones(spark, tmp_dir):
    import pytest

    from fixtures import reorder

    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    cols, alias, rows = reorder(list(reversed(COLS)))
    write_city(landing, "A", cols=cols, alias=alias, rows=rows)  # other order: read by name
    events = os.path.join(tmp_dir, "events")
    ingest_arrivals(spark, landing, events, checkpoint=os.path.join(tmp_dir, "ckpt"), n_fields=2,
                    columns=COLS).awaitTermination()
    assert spark.read.parquet(events).count() == 5
    missing = [c for c in COLS if c != "主要用途"]
    idx = [COLS.index(c) for c in missing]
    write_city(landing, "B", cols=missing, alias=[ALIAS[i] for i in idx],
               rows=[[r[i] for i in idx] for r in ROWS])
    q = ingest_arrivals(spark, landing, events, checkpoint=os.path.join(tmp_dir, "ckpt"), n_fields=2,
                        columns=COLS)
    with pytest.raises(Exception, match="lacks? columns"):
        q.awaitTermination()


def test_stream_positional_alias_row(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    write_city(landing, "A")              # alias row first: dropped, 5 rows kept
    write_city(landing, "B", alias=None)  # no alias row: the first (kept) record goes
    events = os.path.join(tmp_dir, "events")
    ingest_arrivals(spark, landing, events, checkpoint=os.path.join(tmp_dir, "ckpt"), n_fields=2,
                    columns=COLS, alias_row="positional").awaitTermination()
    counts = {r.city: r["count"] for r in spark.read.parquet(events).groupBy("city").count().collect()}
    assert counts == {"台北市": 5, "台中市": 4}


def test_stream_parser_drops_only_the_first_row_across_chunks(tmp_dir):
    import pyarrow as pa

    from strata.streaming.arrivals import _file_parser

    p = write_city(tmp_dir, "A")
    out_schema = pa.schema([(c, pa.string()) for c in COLS] + [("city", pa.string()), ("_file", pa.string())])
    # a tiny block size cuts the file into many small chunks
    parser = _file_parser(COLS, lambda path: "x", "positional", out_schema, batch_rows=1)
    import pyarrow.csv as pacsv

    original = pacsv.ReadOptions
    try:
        pacsv.ReadOptions = lambda **kw: original(**{**kw, "block_size": 256})  # first chunk: the alias row alone
        batch = pa.RecordBatch.from_pydict({"path": ["file:" + p]})
        rows = [r for b in parser(iter([batch])) for r in b.column("鄉鎮市區").to_pylist()]
    finally:
        pacsv.ReadOptions = original
    assert rows == [r[0] for r in ROWS]  # only the alias row is gone


@pytest.mark.parametrize("sizes", [[5000] + [100] * 60, list(range(1, 80)), [7], [0, 0, 0]])
def test_members_are_dealt_by_size(spark, sizes):
    """One large and many small members: no task has more than the mean and the largest member."""
    from strata.sources.zip_members import dealt_by_size

    rows = [("z.zip", f"m{i}", n, True) for i, n in enumerate(sizes)]
    dealt = dealt_by_size(spark.createDataFrame(rows, "archive string, member string, size bigint, wanted boolean").repartition(3), 8)
    assert dealt.rdd.getNumPartitions() == 8
    got = [(r["p"], r["size"]) for r in dealt.selectExpr("spark_partition_id() AS p", "size").collect()]
    held = [sum(n for p, n in got if p == t) for t in range(8)]
    assert sorted(n for _, n in got) == sorted(sizes)
    assert max(held) <= sum(sizes) / 8 + max(sizes) and max(held) - min(held) <= max(sizes)
