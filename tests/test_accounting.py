"""Accounting of what cleaning nulls, reconciliation of contents, splits by keys, published results, one file-name rule."""

from __future__ import annotations

import json
import os
import zipfile
from collections import Counter

import pyarrow as pa
import pytest
from fixtures import COLS, ROWS, csv_text, write_city
from pyspark.sql import Observation
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata import schema
from strata.__main__ import main
from strata.functions.numerals import decode_floor_array, decode_floor_text
from strata.operators.project import account_for, accounts
from strata.operators.split import balanced_split, cut_points, keyed_split, md5_order, random_split
from strata.operators.tagging import reconcile_contents, reconcile_counts, source_counts, tagged_union
from strata.plans.job import run
from strata.sinks.published import live, publish_parts, read_published
from strata.sources.records import city_files, read_tagged
from strata.sources.zip_members import read_zip_members, tag_by_member
from strata.streaming.arrivals import tag_by_letter


# --- accounting ---------------------------------------------------------------

def test_accounts_count_tokens_and_failed_casts(spark):
    rows = [("1080415", "5", "NA"), ("108/04/16", "x", None), ("None", None, "text"), (None, "7.5", ""), (" 1080416 ", "8.0", "n/a")]
    df = spark.createDataFrame(rows, f"`{schema.COL_DATE}` string, `建物現況格局-房` string, `備註` string")
    seen = Observation("seen")
    assert account_for(df, seen).count() == 5
    got = {r["field"]: (r["n_missing"], r["n_failed"]) for r in accounts(spark, seen).collect()}
    assert seen.get["rows"] == 5
    assert got == {"transaction_date": (1, 1), "room": (0, 2), "note": (3, 0)}


def test_job_report(spark, tmp_dir):
    paths = {write_city(tmp_dir, "A"): "台北市", write_city(tmp_dir, "B", rows=ROWS[:1] * 30): "台中市"}
    report: dict = {}
    out = run(spark, paths, os.path.join(tmp_dir, "out"), report=report, require=COLS, max_events_per_line=4)
    plain = run(spark, paths, os.path.join(tmp_dir, "plain"), require=COLS, max_events_per_line=4)

    def lines(parts):
        return sorted(r["value"] for f in parts.values() for r in spark.read.text(f).collect())

    assert lines(out) == lines(plain)
    assert [c["city"] for c in report["cities"]] == sorted(["台北市", "台中市"]) and all(c["ok"] for c in report["cities"])
    assert {c["city"]: c["n_rows"] for c in report["cities"]}["台中市"] == 30
    assert report["rows"] > 0 and {f["field"] for f in report["fields"]} == {schema.ALIAS_BY_SOURCE[c] for c in COLS}
    assert report["values"]["type"]


def test_cli_report(spark, tmp_dir, capsys):
    write_city(tmp_dir, "A")
    main([tmp_dir, os.path.join(tmp_dir, "out"), "--no-sizing", "--report"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["cities"][0]["ok"] and report["cities"][0]["n_rows"] == report["cities"][0]["n_expected"] > 0


# --- reconciliation -----------------------------------------------------------

def test_contents_see_a_swap_that_counts_do_not(spark):
    rows = [("a", i, None if i % 3 else "x") for i in range(20)] + [(None, i, "y") for i in range(5)] + [("b", 1, None)]
    want = spark.createDataFrame(rows, "city string, k int, v string")
    moved = [r for r in rows if r != ("a", 4, None)] + [("a", 5, None)]
    have = spark.createDataFrame(moved[::-1], "city string, k int, v string").repartition(3)
    counts = reconcile_counts(have, "city", want.groupBy("city").agg(F.count(F.lit(1)).alias("n_expected")))
    assert all(r["ok"] for r in counts.collect()) and counts.count() == 4  # two tags, the null tag, the total
    assert {r["city"]: (r["n_rows"], r["n_expected"], r["ok"]) for r in reconcile_contents(have, want).collect()} == {
        "a": (20, 20, False), "b": (1, 1, True), None: (5, 5, True)}
    # a null that moved to another column, a missing tag, an additional tag
    shifted = spark.createDataFrame([("b", None, "1"), ("c", 1, None)], "city string, k string, v string")
    other = want.where("city = 'b'").select("city", F.col("k").cast("string").alias("k"), "v")
    assert {r["city"]: r["ok"] for r in reconcile_contents(shifted, other).collect()} == {"b": False, "c": False}


def test_union_keeps_rows_without_a_tag(spark):
    frames = {"a": spark.range(3).toDF("k"), None: spark.range(2).toDF("k")}
    union = tagged_union(frames)
    assert Counter(r["city"] for r in union.collect()) == {"a": 3, None: 2}
    got = reconcile_counts(union, "city", source_counts(frames)).collect()
    assert sorted((r["city"] or "", r["n_rows"], r["ok"]) for r in got) == [("", 2, True), ("", 5, True), ("a", 3, True)]


# --- splits -------------------------------------------------------------------

@pytest.mark.parametrize("n_keys,n", [(1000, 2), (1000, 7), (3, 5), (1, 2), (0, 3)])
def test_balanced_split_is_ntile_without_a_rank(spark, n_keys, n):
    keys = [None if i == 4 else f"k{i}" for i in range(n_keys)]
    df = spark.createDataFrame([(k, j) for k in keys for j in range(2)], "k string, j int").repartition(4)
    got = balanced_split(df, "k", n, seed=9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Exchange range" not in plan
    ranked = df.select("k").distinct().withColumn(
        "part", F.ntile(n).over(Window.orderBy(md5_order("k", 9), F.col("k").asc_nulls_first())) - 1)
    expected = {r["k"]: r["part"] for r in ranked.collect()}
    assert {(r["k"], r["part"]) for r in got.collect()} == set(expected.items()) and got.count() == 2 * n_keys


def test_cut_points_among_equal_orders(spark, monkeypatch):
    """Keys whose orders are equal are cut by the key, the null key first."""
    from strata.operators import split

    monkeypatch.setattr(split, "md5_order", lambda key, seed=42: F.pmod(F.length(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(""))),
                                                                        F.lit(3)).cast("bigint"))
    keys = spark.createDataFrame([(x,) for x in (None, "abc", "def", "a", "b", "c", "ab")], "k string")
    order = [(0, None), (0, "abc"), (0, "def"), (1, "a"), (1, "b"), (1, "c"), (2, "ab")]
    assert cut_points(keys, "k", range(7)) == order
    parts = {r["k"]: r["part"] for r in balanced_split(keys, "k", 7).collect()}
    assert parts == {k: i for i, (_, k) in enumerate(order)}


def test_keyed_split_has_its_weights_and_nothing_else(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("v"))
    weights = (0.5, 0.0, 0.3, 0.2)
    a = {r["k"]: r["part"] for r in keyed_split(df, "k", weights, seed=3).collect()}
    b = {r["k"]: r["part"] for r in keyed_split(df.repartition(7).where("k % 2 = 0"), "k", weights, seed=3).collect()}
    assert all(a[k] == p for k, p in b.items())
    sizes = Counter(a.values())
    assert sizes[1] == 0 and all(abs(sizes[i] - 20_000 * w) < 4 * 75 for i, w in enumerate(weights))
    assert a != {r["k"]: r["part"] for r in keyed_split(df, "k", weights, seed=4).collect()}
    frames = random_split(df, (1, 0), seed=1)
    assert [f.count() for f in frames] == [20_000, 0]
    for bad in ((), (0, 0), (1, -1)):
        with pytest.raises(ValueError):
            keyed_split(df, "k", bad)


# --- results that are replaced --------------------------------------------------

def test_published_results(spark, tmp_dir):
    path = os.path.join(tmp_dir, "result")
    assert live(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    first = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "part int, v string").repartition(3)
    publish_parts(first, path, files_per_part=1)
    assert sorted((r["part"], r["value"]) for r in read_published(spark, path).collect()) == [
        ("0", '{"v":"a"}'), ("0", '{"v":"b"}'), ("1", '{"v":"c"}')]
    with pytest.raises(Exception):  # a write that fails is never seen
        publish_parts(first.withColumn("v", F.raise_error(F.lit("no"))), path)
    assert read_published(spark, path).count() == 3
    publish_parts(spark.createDataFrame([(1, "z")], "part int, v string"), path)
    assert [(r["part"], r["value"]) for r in read_published(spark, path).collect()] == [("1", '{"v":"z"}')]
    publish_parts(first.limit(0), path)
    assert read_published(spark, path).count() == 0 and live(spark, path)[0] == 3


# --- one file-name rule ---------------------------------------------------------

def test_folder_archive_and_stream_take_the_same_names(spark, tmp_dir):
    write_city(tmp_dir, "A")
    os.rename(os.path.join(tmp_dir, "A_lvr_land_A.csv"), os.path.join(tmp_dir, "a_LVR_land_a.CSV"))
    found = city_files(spark, tmp_dir)
    assert list(found.values()) == ["台北市"] and [tag_by_letter()(p) for p in found] == ["台北市"]
    assert read_tagged(spark, found, require=COLS).count() == len(ROWS)
    archive = os.path.join(tmp_dir, "x.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        zf.writestr("b_lvr_land_a.CSV", "\ufeff" + csv_text())
    names = {"B_lvr_land_A.csv": "台中市"}
    rows = tag_by_member(read_zip_members(spark, archive, names=names, columns=COLS), names)
    assert {r["city"]: r["count"] for r in rows.groupBy("city").count().collect()} == {"台中市": len(ROWS)}


# --- the Arrow form of the numerals -----------------------------------------------

def test_arrow_decode_equals_the_plain_rule():
    texts = [None, "", "層", "十", "十層", "十三層", "二十層", "二十三層", "一百零一層", "九百九十九層", "地下一層", "015", "三十層以上",
             "二\n十層", "層層", "十層十", "百", "五百十", "X十二層", "見其他登記事項"]
    for mode in ("compat", "full"):
        assert decode_floor_array(pa.array(texts, pa.string()), mode).to_pylist() == [decode_floor_text(t, mode) for t in texts]
    assert decode_floor_array(pa.array([], pa.string())).to_pylist() == []
