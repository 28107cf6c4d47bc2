import os

import pytest
from pyspark.sql import functions as F

from fixtures import ALIAS, COLS, ROWS, reorder, write_city
from strata.operators.tagging import ColumnMismatch
from strata.sources.records import read_records, read_tagged, spark_path


def test_quotes_newlines_bom(spark, tmp_dir):
    p = write_city(tmp_dir)
    df = read_records(spark, [p], require=COLS)
    notes = [r[0] for r in df.select("備註").collect()]
    assert 'say "hi", ok' in notes and "line1\nline2" in notes
    assert "鄉鎮市區" in df.columns  # BOM stripped from the first name
    assert df.count() == len(ROWS)


@pytest.mark.parametrize("mode", ["typed", "positional"])
def test_alias_row_modes(spark, tmp_dir, mode):
    p = write_city(tmp_dir)
    df = read_records(spark, [p], require=COLS, alias_row=mode)
    assert df.count() == len(ROWS)
    assert df.filter(F.col("鄉鎮市區") == ALIAS[0]).count() == 0


def test_positional_drops_first_row_whatever_it_holds(spark, tmp_dir):
    p = write_city(tmp_dir, alias=None)  # no alias row: the first data row goes
    df = read_records(spark, [p], require=COLS, alias_row="positional")
    assert df.count() == len(ROWS) - 1
    assert df.filter(F.col("備註") == "").count() == 0  # ROWS[0] had the empty note


def test_typed_keeps_missing_dates(spark, tmp_dir):
    p = write_city(tmp_dir)
    df = read_records(spark, [p], require=COLS, alias_row="typed")
    assert df.filter(F.col("交易年月日").isNull()).count() == 1


def test_header_only_and_alias_only(spark, tmp_dir):
    a = write_city(tmp_dir, "A", rows=[], alias=None)
    b = write_city(tmp_dir, "B", rows=[])
    for mode in ("typed", "positional"):
        assert read_records(spark, [a, b], require=COLS, alias_row=mode).count() == 0


def test_column_order_swapped_union_by_name(spark, tmp_dir):
    a = write_city(tmp_dir, "A")
    cols, alias, rows = reorder(list(reversed(COLS)))
    b = write_city(tmp_dir, "B", cols=cols, alias=alias, rows=rows)
    df = read_tagged(spark, {a: "台北市", b: "台中市"}, require=COLS)
    by_city = {c: sorted(tuple("" if v is None else v for v in r)
                         for r in df.filter(F.col("city") == c).select(*COLS).collect())
               for c in ("台北市", "台中市")}
    assert by_city["台北市"] == by_city["台中市"]
    assert len(by_city["台北市"]) == len(ROWS)


def test_missing_column_raises(spark, tmp_dir):
    a = write_city(tmp_dir, "A")
    cols = [c for c in COLS if c != "主要用途"]
    idx = [COLS.index(c) for c in cols]
    b = write_city(tmp_dir, "B", cols=cols, alias=[ALIAS[i] for i in idx],
                   rows=[[r[i] for i in idx] for r in ROWS])
    with pytest.raises(ColumnMismatch):
        read_records(spark, [a, b], require=COLS)


def test_na_tokens_become_null(spark, tmp_dir):
    rows = [["甲區", "1080415", "十三層", "NA", "None", "null"]]
    p = write_city(tmp_dir, rows=rows)
    from strata import schema

    r = read_records(spark, [p], require=COLS, na_tokens=schema.NA_TOKENS).first()
    assert r["建物型態"] is None and r["主要用途"] is None and r["備註"] is None


def test_tag_by_folder_and_encoded_names(spark, tmp_dir):
    d1 = os.path.join(tmp_dir, "city=MIDDLE EAST")
    d2 = os.path.join(tmp_dir, "a+b%c")
    os.makedirs(d1)
    os.makedirs(d2)
    write_city(d1, "A")
    write_city(d2, "B")
    df = read_tagged(spark, {d1: "m", d2: "x"}, require=COLS)
    counts = {r.city: r["count"] for r in df.groupBy("city").count().collect()}
    assert counts == {"m": len(ROWS), "x": len(ROWS)}


def test_spark_path_forms():
    assert spark_path("/a/b.csv") == "file:/a/b.csv"
    assert spark_path("file:///a/b.csv") == "file:/a/b.csv"
    assert spark_path("hdfs://nn/a") == "hdfs://nn/a"


def test_header_names_with_spaces(spark, tmp_dir):
    cols = [" " + COLS[0]] + COLS[1:-1] + [COLS[-1] + " "]
    p = write_city(tmp_dir, cols=cols)
    df = read_records(spark, [p], require=COLS)
    assert df.columns[:len(COLS)] == COLS and df.count() == len(ROWS)


def test_float_artifacts_from_a_pandas_rewrite(spark, tmp_dir):
    from strata.operators.project import cast_columns

    rows = [["甲區", "1080415.0", "十三層", "T", "住家用", ""]]
    p = write_city(tmp_dir, rows=rows)
    df = read_records(spark, [p], require=COLS, alias_row="typed")
    assert df.count() == 1  # a float-form date is a date, not an alias row
    typed = cast_columns(spark.createDataFrame([("3.0", "3.5", "12000000.0")], "a string, b string, c string"),
                         {"a": "int", "b": "int", "c": "bigint"}).first()
    assert (typed.a, typed.b, typed.c) == (3, None, 12000000)


def test_tag_filter_prunes_city_files(spark, tmp_dir):
    a = write_city(tmp_dir, "A")
    b = write_city(tmp_dir, "B")
    df = read_tagged(spark, {a: "台北市", b: "台中市"}, require=COLS).filter(F.col("city") == "台中市")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    files = {r["_file"] for r in df.select("_file").distinct().collect()}
    assert len(files) == 1 and files.pop().endswith("B_lvr_land_A.csv")
    assert df.count() == len(ROWS)


def test_many_tags_single_scan(spark, tmp_dir):
    a = write_city(tmp_dir, "A")
    b = write_city(tmp_dir, "B")
    df = read_tagged(spark, {a: "x", b: "y"}, require=COLS, branch_tag_limit=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert {r.city: r["count"] for r in df.groupBy("city").count().collect()} == {"x": len(ROWS), "y": len(ROWS)}


def test_empty_file_is_skipped(spark, tmp_dir):
    import warnings

    p = write_city(tmp_dir, "A")
    empty = os.path.join(tmp_dir, "B_lvr_land_A.csv")
    open(empty, "w").close()  # 0 bytes: Spark's listing leaves it out
    bom_only = os.path.join(tmp_dir, "E_lvr_land_A.csv")
    with open(bom_only, "w", encoding="utf-8-sig") as fh:
        fh.write("")  # a byte-order mark and nothing else: no header
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        df = read_records(spark, [tmp_dir], require=COLS)
    assert df.count() == len(ROWS)
    assert any("empty file" in str(w.message) for w in caught)


def test_tag_with_only_an_empty_file(spark, tmp_dir):
    import warnings

    p = write_city(tmp_dir, "A")
    bom_only = os.path.join(tmp_dir, "B_lvr_land_A.csv")
    with open(bom_only, "w", encoding="utf-8-sig") as fh:
        fh.write("")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = read_tagged(spark, {p: "台北市", bom_only: "台中市"}, require=COLS)
    assert {r.city for r in df.select("city").distinct().collect()} == {"台北市"}


def test_positional_on_split_files(spark, tmp_dir):
    rows = [[f"區{i}", "1080415", "十五層", "T", "住家用", f"n{i}"] for i in range(3000)]
    a = write_city(tmp_dir, "A", rows=rows)
    b = write_city(tmp_dir, "B", rows=rows[:1500])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        df = read_records(spark, [a, b], require=COLS, alias_row="positional", multiline=False)
        assert df.rdd.getNumPartitions() > 4  # the files really are split
        by_file = {r["_file"].rsplit("/", 1)[-1]: r["count"] for r in df.groupBy("_file").count().collect()}
        assert by_file == {"A_lvr_land_A.csv": 3000, "B_lvr_land_A.csv": 1500}
        assert df.filter(F.col("鄉鎮市區") == ALIAS[0]).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_first_rows_dropper_on_arrow_batches():
    import pyarrow as pa

    from strata.sources.records import _first_rows_dropper

    def batch(rows):
        return pa.RecordBatch.from_pydict({"v": [r[0] for r in rows], "_file": [r[1] for r in rows],
                                           "_block": [r[2] for r in rows]})

    batches = [
        batch([("b1-0", "f", 100), ("b1-1", "f", 100)]),  # a later split of f first
        batch([("alias-f", "f", 0), ("f-1", "f", 0)]),    # then f's first split: drop its first row
        batch([("f-2", "f", 0), ("alias-g", "g", 0)]),    # state carried across batches
        batch([("g-1", "g", 0)]),
    ]
    kept = [v for b in _first_rows_dropper("_file", None)(iter(batches)) for v in b.column("v").to_pylist()]
    assert kept == ["b1-0", "b1-1", "f-1", "f-2", "g-1"]

    # typed: a first row goes only when its date shows an alias row
    kept = [v for b in _first_rows_dropper("_file", "v")(iter([batch([("date", "f", 0), ("x", "f", 0), ("1080415", "g", 0)])]))
            for v in b.column("v").to_pylist()]
    assert kept == ["x", "1080415"]


def test_records_are_cut_outside_quotes(monkeypatch):
    import io

    from strata.sources import records

    data = b'a,"b\n""c""",d\r\n\r\n1,"2\r\n3",4\nlast'
    for size in (1, 3, 1 << 16):
        monkeypatch.setattr(records, "HEADER_READ_BYTES", size)
        assert records._records(io.BytesIO(data), 2) == [b'a,"b\n""c""",d', b'1,"2\r\n3",4']
        assert records._records(io.BytesIO(data), 9)[-1] == b"last" and records._records(io.BytesIO(b""), 2) == []


@pytest.mark.parametrize("mode", ["positional", "typed", "none"])
def test_where_equals_a_filter_after_reading(spark, tmp_dir, mode):
    """Files with an alias row, without one, with one that meets the condition, and with only that."""
    odd = list(ALIAS)
    odd[COLS.index("主要用途")], odd[COLS.index("建物型態")] = "住家用", "住宅大樓 x"
    paths = [write_city(tmp_dir, "A"), write_city(tmp_dir, "B", alias=None), write_city(tmp_dir, "E", alias=odd),
             write_city(tmp_dir, "F", alias=odd, rows=[]), write_city(tmp_dir, "H", rows=[odd, odd, *ROWS])]
    where = (F.col("主要用途") == "住家用") & F.col("建物型態").contains("住宅大樓")

    def rows(df):
        return sorted(map(str, df.collect()))

    for require in (COLS, ["備註", "主要用途", "建物型態"], None):
        plain = read_records(spark, paths, require=require, alias_row=mode)
        assert rows(read_records(spark, paths, require=require, alias_row=mode, where=where)) == rows(plain.where(where))


def test_non_csv_files_in_a_folder_are_ignored(spark, tmp_dir):
    write_city(tmp_dir, "A")
    with open(os.path.join(tmp_dir, "README.txt"), "w") as fh:
        fh.write("not a city file\n")
    df = read_tagged(spark, {tmp_dir: "台北市"}, require=COLS)
    assert df.count() == len(ROWS)
