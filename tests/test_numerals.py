import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions.numerals import (
    decode_floor_series,
    decode_floor_text,
    floor_text,
    floors,
    floors_pandas_udf,
    floors_udf,
)

# text, compat, full (hand-traced rule table)
TABLE = [
    (None, 0, 0), ("五層", 5, 5), ("十層", 10, 10), ("十二", 12, 12), ("十三層", 13, 13),
    ("二十層", 20, 20), ("二十三層", 23, 23), ("三十層以上", 30, 30), ("地下一層", 1, 1),
    ("015", 0, 0), ("見其他登記事項", 0, 0), ("一百層", 0, 100), ("一百零一層", 1, 101),
    ("一百十二層", 12, 112), ("一百二十層", 20, 120), ("", 0, 0), ("層", 0, 0),
    ("九百九十九層", 99, 999), ("層層", 0, 0), ("十", 10, 10),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TABLE)], "i int, t string")


@pytest.mark.parametrize("mode,idx", [("compat", 1), ("full", 2)])
def test_native_table(texts, mode, idx):
    got = {r.i: r.v for r in texts.select("i", floors("t", mode).alias("v")).collect()}
    assert got == {i: row[idx] for i, row in enumerate(TABLE)}


@pytest.mark.parametrize("impl", [floors_udf, floors_pandas_udf])
@pytest.mark.parametrize("mode,idx", [("compat", 1), ("full", 2)])
def test_udf_parity(texts, impl, mode, idx):
    got = {r.i: r.v for r in texts.select("i", impl("t", mode).alias("v")).collect()}
    assert got == {i: row[idx] for i, row in enumerate(TABLE)}


def test_python_helpers_agree():
    s = pd.Series([t for t, _, _ in TABLE], dtype=object)
    for mode, idx in (("compat", 1), ("full", 2)):
        assert [decode_floor_text(t, mode) for t, _, _ in TABLE] == [row[idx] for row in TABLE]
        assert decode_floor_series(s, mode).tolist() == [row[idx] for row in TABLE]


def test_encode_decode_round_trip(spark):
    df = spark.range(1, 1000).select(F.col("id").cast("int").alias("n"))
    df = df.select("n", floor_text("n").alias("t"))
    bad_full = df.filter(floors("t", "full") != F.col("n")).count()
    bad_compat = df.filter(floors("t", "compat") != F.pmod("n", F.lit(100))).count()
    assert bad_full == 0 and bad_compat == 0


def test_written_forms(spark):
    df = spark.createDataFrame([(13,), (10,), (20,), (101,), (112,), (5,)], "n int")
    got = [r.t for r in df.select(floor_text("n").alias("t")).collect()]
    assert got == ["十三層", "十層", "二十層", "一百零一層", "一百一十二層", "五層"]


def test_native_plan_has_no_python(spark, texts):
    plan = texts.select(floors("t")).select("*")._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ALPHABET = "一二三四五六七八九十百零層地下以上a1 "


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=300, max_size=300))
def test_native_python_pandas_agree_on_any_text(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    for mode in ("compat", "full"):
        native = {r.i: r.v for r in df.select("i", floors("t", mode).alias("v")).collect()}
        assert native == {i: decode_floor_text(t, mode) for i, t in rows}
        assert decode_floor_series(pd.Series(texts, dtype=object), mode).tolist() == \
            [decode_floor_text(t, mode) for t in texts]
