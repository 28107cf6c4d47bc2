import pytest
from pyspark.sql import functions as F

from strata.operators.tagging import (
    ColumnMismatch,
    assert_same_columns,
    reconcile_counts,
    source_counts,
    tagged_union,
)


def _frames(spark):
    base = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    return {"a": base.filter("k < 30"), "b": base.filter("k >= 30 and k < 80"), "c": base.filter("k >= 80")}


def test_tagged_union_and_reconcile(spark):
    frames = _frames(spark)
    union = tagged_union(frames)
    rec = {r.city: (r.n_rows, r.n_expected, r.ok)
           for r in reconcile_counts(union, "city", source_counts(frames)).collect()}
    assert rec == {"a": (30, 30, True), "b": (50, 50, True), "c": (20, 20, True), None: (100, 100, True)}


def test_reconcile_flags_a_lost_source(spark):
    frames = _frames(spark)
    union = tagged_union({k: v for k, v in frames.items() if k != "c"})
    rec = {r.city: r.ok for r in reconcile_counts(union, "city", source_counts(frames)).collect()}
    assert rec["c"] is False and rec[None] is False and rec["a"] is True


def test_union_by_name_and_column_check(spark):
    frames = _frames(spark)
    frames["b"] = frames["b"].select("v", "k")  # other order: still fine
    assert tagged_union(frames).count() == 100
    frames["c"] = frames["c"].withColumnRenamed("v", "w")
    with pytest.raises(ColumnMismatch):
        assert_same_columns(frames)


def test_tag_filter_prunes_branches(spark):
    union = tagged_union(_frames(spark)).filter(F.col("city") == "a")
    plan = union._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range") == 1  # only branch "a" is left


def test_same_columns_by_source(spark, tmp_dir):
    import os

    from fixtures import COLS, write_city
    from strata.operators.tagging import same_columns_by_source
    from strata.sources.records import header_rows

    good = os.path.join(tmp_dir, "good")
    bad = os.path.join(tmp_dir, "bad")
    os.makedirs(good)
    os.makedirs(bad)
    write_city(good, "A")
    write_city(good, "B", cols=list(reversed(COLS)))
    write_city(bad, "A", cols=COLS[:-1] + ["other"])
    heads = header_rows(spark, [good, bad]).withColumn(
        "src", F.regexp_extract("path", "/(good|bad)/", 1))
    got = {r.src: (r.n_files, r.same_columns) for r in same_columns_by_source(heads, COLS, "src").collect()}
    assert got == {"good": (2, True), "bad": (1, False)}


def test_distinct_sorted_and_top_n_order(spark):
    from strata.operators.inspect import distinct_sorted, distinct_values, top_n

    df = spark.createDataFrame([(t,) for t in ["二十層", "十三層", "二十層", None, "九層", "十五層"]], "t string")
    assert sorted(r.t for r in distinct_values(df, "t").collect() if r.t) == sorted({"二十層", "十三層", "九層", "十五層"})
    desc = [r.t for r in distinct_sorted(df, "t").collect()]
    assert desc == sorted({"二十層", "十三層", "九層", "十五層"}, reverse=True) + [None]  # code-point order, null last
    assert [r.t for r in top_n(df, "t", 2).collect()] == desc[:2]
    plan = top_n(df, "t", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_size_settings_parse(spark):
    from strata.operators.sizing import broadcast_threshold
    from strata.sources.records import _bytes

    assert _bytes("128m") == 128 << 20 and _bytes("128MB") == 128 << 20 and _bytes("4096") == 4096
    assert _bytes("1g") == 1 << 30 and _bytes("16k") == 16 << 10
    df = spark.range(1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for value, expected in (("10485760", 10485760), ("10MB", 10 << 20), ("-1", -1)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert broadcast_threshold(df) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_records_of_one_city_leave_the_others_out_before_the_part_join(spark):
    """Rows of other cities are dropped by their supplier, so only the city's reach the join with the parts."""
    from pyspark.sql import functions as F

    from strata.plans import standin

    sf = "/root/testdata/sf0.001"
    everything = standin.records(spark, sf)
    city = everything.agg(F.min("city")).first()[0]
    for of, same in ((F.col("r_name") == city, F.col("city") == city), (F.col("r_name") != city, F.col("city") != city)):
        some = standin.records(spark, sf, of=of)
        want = everything.where(same)
        assert some.count() == want.count() > 0
        assert some.exceptAll(want).isEmpty() and want.exceptAll(some).isEmpty()
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("l_partkey") < plan.index("LeftSemi") and plan.count("LeftSemi") >= 2
