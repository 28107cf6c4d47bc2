import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.nest import nest_paged, nest_two_levels
from strata.operators.rank import row_number_by_range
from strata.operators.split import balanced_split, hash_split, random_split


def skewed_events(spark, n=3000):
    # one city holds most rows, and a third of all rows are identical copies
    df = spark.range(n).select(
        F.when(F.col("id") % 5 == 0, F.lit("b")).otherwise(F.lit("a")).alias("city"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.date_add(F.lit(dt.date(2019, 1, 1)), (F.col("id") % 11).cast("int"))).alias("date"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("d"), (F.col("id") % 13).cast("string"))).alias("district"),
        F.when(F.col("id") % 3 == 0, F.lit("t")).otherwise((F.col("id") % 4).cast("string")).alias("type"))
    return df


def test_slots_sorted_desc_null_last(spark):
    doc = nest_two_levels(skewed_events(spark)).collect()
    for row in doc:
        dates = [s["date"] for s in row.time_slots]
        assert dates[-1] is None
        real = dates[:-1]
        assert real == sorted(real, reverse=True)
        for s in row.time_slots:
            evs = [tuple(e) for e in s["events"]]
            assert evs == sorted(evs, key=lambda t: tuple("" if v is None else v for v in t))


def test_paged_concatenation_is_the_document(spark):
    ev = skewed_events(spark)
    full = {r.city: r.time_slots for r in nest_two_levels(ev).collect()}
    pages = nest_paged(ev, max_events=97, num_partitions=7).collect()
    by_city = {}
    for r in sorted(pages, key=lambda r: (r.city, r.page)):
        assert sum(len(s["events"]) for s in r.time_slots) <= 97
        by_city.setdefault(r.city, []).extend(r.time_slots)
    for city, slots in by_city.items():
        merged = []
        for s in slots:  # a slot cut by a page boundary continues on the next page
            if merged and merged[-1][0] == s["date"]:
                merged[-1][1].extend(s["events"])
            else:
                merged.append((s["date"], list(s["events"])))
        assert [(d, [tuple(e) for e in evs]) for d, evs in merged] == \
               [(s["date"], [tuple(e) for e in s["events"]]) for s in full[city]]


def test_row_number_matches_window(spark):
    ev = skewed_events(spark).withColumn("v", F.xxhash64("district", "type", "date"))
    ours = row_number_by_range(ev, [F.col("v").asc(), F.col("date").asc_nulls_first()], ["city"],
                               num_partitions=6)
    w = Window.partitionBy("city").orderBy(F.col("v").asc(), F.col("date").asc_nulls_first())
    ref = ev.withColumn("rn", (F.row_number().over(w) - 1).cast("bigint"))
    key = ["city", "v", "date", "rn"]
    a = sorted(tuple(r) for r in ours.select(*key).collect())
    b = sorted(tuple(r) for r in ref.select(*key).collect())
    assert a == b


def test_hash_split_is_reproducible(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r.k: r.part for r in hash_split(df, "k", 3).collect()}
    b = {r.k: r.part for r in hash_split(df, "k", 3).collect()}
    assert a == b and set(a.values()) == {0, 1, 2}


def test_balanced_split_sizes(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    sizes = sorted(r["count"] for r in balanced_split(df, "k", 4).groupBy("part").count().collect())
    assert sum(sizes) == 1001 and sizes[-1] - sizes[0] <= 1


def test_random_split_disjoint_cover(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = random_split(df, (0.5, 0.5), seed=3)
    ka = {r.k for r in a.collect()}
    kb = {r.k for r in b.collect()}
    assert not (ka & kb) and len(ka | kb) == 2000


def test_weighted_cumulative_matches_window(spark):
    from strata.operators.rank import cumulative_by_range

    df = spark.range(2000).select(
        F.when(F.col("id") < 1400, F.lit("hot")).otherwise((F.col("id") % 9).cast("string")).alias("k"),
        F.col("id").alias("o"), ((F.col("id") * 7) % 5 + 1).alias("w"))
    ours = cumulative_by_range(df, [F.col("o").asc()], ["k"], weight="w", out_col="c", num_partitions=5)
    win = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("c", F.coalesce(F.sum("w").over(win), F.lit(0)).cast("bigint"))
    assert sorted(tuple(r) for r in ours.select("k", "o", "c").collect()) == \
        sorted(tuple(r) for r in ref.select("k", "o", "c").collect())


def test_combined_copies_same_document(spark):
    ev = skewed_events(spark)
    a = nest_two_levels(ev).select("city", F.to_json("time_slots").alias("j")).collect()
    b = nest_two_levels(ev, combine_copies=True).select("city", F.to_json("time_slots").alias("j")).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_measure_and_broadcast_gate(spark):
    from strata.operators.sizing import broadcast_if_small, measure

    df = spark.createDataFrame([("abc", 1), ("de", 2)], "s string, i int")
    rows, size = measure(df)
    assert rows == 2 and size == 2 * 16 + 5 + 2 * 4
    assert broadcast_if_small(df, 1000)[1] is True
    assert broadcast_if_small(df, 10)[1] is False


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_event = st.tuples(
    st.sampled_from(["a", "a", "a", "b", "c"]),                  # a hot city
    st.one_of(st.none(), st.integers(0, 6)),                      # null dates included
    st.sampled_from(["x", "y", "z"]),                             # few districts: many copies
    st.sampled_from(["t1", "t2"]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_event, min_size=1, max_size=120), st.integers(1, 17), st.integers(1, 5))
def test_paged_property(spark, events, page, parts):
    rows = [(c, None if d is None else dt.date(2019, 1, 1) + dt.timedelta(days=d), di, ty)
            for c, d, di, ty in events]
    ev = spark.createDataFrame(rows, "city string, date date, district string, type string")
    full = {r.city: [(s["date"], [tuple(e) for e in s["events"]]) for s in r.time_slots]
            for r in nest_two_levels(ev).collect()}
    got: dict[str, list] = {}
    for r in sorted(nest_paged(ev, max_events=page, num_partitions=parts).collect(),
                    key=lambda r: (r.city, r.page)):
        assert 0 < sum(len(s["events"]) for s in r.time_slots) <= page
        merged = got.setdefault(r.city, [])
        for s in r.time_slots:
            evs = [tuple(e) for e in s["events"]]
            if merged and merged[-1][0] == s["date"]:
                merged[-1][1].extend(evs)
            else:
                merged.append((s["date"], evs))
    assert got == full


def test_row_number_with_null_keys(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise((F.col("id") % 3).cast("string")).alias("k"),
        F.col("id").alias("o"))
    ours = row_number_by_range(df, [F.col("o").asc()], ["k"], num_partitions=4)
    ref = df.withColumn("rn", (F.row_number().over(Window.partitionBy("k").orderBy("o")) - 1).cast("bigint"))
    assert sorted(tuple(r) for r in ours.select("k", "o", "rn").fillna("∅").collect()) == \
        sorted(tuple(r) for r in ref.select("k", "o", "rn").fillna("∅").collect())
