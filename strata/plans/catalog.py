"""Query catalog: one Spark query per operator group, each with a DuckDB oracle.

Every query reads the benchmark tables (through :mod:`strata.plans.standin`)
in full and runs the library's own operators on them.  Nested results are
returned as JSON text (``to_json``), the exact bytes a JSON-lines sink
writes, so they can be compared as scalars.  Column names are aliased the
same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.functions.dates import roc_to_date
from strata.functions.numerals import floor_text, floors, floors_pandas_udf, floors_udf
from strata.operators.inspect import distinct_values, top_n
from strata.operators.nest import document_json, nest_events, nest_paged
from strata.operators.project import account_for, accounts
from strata.operators.split import balanced_split, hash_split, keyed_split
from strata.operators.tagging import reconcile_contents, reconcile_counts, tagged_union
from strata.plans import standin
from strata.plans.job import clean, filter_records, select_events, split_parts, transform
from strata.session import scratch_path, settings
from strata.sinks.json_lines import write_named_parts, write_parts
from strata.sinks.published import publish_parts, read_published
from strata.sinks.records_csv import write_records_csv
from strata.sources.records import CSV_GLOB, list_files, read_tagged
from strata.sources.zip_members import read_zip_members, tag_by_member

Query = Callable[[SparkSession, str], DataFrame]

PAGE_EVENTS = 50  # page size of the paged-document query


# --- shared pieces ----------------------------------------------------------

def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in records, cleaned and filtered (use 'R', type contains 'ECON', >= 13 floors)."""
    return filter_records(standin.records(spark, sf_dir), use_value=standin.STANDIN_USE,
                          type_part=standin.STANDIN_TYPE_PART)


def _transform(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return transform(standin.records(spark, sf_dir), use_value=standin.STANDIN_USE,
                     type_part=standin.STANDIN_TYPE_PART, **kw)


# --- queries ----------------------------------------------------------------

def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> floors -> high-rise filter -> ROC date -> two-level nest -> JSON line per city.

    Identical events are counted map-side first and expanded only in the
    final arrays (the default), so a hot group of copies is never shuffled
    row by row.
    """
    return document_json(_transform(spark, sf_dir, max_events_per_line=None))


def q_flagship_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same document without the copy count: one shuffle per nesting level."""
    return document_json(_transform(spark, sf_dir, combine_copies=False, max_events_per_line=None))


def q_nest_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded form: pages of at most PAGE_EVENTS events per city, in document order."""
    return document_json(_transform(spark, sf_dir, max_events_per_line=PAGE_EVENTS), extra=("page",))


def q_events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept events written once as a Parquet table (a lineage cut), the document's pages nested from it."""
    from strata.plans.job import nest_from_events, write_events

    out = scratch_path(spark, "events-table")
    write_events(standin.records(spark, sf_dir), out, use_value=standin.STANDIN_USE,
                 type_part=standin.STANDIN_TYPE_PART)
    return document_json(nest_from_events(spark, out, max_events_per_line=PAGE_EVENTS), extra=("page",))


def q_nest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level 1 only: one row per (city, date) with its sorted events."""
    events = select_events(_kept(spark, sf_dir), 2)
    lvl1 = nest_events(events, ("city", "date"), schema.SHORT_EVENT_FIELDS)
    return lvl1.select("city", "date", F.to_json("events").alias("line"),
                       F.size("events").cast("bigint").alias("n_events"))


def q_nest_full_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28-field document in pages, flattened back to rows: nesting keeps every row and field."""
    events = select_events(_kept(spark, sf_dir), 28)
    doc = nest_paged(events, "city", "date", schema.FULL_EVENT_FIELDS, max_events=PAGE_EVENTS)
    slots = doc.select("city", F.explode("time_slots").alias("s"))
    ev = slots.select("city", F.col("s.date").alias("date"), F.explode("s.events").alias("e"))
    return ev.select("city", "date", "e.*")


def q_flagship_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 28-field document, one JSON line per city (null fields written out)."""
    doc = _transform(spark, sf_dir, n_fields=28, max_events_per_line=None)
    return doc.select("city", F.to_json("time_slots", {"ignoreNullFields": "false"}).alias("line"))


def q_floors_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floor text -> int with the native column expression."""
    return standin.floor_texts(spark, sf_dir).select("number", floors("總樓層數").alias("floors"))


def q_floors_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floor text -> int with the row-at-a-time Python UDF (parity surface)."""
    return standin.floor_texts(spark, sf_dir).select("number", floors_udf("總樓層數").alias("floors"))


def q_floors_pandas_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floor text -> int with the Arrow pandas UDF (parity surface)."""
    return standin.floor_texts(spark, sf_dir).select("number", floors_pandas_udf("總樓層數").alias("floors"))


def q_floors_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-digit floor texts: full mode reads 百, compat mode ignores it."""
    part = standin.table(spark, sf_dir, "part")
    txt = part.select("p_partkey", floor_text(F.col("p_size") * 19).alias("t"))
    return txt.select("p_partkey", floors("t", "full").alias("floors_full"),
                      floors("t", "compat").alias("floors_compat"))


def q_roc_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC yyyMMdd text -> date."""
    return standin.roc_texts(spark, sf_dir).select("number", roc_to_date("交易年月日").alias("date"))


def q_high_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composite filter on use, type and decoded floors."""
    return _kept(spark, sf_dir).select(F.col("編號").alias("number"), "city", "Floors")


def q_project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 28 record columns typed and renamed to their output names."""
    return select_events(clean(standin.records(spark, sf_dir)), 28).drop("date")


def q_distinct_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct use values of the high buildings whose type contains 'M'."""
    high = clean(standin.records(spark, sf_dir)).where(F.col(schema.COL_TYPE).contains("M") & (F.col("Floors") >= schema.MIN_FLOORS))
    return distinct_values(high, schema.COL_USE).withColumnRenamed(schema.COL_USE, "main_use")


def q_distinct_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct building types left after the filter (types that contain 'M')."""
    kept = filter_records(standin.records(spark, sf_dir), use_value=standin.STANDIN_USE, type_part="M")
    return distinct_values(kept, schema.COL_TYPE).withColumnRenamed(schema.COL_TYPE, "type")


def q_top_floor_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 10 distinct floor texts after the filter, descending (a top-N report)."""
    return top_n(_kept(spark, sf_dir), schema.COL_FLOORS_TEXT, 10).withColumnRenamed(
        schema.COL_FLOORS_TEXT, "total_floor")


def q_tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sources, each tagged with its name, unioned by column name."""
    return tagged_union(standin.segment_frames(spark, sf_dir), col="city")


def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union counts per tag and in total (one rollup pass) against the counts of the whole table.

    One source, the least by name, has lost its customers with a negative balance: its count and the total don't match.
    """
    frames = standin.segment_frames(spark, sf_dir)
    first = min(f for f in frames if f is not None)
    union = tagged_union(frames | {first: frames[first].where("c_acctbal >= 0")}, col="city")
    # expected from the table itself, not from the frames that made the union
    expected = standin.table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("city")).agg(
        F.count(F.lit(1)).alias("n_expected"))
    return reconcile_counts(union, "city", expected)


def q_reconcile_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union contents per tag against the whole table; the least source has lost its least customer and has its greatest twice."""
    frames = standin.segment_frames(spark, sf_dir)
    first = min(f for f in frames if f is not None)
    ends = frames[first].agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi")).first()
    own = frames[first]
    swapped = own.where(F.col("c_custkey") != ends["lo"]).unionByName(own.where(F.col("c_custkey") == ends["hi"]))
    expected = standin.table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "city")
    return reconcile_contents(tagged_union(frames | {first: swapped}, col="city"), expected)


def q_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cleaning nulls, per column, counted on the pass that writes the kept events (dirty dates, notes with tokens)."""
    seen = Observation("records")
    kept = filter_records(account_for(_dirty(spark, sf_dir), seen), use_value=standin.STANDIN_USE, type_part=standin.STANDIN_TYPE_PART)
    select_events(kept, 28).write.parquet(scratch_path(spark, "accounted"))
    return accounts(spark, seen)


def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reproducible md5 bucket per key."""
    cust = standin.table(spark, sf_dir, "customer").select("c_custkey")
    return hash_split(cust, "c_custkey", 2, 42, "part")


def q_balanced_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys cut into two near-equal parts in md5 order (ntile semantics)."""
    cust = standin.table(spark, sf_dir, "customer").select("c_custkey")
    return balanced_split(cust, "c_custkey", 2, 42, "part")


def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded Bernoulli split of the keys into three parts with weights."""
    cust = standin.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return keyed_split(cust, "c_custkey", RANDOM_WEIGHTS, seed=7)


RANDOM_WEIGHTS = (0.5, 0.3, 0.2)


def _regions(spark: SparkSession, sf_dir: str) -> list[str]:
    """The city tags of the stand-in: the region names (a five-row table)."""
    return sorted(r[0] for r in standin.table(spark, sf_dir, "region").select("r_name").collect())


def _all_columns(df: DataFrame) -> DataFrame:
    """The city and all 28 columns, cleaned, typed and renamed, as the round-trip queries compare them."""
    return select_events(clean(df), 28).drop("date")


def _city_folders(spark: SparkSession, out: str) -> dict[str, str]:
    """``{folder: city}`` of the ``city=<city>`` folders under ``out`` (one row per city)."""
    folder = F.regexp_extract("path", "^(.*/city=[^/]+)/", 1)
    rows = list_files(spark, [out], CSV_GLOB).select(folder.alias("folder")).distinct().collect()
    return {r["folder"]: unquote(r["folder"].rsplit("city=", 1)[1]) for r in rows}


def _write_cities(spark: SparkSession, sf_dir: str, records: DataFrame, out: str, **write_args) -> None:
    """The stand-in records as per-city files.  Neither the join with the parts nor the cities' folders
    sort the records: the smaller side's partitions are hashed where each is no larger than one of AQE's."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    with settings(spark, {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": size}):
        write_records_csv(records, out, tag_col="city", n_tags=standin.n_cities(spark, sf_dir), **write_args)


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as per-city BOM CSV files with alias rows, read back by folder, all 28 columns."""
    out = scratch_path(spark, "csv")
    _write_cities(spark, sf_dir, standin.records(spark, sf_dir), out)
    return _all_columns(read_tagged(spark, _city_folders(spark, out), col="city"))


def q_csv_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as per-city CSV files with the alias row at the head of each,
    read back dropping the first data row of every file (positional mode)."""
    out = scratch_path(spark, "csvpos")
    standin.write_city_files(standin.records(spark, sf_dir), out)
    return _all_columns(read_tagged(spark, _city_folders(spark, out), col="city", alias_row="positional"))


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in records with dates that are tokens, blank or junk for three orders of seven."""
    kind = F.pmod(F.col("總價元").cast("bigint"), F.lit(7))
    date = F.when(kind == 0, "NA").when(kind == 1, "").when(kind == 2, "108/04/16").otherwise(F.col(schema.COL_DATE))
    return standin.records(spark, sf_dir).withColumn(schema.COL_DATE, date)


def q_dirty_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose dates hold tokens, blanks and junk, written to files and read back in both alias modes."""
    out = scratch_path(spark, "dirty")
    _write_cities(spark, sf_dir, _dirty(spark, sf_dir), out)
    folders = _city_folders(spark, out)
    frames = [clean(read_tagged(spark, folders, col="city", alias_row=mode)).select(
        F.lit(mode).alias("mode"), "city", F.col("編號").alias("number"), "date") for mode in ("positional", "typed")]
    return frames[0].unionByName(frames[1])


def q_same_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every city, one city's without the note column: each city's headers checked against the 28 columns."""
    from strata.operators.tagging import same_columns_by_source
    from strata.sources.records import header_rows

    out = scratch_path(spark, "headers")
    odd = _regions(spark, sf_dir)[0]
    others, one = (standin.records(spark, sf_dir, of=of) for of in (F.col("r_name") != odd, F.col("r_name") == odd))
    _write_cities(spark, sf_dir, others, out)
    _write_cities(spark, sf_dir, one.drop("備註"), out, mode="append")
    heads = header_rows(spark, [out])
    # the writer names folders city=<escaped value>
    city = F.regexp_extract(F.col("path"), "/city=([^/]+)/", 1)
    heads = heads.withColumn("city", F.url_decode(F.regexp_replace(city, "\\+", "%2B")))
    return same_columns_by_source(heads, schema.SOURCE_COLUMNS).select("city", "same_columns")


def q_zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records zipped as per-city members (alias row first), ingested from the archives."""
    out = scratch_path(spark, "zip")
    archives = standin.write_city_archives(standin.records(spark, sf_dir), out)
    names = {f"{c}.csv": c for c in _regions(spark, sf_dir)}
    rows = read_zip_members(spark, archives, names=names, alias_row="positional")
    return _all_columns(tag_by_member(rows, names))


def q_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship documents split by city hash, written in one pass, read back as text lines."""
    out = scratch_path(spark, "json")
    parts = split_parts(_transform(spark, sf_dir, max_events_per_line=PAGE_EVENTS), "hash", 2, 42)
    write_parts(parts, out, part_col="part")
    back = spark.read.text(out)
    return back.select(F.col("part").cast("bigint").alias("part"), F.col("value").alias("line"))


def q_overwrite_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written twice to named paths, one file each, in overwrite mode: only the second result is there."""
    out = scratch_path(spark, "named")
    paths = {i: f"{out}/output{i + 1}.json" for i in range(2)}
    pages = _transform(spark, sf_dir, max_events_per_line=PAGE_EVENTS)
    for seed in (5, 42):
        write_named_parts(split_parts(pages, "hash", 2, seed), paths, n_files=1)
    lines = [spark.read.text(p).select(F.lit(i).cast("bigint").alias("part"), F.col("value").alias("line")) for i, p in paths.items()]
    files = list_files(spark, [out], "part-*").select(F.regexp_extract("path", "/output([0-9]+)[.]json/", 1).cast("bigint").alias("of"))
    files = files.groupBy((F.col("of") - 1).alias("of")).agg(F.count(F.lit(1)).alias("n_files"))
    both = lines[0].unionByName(lines[1])
    return both.join(files, both["part"] == files["of"]).select("part", "line", "n_files")


def q_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result published twice (one file a part): readers see the second one, whole."""
    out = scratch_path(spark, "published")
    pages = _transform(spark, sf_dir, max_events_per_line=PAGE_EVENTS)
    for seed in (5, 42):
        publish_parts(split_parts(pages, "hash", 2, seed), out, files_per_part=1)
    back = read_published(spark, out)
    files = back.groupBy(F.col("part").alias("of")).agg(F.count_distinct("file").alias("n_files"))
    return back.join(files, F.col("part") == F.col("of")).select(F.col("part").cast("bigint").alias("part"), F.col("value").alias("line"), "n_files")


def q_stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records land as per-city CSV files (alias row first); a file stream (availableNow)
    drops each file's alias row by position, cleans, filters and appends events."""
    from strata.streaming.arrivals import events_table, ingest_arrivals, tag_by_folder

    landing = scratch_path(spark, "landing")
    standin.write_city_files(standin.records(spark, sf_dir), landing)
    events_dir = scratch_path(spark, "events")
    q = ingest_arrivals(spark, landing, events_dir, checkpoint=scratch_path(spark, "stream-ckpt"),
                        n_fields=2, use_value=standin.STANDIN_USE,
                        type_part=standin.STANDIN_TYPE_PART, tagger=tag_by_folder("city"),
                        alias_row="positional")
    q.awaitTermination()
    return events_table(spark, events_dir).select("city", "date", "district", "type")


def queries() -> dict[str, Query]:
    return {
        "q_flagship": q_flagship,
        "q_flagship_direct": q_flagship_direct,
        "q_flagship_full": q_flagship_full,
        "q_nest_paged": q_nest_paged,
        "q_events_table": q_events_table,
        "q_nest_events": q_nest_events,
        "q_nest_full_unnest": q_nest_full_unnest,
        "q_floors_native": q_floors_native,
        "q_floors_udf": q_floors_udf,
        "q_floors_pandas_udf": q_floors_pandas_udf,
        "q_floors_full": q_floors_full,
        "q_roc_date": q_roc_date,
        "q_high_rise": q_high_rise,
        "q_project_rename": q_project_rename,
        "q_distinct_use": q_distinct_use,
        "q_distinct_type": q_distinct_type,
        "q_top_floor_texts": q_top_floor_texts,
        "q_tagged_union": q_tagged_union,
        "q_reconcile": q_reconcile,
        "q_reconcile_contents": q_reconcile_contents,
        "q_reject_counts": q_reject_counts,
        "q_hash_split": q_hash_split,
        "q_balanced_split": q_balanced_split,
        "q_random_split": q_random_split,
        "q_csv_round_trip": q_csv_round_trip,
        "q_csv_positional": q_csv_positional,
        "q_dirty_dates": q_dirty_dates,
        "q_same_columns": q_same_columns,
        "q_zip_members": q_zip_members,
        "q_json_round_trip": q_json_round_trip,
        "q_overwrite_named": q_overwrite_named,
        "q_published": q_published,
        "q_stream_arrivals": q_stream_arrivals,
    }


# --- oracle SQL (DuckDB) ----------------------------------------------------

# Record rows as the stand-in builds them, with the true values: floors is
# p_size, date is l_shipdate.
_REC = """
rec AS (
  SELECT r.r_name AS city, CAST(l.l_shipdate AS DATE) AS date, n.n_name AS district,
         p.p_type AS type, p.p_size AS floors, l.l_returnflag AS main_use,
         l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_linestatus, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_shipdate, p.p_name, p.p_brand, s.s_name
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
kept AS (
  SELECT * FROM rec WHERE main_use = 'R' AND strpos(type, 'ECON') > 0 AND floors >= 13
)"""

# p_size (1..99) written as floor text, the same words the stand-in writes.
_FLOOR_TEXT = (
    "((CASE WHEN p_size >= 20 THEN substr('一二三四五六七八九', p_size // 10, 1) || '十' "
    "WHEN p_size >= 10 THEN '十' ELSE '' END) || "
    "(CASE WHEN p_size % 10 > 0 THEN substr('一二三四五六七八九', p_size % 10, 1) ELSE '' END) || '層')"
)

# the stand-in's notes as they read after cleaning: the token NA is missing
_NOTE = ("(CASE l_linenumber % 5 WHEN 0 THEN p_name || ', \"' || main_use || '\"' "
         "WHEN 1 THEN s_name || chr(10) || p_name WHEN 4 THEN 'note ' || p_brand END)")

_NUMBER = "(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR))"

_ROC_INT = ("CAST((year(l_shipdate) - 1911) * 10000 + month(l_shipdate) * 100 "
            "+ day(l_shipdate) AS INTEGER)")

_MD5_ORDER = "CAST(('0x' || substr(md5('42|' || CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT)"

_EVENTS_2 = ("list({'district': district, 'type': type} "
             "ORDER BY district NULLS FIRST, type NULLS FIRST)")


def oracle_sql() -> dict[str, str]:
    flagship = f"""
WITH {_REC},
slots AS (SELECT city, date, {_EVENTS_2} AS events FROM kept GROUP BY city, date)
SELECT city, to_json(list({{'date': date, 'events': events}} ORDER BY date DESC NULLS LAST)) AS line
FROM slots GROUP BY city"""
    paged = f"""
WITH {_REC},
ranked AS (
  SELECT city, date, district, type,
         (row_number() OVER (PARTITION BY city ORDER BY date DESC NULLS LAST,
                             district NULLS FIRST, type NULLS FIRST) - 1) AS rn
  FROM kept),
pg AS (
  SELECT city, CAST(floor(rn / {PAGE_EVENTS}) AS BIGINT) AS page, date, {_EVENTS_2} AS events
  FROM ranked GROUP BY city, page, date)
SELECT city, page, to_json(list({{'date': date, 'events': events}} ORDER BY date DESC NULLS LAST)) AS line
FROM pg GROUP BY city, page"""
    floors_q = f"""
SELECT {_NUMBER} AS number, p.p_size AS floors
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""
    round_trip = f"""
WITH {_REC}
SELECT city,
  district, p_name AS transaction_sign, s_name AS number_plate, l_quantity AS square_meter,
  p_brand AS use_zoning, l_linestatus AS non_metropolis_district,
  CAST(NULL AS VARCHAR) AS non_metropolis_land_use, {_ROC_INT} AS transaction_date,
  CAST(l_linenumber AS VARCHAR) AS transaction_number, CAST(NULL AS VARCHAR) AS shifting,
  (SELECT {_FLOOR_TEXT} FROM (SELECT floors AS p_size)) AS total_floor, type, main_use,
  CAST(NULL AS VARCHAR) AS main_materials, CAST(NULL AS VARCHAR) AS complete_date,
  l_extendedprice AS total_area, CAST(l_linenumber AS INTEGER) AS room,
  CAST(NULL AS INTEGER) AS hall, CAST(NULL AS INTEGER) AS health,
  CAST(NULL AS VARCHAR) AS compartmented, CAST(NULL AS VARCHAR) AS organization,
  CAST(l_orderkey AS BIGINT) AS price, l_discount AS unit_price, CAST(NULL AS VARCHAR) AS berth,
  l_tax AS berth_area, CAST(NULL AS BIGINT) AS berth_price, {_NOTE} AS note,
  {_NUMBER} AS number
FROM rec"""
    full_event = f"""{{'district': district, 'transaction_sign': p_name, 'number_plate': s_name,
  'square_meter': l_quantity, 'use_zoning': p_brand, 'non_metropolis_district': l_linestatus,
  'non_metropolis_land_use': CAST(NULL AS VARCHAR), 'transaction_date': {_ROC_INT},
  'transaction_number': CAST(l_linenumber AS VARCHAR), 'shifting': CAST(NULL AS VARCHAR),
  'total_floor': (SELECT {_FLOOR_TEXT} FROM (SELECT floors AS p_size)), 'type': type,
  'main_use': main_use, 'main_materials': CAST(NULL AS VARCHAR), 'complete_date': CAST(NULL AS VARCHAR),
  'total_area': l_extendedprice, 'room': CAST(l_linenumber AS INTEGER), 'hall': CAST(NULL AS INTEGER),
  'health': CAST(NULL AS INTEGER), 'compartmented': CAST(NULL AS VARCHAR),
  'organization': CAST(NULL AS VARCHAR), 'price': CAST(l_orderkey AS BIGINT), 'unit_price': l_discount,
  'berth': CAST(NULL AS VARCHAR), 'berth_area': l_tax, 'berth_price': CAST(NULL AS BIGINT),
  'note': {_NOTE}, 'number': {_NUMBER}}}"""
    flagship_full = f"""
WITH {_REC},
ev AS (SELECT city, date, {full_event} AS e FROM kept),
slots AS (SELECT city, date, list(e ORDER BY e NULLS FIRST) AS events FROM ev GROUP BY city, date)
SELECT city, to_json(list({{'date': date, 'events': events}} ORDER BY date DESC NULLS LAST)) AS line
FROM slots GROUP BY city"""
    json_lines = f"""
SELECT CAST(('0x' || substr(md5('42|' || city), 1, 8)) AS BIGINT) % 2 AS part,
       '{{"city":"' || city || '","page":' || page || ',"time_slots":' || line || '}}' AS line
FROM ({paged})"""
    return {
        "q_flagship": flagship,
        "q_flagship_full": flagship_full,
        "q_flagship_direct": flagship,
        "q_events_table": paged,
        "q_nest_paged": paged,
        "q_nest_events": f"""
WITH {_REC}
SELECT city, date, to_json({_EVENTS_2}) AS line, CAST(count(*) AS BIGINT) AS n_events
FROM kept GROUP BY city, date""",
        "q_nest_full_unnest": f"""
WITH {_REC}
SELECT city, date,
  district, p_name AS transaction_sign, s_name AS number_plate, l_quantity AS square_meter,
  p_brand AS use_zoning, l_linestatus AS non_metropolis_district,
  CAST(NULL AS VARCHAR) AS non_metropolis_land_use, {_ROC_INT} AS transaction_date,
  CAST(l_linenumber AS VARCHAR) AS transaction_number, CAST(NULL AS VARCHAR) AS shifting,
  (SELECT {_FLOOR_TEXT} FROM (SELECT floors AS p_size)) AS total_floor, type, main_use,
  CAST(NULL AS VARCHAR) AS main_materials, CAST(NULL AS VARCHAR) AS complete_date,
  l_extendedprice AS total_area, CAST(l_linenumber AS INTEGER) AS room,
  CAST(NULL AS INTEGER) AS hall, CAST(NULL AS INTEGER) AS health,
  CAST(NULL AS VARCHAR) AS compartmented, CAST(NULL AS VARCHAR) AS organization,
  CAST(l_orderkey AS BIGINT) AS price, l_discount AS unit_price, CAST(NULL AS VARCHAR) AS berth,
  l_tax AS berth_area, CAST(NULL AS BIGINT) AS berth_price, {_NOTE} AS note,
  {_NUMBER} AS number
FROM kept""",
        "q_floors_native": floors_q,
        "q_floors_udf": floors_q,
        "q_floors_pandas_udf": floors_q,
        "q_floors_full": """
SELECT p_partkey, p_size * 19 AS floors_full, (p_size * 19) % 100 AS floors_compat FROM part""",
        "q_roc_date": f"SELECT {_NUMBER} AS number, CAST(l_shipdate AS DATE) AS date FROM lineitem",
        "q_high_rise": f"WITH {_REC} SELECT {_NUMBER} AS number, city, floors AS Floors FROM kept",
        "q_project_rename": round_trip,
        "q_distinct_use": f"WITH {_REC} SELECT DISTINCT main_use FROM rec WHERE strpos(type, 'M') > 0 AND floors >= 13",
        "q_distinct_type": f"WITH {_REC} SELECT DISTINCT type FROM rec WHERE main_use = 'R' AND strpos(type, 'M') > 0 AND floors >= 13",
        "q_top_floor_texts": f"""
WITH {_REC}
SELECT total_floor FROM (SELECT DISTINCT (SELECT {_FLOOR_TEXT} FROM (SELECT floors AS p_size)) AS total_floor FROM kept)
ORDER BY total_floor DESC LIMIT 10""",
        "q_tagged_union": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS city FROM customer""",
        "q_reconcile": """
WITH t AS (SELECT c_mktsegment, count(*) AS n_expected, count(*) FILTER (
             c_acctbal >= 0 OR c_mktsegment IS DISTINCT FROM (SELECT min(c_mktsegment) FROM customer)) AS n_rows
           FROM customer GROUP BY ROLLUP (c_mktsegment))
SELECT c_mktsegment AS city, n_rows, n_expected, n_rows = n_expected AS ok FROM t""",
        "q_reconcile_contents": """
SELECT c_mktsegment AS city, count(*) AS n_rows, count(*) AS n_expected,
       c_mktsegment IS DISTINCT FROM (SELECT min(c_mktsegment) FROM customer) OR count(*) = 1 AS ok
FROM customer GROUP BY c_mktsegment""",
        "q_reject_counts": f"""
WITH {_REC},
n AS (SELECT count(*) FILTER (l_orderkey % 7 < 2) AS tokens, count(*) FILTER (l_orderkey % 7 = 2) AS junk,
             count(*) FILTER (l_linenumber % 5 = 2) AS notes FROM rec)
SELECT field, CASE field WHEN 'transaction_date' THEN tokens WHEN 'note' THEN notes ELSE 0 END AS n_missing,
       CASE field WHEN 'transaction_date' THEN junk ELSE 0 END AS n_failed
FROM n, (SELECT unnest([{", ".join(f"'{x}'" for x in schema.FULL_EVENT_FIELDS)}]) AS field)""",
        "q_hash_split": f"SELECT c_custkey, {_MD5_ORDER} % 2 AS part FROM customer",
        "q_balanced_split": f"""
SELECT c_custkey, CAST(ntile(2) OVER (ORDER BY {_MD5_ORDER}, c_custkey) - 1 AS BIGINT) AS part
FROM (SELECT DISTINCT c_custkey FROM customer)""",
        "q_random_split": f"""
SELECT c_custkey, c_name, CASE WHEN h < {round(2**32 * 0.5)} THEN 0 WHEN h < {round(2**32 * 0.8)} THEN 1 ELSE 2 END::BIGINT AS part
FROM (SELECT *, {_MD5_ORDER.replace("42|", "7|")} AS h FROM customer)""",
        "q_csv_round_trip": round_trip,
        "q_stream_arrivals": f"WITH {_REC} SELECT city, date, district, type FROM kept",
        "q_zip_members": round_trip,
        "q_csv_positional": round_trip,
        "q_dirty_dates": f"""
WITH {_REC}
SELECT mode, city, {_NUMBER} AS number, CASE WHEN l_orderkey % 7 > 2 THEN date END AS date
FROM rec CROSS JOIN (VALUES ('positional'), ('typed')) AS m(mode)""",
        "q_same_columns": f"""
WITH {_REC}
SELECT DISTINCT city, city <> (SELECT min(r_name) FROM region) AS same_columns FROM rec""",
        "q_overwrite_named": f"SELECT *, 1::BIGINT AS n_files FROM ({json_lines})",
        "q_published": f"SELECT *, 1::BIGINT AS n_files FROM ({json_lines})",
        "q_json_round_trip": json_lines,
    }
