"""The batch job: tagged records -> clean -> filter -> nest -> split -> JSON lines.

``transform`` is the lazy plan from tagged text records to the nested
document; ``run`` adds reading the city files and writing the parts.  The
document plan is plain DataFrame code: hash aggregations (identical events,
then slot, then city) and no Python; the bounded paged form adds a range-partitioned
numbering step (see ``operators.rank``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.functions.dates import roc_to_date
from strata.functions.numerals import floors
from strata.operators.filters import high_rise
from strata.operators.inspect import top_n
from strata.operators.nest import nest_paged, nest_two_levels
from strata.operators.project import account_for, accounts, cast_columns, null_tokens, to_english
from strata.operators.split import balanced_split, hash_split, keyed_split
from strata.operators.tagging import reconcile_contents
from strata.session import scratch_path


PAGE_EVENTS = 10_000  # events of a document line, unless the caller says otherwise


def clean(df: DataFrame, *, floors_mode: str = "compat",
          na_tokens: list[str] | None = schema.NA_TOKENS) -> DataFrame:
    """Null the missing-value tokens, type the text columns, add ``Floors`` and ``date``."""
    text = df if na_tokens is None else null_tokens(
        df, [c for c in df.columns if c in schema.TYPE_BY_SOURCE], na_tokens)
    typed = cast_columns(text)
    return (typed.withColumn("Floors", floors(F.col(schema.COL_FLOORS_TEXT), floors_mode))
                 .withColumn("date", roc_to_date(F.col(schema.COL_DATE))))


def necessary(use_value: str = schema.RESIDENTIAL, type_part: str = schema.TOWER) -> Column:
    """What the raw columns of every kept record meet: cleaning only turns values into null."""
    return (F.col(schema.COL_USE) == F.lit(use_value)) & F.col(schema.COL_TYPE).contains(type_part)


def filter_records(
    records: DataFrame,
    *,
    floors_mode: str = "compat",
    use_value: str = schema.RESIDENTIAL,
    type_part: str = schema.TOWER,
    min_floors: int = schema.MIN_FLOORS,
) -> DataFrame:
    """Text records -> cleaned rows that pass the high-rise filter.

    The tests of :func:`necessary` run first, on the raw columns, where Catalyst pushes
    them into the scan (``EqualTo`` / ``StringContains``); the exact filter runs
    after cleaning.  A reader that is given them as ``where`` scans CSV files with
    them in the default alias-row mode too.
    """
    pre = records.filter(necessary(use_value, type_part))
    return high_rise(clean(pre, floors_mode=floors_mode),
                     use_value=use_value, type_part=type_part, min_floors=min_floors)


def select_events(df: DataFrame, n_fields: int = 2, key: str = "city") -> DataFrame:
    """``key, date`` and the event fields, renamed to their output names."""
    return to_english(df, schema.event_fields(n_fields), keep=(key, "date"))


def transform(
    records: DataFrame,
    *,
    n_fields: int = 2,
    key: str = "city",
    floors_mode: str = "compat",
    use_value: str = schema.RESIDENTIAL,
    type_part: str = schema.TOWER,
    min_floors: int = schema.MIN_FLOORS,
    combine_copies: bool = True,
    max_events_per_line: int | None = PAGE_EVENTS,
) -> DataFrame:
    """Tagged text records -> nested document, in pages (``key, page, time_slots``).

    Pages hold at most ``max_events_per_line`` events, so no row grows with a
    city; ``None`` gives the parity form, one row per city (``key, time_slots``).

    ``combine_copies`` (default) counts identical events map-side before the
    (city, date) shuffle, so a large group of copies never travels row by
    row; ``False`` saves that aggregation when copies are known to be rare.
    """
    kept = filter_records(records, floors_mode=floors_mode, use_value=use_value,
                          type_part=type_part, min_floors=min_floors)
    events = select_events(kept, n_fields, key)
    fields = schema.event_fields(n_fields)
    if max_events_per_line:
        return nest_paged(events, key, "date", fields, max_events=max_events_per_line)
    return nest_two_levels(events, key, "date", fields, combine_copies=combine_copies)


def write_events(
    records: DataFrame,
    events_dir: str,
    *,
    n_fields: int = 2,
    key: str = "city",
    floors_mode: str = "compat",
    use_value: str = schema.RESIDENTIAL,
    type_part: str = schema.TOWER,
    min_floors: int = schema.MIN_FLOORS,
    mode: str = "overwrite",
) -> str:
    """Clean and filter the records once and write the kept events as Parquet.

    The table (``key, date`` and the event fields, in folders per ``key``)
    is a written cut of the lineage: documents built from it re-read compact
    Parquet after a lost executor instead of parsing the CSV again.  Each
    task writes one file per city it holds, so no repartition is needed.
    The key stays a column inside the files (the folder column is a copy),
    so reading it back never depends on partition-value type inference.
    """
    kept = filter_records(records, floors_mode=floors_mode, use_value=use_value,
                          type_part=type_part, min_floors=min_floors)
    events = select_events(kept, n_fields, key).withColumn(f"{key}_dir", F.col(key))
    events.write.mode(mode).partitionBy(f"{key}_dir").parquet(events_dir)
    return events_dir


def nest_from_events(spark: SparkSession, events_dir: str, *, n_fields: int = 2, key: str = "city",
                     combine_copies: bool = True, max_events_per_line: int | None = PAGE_EVENTS) -> DataFrame:
    """The document (or its pages) from an events table written by :func:`write_events`."""
    events = spark.read.parquet(events_dir)
    events = events.drop(f"{key}_dir")  # the folder column, a copy of the key
    fields = schema.event_fields(n_fields)
    if max_events_per_line:
        return nest_paged(events, key, "date", fields, max_events=max_events_per_line)
    return nest_two_levels(events, key, "date", fields, combine_copies=combine_copies)


def split_parts(doc: DataFrame, how: str = "hash", n: int = 2, seed: int | None = 42,
                key: str = "city", col: str = "part") -> DataFrame:
    """Add a ``part`` column: ``hash`` (reproducible), ``balanced`` or ``random``."""
    if how == "hash":
        return hash_split(doc, key, n, 42 if seed is None else seed, col)
    if how == "balanced":
        return balanced_split(doc, key, n, 42 if seed is None else seed, col)
    if how == "random":
        return keyed_split(doc, key, [1.0 / n] * n, seed, col)
    raise ValueError(f"unknown split {how!r}")


def run(
    spark: SparkSession,
    sources: Mapping[str, str],
    out_dir: str,
    *,
    n_fields: int = 2,
    split: str = "hash",
    n_parts: int = 2,
    seed: int | None = 42,
    files_per_part: int | None = None,
    alias_row: str = "positional",
    multiline: bool = True,
    require: list[str] | None = None,
    part_paths: Mapping[int, str] | None = None,
    report: dict | None = None,
    **transform_args,
) -> dict[str, str]:
    """Read ``{path: city}`` files, build the document, write one JSON-lines folder per part.

    Returns ``{part: folder}``.  By default all parts are written by a single
    ``partitionBy`` write under ``out_dir``; with the default hash split that
    write is the only pass over the input (the balanced split first ranks the
    keys, which computes the document once more).  ``part_paths`` (``{part:
    path}``) writes each part to its own path instead.  ``multiline=False``
    lets Spark split large files that have no line breaks inside quotes.

    A ``report`` dictionary is filled with what became of the records: ``rows`` (those that
    pass the tests on raw values), ``fields`` (per column, missing-value tokens and failed
    casts among them, counted by the pass that reads them), ``cities`` (per city the events
    kept, the events in the written lines, and whether they are the same ones) and
    ``values`` (distinct values of the inspected fields, the first 100 of each).  The kept
    events are then written once to the shared checkpoint folder, and the document is
    made from that table.
    """
    from strata.sinks.json_lines import write_named_parts, write_parts
    from strata.sources.records import read_tagged

    cols = schema.required_columns(n_fields) if require is None else require
    wanted = necessary(**{k: v for k, v in transform_args.items() if k in ("use_value", "type_part")})
    records = read_tagged(spark, sources, alias_row=alias_row, multiline=multiline, require=cols, where=wanted).drop("_file")
    if report is None:
        doc = transform(records, n_fields=n_fields, **transform_args)
    else:
        nesting = {k: transform_args.pop(k) for k in ("combine_copies", "max_events_per_line") if k in transform_args}
        seen = Observation("records")
        events_dir = write_events(account_for(records, seen), scratch_path(spark, "events"), n_fields=n_fields, **transform_args)
        doc = nest_from_events(spark, events_dir, n_fields=n_fields, **nesting)
    parts = split_parts(doc, split, n_parts, seed)
    if part_paths:
        out = write_named_parts(parts, dict(part_paths), n_files=files_per_part)
    else:
        out = write_parts(parts, out_dir, part_col="part", files_per_part=files_per_part)
    if report is not None:
        events = spark.read.parquet(events_dir).drop("city_dir")
        report["rows"] = seen.get["rows"]
        report["fields"] = [r.asDict() for r in accounts(spark, seen).collect()]
        back = spark.read.schema(doc.schema).json(list(out.values())) if out else doc.limit(0)
        report["cities"] = [r.asDict() for r in reconcile_contents(events_of(back, "city"), events).orderBy("city").collect()]
        report["values"] = {c: [r[0] for r in top_n(events, c).collect()] for c in INSPECTED if c in events.columns}
    return out


#: Fields whose values are looked at after the filter.
INSPECTED = ("main_use", "type", "total_floor")


def events_of(doc: DataFrame, key: str = "city") -> DataFrame:
    """The events of a nested document as rows: ``key, date`` and the event fields."""
    slots = doc.select(key, F.explode("time_slots").alias("s"))
    return slots.select(key, F.col("s.date").alias("date"), F.explode("s.events").alias("e")).select(key, "date", "e.*")
