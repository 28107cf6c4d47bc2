"""Incremental ingest of city files as they land in a folder.

The batch job waits for a download to appear and then reads it.  Here the
landing folder is watched by Structured Streaming: a ``binaryFile`` stream
(paths only, no content) yields the files not seen before, and a
``mapInArrow`` step parses each new file in an executor with Arrow's
streaming CSV reader - columns bound by name (any order, extra columns
ignored), BOM, quoted commas and line breaks, the city from the file path,
typed or positional alias-row drop.  The rows are then cleaned and filtered
like the batch job and appended to a Parquet events table by the file sink,
whose log and the checkpoint make every file count exactly once.  Nothing
passes through the driver per batch.

``availableNow`` processes whatever has landed and stops, so the same code
serves a scheduled run and a continuous one (``processing_time="1 minute"``).
The nested document is then built in batch from the events table
(:func:`document_from_events`), so late files only add rows to the table.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator, Mapping
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata import schema
from strata.operators.tagging import ColumnMismatch
from strata.plans.job import filter_records, nest_from_events, select_events
from strata.session import checkpoint_dir
from strata.sources.paths import open_path
from strata.sources.records import CSV_GLOB, FILE_COL, check_alias_mode, city_names, is_alias_date, list_files, name_key

Tagger = Callable[[str], "str | None"]


def tag_by_letter(letters: Mapping[str, str] | None = None) -> Tagger:
    """City from the file name ``<letter>_lvr_land_A.csv``, in any case (None for other names)."""
    names = city_names(letters)
    return lambda path: names.get(name_key(path))


def tag_by_folder(col: str = "city") -> Tagger:
    """City from a ``<col>=<value>`` folder in the file's path."""
    pattern = re.compile(rf"/{re.escape(col)}=([^/]+)/")

    def tag(path: str) -> str | None:
        m = pattern.search(path)
        return unquote(m.group(1)) if m else None

    return tag


def new_files(spark: SparkSession, landing_dir: str, *, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming frame of the CSV files landing under ``landing_dir`` (``path`` only, no content)."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length bigint, content binary")
            .option("pathGlobFilter", CSV_GLOB)
            .option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .load(landing_dir)
            .select("path"))


def _file_parser(columns: list[str], tagger: Tagger, alias_row: str, out_schema: pa.Schema,
                 batch_rows: int):
    """``mapInArrow`` body: each landed file path -> its record rows, tagged with the city."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import csv as pacsv

        read = pacsv.ReadOptions(use_threads=False, block_size=max(1 << 20, batch_rows * 256))
        parse = pacsv.ParseOptions(newlines_in_values=True)
        # the typed mode looks at the first row's date, whether or not it is wanted
        wanted = columns if alias_row != "typed" or schema.COL_DATE in columns else [*columns, schema.COL_DATE]
        convert = pacsv.ConvertOptions(
            include_columns=wanted, column_types={c: pa.string() for c in wanted},
            strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                city = tagger(path)
                if city is None:  # a foreign file must not stop the stream for good; foreign_files() lists them
                    print(f"strata: not a city file, left out: {path}", file=sys.stderr)
                    continue
                with open_path(path) as fh:
                    source = fh if isinstance(fh, pa.NativeFile) else pa.PythonFile(fh, mode="r")
                    try:
                        reader = pacsv.open_csv(source, read_options=read, parse_options=parse,
                                                convert_options=convert)
                    except (pa.ArrowInvalid, KeyError) as err:
                        if str(err).strip() == "Empty CSV file":  # no bytes (or only a BOM)
                            continue
                        raise ColumnMismatch(f"{path} lacks columns: {err}") from err
                    pending = alias_row != "none"  # the file's first data row is still to judge
                    for chunk in reader:
                        if pending and chunk.num_rows:
                            pending = False
                            if alias_row == "positional" or is_alias_date(chunk.column(wanted.index(schema.COL_DATE))[0].as_py()):
                                chunk = chunk.slice(1)
                        m = chunk.num_rows
                        if m:
                            yield pa.RecordBatch.from_arrays(
                                [chunk.column(c) for c in columns]
                                + [pa.array([city] * m, pa.string()), pa.array([path] * m, pa.string())],
                                schema=out_schema)

    return run


def arrivals(
    spark: SparkSession,
    landing_dir: str,
    *,
    columns: list[str],
    tagger: Tagger | None = None,
    alias_row: str = "positional",
    max_files_per_trigger: int = 1000,
    batch_rows: int = 10_000,
) -> DataFrame:
    """Streaming frame of text records (``columns``, ``city``, ``_file``) from newly landed files."""
    check_alias_mode(alias_row)
    tag = tag_by_letter() if tagger is None else tagger
    spark_schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                                + [T.StructField("city", T.StringType()),
                                   T.StructField(FILE_COL, T.StringType())])
    arrow_schema = pa.schema([(c, pa.string()) for c in columns] + [("city", pa.string()), (FILE_COL, pa.string())])
    return new_files(spark, landing_dir, max_files_per_trigger=max_files_per_trigger).mapInArrow(
        _file_parser(list(columns), tag, alias_row, arrow_schema, batch_rows), spark_schema)


def foreign_files(spark: SparkSession, landing_dir: str, tagger: Tagger | None = None) -> DataFrame:
    """``path`` of the landed CSV files without a city, which the stream leaves out."""
    tag = tag_by_letter() if tagger is None else tagger

    def without_city(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([tag(p) is None for p in batch.column(0).to_pylist()], pa.bool_()))

    return list_files(spark, [landing_dir], CSV_GLOB).select("path").mapInArrow(without_city, "path string")


def ingest_arrivals(
    spark: SparkSession,
    landing_dir: str,
    events_dir: str,
    *,
    checkpoint: str | None = None,
    n_fields: int = 28,
    floors_mode: str = "compat",
    use_value: str = schema.RESIDENTIAL,
    type_part: str = schema.TOWER,
    min_floors: int = schema.MIN_FLOORS,
    columns: list[str] | None = None,
    tagger: Tagger | None = None,
    alias_row: str = "positional",
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream: landed files -> clean -> filter -> events appended as Parquet.

    ``columns`` are the source columns every file must have (default: the
    ones the ``n_fields`` document needs); ``tagger`` maps a file path to its
    city (default: the letter in the file name); a file without a city is left
    out with a line in the executor's log, and :func:`foreign_files` lists them.  The checkpoint defaults to a
    folder under the session's shared ``spark.checkpoint.dir`` named after
    the (landing, events) pair, so a rerun for the same pair resumes and
    different pairs never share one.
    """
    required = schema.required_columns(n_fields) if columns is None else list(columns)
    records = arrivals(spark, landing_dir, columns=required, tagger=tagger, alias_row=alias_row,
                       max_files_per_trigger=max_files_per_trigger)
    kept = filter_records(records, floors_mode=floors_mode, use_value=use_value,
                          type_part=type_part, min_floors=min_floors)
    events = select_events(kept, n_fields)
    pair = hashlib.sha1(f"{landing_dir}|{events_dir}".encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/strata-arrivals-{pair}"
    writer = (events.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).option("path", events_dir))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def events_table(spark: SparkSession, events_dir: str) -> DataFrame:
    """The accumulated events."""
    return spark.read.parquet(events_dir)


def document_from_events(spark: SparkSession, events_dir: str, n_fields: int = 28,
                         **nest_args) -> DataFrame:
    """The nested document (``city, time_slots``) from the accumulated events table."""
    return nest_from_events(spark, events_dir, n_fields=n_fields, **nest_args)
