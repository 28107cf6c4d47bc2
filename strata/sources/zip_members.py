"""Zip archives of record CSV files.

Spark has no zip codec.  Archives are read in two distributed steps, and
neither the driver nor any one task ever holds a whole archive:

1. **List members** - the archive files are listed (metadata only) and each
   executor reads just the central directory of its archives (random access
   at the end of the file), giving one row per matching CSV member.
2. **Parse members** - the member rows are dealt to tasks by size; each task
   seeks to its member and stream-parses it with Arrow's CSV reader (quoted
   commas, doubled quotes, line breaks in fields, BOM), batch by batch.

So archives of any size parallelise by member.  One member is read by one
task (a compressed stream does not split).
"""

from __future__ import annotations

import fnmatch
import warnings
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schema
from strata.operators.project import null_tokens
from strata.operators.rank import row_number_by_range
from strata.operators.tagging import ColumnMismatch
from strata.session import default_parallelism
from strata.sources.paths import open_path
from strata.sources.records import check_alias_mode, is_alias_date, list_files, name_key

ARCHIVE_COL = "_archive"
MEMBER_COL = "_member"
ROW_COL = "_row"


def _member_lister(pattern: str, names: frozenset[str] | None):
    """``mapInPandas`` body: ``(archive, member, bytes, wanted)`` of matching members, from the central directory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zipfile

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                with open_path(path, seek=True) as fh, zipfile.ZipFile(fh) as zf:
                    for info in zf.infolist():
                        name = info.filename
                        base = name.rsplit("/", 1)[-1]
                        if not info.is_dir() and fnmatch.fnmatchcase(base.lower(), pattern.lower()):
                            rows.append((path, name, info.file_size, names is None or name_key(name) in names))
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "wanted"])

    return run


def _member_parser(columns: list[str], alias_row: str, out_schema: pa.Schema, batch_rows: int):
    """``mapInArrow`` body: stream-parse each member row into record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        from pyarrow import csv as pacsv

        read = pacsv.ReadOptions(use_threads=False, block_size=max(1 << 20, batch_rows * 256))
        parse = pacsv.ParseOptions(newlines_in_values=True)
        # the typed mode looks at the first row's date, whether or not it is wanted
        wanted = columns if alias_row != "typed" or schema.COL_DATE in columns else [*columns, schema.COL_DATE]
        date_at = wanted.index(schema.COL_DATE) if schema.COL_DATE in wanted else -1
        convert = pacsv.ConvertOptions(
            include_columns=wanted, column_types={c: pa.string() for c in wanted},
            strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=True)
        for batch in batches:
            for archive, member in zip(batch.column("archive").to_pylist(), batch.column("member").to_pylist()):
                with open_path(archive, seek=True) as fh, zipfile.ZipFile(fh) as zf, zf.open(member) as raw:
                    try:
                        reader = pacsv.open_csv(pa.PythonFile(raw, mode="r"), read_options=read,
                                                parse_options=parse, convert_options=convert)
                    except (pa.ArrowInvalid, KeyError) as err:
                        if str(err).strip() == "Empty CSV file":  # no bytes (or only a BOM)
                            continue
                        raise ColumnMismatch(f"{archive}!{member}: {err}") from err
                    row = 0
                    for chunk in reader:
                        n = chunk.num_rows
                        start = int(row == 0 and n > 0 and alias_row != "none" and (
                            alias_row == "positional" or is_alias_date(chunk.column(date_at)[0].as_py())))
                        chunk = chunk.slice(start)
                        m = chunk.num_rows
                        if m:
                            extra = [pa.array([archive] * m, pa.string()), pa.array([member] * m, pa.string()),
                                     pa.array(range(row + start, row + start + m), pa.int64())]
                            yield pa.RecordBatch.from_arrays(
                                [chunk.column(c) for c in columns] + extra, schema=out_schema)
                        row += n

    return run


def zip_member_list(spark: SparkSession, archives: Iterable[str] | str, member_pattern: str = "*.csv",
                    names: Iterable[str] | None = None) -> DataFrame:
    """``archive, member, size, wanted``: the matching members of every archive (central directories only).

    ``wanted`` says whether a member's file name is in ``names`` (all are, without names).
    """
    paths = [archives] if isinstance(archives, str) else list(archives)
    return list_files(spark, paths).select("path").mapInPandas(
        _member_lister(member_pattern, None if names is None else frozenset(map(name_key, names))),
        "archive string, member string, size bigint, wanted boolean")


def report_unwanted(members: DataFrame) -> int:
    """Warn of members that are left out, with their number and one example; return the number."""
    row = members.where("NOT wanted").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("example")).first()
    if row["n"]:
        warnings.warn(f"{row['n']} archive member(s) outside the name list are not read, e.g. {row['example']}", stacklevel=3)
    return int(row["n"])


def dealt_by_size(members: DataFrame, n_tasks: int) -> DataFrame:
    """The members in ``n_tasks`` partitions of about equal bytes.

    Members are numbered from the largest to the smallest and dealt to the tasks to and
    fro, so a task's bytes exceed another's by at most the largest member's.
    """
    order = [F.col("size").desc(), F.col("archive").asc(), F.col("member").asc()]
    turn = F.pmod(F.col("_turn"), F.lit(2 * n_tasks))
    task = F.when(turn < n_tasks, turn).otherwise(2 * n_tasks - 1 - turn).cast("int")
    return row_number_by_range(members, order, out_col="_turn").repartitionById(n_tasks, task).drop("_turn")


def read_zip_members(
    spark: SparkSession,
    archives: Iterable[str] | str,
    *,
    member_pattern: str = "*.csv",
    names: Iterable[str] | None = None,
    columns: list[str] | None = None,
    alias_row: str = "positional",
    na_tokens: Iterable[str] | None = None,
    batch_rows: int = 10_000,
) -> DataFrame:
    """Record rows from every CSV member matching ``member_pattern`` in ``archives``.

    With ``names`` only members of these file names are parsed; others are
    counted in a warning.  Returns the ``columns`` (text) plus ``_archive``,
    ``_member`` and ``_row`` (the data row's index in its member, the alias row
    being 0).  ``alias_row``: ``positional`` drops each member's first data row;
    ``typed`` drops it only when its date shows an alias row; ``none`` keeps all.
    """
    check_alias_mode(alias_row)
    cols = list(schema.SOURCE_COLUMNS if columns is None else columns)
    members = zip_member_list(spark, archives, member_pattern, names)
    if names is not None:
        report_unwanted(members)
    members = dealt_by_size(members.where("wanted"), max(1, 2 * default_parallelism(spark)))
    spark_schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in cols]
        + [T.StructField(ARCHIVE_COL, T.StringType()), T.StructField(MEMBER_COL, T.StringType()),
           T.StructField(ROW_COL, T.LongType())])
    arrow_schema = pa.schema([(c, pa.string()) for c in cols]
                             + [(ARCHIVE_COL, pa.string()), (MEMBER_COL, pa.string()), (ROW_COL, pa.int64())])
    rows = members.mapInArrow(_member_parser(cols, alias_row, arrow_schema, batch_rows), spark_schema)
    return rows if na_tokens is None else null_tokens(rows, cols, na_tokens)


def tag_by_member(df: DataFrame, tags: dict[str, str], col: str = "city") -> DataFrame:
    """Tag rows by member file name (``{file name: tag}``), e.g. the city letter files.

    Rows of members without a tag are not kept; read with ``names`` so that such members are reported and not parsed.
    """
    kv = []
    for name, t in tags.items():
        kv += [F.lit(name_key(name)), F.lit(t)]
    base = F.lower(F.element_at(F.split(F.col(MEMBER_COL), "/"), -1))
    return df.withColumn(col, F.try_element_at(F.create_map(*kv), base)).where(F.col(col).isNotNull())
