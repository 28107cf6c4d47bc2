"""Reading per-city record files (CSV) into one tagged DataFrame.

Design (nothing is inferred; only file names and distinct headers reach the driver):

1. **Header discovery** - one distributed pass over the file list
   (``binaryFile`` without its content column) reads only the header record
   of every file, to its end, in executors.
2. **Group by header** - files with the same header are read by one CSV scan
   with an all-string schema and ``enforceSchema=False`` (a file whose header
   changed since discovery fails loudly instead of being misread).  Usually
   there is one group; a column-order variant adds one scan, never one per
   file.
3. **Check columns by name** (``require``): a missing column raises
   :class:`~strata.operators.tagging.ColumnMismatch`; the groups are then
   unioned *by name*.
4. **Tag**: with few tags, one scan branch per tag with a literal tag (a
   filter on the tag prunes whole branches); with many, one scan and the tag
   from each row's file path by a join, broadcast while its measured size allows.
5. **Alias row**: the first data row of every file is an English alias row.
   ``positional`` (default) drops exactly that row; ``typed`` drops it only when
   its date is neither missing nor an integer, for files that may lack an alias
   row.  No mode drops any other row.  The header pass also takes each file's first
   data record, so the row is judged before the scan: a file whose first row need
   not go, or fails the caller's ``where`` anyway (an alias row is no record), is
   read by a plain scan that ``where`` is pushed into.  Only the other files pass
   through a narrow Arrow step, in which a split is read in order by one task.
6. **Missing-value tokens** (``NA``, ``None``, ...) become null when
   ``na_tokens`` is given; the job does it in its cleaning step instead, after
   the filters that must reach the scan.

CSV options: ``multiLine`` and ``escape='"'`` keep quoted commas, doubled
quotes and line breaks inside a field; ``multiLine`` makes every file one
split, which suits many small files - pass ``multiline=False`` for big,
clean files so they split.
"""

from __future__ import annotations

import csv
import io
import posixpath
import re
import warnings
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schema
from strata.operators.project import null_tokens
from strata.operators.sizing import broadcast_if_small
from strata.operators.tagging import ColumnMismatch
from strata.session import scratch_path
from strata.sources.paths import open_path

FILE_COL = "_file"
HEADER_READ_BYTES = 64 << 10  # read step; a header record is read to its end

CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "sep": ","}


# --- paths ------------------------------------------------------------------

def spark_path(path: str) -> str:
    """A path in the form Spark reports in ``_metadata.file_path``."""
    if path.startswith("file:///"):
        return "file:/" + path[len("file:///"):]
    if path.startswith("file:"):
        return path
    if "://" in path:
        return path
    return "file:" + posixpath.abspath(path)


def parse_header(first_bytes: bytes, *, strip: bool = True) -> list[str]:
    """Column names from the first CSV record of a file (BOM and quotes handled)."""
    text = first_bytes.decode("utf-8-sig", errors="replace")
    rows = csv.reader(io.StringIO(text))
    try:
        names = next(rows)
    except StopIteration:
        return []
    return [c.strip() for c in names] if strip else names


def _records(fh, n: int) -> list[bytes]:
    """The first ``n`` records of a file (fewer at its end), cut at line breaks outside quotes."""
    found, head, at, inside = [], b"", 0, False
    while len(found) < n:
        mark = _RECORD_MARK.search(head, at)
        if mark is None:
            at = len(head)
            if not (chunk := fh.read(HEADER_READ_BYTES)):
                return [*found, head] if head else found
            head += chunk
        elif mark[0] == b'"':
            inside, at = not inside, mark.end()
        elif inside:
            at = mark.end()
        else:
            line, head, at = head[:mark.start()], head[mark.end():], 0
            if line or not found:  # blank lines hold no record; a blank first line is an empty header
                found.append(line)
    return found


_RECORD_MARK = re.compile(rb'["\r\n]')


def _first_record(fh) -> bytes:
    """The bytes of a file up to the first line break outside quotes (all of it without one)."""
    return b"".join(_records(fh, 1))


def _peek_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        headers, firsts = [], []
        for p in pdf["path"]:
            with open_path(p) as fh:
                head, *first = _records(fh, 2) or [b""]
                headers.append("\x1f".join(parse_header(head, strip=False)))
                firsts.append(first[0].decode("utf-8", errors="replace") if first else None)
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "header": headers, "first": firsts})


CSV_GLOB = "*.[cC][sS][vV]"


def list_files(spark: SparkSession, paths: Iterable[str], glob: str | None = None) -> DataFrame:
    """Files under ``paths`` (files, folders or globs) as ``path, length`` rows; no content is read.

    ``glob`` keeps only matching file names (Spark's ``pathGlobFilter``).
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(list(paths)).select("path", "length")


def header_rows(spark: SparkSession, paths: Iterable[str], glob: str | None = CSV_GLOB) -> DataFrame:
    """``path, length, header, first`` for every CSV file under ``paths``; the header is its
    column names joined by U+001F, ``first`` the text of its first data record (null
    without one).  Lazy: nothing is collected."""
    return list_files(spark, paths, glob).mapInPandas(_peek_headers, "path string, length bigint, header string, first string")


def discover(spark: SparkSession, paths: Iterable[str],
             glob: str | None = CSV_GLOB) -> dict[str, list[tuple[str, int]]]:
    """``{header -> [(file, bytes)]}`` for every CSV file under ``paths`` (one distributed job).

    Headers are grouped in Spark, so each distinct header comes back once
    with its file list (the driver holds the file list anyway: Spark's file
    sources plan from it).
    """
    return _grouped(header_rows(spark, paths, glob))


def _grouped(heads: DataFrame) -> dict[str, list[tuple[str, int]]]:
    grouped = heads.groupBy("header").agg(F.sort_array(F.collect_list(F.struct("path", "length"))).alias("files"))
    return {row["header"]: [(f["path"], f["length"]) for f in row["files"]] for row in grouped.collect()}


def _written_heads(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """:func:`header_rows`, written once: files are opened in one pass."""
    out = scratch_path(spark, "heads")
    header_rows(spark, paths).write.parquet(out)
    return spark.read.schema("path string, length bigint, header string, first string").parquet(out)


def files_to_cut(spark: SparkSession, files: DataFrame, header: str, alias_row: str, where: Column | None) -> set[str]:
    """Paths of the ``files`` (:func:`header_rows`) whose first data row has to be taken out by the reader.

    These are the files whose first row the mode drops and ``where`` lets through.
    The record is parsed by Spark's own CSV parser with the scan's options.
    """
    if alias_row == "none":
        return set()
    names = header.split("\x1f")
    fields = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
    parsed = files.where((F.col("header") == F.lit(header)) & F.col("first").isNotNull()).select(
        "path", F.from_csv("first", F.lit(_ddl(fields)), {k: v for k, v in CSV_OPTIONS.items() if k != "header"}).alias("r"))
    rows = parsed.select("path", *[F.col(f"r._{i}").alias(n.strip()) for i, n in enumerate(names)])
    if alias_row == "typed":
        date = F.trim(F.coalesce(F.col(schema.COL_DATE), F.lit("")))
        rows = rows.where((date != "") & ~date.isin(list(schema.NA_TOKENS)) & ~date.rlike(r"^[+-]?\d+(\.0*)?$"))
    if where is not None:
        rows = rows.where(where)
    return {r["path"] for r in rows.select("path").collect()}  # some of the files that the driver plans from


def _ddl(fields: T.StructType) -> str:
    return ", ".join(f"{f.name} string" for f in fields)


def file_headers(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str]]:
    """``{header -> [files]}`` for every file under ``paths``."""
    return {h: [p for p, _ in files] for h, files in discover(spark, paths).items()}


def _warn_unsplittable(spark: SparkSession, files: list[tuple[str, int | None]]) -> None:
    split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    big = [(p, n) for p, n in files if n is not None and n > 4 * split]
    if big:
        warnings.warn(
            f"{len(big)} file(s) (largest {max(n for _, n in big)} bytes) are read with multiLine=True, "
            "one task per file; pass multiline=False for large files without line breaks in quoted fields",
            stacklevel=3)


def _bytes(text: str) -> int:
    t = str(text).strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    t = t[:-1] if t.endswith("b") else t
    return int(float(t[:-1]) * units[t[-1]]) if t and t[-1] in units else int(t)


# --- tagging ----------------------------------------------------------------

def _tag_for(path: str, keys: Mapping[str, str]) -> str | None:
    """Tag of the longest key equal to ``path`` or naming a folder that contains it."""
    cur = path.rstrip("/")
    while cur:
        if cur in keys:
            return keys[cur]
        if "/" not in cur:
            return None
        cur = cur.rsplit("/", 1)[0]
    return None


def tag_by_file(df: DataFrame, file_tags: Mapping[str, str], col: str = "city",
                file_col: str = FILE_COL) -> DataFrame:
    """Add ``col`` from ``file_tags`` (Spark file path -> tag)."""
    lookup = df.sparkSession.createDataFrame(list(file_tags.items()), f"{file_col}_ string, `{col}` string")
    lookup, _ = broadcast_if_small(lookup)
    return df.join(lookup, df[file_col] == lookup[f"{file_col}_"], "left").drop(f"{file_col}_")


# --- alias row ----------------------------------------------------------------

ALIAS_MODES = ("positional", "typed", "none")


def check_alias_mode(mode: str) -> None:
    if mode not in ALIAS_MODES:
        raise ValueError(f"alias row mode must be one of {', '.join(ALIAS_MODES)}, not {mode!r}")


def is_alias_date(value: str | None, missing: Iterable[str] = schema.NA_TOKENS) -> bool:
    """Whether a first row's date text shows an alias row: text that is neither missing nor an integer."""
    text = (value or "").strip()
    return bool(text) and text not in set(missing) and not re.fullmatch(r"[+-]?\d+(\.0*)?", text)


def _first_rows_dropper(file_col: str, date_col: str | None):
    """``mapInArrow`` body dropping the first row of every file's first split.

    A split is read in order inside one task, so the first row of a file is
    the first row of its offset-0 split that the task meets.  Vectorised:
    a row starts a split when its path or split offset differs from the
    previous row's (the last pair is carried across batches).  With
    ``date_col`` a first row whose date could be a record's is kept.
    """

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        last_file, last_block = None, None
        for batch in batches:
            n = len(batch)
            if n == 0:
                continue
            files, blocks = batch.column(file_col), batch.column("_block")
            prev_file = pa.concat_arrays([pa.array([last_file], files.type), files.slice(0, n - 1)])
            prev_block = pa.concat_arrays([pa.array([last_block], blocks.type), blocks.slice(0, n - 1)])
            starts = pc.or_(pc.fill_null(pc.not_equal(files, prev_file), True),
                            pc.fill_null(pc.not_equal(blocks, prev_block), True))
            first = pc.and_(starts, pc.equal(blocks, 0))
            if date_col is not None and pc.any(first).as_py():
                at = pc.indices_nonzero(first).to_pylist()
                drop = [is_alias_date(batch.column(date_col)[i].as_py()) for i in at]
                first = pa.array([False] * n) if not any(drop) else pc.is_in(
                    pa.array(range(n)), pa.array([i for i, d in zip(at, drop, strict=True) if d]))
            last_file, last_block = files[n - 1].as_py(), blocks[n - 1].as_py()
            yield batch.filter(pc.invert(first))

    return run


def drop_alias_row(df: DataFrame, mode: str = "positional", date_col: str = schema.COL_DATE,
                   file_col: str = FILE_COL) -> DataFrame:
    """Drop the English alias row that follows the header of each file.

    ``positional``: drop the first data row of each file, whatever it holds.
    ``typed``: drop that row only when its date is neither missing nor an
    integer.  Neither ever drops another row.  One narrow pass: ``df`` must
    come straight from a file scan with the ``_file`` and ``_block`` columns
    of :func:`read_records`, so rows are in file order.
    """
    check_alias_mode(mode)
    if mode == "none":
        return df
    return df.mapInArrow(_first_rows_dropper(file_col, date_col if mode == "typed" else None), df.schema)


# --- reading ------------------------------------------------------------------

def _scan(spark: SparkSession, files: list[str], columns: list[str], multiline: bool) -> DataFrame:
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
    reader = reader.option("enforceSchema", "false").schema(schema.text_schema(columns))
    df = reader.csv(files)
    return df.select("*", scan_file_path().alias(FILE_COL),
                     F.col("_metadata.file_block_start").alias("_block"))


def scan_file_path() -> Column:
    """The scanned file's path in listing form.

    ``_metadata.file_path`` is URI-encoded (a space reads ``%20``) while file
    listings give the plain path; decode it, keeping a literal ``+``.
    """
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), "\\+", "%2B"))


def read_records(
    spark: SparkSession,
    paths: Iterable[str],
    *,
    require: Iterable[str] | None = schema.SOURCE_COLUMNS,
    alias_row: str = "positional",
    na_tokens: Iterable[str] | None = None,
    multiline: bool = True,
    groups: Mapping[str, list] | None = None,
    where: Column | None = None,
    first_rows: DataFrame | None = None,
) -> DataFrame:
    """Read record CSV files (any header order) into text columns plus ``_file``.

    ``where``: a condition on the raw text columns that every wanted row meets; only such
    rows come back.  Spark pushes it into the scan of all files but those whose first
    row has to be dropped and meets it.

    ``require``: columns every file must have (they are the output columns);
    ``None`` keeps the columns of the files, which must then agree as a set.
    ``groups`` (``{header: files}`` or ``{header: [(file, bytes)]}``) skips
    discovery when already known.
    """
    check_alias_mode(alias_row)
    paths = list(paths)
    found = discover(spark, paths) if groups is None else groups

    def heads() -> DataFrame:
        if first_rows is not None:
            return first_rows
        return header_rows(spark, [f[0] if isinstance(f, tuple) else f for fs in found.values() for f in fs])

    sized = {h: [f if isinstance(f, tuple) else (f, None) for f in fs] for h, fs in found.items()}
    if multiline:
        _warn_unsplittable(spark, [f for fs in sized.values() for f in fs])
    groups = {h: [p for p, _ in fs] for h, fs in sized.items()}
    if "" in groups:  # files without even a header (0 bytes) hold no records
        warnings.warn(f"skipping {len(groups[''])} empty file(s), e.g. {groups[''][0]}", stacklevel=2)
        del groups[""]
        if not groups:
            raise FileNotFoundError(f"only empty files under {list(paths)}")
    if not groups:
        raise FileNotFoundError(f"no files under {list(paths)}")
    required = None if require is None else list(require)
    frames = []
    col_sets = []
    for header, files in groups.items():
        raw_cols = header.split("\x1f") if header else []
        cols = [c.strip() for c in raw_cols]  # names as written may carry stray spaces
        if required is not None:
            missing = [c for c in required if c not in cols]
            if missing:
                raise ColumnMismatch(f"{len(files)} file(s), e.g. {files[0]}, lack columns {missing}")
        col_sets.append(frozenset(cols))
        keep = required if required is not None else cols
        if where is None and alias_row == "positional":
            cut = set(files)  # each loses its first row
        else:
            cut = files_to_cut(spark, heads(), header, alias_row, where)
        for some, mode in (([f for f in files if f not in cut], "none"), ([f for f in files if f in cut], alias_row)):
            if not some:
                continue
            df = _scan(spark, some, raw_cols, multiline)
            df = df.select(*[F.col(f"`{r}`").alias(c) for r, c in zip(raw_cols, cols)], FILE_COL, "_block")
            if mode != "none":  # cut to the needed columns before rows pass through Python
                used = [c for c in cols if c in keep or c == schema.COL_DATE and mode == "typed" or where is not None]
                df = drop_alias_row(df.select(*[F.col(c) for c in used], FILE_COL, "_block"), mode)
            df = df if where is None else df.where(where)
            frames.append(df.select(*[F.col(c) for c in keep], FILE_COL))
    if required is None and len(set(col_sets)) > 1:
        raise ColumnMismatch(f"files disagree on columns: {[sorted(c) for c in set(col_sets)]}")
    out = reduce(lambda a, b: a.unionByName(b), frames)
    if na_tokens is not None:
        out = null_tokens(out, [c for c in out.columns if c != FILE_COL], na_tokens)
    return out


BRANCH_TAG_LIMIT = 64  # up to this many tags, one scan branch per tag


def read_tagged(
    spark: SparkSession,
    sources: Mapping[str, str],
    *,
    col: str = "city",
    branch_tag_limit: int = BRANCH_TAG_LIMIT,
    **read_args,
) -> DataFrame:
    """Read ``{path: tag}`` (files or folders) into one frame with a ``col`` tag.

    One header pass for all files.  With few tags (``branch_tag_limit``) each
    tag is its own scan branch with a literal tag: a filter on the tag then
    removes the other branches, so their files are never read, and the
    branches together still read every file once.  With many tags one scan
    per distinct header reads everything and the tag comes from each row's
    file path, which keeps the plan small.
    """
    keys = {spark_path(p).rstrip("/"): t for p, t in sources.items()}
    heads = _written_heads(spark, list(keys))
    groups = _grouped(heads)
    if "" in groups:  # files without even a header hold no records
        warnings.warn(f"skipping {len(groups[''])} empty file(s), e.g. {groups[''][0][0]}", stacklevel=2)
        del groups[""]
    if not groups:
        raise FileNotFoundError(f"no records under {list(keys)}")
    file_tags = {}
    for files in groups.values():
        for f, _ in files:
            t = _tag_for(f, keys)
            if t is None:
                raise ValueError(f"file {f} matches no source path")
            file_tags[f] = t
    tags = sorted(set(file_tags.values()))
    if len(tags) <= branch_tag_limit:
        branches = []
        for t in tags:
            sub = {h: [(f, n) for f, n in fs if file_tags[f] == t] for h, fs in groups.items()}
            sub = {h: fs for h, fs in sub.items() if fs}
            branches.append(read_records(spark, list(keys), groups=sub, first_rows=heads, **read_args)
                            .withColumn(col, F.lit(t)))
        return reduce(lambda a, b: a.unionByName(b), branches)
    df = read_records(spark, list(keys), groups=groups, first_rows=heads, **read_args)
    return tag_by_file(df, file_tags, col)


def city_sources(folder: str, letters: Mapping[str, str] | None = None) -> dict[str, str]:
    """``{folder/<letter>_lvr_land_A.csv: city}`` for the standard file names."""
    letters = schema.CITY_BY_LETTER if letters is None else letters
    base = folder.rstrip("/")
    return {f"{base}/{schema.CITY_FILE_PATTERN.format(letter=k)}": v for k, v in letters.items()}


def report_foreign(files: DataFrame) -> int:
    """Warn of CSV files (``path``) that are left out, with their number and one example; return the number."""
    rest = files.agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("example")).first()
    if rest["n"]:
        warnings.warn(f"{rest['n']} CSV file(s) outside the name list are not read, e.g. {rest['example']}", stacklevel=3)
    return int(rest["n"])


def name_key(path: str) -> str:
    """A file's name as folders, archives and streams compare it: without its folders and without case."""
    return path.rsplit("/", 1)[-1].lower()


def city_names(letters: Mapping[str, str] | None = None) -> dict[str, str]:
    """``{name key: city}`` of the standard file names."""
    letters = schema.CITY_BY_LETTER if letters is None else letters
    return {name_key(schema.CITY_FILE_PATTERN.format(letter=k)): v for k, v in letters.items()}


def city_files(spark: SparkSession, folder: str, letters: Mapping[str, str] | None = None) -> dict[str, str]:
    """``{file: city}`` for the city files actually present under ``folder``.

    Lists the folder (file metadata only) and keeps names of the form
    ``<letter>_lvr_land_A.csv`` (in any case) whose letter has a city; other CSV files
    are counted in a warning.
    """
    names = city_names(letters)
    files = list_files(spark, [folder], CSV_GLOB).select("path", F.lower(F.element_at(F.split("path", "/"), -1)).alias("name"))
    mine = F.col("name").isin(list(names))
    found = {r["path"]: names[r["name"]] for r in files.where(mine).collect()}  # one per city file
    report_foreign(files.where(~mine))
    if not found:
        raise FileNotFoundError(f"no city files ({', '.join(sorted(names))}) under {folder}")
    return found

