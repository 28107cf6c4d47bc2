"""Stand-in record inputs built from the benchmark tables.

No transaction files ship with the tests, so the catalog queries read the
driver's tables and shape them into rows of the record schema: text columns
named as in the city files, as a header-only CSV read yields them.  This
module only maps columns; all cleaning, filtering and nesting happens in the
library operators that the queries then call.

Mapping (one record per ``lineitem`` row)::

    city                 <- region name of the supplier's nation
    鄉鎮市區 district     <- nation name of the supplier
    交易年月日 date       <- l_shipdate written as ROC yyyMMdd
    總樓層數 floors text  <- p_size written as Chinese-numeral floor text
    建物型態 type         <- p_type
    主要用途 use          <- l_returnflag
    ... other columns from lineitem / part / supplier, some left empty

Joins are left to Catalyst: the dimension tables are broadcast only when
their scan size is under ``spark.sql.autoBroadcastJoinThreshold``, and
sort-merge joined beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import date_to_roc
from strata.functions.numerals import floor_text
from strata.sources.paths import filesystem_of, local_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem``."""
    return table(spark, sf_dir, "lineitem")


def _txt(c) -> F.Column:
    return c.cast("string")


def _note() -> F.Column:
    """Notes with commas, quotes and line breaks, missing-value tokens and nulls, by the line number."""
    kind = F.pmod(F.col("l_linenumber"), F.lit(5))
    return (F.when(kind == 0, F.concat("p_name", F.lit(', "'), "l_returnflag", F.lit('"')))
            .when(kind == 1, F.concat("s_name", F.lit("\n"), "p_name"))
            .when(kind == 2, F.lit("NA")).when(kind == 4, F.concat(F.lit("note "), "p_brand")))


def n_cities(spark: SparkSession, sf_dir: str) -> int:
    """How many city tags the records can have (a null one counts)."""
    return table(spark, sf_dir, "region").select("r_name").distinct().count()


def records(spark: SparkSession, sf_dir: str, *, with_city: bool = True, of: F.Column | None = None) -> DataFrame:
    """Record rows (all text, source column names) plus ``city`` when asked.

    ``of``: a condition on ``r_name``; rows of other cities go before the large join.
    """
    li = fact_table(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    supp = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    if of is not None:
        region = region.where(of)
        # semi joins are taken to be as large as their left side, so that a small one is broadcast
        there = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region").where(of), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
        there = table(spark, sf_dir, "supplier").join(there, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
        li = li.join(there.select(F.col("s_suppkey").alias("_of")), F.col("l_suppkey") == F.col("_of"), "left_semi")
    j = (li.join(part, li.l_partkey == part.p_partkey)
         .join(supp, li.l_suppkey == supp.s_suppkey)
         .join(nation, supp.s_nationkey == nation.n_nationkey)
         .join(region, nation.n_regionkey == region.r_regionkey))
    empty = F.lit(None).cast("string")
    cols = [
        F.col("n_name").alias("鄉鎮市區"),
        F.col("p_name").alias("交易標的"),
        F.col("s_name").alias("土地區段位置建物區段門牌"),
        _txt(F.col("l_quantity")).alias("土地移轉總面積平方公尺"),
        F.col("p_brand").alias("都市土地使用分區"),
        F.col("l_linestatus").alias("非都市土地使用分區"),
        empty.alias("非都市土地使用編定"),
        _txt(date_to_roc(F.col("l_shipdate"))).alias("交易年月日"),
        _txt(F.col("l_linenumber")).alias("交易筆棟數"),
        empty.alias("移轉層次"),
        floor_text(F.col("p_size")).alias("總樓層數"),
        F.col("p_type").alias("建物型態"),
        F.col("l_returnflag").alias("主要用途"),
        empty.alias("主要建材"),
        empty.alias("建築完成年月"),
        _txt(F.col("l_extendedprice")).alias("建物移轉總面積平方公尺"),
        _txt(F.col("l_linenumber")).alias("建物現況格局-房"),
        empty.alias("建物現況格局-廳"),
        empty.alias("建物現況格局-衛"),
        empty.alias("建物現況格局-隔間"),
        empty.alias("有無管理組織"),
        _txt(F.col("l_orderkey")).alias("總價元"),
        _txt(F.col("l_discount")).alias("單價元平方公尺"),
        empty.alias("車位類別"),
        _txt(F.col("l_tax")).alias("車位移轉總面積平方公尺"),
        empty.alias("車位總價元"),
        _note().alias("備註"),
        F.concat_ws("-", _txt(F.col("l_orderkey")), _txt(F.col("l_linenumber"))).alias("編號"),
    ]
    if with_city:
        cols.append(F.col("r_name").alias("city"))
    return j.select(*cols)


# The stand-in's filter values: use = 'R' (a return flag), type contains 'ECON'.
STANDIN_USE = "R"
STANDIN_TYPE_PART = "ECON"


def floor_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``number, 總樓層數``: one floor text per lineitem row (p_size written out)."""
    li = fact_table(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.concat_ws("-", _txt(F.col("l_orderkey")), _txt(F.col("l_linenumber"))).alias("number"),
        floor_text(F.col("p_size")).alias("總樓層數"))


def roc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``number, 交易年月日``: one ROC date text per lineitem row."""
    li = fact_table(spark, sf_dir)
    return li.select(
        F.concat_ws("-", _txt(F.col("l_orderkey")), _txt(F.col("l_linenumber"))).alias("number"),
        _txt(date_to_roc(F.col("l_shipdate"))).alias("交易年月日"))


def segment_frames(spark: SparkSession, sf_dir: str) -> dict[str | None, DataFrame]:
    """One customer frame per segment of the data (null: customers without one), the segment column left out (it becomes the tag)."""
    cust = table(spark, sf_dir, "customer")
    segments = [r[0] for r in cust.select("c_mktsegment").distinct().collect()]
    return {seg: cust.where(F.col("c_mktsegment").eqNullSafe(F.lit(seg))).drop("c_mktsegment")
            for seg in sorted(segments, key=lambda x: (x is None, x))}


def _city_csv_writer(records_df: DataFrame, out_dir: str, tag_col: str, as_zip: bool):
    """``mapInArrow`` body writing one task's rows as per-city CSV (zipped or not).

    Rows go to the file of their city batch by batch, so a task holds one batch
    however many rows it has.  The files get their names when all are whole.
    """
    import contextlib
    import io
    import os
    import shutil
    import tempfile
    import zipfile

    import pyarrow as pa
    import pyarrow.compute as pc
    from pyarrow import csv as pacsv
    from pyspark import TaskContext

    from strata import schema

    cols = [c for c in records_df.columns if c != tag_col]
    base = out_dir.rstrip("/")
    alias = pa.table({c: pa.array([schema.ALIAS_BY_SOURCE.get(c, c)], pa.string()) for c in cols})
    out_schema = pa.schema([("path", pa.string()), ("rows", pa.int64())])

    def csv_bytes(rows: pa.Table, head: bool) -> bytes:
        text = io.BytesIO()
        if head:
            text.write("\ufeff".encode("utf-8"))
            rows = pa.concat_tables([alias, rows])
        pacsv.write_csv(rows, text, pacsv.WriteOptions(include_header=head))
        return text.getvalue()

    def write(batches):
        pid = TaskContext.get().partitionId()
        n = 0
        with contextlib.ExitStack() as stack:
            # members of an archive are written one after the other, so their texts wait in local files
            folder = stack.enter_context(tempfile.TemporaryDirectory(prefix="strata-zip-")) if as_zip else None
            parts: dict[str, _Pieces] = {}
            for batch in batches:
                table = pa.Table.from_batches([batch])
                n += table.num_rows
                for tag in pc.unique(table.column(tag_col)).to_pylist():
                    rows = table.filter(pc.equal(table.column(tag_col), tag)).select(cols).cast(alias.schema)
                    head = tag not in parts
                    if head:
                        path = os.path.join(folder, str(len(parts))) if as_zip else f"{base}/{tag_col}={tag}/part-{pid:05d}.csv"
                        parts[tag] = _Pieces(path)
                    parts[tag].write(csv_bytes(rows, head))
            written = [part.close() for part in parts.values()]
            if as_zip and parts:
                archive = _Pieces(f"{base}/part-{pid:05d}.zip")
                with archive.stream() as fh, zipfile.ZipFile(fh, "w", zipfile.ZIP_DEFLATED) as zf:
                    for tag, member in zip(parts, written, strict=True):
                        with open(member, "rb") as text, zf.open(f"{tag}.csv", "w", force_zip64=True) as to:
                            shutil.copyfileobj(text, to, 1 << 20)
                written = [archive.close()]
        if written:
            yield pa.RecordBatch.from_pylist([{"path": p, "rows": n} for p in written], schema=out_schema)

    return cols, write


def write_city_archives(records_df: DataFrame, out_dir: str, *, tag_col: str = "city") -> list[str]:
    """Write stand-in records as zip archives of per-city CSV members, in executors.

    Each task writes one archive ``part-<partition>.zip`` holding one member
    ``<city>.csv`` per city present in its partition: UTF-8 with BOM, the
    header, the English alias row, then the rows (Arrow's CSV writer quotes
    what needs quoting).  Names depend only on the partition, so a retried
    task overwrites its own archive.  Returns the archive paths (one per task).
    """
    cols, write = _city_csv_writer(records_df, out_dir, tag_col, as_zip=True)
    done = records_df.select(tag_col, *cols).mapInArrow(write, "path string, rows bigint")
    return [r["path"] for r in done.collect()]  # one path per task


def write_city_files(records_df: DataFrame, out_dir: str, *, tag_col: str = "city") -> dict[str, str]:
    """Write stand-in records as per-city CSV files shaped like the source files, in executors.

    Each task writes ``<tag_col>=<city>/part-<partition>.csv`` for every city
    in its partition: UTF-8 with BOM, the header, the English alias row first,
    then the rows, so every file starts the way the positional alias-row mode
    expects.  Returns ``{file: city}``.
    """
    from urllib.parse import unquote

    cols, write = _city_csv_writer(records_df, out_dir, tag_col, as_zip=False)
    done = records_df.select(tag_col, *cols).mapInArrow(write, "path string, rows bigint")
    out = {}
    for r in done.collect():  # one row per written file
        folder = r["path"].rsplit("/", 2)[-2]
        out[r["path"]] = unquote(folder[len(tag_col) + 1:])
    return out


class _Pieces:
    """A file that an executor writes piece by piece and that appears whole (local path or pyarrow filesystem URI).

    The bytes go to a name private to this task attempt, which :meth:`close` renames
    into place, so a failed or speculative attempt never leaves a partial file.  A
    local file is open only while a piece is written, so a task may have many.
    """

    def __init__(self, path: str):
        import os

        from pyspark import TaskContext

        ctx = TaskContext.get()
        self.path, self._tmp = path, f"{path}.attempt-{ctx.taskAttemptId() if ctx else os.getpid()}"
        self._local, self._open, self._begun = local_path(path), None, False

    def stream(self):
        """The file, open for writing behind what is there."""
        import os

        if self._local is None:
            filesystem, inner = filesystem_of(self._tmp)
            return filesystem.open_output_stream(inner)
        if not self._begun:
            os.makedirs(os.path.dirname(self._local), exist_ok=True)
        mode, self._begun = "ab" if self._begun else "wb", True
        return open(local_path(self._tmp), mode)

    def write(self, data: bytes) -> None:
        if self._local is not None:
            with self.stream() as fh:
                fh.write(data)
            return
        if self._open is None:  # stores do not append: the stream stays open
            self._open = self.stream()
        self._open.write(data)

    def close(self) -> str:
        """Give the file its name; returns it."""
        import os

        if self._local is not None:
            os.replace(local_path(self._tmp), self._local)
            return self.path
        if self._open is not None:
            self._open.close()
        filesystem, inner = filesystem_of(self.path)
        filesystem.move(filesystem_of(self._tmp)[1], inner)
        return self.path
