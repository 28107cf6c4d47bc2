"""Writing record rows back as per-tag CSV files (UTF-8 with BOM, header, alias rows).

The shape of the source files: a header row of source column names, an
English alias row, data.  One folder per tag (``partitionBy``), one write job.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schema
from strata.session import settings

BOM = "\ufeff"


OPEN_FILES = 64  # up to so many tags, a task keeps a file open for each


def _alias_heads(tag_col: str, alias: dict[str, str], most: int | None):
    """``mapInArrow`` body adding an alias row before a task's first row of each tag.

    Without ``most``, ``_ord`` tells it (0) from the rows (1), for a sort; with it, more tags than so many are an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[str | None] = set()
        for batch in batches:
            new = [t for t in pc.unique(batch.column(tag_col)).to_pylist() if t not in met]
            met.update(new)
            if most is not None and len(met) > most:
                raise ValueError(f"more than the {most} tags given by n_tags")
            heads = [pa.array(new if c == tag_col else [alias[c]] * len(new), pa.string()) for c in batch.schema.names]
            for columns, ord_, n in ((heads, 0, len(new)), (batch.columns, 1, len(batch))):
                names, extra = list(batch.schema.names), []
                if most is None:
                    names, extra = [*names, "_ord"], [pa.array([ord_] * n, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *extra], names=names)

    return run


def write_records_csv(df: DataFrame, out_dir: str, *, tag_col: str = "city",
                      alias: Mapping[str, str] | None = None, bom: bool = True, mode: str = "overwrite",
                      n_tags: int | None = None) -> str:
    """Write text record columns as CSV under ``out_dir/<tag_col>=<tag>/``.

    Every file starts with the byte-order mark (``bom``: the first header name
    is prefixed with U+FEFF), the header and one alias row, so it reads back in
    the positional mode.  ``alias`` maps source column -> alias text (default:
    the English output names).  One pass: each task writes one file per tag it
    holds, its alias row first.  Where at most ``n_tags`` tags (a null tag is one)
    are known to be there and these are few, a task writes all its files side by
    side; otherwise its rows are sorted by tag, which may spill.
    """
    cols = [c for c in df.columns if c != tag_col]
    alias = schema.ALIAS_BY_SOURCE if alias is None else alias
    most = n_tags if n_tags is not None and 0 < n_tags <= OPEN_FILES else None
    data = df.select(F.col(tag_col).cast("string").alias(tag_col), *[F.col(c).cast("string").alias(c) for c in cols])
    out_schema = T.StructType([T.StructField(c, T.StringType()) for c in data.columns])
    if most is None:
        out_schema = out_schema.add("_ord", T.IntegerType())
    rows = data.mapInArrow(_alias_heads(tag_col, {c: alias.get(c, c) for c in cols}, most), out_schema)
    if most is None:
        rows = rows.sortWithinPartitions(tag_col, "_ord").drop("_ord")
    if bom and cols:
        rows = rows.withColumnRenamed(cols[0], BOM + cols[0])
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(most + 1 if most else 0)}):  # as many open files start a sort
        (rows.write.mode(mode).partitionBy(tag_col)
         .option("header", "true").option("escape", '"').option("quote", '"')
         .csv(out_dir))
    return out_dir
