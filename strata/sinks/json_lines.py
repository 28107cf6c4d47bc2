"""JSON-lines output: one valid JSON document per line.

Spark's JSON writer omits null fields (a null ``date`` key disappears), and
``to_json`` of the same row gives the written line byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def write_json_lines(df: DataFrame, path: str, *, n_files: int | None = None,
                     mode: str = "overwrite") -> str:
    """Write ``df`` as JSON lines under ``path``.

    ``n_files`` repartitions first (1 = a single file, as small outputs
    want); ``None`` keeps the plan's partitioning so large outputs write in
    parallel.
    """
    out = df.repartition(n_files) if n_files else df
    out.write.mode(mode).json(path)
    return path


def write_parts(df: DataFrame, out_dir: str, *, part_col: str = "part",
                files_per_part: int | None = None, mode: str = "overwrite") -> dict[str, str]:
    """Write every part to its own folder in a single pass (``partitionBy``).

    Returns ``{part value: folder}``.  ``files_per_part=1`` gives one file per
    part (the whole part goes through one task, so only for small results);
    ``k > 1`` spreads each part over about ``k`` files; ``None`` leaves the
    file count to the plan.
    """
    out = df
    if files_per_part == 1:
        out = df.repartition(part_col)
    elif files_per_part:
        # deterministic spread: a hash of the row itself (nested columns hash directly)
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_part))
        out = df.repartition(F.col(part_col), salt)
    out.write.mode(mode).partitionBy(part_col).json(out_dir)
    # list the written folders (file metadata only, no data is re-read or recomputed)
    listing = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.json").load(out_dir)
    if part_col not in listing.columns:  # an empty result writes no part folders
        return {}
    parts = [r[0] for r in listing.select(part_col).distinct().collect()]
    base = out_dir.rstrip("/")
    folder = {p: NULL_FOLDER if p is None else p for p in parts}  # Spark's own name for a null part
    return {str(p): f"{base}/{part_col}={folder[p]}" for p in sorted(parts, key=lambda p: (p is None, p))}


def write_named_parts(df: DataFrame, paths: dict, *, part_col: str = "part",
                      n_files: int | None = None, mode: str = "overwrite") -> dict[str, str]:
    """Write each part to a path of its own (``{part value: path}``), without ``part_col``.

    The split result is checkpointed once (to the shared checkpoint folder),
    so every part's write reads it instead of recomputing the document;
    each part is then one filtered write.  Part values missing from
    ``paths`` are an error, so no row is silently left out.
    """
    from strata.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    present = {r[0] for r in done.select(part_col).distinct().collect()}  # a handful of part ids
    missing = present - set(paths)
    if missing:
        raise ValueError(f"no path for part(s) {sorted(missing, key=lambda p: (p is None, p))}")
    out = {}
    for value, path in paths.items():
        write_json_lines(done.filter(F.col(part_col) == F.lit(value)).drop(part_col), path,
                         n_files=n_files, mode=mode)
        out[str(value)] = path
    return out
