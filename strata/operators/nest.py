"""Two-level nesting: ``key -> slots (latest first) -> events``.

Output document (one row per key)::

    city: string
    time_slots: array<struct<date: date, events: array<struct<...fields...>>>>

Order is fixed, not left to ``collect_list``: ``events`` are sorted by the
whole struct (ascending, nulls first), ``time_slots`` by date descending
with the null date last.  Both sorts are ``sort_array`` inside the
aggregate, so no global sort or range exchange is planned.

Scale.  ``combine_copies`` first counts identical events per slot, which
Spark does map-side, so a group of copies - however large - travels as one
(event, count) row and is expanded only in the final array.  The document
itself is one row per key by definition, so a key's whole content ends in
one row; :func:`nest_paged` is the bounded form for data where that does not
fit: every output row holds at most ``max_events`` events, no row is
dropped, and concatenating a key's pages in page order gives its document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rank import cumulative_by_range


def event_struct(fields: Sequence[str]) -> Column:
    """Pack the event fields into one struct, in the given order."""
    return F.struct(*[F.col(f) for f in fields])


def _expand(runs: Column) -> Column:
    """``array<struct<_ev, _n>>`` -> the events, each repeated ``_n`` times, in order."""
    return F.flatten(F.transform(runs, lambda r: F.array_repeat(r["_ev"], r["_n"].cast("int"))))


def nest_events(
    df: DataFrame,
    keys: Sequence[str] = ("city", "date"),
    fields: Sequence[str] = ("district", "type"),
    *,
    events_col: str = "events",
    combine_copies: bool = False,
) -> DataFrame:
    """Level 1: one row per ``keys`` with the sorted array of event structs.

    ``combine_copies``: count identical events first (partial aggregation
    before the shuffle), then collect one (event, count) run per distinct
    event; a hot group of copies never crosses the network row by row.
    """
    ev = event_struct(fields).alias("_ev")
    if not combine_copies:
        return df.groupBy(*keys).agg(F.sort_array(F.collect_list(ev)).alias(events_col))
    runs = df.groupBy(*[F.col(k) for k in keys], ev).agg(F.count(F.lit(1)).alias("_n"))
    nested = runs.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_ev", "_n"))).alias("_runs"))
    return nested.select(*keys, _expand(F.col("_runs")).alias(events_col))


def nest_slots(
    df: DataFrame,
    key: str = "city",
    slot: str = "date",
    *,
    events_col: str = "events",
    slots_col: str = "time_slots",
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Level 2: one row per ``key`` with slots sorted by ``slot`` descending, null last."""
    s = F.struct(F.col(slot), F.col(events_col))
    return df.groupBy(key, *extra_keys).agg(F.sort_array(F.collect_list(s), asc=False).alias(slots_col))


def nest_two_levels(
    df: DataFrame,
    key: str = "city",
    slot: str = "date",
    fields: Sequence[str] = ("district", "type"),
    *,
    combine_copies: bool = False,
) -> DataFrame:
    """Full document: ``key, time_slots[slot desc] -> events[sorted]``."""
    level1 = nest_events(df.select(key, slot, *fields), (key, slot), fields, combine_copies=combine_copies)
    return nest_slots(level1, key, slot)


def nest_paged(
    df: DataFrame,
    key: str = "city",
    slot: str = "date",
    fields: Sequence[str] = ("district", "type"),
    *,
    max_events: int = 10_000,
    num_partitions: int | None = None,
) -> DataFrame:
    """Bounded document pages: ``key, page, time_slots``.

    Events of a key are numbered in document order (slot descending with null
    last, then the event struct); page ``p`` holds numbers
    ``[p * max_events, (p + 1) * max_events)``.  A slot cut by a page boundary
    appears at the end of one page and the start of the next.

    Plan: identical events are counted first (map-side), the distinct
    (key, slot, event) rows get weighted cumulative positions by range
    (:func:`~strata.operators.rank.cumulative_by_range`), a run of copies that
    crosses page boundaries is cut into per-page pieces, and every group
    after that holds at most ``max_events`` events.
    """
    if max_events < 1:
        raise ValueError("max_events must be positive")
    m = F.lit(max_events).cast("bigint")
    runs = df.groupBy(F.col(key), F.col(slot), event_struct(fields).alias("_ev")).agg(
        F.count(F.lit(1)).alias("_n"))
    placed = cumulative_by_range(
        runs, [F.col(slot).desc_nulls_last(), F.col("_ev").asc_nulls_first()], [key],
        weight="_n", out_col="_start", num_partitions=num_partitions)
    first_page = F.floor(F.col("_start") / m)
    last_page = F.floor((F.col("_start") + F.col("_n") - 1) / m)
    pieces = placed.select(key, slot, "_ev", "_start", "_n",
                           F.explode(F.sequence(first_page, last_page)).alias("page"))
    lo = F.greatest(F.col("_start"), F.col("page") * m)
    hi = F.least(F.col("_start") + F.col("_n"), (F.col("page") + 1) * m)
    pieces = pieces.select(key, slot, F.col("page").cast("bigint").alias("page"), "_ev",
                           (hi - lo).alias("_n"))
    level1 = pieces.groupBy(key, "page", slot).agg(
        F.sort_array(F.collect_list(F.struct("_ev", "_n"))).alias("_runs"))
    level1 = level1.select(key, "page", slot, _expand(F.col("_runs")).alias("events"))
    return nest_slots(level1, key, slot, extra_keys=("page",))


def document_json(df: DataFrame, key: str = "city", slots_col: str = "time_slots",
                  extra: Sequence[str] = ()) -> DataFrame:
    """``key, [extra], line``: the slots as the JSON text a JSON-lines sink writes."""
    return df.select(F.col(key), *[F.col(e) for e in extra], F.to_json(F.col(slots_col)).alias("line"))
