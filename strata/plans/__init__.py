"""Plans: the end-to-end job, stand-in inputs and the query catalog."""

from strata.plans.job import (
    clean,
    filter_records,
    nest_from_events,
    run,
    select_events,
    split_parts,
    transform,
    write_events,
)

__all__ = ["clean", "filter_records", "nest_from_events", "run", "select_events", "split_parts",
           "transform", "write_events"]
