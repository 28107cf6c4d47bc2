"""Command line: ``python -m strata <input> <output> [options]``.

Reads the city files (``<letter>_lvr_land_A.csv`` under a folder, or zip
archives holding them), builds the nested document and writes one JSON-lines
folder per part.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata import schema
from strata.plans.job import PAGE_EVENTS, necessary, nest_from_events, run, split_parts, transform, write_events
from strata.sinks.json_lines import write_named_parts, write_parts
from strata.session import size_for_input
from strata.sources.records import city_files, list_files, read_tagged, report_foreign
from strata.sources.zip_members import read_zip_members, tag_by_member


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="strata", description=__doc__)
    ap.add_argument("input", help="folder with <letter>_lvr_land_A.csv files, or a zip archive / glob")
    ap.add_argument("output", help="output folder; one sub-folder per part")
    ap.add_argument("--zip", action="store_true", help="input is zip archive(s)")
    ap.add_argument("--fields", type=int, default=2, choices=(2, 28))
    ap.add_argument("--floors", default="compat", choices=("compat", "full"))
    ap.add_argument("--split", default="hash", choices=("hash", "balanced", "random"))
    ap.add_argument("--parts", type=int, default=2)
    ap.add_argument("--seed", type=int, default=None)
    ap.add_argument("--alias-row", default="positional", choices=("positional", "typed", "none"),
                    help="positional: drop each file's first data row; typed: only when its date is not one")
    ap.add_argument("--single-line", dest="multiline", action="store_false",
                    help="no field holds a line break: large files are split")
    ap.add_argument("--files-per-part", type=int, default=None,
                    help="1 = a single file per part (small outputs only)")
    ap.add_argument("--max-events-per-line", type=int, default=PAGE_EVENTS,
                    help="events of a page; a line is (city, page, time_slots)")
    ap.add_argument("--whole-cities", action="store_true",
                    help="one line per city instead of pages (a line then grows with its city)")
    ap.add_argument("--no-combine-copies", dest="combine_copies", action="store_false",
                    help="skip counting identical events map-side before nesting (when copies are rare)")
    ap.add_argument("--part-paths", default=None,
                    help="comma-separated output path per part (e.g. out/output1.json,out/output2.json) "
                         "instead of part=<n> folders under the output")
    ap.add_argument("--stream", action="store_true",
                    help="treat the input as a landing folder: ingest the files not yet seen "
                         "(Structured Streaming, availableNow) into --events-dir, then nest from it")
    ap.add_argument("--max-files-per-trigger", type=int, default=1000,
                    help="with --stream: files per micro-batch (bounds what one batch plans and reads)")
    ap.add_argument("--events-dir", default=None,
                    help="write the cleaned, filtered events there as Parquet first (a written cut of "
                         "the lineage), then nest from that table")
    ap.add_argument("--explain", action="store_true",
                    help="print the formatted physical plan of the document before writing")
    ap.add_argument("--report", action="store_true",
                    help="print what became of the records: tokens and failed casts per column, events kept and "
                         "written per city, values left after the filter (folders of CSV files; see plans.job.run)")
    ap.add_argument("--no-sizing", action="store_true",
                    help="keep the session's shuffle and split sizes (default: size them from the input bytes)")
    args = ap.parse_args(argv)

    if args.stream and not args.events_dir:
        ap.error("--stream needs --events-dir")
    if args.stream and args.zip:
        ap.error("--stream watches a folder of CSV files; it does not read zip archives")
    if args.report and (args.stream or args.zip or args.events_dir):
        ap.error("--report reads a folder of CSV files and keeps its own events table")
    page = None if args.whole_cities else args.max_events_per_line
    spark = SparkSession.builder.appName("strata").getOrCreate()
    if not args.no_sizing:
        total = list_files(spark, [args.input]).agg(F.sum("length")).first()[0] or 0  # metadata only
        size_for_input(spark, total)
    seed = args.seed if args.seed is not None else (None if args.split == "random" else 42)
    named = {i: p for i, p in enumerate(args.part_paths.split(","))} if args.part_paths else None
    if args.report:
        report: dict = {}
        written = run(spark, city_files(spark, args.input), args.output, n_fields=args.fields, split=args.split, n_parts=args.parts,
                      seed=seed, files_per_part=args.files_per_part, alias_row=args.alias_row, multiline=args.multiline,
                      part_paths=named, report=report, floors_mode=args.floors, combine_copies=args.combine_copies,
                      max_events_per_line=page)
        print(json.dumps(written, ensure_ascii=False))
        print(json.dumps(report, ensure_ascii=False, default=str))
        return written
    if args.stream:
        from strata.streaming.arrivals import foreign_files, ingest_arrivals

        ingest_arrivals(spark, args.input, args.events_dir, n_fields=args.fields,
                        floors_mode=args.floors, columns=schema.required_columns(args.fields),
                        alias_row=args.alias_row,
                        max_files_per_trigger=args.max_files_per_trigger).awaitTermination()
        report_foreign(foreign_files(spark, args.input))
        records = None
    elif args.zip:
        names = {schema.CITY_FILE_PATTERN.format(letter=k): v for k, v in schema.CITY_BY_LETTER.items()}
        rows = read_zip_members(spark, args.input, names=names, columns=schema.required_columns(args.fields),
                                alias_row=args.alias_row)
        records = tag_by_member(rows, names)
    else:
        records = read_tagged(spark, city_files(spark, args.input), alias_row=args.alias_row, multiline=args.multiline,
                              require=schema.required_columns(args.fields), where=necessary())
    if args.events_dir:
        if records is not None:
            write_events(records, args.events_dir, n_fields=args.fields, floors_mode=args.floors)
        doc = nest_from_events(spark, args.events_dir, n_fields=args.fields,
                               combine_copies=args.combine_copies,
                               max_events_per_line=page)
    else:
        doc = transform(records, n_fields=args.fields, floors_mode=args.floors,
                        combine_copies=args.combine_copies,
                        max_events_per_line=page)
    if args.explain:
        doc.explain("formatted")
    parts = split_parts(doc, args.split, args.parts, seed)
    if named:
        written = write_named_parts(parts, named, n_files=args.files_per_part)
    else:
        written = write_parts(parts, args.output, files_per_part=args.files_per_part)
    print(json.dumps(written, ensure_ascii=False))
    return written


if __name__ == "__main__":
    main()
