"""Captures on the command line.

``process PATH OUT``   flow rows, host profiles and the series
``run PATH OUT``       the same from captures as they land, until stopped
``decode PATH``        the first packets
``info PATH``          what each capture holds
``retain PATH BYTES``  delete the oldest files beyond a size
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from netloom.config import OFFLINE
from netloom.plans.process import process_captures
from netloom.sources.decode import decode_frames
from netloom.sources.pcap import capture_files, capture_reports, read_captures
from netloom.sources.sinks import apply_retention, write_csv
from netloom.streaming.ledger import enlist, keep_enlisting
from netloom.streaming.jobs import flush_flows, run_capture_flows


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="netloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    process = commands.add_parser("process")
    process.add_argument("path")
    process.add_argument("out")
    process.add_argument("--csv", action="store_true", help="write CSV beside Parquet")
    run = commands.add_parser("run")
    run.add_argument("path")
    run.add_argument("out")
    run.add_argument("--once", action="store_true", help="stop when all that has landed is done")
    run.add_argument("--flush", action="store_true", help="with --once: write the flows that are still open as the end of their captures closes them")
    run.add_argument("--ledger", action="store_true", help="read each content once: renamed copies are left out, replaced files are read again")
    decode = commands.add_parser("decode")
    decode.add_argument("path")
    decode.add_argument("--packets", type=int, default=20)
    info = commands.add_parser("info")
    info.add_argument("path")
    retain = commands.add_parser("retain")
    retain.add_argument("path")
    retain.add_argument("bytes", type=int)
    options = parser.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if options.command == "info":
        capture_reports(capture_files(spark, options.path)).show(truncate=False)
        return
    if options.command == "decode":
        decode_frames(read_captures(spark, options.path)).limit(options.packets).show(options.packets, truncate=False)
        return
    if options.command == "retain":
        print(apply_retention(spark, options.path, options.bytes), "files deleted")
        return
    flow, profile, series = OFFLINE
    if options.command == "run":
        state, settings = f"{options.out}/_checkpoint", {"params": flow, "profile": profile, "series": series}
        ledger = f"{options.out}/_ledger" if options.ledger else None
        if ledger:
            enlist(spark, options.path, ledger)
            if not options.once:
                keep_enlisting(spark, options.path, ledger, f"{options.out}/_scans")
        run_capture_flows(spark, options.path, options.out, state, available_now=options.once, ledger=ledger, **settings).awaitTermination()
        if options.once and options.flush:
            print(flush_flows(spark, options.out, state, **settings), "open flows written")
        return
    tables = process_captures(spark, options.path, flow=flow, profile=profile, series=series, flows_path=f"{options.out}/flows")
    for name in ("profiles", "series"):
        getattr(tables, name).write.mode("overwrite").parquet(f"{options.out}/{name}")
        if options.csv:
            write_csv(spark.read.parquet(f"{options.out}/{name}"), f"{options.out}/{name}_csv")
    if options.csv:
        write_csv(tables.flows, f"{options.out}/flows_csv")


if __name__ == "__main__":
    main()
