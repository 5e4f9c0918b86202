"""Command line: ``python -m tapflow <step> <names...> [options]``.

Runs one named step (see ``tapflow.plans.steps``), then shows a short preview
of the written table.  Names are Parquet folders (with a slash), or tables of
the session's catalog; without ``--hive`` or another catalog that outlives the
process, only folders are seen by the next step.  A wrong number of names prints the
step's usage and exits with status 255, as a scheduler expects.

JDBC connection options are passed as ``--option key=value`` (repeatable);
a password is read from the environment variable named by
``--password-env`` so it never appears in a process list.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from tapflow.plans.steps import STEPS, StepOptions, run_step

log = logging.getLogger("tapflow")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tapflow", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("step", choices=sorted(STEPS))
    p.add_argument("names", nargs="*", help="input paths or table names, then the output")
    p.add_argument("--db", default=None, help="database of every table")
    p.add_argument("--path", default=None, help="external location of the output table")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="JDBC reader option (url, driver, user, dbtable, ...)")
    p.add_argument("--password-env", default=None,
                   help="environment variable holding the JDBC password")
    p.add_argument("--hot-threshold", type=int, default=None,
                   help="rows above which a card-day is processed in chunks")
    p.add_argument("--rows-per-chunk", type=int, default=None,
                   help="target rows per chunk of a hot card-day")
    p.add_argument("--restartable", action="store_true",
                   help="publish the output whole, and skip a step whose inputs are unchanged")
    p.add_argument("--rejects", default=None,
                   help="table for the lines of a tap file that do not parse whole")
    p.add_argument("--buckets", type=int, default=0,
                   help="bucket the tables between the clean steps and od-flow by card")
    p.add_argument("--replace-partitions", action="store_true",
                   help="overwrite only the days that the input holds")
    p.add_argument("--hive", action="store_true",
                   help="use the Hive catalog of the submitted session")
    p.add_argument("--no-preview", action="store_true")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    step = STEPS[args.step]
    if len(args.names) != step.inputs:
        log.warning("%s needs %d names: %s", args.step, step.inputs, step.help)
        return 255
    jdbc = dict(kv.split("=", 1) for kv in args.option)
    if args.password_env:
        jdbc["password"] = os.environ[args.password_env]
    options = StepOptions(db=args.db, jdbc=jdbc, path=args.path, buckets=args.buckets,
                          rejects=args.rejects, restartable=args.restartable)
    if args.replace_partitions:
        options.mode = "partitions"
    if args.hot_threshold is not None:
        options.hot_threshold = args.hot_threshold
    if args.rows_per_chunk is not None:
        options.rows_per_chunk = args.rows_per_chunk

    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.appName(f"tapflow {args.step}")
             .config("spark.ui.enabled", "false")  # batch step: no web UI server
             .config("spark.sql.parquet.writeLegacyFormat", "true"))
    if args.hive:
        spark = spark.enableHiveSupport()
    spark = spark.getOrCreate()
    try:
        out = run_step(spark, args.step, args.names, options)
        if not args.no_preview:
            # only the small flow table is ordered; the others show any first rows
            if step.preview_order:
                out = out.orderBy(*step.preview_order)
            out.limit(step.preview_rows).show(truncate=False)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    sys.exit(main())
