"""Command line: ``python -m cityviews COMMAND ...``, or the same under ``spark-submit``.

    refresh  VIEW FILE PATH                upsert what one arrived file brings
    backfill VIEW FOLDER PATH FIRST LAST   upsert the files of an hour range, in one job
    follow   VIEW FOLDER PATH CHECKPOINT   upsert the files that are new in a folder
    gaps     FOLDER FIRST LAST             hours of a range without files
    show     VIEW PATH                     print the first rows of the state
    compact  VIEW PATH                     merge the batches of a view
    reset    VIEW PATH                     empty a view
    slots    FOLDER FIRST LAST             hourly weather whose slot isn't the hour of its file

VIEW is a name of ``cityviews.plans.registry.VIEWS``; hours read ``yyyy-MM-dd_HH``. A feed is a folder
of stamped files, or of folders ``day=yyyy-MM-dd/hour=HH``; its files may differ in types and fields.
With ``--cells`` a command takes the view kept as text cells. ``--rule ingest`` lets what is written
last win, not the newest file; give it to all commands of a view. ``refresh --latest`` takes a
folder for FILE and uses its newest file; ``backfill --stale`` skips hours without a newer file.
``show status_hourly_parts`` prints the means behind the sums.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cityviews.plans.refresh import (
    backfill,
    check_feed,
    feed_rows,
    file_coverage,
    files_of,
    refresh_cells_from_file,
    refresh_from_file,
)
from cityviews.plans.registry import VIEWS, stored_spec
from cityviews.plans.views import off_slot, status_hourly_from_parts
from cityviews.sinks.store import compact_view, read_view, reset_view
from cityviews.sources.files import latest_file, stream_files
from cityviews.streaming.refresh import follow_files


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="cityviews", description=__doc__,
        formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *names: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in names:
            sub.add_argument(argument, choices=list(VIEWS) if argument == "view" else None)
        return sub

    def kept(sub: argparse.ArgumentParser) -> argparse.ArgumentParser:
        sub.add_argument("--cells", action="store_true")
        sub.add_argument("--rule", choices=["version", "ingest"])
        return sub

    refresh = kept(command("refresh", "view", "file", "path"))
    refresh.add_argument("--batch", type=int)
    refresh.add_argument("--latest", action="store_true")
    again = kept(command("backfill", "view", "folder", "path", "first", "last"))
    again.add_argument("--batch", type=int)
    again.add_argument("--stale", action="store_true")
    follow = kept(command("follow", "view", "folder", "path", "checkpoint"))
    follow.add_argument("--files-per-batch", type=int)
    follow.add_argument("--compact-every", type=int)
    command("gaps", "folder", "first", "last")
    command("slots", "folder", "first", "last")
    show = kept(command("show", "view", "path"))
    show.add_argument("--rows", type=int, default=20)
    compact = kept(command("compact", "view", "path"))
    compact.add_argument("--upto", type=int)
    kept(command("reset", "view", "path"))
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    spec = stored_spec(args.view, args.cells, args.rule) if "view" in args else None
    if args.command == "refresh":
        file = latest_file(spark, args.file) if args.latest else args.file
        if file is None:
            raise ValueError(f"no stamped file in {args.file}")
        if args.cells:
            refresh_cells_from_file(spark, args.view, file, args.path, args.batch, args.rule or "version")
        else:
            refresh_from_file(spark, args.view, file, args.path, args.batch)
    elif args.command == "backfill":
        backfill(spark, args.view, args.folder, args.path, args.first, args.last, args.batch,
                 args.cells, args.rule, args.stale)
    elif args.command == "follow":
        check_feed(VIEWS[args.view], files_of(spark, args.folder))
        follow_files(
            stream_files(spark, args.folder, args.files_per_batch), args.view, args.folder, args.path,
            args.checkpoint, args.compact_every, args.cells, args.rule).awaitTermination()
    elif args.command == "gaps":
        counts = file_coverage(spark, args.folder, args.first, args.last)
        n = 0
        for row in counts.where("n = 0").orderBy("stamp").toLocalIterator():
            n += 1
            print(row["stamp"])
        print(f"{n} hours without files")
    elif args.command == "slots":
        found = feed_rows(VIEWS["weather_hourly"], files_of(spark, args.folder, args.first, args.last))
        n = 0
        for row in off_slot(found).orderBy("version").toLocalIterator():
            n += 1
            print(row["version"], row["time"])
        print(f"{n} hours off their slot")
    elif args.command == "show":
        rows = read_view(spark, spec, args.path)
        if args.view == "status_hourly_parts" and not args.cells:
            rows = status_hourly_from_parts(rows)
        rows.show(args.rows, truncate=False)
    elif args.command == "compact":
        compact_view(spark, spec, args.path, args.upto)
    elif args.command == "reset":
        reset_view(spark, spec, args.path)


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName(f"cityviews {args.command}").getOrCreate()
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
