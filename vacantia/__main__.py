"""python -m vacantia run | stream | report: the daily run over landed feeds, the same over a folder as a stream, and its sheets."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vacantia.operators import quality
from vacantia.plans import pipeline
from vacantia.sources import feeds
from vacantia.streaming import daily


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vacantia", description=__doc__)
    parser.add_argument("--today", default=dt.date.today().isoformat(), help="the day of the run, YYYY-MM-DD")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="one day: feeds to sheet, excluded rows and board")
    run.add_argument("--feed", action="append", required=True, metavar="NAME=PATH", help="JSON files of a feed's adverts; may be given again")
    run.add_argument("--skip", action="append", default=[], metavar="NAME", help="a feed to leave out")
    run.add_argument("--folder", required=True, help="where the tables are kept")
    stream = commands.add_parser("stream", help="all that has landed in a folder, a part of the day for each batch of files")
    for name in ("--landing", "--folder", "--checkpoint"):
        stream.add_argument(name, required=True)
    report = commands.add_parser("report", help="review sheets of a day's run")
    report.add_argument("--folder", required=True)
    report.add_argument("--rows", type=int, default=40, help="rows of each sheet")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """The exit code: 0 if all went well."""
    wanted = arguments(argv)
    spark = SparkSession.builder.appName("vacantia").getOrCreate()
    if wanted.command == "run":
        paths = dict(f.split("=", 1) for f in wanted.feed)
        found = feeds.union({name: lambda path=path: feeds.read_adverts(spark, path) for name, path in paths.items()}, set(wanted.skip))
        if found is None:
            print("no feed could be read", file=sys.stderr)
            return 1
        ads = feeds.numbered(found.withColumn("date_added", F.lit("")), "job_url", "title", "company", "description_snippet")
        return pipeline.run(pipeline.materialised(ads), wanted.today, wanted.folder)
    if wanted.command == "stream":
        daily.start(spark, wanted.landing, wanted.folder, wanted.today, wanted.checkpoint).awaitTermination()
        return 0
    rows = spark.read.parquet(f"{wanted.folder}/screened/{wanted.today}")
    print(quality.level_sheet(rows, wanted.rows))
    print(quality.tech_sheet(rows, wanted.rows))
    print(quality.drops_sheet(rows.where("not kept"), wanted.rows))
    return 0


if __name__ == "__main__":
    sys.exit(main())
