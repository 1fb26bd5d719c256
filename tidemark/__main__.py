"""Command line, for spark-submit or `python -m tidemark`.

    ingest  take changes from Kafka or a folder into a store
    build   rebuild the marts from a store's current tables
    check   run the data checks on built marts; fails if any check fails
    page    write all page results for a selection
    latest  show the newest change events
"""

from __future__ import annotations

import argparse
from datetime import date

from tidemark.operators import quality
from tidemark.plans import dashboard, marts
from tidemark.session import build_session
from tidemark.sources import changes
from tidemark.streaming.ingest import start_ingest
from tidemark.streaming.store import ChangeStore


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    top.add_argument("--master", help="Spark master; by default what spark-submit sets")
    commands = top.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest")
    ingest.add_argument("store")
    ingest.add_argument("--checkpoint", required=True)
    source = ingest.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--files", metavar="FOLDER")
    ingest.add_argument("--topic-prefix", help="with --kafka: topics are <prefix>.<entity>")
    ingest.add_argument("--keep-marts", action="store_true", help="bring hourly, status and city figures up to date with every batch")
    ingest.add_argument("--interval", help='run on, e.g. "30 seconds"; by default take what is there and end')

    build = commands.add_parser("build")
    build.add_argument("store")
    build.add_argument("marts")
    build.add_argument("--only", nargs="+", choices=sorted(marts.MARTS))

    check = commands.add_parser("check")
    check.add_argument("marts")

    page = commands.add_parser("page")
    page.add_argument("store")
    page.add_argument("out")
    page.add_argument("--city", nargs="*")
    page.add_argument("--status", nargs="*")
    page.add_argument("--category", nargs="*")
    page.add_argument("--start", type=date.fromisoformat)
    page.add_argument("--end", type=date.fromisoformat)

    vacuum = commands.add_parser("vacuum", help="delete table versions that recent commits do not use")
    vacuum.add_argument("store")
    vacuum.add_argument("--keep", type=int, default=10, help="commits whose tables stay readable")
    latest = commands.add_parser("latest")
    latest.add_argument("store")
    latest.add_argument("-k", type=int, default=30)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("tidemark", args.master)
    if args.command == "ingest":
        if args.kafka:
            if not args.topic_prefix:
                raise SystemExit("--kafka needs --topic-prefix")
            messages = changes.kafka_stream(spark, args.kafka, changes.topics(args.topic_prefix))
        else:
            messages = changes.file_stream(spark, args.files)
        store = ChangeStore(spark, args.store, keep_marts=args.keep_marts)
        query = start_ingest(messages, store, args.checkpoint, args.interval, repeats=not args.kafka)
        try:
            query.awaitTermination()
        except KeyboardInterrupt:
            query.stop()
    elif args.command == "build":
        marts.build_marts(ChangeStore(spark, args.store).tables(), args.marts, args.only)
    elif args.command == "check":
        results = marts.check_marts(spark, args.marts).cache()
        results.show(truncate=False)
        quality.require_passed(results)
    elif args.command == "page":
        picked = [None if v is None else tuple(v) for v in (args.city, args.status, args.category)]
        filters = dashboard.Filters(*picked, args.start, args.end)
        for name, frame in dashboard.page(ChangeStore(spark, args.store).tables(), filters).items():
            frame.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    elif args.command == "vacuum":
        print(ChangeStore(spark, args.store).vacuum(args.keep), "folders deleted")
    elif args.command == "latest":
        ChangeStore(spark, args.store).latest_events(args.k).show(args.k, truncate=False)


if __name__ == "__main__":
    main()
