"""Command line of the jobs: ``python -m oreflow <job>`` or through ``spark-submit``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from oreflow import session
from oreflow.operators import message_text
from oreflow.plans import KEEP_SECONDS, Warehouse, drop_table
from oreflow.sources import Topic, read_topic, round_trip
from oreflow.streaming import (
    repartition_state,
    run_bronze,
    run_for,
    run_gold,
    run_silver,
    run_tail,
    run_until_idle,
    supervised,
)
from oreflow.streaming.jobs import AVAILABLE

JOBS = ("bronze", "silver", "gold", "tail", "check", "drop-gold", "repartition")


def _pair(text: str) -> tuple[str, str]:
    key, sign, value = text.partition("=")
    if not sign:
        raise argparse.ArgumentTypeError(f"expected key=value, not {text}")
    return key, value


def parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="oreflow", description=__doc__)
    cli.add_argument("job", choices=JOBS)
    cli.add_argument("--topic", default="trades", help="name of the topic")
    cli.add_argument("--servers", help="Kafka servers of the topic")
    cli.add_argument("--path", help="folder of the topic's Parquet log, instead of Kafka")
    cli.add_argument("--topic-option", type=_pair, action="append", default=[], metavar="KEY=VALUE")
    cli.add_argument("--root", default="", help="folder of the tables, which all executors can reach")
    cli.add_argument("--checkpoints", help="folder of the checkpoints, if not below the root")
    cli.add_argument("--format", choices=("parquet", "iceberg"), help="of the tables; iceberg for large ones")
    cli.add_argument("--catalog", help="name of the Iceberg catalog")
    cli.add_argument("--catalog-uri", help="REST address of the Iceberg catalog")
    cli.add_argument("--s3-endpoint", help="object store of the Iceberg catalog and the checkpoints")
    cli.add_argument("--bounded", action="store_true", help="silver: forget trade ids behind the watermark")
    cli.add_argument("--salts", type=int, help="silver: tasks that share a busy trade id; by default all")
    cli.add_argument("--state-partitions", type=int, help="silver, gold: tasks with state, fixed at the first start")
    cli.add_argument("--spread", type=int, help="silver, gold: tasks that share the rows of a busy ticker")
    cli.add_argument("--keep-seconds", type=float, default=KEEP_SECONDS, help="gold: how long replaced rows stay")
    cli.add_argument("--starting", default="latest", choices=("earliest", "latest"), help="tail: where to begin")
    cli.add_argument("--once", action="store_true", help="work off what is there, then stop")
    cli.add_argument("--interval", help="time between two batches, such as '30 seconds'")
    cli.add_argument("--seconds", type=float, help="stop after this time")
    cli.add_argument("--until-idle", action="store_true", help="stop when a trigger finds nothing new")
    cli.add_argument("--attempts", type=int, default=1, help="start a failed job again from its checkpoint, so often in all")
    cli.add_argument(
        "--generation", type=int, default=1, help="silver, gold: how often the state was laid out anew, plus one"
    )
    cli.add_argument("--packages", action="store_true", help="fetch the connectors the job needs")
    cli.add_argument("--master")
    cli.add_argument("--conf", type=_pair, action="append", default=[], metavar="KEY=VALUE")
    return cli


def settings_of(args: argparse.Namespace) -> dict[str, str]:
    settings: dict[str, str] = {}
    if args.packages:
        wanted = [session.KAFKA_PACKAGE] if args.servers else []
        wanted += [session.ICEBERG_PACKAGE] if args.format == "iceberg" else []
        wanted += [session.S3A_PACKAGE] if args.s3_endpoint else []
        if wanted:
            settings |= session.package_settings(*wanted)
    if args.format == "iceberg":
        if not (args.catalog and args.catalog_uri):
            raise SystemExit("iceberg needs --catalog and --catalog-uri")
        settings |= session.iceberg_settings(args.catalog, args.catalog_uri, args.root, args.s3_endpoint)
    if args.s3_endpoint:
        settings |= session.s3a_settings(args.s3_endpoint)
    if args.state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(args.state_partitions)
    return settings | dict(args.conf)


def check(spark: SparkSession, topic: Topic) -> int:
    """Exit code of a round trip: three messages out and back, and a look at the topic."""
    greetings = [(f"check-{i}", f"round trip {i}") for i in (1, 2, 3)]
    lost = round_trip(spark.createDataFrame(greetings, "key string, value string"), topic)
    print(f"{len(greetings) - lost} of {len(greetings)} messages came back from {topic.name}")
    message_text(read_topic(spark, topic)).show(truncate=False)
    return min(lost, 1)


def start(spark: SparkSession, args: argparse.Namespace, warehouse: Warehouse) -> StreamingQuery:
    trigger = AVAILABLE if args.once else {"processingTime": args.interval} if args.interval else None
    if args.job == "silver":
        return run_silver(spark, warehouse, trigger, bounded=args.bounded, salts=args.salts, spread=args.spread)
    if args.job == "gold":
        return run_gold(spark, warehouse, trigger, spread=args.spread, keep_seconds=args.keep_seconds)
    topic = topic_of(args)
    if args.job == "bronze":
        return run_bronze(spark, topic, warehouse, trigger)
    return run_tail(spark, topic, args.starting, trigger=trigger)


def topic_of(args: argparse.Namespace) -> Topic:
    return Topic(args.topic, servers=args.servers, path=args.path, options=dict(args.topic_option))


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.job not in ("tail", "check") and not args.root:
        raise SystemExit(f"{args.job} needs --root")
    if args.job not in ("tail", "check") and not args.format:
        raise SystemExit(f"{args.job} needs --format: iceberg, or parquet for moderate numbers of files")
    catalog = args.catalog if args.format == "iceberg" else None
    warehouse = Warehouse(
        args.root, args.format or "parquet", catalog, checkpoints=args.checkpoints, generation=args.generation
    )
    spark = session.build_session(f"oreflow-{args.job}", settings_of(args), master=args.master)
    try:
        if args.job == "check":
            return check(spark, topic_of(args))
        if args.job == "drop-gold":
            drop_table(spark, warehouse.gold)
            return 0
        if args.job == "repartition":
            if not args.state_partitions:
                raise SystemExit("repartition needs --state-partitions")
            made = repartition_state(spark, warehouse, args.state_partitions, args.bounded, args.salts)
            print(f"go on with --generation {made.generation}")
            return 0
        if args.attempts > 1 and not (args.seconds or args.until_idle):
            supervised(lambda: start(spark, args, warehouse), args.attempts)
            return 0
        query = start(spark, args, warehouse)
        if args.until_idle:
            run_until_idle(spark, query, seconds=args.seconds)
        elif args.seconds:
            run_for(query, args.seconds)
        else:
            query.awaitTermination()
        return 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
