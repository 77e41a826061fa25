"""Command line: ``python -m tradewind <command> --help``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from tradewind import schemas
from tradewind.functions import utc_now
from tradewind.operators import orders, reports
from tradewind.operators.items import (
    attach_descriptions,
    attach_reviews,
    drop_empty,
    seller_listings,
    with_seller,
)
from tradewind.plans.items_run import run_items
from tradewind.plans.orders_run import run_orders
from tradewind.plans.replay import CORRECTIONS, replay_orders
from tradewind.plans.staging import staging
from tradewind.plans.tables import PARTS, TableStore
from tradewind.session import build_session, shuffle_partitions
from tradewind.sources.landing import ARRIVAL, CORRUPT, read_landing, with_arrival
from tradewind.streaming.orders_stream import run_orders_stream

def _items(spark: SparkSession, args: argparse.Namespace) -> int:
    landed = with_arrival(read_landing(spark, args.landing, schemas.RAW_ITEM, args.format))
    outcomes = run_items(
        TableStore(spark, args.root), landed, args.run_id, utc_now(), ARRIVAL, args.limit,
        sellers=args.seller,
    )
    summary = reports.run_summary(outcomes).first()
    print(json.dumps(summary.asDict()))
    return 0 if summary.successful == summary.total > 0 else 1


def _extract(spark: SparkSession, args: argparse.Namespace) -> int:
    def staged(name: str, path: str, schema: str) -> DataFrame:
        # Row numbers of a file scan must not change between two reads.
        return stage.put(name, with_arrival(read_landing(spark, path, schema, args.format)))

    with staging(spark) as stage:
        listings = drop_empty(with_seller(staged("listings", args.landing, schemas.RAW_ITEM)))
        found = seller_listings(listings, ARRIVAL, args.limit, sellers=args.seller)
        if args.descriptions:
            texts = staged("descriptions", args.descriptions, schemas.RAW_DESCRIPTION)
            found = attach_descriptions(found, texts, ARRIVAL)
        if args.reviews:
            reviews = staged("reviews", args.reviews, schemas.RAW_REVIEW)
            found = attach_reviews(found, reviews, ARRIVAL)
        found.drop(ARRIVAL, CORRUPT).write.format(args.format).save(args.out)
    return 0


def _orders(spark: SparkSession, args: argparse.Namespace) -> int:
    store = TableStore(spark, args.root)
    bounds = {"start": args.start_date, "end": args.end_date, "sellers": args.seller}
    if args.checkpoint:
        run_orders_stream(
            store, args.landing, args.checkpoint, args.run_id, utc_now(), fmt=args.format, **bounds
        )
    else:
        landed = with_arrival(read_landing(spark, args.landing, schemas.RAW_ORDER, args.format))
        run_orders(store, landed, args.run_id, utc_now(), ARRIVAL, **bounds)
    return 0


def _replay(spark: SparkSession, args: argparse.Namespace) -> int:
    texts = spark.read.schema(CORRECTIONS).json(args.corrections) if args.corrections else None
    replay_orders(TableStore(spark, args.root), args.run_id, utc_now(), texts)
    return 0


def _stats(spark: SparkSession, args: argparse.Namespace) -> int:
    store = TableStore(spark, args.root)
    stats = reports.stats_of_days(store.read("order_days"), store.read("etl_state"), args.seller)
    document = reports.stats_json(stats).first()
    print(json.dumps(json.loads(document.stats) if document else {"order_counts": {}}, indent=2))
    return 0


def _last_orders(spark: SparkSession, args: argparse.Namespace) -> int:
    landed = with_arrival(read_landing(spark, args.landing, schemas.RAW_ORDER, args.format))
    with staging(spark) as stage:
        # Row numbers of a file scan must not change between two reads.
        own = stage.put("own", orders.for_sellers(landed, [args.seller]))
        return _print_newest(reports.last_order_documents(own, ARRIVAL, args.n))


def _print_newest(newest: DataFrame) -> int:
    found = sorted(newest.collect(), key=lambda r: (r.date_created, r.id), reverse=True)
    print(json.dumps({"orders": [json.loads(r.document) for r in found]}, indent=2))
    return 0


def _sellers(spark: SparkSession, args: argparse.Namespace) -> int:
    listings = with_arrival(read_landing(spark, args.landing, schemas.RAW_ITEM, args.format))
    users = with_arrival(read_landing(spark, args.users, schemas.RAW_USER, args.format))
    choose = reports.category_sellers if args.out else reports.quick_sellers
    with staging(spark) as stage:
        listings = with_seller(listings).select("id", "seller_id", "category_id", ARRIVAL)
        listings = stage.put("listings", listings)
        users = stage.put("users", users.select("id", "nickname", ARRIVAL))
        found = choose(listings, ARRIVAL, args.category)
        return _print_sellers(spark, args, reports.with_nicknames(found, users, ARRIVAL))


def _print_sellers(spark: SparkSession, args: argparse.Namespace, named: DataFrame) -> int:
    if args.out:
        named.write.csv(args.out, header=True)
        print(json.dumps({"sellers": spark.read.csv(args.out, header=True).count()}))
    else:
        for row in named.collect():
            print(f"{row.seller_id}\t{row.nickname}")
    return 0


def _init(spark: SparkSession, args: argparse.Namespace) -> int:
    TableStore(spark, args.root, args.parts).init_tables()
    return 0


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tradewind", description=__doc__)
    parser.add_argument(
        "--input-gb", type=int, help="size of the input, to choose the shuffle partitions"
    )
    commands = parser.add_subparsers(required=True)

    def command(name, run, help, root=True, landing=True):
        sub = commands.add_parser(name, help=help)
        sub.set_defaults(run=run)
        if root:
            sub.add_argument("--root", required=True, help="folder of the target tables")
        if landing:
            sub.add_argument("--landing", required=True, help="folder of landed documents")
            sub.add_argument("--format", default="json", choices=("json", "parquet"))
        return sub

    def run_options(sub):
        sub.add_argument("--seller", type=int, action="append", help="repeatable; default all")
        sub.add_argument("--run-id", default=f"run-{utc_now().isoformat()}")

    sub = command("init", _init, "create the tables", landing=False)
    sub.add_argument("--parts", type=int, default=PARTS, help="hash parts of the larger tables")
    sub = command("items", _items, "load listings")
    run_options(sub)
    sub.add_argument("--limit", type=int, help="listings per seller; default all")
    sub = command("extract", _extract, "write active listings as they are", root=False)
    sub.add_argument("--seller", type=int, action="append", help="repeatable; default all")
    sub.add_argument("--limit", type=int, help="listings per seller; default all")
    sub.add_argument("--descriptions", help="folder of landed descriptions to attach")
    sub.add_argument("--reviews", help="folder of landed reviews to attach")
    sub.add_argument("--out", required=True, help="folder to write")
    sub = command("orders", _orders, "load orders")
    run_options(sub)
    sub.add_argument("--start-date", help="ISO date or time, inclusive")
    sub.add_argument("--end-date", help="ISO date or time, inclusive; a date is its midnight")
    sub.add_argument("--checkpoint", help="follow new files, noting progress in this folder")
    sub = command("replay", _replay, "load rejected orders again", landing=False)
    sub.add_argument("--run-id", default=f"run-{utc_now().isoformat()}")
    sub.add_argument("--corrections", help="JSON lines of entry and corrected document; default: all")
    sub = command("stats", _stats, "print a seller's order statistics", landing=False)
    sub.add_argument("--seller", type=int, required=True)
    sub = command("last-orders", _last_orders, "print a seller's newest orders", root=False)
    sub.add_argument("--seller", type=int, required=True)
    sub.add_argument("-n", type=int, default=2)
    sub = command("sellers", _sellers, "sellers of a category", root=False)
    sub.add_argument("--users", required=True, help="folder of landed users")
    sub.add_argument("--category", required=True)
    sub.add_argument("--out", help="write all sellers here; default: print those of 10 listings")
    return parser


def main(arguments: list[str] | None = None) -> int:
    args = _parser().parse_args(arguments)
    partitions = shuffle_partitions(args.input_gb << 30) if args.input_gb else None
    return args.run(build_session("tradewind", partitions=partitions), args)


if __name__ == "__main__":
    sys.exit(main())
