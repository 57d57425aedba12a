"""The jobs from the command line."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.plans import jobs
from marketbars.session import builder
from marketbars.sources.feed import ARRIVAL
from marketbars.sources.tables import distinct_symbols, symbol_universe
from marketbars.streaming.landing import ingest_stream


def _feed_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("feed", help="folder of landing files")
    parser.add_argument("--format", default="csv")
    parser.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE", help="of the reader"
    )
    parser.add_argument("--quarantine", metavar="TABLE", help="for rows that bar tables refuse")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marketbars", description=__doc__)
    parser.add_argument("--database", help="database of the tables, default the current one")
    parser.add_argument(
        "--shuffled-gb", type=float, help="size of the largest shuffle; sets its partitions"
    )
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="load the feed's new bars")
    _feed_arguments(ingest)
    ingest.add_argument("--as-of", type=dt.date.fromisoformat, required=True)
    ingest.add_argument("--symbols", nargs="+", default=list(S.DEFAULT_SYMBOLS))
    ingest.add_argument("--symbols-table", help="table with a symbol column, instead")
    ingest.add_argument(
        "--symbol-in-path", metavar="PATTERN", help="its first group is the symbol of a file"
    )
    ingest.add_argument("--start", default=S.DEFAULT_START, help="first date of a new symbol")

    stream = commands.add_parser("stream", help="load the files new since the last run")
    _feed_arguments(stream)
    stream.add_argument("--checkpoint", required=True)

    build = commands.add_parser("build", help="bring the layers up to date")
    build.add_argument("--mode", choices=("full", "tail"), default="full")
    build.add_argument("--since", type=dt.date.fromisoformat)
    build.add_argument("--rebuild", action="store_true")

    forecast = commands.add_parser("forecast", help="replace both forecasts")
    forecast.add_argument("--horizon", type=int, default=S.HORIZON_DAYS)
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    shuffled = None if args.shuffled_gb is None else int(args.shuffled_gb * 2**30)
    spark = spark or builder(shuffled_bytes=shuffled).getOrCreate()
    tables = jobs.Tables()
    if args.database:
        tables = jobs.Tables(**{k: f"{args.database}.{v}" for k, v in vars(tables).items()})
    if args.command in ("ingest", "stream"):
        options = dict(option.split("=", 1) for option in args.option)
        bad = ("quarantine", args.quarantine) if args.quarantine else ("error", None)
    if args.command == "ingest":
        if args.symbols_table:
            symbols = distinct_symbols(spark.table(args.symbols_table))
        else:
            symbols = symbol_universe(spark, args.symbols)
        symbol = None
        if args.symbol_in_path:
            symbol = F.regexp_extract(f"{ARRIVAL}.file", args.symbol_in_path, 1)
        target = args.as_of, symbols, tables.landing, args.start
        jobs.ingest_files(spark, args.feed, *target, *bad, args.format, symbol, **options)
    elif args.command == "stream":
        ingest_stream(
            spark, args.feed, tables.landing, args.checkpoint, args.format, *bad, **options
        )
    elif args.command == "build":
        jobs.build_layers(spark, tables, args.mode, args.since, args.rebuild)
    else:
        jobs.forecast_close(spark, tables, args.horizon)
        jobs.forecast_avg_close(spark, tables, args.horizon)
