"""The warehouse's jobs: ingest, layered build, forecasts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import month_bucket
from marketbars.operators.audit import most_copies, reject_duplicates
from marketbars.operators.enrich import enrich
from marketbars.operators.merge import upsert_by_key
from marketbars.operators.refresh import (
    changed_rows,
    differing_months,
    fingerprints,
    month_counts,
    refresh_tail,
)
from marketbars.operators.series import BLOCK
from marketbars.operators.summary import summarize
from marketbars.operators.trend import extend, fit_months, month_sums
from marketbars.operators.watermark import ingest_window, newest_dates, watermarks
from marketbars.sinks import tables as sinks
from marketbars.sinks.month_index import MonthIndex, in_months, refreshed
from marketbars.sources.feed import normalize_feed, read_feed
from marketbars.sources.ledger import (
    ensure_ledger,
    entries_of,
    files_to_open,
    list_files,
    next_run,
)
from marketbars.sources.tables import read_layer, stored_months, symbol_universe
from marketbars.storage import Stage, staging
from marketbars.streaming.landing import ingest_stream


# What a daily run knows of the months that it does not read.
FINGERPRINTS = MonthIndex(
    "fingerprints", "n BIGINT, one DECIMAL(38,0), two DECIMAL(38,0)", fingerprints
)
COUNTS = MonthIndex("counts", "symbol STRING, rows BIGINT", month_counts)
COPIES = MonthIndex("copies", "copies BIGINT", lambda bars: most_copies(bars, S.MONTH))
_SUMS = "symbol STRING, rows BIGINT, y DOUBLE, at_y DOUBLE, last_date DATE"
CLOSE_SUMS = MonthIndex("close_sums", _SUMS, lambda bars: month_sums(bars, "close"))
AVG_CLOSE_SUMS = MonthIndex("avg_close_sums", _SUMS, lambda bars: month_sums(bars, "avg_close"))


@dataclass(frozen=True)
class Tables:
    landing: str = S.LANDING_TABLE
    bronze: str = S.BRONZE_TABLE
    silver: str = S.SILVER_TABLE
    gold: str = S.GOLD_TABLE
    forecast_close: str = S.FORECAST_CLOSE_TABLE
    forecast_avg_close: str = S.FORECAST_AVG_CLOSE_TABLE


def ingest(
    spark: SparkSession,
    feed: DataFrame,
    as_of: dt.date | str,
    symbols: DataFrame | None = None,
    table: str = S.LANDING_TABLE,
    default_start: str = S.DEFAULT_START,
    on_bad: str = "error",
    quarantine_table: str | None = None,
) -> None:
    """Append the feed's new bars of all symbols to the landing table.

    ``feed`` is a normalized feed. Running it again loads nothing twice.
    """
    sinks.ensure_landing_table(spark, table)
    with staging(spark) as stage:
        marks = _marks(spark, symbols, table, default_start, stage)
        batch = ingest_window(feed, marks, as_of)
        sinks.append_absent(batch, table, on_bad, quarantine_table)


def _marks(
    spark: SparkSession, symbols: DataFrame | None, table: str, default_start: str, stage: Stage
) -> DataFrame:
    """The stored `watermarks` of a landing table, from its newest months."""
    symbols = symbol_universe(spark) if symbols is None else symbols
    held = spark.table(table).select("symbol", "date", S.MONTH)
    newest = newest_dates(symbols, held, stored_months(spark, table), stage)
    dated = newest.withColumnRenamed("max_date", "date")
    return stage(watermarks(symbols, dated, default_start))


def ingest_files(
    spark: SparkSession,
    folder: str,
    as_of: dt.date | str,
    symbols: DataFrame | None = None,
    table: str = S.LANDING_TABLE,
    default_start: str = S.DEFAULT_START,
    on_bad: str = "error",
    quarantine_table: str | None = None,
    fmt: str = "csv",
    symbol: Column | str | None = None,
    **options: str,
) -> int:
    """`ingest` from a folder that grows; returns how many files were opened.

    A ledger beside the table (``<table>__files``) knows the files that were
    read and what was left of them. Only new files, and those with rows that
    come into reach, are opened. The ledger is written after the rows: a run
    that was cut short, or a lost ledger, costs a reading and inserts nothing
    twice. ``symbol`` is `normalize_feed`'s, for files that do not name theirs.
    """
    sinks.ensure_landing_table(spark, table)
    files = f"{table}__files"
    ensure_ledger(spark, files)
    end = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=1)
    with staging(spark) as stage:
        marks = _marks(spark, symbols, table, default_start, stage)
        listing = stage(list_files(spark, folder, **options))
        opened = stage(files_to_open(listing, spark.table(files), marks, end))
        # Paths are on the driver anyway when Spark plans the scan.
        paths = sorted(r.path for r in opened.select("path").collect())
        if not paths:
            return 0
        feed = stage(normalize_feed(read_feed(spark, paths, fmt, **options), symbol))
        batch = ingest_window(feed, marks, as_of)
        sinks.append_absent(batch, table, on_bad, quarantine_table)
        entries = entries_of(opened, feed, marks, end, next_run(spark, files))
        entries.select(*spark.table(files).columns).write.insertInto(files)
        return len(paths)


def build_layers(
    spark: SparkSession,
    tables: Tables = Tables(),
    mode: str = "full",
    since: dt.date | str | None = None,
    rebuild: bool = False,
) -> None:
    """Bronze and silver by upsert, gold anew, from the landing table.

    ``mode='full'`` computes all of bronze and silver again. ``'tail'`` finds
    the landing rows that bronze lacks or holds differently and recomputes only
    what they reach; with ``since`` it looks for them from that date on only.
    ``rebuild`` replaces every layer, which also removes rows whose source row
    is gone; otherwise those stay.
    """
    if mode not in ("full", "tail"):
        raise ValueError(f"mode must be 'full' or 'tail', not {mode!r}")
    if since is not None and (rebuild or mode != "tail"):
        raise ValueError("since limits a tail build only")
    sinks.ensure_bronze_table(spark, tables.bronze)
    sinks.ensure_silver_table(spark, tables.silver)
    sinks.recover_swap(spark, tables.gold)
    if mode == "tail" and not rebuild:
        _build_tail(spark, tables, since)
        return
    landing = read_layer(spark, tables.landing, S.BAR_COLUMNS)
    _reject_copies(spark, tables.landing)
    if rebuild:
        sinks.write_reload(landing, tables.bronze)
        _rebuild(spark, tables)
        return
    sinks.write_upsert(landing, tables.bronze, check_unique=False, stored=True)
    silver = enrich(read_layer(spark, tables.bronze))
    sinks.write_upsert(silver, tables.silver, check_unique=False)
    sinks.write_rebuild(summarize(read_layer(spark, tables.silver)), tables.gold)


def _rebuild(spark: SparkSession, tables: Tables) -> None:
    """Silver and gold from one pass over bronze.

    The enriched series are stored as they lie after their one shuffle, by symbol and
    block. Both layers are written from there, and gold needs no shuffle before
    its rows are dealt to months.
    """
    series = f"{tables.silver}__series"
    sinks.write_series(enrich(read_layer(spark, tables.bronze), keep_block=True), series)
    rows = spark.table(series)
    sinks.write_reload(rows.drop(BLOCK), tables.silver)
    sinks.write_rebuild(summarize(rows, also_by=(BLOCK,)), tables.gold)
    spark.sql(f"DROP TABLE {series}")


def _reject_copies(spark: SparkSession, table: str) -> None:
    """Fail on a repeated key. Months that were found free of them are not read."""
    copied = refreshed(spark, table, COPIES).where(F.col("copies") > 1)
    months = [r[S.MONTH] for r in copied.select(S.MONTH).collect()]
    if months:
        reject_duplicates(spark.table(table).where(in_months(months)))


def _build_tail(spark: SparkSession, tables: Tables, since: dt.date | str | None) -> None:
    """Bring the layers up to date month by month.

    Months are known by their stored fingerprints; those whose files are the same
    are not read for them again. Only months that differ are compared row by row
    and checked for repeated keys; only what their changes reach is computed
    again, from stored row counts and the bars of the months around them, and only
    the months of those rows are written. Silver and gold go first and bronze
    last: after a failure in between, the next run still finds the same changes
    in bronze and does all of it again.
    """
    held, landed = (refreshed(spark, t, FINGERPRINTS) for t in (tables.bronze, tables.landing))
    months = differing_months(held, landed)
    new, old = (spark.table(t) for t in (tables.landing, tables.bronze))
    if since is not None:
        first = dt.date.fromisoformat(str(since))
        months = [m for m in months if m >= first.replace(day=1)]
        new, old = (t.where(F.col("date") >= F.lit(first)) for t in (new, old))
    if not months and spark.catalog.tableExists(tables.gold):
        return
    _reject_copies(spark, tables.landing)
    with staging(spark) as stage:
        changed = changed_rows(*(t.where(in_months(months)) for t in (old, new)))
        _follow(spark, tables, stage(changed), stage)


def _follow(spark: SparkSession, tables: Tables, changed: DataFrame, stage: Stage) -> None:
    """Take changed bars, not yet in bronze, over into all layers."""
    dated = changed.withColumn(S.MONTH, month_bucket("date"))
    bronze = upsert_by_key(spark.table(tables.bronze), dated)
    counts = refreshed(spark, tables.bronze, COUNTS)
    tail = stage(refresh_tail(bronze, changed, stage=stage, counts=counts))
    sinks.write_upsert(tail, tables.silver, check_unique=False, stored=True)
    written = tail.select(month_bucket("date").alias(S.MONTH)).distinct()
    _write_gold(spark, tables, [r[0] for r in written.collect()])
    sinks.write_upsert(changed, tables.bronze, check_unique=False, stored=True)


def refresh_keys(spark: SparkSession, tables: Tables, keys: DataFrame) -> None:
    """Bring the layers up to date with the landing rows of some stored keys.

    A change feed: only the months of the keys are compared, and nothing is looked
    for elsewhere. Rows that bronze holds already are no change, so that keys
    may come again.
    """
    with staging(spark) as stage:
        dated = keys.select(*S.KEY).dropna().distinct()
        dated = stage(dated.withColumn(S.MONTH, month_bucket("date")))
        near = in_months(r[0] for r in dated.select(S.MONTH).distinct().collect())
        landed = spark.table(tables.landing).where(near)
        landed = landed.join(dated, [S.MONTH, *S.KEY], "left_semi")
        changed = stage(changed_rows(spark.table(tables.bronze).where(near), landed))
        if not changed.isEmpty():
            _follow(spark, tables, changed, stage)


def stream_layers(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    tables: Tables = Tables(),
    fmt: str = "csv",
    on_bad: str = "error",
    quarantine_table: str | None = None,
    **options: str,
) -> None:
    """Load the files that came since the last call and take them into all layers.

    Each micro-batch is inserted and its keys are handed on to `refresh_keys`. A
    batch that is delivered again after a failure in between inserts nothing,
    and its keys are followed up again.
    """
    sinks.ensure_bronze_table(spark, tables.bronze)
    sinks.ensure_silver_table(spark, tables.silver)
    sinks.recover_swap(spark, tables.gold)

    def follow(batch: DataFrame) -> None:
        refresh_keys(batch.sparkSession, tables, batch)

    target = tables.landing, checkpoint, fmt, on_bad, quarantine_table
    ingest_stream(spark, folder, *target, follow, **options)
    for table in (tables.bronze, tables.silver, tables.gold):
        if spark.catalog.tableExists(table):
            spark.catalog.refreshTable(table)


def _write_gold(spark: SparkSession, tables: Tables, months: list[dt.date]) -> None:
    """Gold rows depend on silver's of the same month only."""
    silver = spark.table(tables.silver)
    if not (spark.catalog.tableExists(tables.gold) and S.MONTH in spark.table(tables.gold).columns):
        sinks.write_rebuild(summarize(read_layer(spark, tables.silver)), tables.gold)
        return
    sinks.write_months(summarize(silver.where(in_months(months)).drop(S.MONTH)), tables.gold)


def forecast_close(
    spark: SparkSession, tables: Tables = Tables(), horizon: int = S.HORIZON_DAYS
) -> None:
    """Replace the forecast made from silver closes.

    Lines come from sums kept by symbol and month: only months whose files
    changed since the last forecast are read.
    """
    sinks.ensure_forecast_table(spark, tables.forecast_close)
    lines = fit_months(refreshed(spark, tables.silver, CLOSE_SUMS))
    sinks.write_replace(extend(lines, horizon), tables.forecast_close)


def forecast_avg_close(
    spark: SparkSession, tables: Tables = Tables(), horizon: int = S.HORIZON_DAYS
) -> None:
    """Replace the forecast made from gold average closes; see `forecast_close`."""
    sinks.ensure_forecast_table(spark, tables.forecast_avg_close)
    sinks.recover_swap(spark, tables.gold)
    lines = fit_months(refreshed(spark, tables.gold, AVG_CLOSE_SUMS))
    sinks.write_replace(extend(lines, horizon), tables.forecast_avg_close)
