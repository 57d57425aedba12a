"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import month_bucket
from marketbars.operators import audit, merge, series, summary, trend
from marketbars.operators import watermark as wm
from marketbars.operators.enrich import (
    enrich,
    with_changes,
    with_month_volatility,
    with_moving_average,
)
from marketbars.operators.refresh import refresh_tail
from marketbars.plans import jobs
from marketbars.sinks import tables as sinks
from marketbars.sources import tables as layers
from marketbars.sources.feed import ARRIVAL, normalize_feed, read_feed
from marketbars.sources.tape import (
    bars_from_events,
    bars_from_lineitem,
    trades_from_lineitem,
)
from marketbars.storage import at_end, new_folder, stage
from marketbars.streaming.landing import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# The stored part of the data in the incremental queries: bars before SPLIT of
# all symbols but one. The feed is all bars.
SPLIT = "2000-01-01"
NEW_SYMBOL = "Brand#11"
FEED_START = "1999-12-01"
AS_OF = "2001-01-02"
NAN = -1e30
NAN_COLUMNS = ("prev_close", "daily_change", "daily_change_percent", "weekly_ma", "monthly_ma")


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars, stored: for plans that read them in several places."""
    return stage(bars_from_lineitem(spark, sf_dir))


def _closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored closes: for operators that look at no other column."""
    return stage(bars_from_lineitem(spark, sf_dir).select("date", "symbol", "close"))


def _target(bars: DataFrame) -> DataFrame:
    return bars.where((F.col("date") < F.lit(SPLIT).cast("date")) & (F.col("symbol") != NEW_SYMBOL))


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return layers.distinct_symbols(part.select(F.col("p_brand").alias("symbol")))


def _as_feed(bars: DataFrame) -> DataFrame:
    """Bars as a landing feed holds them: late local timestamps, odd names, extras."""
    return bars.select(
        F.concat(F.col("date").cast("string"), F.lit(" 23:00:00-05:00")).alias("Date"),
        F.col("symbol").alias("Symbol"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
        F.col("dividends").alias("Dividends"),
        F.col("stock_splits").alias("Stock Splits"),
        F.lit(0).cast("bigint").alias("seq"),
    )


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Sums in another order differ in the last bits; see the oracle's rounding."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def bars_lineitem(spark, sf_dir):
    return bars_from_lineitem(spark, sf_dir)


def bars_events(spark, sf_dir):
    return bars_from_events(spark, sf_dir)


def bronze(spark, sf_dir):
    return layers.bar_columns(bars_from_lineitem(spark, sf_dir).withColumn("extra", F.lit(1)))


def symbol_slice(spark, sf_dir):
    return layers.symbol_slice(bars_from_lineitem(spark, sf_dir), NEW_SYMBOL)


def history(spark, sf_dir):
    return layers.history(bars_from_lineitem(spark, sf_dir), NEW_SYMBOL, FEED_START, AS_OF)


def distinct_symbols(spark, sf_dir):
    return layers.distinct_symbols(bars_from_lineitem(spark, sf_dir))


def normalize(spark, sf_dir):
    feed = _as_feed(bars_from_events(spark, sf_dir)).withColumn("Capital Gains", F.lit(0.0))
    return normalize_feed(feed)


def _marks(spark, sf_dir, bars):
    return wm.watermarks(_symbols(spark, sf_dir), _target(bars), FEED_START)


def watermarks(spark, sf_dir):
    return _marks(spark, sf_dir, bars_from_lineitem(spark, sf_dir))


def ingest_window(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    return wm.ingest_window(bars, stage(_marks(spark, sf_dir, bars)), AS_OF)


def _batch(bars: DataFrame) -> DataFrame:
    """Recent bars, restated by one price unit."""
    return bars.where(F.col("date") >= F.lit(FEED_START).cast("date")).withColumn(
        "close", F.col("close") + 1
    )


def insert_if_absent(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    target = bars.where(F.col("date") < F.lit(SPLIT).cast("date"))
    return merge.insert_if_absent(target, _batch(bars))


def upsert_by_key(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    target = bars.where(F.col("date") < F.lit(SPLIT).cast("date"))
    return merge.upsert_by_key(target, _batch(bars))


def first_per_key(spark, sf_dir):
    """The first order line of each (date, brand): repeated keys in one batch."""
    arrival = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(ARRIVAL)
    batch = trades_from_lineitem(spark, sf_dir).select(
        "date", "symbol", arrival, "l_quantity", "l_extendedprice"
    )
    return merge.first_per_key(batch)


def ingest_increment(spark, sf_dir):
    """Watermark, window and insert-if-absent: the table after one load."""
    bars = _bars(spark, sf_dir)
    target = _target(bars)
    marks = stage(_marks(spark, sf_dir, bars))
    feed = normalize_feed(_as_feed(bars))
    return merge.insert_if_absent(target, stage(wm.ingest_window(feed, marks, AS_OF)))


def _database(spark: SparkSession) -> tuple[str, str]:
    """A new database whose tables lie in the shared folder."""
    folder = new_folder(spark)
    name = f"marketbars_{folder.rsplit('/', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    at_end(lambda: spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE"))
    return name, folder


def ingest_stream_query(spark, sf_dir):
    """Bars written as landing files, loaded by the stream, read from the table."""
    database, folder = _database(spark)
    feed = f"{folder}/feed"
    _as_feed(bars_from_lineitem(spark, sf_dir)).write.option("header", "true").csv(feed)
    ingest_stream(spark, feed, f"{database}.stock_data", f"{folder}/checkpoint")
    return layers.read_layer(spark, f"{database}.stock_data")


def stream_layers_query(spark, sf_dir):
    """Two sets of files taken into gold by the stream, the second a change feed."""
    database, folder = _database(spark)
    tables = jobs.Tables(**{k: f"{database}.{v}" for k, v in vars(jobs.Tables()).items()})
    bars = _bars(spark, sf_dir)
    # Rows of all years in both sets: changes reach rows that are stored.
    odd = F.dayofmonth("date") % 2 == 1
    for part in (odd, ~odd):
        files = _as_feed(bars.where(part)).write.mode("append").option("header", "true")
        files.csv(f"{folder}/feed")
        jobs.stream_layers(spark, f"{folder}/feed", f"{folder}/checkpoint", tables)
    return _rounded(layers.read_layer(spark, tables.gold), 6, "avg_monthly_volatility")


def _table_with(spark: SparkSession, rows: DataFrame) -> str:
    table = f"{_database(spark)[0]}.stock_data"
    sinks.ensure_landing_table(spark, table)
    sinks.append_absent(rows, table)
    return table


def table_insert(spark, sf_dir):
    """`insert_if_absent` on a stored table."""
    bars = _bars(spark, sf_dir)
    table = _table_with(spark, bars.where(F.col("date") < F.lit(SPLIT).cast("date")))
    sinks.append_absent(_batch(bars), table)
    return layers.read_layer(spark, table)


def table_upsert(spark, sf_dir):
    """`upsert_by_key` on a stored table."""
    bars = _bars(spark, sf_dir)
    table = _table_with(spark, bars.where(F.col("date") < F.lit(SPLIT).cast("date")))
    sinks.write_upsert(_batch(bars), table)
    return layers.read_layer(spark, table)


def _warehouse(spark: SparkSession, sf_dir: str) -> jobs.Tables:
    """All bars ingested and built into layers, through the stored tables."""
    database = _database(spark)[0]
    tables = jobs.Tables(**{k: f"{database}.{v}" for k, v in vars(jobs.Tables()).items()})
    feed = normalize_feed(_as_feed(bars_from_lineitem(spark, sf_dir)))
    symbols = _symbols(spark, sf_dir)
    jobs.ingest(spark, feed, "2100-01-01", symbols, tables.landing, default_start="1900-01-01")
    jobs.build_layers(spark, tables)
    return tables


def build_layers(spark, sf_dir):
    """The stored gold layer after ingest and build."""
    gold = layers.read_layer(spark, _warehouse(spark, sf_dir).gold)
    return _rounded(gold, 6, "avg_monthly_volatility")


def build_layers_tail(spark, sf_dir):
    """Gold after early and late bars were restated and the layers' tail was built."""
    tables = _warehouse(spark, sf_dir)
    _restate(spark, tables)
    jobs.build_layers(spark, tables, mode="tail")
    return _rounded(layers.read_layer(spark, tables.gold), 6, "avg_monthly_volatility")


def _restate(spark: SparkSession, tables: jobs.Tables) -> None:
    """Early and late bars of the landing table, restated by one price unit."""
    landing = layers.read_layer(spark, tables.landing)
    late = F.col("date") >= F.lit("2000-11-15").cast("date")
    early = landing.groupBy("symbol").agg(F.min("date").alias("date"))
    restated = stage(
        landing.where(late)
        .unionByName(landing.join(early, ["symbol", "date"]).select(*S.BAR_COLUMNS))
        .distinct()
        .withColumn("close", F.col("close") + 1)
    )
    sinks.write_upsert(restated, tables.landing)


def forecast_after_tail(spark, sf_dir):
    """The stored forecast after a first one, restated bars and a tail build.

    The second fit reads the sums that the first one stored, but for months that changed.
    """
    tables = _warehouse(spark, sf_dir)
    jobs.forecast_close(spark, tables)
    _restate(spark, tables)
    jobs.build_layers(spark, tables, mode="tail")
    jobs.forecast_close(spark, tables)
    return _rounded(spark.table(tables.forecast_close), 3, "predicted_close")


def rebuild_layers(spark, sf_dir):
    """Gold after all layers were replaced."""
    tables = _warehouse(spark, sf_dir)
    jobs.build_layers(spark, tables, rebuild=True)
    return _rounded(layers.read_layer(spark, tables.gold), 6, "avg_monthly_volatility")


def build_forecast_close(spark, sf_dir):
    """The stored forecast from silver after ingest, build and forecast."""
    tables = _warehouse(spark, sf_dir)
    jobs.forecast_close(spark, tables)
    return _rounded(spark.table(tables.forecast_close), 3, "predicted_close")


def quarantine_insert(spark, sf_dir):
    """What is set aside when a batch with bad rows is inserted twice."""
    table = f"{_database(spark)[0]}.stock_data"
    sinks.ensure_landing_table(spark, table)
    batch = stage(_marked(spark, sf_dir))
    for _ in range(2):
        sinks.append_absent(batch, table, "quarantine", f"{table}_aside")
    return spark.table(f"{table}_aside")


def build_forecast(spark, sf_dir):
    """The stored forecast from gold after ingest, build and forecast."""
    tables = _warehouse(spark, sf_dir)
    jobs.forecast_avg_close(spark, tables)
    return _rounded(spark.table(tables.forecast_avg_close), 3, "predicted_close")


def ingest_plain_feed(spark, sf_dir):
    """Files as a market data client writes them: symbol last, a further column, no `seq`."""
    database, folder = _database(spark)
    plain = _as_feed(bars_from_lineitem(spark, sf_dir)).withColumn("Capital Gains", F.lit(0.0))
    order = ("Date", "Open", "High", "Low", "Close", "Volume", "Dividends", "Stock Splits")
    files = plain.select(*order, "Capital Gains", "Symbol")
    files.write.option("header", "true").csv(f"{folder}/feed")
    feed = normalize_feed(read_feed(spark, f"{folder}/feed"))
    table = f"{database}.stock_data"
    jobs.ingest(spark, feed, "2100-01-01", _symbols(spark, sf_dir), table, "1900-01-01")
    return layers.read_layer(spark, table)


def ingest_grown_folder(spark, sf_dir):
    """Two loads of a folder that grew between them; the second opens the new files only."""
    database, folder = _database(spark)
    bars, table = _bars(spark, sf_dir), f"{database}.stock_data"
    older = F.col("date") < F.lit(SPLIT).cast("date")
    for part in (older, ~older):
        files = _as_feed(bars.where(part)).write.mode("append").option("header", "true")
        files.csv(f"{folder}/feed")
        target = "2100-01-01", _symbols(spark, sf_dir), table, "1900-01-01"
        jobs.ingest_files(spark, f"{folder}/feed", *target)
    return layers.read_layer(spark, table)


def ingest_symbol_files(spark, sf_dir):
    """A folder for each symbol, whose files do not name it."""
    database, folder = _database(spark)
    feed = _as_feed(bars_from_lineitem(spark, sf_dir))
    by_symbol = feed.withColumn("ticker", F.replace("Symbol", F.lit("#"), F.lit("-"))).drop("Symbol")
    by_symbol.write.partitionBy("ticker").option("header", "true").csv(f"{folder}/feed")
    ticker = F.regexp_extract(f"{ARRIVAL}.file", "/ticker=([^/]+)/", 1)
    jobs.ingest_files(
        spark,
        f"{folder}/feed",
        "2100-01-01",
        _symbols(spark, sf_dir),
        f"{database}.stock_data",
        "1900-01-01",
        symbol=F.replace(ticker, F.lit("-"), F.lit("#")),
        recursiveFileLookup="true",
    )
    return layers.read_layer(spark, f"{database}.stock_data")


def read_feed_query(spark, sf_dir):
    """Bars written as CSV landing files and read back through the feed schema."""
    path = new_folder(spark)
    _as_feed(bars_from_events(spark, sf_dir)).write.option("header", "true").csv(path)
    return normalize_feed(read_feed(spark, path)).drop(ARRIVAL)


def silver_not_null_keys(spark, sf_dir):
    bars = bars_from_lineitem(spark, sf_dir)
    # Losing trades lose their date, falling ones their symbol.
    holes = bars.withColumns(
        {
            "date": F.when(F.col("close") != F.col("low"), F.col("date")),
            "symbol": F.when(F.col("open") != F.col("high"), F.col("symbol")),
        }
    )
    return series.keyed_rows(holes)


def prev_close(spark, sf_dir):
    return with_changes(_closes(spark, sf_dir)).select("date", "symbol", "close", "prev_close")


def daily_change(spark, sf_dir):
    return with_changes(_closes(spark, sf_dir)).select("date", "symbol", "daily_change")


def daily_change_percent(spark, sf_dir):
    return with_changes(_closes(spark, sf_dir)).select("date", "symbol", "daily_change_percent")


def weekly_ma(spark, sf_dir):
    bars = _closes(spark, sf_dir)
    return with_moving_average(bars, "weekly_ma", S.WEEKLY_ROWS).select(
        "date", "symbol", "weekly_ma"
    )


def monthly_ma(spark, sf_dir):
    bars = _closes(spark, sf_dir)
    return with_moving_average(bars, "monthly_ma", S.MONTHLY_ROWS).select(
        "date", "symbol", "monthly_ma"
    )


def month_bucket_query(spark, sf_dir):
    bars = bars_from_lineitem(spark, sf_dir)
    return bars.select("date", "symbol", month_bucket("date").alias("month"))


def monthly_volatility(spark, sf_dir):
    rows = with_month_volatility(with_changes(_closes(spark, sf_dir), keep_block=True))
    return _rounded(rows, 6, "monthly_volatility").select("date", "symbol", "monthly_volatility")


def silver(spark, sf_dir):
    return _rounded(enrich(_bars(spark, sf_dir)), 6, "monthly_volatility")


def silver_sparse(spark, sf_dir):
    """One series per user: gaps between days, months of a single bar."""
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    bars = stage(bars_from_events(spark, sf_dir, user))
    return _rounded(
        enrich(bars, on_zero="null"),
        6,
        "prev_close",
        "daily_change",
        "daily_change_percent",
        "weekly_ma",
        "monthly_ma",
        "monthly_volatility",
    )


def silver_early(spark, sf_dir):
    """Silver kept up to date after a few early bars were restated."""
    before = _bars(spark, sf_dir)
    early = before.groupBy("symbol").agg(F.min("date").alias("date"))
    changed = stage(
        before.join(early, ["symbol", "date"]).withColumn("close", F.col("close") + 1)
    ).select(*S.BAR_COLUMNS)
    tail = stage(refresh_tail(merge.upsert_by_key(before, changed), changed))
    return _rounded(merge.upsert_by_key(enrich(before), tail), 6, "monthly_volatility")


def silver_tail(spark, sf_dir):
    """Silver kept up to date after restated bars: only their reach is computed."""
    before = _bars(spark, sf_dir)
    changed = stage(
        before.where(F.col("date") >= F.lit("2000-11-15").cast("date")).withColumn(
            "close", F.col("close") + 1
        )
    )
    tail = stage(refresh_tail(merge.upsert_by_key(before, changed), changed))
    return _rounded(merge.upsert_by_key(enrich(before), tail), 6, "monthly_volatility")


def _gold(spark, sf_dir):
    silver = enrich(_bars(spark, sf_dir), keep_block=True)
    return summary.summarize(silver, also_by=(series.BLOCK,))


def daily_summary(spark, sf_dir):
    silver = enrich(_bars(spark, sf_dir), keep_block=True)
    result = summary.daily_summary(silver, also_by=(series.BLOCK,))
    return _rounded(result, 6, "avg_monthly_volatility")


def classify_anomaly(spark, sf_dir):
    changes = with_changes(_closes(spark, sf_dir)).select(
        "date", "symbol", F.col("daily_change_percent").alias("avg_daily_change_percent")
    )
    return summary.classify_anomaly(changes)


def gold(spark, sf_dir):
    return _rounded(_gold(spark, sf_dir), 6, "avg_monthly_volatility")


def day_index(spark, sf_dir):
    return trend.day_index(_closes(spark, sf_dir), "close")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver stored by series, in buckets of symbol and block."""
    table = f"{_database(spark)[0]}.series"
    sinks.write_series(enrich(_bars(spark, sf_dir), keep_block=True), table)
    return spark.table(table)


def day_index_series(spark, sf_dir):
    """`day_index` on a layer stored by series: its rows are not shuffled."""
    return trend.day_index(_series(spark, sf_dir), "close")


def forecast_series(spark, sf_dir):
    """The forecast from a layer stored by series: its rows are not shuffled."""
    return _rounded(trend.forecast(_series(spark, sf_dir), "close"), 3, "predicted_close")


def fit_trend(spark, sf_dir):
    fit = trend.fit_trend(bars_from_lineitem(spark, sf_dir), "close")
    return _rounded(_rounded(fit, 3, "intercept"), 6, "slope")


def forecast_close(spark, sf_dir):
    # The forecast needs no column the enrichment adds: silver's close is the
    # bar's, and rows without a key are dropped in both.
    result = trend.forecast(bars_from_lineitem(spark, sf_dir), "close")
    return _rounded(result, 3, "predicted_close")


def forecast_avg_close(spark, sf_dir):
    return _rounded(trend.forecast(_gold(spark, sf_dir), "avg_close"), 3, "predicted_close")


def forecast_row_counts(spark, sf_dir):
    result = trend.forecast(bars_from_lineitem(spark, sf_dir), "close")
    return result.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def audit_nulls(spark, sf_dir):
    bars = bars_from_lineitem(spark, sf_dir)
    holes = bars.withColumn("close", F.when(F.col("close") >= F.col("open"), F.col("close")))
    return audit.audit_nulls(holes, ("date", "symbol", "close"))


def audit_duplicates(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return audit.audit_duplicates(lineitem, ("l_orderkey", "l_linenumber"))


def audit_length(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return audit.audit_length(part, "p_name")


def edge_nulls(spark, sf_dir):
    """Falling days have no close: NULL before, at and after a row."""
    bars = bars_from_lineitem(spark, sf_dir)
    holes = bars.withColumn("close", F.when(F.col("close") >= F.col("open"), F.col("close")))
    return _rounded(enrich(stage(holes)), 6, "monthly_volatility")


def edge_nan(spark, sf_dir):
    """Flat days have a NaN close: it reaches changes, averages and labels."""
    bars = bars_from_lineitem(spark, sf_dir)
    flat = F.col("high") == F.col("low")
    close = F.when(flat, F.lit(float("nan"))).otherwise(F.col("close"))
    nans = stage(bars.withColumn("close", close))
    labelled = summary.classify_anomaly(enrich(nans), percent="daily_change_percent")
    # NaN reads as NULL in some clients, so another number stands for it.
    marked = {c: F.nanvl(F.round(c, 6), F.lit(float(NAN))) for c in NAN_COLUMNS}
    return labelled.withColumns(marked).select("date", "symbol", "anomaly_type", *NAN_COLUMNS)


def edge_thresholds(spark, sf_dir):
    """Whole percents, so that the limits themselves occur; zero becomes NULL."""
    whole = F.nullif(F.floor("daily_change_percent").cast("double"), F.lit(0.0))
    changes = with_changes(_closes(spark, sf_dir)).select(
        "date", "symbol", whole.alias("avg_daily_change_percent")
    )
    return summary.classify_anomaly(changes)


def edge_single_point(spark, sf_dir):
    """Only the newest bar of each symbol: the trend is flat."""
    newest = bars_from_lineitem(spark, sf_dir).groupBy("symbol").agg(
        F.max_by("close", "date").alias("close"), F.max("date").alias("date")
    )
    return _rounded(trend.forecast(newest, "close"), 3, "predicted_close")


def _marked(spark, sf_dir):
    """Bars of which some have no date, no symbol, or a symbol too long."""
    return bars_from_lineitem(spark, sf_dir).withColumns(
        {
            "date": F.when(F.col("close") != F.col("low"), F.col("date")),
            "symbol": F.when(F.col("open") == F.col("high"), F.concat("symbol", F.lit(" (high)")))
            .when(F.col("open") != F.col("low"), F.col("symbol")),
        }
    )


def quarantine(spark, sf_dir):
    """Rows a bar table refuses."""
    return _marked(spark, sf_dir).where(audit.bad_key())


QUERIES: dict[str, Query] = {
    "bars_lineitem": bars_lineitem,
    "bars_events": bars_events,
    "read_feed": read_feed_query,
    "normalize_feed": normalize,
    "watermarks": watermarks,
    "ingest_window": ingest_window,
    "ingest_increment": ingest_increment,
    "ingest_stream": ingest_stream_query,
    "stream_layers": stream_layers_query,
    "ingest_plain_feed": ingest_plain_feed,
    "ingest_grown_folder": ingest_grown_folder,
    "ingest_symbol_files": ingest_symbol_files,
    "first_per_key": first_per_key,
    "insert_if_absent": insert_if_absent,
    "upsert_by_key": upsert_by_key,
    "table_insert": table_insert,
    "table_upsert": table_upsert,
    "bronze": bronze,
    "symbol_slice": symbol_slice,
    "history": history,
    "distinct_symbols": distinct_symbols,
    "silver_not_null_keys": silver_not_null_keys,
    "prev_close": prev_close,
    "daily_change": daily_change,
    "daily_change_percent": daily_change_percent,
    "weekly_ma": weekly_ma,
    "monthly_ma": monthly_ma,
    "month_bucket": month_bucket_query,
    "monthly_volatility": monthly_volatility,
    "silver": silver,
    "silver_sparse": silver_sparse,
    "silver_tail": silver_tail,
    "silver_early": silver_early,
    "daily_summary": daily_summary,
    "classify_anomaly": classify_anomaly,
    "gold": gold,
    "build_layers": build_layers,
    "build_layers_tail": build_layers_tail,
    "rebuild_layers": rebuild_layers,
    "build_forecast": build_forecast,
    "forecast_after_tail": forecast_after_tail,
    "build_forecast_close": build_forecast_close,
    "day_index": day_index,
    "day_index_series": day_index_series,
    "forecast_series": forecast_series,
    "fit_trend": fit_trend,
    "forecast_close": forecast_close,
    "forecast_avg_close": forecast_avg_close,
    "forecast_row_counts": forecast_row_counts,
    "audit_nulls": audit_nulls,
    "audit_duplicates": audit_duplicates,
    "audit_length": audit_length,
    "quarantine": quarantine,
    "quarantine_insert": quarantine_insert,
    "edge_nulls": edge_nulls,
    "edge_nan": edge_nan,
    "edge_thresholds": edge_thresholds,
    "edge_single_point": edge_single_point,
}
