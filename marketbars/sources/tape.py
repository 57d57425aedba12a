"""Daily bars from rows that each carry one price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S


def bars_from_prices(prices: DataFrame, order: Column, volume: Column) -> DataFrame:
    """One bar per (date, symbol) from rows of (date, symbol, price, ...).

    ``order`` ranks the rows of a day; its first and last price are open and
    close. All aggregates combine map-side, so a symbol that owns much of the
    tape reaches the shuffle as one row per day and task.
    """
    return (
        prices.groupBy("date", "symbol")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            volume.cast("bigint").alias("volume"),
        )
        .withColumns({"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)})
        .select(*S.BAR_COLUMNS)
    )


# Order and line number repeat in the data; the further fields decide ties.
TRADE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
)


def trades_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades of (date, symbol): symbol is the part's brand.

    Neither side of the join has a size bound, so none is hinted; Spark
    broadcasts ``part`` while it is below the configured limit.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_shipdate").cast("date").alias("date"), *TRADE_ORDER
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", F.col("p_brand").alias("symbol")
    )
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))


def bars_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the line item trades, prices in whole cents per unit."""
    price = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("double")
    prices = trades_from_lineitem(spark, sf_dir).withColumn("price", price)
    return bars_from_prices(prices, F.struct(*TRADE_ORDER), F.sum("l_quantity"))


def bars_from_events(
    spark: SparkSession, sf_dir: str, symbol: Column | None = None
) -> DataFrame:
    """Events as a tape of values, one symbol per event type unless given."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    prices = events.select(
        (F.col("event_type") if symbol is None else symbol).alias("symbol"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("price"),
        "ts",
    )
    return bars_from_prices(prices, F.col("ts"), F.count(F.lit(1)))
