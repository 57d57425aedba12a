"""Reads of the stored layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S


def bar_columns(df: DataFrame) -> DataFrame:
    """The nine bar columns of a source table, by name."""
    return df.select(*S.BAR_COLUMNS)


def read_layer(
    spark: SparkSession,
    table: str,
    columns: Iterable[str] | None = None,
    since: dt.date | str | None = None,
) -> DataFrame:
    """A stored layer without its storage partition column.

    ``since`` leaves out earlier dates; their months are not read.
    """
    layer = spark.table(table)
    if since is not None:
        day = F.lit(str(since)).cast("date")
        layer = layer.where((F.col(S.MONTH) >= F.trunc(day, "MM")) & (F.col("date") >= day))
    return layer.select(*columns) if columns else layer.drop(S.MONTH)


def partition_values(spark: SparkSession, table: str) -> list[dict[str, str]]:
    """The partitions of a table, each as its columns' values."""
    found = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [dict(part.split("=", 1) for part in row[0].split("/")) for row in found]


def stored_months(spark: SparkSession, table: str) -> list[dt.date]:
    """The months that a bar table has files for; twelve a year."""
    texts = [p[S.MONTH] for p in partition_values(spark, table)]
    return [dt.date.fromisoformat(t) for t in texts if not t.startswith("__")]


def distinct_symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def symbol_slice(df: DataFrame, symbol: str) -> DataFrame:
    """One symbol's rows; the predicate reaches the scan."""
    return df.where(F.col("symbol") == symbol)


def history(
    df: DataFrame, symbol: str, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """One symbol's bars with start <= date < end."""
    day = [F.lit(str(d)).cast("date") for d in (start, end)]
    return symbol_slice(df, symbol).where((F.col("date") >= day[0]) & (F.col("date") < day[1]))


def symbol_universe(
    spark: SparkSession, symbols: Iterable[str] = S.DEFAULT_SYMBOLS
) -> DataFrame:
    """The symbols to load, as a frame."""
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")
