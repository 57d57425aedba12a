"""Row-count windows over a symbol's series that never need the series whole.

A window partitioned by symbol puts a symbol's full history in one task. Here
each series is cut into calendar blocks of a few years. A block first receives
the few rows that precede it, at whatever distance in time they lie, so every
frame that looks back at most that far sees the same rows as on the uncut
series. With one bar per day a block holds at most ``years * 366`` rows plus
those, whatever share of the data its symbol owns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketbars.functions.expressions import month_bucket

BLOCK = "_block"
BLOCK_MONTH = "_block_month"
BLOCK_YEARS = 5
_EARLIER = "_earlier"


def calendar_block(date: str = "date", years: int = BLOCK_YEARS) -> Column:
    if years < 1:
        raise ValueError("a block spans at least one year")
    return F.floor(F.year(date) / F.lit(years)).cast("int")


def keyed_rows(df: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Rows that belong to a series: both key columns are present."""
    return df.where(F.col(date).isNotNull() & F.col(symbol).isNotNull())


def _rows_before_blocks(
    rows: DataFrame, value: str, reach: int, symbol: str, date: str
) -> DataFrame:
    """For each block the ``reach`` rows of its symbol that precede it.

    Only the last ``reach`` rows of a block can precede a later one, so a
    symbol is reduced to those rows per block before its blocks meet. Such a
    row serves every block that starts within the next ``reach`` rows; where a
    series is sparse these may be several.
    """
    newest_first = Window.partitionBy(symbol, BLOCK).orderBy(F.col(date).desc())
    ends = (
        rows.select(symbol, date, value, BLOCK)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= reach)
    )
    ahead = Window.partitionBy(symbol).orderBy(date).rowsBetween(1, reach)
    later = F.array_remove(F.collect_set(BLOCK).over(ahead), F.col(BLOCK))
    return ends.withColumn("_later", later).select(
        symbol, date, value, F.explode("_later").alias(BLOCK), F.lit(True).alias(_EARLIER)
    )


def over_series(
    df: DataFrame,
    reach: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    *,
    value: str = "close",
    symbol: str = "symbol",
    date: str = "date",
    years: int = BLOCK_YEARS,
) -> DataFrame:
    """Add window columns over each symbol's rows in date order.

    ``columns`` gets the window and may look back up to ``reach`` rows of
    ``value``. ``df`` is read twice, the second time for three columns only:
    pass a stored table. The result is hash partitioned by (symbol, block) and
    keeps `BLOCK` and `BLOCK_MONTH`, so that later steps can group by them
    without another shuffle or sort.
    """
    rows = keyed_rows(df, symbol, date).withColumn(BLOCK, calendar_block(date, years))
    if reach > 0:
        before = _rows_before_blocks(rows, value, reach, symbol, date)
        rows = rows.withColumn(_EARLIER, F.lit(False)).unionByName(
            before, allowMissingColumns=True
        )
    else:
        rows = rows.withColumn(_EARLIER, F.lit(False))
    # Month before date does not change the order, but leaves the rows sorted
    # for windows per calendar month.
    series = Window.partitionBy(symbol, BLOCK).orderBy(BLOCK_MONTH, date)
    return (
        rows.withColumn(BLOCK_MONTH, month_bucket(date))
        .withColumns(columns(series))
        .where(~F.col(_EARLIER))
        .drop(_EARLIER)
    )
