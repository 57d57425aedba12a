"""Straight-line trend per symbol and its forecast.

The line is fitted on day numbers 0..n-1 of a symbol's usable rows. Each
calendar block numbers its own rows and reduces them to a few sums; a symbol's
blocks then meet as one row each. So no task sees a whole series, and no row is
joined or shuffled a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import month_bucket
from marketbars.operators.series import BLOCK, BLOCK_YEARS, calendar_block, keyed_rows


def _usable(df: DataFrame, y: str) -> DataFrame:
    value = F.col(y).cast("double")
    block = [BLOCK] if BLOCK in df.columns else []
    rows = keyed_rows(df).select("date", "symbol", value.alias(y), *block)
    return rows.where(F.col(y).isNotNull() & ~F.isnan(y))


def training_rows(df: DataFrame, y: str = "close", years: int = BLOCK_YEARS) -> DataFrame:
    """(date, symbol, y) where y is a number, with the row's calendar block.

    A block column that ``df`` has is kept: rows stored by it are not shuffled.
    """
    rows = _usable(df, y)
    return rows if BLOCK in df.columns else rows.withColumn(BLOCK, calendar_block("date", years))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with their number inside the block, from 0."""
    block = Window.partitionBy("symbol", BLOCK).orderBy("date")
    return rows.withColumn("_at", F.row_number().over(block) - 1)


def _rows_so_far():
    """The blocks of a symbol before the current one."""
    return (
        Window.partitionBy("symbol")
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def day_index(df: DataFrame, y: str = "close", years: int = BLOCK_YEARS) -> DataFrame:
    """Usable rows numbered 0..n-1 per symbol in date order.

    Reads ``df`` twice, the second time to count rows per block.
    """
    rows = training_rows(df, y, years)
    counts = rows.groupBy("symbol", BLOCK).agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select(
        "symbol",
        BLOCK,
        F.coalesce(F.sum("_rows").over(_rows_so_far()), F.lit(0)).alias("_start"),
    )
    return (
        _numbered(rows)
        .join(starts, ["symbol", BLOCK])
        .select("date", "symbol", y, (F.col("_start") + F.col("_at")).alias("day"))
    )


def _block_sums(rows: DataFrame, y: str) -> DataFrame:
    return (
        _numbered(rows)
        .groupBy("symbol", BLOCK)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(y).alias("y"),
            F.sum(F.col("_at") * F.col(y)).alias("at_y"),
            F.max("date").alias("last_date"),
        )
    )


def month_sums(df: DataFrame, y: str = "close") -> DataFrame:
    """What a line needs of each symbol's month: (symbol, month, rows, y, at_y, last_date).

    Months do not depend on one another: of changed months the sums are made
    anew, of others they are kept.
    """
    rows = _usable(df, y).withColumn(BLOCK, month_bucket("date"))
    return _block_sums(rows, y).withColumnRenamed(BLOCK, S.MONTH)


def fit_trend(df: DataFrame, y: str = "close", years: int = BLOCK_YEARS) -> DataFrame:
    """Least-squares line per symbol: (symbol, n, last_date, intercept, slope).

    With day numbers 0..n-1 the spread of x is known, n(n^2-1)/12, so the fit
    needs n, sum(y) and sum(day*y) only. One row gives slope 0. Symbols without
    a usable row have no line.
    """
    return _line_of(_block_sums(training_rows(df, y, years), y))


def fit_months(sums: DataFrame) -> DataFrame:
    """`fit_trend` from the `month_sums` of all months."""
    return _line_of(sums.withColumnRenamed(S.MONTH, BLOCK))


def _line_of(blocks: DataFrame) -> DataFrame:
    start = F.coalesce(F.sum("rows").over(_rows_so_far()), F.lit(0))
    totals = (
        blocks.withColumn("start", start)
        .groupBy("symbol")
        .agg(
            F.sum("rows").alias("n"),
            F.sum("y").alias("y"),
            F.sum(F.col("start") * F.col("y") + F.col("at_y")).alias("day_y"),
            F.max("last_date").alias("last_date"),
        )
    )
    n = F.col("n").cast("double")
    mean_day = (n - 1) / 2
    spread = F.nullif(n * (n * n - 1) / 12, F.lit(0.0))
    slope = F.coalesce((F.col("day_y") - mean_day * F.col("y")) / spread, F.lit(0.0))
    return totals.withColumn("slope", slope).select(
        "symbol",
        "n",
        "last_date",
        (F.col("y") / n - F.col("slope") * mean_day).alias("intercept"),
        "slope",
    )


def forecast(
    df: DataFrame,
    y: str = "close",
    horizon: int = S.HORIZON_DAYS,
    start_offset: int = 0,
    years: int = BLOCK_YEARS,
) -> DataFrame:
    """``horizon`` calendar days per symbol on the symbol's trend line.

    The first value continues the line one step after the last usable row. The
    first date is that row's own date; ``start_offset=1`` moves it to the next
    day.
    """
    return extend(fit_trend(df, y, years), horizon, start_offset)


def extend(
    lines: DataFrame, horizon: int = S.HORIZON_DAYS, start_offset: int = 0
) -> DataFrame:
    """The days that `forecast` gives, from fitted lines."""
    if horizon < 1:
        raise ValueError("horizon must be at least one day")
    step = F.col("step")
    return (
        lines.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))))
        .select(
            F.date_add("last_date", step + start_offset).alias("date"),
            "symbol",
            (F.col("intercept") + F.col("slope") * (F.col("n") + step)).alias("predicted_close"),
        )
    )
