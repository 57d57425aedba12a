"""Enrichment of a symbol's series: changes, moving averages, volatility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import change, change_percent, month_bucket
from marketbars.operators.series import BLOCK, BLOCK_MONTH, BLOCK_YEARS, over_series

_PREVIOUS = "_previous"


def _change_columns(value: str, on_zero: str) -> dict[str, Column]:
    current, previous = F.col(value), F.col(_PREVIOUS)
    return {
        "prev_close": F.coalesce(previous, current),
        "daily_change": change(current, previous),
        "daily_change_percent": change_percent(current, previous, on_zero),
    }


def with_changes(
    df: DataFrame,
    value: str = "close",
    on_zero: str = "error",
    years: int = BLOCK_YEARS,
    keep_block: bool = False,
) -> DataFrame:
    """Previous value, change and change in percent of each symbol's rows.

    The previous row counts even when its value is NULL: change is then 0.
    ``keep_block`` leaves the block columns in, by which `with_month_volatility`
    goes on without another shuffle.
    """
    rows = over_series(
        df, 1, lambda series: {_PREVIOUS: F.lag(value).over(series)}, value=value, years=years
    )
    changed = rows.withColumns(_change_columns(value, on_zero)).drop(_PREVIOUS)
    return changed if keep_block else changed.drop(BLOCK, BLOCK_MONTH)


def with_moving_average(
    df: DataFrame, name: str, rows: int, value: str = "close", years: int = BLOCK_YEARS
) -> DataFrame:
    """Average of a row and the ``rows - 1`` before it; fewer at the start.

    Blocks grow with the frame, so that few rows serve more than one block.
    """
    reach = rows - 1
    # At least eight frames of daily rows to a block.
    years = max(years, -(-8 * reach // 366))
    result = over_series(
        df,
        reach,
        lambda series: {name: F.avg(value).over(series.rowsBetween(-reach, 0))},
        value=value,
        years=years,
    )
    return result.drop(BLOCK, BLOCK_MONTH)


def with_month_volatility(
    df: DataFrame, value: str = "daily_change_percent", name: str = "monthly_volatility"
) -> DataFrame:
    """Sample deviation of a symbol's values in the calendar month of each row.

    Rows that still have their block columns are grouped by them, as they lie;
    the columns go then.
    """
    blocked = BLOCK in df.columns and BLOCK_MONTH in df.columns
    month = Window.partitionBy("symbol", *([BLOCK] if blocked else []), BLOCK_MONTH)
    if not blocked:
        df = df.withColumn(BLOCK_MONTH, month_bucket("date"))
    return df.withColumn(name, F.stddev_samp(value).over(month)).drop(BLOCK, BLOCK_MONTH)


def enrich(
    bronze: DataFrame,
    on_zero: str = "error",
    years: int = BLOCK_YEARS,
    keep_block: bool = False,
) -> DataFrame:
    """The silver layer: bars with changes, moving averages and volatility.

    One shuffle and one sort of the bars serve all windows, plus the rows that
    precede each block. Needs a unique (date, symbol); see `audit_duplicates`.
    ``keep_block`` leaves the block column in, which `daily_summary` can use to
    go on without a shuffle.
    """
    reach = S.MONTHLY_ROWS - 1
    series = over_series(
        bronze.select(*S.BAR_COLUMNS),
        reach,
        lambda w: {
            _PREVIOUS: F.lag("close").over(w),
            "weekly_ma": F.avg("close").over(w.rowsBetween(1 - S.WEEKLY_ROWS, 0)),
            "monthly_ma": F.avg("close").over(w.rowsBetween(-reach, 0)),
        },
        years=years,
    )
    month = Window.partitionBy("symbol", BLOCK, BLOCK_MONTH)
    silver = series.withColumns(_change_columns("close", on_zero)).withColumn(
        "monthly_volatility", F.stddev_samp("daily_change_percent").over(month)
    )
    return silver.select(*S.SILVER_COLUMNS, *([BLOCK] if keep_block else []))
