"""Daily summary and anomaly label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import anomaly_label


def daily_summary(silver: DataFrame, also_by: Sequence[str] = ()) -> DataFrame:
    """One row per (date, symbol): averages of prices, sums of amounts.

    ``also_by`` names columns that (date, symbol) determines. They change no
    group, but let Spark keep a partitioning that includes them.
    """
    averages = {
        "avg_open": "open",
        "avg_high": "high",
        "avg_low": "low",
        "avg_close": "close",
    }
    sums = {
        "total_volume": "volume",
        "total_dividends": "dividends",
        "total_stock_splits": "stock_splits",
    }
    derived = {
        f"avg_{name}": name
        for name in (
            "daily_change",
            "daily_change_percent",
            "weekly_ma",
            "monthly_ma",
            "monthly_volatility",
        )
    }
    return (
        silver.groupBy(*also_by, *S.KEY)
        .agg(
            *[F.avg(source).alias(name) for name, source in averages.items()],
            *[F.sum(source).alias(name) for name, source in sums.items()],
            *[F.avg(source).alias(name) for name, source in derived.items()],
        )
        .drop(*also_by)
    )


def classify_anomaly(
    df: DataFrame,
    up: float = S.UP_PERCENT,
    down: float = S.DOWN_PERCENT,
    percent: str = "avg_daily_change_percent",
) -> DataFrame:
    return df.withColumn("anomaly_type", anomaly_label(F.col(percent), up, down))


def summarize(silver: DataFrame, also_by: Sequence[str] = ()) -> DataFrame:
    """The gold layer. The label is a function of the summary row: no join."""
    return classify_anomaly(daily_summary(silver, also_by)).select(*S.GOLD_COLUMNS)
