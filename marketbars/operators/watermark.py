"""Per-symbol high-water marks and the slice of a feed they ask for."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.storage import Stage


def watermarks(
    symbols: DataFrame, target: DataFrame, default_start: str = S.DEFAULT_START
) -> DataFrame:
    """(symbol, max_date, start_date) of each symbol to load.

    Loading starts the day after the newest stored bar, or at
    ``default_start`` for a symbol without any. Rows at or before the mark are
    never loaded again: late or restated history needs an upsert.
    """
    newest = target.groupBy("symbol").agg(F.max("date").alias("max_date"))
    start = F.coalesce(F.date_add("max_date", 1), F.lit(default_start).cast("date"))
    return (
        symbols.select("symbol")
        .distinct()
        .join(newest, "symbol", "left")
        .select("symbol", "max_date", start.alias("start_date"))
    )


def newest_dates(
    symbols: DataFrame, target: DataFrame, months: Sequence[dt.date], stage: Stage
) -> DataFrame:
    """(symbol, max_date) of the symbols that ``target`` holds, newest months first.

    ``months`` are the table's. One, two, four and so on are read for the
    symbols not found so far, until all are found or all months were read: a
    daily load reads the last month only, unless a symbol has none there.
    """
    missing, found = symbols.select("symbol").distinct(), None
    left = sorted(months, reverse=True)
    count = 1
    while left and not missing.isEmpty():
        last, first = left[0], left[min(count, len(left)) - 1]
        span = F.col(S.MONTH).between(F.lit(first), F.lit(last))
        newest = stage(
            target.where(span)
            .join(missing, "symbol", "left_semi")
            .groupBy("symbol")
            .agg(F.max("date").alias("max_date"))
        )
        found = newest if found is None else found.unionByName(newest)
        missing = missing.join(newest, "symbol", "left_anti")
        left, count = left[count:], count * 2
    if found is None:
        found = symbols.select("symbol", F.lit(None).cast("date").alias("max_date")).limit(0)
    return found


def ingest_window(feed: DataFrame, marks: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Feed rows of the marked symbols with start_date <= date < as_of - 1 day.

    The end is exclusive, so the newest day loaded is two days before
    ``as_of``. A symbol whose start is not before the end gets no rows. Pass
    stored marks: their size then decides whether they are broadcast.
    """
    end = F.date_sub(F.lit(str(as_of)).cast("date"), 1)
    return (
        feed.where(F.col("date") < end)
        .join(marks.select("symbol", "start_date"), "symbol")
        .where(F.col("date") >= F.col("start_date"))
        .select(*feed.columns)
    )
