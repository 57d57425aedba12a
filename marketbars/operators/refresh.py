"""Recompute of the part of the silver layer that a change can reach."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import month_bucket
from marketbars.operators.enrich import enrich
from marketbars.operators.series import BLOCK_YEARS, keyed_rows
from marketbars.storage import Stage, stage


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``after`` that ``before`` lacks or holds with other values."""
    old = before.select(*[F.col(c).alias(f"_old_{c}") for c in S.BAR_COLUMNS])
    same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in S.BAR_COLUMNS]
    return after.select(*S.BAR_COLUMNS).join(old, same, "left_anti")


def fingerprints(bars: DataFrame) -> DataFrame:
    """Per month the number of rows and two sums of row hashes, in any order."""
    row = [F.col(c) for c in S.BAR_COLUMNS]
    wide = "decimal(38,0)"
    return bars.groupBy(S.MONTH).agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(*row).cast(wide)).alias("one"),
        F.sum(F.xxhash64(F.lit("again"), *row).cast(wide)).alias("two"),
    )


def differing_months(before: DataFrame, after: DataFrame) -> list[dt.date]:
    """Months whose `fingerprints` in ``after`` are not those in ``before``.

    Both are `fingerprints`, one row a month. Two months that differ pass as
    equal only if both 64-bit sums agree by chance, one time in 2^128.
    """
    old, new = (
        {r[S.MONTH]: (r["n"], r["one"], r["two"]) for r in prints.collect()}
        for prints in (before, after)
    )
    return sorted(m for m, found in new.items() if old.get(m) != found)


def month_counts(bars: DataFrame) -> DataFrame:
    """(symbol, month, rows) of bars that belong to a series."""
    month = month_bucket("date").alias(S.MONTH)
    return keyed_rows(bars).groupBy("symbol", month).agg(F.count("*").alias("rows"))


def months_to_refresh(
    bronze: DataFrame, changed: DataFrame, counts: DataFrame | None = None
) -> DataFrame:
    """(symbol, month, affected) of what changes reach and of what they look back to.

    Of ``bronze`` only the months of changes are read where `month_counts` of the
    others are given.

    A change reaches the 29 rows after it, through the averages, and with each
    row the volatility of its month. So a month is affected if it holds a change
    or one of the 29 rows after one. The months with the 29 rows before a run of
    affected months come with ``affected`` false. Only one row per symbol and
    month meets in a window.
    """
    reach = S.MONTHLY_ROWS - 1
    last = (
        keyed_rows(changed)
        .groupBy("symbol", month_bucket("date").alias(S.MONTH))
        .agg(F.max("date").alias("_last"))
    )
    held = keyed_rows(bronze)
    if counts is None:
        counts = month_counts(held)
    elif S.MONTH in held.columns:
        held = held.where(F.col(S.MONTH).isin(_distinct_months(last)))
    touched = (
        held.select("symbol", "date", month_bucket("date").alias(S.MONTH))
        .join(last, ["symbol", S.MONTH])
        .groupBy("symbol", S.MONTH)
        .agg(
            F.count("*").alias("_rows"),
            F.count_if(F.col("date") > F.col("_last")).alias("_after"),
            F.max("_last").alias("_last"),
        )
    )
    others = (
        counts.join(last.select("symbol").distinct(), "symbol", "left_semi")
        .join(last, ["symbol", S.MONTH], "left_anti")
        .select("symbol", S.MONTH, F.col("rows").alias("_rows"))
    )
    months = touched.unionByName(others, allowMissingColumns=True)
    in_order = Window.partitionBy("symbol").orderBy(S.MONTH)
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    later = in_order.rowsBetween(1, Window.unboundedFollowing)
    through = F.col("_through")
    first = through - F.col("_rows")
    reached = F.when(
        F.col("_last").isNotNull(), through + F.greatest(F.lit(0), reach - F.col("_after"))
    )
    affected = F.coalesce(F.col("_reached") > first, F.lit(False))
    next_run = F.min(F.when(F.col("affected"), first)).over(later)
    return (
        months.withColumn("_through", F.sum("_rows").over(upto))
        .withColumn("_reached", F.max(reached).over(upto))
        .withColumn("affected", affected)
        .withColumn("_next", next_run)
        .where(F.col("affected") | (F.col("_next") - through < reach))
        .select("symbol", S.MONTH, "affected")
    )


def _distinct_months(rows: DataFrame) -> list[dt.date]:
    """The months of some rows; twelve a year."""
    return sorted(r[0] for r in rows.select(S.MONTH).distinct().collect())


def _bars_of(bronze: DataFrame, months: DataFrame) -> DataFrame:
    """The bars of the months. Partitions of other months are not listed."""
    dated = keyed_rows(bronze)
    if S.MONTH not in bronze.columns:
        dated = dated.withColumn(S.MONTH, month_bucket("date"))
    near = dated.where(F.col(S.MONTH).isin(_distinct_months(months)))
    return near.join(months, ["symbol", S.MONTH]).select(*S.BAR_COLUMNS)


def refresh_tail(
    bronze: DataFrame,
    changed: DataFrame,
    on_zero: str = "error",
    years: int = BLOCK_YEARS,
    stage: Stage = stage,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Silver rows that changes at the keys in ``changed`` can affect.

    Per symbol the months that `months_to_refresh` finds, early and late changes
    apart, are computed again with the rows before them that averages look back
    to. ``bronze`` may keep its month column; with ``counts``, the `month_counts` of
    what it held before the changes, only those months of it are read.
    """
    months = stage(months_to_refresh(bronze, changed, counts))
    silver = enrich(stage(_bars_of(bronze, months)), on_zero, years)
    affected = months.where("affected").select("symbol", F.col(S.MONTH).alias("_month"))
    return (
        silver.withColumn("_month", month_bucket("date"))
        .join(affected, ["symbol", "_month"], "left_semi")
        .select(*S.SILVER_COLUMNS)
    )
