"""Constraint checks: files enforce neither keys nor NOT NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars import schemas as S


def audit_nulls(df: DataFrame, columns: Sequence[str] = S.KEY) -> DataFrame:
    """One row: how many NULLs each column holds, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def audit_duplicates(df: DataFrame, key: Sequence[str] = S.KEY) -> DataFrame:
    """The keys that occur more than once, with their count as ``copies``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def most_copies(df: DataFrame, by: str, key: Sequence[str] = S.KEY) -> DataFrame:
    """How often a key occurs at most, for each value of ``by``, which keys determine."""
    counts = df.groupBy(by, *key).agg(F.count(F.lit(1)).alias("copies"))
    return counts.groupBy(by).agg(F.max("copies").alias("copies"))


def audit_length(
    df: DataFrame, column: str = "symbol", limit: int = S.SYMBOL_LENGTH
) -> DataFrame:
    """The distinct values longer than ``limit`` characters, with their rows."""
    return (
        df.where(F.length(column) > limit)
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"), F.max(F.length(column)).alias("length"))
    )


def bad_key(key: Sequence[str] = S.KEY, limit: int = S.SYMBOL_LENGTH) -> Column:
    """True for rows the bar tables may not hold: a NULL key or a long symbol."""
    missing = [F.col(c).isNull() for c in key]
    return reduce(lambda a, b: a | b, missing, F.length("symbol") > limit)


def require_not_null(df: DataFrame, columns: Sequence[str] = S.KEY) -> DataFrame:
    """``df``, whose job fails on the first row with a NULL in ``columns``.

    The check is part of the columns themselves, so it costs no extra pass.
    """
    checked = {
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} must not be NULL"))).otherwise(
            F.col(c)
        )
        for c in columns
    }
    return df.withColumns(checked)


def reject_duplicates(df: DataFrame, key: Sequence[str] = S.KEY) -> None:
    """Fail when a key occurs more than once; names one such key."""
    found = audit_duplicates(df, key).head(1)
    if found:
        raise ValueError(f"duplicate key in batch: {found[0].asDict()}")
