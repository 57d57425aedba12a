"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketbars import schemas as S


def month_bucket(date: Column | str) -> Column:
    """First day of the calendar month, as DATE."""
    return F.trunc(date, "MM")


def local_date(text: Column | str) -> Column:
    """Calendar date written at the head of a timestamp text.

    The text is cast straight to DATE. A detour over TIMESTAMP would apply the
    zone offset and move late-evening bars to the next day.
    """
    column = F.col(text) if isinstance(text, str) else text
    return column.cast("date")


def change(value: Column, previous: Column) -> Column:
    """Difference to the previous value, 0 where either is missing."""
    return F.coalesce(value - previous, F.lit(0.0))


def change_percent(value: Column, previous: Column, on_zero: str = "error") -> Column:
    """Change in percent of the previous value, 0 where either is missing.

    A previous value of zero is a division error, or with ``on_zero='null'``
    counts as missing.
    """
    if on_zero not in ("error", "null"):
        raise ValueError(f"on_zero must be 'error' or 'null', not {on_zero!r}")
    if on_zero == "null":
        base = F.nullif(previous, F.lit(0.0))
    else:
        # Stated here rather than left to spark.sql.ansi.enabled.
        base = F.when(previous == 0, F.raise_error(F.lit("previous value is zero"))).otherwise(
            previous
        )
    return F.coalesce((value - previous) / base * 100, F.lit(0.0))


def anomaly_label(
    percent: Column, up: float = S.UP_PERCENT, down: float = S.DOWN_PERCENT
) -> Column:
    """Label of a day's change. NULL and the limits themselves are normal."""
    return (
        F.when(percent > F.lit(up), S.HIGH_POSITIVE)
        .when(percent < F.lit(down), S.HIGH_NEGATIVE)
        .otherwise(S.NORMAL)
    )
