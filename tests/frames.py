"""Small frames for the tests."""

from __future__ import annotations

import datetime as dt

from marketbars import schemas as S


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text if len(text) == 10 else f"2020-{text}")


def bars(spark, rows):
    """Bars from (symbol, date, close) rows; a date may leave out the year 2020."""
    data = [
        (day(d) if d else None, s, c, c, c, c, 1, 0.0, 0.0) for s, d, c in rows
    ]
    return spark.createDataFrame(data, S.BARS)


def closes(df, *columns):
    """Rows as tuples of (symbol, date, columns...), sorted."""
    names = ("symbol", "date", *columns)
    return sorted(tuple(r[n] for n in names) for r in df.select(*names).collect())
