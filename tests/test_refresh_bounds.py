"""How far a refresh reaches, early and late changes apart."""

import datetime as dt

import pytest
from frames import bars

from marketbars import schemas as S
from marketbars.operators.enrich import enrich
from marketbars.operators.merge import upsert_by_key
from marketbars.operators.refresh import refresh_tail
from marketbars.storage import stage


def _series(spark, days, symbol="A"):
    start = dt.date(2020, 1, 1)
    dates = [start + dt.timedelta(days=d) for d in days]
    return stage(bars(spark, [(symbol, str(d), 10.0 + i % 7) for i, d in enumerate(dates)]))


def _restated(data, *dates):
    return stage(data.where(data.date.cast("string").isin(list(dates))).withColumn("close", data.close + 5))


def _months(frame):
    return sorted({str(r.date)[:7] for r in frame.select("date").distinct().collect()})


def _check(data, changed):
    after = stage(upsert_by_key(data, changed))
    tail = stage(refresh_tail(after, changed))
    refreshed = upsert_by_key(enrich(data), tail).select(*S.SILVER_COLUMNS)
    expected = enrich(after).select(*S.SILVER_COLUMNS)
    assert sorted(map(str, refreshed.collect())) == sorted(map(str, expected.collect()))
    return _months(tail)


def test_a_first_day_change_reaches_29_rows(spark):
    data = _series(spark, range(0, 400))
    # 1 January and the 29 rows after it: all of January, nothing more.
    assert _check(data, _restated(data, "2020-01-01")) == ["2020-01"]
    assert _check(data, _restated(data, "2020-01-03")) == ["2020-01", "2020-02"]


def test_early_and_late_changes_leave_the_middle_alone(spark):
    data = _series(spark, range(0, 700))
    months = _check(data, _restated(data, "2020-02-10", "2021-07-05"))
    assert months == ["2020-02", "2020-03", "2021-07", "2021-08"]


@pytest.mark.parametrize("step", [9, 45])
def test_sparse_series_count_rows_not_days(spark, step):
    data = _series(spark, range(0, 3000, step))
    months = _check(data, _restated(data, "2020-01-01"))
    last = dt.date(2020, 1, 1) + dt.timedelta(days=29 * step)
    assert months[0] == "2020-01" and months[-1] == str(last)[:7]


def test_missing_closes_are_rows(spark):
    data = _series(spark, range(0, 200))
    holes = stage(data.selectExpr("date", "symbol", "open", "high", "low",
                                  "CASE WHEN day(date) % 3 > 0 THEN close END AS close",
                                  "volume", "dividends", "stock_splits"))
    assert _check(holes, _restated(holes, "2020-03-04")) == ["2020-03", "2020-04"]
