import datetime as dt
import math
import random

import numpy as np
import pytest
from frames import bars, closes, day

from marketbars.operators.trend import day_index, fit_trend, forecast
from marketbars.storage import stage


def line(n, slope=2.0, intercept=1.0, symbol="A", start=dt.date(2020, 1, 1)):
    return [
        (symbol, str(start + dt.timedelta(i)), intercept + slope * i) for i in range(n)
    ]


def test_perfect_line(spark):
    got = closes(forecast(bars(spark, line(10))), "predicted_close")
    assert len(got) == 30
    assert [r[1] for r in got] == [day("01-10") + dt.timedelta(i) for i in range(30)]
    assert [r[2] for r in got] == pytest.approx([21 + 2 * i for i in range(30)], abs=1e-9)


def test_row_order_does_not_matter(spark):
    rows = line(50)
    expected = closes(forecast(bars(spark, rows)), "predicted_close")
    random.Random(1).shuffle(rows)
    assert closes(forecast(bars(spark, rows)), "predicted_close") == expected


def test_single_row_is_flat(spark):
    got = closes(forecast(bars(spark, [("A", "01-02", 5.0)])), "predicted_close")
    assert len(got) == 30 and {r[2] for r in got} == {5.0}


def test_symbol_without_values_has_no_forecast(spark):
    rows = [("A", "01-02", None), ("A", "01-03", math.nan), *line(3, symbol="B")]
    got = forecast(bars(spark, rows)).select("symbol").distinct().collect()
    assert [r.symbol for r in got] == ["B"]


def test_nulls_and_nans_take_no_day_number(spark):
    rows = [
        ("A", "01-02", 1.0),
        ("A", "01-03", None),
        ("A", "01-04", math.nan),
        ("A", "01-05", 3.0),
    ]
    data = bars(spark, rows)
    assert closes(day_index(data), "day") == [("A", day("01-02"), 0), ("A", day("01-05"), 1)]
    row = fit_trend(data).first()
    assert (row.n, row.slope, row.intercept) == (2, 2, 1)


def test_offset_and_horizon(spark):
    data = bars(spark, line(4))
    got = closes(forecast(data, horizon=5, start_offset=1), "predicted_close")
    assert [r[1] for r in got] == [day("01-05") + dt.timedelta(i) for i in range(5)]
    assert got[0][2] == pytest.approx(9)
    with pytest.raises(ValueError):
        forecast(data, horizon=0)


@pytest.mark.parametrize("years", [1, 5])
def test_fit_over_many_blocks(spark, years):
    """Long noisy series against a fit on the whole series."""
    rng = random.Random(7)
    rows, series = [], {}
    for s, step in (("D", 1), ("W", 7), ("Y", 300)):
        at, values = dt.date(1980, 3, 1), []
        while at.year < 2024:
            values.append(100 + rng.gauss(0, 30) + 0.01 * len(values))
            rows.append((s, str(at), values[-1]))
            at += dt.timedelta(rng.randrange(1, 2 * step + 1))
        series[s] = values
    data = stage(bars(spark, rows))
    for row in fit_trend(data, years=years).collect():
        slope, intercept = np.polyfit(np.arange(row.n), series[row.symbol], 1)
        assert row.n == len(series[row.symbol])
        assert row.slope == pytest.approx(slope, rel=1e-9)
        assert row.intercept == pytest.approx(intercept, rel=1e-9)
    indexed = day_index(data, years=years).orderBy("symbol", "day").collect()
    for symbol, values in series.items():
        mine = [r for r in indexed if r.symbol == symbol]
        assert [r.day for r in mine] == list(range(len(values)))
        assert [r.close for r in mine] == values
