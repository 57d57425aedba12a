import datetime as dt
import math
import random

import pytest
from frames import bars, closes, day
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.operators.enrich import (
    enrich,
    with_changes,
    with_month_volatility,
    with_moving_average,
)
from marketbars.operators.merge import upsert_by_key
from marketbars.operators.refresh import changed_rows, refresh_tail
from marketbars.operators.series import calendar_block
from marketbars.storage import stage


def by_date(df):
    return {(r.symbol, r.date): r for r in df.collect()}


def test_first_row(spark):
    (row,) = enrich(bars(spark, [("A", "01-02", 10.0)])).collect()
    assert (row.prev_close, row.daily_change, row.daily_change_percent) == (10, 0, 0)
    assert (row.weekly_ma, row.monthly_ma, row.monthly_volatility) == (10, 10, None)
    assert tuple(row.asDict()) == S.SILVER_COLUMNS


def test_null_close(spark):
    rows = [
        ("A", "01-02", 10.0),
        ("A", "01-03", None),
        ("A", "01-04", 12.0),
        ("A", "01-05", None),
        ("A", "01-06", None),
    ]
    got = closes(
        enrich(bars(spark, rows)), "prev_close", "daily_change", "daily_change_percent", "weekly_ma"
    )
    assert [r[2:] for r in got] == [
        (10, 0, 0, 10),
        (10, 0, 0, 10),
        (12, 0, 0, 11),
        (12, 0, 0, 11),
        (None, 0, 0, 11),
    ]


def test_all_null_average(spark):
    (row,) = enrich(bars(spark, [("A", "01-02", None)])).collect()
    assert row.weekly_ma is None and row.monthly_ma is None and row.prev_close is None


def test_null_keys_are_dropped_before_the_windows(spark):
    rows = [("A", "01-02", 10.0), ("A", None, 99.0), (None, "01-03", 99.0), ("A", "01-04", 11.0)]
    got = closes(enrich(bars(spark, rows)), "prev_close")
    assert got == [("A", day("01-02"), 10.0), ("A", day("01-04"), 10.0)]


def test_nan_close(spark):
    rows = [("A", "01-02", 10.0), ("A", "01-03", math.nan), ("A", "01-04", 11.0)]
    got = [r[2] for r in closes(enrich(bars(spark, rows)), "daily_change_percent")]
    assert got[0] == 0 and math.isnan(got[1]) and math.isnan(got[2])


def test_zero_previous_close(spark):
    zero = bars(spark, [("A", "01-02", 0.0), ("A", "01-03", 5.0)])
    with pytest.raises(PySparkException, match="previous value is zero"):
        enrich(zero).collect()
    got = closes(enrich(zero, on_zero="null"), "daily_change", "daily_change_percent")
    assert [r[2:] for r in got] == [(0, 0), (5, 0)]
    with pytest.raises(ValueError):
        with_changes(zero, on_zero="ignore")


def test_frames_count_rows(spark):
    start = dt.date(2020, 1, 1)
    rows = [("A", str(start + dt.timedelta(i)), float(i + 1)) for i in range(40)]
    got = closes(enrich(bars(spark, rows)), "weekly_ma", "monthly_ma")
    assert got[39][2:] == (37, 25.5)
    assert got[2][2] == 2


def test_gaps_do_not_matter(spark):
    rows = [("A", "01-02", 1.0), ("A", "01-20", 2.0), ("A", "03-15", 6.0)]
    got = closes(enrich(bars(spark, rows)), "prev_close", "weekly_ma")
    assert got[2][2:] == (2, 3)


def test_volatility_is_per_calendar_month_and_year(spark):
    rows = [
        ("A", "2023-01-30", 100.0),
        ("A", "2023-01-31", 110.0),
        ("A", "2024-01-30", 110.0),
        ("A", "2024-01-31", 121.0),
    ]
    got = closes(enrich(bars(spark, rows)), "monthly_volatility")
    # The first row's 0 % takes part.
    assert [r[2] for r in got] == pytest.approx([math.sqrt(50)] * 4)


def test_operators_alone_equal_the_whole(spark):
    rows = random_bars(3, symbols=6)
    data = bars(spark, rows)
    whole = by_date(enrich(data))
    alone = with_month_volatility(with_changes(data))
    alone = with_moving_average(alone, "weekly_ma", 7)
    alone = with_moving_average(alone, "monthly_ma", 30)
    for key, row in by_date(alone.select(*S.SILVER_COLUMNS)).items():
        assert row == whole[key]


def random_bars(seed, symbols=40, first=1985, last=2024):
    """Series from daily to one bar in several years, with NULL closes."""
    rng = random.Random(seed)
    rows = []
    for s in range(symbols):
        at = dt.date(first, 1, 1) + dt.timedelta(rng.randrange(2000))
        step = rng.choice([1, 3, 12, 40, 150, 700])
        while at.year <= last and len(rows) < 400 * (s + 1):
            close = None if rng.random() < 0.05 else float(rng.randrange(1, 500))
            rows.append((f"S{s}", str(at), close))
            at += dt.timedelta(rng.randrange(1, 2 * step))
            if rng.random() < 0.01:
                at += dt.timedelta(rng.randrange(3000))
    rng.shuffle(rows)
    return rows


def uncut(data):
    """Silver with windows over whole series."""
    w = Window.partitionBy("symbol").orderBy("date")
    month = Window.partitionBy("symbol", F.trunc("date", "MM"))
    p = F.lag("close").over(w)
    c = F.col("close")
    return (
        data.withColumn("prev_close", F.coalesce(p, c))
        .withColumn("daily_change", F.coalesce(c - p, F.lit(0.0)))
        .withColumn("daily_change_percent", F.coalesce((c - p) / p * 100, F.lit(0.0)))
        .withColumn("weekly_ma", F.avg(c).over(w.rowsBetween(-6, 0)))
        .withColumn("monthly_ma", F.avg(c).over(w.rowsBetween(-29, 0)))
        .withColumn("monthly_volatility", F.stddev_samp("daily_change_percent").over(month))
    )


@pytest.mark.parametrize("years", [1, 2, 5, 30])
def test_cut_series_equal_uncut_ones(spark, years):
    data = stage(bars(spark, random_bars(11)))
    expected = uncut(data)
    actual = enrich(data, years=years)
    assert actual.count() == data.count()
    assert actual.exceptAll(expected).isEmpty()
    assert expected.exceptAll(actual).isEmpty()


def test_block_size_is_bounded_by_the_calendar(spark):
    days = spark.sql(
        "SELECT explode(sequence(date'1970-01-01', date'2029-12-31')) AS date, 'HOT' AS symbol"
    )
    sizes = [r["count"] for r in days.groupBy(calendar_block()).count().collect()]
    assert max(sizes) == 5 * 365 + 2 and len(sizes) == 12


def test_block_must_be_a_year_or_more(spark):
    with pytest.raises(ValueError):
        enrich(bars(spark, [("A", "01-02", 10.0)]), years=0)


def test_series_are_independent(spark):
    rows = random_bars(5, symbols=4)
    alone = by_date(enrich(bars(spark, rows)))
    more = by_date(enrich(bars(spark, rows + [("Z", "01-02", 1.0), ("Z", "01-05", 2.0)])))
    assert all(more[key] == row for key, row in alone.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_tail_refresh_equals_full_recompute(spark, seed):
    rng = random.Random(seed)
    rows = random_bars(seed, symbols=12)
    restated = [(s, d, float(rng.randrange(1, 500))) for s, d, _ in rng.sample(rows, 8)]
    newest = max(d for _, d, _ in rows)
    added = [("S0", "2025-06-01", 7.0), ("NEW", newest, 3.0)]
    before = stage(bars(spark, rows))
    batch = stage(bars(spark, restated + added))
    after = stage(upsert_by_key(before, batch))

    changed = changed_rows(before, after)
    assert {(r.symbol, str(r.date)) for r in changed.collect()} <= {
        (s, d) for s, d, _ in restated + added
    }
    refreshed = upsert_by_key(enrich(before), refresh_tail(after, changed))
    expected = by_date(enrich(after))
    actual = by_date(refreshed)
    assert actual.keys() == expected.keys()
    for key, row in expected.items():
        for name in S.SILVER_COLUMNS:
            want, got = row[name], actual[key][name]
            if isinstance(want, float):
                assert got == pytest.approx(want, abs=1e-9), (key, name)
            else:
                assert got == want, (key, name)


def test_tail_refresh_leaves_earlier_months_alone(spark):
    days = [(m, d) for m in (1, 2, 3) for d in range(1, 29)]
    data = stage(bars(spark, [("A", f"{m:02d}-{d:02d}", float(m * d)) for m, d in days]))
    changed = bars(spark, [("A", "02-20", 1.0)])
    dates = [r.date for r in refresh_tail(data, changed).collect()]
    assert min(dates) == day("02-01") and max(dates) == day("03-28") and len(dates) == 56


def test_a_long_average_equals_the_uncut_window(spark):
    start = dt.date(1990, 1, 1)
    rows = [("A", str(start + dt.timedelta(days=d)), float(d % 97)) for d in range(7000)]
    data = stage(bars(spark, rows))
    frame = Window.partitionBy("symbol").orderBy("date").rowsBetween(-2999, 0)
    expected = data.select("date", F.avg("close").over(frame).alias("ma"))
    actual = with_moving_average(data, "ma", 3000).select("date", "ma")
    assert sorted(actual.collect()) == sorted(expected.collect())
