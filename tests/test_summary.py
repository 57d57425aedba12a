import pytest
from frames import bars, day

from marketbars import schemas as S
from marketbars.operators.enrich import enrich
from marketbars.operators.series import BLOCK
from marketbars.operators.summary import classify_anomaly, daily_summary, summarize


@pytest.mark.parametrize(
    ("percent", "label"),
    [
        (3.0, "Normal"),
        (-3.0, "Normal"),
        (3.0001, "High Positive Change"),
        (-3.0001, "High Negative Change"),
        (0.0, "Normal"),
        (None, "Normal"),
        (float("nan"), "High Positive Change"),
    ],
)
def test_label(spark, percent, label):
    df = spark.createDataFrame([(percent,)], "avg_daily_change_percent double")
    assert classify_anomaly(df).first().anomaly_type == label


def test_other_limits(spark):
    df = spark.createDataFrame([(2.0,), (-6.0,)], "avg_daily_change_percent double")
    got = [r.anomaly_type for r in classify_anomaly(df, up=1.0, down=-5.0).collect()]
    assert got == ["High Positive Change", "High Negative Change"]


def test_repeated_keys_are_averaged_and_summed(spark):
    first = enrich(bars(spark, [("A", "01-02", 10.0)]))
    second = enrich(bars(spark, [("A", "01-02", 20.0)]))
    second = second.withColumn("volume", second.volume + 1)
    (row,) = daily_summary(first.unionByName(second)).collect()
    assert (row.avg_close, row.total_volume) == (15, 3)


def test_extra_grouping_changes_nothing(spark):
    rows = [("A", f"{y}-12-{d}", float(d)) for y in (2019, 2020) for d in range(10, 32)]
    data = bars(spark, rows)
    plain = summarize(enrich(data))
    kept = summarize(enrich(data, keep_block=True), also_by=(BLOCK,))
    assert tuple(kept.columns) == S.GOLD_COLUMNS
    assert kept.exceptAll(plain).isEmpty() and kept.count() == plain.count() == 44


def test_gold_row(spark):
    rows = summarize(enrich(bars(spark, [("A", "01-02", 10.0), ("A", "01-03", 11.0)]))).collect()
    row = next(r for r in rows if r.date == day("01-03"))
    assert row.avg_daily_change == 1 and row.avg_daily_change_percent == 10
    assert row.anomaly_type == "High Positive Change"
