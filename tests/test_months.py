"""What a daily run reads: the newest months, and those that differ."""

import datetime as dt

from frames import bars
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import month_bucket
from marketbars.operators.refresh import differing_months, fingerprints
from marketbars.operators.watermark import newest_dates
from marketbars.sinks import tables as sinks
from marketbars.sources.tables import stored_months
from marketbars.storage import stage


def _dated(df):
    return stage(df.withColumn(S.MONTH, month_bucket("date")))


def test_months_differ_by_any_value_and_by_repeated_rows(spark):
    rows = [("A", f"{m:02d}-0{d}", 1.0) for m in range(1, 7) for d in (1, 2)]
    before = _dated(bars(spark, rows))
    changed = [("A", d, 2.0 if d == "02-01" else c) for s, d, c in rows if d != "05-02"]
    after = _dated(bars(spark, [*changed, ("A", "03-01", 1.0), ("A", "09-01", 1.0), ("A", "04-03", None)]))
    before, after = fingerprints(before), fingerprints(after)
    assert [m.month for m in differing_months(before, after)] == [2, 3, 4, 5, 9]
    assert differing_months(before, before) == []


def test_the_newest_months_first(spark):
    sinks.ensure_landing_table(spark, "months")
    rows = [("A", f"2020-{m:02d}-03", 1.0) for m in range(1, 13)]
    rows += [("B", "2011-07-09", 1.0), ("C", "2020-11-30", 1.0)]
    sinks.append_absent(bars(spark, rows), "months")
    read = []

    def staged(df):
        read.append(df.select("symbol").count())
        return stage(df)

    symbols = spark.createDataFrame([("A",), ("B",), ("C",), ("NEW",)], "symbol string")
    months = stored_months(spark, "months")
    assert len(months) == 13
    found = newest_dates(symbols, spark.table("months"), months, staged).collect()
    assert {r.symbol: r.max_date for r in found} == {
        "A": dt.date(2020, 12, 3), "B": dt.date(2011, 7, 9), "C": dt.date(2020, 11, 30)
    }
    # A in the last month, C in the two before, nothing in the next four, B in the rest.
    assert read == [1, 1, 0, 1]
    read.clear()
    newest_dates(symbols.where(F.col("symbol") == "A"), spark.table("months"), months, staged)
    assert read == [1]
    assert newest_dates(symbols, spark.table("months"), [], staged).collect() == []
    spark.sql("DROP TABLE months")
