"""What daily runs read: months whose files changed, and their neighbours."""

import re
import uuid
from pathlib import Path

import pytest
from frames import bars, closes, day

from marketbars import schemas as S
from marketbars.operators.enrich import enrich
from marketbars.operators.summary import summarize
from marketbars.operators.trend import fit_months, fit_trend, forecast, month_sums
from marketbars.plans import jobs
from marketbars.sinks import tables as sinks
from marketbars.sinks.month_index import MonthIndex, files_by_month, in_months, refreshed
from marketbars.sources.tables import partition_values, read_layer, stored_months
from marketbars.storage import stage


@pytest.fixture
def tables(spark):
    run = uuid.uuid4().hex
    names = jobs.Tables(*[f"{n}_{run}" for n in ("l", "b", "s", "g", "fc", "fa")])
    yield names
    for row in spark.sql("SHOW TABLES").where(f"tableName LIKE '%{run}%'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {row.tableName}")


def year_of_bars(spark, first=2019, last=2020, symbols=("A", "B")):
    rows = [
        (s, f"{y}-{m:02d}-{d:02d}", float(10 + (d * m + y + ord(s)) % 17))
        for s in symbols
        for y in range(first, last + 1)
        for m in range(1, 13)
        for d in range(1, 26)
    ]
    return bars(spark, rows)


def spoil(spark, table, but):
    """Make the files of all months but some unreadable."""
    spoiled = 0
    for path in spark.table(table).inputFiles():
        if not any(f"month={m}" in path for m in but):
            file = Path(re.sub(r"^file:/*", "/", path))
            file.write_bytes(b"x" * file.stat().st_size)
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            spoiled += 1
    return spoiled


def test_months_are_named_in_one_order(spark, tables):
    sinks.ensure_landing_table(spark, tables.landing)
    sinks.append_absent(year_of_bars(spark, 2020), tables.landing)
    months = [day("12-01"), "2020-01-01", day("11-01")]
    for order in (months, months[::-1]):
        found = spark.table(tables.landing).where(in_months(order))
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "IN (2020-01-01,2020-11-01,2020-12-01)" in text
        assert found.count() == 150


def built(spark, tables):
    sinks.ensure_landing_table(spark, tables.landing)
    sinks.append_absent(year_of_bars(spark), tables.landing)
    jobs.build_layers(spark, tables)
    jobs.build_layers(spark, tables, mode="tail")
    jobs.forecast_close(spark, tables)
    jobs.forecast_avg_close(spark, tables)


def restate(spark, tables, *days):
    landing = read_layer(spark, tables.landing)
    changed = landing.where(landing.date.cast("string").isin(list(days)) & (landing.symbol == "A"))
    sinks.write_upsert(changed.withColumn("close", changed.close + 3), tables.landing)


def test_a_tail_run_opens_no_other_month(spark, tables):
    """An early and a late change: all months that they do not reach are unreadable."""
    built(spark, tables)
    jobs._build_tail(spark, tables, None)  # fills what a tail run with changes keeps
    restate(spark, tables, "2019-03-04")
    jobs.build_layers(spark, tables, mode="tail")
    before = read_layer(spark, tables.landing)
    expected = stage(before.withColumn("close", before.close))
    restate(spark, tables, "2019-02-10", "2020-09-20")
    landing = stage(read_layer(spark, tables.landing))
    assert not landing.exceptAll(expected).isEmpty()
    # 25 rows a month: 29 rows are two months, before a change and after it. Of 24 months.
    near = ["2019-01", "2019-02", "2019-03", "2019-04", "2020-07", "2020-08", "2020-09", "2020-10", "2020-11"]
    assert spoil(spark, tables.landing, ["2019-02", "2020-09"]) == 22
    assert spoil(spark, tables.bronze, ["2019-02", "2020-09", *near]) > 10
    assert spoil(spark, tables.silver, near) > 10
    jobs.build_layers(spark, tables, mode="tail")
    jobs.forecast_close(spark, tables)
    jobs.forecast_avg_close(spark, tables)

    silver = enrich(landing)
    gold = spark.table(tables.gold).where("month BETWEEN '2019-02-01' AND '2019-03-31'").drop("month")
    want = summarize(silver).where("date BETWEEN '2019-02-01' AND '2019-03-31'")
    assert gold.count() == 100
    exact = [c for c in S.GOLD_COLUMNS if c != "avg_monthly_volatility"]
    assert gold.select(*exact).exceptAll(want.select(*exact)).isEmpty()
    for name, source, y in (
        (tables.forecast_close, silver, "close"),
        (tables.forecast_avg_close, summarize(silver), "avg_close"),
    ):
        got = closes(spark.table(name), "predicted_close")
        assert [r[2] for r in got] == pytest.approx(
            [r[2] for r in closes(forecast(source, y), "predicted_close")]
        )
    # Whatever reads another month fails.
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_layer(spark, tables.bronze).agg({"close": "sum"}).collect()


def test_nothing_changed_nothing_is_read(spark, tables):
    built(spark, tables)
    jobs.build_layers(spark, tables, mode="tail")
    for name in (tables.landing, tables.bronze, tables.silver):
        assert spoil(spark, name, []) == 24
    jobs.build_layers(spark, tables, mode="tail")
    jobs.forecast_close(spark, tables)


def test_an_index_follows_its_table(spark, tables):
    seen = []

    def compute(rows):
        seen.append(sorted(r[0].month for r in rows.select("month").distinct().collect()))
        return rows.where("close > 1").groupBy("month", "symbol").count()

    index = MonthIndex("n", "symbol STRING, count BIGINT", compute)
    sinks.ensure_landing_table(spark, tables.landing)
    assert refreshed(spark, tables.landing, index).count() == 0 and seen == []
    sinks.append_absent(bars(spark, [("A", "01-02", 1.0), ("A", "02-02", 2.0)]), tables.landing)
    for _ in range(2):
        assert refreshed(spark, tables.landing, index).collect() == [("A", 1, day("02-01"))]
    sinks.append_absent(bars(spark, [("B", "02-03", 2.0), ("B", "03-03", 2.0)]), tables.landing)
    found = refreshed(spark, tables.landing, index)
    assert sorted(map(tuple, found.collect())) == [
        ("A", 1, day("02-01")), ("B", 1, day("02-01")), ("B", 1, day("03-01"))
    ]
    # January was empty and is known as such.
    assert seen == [[1, 2], [2, 3]]
    sinks.write_reload(bars(spark, [("C", "02-02", 9.0)]), tables.landing)
    assert refreshed(spark, tables.landing, index).collect() == [("C", 1, day("02-01"))]
    side = f"{tables.landing}__n"
    kept = {(p["month"], p["files"]) for p in partition_values(spark, side)}
    assert kept == set(files_by_month(spark, tables.landing).items())
    # A lost index is made again.
    spark.sql(f"DROP TABLE {side}")
    assert refreshed(spark, tables.landing, index).count() == 1


def test_repeated_keys_are_found_in_new_months_only(spark, tables):
    sinks.ensure_landing_table(spark, tables.landing)
    good = [("A", f"{m:02d}-02", 1.0) for m in range(1, 5)]
    sinks.append_absent(bars(spark, good), tables.landing)
    jobs.build_layers(spark, tables)
    assert len(stored_months(spark, f"{tables.landing}__copies")) == 4
    copies = bars(spark, [("A", "05-02", 1.0), ("A", "05-02", 2.0)])
    sinks._by_month(sinks._with_month(copies), tables.landing).write.insertInto(tables.landing)
    for mode in ("full", "tail"):
        with pytest.raises(ValueError, match="duplicate key"):
            jobs.build_layers(spark, tables, mode=mode)


@pytest.mark.parametrize("y", ["close", "volume"])
def test_lines_from_month_sums(spark, y):
    data = year_of_bars(spark, 2017, 2020).unionByName(bars(spark, [("C", "02-02", 5.0), ("D", "02-02", None)]))
    data = data.withColumn("volume", data.volume + data.date.cast("timestamp").cast("long") % 7)
    data = stage(data.unionByName(bars(spark, [("A", "12-30", float("nan"))])))
    whole = {r.symbol: r for r in fit_trend(data, y).collect()}
    months = {r.symbol: r for r in fit_months(month_sums(data, y)).collect()}
    assert set(whole) == set(months)
    for symbol, line in whole.items():
        assert months[symbol][:3] == line[:3]
        assert months[symbol][3:] == pytest.approx(line[3:], rel=1e-9, abs=1e-9)
