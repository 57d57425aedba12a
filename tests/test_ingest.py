import datetime as dt
import json

import pytest
from frames import bars, closes, day
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.operators import audit
from marketbars.operators.merge import first_per_key, insert_if_absent, upsert_by_key
from marketbars.operators.watermark import ingest_window, watermarks
from marketbars.sources.feed import ARRIVAL, normalize_feed, read_feed
from marketbars.sources.tables import history, symbol_universe


def feed(spark, rows):
    data = [(d, s, c, c, c, c, 1, 0.0, 0.0, seq) for s, d, c, seq in rows]
    return spark.createDataFrame(data, S.FEED)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_local_date_is_kept(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = normalize_feed(feed(spark, [("A", "2020-01-02 23:00:00-05:00", 1.0, 1)])).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got.date == day("01-02")


def test_normal_form(spark):
    extra = feed(spark, [("A", "2020-01-02", 1.0, 1)]).withColumn("Capital Gains", F.lit(1.0))
    got = normalize_feed(extra)
    assert got.columns == list(S.BAR_COLUMNS)
    assert [f.dataType for f in got.schema] == [f.dataType for f in S.BARS]
    unnamed = normalize_feed(extra.drop("Symbol"), symbol="MSFT")
    assert unnamed.first().symbol == "MSFT"


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_feed_formats(spark, tmp_path, fmt):
    rows = [("A", "2020-01-02 00:00:00-05:00", 1.5, 1), ("B", "2020-01-03 00:00:00-05:00", 2.5, 2)]
    path = str(tmp_path / fmt)
    writer = feed(spark, rows).write.format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)
    got = normalize_feed(read_feed(spark, path, fmt))
    assert closes(got, "close") == [("A", day("01-02"), 1.5), ("B", day("01-03"), 2.5)]
    assert ARRIVAL in got.columns


def test_feed_file_of_another_shape_fails(spark, tmp_path):
    path = str(tmp_path / "feed")
    shifted = feed(spark, [("A", "2020-01-02", 1.5, 1)]).select("Symbol", "Date", "Open", "Low")
    shifted.write.option("header", "true").csv(path)
    with pytest.raises(Exception, match="no column High"):
        normalize_feed(read_feed(spark, path)).collect()


def test_watermarks(spark):
    target = bars(spark, [("A", "01-04", 1.0), ("A", "01-05", 1.0), ("C", "01-09", 1.0)])
    got = watermarks(symbol_universe(spark, ["A", "B"]), target).collect()
    assert {(r.symbol, r.max_date, r.start_date) for r in got} == {
        ("A", day("01-05"), day("01-06")),
        ("B", None, day("01-01")),
    }


def test_default_universe(spark):
    assert sorted(r.symbol for r in symbol_universe(spark).collect()) == ["AAPL", "GOOGL", "MSFT"]


def test_window_ends_before_yesterday_and_skips_late_rows(spark):
    rows = [("A", f"01-{d:02d}", float(d)) for d in range(1, 12)] + [("X", "01-07", 1.0)]
    marks = watermarks(symbol_universe(spark, ["A"]), bars(spark, [("A", "01-05", 1.0)]))
    got = ingest_window(bars(spark, rows), marks, "2020-01-10")
    assert [r[1] for r in closes(got)] == [day("01-06"), day("01-07"), day("01-08")]
    assert ingest_window(bars(spark, rows), marks, dt.date(2020, 1, 7)).isEmpty()


def test_history(spark):
    rows = [("A", f"01-{d:02d}", 1.0) for d in range(1, 9)] + [("B", "01-03", 1.0)]
    got = history(bars(spark, rows), "A", "2020-01-02", "2020-01-04")
    assert closes(got) == [("A", day("01-02")), ("A", day("01-03"))]


def test_insert_if_absent(spark):
    target = bars(spark, [("A", "01-02", 10.0)])
    batch = bars(spark, [("A", "01-02", 11.0), ("A", "01-03", 13.0), ("A", "01-03", 12.0)])
    order = F.when(F.col("close") == 13, 3).otherwise(F.col("close") - 10)
    batch = first_per_key(batch.withColumn(ARRIVAL, order))
    once = insert_if_absent(target, batch)
    expected = [("A", day("01-02"), 10.0), ("A", day("01-03"), 12.0)]
    assert closes(once, "close") == expected
    assert closes(insert_if_absent(once, batch), "close") == expected


def test_first_per_key_decides_equal_arrivals(spark):
    rows = [("A", "01-03", float(c)) for c in (7, 3, 5)]
    batch = bars(spark, rows).withColumn(ARRIVAL, F.lit(1))
    assert closes(first_per_key(batch), "close") == [("A", day("01-03"), 3.0)]


def test_copies_of_one_key_are_reduced_before_the_shuffle(spark):
    """One key holds a third of a large batch: each task sends one row of it."""
    hot = spark.range(100_000, numPartitions=4).selectExpr(
        "date'2020-01-02' AS date", "'HOT' AS symbol", "id"
    )
    rest = spark.range(200_000, numPartitions=4).selectExpr(
        "date_add(date'1990-01-01', cast(id % 10000 as int)) AS date",
        "concat('S', id div 10000) AS symbol",
        "id",
    )
    batch = hot.unionByName(rest).select("date", "symbol", F.col("id").alias(ARRIVAL), "id")
    first = first_per_key(batch)
    assert first.where("symbol = 'HOT'").first().id == 0
    assert first.count() == 200_001
    first.write.format("noop").mode("overwrite").save()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1 and "Window" not in plan


def test_upsert(spark):
    target = bars(spark, [("A", "01-02", 10.0), ("A", "02-03", 20.0)])
    batch = bars(spark, [("A", "02-03", 21.0), ("A", "02-04", 22.0)])
    once = upsert_by_key(target, batch)
    expected = [("A", day("01-02"), 10.0), ("A", day("02-03"), 21.0), ("A", day("02-04"), 22.0)]
    assert closes(once, "close") == expected
    assert closes(upsert_by_key(once, batch), "close") == expected


def test_audits(spark):
    data = bars(
        spark,
        [
            ("A", "01-02", 1.0),
            ("A", "01-02", 2.0),
            (None, "01-03", None),
            ("ABCDEFGHIJK", None, 1.0),
        ],
    )
    nulls = audit.audit_nulls(data, ("date", "symbol", "close")).first()
    assert nulls.asDict() == {"date_nulls": 1, "symbol_nulls": 1, "close_nulls": 1}
    (twice,) = audit.audit_duplicates(data).collect()
    assert (twice.symbol, twice.copies) == ("A", 2)
    (long,) = audit.audit_length(data).collect()
    assert (long.symbol, long.rows, long.length) == ("ABCDEFGHIJK", 1, 11)
    with pytest.raises(ValueError, match="duplicate key"):
        audit.reject_duplicates(data)
    with pytest.raises(PySparkException, match="symbol must not be NULL"):
        audit.require_not_null(data, ("symbol",)).collect()


PLAIN = "Date,Open,High,Low,Close,Volume,Dividends,Stock Splits,Symbol,Capital Gains"


def _plain(folder, *lines, header=PLAIN):
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def test_columns_are_found_by_name(spark, tmp_path):
    path = _plain(tmp_path / "feed", "2020-01-02 00:00:00-05:00,1,4,0.5,2,100,0,0,A,0")
    (row,) = normalize_feed(read_feed(spark, path)).collect()
    assert (row.symbol, row.open, row.high, row.low, row.close, row.volume) == ("A", 1, 4, 0.5, 2, 100)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_without_seq_the_first_row_of_a_file_wins(spark, tmp_path, fmt):
    from marketbars.operators.merge import first_per_key

    folder = tmp_path / "feed"
    if fmt == "csv":
        day = "2020-01-02 00:00:00-05:00,1,4,0.5,{},100,0,0,A,0"
        _plain(folder, *(day.format(c) for c in (13, 12, 14)))
    else:
        folder.mkdir()
        rows = [{"Date": "2020-01-02 00:00:00-05:00", "Symbol": "A", "Close": c} for c in (13.0, 12.0, 14.0)]
        (folder / "part.json").write_text("\n".join(map(json.dumps, rows)))
    (row,) = first_per_key(normalize_feed(read_feed(spark, str(folder), fmt))).collect()
    assert row.close == 13


def test_a_missing_column_fails(spark, tmp_path):
    path = _plain(tmp_path / "feed", "2020-01-02,1,A", header="Date,Open,Symbol")
    with pytest.raises(ValueError, match="High"):
        read_feed(spark, path)


def test_text_that_is_no_number_fails(spark, tmp_path):
    path = _plain(tmp_path / "feed", "2020-01-02 00:00:00-05:00,x,4,0.5,2,100,0,0,A,0")
    with pytest.raises(Exception, match="Open is no double"):
        normalize_feed(read_feed(spark, path)).collect()


def test_the_symbol_from_the_file_name(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    header = PLAIN.replace(",Symbol", "")
    for symbol in ("A", "B"):
        line = "2020-01-02 00:00:00-05:00,1,4,0.5,2,100,0,0,0"
        (folder / f"{symbol}.csv").write_text(f"{header}\n{line}\n")
    name = F.regexp_extract("arrival.file", r"([^/]+)[.]csv$", 1)
    got = normalize_feed(read_feed(spark, str(folder)), symbol=name)
    assert sorted(r.symbol for r in got.collect()) == ["A", "B"]
