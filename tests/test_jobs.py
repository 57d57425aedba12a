import uuid

import pytest
from frames import bars, closes, day
from test_enrich import random_bars, uncut

from marketbars import schemas as S
from marketbars.cli import main
from marketbars.operators.summary import summarize
from marketbars.operators.trend import forecast
from marketbars.plans import jobs
from marketbars.sinks import tables as sinks
from marketbars.sources.feed import normalize_feed, read_feed
from marketbars.sources.tables import read_layer, symbol_universe
from marketbars.streaming.landing import ingest_stream


@pytest.fixture
def tables(spark):
    run = uuid.uuid4().hex
    names = jobs.Tables(*[f"{n}_{run}" for n in ("l", "b", "s", "g", "fc", "fa")])
    yield names
    for row in spark.sql("SHOW TABLES").where(f"tableName LIKE '%{run}%'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {row.tableName}")


def land(spark, path, rows, mode="append"):
    data = [
        (f"{d} 00:00:00-05:00", s, c, c, c, c, 1, 0.0, 0.0, q) for q, (s, d, c) in enumerate(rows)
    ]
    frame = spark.createDataFrame(data, S.FEED).coalesce(1)
    frame.write.mode(mode).option("header", "true").csv(str(path))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_ingest_twice_loads_once(spark, tables, tmp_path):
    days = [f"2020-01-{d:02d}" for d in range(1, 11)]
    land(spark, tmp_path / "feed", [(s, d, 1.0) for s in ("AAPL", "X") for d in days])
    feed = normalize_feed(read_feed(spark, str(tmp_path / "feed")))
    for _ in range(2):
        jobs.ingest(spark, feed, "2020-01-06", table=tables.landing)
        got = closes(read_layer(spark, tables.landing))
        assert got == [("AAPL", day(f"01-{d:02d}")) for d in range(1, 5)]
    # A later run continues behind the mark and takes up a new symbol.
    symbols = symbol_universe(spark, ["AAPL", "X"])
    jobs.ingest(spark, feed, "2020-01-08", symbols, tables.landing)
    got = closes(read_layer(spark, tables.landing))
    assert got == [(s, day(f"01-{d:02d}")) for s in ("AAPL", "X") for d in range(1, 7)]


def test_stream_equals_one_batch_load(spark, tables, tmp_path):
    feed, checkpoint = tmp_path / "feed", str(tmp_path / "checkpoint")
    first = [("A", f"2020-01-{d:02d}", float(d)) for d in range(1, 9)]
    second = [("A", "2020-01-08", 99.0), ("A", "2020-01-09", 9.0), ("B", "2020-02-01", 1.0)]

    land(spark, feed, first)
    ingest_stream(spark, str(feed), tables.landing, checkpoint)
    assert len(closes(read_layer(spark, tables.landing))) == 8
    land(spark, feed, second)
    ingest_stream(spark, str(feed), tables.landing, checkpoint)
    loaded = closes(read_layer(spark, tables.landing), "close")
    assert loaded == sorted(
        (s, day(d), c) for s, d, c in first + second[1:]
    )
    # Nothing new, then everything again from a lost checkpoint.
    ingest_stream(spark, str(feed), tables.landing, checkpoint)
    ingest_stream(spark, str(feed), tables.landing, str(tmp_path / "other"))
    assert closes(read_layer(spark, tables.landing), "close") == loaded

    sinks.ensure_landing_table(spark, tables.bronze)
    sinks.append_absent(normalize_feed(read_feed(spark, str(feed))), tables.bronze)
    assert closes(read_layer(spark, tables.bronze), "close") == loaded


def test_layers_and_forecasts(spark, tables):
    rows = random_bars(21, symbols=6, first=2008, last=2013)
    sinks.ensure_landing_table(spark, tables.landing)
    sinks.append_absent(bars(spark, rows), tables.landing)
    jobs.build_layers(spark, tables)
    landing = read_layer(spark, tables.landing)
    assert same(read_layer(spark, tables.bronze), landing)
    assert same(read_layer(spark, tables.silver), uncut(landing).select(*S.SILVER_COLUMNS))
    assert same(read_layer(spark, tables.gold), summarize(read_layer(spark, tables.silver)))

    jobs.forecast_close(spark, tables)
    jobs.forecast_avg_close(spark, tables)
    expected = forecast(landing, "close")
    symbols = landing.where("close is not null").select("symbol").distinct().count()
    for name in (tables.forecast_close, tables.forecast_avg_close):
        assert spark.table(name).columns == list(S.FORECAST_COLUMNS)
        assert spark.table(name).count() == 30 * symbols
        got = closes(spark.table(name), "predicted_close")
        want = closes(expected, "predicted_close")
        assert [r[:2] for r in got] == [r[:2] for r in want]
        assert [r[2] for r in got] == pytest.approx([r[2] for r in want])


def test_tail_build_equals_full_build(spark, tables):
    rows = random_bars(22, symbols=5, first=2008, last=2016)
    sinks.ensure_landing_table(spark, tables.landing)
    sinks.append_absent(bars(spark, [r for r in rows if r[1] < "2015"]), tables.landing)
    jobs.build_layers(spark, tables)
    sinks.append_absent(bars(spark, rows), tables.landing)
    jobs.build_layers(spark, tables, mode="tail")
    expected = uncut(read_layer(spark, tables.landing)).select(*S.SILVER_COLUMNS)
    # The deviation may differ in the last bits, its sums run in another order.
    exact = [c for c in S.SILVER_COLUMNS if c != "monthly_volatility"]
    assert same(read_layer(spark, tables.silver).select(*exact), expected.select(*exact))
    assert same(read_layer(spark, tables.bronze), read_layer(spark, tables.landing))
    # Nothing changed: nothing to do.
    jobs.build_layers(spark, tables, mode="tail", since="2015-01-01")
    assert same(read_layer(spark, tables.silver).select(*exact), expected.select(*exact))


def test_a_stream_feeds_the_layers(spark, tables, tmp_path, monkeypatch):
    feed, checkpoint = tmp_path / "feed", str(tmp_path / "checkpoint")
    days = [f"2020-{m:02d}-{d:02d}" for m in range(1, 5) for d in range(1, 29)]
    rows = [(s, d, float(10 + (i * 7) % 13)) for s in ("A", "B") for i, d in enumerate(days)]
    land(spark, feed, [r for i, r in enumerate(rows) if i % 3])
    jobs.stream_layers(spark, str(feed), checkpoint, tables)
    land(spark, feed, rows)

    def lost(*_):
        raise RuntimeError("lost driver")

    # The rows are inserted, the layers are not: the batch comes again.
    with monkeypatch.context() as m:
        m.setattr(jobs, "_follow", lost)
        with pytest.raises(Exception, match="lost driver"):
            jobs.stream_layers(spark, str(feed), checkpoint, tables)
    spark.catalog.refreshTable(tables.landing)
    assert read_layer(spark, tables.landing).count() == len(rows)
    assert read_layer(spark, tables.bronze).count() < len(rows)
    jobs.stream_layers(spark, str(feed), checkpoint, tables)
    landing = read_layer(spark, tables.landing)
    assert same(read_layer(spark, tables.bronze), landing)
    exact = [c for c in S.SILVER_COLUMNS if c != "monthly_volatility"]
    expected = uncut(landing).select(*S.SILVER_COLUMNS)
    assert same(read_layer(spark, tables.silver).select(*exact), expected.select(*exact))
    exact = [c for c in S.GOLD_COLUMNS if c != "avg_monthly_volatility"]
    assert same(read_layer(spark, tables.gold).select(*exact), summarize(expected).select(*exact))


def test_deleted_rows_stay_until_a_rebuild(spark, tables):
    sinks.ensure_landing_table(spark, tables.landing)
    sinks.append_absent(bars(spark, [("A", "01-02", 1.0), ("B", "01-02", 2.0)]), tables.landing)
    jobs.build_layers(spark, tables)
    sinks.write_reload(bars(spark, [("A", "01-02", 1.0)]), tables.landing)
    jobs.build_layers(spark, tables)
    assert len(closes(read_layer(spark, tables.silver))) == 2
    assert len(closes(read_layer(spark, tables.gold))) == 2
    jobs.build_layers(spark, tables, rebuild=True)
    assert closes(read_layer(spark, tables.silver)) == [("A", day("01-02"))]
    assert closes(read_layer(spark, tables.gold)) == [("A", day("01-02"))]
    # A rebuilt table takes upserts like one created empty.
    jobs.build_layers(spark, tables)
    assert closes(read_layer(spark, tables.silver)) == [("A", day("01-02"))]


def test_duplicate_keys_stop_the_build(spark, tables):
    data = bars(spark, [("A", "01-02", 1.0), ("A", "01-02", 2.0)])
    sinks.ensure_landing_table(spark, tables.landing)
    sinks.write_reload(data, tables.landing)
    with pytest.raises(ValueError, match="duplicate key"):
        jobs.build_layers(spark, tables)
    with pytest.raises(ValueError):
        jobs.build_layers(spark, tables, mode="some")
    with pytest.raises(ValueError, match="since"):
        jobs.build_layers(spark, tables, since="2020-01-01")


def test_command_line(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    feed, more = tmp_path / "feed", tmp_path / "more"
    days = [f"2024-01-{d:02d}" for d in range(2, 13)]
    land(spark, feed, [("AAPL", d, float(i + 10)) for i, d in enumerate(days)])
    land(spark, more, [("MSFT", "2024-01-02", 5.0)])

    def run(*arguments):
        main(["--database", database, *arguments], spark)

    run("ingest", str(feed), "--as-of", "2024-01-10")
    run("stream", str(more), "--checkpoint", str(tmp_path / "state"))
    run("build")
    run("ingest", str(feed), "--as-of", "2024-01-14")
    run("build", "--mode", "tail", "--since", "2024-01-09")
    run("forecast", "--horizon", "3")
    gold = closes(spark.table(f"{database}.{S.GOLD_TABLE}"), "avg_close", "anomaly_type")
    assert [r[:3] for r in gold] == [
        *[("AAPL", day(d), float(i + 10)) for i, d in enumerate(days)],
        ("MSFT", day("2024-01-02"), 5.0),
    ]
    assert gold[1][3] == "High Positive Change"
    for name in (S.FORECAST_CLOSE_TABLE, S.FORECAST_AVG_CLOSE_TABLE):
        got = closes(spark.table(f"{database}.{name}"), "predicted_close")
        assert [r[2] for r in got] == pytest.approx([21, 22, 23, 5, 5, 5])
    with pytest.raises(SystemExit):
        run("build", "--mode", "some")
    spark.sql(f"DROP DATABASE {database} CASCADE")
