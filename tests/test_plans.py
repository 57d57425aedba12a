"""The plans are the ones the operators promise."""

import re

import pytest
from conftest import TESTDATA
from frames import bars

from marketbars.operators.enrich import enrich, with_changes, with_month_volatility
from marketbars.operators.merge import absent_rows
from marketbars.operators.refresh import _bars_of
from marketbars.operators.series import BLOCK
from marketbars.operators.summary import summarize
from marketbars.operators.trend import day_index, fit_trend, forecast
from marketbars.plans.registry import QUERIES
from marketbars.session import shuffle_partitions
from marketbars.sinks import tables as sinks
from marketbars.sources.tables import symbol_slice
from marketbars.storage import stage


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def count(text, node):
    return len(re.findall(rf"(?<!\w){node}(?!\w)", text))


@pytest.fixture(scope="module")
def stored(spark):
    return stage(bars(spark, [("A", f"01-{d:02d}", float(d)) for d in range(1, 29)]))


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def final(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_silver(spark, stored):
    text = plan(enrich(stored))
    # Block ends, ends per symbol, the bars themselves: of these only the last
    # moves whole rows. No window is partitioned by symbol alone but the one
    # over block ends.
    assert count(text, "Exchange") == 3
    assert count(text, "Window") == 4
    assert count(text, "Sort") == 4  # one of them map-side, for the group limit
    assert "WindowGroupLimit" in text
    assert "Join" not in text
    assert "PushedFilters: [IsNotNull(date), IsNotNull(symbol)]" in text
    assert re.search(r"ReadSchema: struct<date:date,symbol:string,close:double>", text)


def test_volatility_goes_on_where_changes_left_the_rows(spark, stored):
    text = plan(with_month_volatility(with_changes(stored, keep_block=True)))
    assert count(text, "Exchange") == 3 and "Join" not in text


def test_gold_adds_neither_shuffle_nor_join(spark, stored):
    silver = enrich(stored, keep_block=True)
    text = plan(summarize(silver, also_by=(BLOCK,)))
    assert count(text, "Exchange") == 3 and "Join" not in text


def test_forecast_moves_rows_once(spark, stored):
    text = plan(forecast(stored))
    assert count(text, "Exchange") == 2 and "Join" not in text
    assert "ReadSchema: struct<date:date,symbol:string,close:double>" in text
    # Bars are cut by block, block sums meet per symbol.
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", text)
    assert sorted(windows) == ["symbol", f"symbol, {BLOCK}"]


def test_day_index(spark, stored, no_broadcast):
    # Rows move once; the other three move one row per block.
    text = plan(day_index(stored))
    assert count(text, "Exchange") == 4 and count(text, "SortMergeJoin") == 1


@pytest.fixture
def by_series(spark, stored):
    sinks.write_series(enrich(stored, keep_block=True), "by_series", buckets=4)
    yield spark.table("by_series")
    spark.sql("DROP TABLE by_series")


def test_layers_stored_by_series_are_not_shuffled(by_series, no_broadcast):
    """Exchanges move block sums, or days of gold that were reduced, and no bars."""
    text = plan(day_index(by_series))
    assert "Bucketed: true" in text and "SelectedBucketsCount: 4 out of 4" in text
    below = text.split("Window [row_number()")[1].split("SortMergeJoin")[0]
    assert "Exchange" not in below.split("FileScan")[0]
    assert count(text, "Exchange") == 2
    text = plan(forecast(by_series))
    assert count(text, "Exchange") == 1 and text.index("Exchange") < text.index("row_number")
    assert count(plan(summarize(by_series, also_by=(BLOCK,))), "Exchange") == 0


def test_bars_are_reduced_before_their_one_shuffle(spark):
    text = plan(QUERIES["bars_lineitem"](spark, str(TESTDATA / "sf0.001")))
    assert count(text, "Exchange") == 1 and "REPARTITION" not in text
    assert "hashpartitioning(date, symbol" in text
    below = text.split("Exchange hashpartitioning")[1]
    assert "partial_min_by" in below and "BroadcastHashJoin" in below


def test_no_python_in_plans(spark):
    for name in ("silver", "gold", "forecast_close", "ingest_increment", "upsert_by_key"):
        text = plan(QUERIES[name](spark, str(TESTDATA / "sf0.001")))
        assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", text), name


def test_slice_reaches_the_scan(spark, stored):
    assert "EqualTo(symbol,A)" in plan(symbol_slice(stored, "A"))


def test_merges_prune_the_target(spark):
    sinks.ensure_landing_table(spark, "pruned")
    year = bars(spark, [("A", f"{m:02d}-02", 1.0) for m in range(1, 13)])
    sinks.append_absent(year, "pruned")
    target = spark.table("pruned")
    batch = stage(target.where("month >= date'2020-11-01'"))
    new = absent_rows(sinks._months_of(target, batch), batch, ("month", "date", "symbol"))
    text = final(new)
    assert "SortMergeJoin" not in text and count(text, "BroadcastHashJoin") == 2
    assert re.search(r"PartitionFilters: \[[^\]]*month IN \(2020-11-01,2020-12-01\)", text)
    spark.sql("DROP TABLE pruned")


def test_tail_refresh_prunes_the_months_before_and_after(spark):
    sinks.ensure_landing_table(spark, "tail")
    year = bars(spark, [("A", f"{m:02d}-02", 1.0) for m in range(1, 13)])
    sinks.append_absent(year, "tail")
    months = stage(spark.sql("SELECT 'A' AS symbol, date'2020-05-01' AS month, true AS affected"))
    rows = _bars_of(spark.table("tail"), months)
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[[^\]]*month = 2020-05-01", text)
    assert [r.date.month for r in rows.collect()] == [5]
    spark.sql("DROP TABLE tail")


@pytest.mark.parametrize(
    ("size", "partitions"), [(0, 8), (2**20, 8), (10 * 2**40, 40_960), (100 * 2**40, 409_600)]
)
def test_shuffle_partitions_follow_the_size(size, partitions):
    assert shuffle_partitions(size) == partitions
