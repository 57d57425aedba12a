import uuid
from pathlib import Path

import pytest
from frames import bars, closes, day
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.operators.merge import first_per_key
from marketbars.sinks import tables as sinks
from marketbars.sources.feed import ARRIVAL
from marketbars.sources.tables import read_layer
from marketbars.storage import shared_dir

JAN, FEB = day("01-02"), day("02-03")


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    sinks.ensure_landing_table(spark, name)
    sinks.ensure_landing_table(spark, name)
    yield name
    for suffix in ("", "__new", "__old"):
        spark.sql(f"DROP TABLE IF EXISTS {name}{suffix}")


def stored(spark, table):
    return closes(read_layer(spark, table), "close")


def test_landing_table_shape(spark, table):
    fields = {f.name: f.dataType.simpleString() for f in spark.table(table).schema}
    assert list(fields) == [*S.BAR_COLUMNS, S.MONTH]
    text = spark.sql(f"DESCRIBE TABLE {table}").where("col_name = 'symbol'").first().data_type
    assert text == "varchar(10)"


def test_insert_keeps_stored_rows(spark, table):
    sinks.append_absent(bars(spark, [("A", "01-02", 10.0)]), table)
    batch = bars(spark, [("A", "01-02", 11.0), ("A", "02-03", 12.0)])
    sinks.append_absent(batch, table)
    expected = [("A", JAN, 10.0), ("A", FEB, 12.0)]
    assert stored(spark, table) == expected
    sinks.append_absent(batch, table)
    assert stored(spark, table) == expected


def test_first_arrival_wins_within_a_batch(spark, table):
    rows = bars(spark, [("A", "01-02", 12.0), ("A", "01-02", 13.0), ("A", "01-02", 14.0)])
    batch = rows.withColumn(ARRIVAL, F.abs(F.col("close") - 13))
    assert first_per_key(batch).first().close == 13
    sinks.append_absent(batch, table)
    assert stored(spark, table) == [("A", JAN, 13.0)]


def test_an_insert_tells_what_it_met(spark, table):
    """Counted in the jobs that write; no pass of its own."""
    sinks.append_absent(bars(spark, [("A", "01-02", 1.0)]), table)
    rows = [("A", "01-02", 2.0), ("B", "01-02", 2.0), ("B", "01-02", 2.0), (None, "01-03", 1.0)]
    rows += [("A", None, 1.0), ("A", None, 2.0), ("ELEVEN_CHARS", "01-04", 1.0), ("C", "02-02", 3.0)]
    counts = sinks.append_absent(bars(spark, rows), table, "quarantine", f"{table}_aside")
    assert counts == sinks.Written(8, 2, null_dates=2, null_symbols=1, long_symbols=1)
    assert sinks.append_absent(bars(spark, rows[:3]), table) == sinks.Written(3, 0, 0, 0, 0)
    assert sinks.append_absent(bars(spark, []), table).written == 0
    spark.sql(f"DROP TABLE {table}_aside")


def test_keys_stay_unique_without_arrival(spark, table):
    sinks.append_absent(bars(spark, [("A", "01-02", 12.0), ("A", "01-02", 11.0)]), table)
    assert stored(spark, table) == [("A", JAN, 11.0)]


@pytest.mark.parametrize(
    "row", [("A", None, 1.0), (None, "01-02", 1.0), ("ABCDEFGHIJK", "01-02", 1.0)]
)
def test_bad_rows_fail_the_insert(spark, table, row):
    with pytest.raises(PySparkException):
        sinks.append_absent(bars(spark, [("A", "02-03", 1.0), row]), table)
    assert stored(spark, table) == []


def test_bad_rows_can_be_set_aside(spark, table):
    rows = [
        ("A", "01-02", 1.0),
        ("A", None, 2.0),
        (None, "01-02", 3.0),
        ("ABCDEFGHIJK", "01-02", 4.0),
    ]
    aside = f"{table}__old"
    sinks.append_absent(bars(spark, rows), table, "quarantine", aside)
    assert stored(spark, table) == [("A", JAN, 1.0)]
    assert sorted(r.close for r in spark.table(aside).collect()) == [2, 3, 4]
    with pytest.raises(ValueError):
        sinks.append_absent(bars(spark, rows), table, "quarantine")
    with pytest.raises(ValueError):
        sinks.append_absent(bars(spark, rows), table, "skip")


def test_upsert_replaces_keys_and_keeps_the_rest(spark, table):
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sinks.write_upsert(
        bars(spark, [("A", "01-02", 10.0), ("A", "02-03", 20.0), ("B", "02-03", 5.0)]), table
    )
    batch = bars(spark, [("A", "02-03", 21.0), ("A", "02-04", 22.0)])
    for _ in range(2):
        sinks.write_upsert(batch, table)
        assert stored(spark, table) == [
            ("A", JAN, 10.0),
            ("A", FEB, 21.0),
            ("A", day("02-04"), 22.0),
            ("B", FEB, 5.0),
        ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_upsert_rewrites_touched_months_only(spark, table):
    sinks.write_upsert(bars(spark, [("A", "01-02", 10.0), ("A", "02-03", 20.0)]), table)
    files = lambda: {
        r.month: r.file
        for r in spark.table(table).select("month", F.input_file_name().alias("file")).collect()
    }
    before = files()
    sinks.write_upsert(bars(spark, [("A", "02-03", 21.0)]), table)
    after = files()
    assert before[day("01-01")] == after[day("01-01")]
    assert before[day("02-01")] != after[day("02-01")]


def test_upsert_refuses_repeated_keys(spark, table):
    with pytest.raises(ValueError, match="duplicate key"):
        sinks.write_upsert(bars(spark, [("A", "01-02", 1.0), ("A", "01-02", 2.0)]), table)
    assert stored(spark, table) == []


def test_staged_copies_are_removed(spark, table):
    root = Path(shared_dir(spark)) / "marketbars"
    before = set(root.glob("*"))
    sinks.append_absent(bars(spark, [("A", "01-02", 10.0)]), table)
    sinks.write_upsert(bars(spark, [("A", "01-02", 11.0)]), table)
    assert set(root.glob("*")) == before
    assert stored(spark, table) == [("A", JAN, 11.0)]


def test_upsert_refuses_null_keys(spark, table):
    sinks.write_upsert(bars(spark, [("A", "01-02", 10.0)]), table)
    with pytest.raises(PySparkException):
        sinks.write_upsert(bars(spark, [("A", "01-02", 11.0), (None, "01-02", 1.0)]), table)
    assert stored(spark, table) == [("A", JAN, 10.0)]


def test_reload_drops_what_is_gone(spark, table):
    sinks.write_upsert(bars(spark, [("A", "01-02", 10.0)]), table)
    for _ in range(2):
        sinks.write_reload(bars(spark, [("B", "02-03", 1.0)]), table)
        assert stored(spark, table) == [("B", FEB, 1.0)]
    with pytest.raises(PySparkException):
        sinks.write_reload(bars(spark, [("B", "02-03", 1.0), ("B", None, 1.0)]), table)
    assert stored(spark, table) == [("B", FEB, 1.0)]


def test_failed_rebuild_keeps_the_old_table(spark):
    name = f"g_{uuid.uuid4().hex}"
    sinks.write_rebuild(bars(spark, [("A", "01-02", 10.0)]), name)
    broken = bars(spark, [("B", "01-02", 1.0)]).withColumn(
        "close", F.raise_error(F.lit("broken")).cast("double")
    )
    with pytest.raises(PySparkException, match="broken"):
        sinks.write_rebuild(broken, name)
    assert stored(spark, name) == [("A", JAN, 10.0)]
    sinks.write_rebuild(bars(spark, [("B", "01-02", 1.0)]), name)
    assert stored(spark, name) == [("B", JAN, 1.0)]
    spark.sql(f"DROP TABLE {name}")


def test_replace_empties_and_loads(spark):
    name = f"f_{uuid.uuid4().hex}"
    sinks.ensure_forecast_table(spark, name)
    schema = "symbol string, predicted_close double, date date"
    for value in (1.0, 2.0):
        sinks.write_replace(spark.createDataFrame([("A", value, JAN)], schema), name)
        assert [tuple(r) for r in spark.table(name).collect()] == [(JAN, "A", value)]
    with pytest.raises(PySparkException, match="predicted_close must not be NULL"):
        sinks.write_replace(spark.createDataFrame([("A", None, JAN)], schema), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(JAN, "A", 2.0)]
    # The definition is still the table's own.
    with pytest.raises(PySparkException, match="length limitation"):
        sinks.write_replace(spark.createDataFrame([("ABCDEFGHIJK", 1.0, JAN)], schema), name)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {name}__new")


def test_a_row_is_set_aside_once(spark, table):
    aside = f"{table}_aside"
    rows = [("A", "01-02", 1.0), (None, "01-03", 2.0)]
    for _ in range(2):
        sinks.append_absent(bars(spark, rows), table, "quarantine", aside)
    assert spark.table(aside).count() == 1
    spark.sql(f"DROP TABLE {aside}")


@pytest.mark.parametrize("lost_after", ["fill", "first renaming", "second renaming"])
def test_a_swap_that_was_cut_short_is_finished(spark, lost_after):
    one, two = (bars(spark, [("A", f"01-0{d + 2}", 1.0) for d in range(n)]) for n in (1, 2))
    sinks.write_rebuild(one, "swapped")
    two.write.saveAsTable("swapped__new")
    if lost_after != "fill":
        spark.sql("ALTER TABLE swapped RENAME TO swapped__old")
    if lost_after == "second renaming":
        spark.sql("ALTER TABLE swapped__new RENAME TO swapped")
    sinks.recover_swap(spark, "swapped")
    assert spark.table("swapped").count() == (1 if lost_after == "fill" else 2)
    for name in ("swapped__new", "swapped__old"):
        assert not spark.catalog.tableExists(name)
    spark.sql("DROP TABLE swapped")
