"""A month holds its old rows or its new ones, whenever a run is lost."""

import uuid

import pytest
from frames import bars, closes, day

from marketbars.sinks import publish
from marketbars.sinks import tables as sinks
from marketbars.sources.tables import read_layer, stored_months
from marketbars.storage import subfolders

OLD = [("A", "01-02", 1.0), ("A", "02-03", 2.0), ("B", "02-04", 3.0), ("B", "03-04", 4.0)]


@pytest.fixture
def table(spark):
    name = f"p_{uuid.uuid4().hex}"
    sinks.ensure_landing_table(spark, name)
    sinks.append_absent(bars(spark, OLD), name)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored(spark, table):
    return [(s, d.month, c) for s, d, c in closes(read_layer(spark, table), "close")]


def folders(spark, table):
    root = publish.table_folder(spark, table)
    own = [f for f in subfolders(spark, root) if f.startswith("month=")]
    runs = subfolders(spark, f"{root}/_published")
    return sorted(own), {r: sorted(subfolders(spark, f"{root}/_published/{r}")) for r in runs}


BATCH = [("A", "02-03", 9.0), ("A", "03-03", 8.0), ("C", "04-01", 7.0)]
BEFORE = [("A", 1, 1.0), ("A", 2, 2.0), ("B", 2, 3.0), ("B", 3, 4.0)]
AFTER = [("A", 1, 1.0), ("A", 2, 9.0), ("A", 3, 8.0), ("B", 2, 3.0), ("B", 3, 4.0), ("C", 4, 7.0)]


def test_a_run_lost_before_the_switch_leaves_the_old_rows(spark, table, monkeypatch):
    def lost(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(publish, "_switch", lost)
        with pytest.raises(RuntimeError, match="lost driver"):
            sinks.write_upsert(bars(spark, BATCH), table)
    assert stored(spark, table) == BEFORE
    assert len(folders(spark, table)[1]) == 1
    sinks.write_upsert(bars(spark, BATCH), table)
    assert stored(spark, table) == AFTER
    # What the lost run wrote is gone, and so are the replaced months.
    own, runs = folders(spark, table)
    assert own == ["month=2020-01-01"] and len(runs) == 1


def test_a_run_lost_between_two_months_leaves_each_whole(spark, table, monkeypatch):
    switch, calls = publish._switch, []

    def second_is_lost(spark, table, month, folder):
        calls.append(month)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        switch(spark, table, month, folder)

    with monkeypatch.context() as m:
        m.setattr(publish, "_switch", second_is_lost)
        with pytest.raises(RuntimeError, match="lost driver"):
            sinks.write_upsert(bars(spark, BATCH), table)
    spark.catalog.refreshTable(table)
    assert stored(spark, table) == [("A", 1, 1.0), ("A", 2, 9.0), ("B", 2, 3.0), ("B", 3, 4.0)]
    sinks.write_upsert(bars(spark, BATCH), table)
    assert stored(spark, table) == AFTER


def test_published_months_are_appended_to_and_replaced_again(spark, table):
    sinks.write_upsert(bars(spark, BATCH), table)
    sinks.append_absent(bars(spark, [("A", "02-03", 5.0), ("D", "02-20", 6.0)]), table)
    assert stored(spark, table) == sorted([*AFTER, ("D", 2, 6.0)])
    sinks.write_upsert(bars(spark, [("D", "02-20", 1.0)]), table)
    assert stored(spark, table) == sorted([*AFTER, ("D", 2, 1.0)])
    own, runs = folders(spark, table)
    assert own == ["month=2020-01-01"]
    assert sorted(runs.values()) == [["month=2020-02-01"], ["month=2020-03-01", "month=2020-04-01"]]


def test_a_reload_drops_other_months(spark, table):
    sinks.write_upsert(bars(spark, BATCH), table)
    sinks.write_reload(bars(spark, [("Z", "04-02", 1.0), ("Z", "05-02", 2.0)]), table)
    assert stored(spark, table) == [("Z", 4, 1.0), ("Z", 5, 2.0)]
    assert stored_months(spark, table) == [day("04-01"), day("05-01")]
    # Also one that fails leaves everything.
    with pytest.raises(Exception, match="symbol"):
        sinks.write_reload(bars(spark, [("SYMBOL_TOO_LONG", "06-02", 1.0)]), table)
    assert stored(spark, table) == [("Z", 4, 1.0), ("Z", 5, 2.0)]
    sinks.write_reload(bars(spark, []), table)
    assert stored(spark, table) == [] and stored_months(spark, table) == []
