"""The pipeline, stage by stage."""

import pytest
from cases import documents, edit, prose, trouble
from conftest import TESTDATA

import corpus_pipeline
from marketbars.llm.shared import saved

STAGES = dict(corpus_pipeline.STAGES)
SF = str(TESTDATA / "sf0.001")


def ids(frame):
    return sorted(str(r.doc_id) for r in frame.collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_trouble(spark, name):
    docs = saved(documents(spark, trouble()))
    found = saved(STAGES[name](spark, docs, SF))
    if name != "packing":
        assert found.columns == docs.columns
    empty = saved(documents(spark, []))
    assert STAGES[name](spark, empty, SF).collect() == []


def test_letterless_documents_go(spark):
    docs = documents(spark, [(1, prose(1, 30)), (2, "1234 ..."), (3, None), (4, "")])
    assert ids(STAGES["language_id"](spark, docs, SF)) == ["1"]


def test_one_of_each_group_stays(spark):
    base = prose(1, 120)
    rows = [(5, base), (3, edit(base, 1, 1)), (9, base), (7, prose(2, 100)), (8, None), (6, "")]
    assert ids(STAGES["near_duplicates"](spark, documents(spark, rows), SF)) == ["3", "6", "7", "8"]


def test_repeats_go_and_the_rest_of_the_text_stays(spark):
    part = prose(3, 100)[:450]
    rows = [(1, "before " + part), (2, part + " after"), (3, part), (4, prose(4, 20))]
    found = {r.doc_id: r for r in STAGES["repeated_strings"](spark, documents(spark, rows), SF).collect()}
    assert sorted(found) == [1, 2, 4]
    assert found[1].text == "before " and found[1].n_chars == 7 and found[4].text == rows[3][1]


def test_leaked_documents_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, prose(1, 60) + " " + item), (2, prose(2, 80)), (None, item), (None, prose(3, 50))]
    assert ids(STAGES["decontamination"](spark, documents(spark, rows), SF)) == ["2", "None"]


def test_run(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    assert len({r.doc_id for r in found}) > 100
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
