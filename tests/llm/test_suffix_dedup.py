"""Removal of repeated strings against a table of all strings."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, prose, trouble

from marketbars.llm.suffix_dedup import Prefixes, _sorted_within, remove_repeats


def expected(rows, length):
    datas = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[p : p + length] for _, d in datas for p in range(len(d) - length + 1))
    out = []
    for i, d in datas:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((str(i), len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def actual(frame):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


PASSAGE = prose(40, 90)
ROWS = [
    *trouble(),
    *((50 + k, prose(60 + k, 30) + PASSAGE[k * 7 : 450 + k * 11] + prose(90 + k, 30)) for k in range(8)),
    (70, "ab" * 500),
    (71, "x" * 199 + "ab" * 210),
    (72, PASSAGE + PASSAGE),
]
ROWS = [(i, t if t is None else t[:9000]) for i, t in ROWS]


@pytest.mark.parametrize(("length", "most"), [(400, 16_384), (400, 2), (101, 16_384)])
def test_repeats(spark, length, most):
    """With `most` of 2, groups go by the way for frequent strings."""
    got = actual(remove_repeats(documents(spark, ROWS), length, most=most))
    assert got == expected(ROWS, length)


@pytest.mark.parametrize(("also", "most"), [(220, 16_384), (220, 2), (60, 16_384)])
def test_shorter_repeats_are_counted_beside(spark, also, most):
    found = remove_repeats(documents(spark, ROWS), most=most, also=also)
    assert actual(found) == expected(ROWS, 400)
    counts = sorted((str(r.doc_id), r.n_bytes, r.n_repeated) for r in found.collect())
    exact = sorted((i, n, gone) for i, n, gone, *_ in expected(ROWS, also))
    assert [c[:2] for c in counts] == [c[:2] for c in exact]
    for (i, _, got), (_, _, most) in zip(counts, exact, strict=True):
        assert got <= most and (got > 0) == (most > 0), i
    assert sum(c[2] for c in counts) > 0.97 * sum(c[2] for c in exact)
    with pytest.raises(ValueError):
        remove_repeats(documents(spark, ROWS), also=400)


def test_an_empty_table(spark):
    assert remove_repeats(documents(spark, [])).collect() == []


def test_the_kept_text(spark):
    rows = [(1, "é" * 30 + PASSAGE[:420]), (2, PASSAGE[:420] + "ß"), (3, "short")]
    found = {r.doc_id: r.kept for r in remove_repeats(documents(spark, rows), keep_text=True).collect()}
    assert found == {1: "é" * 30, 2: "ß", 3: None}


def test_the_sort_is_a_suffix_sort():
    data = (b"banana bandana " * 9 + b"cab") * 2
    code = np.frombuffer(data, np.uint8)
    at = np.arange(len(code))
    group = np.repeat([0, 1, 2], [100, 1, len(code) - 101])
    for step, room, text in (
        (1, len(code) - at, lambda p: data[p:]),
        (-1, at, lambda p: data[:p][::-1]),
    ):
        order = _sorted_within(Prefixes(code), at, room, group, step)
        for g in range(3):
            mine = order[group == g]
            assert [text(p) for p in mine] == sorted(text(p) for p in at[group == g])
