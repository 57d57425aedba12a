"""Neighbours and hard negatives against comparing everything."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import TESTDATA

from marketbars.llm import hard_negatives
from marketbars.llm.hard_negatives import SortedLists, Wanted, find, mine, negatives_of_fiftieths
from marketbars.llm.nearest_neighbours import Graph, nearest_neighbours, nearest_of_hundredths
from marketbars.llm.queries import QUERIES
from marketbars.llm.shared import importable

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, shard int, kind int, ids string"
ODD = float("nan"), float("inf"), -float("inf")


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "v", 1, 1, "i") for r in rows], SCHEMA)


def crowd(n, dimension, seed=0, spread=0.02):
    """Vectors of which a third are near copies of one, others copies of each other."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dimension))
    x[: n // 3] = x[0] + spread * rng.normal(size=(n // 3, dimension))
    x[n // 3 : n // 2] = x[n // 3 + rng.integers(0, 7, n // 2 - n // 3)]
    return x.astype(np.float32)[rng.permutation(n)]


def trouble(dimension=3):
    one = [float(i + 1) for i in range(dimension)]
    rows = [(0, one, 1), (0, one, 1), (100, [2.0, 0.0, 0.0], 1), (7, None, 1), (8, [0.0] * dimension, 2)]
    rows += [(9, [1.0, None, 2.0], 1), (None, one, 1), (12, one, None), (13, [], 3), (14, [1.0, 2.0], 1)]
    rows += [(20 + i, [1.0, x, 0.0], 1) for i, x in enumerate(ODD)]
    rows += [(30 + i, one, i % 3) for i in range(40)] + [(200, [-0.0, 1.0, 0.5], 2), (50, one, 1)]
    return rows + [(300, [1.0, 2.0], 1), (301, [1.5, 2.0], 2), (400, [5.0], 1)]


def usable(vector):
    return vector is not None and len(vector) and all(x is not None and math.isfinite(x) for x in vector)


def by_distance(rows, k):
    """For each query id: (distance, id), the nearest first."""
    rows = {(i, tuple(v)) for i, v, _ in rows if i is not None and usable(v) and any(v)}
    found = {}
    for q, a in rows:
        if q % 100 == 0:
            away = [(math.dist(a, b), i) for i, b in rows if i != q and len(b) == len(a)]
            found[q] = sorted(away)[:k]
    return {q: v for q, v in found.items() if v}


def test_neighbours_trouble(spark):
    rows = trouble()
    expected = by_distance(rows, 10)
    got = {}
    for r in nearest_of_hundredths(frame(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    assert {q: [i for _, i in v] for q, v in got.items()} == {
        q: [i for _, i in v] for q, v in expected.items()
    }
    for q, found in got.items():
        assert [s for s, _ in found] == pytest.approx([s for s, _ in expected[q]], abs=1e-12)


def test_neighbours_empty(spark):
    assert nearest_of_hundredths(frame(spark, [])).count() == 0
    assert nearest_of_hundredths(frame(spark, [(0, [1.0, 2.0], 1)])).count() == 0


def test_neighbours_of_copies_are_the_smallest_ids(spark):
    rows = [(i, [1.0, 1.0], 0) for i in range(400)] + [(1000, [1.0, 1.1], 0)]
    found = nearest_of_hundredths(frame(spark, rows)).orderBy("query_id", "rank").collect()
    for q in (0, 100, 1000):
        ids = [r.vec_id for r in found if r.query_id == q]
        assert ids == [i for i in range(11) if i != q][:10]


def recall(found, points, queries, k=10):
    caught = 0
    for q, ids in found.items():
        away = np.sqrt(((points - points[q]) ** 2).sum(1))
        away[q] = np.inf
        kth = np.sort(away)[k - 1]
        caught += sum(away[i] <= kth for i in ids)
    return caught / (k * len(queries))


@pytest.mark.parametrize("source", ["sf0.1", "crowd"])
def test_recall(spark, source):
    """Recall of the ten nearest, over several shards, also around near copies."""
    if source == "crowd":
        points = crowd(3000, 24).astype(float)
        rows = [(i, v.tolist(), 0) for i, v in enumerate(points)]
    else:
        table = pq.read_table(TESTDATA / source / "embeddings.parquet").to_pylist()
        rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table]
        points = np.array([r[1] for r in rows])
    queries = list(range(0, len(points), 20))
    df = frame(spark, rows)
    found = {q: [] for q in queries}
    asked = df.where(df.vec_id % 20 == 0)
    for r in nearest_neighbours(df, asked, shard_rows=700).collect():
        found[r.query_id].append(r.vec_id)
    assert all(len(set(v)) == 10 for v in found.values())
    assert recall(found, points, queries) >= 0.97


def test_all_are_reached():
    """Every vector is found as its own nearest."""
    points = crowd(2000, 16, seed=3).astype(float)
    points = np.unique(points, axis=0)
    graph = Graph(points)
    near, _ = graph.search(points, 64)
    own = 0
    for i, nodes in enumerate(near):
        ids, away = graph.nearest(points[i], nodes, 1)
        own += i in ids[away == 0]
    assert own >= 0.99 * len(points)
    assert (graph.edges[graph.node != np.arange(len(points))] == -1).all()


def mined_by_hand(rows, anchor_step=50):
    """Positives and negatives by sorting all rows of an anchor."""
    rows = {
        (i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and usable(v)
    }
    found = []
    for anchor in rows:
        if anchor[0] % anchor_step:
            continue
        others = [r for r in rows if r != anchor and len(r[2]) == len(anchor[2])]
        score = sorted(
            (-sum(x * y for x, y in zip(r[2], anchor[2], strict=True)), r[0], r[1] == anchor[1]) for r in others
        )
        for p, pid, same in [s for s in score if s[2]][:5]:
            fits = [(n, i) for n, i, s in score if not s and 50 * -p <= 100 * -n <= 95 * -p]
            found += [(anchor[0], pid, k + 1, i, -p, -n) for k, (n, i) in enumerate(fits[:3])]
    return sorted(found)


NAMES = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def mined(df, **options):
    found = (negatives_of_fiftieths(df) if not options else mine(df, df.where("vec_id % 50 = 0"), **options))
    return sorted(tuple(r) for r in found.select(*NAMES).collect())


def test_negatives_trouble(spark):
    rows = trouble() + [(600 + i, [0.7 + i / 40, 1.5, 2.2], i % 4) for i in range(40)]
    expected = mined_by_hand(rows)
    assert len(expected) > 20
    assert mined(frame(spark, rows)) == expected


def test_negatives_empty(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(50, [1.0], 1), (51, [1.0], 2)])) == []


@pytest.mark.parametrize("seed", range(2))
def test_negatives_random(spark, seed):
    rng = np.random.default_rng(seed)
    points = crowd(1500, 8, seed)
    rows = [(i, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(points)]
    rows += [(3000 + i, np.round(v, 1).tolist(), 1) for i, v in enumerate(points[:60])]
    expected = mined_by_hand(rows)
    df = frame(spark, rows)
    assert mined(df) == expected
    moved = df.selectExpr("vec_id", "embedding", "if(vec_id % 7 = 0, (label + 1) % 10, label) AS label")
    assert mined(moved, shard_rows=200) == expected


def test_large_components_stay_exact():
    """Beyond what floating point holds, scores are whole numbers of any size."""
    values = hard_negatives.whole_numbers(np.array([[1e17, 3.0], [1e17, 2.0], [-1e17, 1.0]]))
    window = Wanted(2, np.ones(3, bool))
    find(SortedLists(values), np.array([3.0, 1.0]), [window])
    big = int(256 * 1e17)
    assert window.result(np.array([5, 6, 7])) == [(3 * big + 768, 5, 0), (3 * big + 512, 6, 1)]


def test_threshold_stops_early():
    """Rows far below all windows are never scored; ties with the kth are."""
    rng = np.random.default_rng(0)
    values = np.floor(rng.normal(size=(20_000, 4)) * 256)
    values[:50] = np.array([900, -900, 900, -900])
    anchor = np.array([250.0, -250, 250, -250])
    window = Wanted(3, np.ones(len(values), bool))
    assert 50 <= find(SortedLists(values), anchor, [window]) < 2000
    assert [i for _, i, _ in window.result(np.arange(len(values))[::-1])] == [19950, 19951, 19952]


def test_queries_return_what_is_asked(spark):
    found = QUERIES["op12_nearest_neighbours"](spark, str(TESTDATA / "sf0.01"))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert dict(found.dtypes)["rank"] == "int" and found.count() == 50
