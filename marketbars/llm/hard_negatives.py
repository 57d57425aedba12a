"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt into shards. A shard keeps, for each dimension, its rows sorted by
that component. An anchor goes down all lists at once, from the end that the sign
of its own component favours. Rows met for the first time are scored whole, by
random access. No row still unmet can score more than the threshold, the score of
the values that the lists have come to. Once that is strictly below the kth score
of each window (or below the window), the shard's answer is exact, and so is the
best of all shards.

The first run finds each anchor's positives; their scores are the windows of the
second, which finds the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.shared import saved
from marketbars.llm.vectors import finite, in_shards, matrix, shard_by_shard

SHARD_ROWS = 8192
SCALE = 256
_FIRST_DEPTH = 64
_ANCHORS = 256
# Whole numbers up to here are exact as floating point numbers.
_EXACT = float(1 << 53)


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as floating point numbers."""
    return np.floor(vectors * scale)


class SortedLists:
    """Rows of a shard, sorted by each of their components."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.order = np.argsort(values, axis=0, kind="stable").astype(np.int32)
        self._most = float(np.abs(values).max(initial=0))

    def _exact(self, anchor: np.ndarray) -> bool:
        return float(np.abs(anchor).max(initial=0)) * self._most * len(anchor) < _EXACT

    def descend(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rows as they are met, their scores, and the threshold after them.

        Scores are whole numbers: floating point numbers where these are exact for
        certain, Python's otherwise. When no row is unmet, the threshold is minus
        infinity. Where many rows are met at once, one product scores all.
        """
        values, weights = self.values, anchor
        if not self._exact(anchor):
            values = np.array([[int(x) for x in row] for row in values.tolist()], object)
            weights = np.array([int(x) for x in anchor.tolist()], object)
        n = len(values)
        down, up = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, left, whole = np.zeros(n, bool), n, None
        at, size = 0, _FIRST_DEPTH
        while at < n and len(down) + len(up):
            end = min(n, at + size)
            rows = np.r_[
                self.order[n - end : n - at, down].reshape(-1), self.order[at:end, up].reshape(-1)
            ]
            fresh = np.zeros(n, bool)
            fresh[rows] = True
            new = np.flatnonzero(fresh & ~met)
            met[new] = True
            left -= len(new)
            last = (values[self.order[n - end, down], down] * weights[down]).sum()
            last = last + (values[self.order[end - 1, up], up] * weights[up]).sum()
            if whole is None and 8 * len(new) > n:
                whole = values @ weights
            scores = values[new] @ weights if whole is None else whole[new]
            yield new, scores, last if left else -np.inf
            if not left:
                return
            at, size = end, 2 * size
        # An anchor of zeros, whose lists say nothing.
        new = np.flatnonzero(~met)
        yield new, values[new] @ weights, -np.inf


class Wanted:
    """The best k of the rows that pass `allowed` and score from `low` to `high`."""

    def __init__(self, k: int, allowed: np.ndarray, low: float = -np.inf, high: float = np.inf) -> None:
        self.k, self.allowed, self.low, self.high = k, allowed, low, high
        self._rows, self._scores, self._kth = [], [], None

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        fits = self.allowed[rows] & (scores >= self.low) & (scores <= self.high)
        if fits.any():
            self._rows.append(rows[fits])
            self._scores.append(scores[fits])
            self._kth = None

    def settled(self, threshold: float) -> bool:
        """Nothing that scores at most the threshold can change the result."""
        if threshold < self.low:
            return True
        if self._kth is None:
            scores = np.sort(np.concatenate(self._scores)) if self._scores else []
            self._kth = scores[-self.k] if len(scores) >= self.k else -np.inf
        return threshold < self._kth

    def result(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(score, id, row), the best first, ties by the smaller id."""
        if not self._rows:
            return []
        rows, scores = np.concatenate(self._rows).tolist(), np.concatenate(self._scores).tolist()
        found = sorted((-int(s), int(ids[r]), r) for r, s in zip(rows, scores, strict=True))
        return [(-s, i, r) for s, i, r in found[: self.k]]


def find(lists: SortedLists, anchor: np.ndarray, wanted: list[Wanted]) -> int:
    """Go down the lists until all windows are settled; the number of rows scored."""
    scored = 0
    for rows, scores, threshold in lists.descend(anchor):
        scored += len(rows)
        for window in wanted:
            window.add(rows, scores)
        if all(window.settled(threshold) for window in wanted):
            break
    return scored


class _Shard:
    def __init__(self, items: pa.Table) -> None:
        self.lists = SortedLists(whole_numbers(matrix(items.column("vector"))))
        self.ids, self.labels, self.rows = (
            items.column(n).to_numpy() for n in ("vec_id", "label", "row")
        )


_POSITIVE = "anchor_id long, anchor long, vec_id long, score long"
_NEGATIVE = "anchor_id long, anchor long, positive_id long, positive_score long, place long, vec_id long, score long"


def _schema(columns: str) -> pa.Schema:
    return pa.schema([(c.split()[0], pa.int64()) for c in columns.split(", ")])


def _table(rows: list[tuple], columns: str) -> pa.RecordBatch:
    schema = _schema(columns)
    arrays = [list(c) for c in zip(*rows, strict=True)] or [[]] * len(schema)
    return pa.record_batch([pa.array(a, pa.int64()) for a in arrays], schema=schema)


def _asked(asked: pa.Table) -> Iterator[tuple[int, int, int, np.ndarray]]:
    anchors = whole_numbers(matrix(asked.column("vector")))
    names = (asked.column(n).to_pylist() for n in ("anchor_id", "anchor", "anchor_label"))
    yield from zip(*names, anchors, strict=True)


def _positives(k: int):
    def answer(shard: _Shard, asked: pa.Table) -> pa.RecordBatch:
        out = []
        for anchor_id, anchor, label, vector in _asked(asked):
            window = Wanted(k, (shard.labels == label) & (shard.rows != anchor))
            find(shard.lists, vector, [window])
            out += [(anchor_id, anchor, i, s) for s, i, _ in window.result(shard.ids)]
        return _table(out, _POSITIVE)

    return answer


def _negatives(k: int, low: int, high: int):
    def answer(shard: _Shard, asked: pa.Table) -> pa.RecordBatch:
        out = []
        positives = asked.column("positives").to_pylist()
        for (anchor_id, anchor, label, vector), own in zip(_asked(asked), positives, strict=True):
            other = shard.labels != label
            # Scores are whole: from the smallest to the largest inside the window.
            windows = [
                Wanted(k, other, -(-low * p["score"] // 100), high * p["score"] // 100) for p in own
            ]
            find(shard.lists, vector, windows)
            for p, window in zip(own, windows, strict=True):
                name = anchor_id, anchor, p["vec_id"], p["score"], p["place"]
                out += [(*name, i, s) for s, i, _ in window.result(shard.ids)]
        return _table(out, _NEGATIVE)

    return answer


def _best(found: DataFrame, key: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    *,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Negatives that score nearly as much as a positive, for each anchor.

    Both frames have `vec_id`, `label` and `embedding`; further columns are not
    read. A component counts as floor(256 * x), a row's score is the inner product
    with the anchor, higher first, ties by the smaller `vec_id`. An anchor's
    positives are its first rows of the same label, itself left out; for each of
    them come the first rows of another label that score `low` to `high` percent
    of the positive: `anchor_id`, `positive_id`, `rank` from 1, `negative_id`,
    `positive_score`, `negative_score`.

    Rows without `vec_id` or `label`, and vectors that are null, empty or hold a
    null or non-finite component, take no part. Equal rows count once; rows that
    share a `vec_id` but differ are rows, and anchors, of their own. Vectors of
    different length do not meet. Scores are exact; one that is no 64-bit number
    ends the query with an error.
    """
    items = _rows(rows)
    asked = _rows(anchors).withColumnsRenamed(
        {"vec_id": "anchor_id", "label": "anchor_label", "row": "anchor"}
    )
    items, asked = saved(items), saved(asked)
    key = ["anchor_id", "anchor"]

    def run(anchors: DataFrame, answer, schema: str) -> DataFrame:
        dealt = in_shards(items, anchors, shard_rows, ["row"])
        return saved(dealt.mapInArrow(shard_by_shard(_Shard, answer, _ANCHORS), schema))

    near = _best(run(asked, _positives(positives), _POSITIVE), key, positives)
    near = near.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives")
    )
    windows = saved(asked.join(near, key))
    found = run(windows, _negatives(negatives, low, high), _NEGATIVE)
    found = found.withColumnRenamed("place", "positive")
    found = _best(found, [*key, "positive"], negatives)
    return found.select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _rows(rows: DataFrame) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    used = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(vector)
    rows = rows.where(used & (F.size(vector) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        vector.alias("vector"),
    )
    row = F.xxhash64("vec_id", "label", "vector").alias("row")
    return rows.distinct().select("*", row, F.size("vector").cast("long").alias("dimension"))


def negatives_of_fiftieths(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every row whose `vec_id` is divisible by 50.

    Of rows whose `vec_id` is divisible by 7 the label is first moved on by one,
    modulo 10.
    """
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = embeddings.select("vec_id", moved.alias("label"), "embedding")
    return mine(rows, rows.where(F.col("vec_id") % 50 == 0))
