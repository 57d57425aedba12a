"""What the operators on embeddings share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.shared import partitions

Batches = Iterator[pa.RecordBatch]


def finite(vector: Column) -> Column:
    """Whether a vector is there, and all its components are, and are finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def in_shards(items: DataFrame, anchors: DataFrame, size: int, key: list[str]) -> DataFrame:
    """Items dealt into shards of `size` rows on average, each followed by all anchors.

    Both have `dimension`, an integer; only items and anchors of one dimension
    meet. `kind` is 0 for items and 1 for anchors, and the columns that one kind
    lacks are null. Items are dealt by a hash of `key`, which tells them apart, so
    no shard is hot. Rows are sorted by `dimension`, `shard` and `kind`: a task
    holds one shard and lets the anchors pass.

    The numbers of shards are broadcast, a row per dimension. Vectors of k
    dimensions have k * k / 2 components at least, so these rows grow with the
    root of the data.
    """
    count = items.groupBy("dimension").agg(F.count("*").alias("n"))
    shards = F.broadcast(count.select("dimension", F.ceil(F.col("n") / size).alias("shards")))
    shard = F.pmod(F.xxhash64(*key), F.col("shards"))
    left = items.join(shards, "dimension").withColumn("shard", shard)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))
    right = anchors.join(shards, "dimension").withColumn("shard", each)
    both = left.withColumn("kind", F.lit(0).cast("long")).unionByName(
        right.withColumn("kind", F.lit(1).cast("long")), allowMissingColumns=True
    )
    dealt = both.drop("shards").repartition(partitions(items.sparkSession), "dimension", "shard")
    return dealt.sortWithinPartitions("dimension", "shard", "kind")


def shard_by_shard(
    build: Callable[[pa.Table], object],
    answer: Callable[[object, pa.Table], pa.RecordBatch],
    block: int,
) -> Callable[[Batches], Batches]:
    """For rows of `in_shards`: something built from a shard answers its anchors.

    A shard is held whole; anchors come in tables of at most `block` rows.
    """

    def run(rows: Batches) -> Batches:
        now, items, built = None, [], None
        for batch in rows:
            names = [batch.column(n).to_numpy() for n in ("dimension", "shard", "kind")]
            new = np.zeros(batch.num_rows, bool)
            for column in names:
                new[1:] |= column[1:] != column[:-1]
            bounds = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for start, end in zip(bounds, bounds[1:], strict=False):
                if start == end:
                    continue
                dimension, shard, kind = (int(column[start]) for column in names)
                if (dimension, shard) != now:
                    now, items, built = (dimension, shard), [], None
                if kind == 0:
                    items.append(batch.slice(start, end - start))
                    continue
                if built is None and items:
                    built = build(pa.Table.from_batches(items))
                    items = []
                for at in range(start, end, block):
                    part = batch.slice(at, min(block, end - at))
                    if built is not None:
                        yield answer(built, pa.Table.from_batches([part]))

    return run
