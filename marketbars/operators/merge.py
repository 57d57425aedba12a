"""Merges of a batch into a keyed table, as pure frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.sources.feed import ARRIVAL


def first_per_key(
    batch: DataFrame, key: Sequence[str] = S.KEY, order: str = ARRIVAL
) -> DataFrame:
    """The row of each key that arrived first; ``order`` is dropped.

    An aggregate, not a ranking: copies of a key are reduced map-side, so a key
    repeated without bound does not gather in one task. Rows that arrived at
    the same moment are decided by their values.
    """
    rest = [name for name in batch.columns if name not in (*key, order)]
    kept = [name for name in batch.columns if name != order]
    return (
        batch.groupBy(*key)
        .agg(F.min(F.struct(order, *rest)).alias("_first"))
        .select(*[name if name in key else f"_first.{name}" for name in kept])
    )


def absent_rows(target: DataFrame, batch: DataFrame, key: Sequence[str] = S.KEY) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` does not hold.

    The target is first reduced to the batch's keys. Against a small stored
    batch that is a broadcast filter on the target's scan, which otherwise
    would be shuffled whole for the anti join.
    """
    held = target.select(*key).join(batch.select(*key), list(key), "left_semi")
    return batch.join(held, list(key), "left_anti")


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: Sequence[str] = S.KEY
) -> DataFrame:
    """``target`` after inserting the batch rows whose key is new.

    Existing rows win over the batch. Batch keys must be unique; see
    `first_per_key`.
    """
    return target.unionByName(absent_rows(target, batch, key))


def upsert_by_key(target: DataFrame, batch: DataFrame, key: Sequence[str] = S.KEY) -> DataFrame:
    """``target`` with the batch's rows in place of those of the same key.

    Target rows the batch does not mention stay.
    """
    kept = target.join(batch.select(*key), list(key), "left_anti")
    return kept.unionByName(batch)
