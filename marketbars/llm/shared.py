"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.llm.hashing import text_id
from marketbars.storage import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The white space between words; bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it lies.

    On a cluster the package is shipped with `--py-files`.
    """
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def saved(df: DataFrame) -> DataFrame:
    """`df` written once to the folder that all executors share, and read back."""
    return stage(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lowered, as UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def free_name(frame: DataFrame, name: str) -> str:
    """`name`, or the like, that is no column of the frame."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text_id(documents: DataFrame, name: str) -> DataFrame:
    """All columns, and a 64-bit hash of `text` under a new name."""
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.LongType())])
    at = documents.columns.index("text")

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids = pa.array([text_id(t) for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.record_batch([*batch.columns, ids], names=[*batch.schema.names, name])

    return documents.mapInArrow(add, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batches(rows: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut into ones of at most `size` rows."""
    for batch in rows:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def batches_by_size(
    rows: Iterator[pa.RecordBatch], column: int, size: int
) -> Iterator[pa.RecordBatch]:
    """The batches, cut into ones of at most `size` bytes in a column, or of one row."""
    for batch in rows:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, end - start)
            start = end
