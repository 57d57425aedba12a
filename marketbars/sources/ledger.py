"""Which landing files were loaded, and which rows of them were left for later.

A load takes the rows of some symbols before some date, so a file that was read
may hold rows that a later load wants. The ledger has an entry for each file read
and, for each symbol with rows left out, the span of their dates. Files without
an entry, and those whose rows come into reach, are opened; others never are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.sources.feed import ARRIVAL

_FILE = ("file", "modified", "length")
LEDGER_DDL = """(file STRING, modified TIMESTAMP, length BIGINT, run BIGINT,
    symbol STRING, first DATE, last DATE) USING parquet"""


def list_files(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """(path, file, modified, length) of a folder's files, which are not opened.

    ``options`` are those of a reader that pick files, as `recursiveFileLookup`.
    """
    files = spark.read.format("binaryFile").options(**options).load(folder)
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("length"),
    )


def last_entries(ledger: DataFrame) -> DataFrame:
    """The entries of each file's last run."""
    last = ledger.groupBy("file").agg(F.max("run").alias("run"))
    return ledger.join(last, ["file", "run"])


def files_to_open(
    listing: DataFrame, ledger: DataFrame, marks: DataFrame, end: dt.date
) -> DataFrame:
    """The files that hold, or may hold, rows to load.

    New files, files that were replaced, and those with rows left out of a
    symbol in ``marks``, from its start date on and before ``end``.
    """
    entries = last_entries(ledger)
    known = entries.where(F.col("symbol").isNull()).select(*_FILE)
    new = listing.join(known, list(_FILE), "left_anti")
    left = (
        entries.where(F.col("symbol").isNotNull() & (F.col("first") < F.lit(end)))
        .join(marks.select("symbol", "start_date"), "symbol")
        .where(F.col("last") >= F.col("start_date"))
        .select("file")
        .distinct()
    )
    return new.unionByName(
        listing.join(left, "file", "left_semi").join(new.select("file"), "file", "left_anti")
    )


def entries_of(opened: DataFrame, feed: DataFrame, marks: DataFrame, end: dt.date, run: int) -> DataFrame:
    """The ledger's entries for files that were read, with what was left out.

    Rows before a symbol's start date are not left for later: no load takes them.
    """
    read = opened.select(*_FILE, F.lit(run).cast("long").alias("run"))
    rows = feed.select(F.col(f"{ARRIVAL}.file").alias("file"), "symbol", "date").join(
        marks.select("symbol", F.lit(True).alias("_loaded")), "symbol", "left"
    )
    later = F.col("_loaded").isNull() | (F.col("date") >= F.lit(end))
    left = (
        rows.where(F.col("symbol").isNotNull() & later)
        .groupBy("file", "symbol")
        .agg(F.min("date").alias("first"), F.max("date").alias("last"))
    )
    return read.unionByName(read.join(left, "file"), allowMissingColumns=True)


def ensure_ledger(spark: SparkSession, table: str = f"{S.LANDING_TABLE}__files") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} {LEDGER_DDL}")


def next_run(spark: SparkSession, table: str) -> int:
    return 1 + (spark.table(table).agg(F.max("run")).first()[0] or 0)
