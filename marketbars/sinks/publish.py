"""Months that replace others as a whole, or not at all.

New rows of a month are written to a folder of their own, inside the table's. Then
the catalog's entry of the month is pointed to it. Whatever is lost in between,
each month is its old rows or its new ones.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.sources.tables import stored_months
from marketbars.storage import delete, subfolders

_FOLDER = "_published"
_PUBLISHED = re.compile(rf"{_FOLDER}/([0-9a-f]{{32}})/{S.MONTH}=([0-9-]+)/")


def table_folder(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    return found.data_type.rstrip("/")


def _written_months(spark: SparkSession, folder: str) -> list[str]:
    files = spark.read.schema("symbol STRING").parquet(folder).inputFiles()
    return sorted({found[2] for found in map(_PUBLISHED.search, files) if found})


def _switch(spark: SparkSession, table: str, month: str, folder: str) -> None:
    part = f"PARTITION ({S.MONTH}=DATE'{month}')"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{folder}'")


def _sweep(spark: SparkSession, table: str, replaced: list[str]) -> None:
    """Remove the folders that no month points to, which a lost run may have left."""
    root = table_folder(spark, table)
    files = spark.table(table).inputFiles()
    live = {found.groups() for found in map(_PUBLISHED.search, files) if found}
    for month in replaced:
        delete(spark, f"{root}/{S.MONTH}={month}")
    for run in subfolders(spark, f"{root}/{_FOLDER}"):
        months = [m for r, m in live if r == run]
        if not months:
            delete(spark, f"{root}/{_FOLDER}/{run}")
            continue
        for name in subfolders(spark, f"{root}/{_FOLDER}/{run}"):
            if name.startswith(f"{S.MONTH}=") and name.split("=")[1] not in months:
                delete(spark, f"{root}/{_FOLDER}/{run}/{name}")


def publish_months(rows: DataFrame, table: str, whole: bool = False) -> None:
    """Replace the months that ``rows`` has; with ``whole`` others go.

    ``rows`` are arranged for writing and have the table's columns; they may be
    read from the table itself.
    """
    spark = rows.sparkSession
    folder = f"{table_folder(spark, table)}/{_FOLDER}/{uuid.uuid4().hex}"
    # The length that the table's type allows, which only its own writer checks.
    fits = F.length("symbol") <= S.SYMBOL_LENGTH
    too_long = F.raise_error(F.lit(f"symbol exceeds {S.SYMBOL_LENGTH} characters"))
    checked = rows.withColumn("symbol", F.when(fits, F.col("symbol")).otherwise(too_long))
    checked.write.partitionBy(S.MONTH).parquet(folder)
    months = _written_months(spark, folder)
    for month in months:
        _switch(spark, table, month, f"{folder}/{S.MONTH}={month}")
    if whole:
        for month in stored_months(spark, table):
            if str(month) not in months:
                _drop(spark, table, month)
    spark.catalog.refreshTable(table)
    _sweep(spark, table, months)


def _drop(spark: SparkSession, table: str, month: dt.date) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({S.MONTH}=DATE'{month}')")
