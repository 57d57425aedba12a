"""Small tables kept beside a bar table, with one part for each of its months.

Spark gives the files of every write new names, so a month whose file names are
the same holds the same rows. A part of an index is kept under the names that its
month had: what is to be computed, and what is out of date, is known from lists
of files and partitions, without opening any. An index that was lost, or cut
short, is computed again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.sources.tables import partition_values

FILES = "files"
_IN_MONTH = re.compile(rf"/{S.MONTH}=([^/]+)/(.+)$")


@dataclass(frozen=True)
class MonthIndex:
    """`compute` makes the rows, with a month column, from bars of some months."""

    suffix: str
    columns: str
    compute: Callable[[DataFrame], DataFrame]


def in_months(months: Iterable[dt.date | str]) -> Column:
    """Rows of these months, in one order; constant, so that other partitions are not listed."""
    days = [F.lit(m).cast("date") for m in sorted(map(str, months))]
    return F.col(S.MONTH).isin(*days) if days else F.lit(False)


def files_by_month(spark: SparkSession, table: str) -> dict[str, str]:
    """A digest of the file names of each month.

    Names are listed on the driver, as Spark itself does to plan a scan.
    """
    spark.catalog.refreshTable(table)
    digests: dict[str, hashlib._Hash] = {}
    for path in sorted(spark.table(table).inputFiles()):
        found = _IN_MONTH.search(path)
        if found:
            digest = digests.setdefault(found[1], hashlib.sha256(found[1].encode()))
            digest.update(found[2].encode() + b"\n")
    return {month: digest.hexdigest()[:32] for month, digest in digests.items()}


def side_table(table: str, index: MonthIndex) -> str:
    return f"{table}__{index.suffix}"


def _parts(parts: Iterable[tuple[str, str]]) -> str:
    return " ".join(f"PARTITION ({S.MONTH}=DATE'{m}', {FILES}='{f}')" for m, f in sorted(parts))


def refreshed(spark: SparkSession, table: str, index: MonthIndex) -> DataFrame:
    """The index of a bar table, brought up to date.

    Only months whose files are others than at the last call are read.
    """
    side = side_table(table, index)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {side} ({index.columns}, {S.MONTH} DATE, {FILES} STRING) "
        f"USING parquet PARTITIONED BY ({S.MONTH}, {FILES})"
    )
    now = files_by_month(spark, table)
    held = {(p[S.MONTH], p[FILES]) for p in partition_values(spark, side)}
    missing = {m: f for m, f in now.items() if (m, f) not in held}
    gone = held - set(now.items())
    if missing:
        rows = index.compute(spark.table(table).where(in_months(sorted(missing))))
        names = F.create_map(*[F.lit(x) for pair in sorted(missing.items()) for x in pair])
        rows = rows.withColumn(FILES, names[F.col(S.MONTH).cast("string")])
        rows = rows.select(*spark.table(side).columns).hint("rebalance", S.MONTH)
        # Parts that were cut short are replaced; only complete ones are registered.
        name = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(name)
        spark.conf.set(name, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(side)
        finally:
            spark.conf.set(name, before)
        # A month without rows is known as well.
        spark.sql(f"ALTER TABLE {side} ADD IF NOT EXISTS {_parts(missing.items())}")
    if gone:
        listed = _parts(gone).replace(") PARTITION", "), PARTITION")
        spark.sql(f"ALTER TABLE {side} DROP IF EXISTS {listed}")
    return spark.table(side).drop(FILES)
