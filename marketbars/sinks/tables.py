"""Table creation and the write modes of the layers.

Bar tables are Parquet, partitioned by month, with one writer at a time. A
write whose computation fails leaves the table as it was and can be run again;
lost executors only cost time. A month is replaced by pointing the catalog to
its new folder, so that a driver lost at any time leaves its old rows or its
new ones. Between months there is no transaction: some may be replaced and
others not, until the job runs again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketbars import schemas as S
from marketbars.functions.expressions import month_bucket
from marketbars.operators.audit import bad_key, reject_duplicates, require_not_null
from marketbars.operators.merge import absent_rows, first_per_key
from marketbars.operators.series import BLOCK
from marketbars.sinks.month_index import in_months
from marketbars.sinks.publish import publish_months
from marketbars.sources.feed import ARRIVAL
from marketbars.sources.tables import stored_months
from marketbars.storage import staging

_MONTH_KEY = (S.MONTH, *S.KEY)


@dataclass(frozen=True)
class Written:
    """What an insert met: rows that came and were written, and rows a table refuses."""

    came: int
    written: int
    null_dates: int
    null_symbols: int
    long_symbols: int


def ensure_table(spark: SparkSession, table: str, ddl: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} {ddl}")


def ensure_landing_table(spark: SparkSession, table: str = S.LANDING_TABLE) -> None:
    ensure_table(spark, table, S.BAR_TABLE_DDL)


def ensure_bronze_table(spark: SparkSession, table: str = S.BRONZE_TABLE) -> None:
    ensure_table(spark, table, S.BAR_TABLE_DDL)


def ensure_silver_table(spark: SparkSession, table: str = S.SILVER_TABLE) -> None:
    ensure_table(spark, table, S.SILVER_TABLE_DDL)


def ensure_forecast_table(spark: SparkSession, table: str) -> None:
    recover_swap(spark, table)
    ensure_table(spark, table, S.FORECAST_TABLE_DDL)


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(S.MONTH, month_bucket("date"))


def _by_month(df: DataFrame, table: str) -> DataFrame:
    """Rows in the table's column order, arranged so that each task writes few months.

    `rebalance` splits a month that outgrows the advisory partition size, so
    neither a hot month nor many small files come out. Sorting by symbol lets
    reads of single symbols skip row groups.
    """
    rows = df.select(*df.sparkSession.table(table).columns).hint("rebalance", S.MONTH)
    return rows.sortWithinPartitions(S.MONTH, "symbol", "date")


def _months_of(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The part of ``target`` in the months of a stored batch; no other is listed."""
    return target.where(in_months(r[0] for r in batch.select(S.MONTH).distinct().collect()))


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Overwrite all partitions ('static') or those that get rows ('dynamic').

    The writer option of the same name does not apply to `insertInto`.
    """
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_absent(
    batch: DataFrame,
    table: str,
    on_bad: str = "error",
    quarantine_table: str | None = None,
) -> Written:
    """Insert the batch rows whose key the table does not hold.

    Stored rows win; inside the batch the first to arrive wins, or where no
    arrival is known the smallest row. Rows with a NULL key or too long a
    symbol fail the write, or with ``on_bad='quarantine'`` go to
    ``quarantine_table``, once each. The batch is stored first: only then is its
    size known, and the table is pruned to its months. What is returned was counted
    while the rows passed, in the jobs that store and write them.
    """
    spark = batch.sparkSession
    if on_bad not in ("error", "quarantine"):
        raise ValueError(f"on_bad must be 'error' or 'quarantine', not {on_bad!r}")
    if on_bad == "quarantine" and not quarantine_table:
        raise ValueError("on_bad='quarantine' needs a quarantine_table")
    came, went = Observation(), Observation()
    no_key = [F.count_if(F.col(c).isNull()).alias(f"null_{c}s") for c in S.KEY]
    too_long = F.count_if(F.length("symbol") > S.SYMBOL_LENGTH).alias("long_symbols")
    with staging(spark) as stage:
        batch = batch.observe(came, F.count(F.lit(1)).alias("rows"), *no_key, too_long)
        if on_bad == "quarantine":
            batch = _set_aside(stage(batch), quarantine_table)
        batch = require_not_null(batch)
        if ARRIVAL not in batch.columns:
            batch = batch.withColumn(ARRIVAL, F.lit(0))
        batch = stage(_with_month(first_per_key(batch)))
        new = absent_rows(_months_of(spark.table(table), batch), batch, _MONTH_KEY)
        counted = _by_month(new, table).observe(went, F.count(F.lit(1)).alias("rows"))
        counted.write.insertInto(table)
    found = came.get
    return Written(
        came=found.get("rows", 0),
        written=went.get.get("rows", 0),
        null_dates=found.get("null_dates", 0),
        null_symbols=found.get("null_symbols", 0),
        long_symbols=found.get("long_symbols", 0),
    )


def _set_aside(batch: DataFrame, quarantine_table: str) -> DataFrame:
    """Add the rows a bar table refuses to another table, return the others.

    A row that is there already, as after a batch was sent again, is not added
    again.
    """
    spark = batch.sparkSession
    bad = F.coalesce(bad_key(), F.lit(True))
    refused = batch.where(bad).select(*S.BAR_COLUMNS).distinct()
    if spark.catalog.tableExists(quarantine_table):
        held = spark.table(quarantine_table)
        same = [refused[c].eqNullSafe(held[c]) for c in S.BAR_COLUMNS]
        refused = refused.join(held, same, "left_anti")
    refused.write.mode("append").saveAsTable(quarantine_table)
    return batch.where(~bad)


def write_upsert(
    batch: DataFrame,
    table: str,
    key: Sequence[str] = S.KEY,
    check_unique: bool = True,
    stored: bool = False,
) -> None:
    """Replace the table's rows of the batch's keys, keep all others.

    Only months the batch touches are read and rewritten. A batch that repeats
    a key is refused; ``check_unique=False`` is for batches known not to. A
    batch is stored first, as it is used several times, unless it is ``stored``:
    read from another table. Into an empty table the rows go directly.
    """
    spark = batch.sparkSession
    batch = _with_month(require_not_null(batch, key))
    with staging(spark) as stage:
        target = spark.table(table)
        fresh = not stored_months(spark, table)
        if not stored and (check_unique or not fresh):
            batch = stage(batch)
        if check_unique:
            reject_duplicates(batch, key)
        if fresh:
            _by_month(batch, table).write.insertInto(table)
            return
        kept = (
            _months_of(target, batch).join(batch.select(*key), list(key), "left_anti")
        )
        rows = kept.unionByName(batch.select(*target.columns))
        publish_months(_by_month(rows, table), table)


def write_reload(df: DataFrame, table: str) -> None:
    """Load a bar table anew from ``df``; rows and months not in it go."""
    publish_months(_by_month(_with_month(require_not_null(df)), table), table, whole=True)


def write_months(df: DataFrame, table: str) -> None:
    """Replace whole months: those that ``df``, read from other tables, has rows of."""
    publish_months(_by_month(_with_month(df), table), table)


def write_rebuild(df: DataFrame, table: str) -> None:
    """Build a table by month beside the old one, then put it in its place.

    The columns are those of ``df`` and the month. A build that fails leaves the
    old table as it was.
    """
    spark = df.sparkSession
    with _successor(spark, table) as fresh:
        # Registered before it is filled: what a crash leaves can be dropped.
        rows = _with_month(df)
        empty = spark.createDataFrame([], rows.schema).write.format("parquet")
        empty.partitionBy(S.MONTH).saveAsTable(fresh)
        with _overwriting(spark, "static"):
            _by_month(rows, fresh).write.insertInto(fresh)


def write_series(df: DataFrame, table: str, buckets: int | None = None) -> None:
    """A new table of a layer by series, in buckets of (symbol, block), sorted by date.

    ``df`` has its block column, as `enrich` leaves with ``keep_block``; rows that
    lie by it already are not moved again. What groups or numbers rows by symbol
    and block, as `daily_summary` and `day_index` do, reads the table without a
    shuffle. There are as many buckets as shuffle partitions unless told.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.write.format("parquet").bucketBy(count, "symbol", BLOCK)
    writer.sortBy("symbol", BLOCK, "date").saveAsTable(table)


def write_replace(df: DataFrame, table: str) -> None:
    """Load an unpartitioned table anew from ``df``, keeping its definition.

    No column may be NULL. A load that fails leaves the old rows.
    """
    spark = df.sparkSession
    columns = spark.table(table).columns
    with _successor(spark, table) as fresh:
        spark.sql(f"CREATE TABLE {fresh} LIKE {table}")
        require_not_null(df, columns).select(*columns).write.insertInto(fresh)


def recover_swap(spark: SparkSession, table: str) -> None:
    """Finish a replacement that was cut short between its two renamings.

    The table is then missing, and its complete successor waits beside the old
    one. A successor that still waits while the table is there may be half
    filled and goes.
    """
    fresh, old = f"{table}__new", f"{table}__old"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(old):
        complete = spark.catalog.tableExists(fresh)
        spark.sql(f"ALTER TABLE {fresh if complete else old} RENAME TO {table}")
    for name in (fresh, old):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def _successor(spark: SparkSession, table: str) -> Iterator[str]:
    """The name of a new table, which replaces ``table`` when all went well."""
    recover_swap(spark, table)
    fresh, old = f"{table}__new", f"{table}__old"
    yield fresh
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
