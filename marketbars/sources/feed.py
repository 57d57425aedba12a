"""The landing feed: files of text bars, and their normal form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars import schemas as S
from marketbars.functions.expressions import local_date

ARRIVAL = "arrival"


# Fields that a file may leave out: a symbol given otherwise, the arrival order.
OPTIONAL = ("Symbol", "seq")

# Columns are found by the header. Files of one folder must agree in theirs, and
# a broken line must fail, not load shifted or emptied columns.
_STRICT = {
    "csv": {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"},
    "json": {"mode": "FAILFAST"},
}


def _with_place(rows: DataFrame) -> DataFrame:
    """Add where a row comes from: file time, file, `seq` if known, part of the file."""
    seq = F.col("seq") if "seq" in rows.columns else F.lit(None)
    return rows.withColumn(
        ARRIVAL,
        F.struct(
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_path").alias("file"),
            seq.cast("bigint").alias("seq"),
            F.col("_metadata.file_block_start").alias("block"),
        ),
    ).drop("seq")


def in_file_order(rows: DataFrame) -> DataFrame:
    """Complete the arrival order by the row's place in its part of the file.

    For a frame straight from the files or a micro-batch of them: rows then
    still come as they are read.
    """
    row = F.monotonically_increasing_id().alias("row")
    return rows.withColumn(ARRIVAL, F.struct(f"{ARRIVAL}.*", row))


def _text_schema(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> T.StructType:
    """The header's columns as text. Reads the first line of the folder."""
    names = spark.read.format("csv").options(**options).load(path).columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _strictly(name: str, kind: T.DataType) -> Column:
    """Text as a number; other text fails, whatever the session's setting."""
    value = F.col(f"`{name}`").try_cast(kind)
    bad = F.col(f"`{name}`").isNotNull() & value.isNull()
    text = F.concat(F.lit(f"{name} is no {kind.simpleString()}: "), F.col(f"`{name}`"))
    return F.when(bad, F.raise_error(text)).otherwise(value)


def _fields(schema: T.StructType, wanted: T.StructType) -> list[T.StructField]:
    missing = [f.name for f in wanted if f.name not in schema.names and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"the feed has no column {', '.join(missing)}")
    return [f for f in wanted if f.name in schema.names]


def _rows(reader, fmt: str, path: str | list[str], given: T.StructType, schema: T.StructType) -> DataFrame:
    """The wanted columns of what a reader with the files' schema loads."""
    found = _fields(given, schema)
    rows = _with_place(reader.schema(given).load(path))
    columns = [
        _strictly(f.name, f.dataType).alias(f.name)
        if fmt == "csv" and not isinstance(f.dataType, T.StringType) and f.name != "seq"
        else F.col(f"`{f.name}`")
        for f in found
        if f.name != "seq"
    ]
    return rows.select(*columns, ARRIVAL)


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: T.StructType = S.FEED,
    **options: str,
) -> DataFrame:
    """Landing rows of every symbol from csv, json, orc or parquet files.

    Columns are found by name, in any order; further ones are left out, and a
    missing one fails. `Symbol` may be missing where `normalize_feed` is told
    it, by a value or from the file's name, as
    ``F.regexp_extract("arrival.file", r"([^/]+)[.]csv$", 1)``. Without `seq`
    the rows of a file arrive in the order in which they stand in it.
    ``path`` is a folder, or a list of files as `plans.jobs.ingest_files` passes.
    ``options`` are the reader's. Feeds from other sources go straight to
    `normalize_feed`.
    """
    options = {**_STRICT.get(fmt, {}), **options}
    given = _text_schema(spark, path, options) if fmt == "csv" else schema
    reader = spark.read.format(fmt).options(**options)
    return in_file_order(_rows(reader, fmt, path, given, schema))


def read_feed_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = S.FEED,
    **options: str,
) -> DataFrame:
    """The landing folder as a stream: each file is delivered once.

    The header is that of the files present at the start. `in_file_order`
    completes the arrival order of a micro-batch.
    """
    options = {**_STRICT.get(fmt, {}), **options}
    given = _text_schema(spark, path, options) if fmt == "csv" else schema
    reader = spark.readStream.format(fmt).options(**options)
    return _rows(reader, fmt, path, given, schema)


def normalize_feed(feed: DataFrame, symbol: Column | str | None = None) -> DataFrame:
    """The nine bar columns, typed; other columns are left out.

    A feed that holds one symbol and does not name it takes ``symbol``. The
    arrival order, where the feed has one, is kept for `first_per_key`.
    """
    if symbol is not None:
        feed = feed.withColumn("Symbol", F.lit(symbol))
    typed = feed.withColumnRenamed("Stock Splits", "stock_splits").withColumn(
        "Date", local_date("Date")
    )
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.BARS.fields]
    extra = [ARRIVAL] if ARRIVAL in feed.columns else []
    return typed.select(*columns, *extra)
