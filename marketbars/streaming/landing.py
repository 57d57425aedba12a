"""The daily load as a stream over the landing folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketbars import schemas as S
from marketbars.sinks.tables import append_absent, ensure_landing_table
from marketbars.sources.feed import in_file_order, normalize_feed, read_feed_stream
from marketbars.storage import staging


def ingest_stream(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    fmt: str = "csv",
    on_bad: str = "error",
    quarantine_table: str | None = None,
    after: Callable[[DataFrame], None] | None = None,
    **options: str,
) -> None:
    """Load the files that came since the last call, then return.

    The checkpoint remembers which files were read. A batch that is delivered
    again after a failure inserts nothing twice, since stored keys win.
    ``after`` gets each batch, stored, once its rows are in the table.
    """
    ensure_landing_table(spark, table)

    def load(batch: DataFrame, _: int) -> None:
        with staging(batch.sparkSession) as stage:
            rows = stage(in_file_order(batch)) if after else in_file_order(batch)
            append_absent(rows, table, on_bad, quarantine_table)
            if after:
                after(rows)

    query = (
        normalize_feed(read_feed_stream(spark, path, fmt, S.FEED, **options))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # The batches ran in a session of their own; drop this one's file listing.
    spark.catalog.refreshTable(table)
