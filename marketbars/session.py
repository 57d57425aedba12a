"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Splits hot join partitions and merges small ones from measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also the size of the files a rebalanced write leaves.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    # Dates come from local timestamps and zero prices must fail loudly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}

_PARTITION_BYTES = 256 * 2**20


def shuffle_partitions(shuffled_bytes: int, least: int = 8) -> int:
    """Partitions for a job that shuffles about this much.

    Adaptive execution merges partitions but, outside of skewed joins and
    rebalanced writes, never splits them: the starting number must fit the
    largest shuffle.
    """
    return max(least, -(-shuffled_bytes // _PARTITION_BYTES))


def builder(app: str = "marketbars", shuffled_bytes: int | None = None) -> SparkSession.Builder:
    """A session builder; state the size of the largest shuffle on a cluster."""
    result = SparkSession.builder.appName(app)
    for name, value in SETTINGS.items():
        result = result.config(name, value)
    if shuffled_bytes is not None:
        result = result.config("spark.sql.shuffle.partitions", shuffle_partitions(shuffled_bytes))
    return result
