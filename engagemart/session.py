"""Session settings sized from the amount of input."""

from __future__ import annotations

from math import ceil

from pyspark.sql import SparkSession

_SHUFFLE_PARTITION_BYTES = 200 * 1024**2
_MIN_PARTITIONS, _MAX_PARTITIONS = 200, 200_000


def settings(input_bytes: int = 0) -> dict[str, str]:
    """Settings for a job over ``input_bytes`` of raw data.

    Shuffles start with partitions of about 200 MB of input each, and adaptive
    execution merges what turns out small and splits what turns out skewed.
    """
    partitions = ceil(input_bytes / _SHUFFLE_PARTITION_BYTES)
    partitions = max(_MIN_PARTITIONS, min(_MAX_PARTITIONS, partitions))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.ui.enabled": "false",
    }


def build_session(app_name: str, input_bytes: int = 0, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**settings(input_bytes), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
