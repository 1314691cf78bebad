"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, recency: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the greatest ``recency``, then the greatest other values.

    Written as an aggregate, so each input partition first reduces a key to one row
    and a key with very many versions is not sorted in one task. The tie-break over
    the remaining columns makes the choice independent of row order.
    """
    rest = [name for name in df.columns if name != key and name not in recency]
    ordered = [*recency, *rest]
    if not ordered:
        return df.select(key).distinct()
    newest = F.max(F.struct(*ordered)).alias("_newest")
    return df.groupBy(key).agg(newest).select(key, "_newest.*").select(*df.columns)
