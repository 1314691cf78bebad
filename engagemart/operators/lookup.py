"""Left join of a large fact table to a lookup table, safe against hot keys.

A lookup table is measured once. Up to a byte limit it is broadcast, so facts are
never shuffled and hot keys cost nothing. Beyond the limit, the few keys that hold
a large share of the facts are joined to a broadcast of just their lookup rows,
and only the remaining, evenly spread keys go through a shuffle join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.scratch import materialize

BROADCAST_BYTES = 256 * 1024**2
# A key with a larger share of the facts than this is joined by broadcast, so there
# are at most 1 / HOT_SHARE such keys.
HOT_SHARE = 1 / 20_000
_SAMPLED_FACTS = 10_000_000
_ROW_OVERHEAD = 16
_FIXED_WIDTH = 8


@dataclass(frozen=True)
class Lookup:
    """A lookup table with its measured size."""

    frame: DataFrame
    rows: int
    bytes: int
    limit: int = BROADCAST_BYTES

    @property
    def fits_broadcast(self) -> bool:
        return self.bytes <= self.limit


def row_bytes(df: DataFrame) -> Column:
    """Size of a row of ``df`` in memory, texts measured, the rest at a fixed width."""
    total = F.lit(_ROW_OVERHEAD + _FIXED_WIDTH * len(df.columns))
    for field in df.schema.fields:
        if not isinstance(field.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            total = total + F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
    return total.cast("bigint")


def measure(frame: DataFrame, limit: int = BROADCAST_BYTES) -> Lookup:
    """Count rows and bytes of a lookup table in one pass, moving only partial sums."""
    size = frame.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(frame)), F.lit(0)).alias("bytes")
    ).first()
    return Lookup(frame, size["rows"], size["bytes"], limit)


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Non-NULL keys that hold more than ``share`` of the facts, as a small written table.

    Found on a sample of one column. The sample only decides which way a row is
    joined; results do not depend on it.
    """
    total = facts.count()
    fraction = min(1.0, _SAMPLED_FACTS / max(total, 1))
    keys = facts.select(key)
    if fraction < 1.0:
        keys = keys.sample(fraction, seed=0)
    counts = keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > F.lit(total * fraction * share)).select(key)
    return materialize(hot, "hot-keys").frame


def _join(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    same_key = F.col(f"fact.{key}") == F.col(f"lookup.{key}")
    return facts.alias("fact").join(lookup.alias("lookup"), same_key, "left")


def left_lookup(
    facts: DataFrame, lookup: Lookup, key: str, hot_share: float = HOT_SHARE
) -> DataFrame:
    """``facts`` left-joined to ``lookup`` on ``key``; address sides as ``fact.*``, ``lookup.*``.

    When the lookup is too large to broadcast, ``facts`` is read more than once and
    should be a scan or a written table.
    """
    if lookup.fits_broadcast:
        return _join(facts, F.broadcast(lookup.frame), key)

    hot = hot_keys(facts, key, hot_share)
    hot_rows = measure(lookup.frame.join(F.broadcast(hot), key, "left_semi"), lookup.limit)
    if not hot_rows.fits_broadcast:
        # Only a lookup with very many rows per key gets here; adaptive execution splits it.
        return _join(facts, lookup.frame, key)

    # NULL keys match nothing, so they go the way of the hot keys and are never shuffled.
    marked = facts.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    aside = marked.where(F.col("_hot") | F.col(key).isNull()).select(*facts.columns)
    spread = facts.where(F.col(key).isNotNull()).join(F.broadcast(hot), key, "left_anti")
    return _join(aside, F.broadcast(hot_rows.frame), key).unionAll(
        _join(spread.select(*facts.columns), lookup.frame, key)
    )
