"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Differencing keeps partial partitions: tuples of bin loads. The two with the largest
spread are combined again and again, the heavy bins of one with the light bins of the
other, until one tuple remains. It needs all items in one place, so large inputs go in
levels: items are dealt into buckets of bounded size, each bucket is differenced into
near-equal bundles, and the bundles are the items of the next level. The last level,
always of bounded size, differences the remaining bundles into shards. Items too large to
balance inside a bucket go up unbundled, so that the last level can even them out.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from engagemart.llm.common import bucket, counted, id_and_text, parts, salted, written

#: Items differenced by one task, and the most items of the last level (more if there are very many shards).
BUCKET_ITEMS, LAST_ITEMS = 2_000, 24_000
#: Documents numbered by one task when slots are dealt.
SLOT_ROWS = 100_000


def difference(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin (0 to bins - 1, heaviest first) of each item, loads as equal as differencing gets them."""
    count = len(sizes)
    if count == 0:
        return np.zeros(0, np.int64)
    # a tuple is (loads ascending, node of each bin); node -1 is an empty bin
    heap, tuples, joined = [], {}, []
    for item, size in enumerate(sizes.tolist()):
        loads, nodes = np.zeros(bins, np.int64), np.full(bins, -1, np.int64)
        loads[-1], nodes[-1] = size, item
        tuples[item] = (loads, nodes)
        heap.append((-size, item))
    heapq.heapify(heap)
    fresh, names = count, count
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        (loads, nodes), (other, theirs) = tuples.pop(first), tuples.pop(second)
        other, theirs = other[::-1], theirs[::-1]
        loads = loads + other
        both = np.flatnonzero((nodes >= 0) & (theirs >= 0))
        merged = np.where(nodes >= 0, nodes, theirs)
        for place in both.tolist():
            joined.append((int(nodes[place]), int(theirs[place])))
            merged[place] = fresh
            fresh += 1
        order = np.argsort(loads, kind="stable")
        loads, merged = loads[order], merged[order]
        tuples[names] = (loads, merged)
        heapq.heappush(heap, (-int(loads[-1] - loads[0]), names))
        names += 1
    (_, nodes) = tuples.popitem()[1]
    label = np.zeros(fresh, np.int64)
    for place, node in enumerate(nodes.tolist()):
        if node >= 0:
            label[node] = bins - 1 - place
    for node in range(fresh - 1, count - 1, -1):
        left, right = joined[node - count]
        label[left] = label[right] = label[node]
    return label[:count]


def _bundles(items: DataFrame, per_bucket: int) -> DataFrame:
    """(_item, _bundle, _bytes) after differencing every ``_bucket`` of items into bundles."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_bytes", "_item"], ascending=[False, True])
        bundle = difference(frame["_bytes"].to_numpy(np.int64), per_bucket)
        bundle += frame["_bucket"].to_numpy(np.int64) * per_bucket
        return pd.DataFrame({"_item": frame["_item"], "_bundle": bundle, "_bytes": frame["_bytes"]})

    kind = items.schema["_item"].dataType.simpleString()
    return items.groupBy("_bucket").applyInPandas(run, f"_item {kind}, _bundle bigint, _bytes bigint")


def karmarkar_karp(groups: DataFrame, shards: int) -> DataFrame:
    """(_group, _shard) for ``groups`` of (_group, _bytes), shards near equal in bytes."""
    items, rows = counted(groups.select(F.col("_group").alias("_item"), "_bytes"), "shard-items")
    total = items.agg(F.sum("_bytes")).head()[0] or 0
    in_bucket, in_last = max(BUCKET_ITEMS, 20 * shards), max(LAST_ITEMS, 100 * shards)
    # of more than this many bytes there are at most a quarter of the last level's items
    large = F.col("_bytes") > 4 * total / in_last
    path = items.select(F.col("_item").alias("_group"), "_item")
    while rows > in_last:
        buckets = parts(rows, in_bucket)
        per_bucket = max(shards, in_last // 2 // buckets // shards * shards)
        placed = items.filter(~large).withColumn("_bucket", bucket(F.col("_item"), buckets))
        bundles = _bundles(placed, per_bucket).withColumn("_next", F.col("_bundle").cast("string"))
        alone = items.filter(large).withColumn("_next", F.concat(F.lit("g"), "_item"))
        step = written(
            bundles.select("_item", "_next", "_bytes").unionByName(alone.select("_item", "_next", "_bytes")),
            "shard-bundles",
        )
        path = path.join(step.select("_item", "_next"), "_item").select("_group", F.col("_next").alias("_item"))
        merged = step.groupBy(F.col("_next").alias("_item")).agg(F.sum("_bytes").alias("_bytes"))
        items, rows = counted(merged, "shard-items")
    # the last level: a bounded number of bundles, packed into a few rows for one task
    packed = items.withColumn("_part", bucket(F.col("_item"), 64)).groupBy("_part").agg(
        F.collect_list(F.struct("_item", "_bytes")).alias("_items")
    )

    def last(frame: pd.DataFrame) -> pd.DataFrame:
        every = sorted((-x["_bytes"], x["_item"]) for row in frame["_items"] for x in row)
        shard = difference(np.array([-size for size, _ in every], np.int64), shards)
        return pd.DataFrame({"_item": [item for _, item in every], "_shard": shard})

    kind = items.schema["_item"].dataType.simpleString()
    shard_of = packed.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(last, f"_item {kind}, _shard bigint")
    return path.join(written(shard_of, "shard-last"), "_item").select("_group", F.col("_shard").cast("int").alias("_shard"))


def with_slots(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """``rows``, written with a row number ``_row``, with ``_slot``: a gapless number from 0 within each ``_shard``.

    Shards are numbered in pieces of bounded size, which start where the pieces before end. Rows that
    agree in ``order`` are many pieces' if they are many.
    """
    pieces = parts(count, SLOT_ROWS) * 4
    rows = salted(rows, order, SLOT_ROWS)
    rows = rows.withColumn("_piece", F.pmod(F.xxhash64(*order, "_salt"), F.lit(pieces)).cast("int"))
    before = Window.partitionBy("_shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("_shard", "_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_shard", "_piece").orderBy(*order))
    return (
        rows.withColumn("_rank", inside)
        .join(starts, ["_shard", "_piece"])
        .withColumn("_slot", F.col("_start") + F.col("_rank") - 1)
        .drop("_piece", "_rank", "_start", "_salt", "_row")
    )


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shards have near-equal bytes, and equal texts share a shard. A
    size is the UTF-8 bytes of the text (NULL: none) plus 8; NULL and empty texts are one
    group. ``slot`` numbers the rows of a shard without gaps; ``grown_shard`` is NULL under this law.
    A group larger than a mean shard gets a shard of its own. Repeated rows each get a slot,
    and so do rows without an id, whose id is NULL in the result.
    """
    given = id_and_text(docs, id_col, text_col)
    rows, count = counted(
        given.select(
            "_id",
            (F.octet_length("_text") + 8).cast("long").alias("_size"),
            F.crc32(F.col("_text").cast("binary")).alias("_crc"),
            F.unhex(F.md5(F.col("_text").cast("binary"))).alias("_group"),
        ),
        "shard-documents",
    )
    groups = rows.groupBy("_group").agg(F.sum("_size").alias("_bytes"))
    # ids of groups as short text, the form bundles have too
    groups = groups.withColumn("_group", F.hex("_group"))
    shard_of = karmarkar_karp(groups, shards).withColumn("_group", F.unhex("_group"))
    placed = rows.join(shard_of, "_group").withColumn("_row", F.monotonically_increasing_id())
    placed = written(placed, "shard-placed")
    return with_slots(placed, ["_id", "_crc"], count).select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
