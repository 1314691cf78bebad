"""Repeated windows: sampled suffixes that bring all copies of a window together.

Of every window of ``width`` symbols, the start with the least hash among its first
``reach`` positions is its anchor. Equal windows have their anchor at the same place and hold
the same ``width - reach + 1`` symbols from there on, the anchor's key: a prefix of the suffix at the window's start whose length varies
with the place of the anchor. So copies of a window meet where anchors are grouped by key.
An anchor's context is the stretch that its windows cover.

Grouping yields two things. Windows of contexts that occur again as a whole are decided at once.
Where one key has several contexts, one of each, and every place that is not decided, goes on as text
to be compared window by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import bucket, counted, hand_back, id_and_text, parts, small, small_batches, written
from engagemart.llm.words import Powers, Rolling, lists, mix, packed, text_slices

#: Text per task that groups anchors; contexts of one key compared in one task.
SLOT_BYTES, GROUP_CONTEXTS = 8 << 20, 4_000
#: Text whose windows are hashed at once: it takes about 100 times its size.
_HASHED_BYTES = 1 << 18
_HELD_ANCHORS = 1 << 18
_GRAM = 4


@dataclass(frozen=True)
class Windows:
    width: int
    reach: int

    @property
    def key(self) -> int:
        return self.width - self.reach + 1


def window_anchors(values: np.ndarray, bounds: np.ndarray, windows: Windows, powers: Powers):
    """(row, anchor, first window, last window, key hash, context hash) of each anchor; places count from
    the start of ``values``, in which row r holds ``bounds[r]`` to ``bounds[r + 1]``."""
    lengths = np.diff(bounds)
    counts = np.maximum(lengths - windows.width + 1, 0)
    rows = np.repeat(np.arange(len(lengths)), counts)
    nothing = np.zeros(0, np.int64)
    if not len(rows):
        return nothing, nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    starts = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[rows]
    hashes = Rolling(values, powers)
    places = np.arange(len(values) - _GRAM + 1)
    best = hashes(places, places + _GRAM) >> np.uint64(32) << np.uint64(32) | places.astype(np.uint64)
    span = 1
    while 2 * span <= windows.reach:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    best = np.minimum(best[starts], best[starts + windows.reach - span])
    anchor = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.ones(len(rows), bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (rows[1:] != rows[:-1])
    cut = np.flatnonzero(first)
    low, high = starts[cut], starts[np.append(cut[1:], len(rows)) - 1]
    anchor, rows = anchor[cut], rows[cut]
    key = hashes(anchor, anchor + windows.key)
    context = hashes(low, high + windows.width) + mix(((anchor - low) * 4096 + (high - low)).astype(np.uint64))
    return rows, anchor, low, high, key, mix(context)


#: Columns of packed anchors: place of the anchor, window starts before it and from it on.
_PACKED = {
    "_key": np.uint64,
    "_context": np.uint64,
    "_doc": np.int64,
    "_place": np.int32,
    "_low": np.int16,
    "_high": np.int16,
}


def anchor_blobs(given: DataFrame, slots: int, windows: Windows, sequences: Callable) -> DataFrame:
    """Anchors of all documents, packed by slot of their key.

    ``sequences(data, offsets, powers)`` turns a slice of texts into (values, row bounds).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(least=_HASHED_BYTES), [], 0

        def blobs_of() -> pa.RecordBatch:
            slot = np.concatenate([columns[0] for columns in held])
            slot = (slot >> np.uint64(33)).astype(np.int64) % slots
            order = np.argsort(slot, kind="stable")
            cuts = np.searchsorted(slot[order], np.arange(slots + 1))
            full = np.flatnonzero(np.diff(cuts))
            blobs = []
            for parts_of_column in zip(*held, strict=True):
                column = np.concatenate(parts_of_column)[order]
                blobs.append(pa.array([column[cuts[s] : cuts[s + 1]].tobytes() for s in full], pa.binary()))
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), *blobs], ["_slot", *_PACKED])

        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, _, data, offsets in text_slices(batch.column("_text"), _HASHED_BYTES):
                values, bounds = sequences(data, offsets, powers)
                rows, anchor, low, high, key, context = window_anchors(values, bounds, windows, powers)
                columns = (key, context, ids[first + rows], anchor - bounds[rows], anchor - low, high - anchor + 1)
                held.append([c.astype(kind) for c, kind in zip(columns, _PACKED.values(), strict=True)])
                size += len(key)
                if size >= _HELD_ANCHORS:
                    yield blobs_of()
                    held, size = [], 0
            hand_back()
        if size:
            yield blobs_of()
        held, powers = [], None
        hand_back()

    return given.mapInArrow(run, "_slot int, " + ", ".join(f"{name} binary" for name in _PACKED))


def grouped_anchors(blobs: DataFrame, windows: Windows, decide: Callable) -> DataFrame:
    """(_doc, _from, _to, _key, _place): decided spans, and with ``_key`` contexts that are still open.

    Places count symbols of the document. ``_from`` and ``_to`` bound a span to remove, or the window
    starts of an open context. ``decide(size, doc, least)`` tells for each anchor of a repeated key whether all its
    windows go: ``size`` anchors have its context, ``least`` is the first document of them.
    """

    def run(table: pa.Table) -> pa.Table:
        hand_back()  # what the slot before has left
        key, context, doc, place, low, high = (
            packed(table.column(name), kind) for name, kind in _PACKED.items()
        )
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(order), bool)  # a key of one anchor needs no more work
        again[1:] |= same
        again[:-1] |= same
        order = order[again]
        order = order[np.lexsort((place[order], doc[order], context[order], key[order]))]
        key, context, doc = key[order], context[order], doc[order]
        place = place[order].astype(np.int64)
        begin, end = place - low[order], place + high[order]
        new_key, new = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new[1:] = new_key[1:] | (context[1:] != context[:-1])
        heads, member, key_number = np.flatnonzero(new), np.cumsum(new) - 1, np.cumsum(new_key) - 1
        sizes = np.diff(np.append(heads, len(key)))
        goes = decide(sizes[member], doc, doc[heads][member])
        # one of each context, and every anchor that does not go, is compared with the others of its key, unless all go
        several = np.bincount(key_number[new]) > 1
        unsettled = np.bincount(key_number, weights=~goes) > 0
        sent = (new | ~goes) & (several & unsettled)[key_number]
        nulls = pa.nulls(int(goes.sum()), pa.int64())
        return pa.table(
            {
                "_doc": np.concatenate([doc[goes], doc[sent]]),
                "_from": np.concatenate([begin[goes], begin[sent]]),
                "_to": np.concatenate([end[goes] + windows.width - 1, end[sent]]),
                "_key": pa.chunked_array([nulls, pa.array(key[sent].astype(np.int64))]),
                "_place": pa.chunked_array([nulls, pa.array(place[sent])]),
            }
        )

    return blobs.groupBy("_slot").applyInArrow(
        run, "_doc bigint, _from bigint, _to bigint, _key bigint, _place bigint"
    )


def open_contexts(given: DataFrame, opened: DataFrame, windows: Windows, symbols: Callable) -> DataFrame:
    """Open contexts as (_doc, _from, _left, _right, _group): what stands before and after the key.

    ``symbols(text)`` gives a text's symbols, ``_group`` has the hash and a digest of the key, so contexts of one group have equal keys.
    """
    wanted = opened.groupBy("_doc").agg(F.collect_list(F.struct("_key", "_place", "_from", "_to")).alias("_open"))
    texts = given.join(wanted, given["_id"] == F.col("_doc")).select("_doc", "_open", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (batch.slice(first, 200) for batch in batches for first in range(0, batch.num_rows, 200))
        for part in pieces:
            for doc, opened, text in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                row, join = symbols(text)
                found = []
                for at in opened:
                    key_end = at["_place"] + windows.key
                    core = join(row[at["_place"] : key_end])
                    found.append(
                        {
                            "_doc": doc,
                            "_from": at["_from"],
                            "_left": join(row[at["_from"] : at["_place"]]),
                            "_right": join(row[key_end : at["_to"] - 1 + windows.width]),
                            "_group": at["_key"].to_bytes(8, "little", signed=True) + hashlib.md5(core).digest(),
                        }
                    )
                yield from pa.Table.from_pylist(found).to_batches()
        hand_back()

    return texts.mapInArrow(run, "_doc bigint, _from bigint, _left binary, _right binary, _group binary")


def repeated_windows(
    docs: DataFrame, id_col: str, text_col: str, windows: Windows, decide: Callable, sequences: Callable,
    symbols: Callable, compare: Callable, count_large: Callable, group_contexts: int = GROUP_CONTEXTS,
) -> DataFrame:
    """(_doc, _spans): disjoint spans, in symbols, of the windows that go; documents without any are left out.

    ``compare`` (an Arrow function of a table of open contexts) settles groups in memory; groups of more than
    ``group_contexts`` contexts are settled by ``count_large``, a shuffle of their windows.
    """
    small_batches(docs.sparkSession)
    given = id_and_text(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(text_col))).head()[0] or 0
    blobs = anchor_blobs(given, parts(size, SLOT_BYTES), windows, sequences)
    anchors = written(grouped_anchors(blobs, windows, decide), "anchors")
    spans = anchors.filter("_key is null").select("_doc", "_from", "_to")
    opened = anchors.filter("_key is not null")
    count = opened.count()
    if count:
        contexts = written(open_contexts(given, opened, windows, symbols), "contexts")
        large, kept = counted(
            contexts.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_contexts).select("_group"),
            "large-groups",
        )
        common = contexts
        if kept:
            common = contexts.join(small(large, kept, 40), "_group", "left_anti")
            spans = spans.unionByName(count_large(contexts.join(small(large, kept, 40), "_group", "left_semi")))
        slots = parts(count, group_contexts)
        # contexts are short but take long to compare, so tasks are as many as slots, whatever their size
        slotted = common.withColumn("_slot", bucket(F.col("_group"), slots)).repartition(slots, "_slot")
        settled = slotted.groupBy("_slot").applyInArrow(compare, "_doc bigint, _from bigint, _to bigint")
        spans = spans.unionByName(settled)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("_spans")
            amounts = pc.list_value_length(spans).to_numpy()
            begin, end = (pc.list_flatten(spans).field(k).to_numpy() for k in (0, 1))
            begin, end, amounts = union_of(begin, end, amounts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), lists(begin, amounts), lists(end, amounts)], ["_doc", "_from", "_to"]
            )

    together = spans.groupBy("_doc").agg(F.sort_array(F.collect_list(F.struct("_from", "_to"))).alias("_spans"))
    return written(together.mapInArrow(unite, "_doc bigint, _from array<bigint>, _to array<bigint>"), "spans")


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text, _from, _to) of every document; no spans are NULL."""
    given = id_and_text(docs, id_col, text_col)
    rows = spans.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_from")), F.lit(0))).head()
    return given.join(small(spans, rows[0] * 4 + rows[1], 24), given["_id"] == F.col("_doc"), "left").drop("_doc")


def runs(doc: np.ndarray, place: np.ndarray, width: int) -> pa.Table:
    """Window starts (sorted by document and place) as spans, neighbouring starts in one."""
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(doc))[: len(heads)] - 1
    return pa.table({"_doc": doc[heads], "_from": place[heads], "_to": place[tails] + width})


def union_of(begin: np.ndarray, end: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans with overlapping and touching ones joined; rows of ``amounts`` spans each, sorted by ``begin``."""
    row = np.repeat(np.arange(len(amounts)), amounts)
    apart = row * (int(end.max(initial=0)) + 2)  # puts the rows behind one another with a gap
    reach = np.maximum.accumulate(end + apart)
    first = np.ones(len(begin), bool)
    first[1:] = begin[1:] + apart[1:] > reach[:-1]
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(begin))[: len(heads)] - 1
    return begin[heads], reach[tails] - apart[tails], np.bincount(row[heads], minlength=len(amounts))
