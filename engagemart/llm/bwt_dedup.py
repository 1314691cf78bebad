"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A group holds the contexts of one key, so what stands between left and right is equal in
all of them and counts as one symbol. The contexts of a task are split into shards, each
with the transform of its strings. Two transforms are merged by refining an interleave: a bit for each
suffix tells its shard; one pass takes the preceding symbols in the order of the present interleave, and a stable sort by
symbol gives the interleave that is right one symbol deeper. The borders that each pass finds are
the common prefixes of neighbours; after as many passes as a window has symbols, intervals of
two or more suffixes are the repeated windows. Suffixes are sorted only inside the shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.anchors import GROUP_CONTEXTS, Windows, repeated_windows, runs, with_spans
from engagemart.llm.common import hand_back, text_keys, with_names
from engagemart.llm.words import Powers

WINDOWS = Windows(width=400, reach=64)
SHARDS = 2


def _sequences(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    return data.astype(np.uint64) + np.uint64(1), offsets


def _symbols(text: str):
    return text.encode(), bytes


def _shared(size: np.ndarray, doc: np.ndarray, least: np.ndarray) -> np.ndarray:
    return size > 1


@dataclass
class Transform:
    """The transform of some strings: of each suffix in order, the symbol before it and its place in the text.

    The first ``strings`` suffixes are the ends of the strings, in the order of the strings; before
    the start of a string stands its own end, symbol 0.
    """

    before: np.ndarray
    places: np.ndarray
    strings: int


def transform(text: np.ndarray, first: int) -> Transform:
    """The transform of ``text``, strings of symbols from 1 each followed by 0; places count from ``first``."""
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    step = 1
    while True:
        following = np.zeros(len(rank), np.int64)
        following[:-step] = rank[step:]
        order = np.argsort(rank * (len(rank) + 70_000) + following, kind="stable")
        pairs = np.stack([rank[order], following[order]])
        fresh = np.ones(len(rank), np.int64)
        fresh[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all():
            break
        step *= 2
    before = np.concatenate([[0], text[:-1]]).astype(text.dtype)
    return Transform(before[order], order + first, len(ends))


def merge(one: Transform, other: Transform, depth: int) -> tuple[Transform, np.ndarray]:
    """The transform of the strings of both, and the interval of each suffix: equal for suffixes that
    share their first ``depth`` symbols."""
    strings = one.strings + other.strings
    ends = np.concatenate([np.zeros(one.strings, bool), np.ones(other.strings, bool)])
    side = np.concatenate([np.zeros(len(one.before), bool), np.ones(len(other.before), bool)])
    before = np.empty(len(side), one.before.dtype)
    interval = np.zeros(len(side), np.int32)
    for _ in range(depth):
        before[~side], before[side] = one.before, other.before
        order = np.argsort(before, kind="stable")
        symbol, inner = before[order], interval[order]
        border = np.ones(len(side), bool)
        border[strings:] = (symbol[strings:] != symbol[strings - 1 : -1]) | (inner[strings:] != inner[strings - 1 : -1])
        side = side[order]
        side[:strings] = ends  # ends differ from one another and keep their order
        interval = np.cumsum(border, dtype=np.int32)
    before[~side], before[side] = one.before, other.before
    places = np.empty(len(side), np.int64)
    places[~side], places[side] = one.places, other.places
    return Transform(before, places, strings), interval


def repeated_places(strings: list[np.ndarray], depth: int, shards: int = SHARDS) -> np.ndarray:
    """Whether the ``depth`` symbols from each place of the strings, laid end to end with an end symbol
    after each, stand at two or more places."""
    text = np.concatenate([part for string in strings for part in (string, [0])])
    text = text.astype(np.uint16 if text.max(initial=0) < 1 << 16 else np.int64)
    cuts = np.cumsum([0, *(len(string) + 1 for string in strings)])
    ends = cuts[np.linspace(0, len(strings), min(shards, len(strings)) + 1).astype(int)]
    queue = [transform(text[a:b], int(a)) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    if len(queue) == 1:  # nothing to merge it with: refine it against no strings
        queue.append(Transform(text[:0], np.zeros(0, np.int64), 0))
    while len(queue) > 1:
        merged, interval = merge(queue[0], queue[1], depth)
        queue = [*queue[2:], merged]
    result = np.zeros(len(text), bool)
    result[merged.places] = np.bincount(interval)[interval] > 1
    return result


def _compare(windows: Windows):
    def run(table: pa.Table) -> pa.Table:
        hand_back()  # what the slot before has left
        groups, lefts, rights = (table.column(name).to_pylist() for name in ("_group", "_left", "_right"))
        keys = {group: 257 + number for number, group in enumerate(dict.fromkeys(groups))}
        strings = [
            np.concatenate(
                [np.frombuffer(left, np.uint8).astype(np.int64) + 1, [keys[group]], np.frombuffer(right, np.uint8).astype(np.int64) + 1]
            )
            for group, left, right in zip(groups, lefts, rights, strict=True)
        ]
        again = repeated_places(strings, windows.reach)
        lengths = np.array([len(string) for string in strings])
        begins = np.cumsum(lengths + 1) - lengths - 1
        counts = lengths - windows.reach + 1  # windows of each context
        context = np.repeat(np.arange(len(strings)), counts)
        window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        gone = again[begins[context] + window]
        doc = table.column("_doc").to_numpy()[context][gone]
        place = (table.column("_from").to_numpy()[context] + window)[gone]
        order = np.lexsort((place, doc))
        return runs(doc[order], place[order], windows.width)

    return run


def _large(windows: Windows):
    """Groups beyond memory: each window is a row, and how often it stands is an aggregate."""

    def settle(contexts: DataFrame) -> DataFrame:
        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {name: batch.column(name).to_pylist() for name in ("_group", "_left", "_right", "_doc", "_from")}
                for group, left, right, doc, begin in zip(*columns.values(), strict=True):
                    found = []
                    for k in range(len(left) + 2 + len(right) - windows.reach):
                        tail = right[: windows.reach - 1 - len(left) + k]
                        digest = hashlib.md5(group + bytes([len(left) - k]) + left[k:] + tail).digest()
                        found.append({"_window": digest, "_doc": doc, "_at": begin + k})
                    yield from pa.Table.from_pylist(found).to_batches()

        rows = contexts.mapInArrow(explode, "_window binary, _doc bigint, _at bigint")
        again = rows.groupBy("_window").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        return rows.join(again, "_window").select(
            "_doc", F.col("_at").alias("_from"), (F.col("_at") + windows.width).alias("_to")
        )

    return settle


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: Windows = WINDOWS, group_contexts: int = GROUP_CONTEXTS
) -> DataFrame:
    """(_doc, _from, _to): the byte spans to remove, as two lists; documents that lose nothing are left out."""
    return repeated_windows(
        docs, id_col, text_col, windows, _shared, _sequences, _symbols, _compare(windows), _large(windows), group_contexts
    )


def dedup_digest(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: Windows = WINDOWS,
    group_contexts: int = GROUP_CONTEXTS, with_bytes: bool = False,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the bytes).

    Texts are UTF-8 bytes. A byte goes if a string of ``windows.width`` bytes that covers it starts at two or more places, of
    one document or several; strings are judged on the input. NULL, empty and shorter texts lose nothing.
    Rows without an id are documents of their own, and so are rows that share an id but not the text. Rows repeating
    id and text count as copies and lose the same bytes.
    """
    named, (docs, top, forms) = docs, text_keys(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, windows, group_contexts)
    given = with_spans(docs, spans, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                rows: list[tuple] = []
                columns = (part.column(name).to_pylist() for name in ("_text", "_from", "_to"))
                for text, begins, ends in zip(*columns, strict=True):
                    data, kept, last = text.encode(), [], 0
                    for begin, end in zip(begins or (), ends or (), strict=True):
                        kept.append(data[last:begin])
                        last = end
                    whole = b"".join([*kept, data[last:]])
                    row = (len(data), len(data) - len(whole), len(kept), hashlib.sha256(whole).hexdigest())
                    rows.append((*row, whole) if with_bytes else row)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_bytes]
                values = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
                names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *values], names[: 5 + with_bytes])
            hand_back()

    kind = given.schema["_id"].dataType.simpleString()
    schema = f"{id_col} {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return with_names(given.mapInArrow(run, schema + ", kept binary" * with_bytes), top, forms, named, id_col)
