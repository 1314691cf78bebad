"""Substring deduplication by prefix-partitioned suffix trees over words.

The suffixes of interest start at the windows of every text. A suffix belongs to the group of its
prefix, which runs to the end of its window's anchor key and so has 26 to 50 words, depending on the
content; groups fit in memory, and larger ones are split by the whole window. A group's
suffix tree is its sorted suffixes with the common prefixes of neighbours: an
internal node as deep as a window is one repeated window, and the suffixes below it are its places. The
document with the smallest id below a node keeps the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.anchors import GROUP_CONTEXTS, Windows, repeated_windows, runs, with_spans
from engagemart.llm.common import text_keys, with_names
from engagemart.llm.words import Powers, word_bounds, word_hashes

WINDOWS = Windows(width=50, reach=25)


def _sequences(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, before = word_bounds(data, offsets)
    return word_hashes(data, starts, ends, powers), before


def _symbols(text: str):
    return text.encode().split(), b" ".join


def _later(size: np.ndarray, doc: np.ndarray, least: np.ndarray) -> np.ndarray:
    return doc > least


def suffix_rows(groups: list[bytes], lefts: list[bytes], rights: list[bytes], reach: int):
    """(context, window in it, symbols) of every suffix: words before the key, the key as one symbol, words after it."""
    names: dict[bytes, int] = {}
    cores: dict[bytes, int] = {}
    flat, lengths, starts = [], [], []
    for group, left, right in zip(groups, lefts, rights, strict=True):
        before, after = left.split(), right.split()
        flat += [names.setdefault(w, len(names)) for w in before]
        flat.append(-1 - cores.setdefault(group, len(cores)))
        flat += [names.setdefault(w, len(names)) for w in after]
        lengths.append(len(before) + 1 + len(after))
        starts.append(lengths[-1] - reach + 1)
    symbols, windows = np.array(flat, np.int32), np.array(starts, np.int64)
    begins = np.cumsum(lengths) - lengths
    context = np.repeat(np.arange(len(windows)), windows)
    window = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return context, window, symbols[(begins[context] + window)[:, None] + np.arange(reach)]


def deep_nodes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and for each place in that order the number of its node of full depth."""
    order = np.lexsort(rows.T[::-1])
    differ = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])  # prefix shared with the one before
    return order, np.concatenate([[0], np.cumsum(common < rows.shape[1])])


def _compare(windows: Windows):
    def run(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_pylist() for name in ("_group", "_left", "_right")}
        context, window, rows = suffix_rows(*columns.values(), windows.reach)
        doc = table.column("_doc").to_numpy()[context]
        place = table.column("_from").to_numpy()[context] + window
        order, node = deep_nodes(rows)
        heads = np.searchsorted(node, np.arange(node[-1] + 1))
        least = np.minimum.reduceat(doc[order], heads)[node]
        gone = order[doc[order] > least]
        gone = gone[np.lexsort((place[gone], doc[gone]))]
        return runs(doc[gone], place[gone], windows.width)

    return run


def _large(windows: Windows):
    """Groups beyond memory: each window is a row, and the smallest document of a window is an aggregate."""

    def settle(contexts: DataFrame) -> DataFrame:
        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {name: batch.column(name).to_pylist() for name in ("_group", "_left", "_right", "_doc", "_from")}
                for group, left, right, doc, begin in zip(*columns.values(), strict=True):
                    before, after = left.split(), right.split()
                    found = []
                    for k in range(len(before) + 2 + len(after) - windows.reach):
                        window = (before[k:], after[: windows.reach - 1 - len(before) + k])
                        digest = hashlib.md5(group + b" ".join(window[0]) + b"\n" + b" ".join(window[1])).digest()
                        found.append({"_window": digest, "_doc": doc, "_at": begin + k})
                    yield from pa.Table.from_pylist(found).to_batches()

        rows = contexts.mapInArrow(explode, "_window binary, _doc bigint, _at bigint")
        least = rows.groupBy("_window").agg(F.min("_doc").alias("_least"))
        return rows.join(least, "_window").filter("_doc > _least").select(
            "_doc", F.col("_at").alias("_from"), (F.col("_at") + windows.width).alias("_to")
        )

    return settle


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: Windows = WINDOWS, group_contexts: int = GROUP_CONTEXTS
) -> DataFrame:
    """(_doc, _from, _to): the word spans to remove, as two lists; documents that lose nothing are left out."""
    return repeated_windows(
        docs, id_col, text_col, windows, _later, _sequences, _symbols, _compare(windows), _large(windows), group_contexts
    )


def dedup_digest(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: Windows = WINDOWS,
    group_contexts: int = GROUP_CONTEXTS, with_text: bool = False,
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (and ``kept_text``).

    A word goes if a window of ``windows.width`` words that covers it also starts in a document
    with a smaller id. Windows are judged on the input. NULL, empty and shorter texts lose nothing. Rows repeating an id and text
    lose the same words. Rows without an id are documents of their own and come after all ids; of rows that share an id
    but not the text, those of one text keep its place and the others are such documents too.
    """
    named, (docs, top, forms) = docs, text_keys(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, windows, group_contexts)
    given = with_spans(docs, spans, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                total, gone, digests, texts = [], [], [], []
                columns = (part.column(name).to_pylist() for name in ("_text", "_from", "_to"))
                for text, begins, ends in zip(*columns, strict=True):
                    words, kept, last = text.encode().split(), [], 0
                    for begin, end in zip(begins or (), ends or (), strict=True):
                        kept += words[last:begin]
                        last = end
                    kept += words[last:]
                    total.append(len(words))
                    gone.append(len(words) - len(kept))
                    joined = b" ".join(kept)
                    digests.append(hashlib.sha256(joined).hexdigest())
                    if with_text:
                        texts.append(joined.decode())
                values = [part.column("_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
                names = [id_col, "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    values, names = [*values, pa.array(texts, pa.string())], [*names, "kept_text"]
                yield pa.RecordBatch.from_arrays(values, names)

    kind = given.schema["_id"].dataType.simpleString()
    schema = f"{id_col} {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    return with_names(given.mapInArrow(run, schema + ", kept_text string" * with_text), top, forms, named, id_col)
