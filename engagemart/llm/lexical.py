"""Ranked lexical search: term-at-a-time scoring with limited accumulators over an inverted index.

The index is partitioned by document: each row of it holds the posting lists of a few megabytes of text, for
the terms of a block of queries. Every task scores all queries of the block against its rows. A query's terms
are taken from the rarest on; each adds to the accumulators of the documents in its list. As soon as the terms
left cannot lift a document without an accumulator to the k-th best partial score, no new accumulators are
made; those there are go on being updated, so their scores stay exact. Tasks hand on their best k of each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from engagemart.llm.common import hand_back, id_and_text, parts, small_batches, written
from engagemart.llm.words import packed, text_slices

TOP = 50
#: Text bytes of an index row and of the rows one task scores; queries, and their bytes, held by every task at once.
BLOCK_BYTES, TASK_BYTES = 8 << 20, 64 << 20
QUERY_ITEMS, QUERY_BYTES = 2_000, 8 << 20
_ROWS = "_ids array<bigint>, _lengths binary, _n bigint, _total bigint, _bytes bigint, _terms array<int>, _dfs array<int>, _docs binary, _tfs binary"
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]

#: Bytes as they are compared: digits, letters in lower case, all of a character beyond ASCII; a blank for the others.
FOLD = np.array([c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256)], np.uint8)


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, with repeats."""
    return (text or "").encode().translate(FOLD.tobytes()).split()


@dataclass
class QueryBlock:
    """Some queries: the ids of their items, their terms' numbers, and the terms by number."""

    items: list[Any]
    terms: list[np.ndarray]
    vocabulary: list[bytes]


def query_blocks(
    items: DataFrame, id_col: str, text_col: str, most_items: int = QUERY_ITEMS, most_bytes: int = QUERY_BYTES
) -> Iterator[QueryBlock]:
    """The queries in blocks of bounded size, one after the other (one larger text is a block of its own)."""
    block, numbers, held = QueryBlock([], [], []), {}, 0
    for item, text in id_and_text(items, id_col, text_col).toLocalIterator():
        if block.items and (len(block.items) >= most_items or held + len(text) > most_bytes):
            yield block
            block, numbers, held = QueryBlock([], [], []), {}, 0
        distinct = sorted(set(terms_of(text)))
        block.items.append(item)
        block.terms.append(np.array([numbers.setdefault(term, len(numbers)) for term in distinct], np.int64))
        block.vocabulary = list(numbers)
        held += len(text)
    if block.items:
        yield block


def _word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    solid = data != 32
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid
    before[offsets] = False
    return np.flatnonzero(solid & ~before[:-1])


def index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Posting lists of ``vocabulary``, one row per ``BLOCK_BYTES`` of text: document ids, terms of each document,
    and per term that occurs, in ascending order, its documents (numbers within the row) and occurrences."""
    given = id_and_text(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        numbers = {term: number for number, term in enumerate(vocabulary)}
        for batch in batches:
            for first, past, raw, offsets in text_slices(batch.column("_text"), BLOCK_BYTES):
                rows, data = past - first, FOLD[raw]
                starts = _word_starts(data, offsets)
                lengths = np.diff(np.searchsorted(starts, offsets))
                keys = np.zeros(0, np.int64)
                if len(starts):
                    # a word reaches to the next one's start, so words lie one after the other as Arrow wants them
                    bounds = np.append(starts, len(data)).astype(np.int32)
                    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
                    coded = words.dictionary_encode()
                    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                    known = np.array([numbers.get(word.rstrip(), -1) for word in distinct], np.int64)
                    term = known[coded.indices.to_numpy()]
                    keys = (term * rows + np.repeat(np.arange(rows), lengths))[term >= 0]
                pairs, tfs = np.unique(keys, return_counts=True)
                terms, dfs = np.unique(pairs // rows, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("_id").slice(first, rows).to_pylist()], pa.list_(pa.int64())),
                        pa.array([lengths.astype(np.int64).tobytes()]),
                        pa.array([int((lengths > 0).sum())]),
                        pa.array([int(lengths.sum())]),
                        pa.array([len(raw)]),
                        pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([dfs.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([(pairs % rows).astype(np.int32).tobytes()]),
                        pa.array([tfs.astype(np.int32).tobytes()]),
                    ],
                    _NAMES,
                )

    return given.mapInArrow(run, _ROWS)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class _Best:
    """The best k (score, id) of a query so far: highest scores, then smallest ids, NULL ids last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.none = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """What a further document must reach."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        scores, ids, none = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.none, none)))
        order = np.lexsort((ids, none, -scores))[: self.k]
        self.scores, self.ids, self.none = scores[order], ids[order], none[order]


def accumulate(
    lists: list[tuple[np.ndarray, np.ndarray]], docs: int, k: int, floor: int, limit: bool = True
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores by document, which documents have an accumulator, and the lists that could make new ones.

    ``lists`` has (documents, contributions) of each term, rarest first; ``floor`` is the k-th best score known
    from elsewhere. Documents without an accumulator score less than the best k; all other scores are exact.
    """
    scores, made = np.zeros(docs, np.int64), np.zeros(docs, bool)
    most = np.array([int(part.max()) for _, part in lists], np.int64)
    left = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
    making = len(lists)
    for place, (own, part) in enumerate(lists):
        if limit and making > place and place:
            best = floor
            # k-th best partial scores cannot exceed what the terms so far can give
            if left[place] < left[0] - left[place] and np.count_nonzero(made) >= k:
                best = max(best, int(np.partition(scores, docs - k)[docs - k]))
            if left[place] < best:
                making = place
        if place < making:
            scores[own] += part
            made[own] = True
        else:
            alive = made[own]
            scores[own[alive]] += part[alive]
    return scores, made, making


def _scorer(queries: QueryBlock, df: np.ndarray, n: int, total: int, k: int, id_type: pa.DataType, limit: bool):
    weights = np.array([weight(n, x) if x else 0 for x in df.tolist()], np.int64)
    # rarest first; equally rare ones in the order of their bytes
    ranks = np.argsort(np.argsort(np.array(queries.vocabulary, object))) if queries.vocabulary else np.zeros(0, np.int64)
    ordered = [terms[np.lexsort((ranks[terms], df[terms]))] for terms in queries.terms]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        best = [_Best(k) for _ in queries.items]
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                found = one.column("_ids")[0].values
                none = found.is_null().to_numpy(zero_copy_only=False)
                ids = found.fill_null(0).to_numpy()
                lengths, docs, tfs = (
                    packed(pa.chunked_array([one.column(name)]), kind)
                    for name, kind in (("_lengths", np.int64), ("_docs", np.int32), ("_tfs", np.int32))
                )
                if not len(docs):
                    continue
                terms, counts = (one.column(name)[0].values.to_numpy() for name in ("_terms", "_dfs"))
                tf, m = tfs.astype(np.int64), 100 - 50 + (50 * lengths * n) // total
                gained = np.repeat(weights[terms], counts) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[docs]))
                ends = np.cumsum(counts)
                place = np.full(len(queries.vocabulary), -1, np.int64)
                place[terms] = np.arange(len(terms))
                for query, order in enumerate(ordered):
                    own = place[order]
                    lists = [(docs[ends[t] - counts[t] : ends[t]], gained[ends[t] - counts[t] : ends[t]]) for t in own[own >= 0]]
                    if not lists:
                        continue
                    scores, made, _ = accumulate(lists, len(ids), k, best[query].floor, limit)
                    hits = np.flatnonzero(made & (scores >= best[query].floor))
                    if len(hits) > k:  # ids decide among those at the k-th score
                        hits = hits[scores[hits] >= np.partition(scores[hits], len(hits) - k)[len(hits) - k]]
                    if len(hits):
                        best[query].add(scores[hits], ids[hits], none[hits])
        for query, top in enumerate(best):
            if len(top.scores):
                count = len(top.scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, query, np.int32)),
                        pa.array([queries.items[query]] * count, id_type),
                        pa.array(top.ids, mask=top.none),
                        pa.array(top.scores),
                    ],
                    ["_query", "item_id", "doc_id", "score"],
                )

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most_items: int = QUERY_ITEMS,
    limit: bool = True,
) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``k`` best documents with a score above 0, equal scores by ascending id.

    NULL and empty texts have no terms: such documents are never found and not counted, such items find nothing.
    Every row of ``docs`` is a document and every row of ``items`` a query of its own, also where ids repeat or are
    missing; documents without an id come last among equal scores. Ids of documents must be whole numbers. Empty
    tables give no rows. Queries go to tasks in blocks of bounded size; each block reads the documents once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = items.schema[item_col].dataType
    schema = f"_query int, item_id {kind.simpleString()}, doc_id bigint, score bigint"
    found = []
    for block in query_blocks(items, item_col, item_text_col, most_items):
        rows = written(index(docs, block.vocabulary, id_col, text_col), "lexical-index")
        n, total, size = rows.agg(F.sum("_n"), F.sum("_total"), F.sum("_bytes")).head()
        if not n:
            continue
        counts = rows.select(F.explode(F.arrays_zip("_terms", "_dfs")).alias("x")).groupBy("x._terms").agg(F.sum("x._dfs").alias("df"))
        df = np.zeros(len(block.vocabulary), np.int64)
        for term, count in counts.collect():  # the block's terms
            df[term] = count
        from pyspark.sql.pandas.types import to_arrow_type

        tasks = max(spark.sparkContext.defaultParallelism, parts(size, TASK_BYTES))
        scored = rows.coalesce(tasks).mapInArrow(_scorer(block, df, n, total, k, to_arrow_type(kind), limit), schema)
        order = Window.partitionBy("_query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found.append(best.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"))
    if not found:
        empty = spark.createDataFrame([], schema).withColumn("rank", F.lit(0))
        return empty.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
