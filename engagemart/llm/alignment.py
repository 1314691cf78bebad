"""Alignment of two tokenizers over a corpus, in Arrow.

Every slice of texts becomes two list columns of ids. Their flattened lists, parent indices and segmented
cumulative sums of token bytes give each token's end within its document; a hash join on (document, end)
finds the ends both tokenizers share, which are the links and cut both token rows into groups. Links are
counted by id pair with ``Table.group_by`` in each task and merged by Spark; a second pass over the written
links joins the counts back.

What is sent to every task is bounded by the vocabularies, not by the corpus: of two tokens that end
together one is a suffix of the other, so there are at most as many id pairs as tokens have suffixes in
the other vocabulary (``pair_bound``), which is checked.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import hand_back, new_path, small_batches
from engagemart.llm.packing import _byte_letters
from engagemart.llm.words import text_slices

#: Bytes of text aligned at a time.
SLICE_BYTES = 1 << 20
#: Fixed value: how byte-level vocabularies of this family split text before merging.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Scripts whose letters, digits and blanks all libraries class alike; texts with others go through the slower one.
_SETTLED = re.compile("[\0-ԯ‐-‧€]*")
_NAMES = ["_id", "n_a", "n_b", "n_groups", "groups_sha256", "links_a", "links_b", "a", "b", "n", "counts"]
_SCHEMA = (
    "_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links_a array<int>, links_b array<int>, "
    "a int, b int, n bigint, counts boolean"
)


class ByteTokens:
    """Tokenizer A: a byte-level vocabulary of the tokenizers library. Encodes a space and the text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        byte = {letter: number for number, letter in enumerate(_byte_letters())}
        vocabulary = json.loads(Path(path).read_text())["model"]["vocab"]
        # added tokens may also be listed; none of them is ever encoded from text
        plain = {t: n for t, n in vocabulary.items() if t not in {x.content for x in self._tokenizer.get_added_tokens_decoder().values()}}
        ranks = {bytes([byte[letter] for letter in token]): number for token, number in plain.items()}
        self._encoding = tiktoken.Encoding("bytes", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.bytes[number] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = []
        for text in texts:
            if not text:
                found.append(np.zeros(0, np.uint32))
            elif text.isascii() or _SETTLED.fullmatch(text):
                found.append(self._encoding.encode_to_numpy(" " + text))
            else:
                found.append(np.array(self._tokenizer.encode(" " + text, add_special_tokens=False).ids, np.uint32))
        return found


class PieceTokens:
    """Tokenizer B: a sentencepiece model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(number) for number in range(self._model.get_piece_size())]
        hexed = [re.fullmatch("<0x([0-9A-F]{2})>", piece) for piece in pieces]
        self.bytes = [
            bytes([int(h[1], 16)]) if h else piece.replace("▁", " ").encode() for h, piece in zip(hexed, pieces, strict=True)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        found = iter(self._model.encode([text for text in texts if text], num_threads=1))
        return [np.array(next(found) if text else [], np.uint32) for text in texts]


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """Most (a, b) id pairs of which one token's bytes end with the other's."""
    by_a, by_b = Counter(a), Counter(b)
    longer = sum(by_b[token[k:]] for token in a for k in range(len(token)))  # b is a suffix of a, or equal
    return longer + sum(by_a[token[k:]] for token in b for k in range(1, len(token)))


def _list(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint32), *rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _joined(tokens: pa.Array, lists: pa.ListArray) -> list[memoryview]:
    """Each row's token bytes, one after the other."""
    flat = tokens.take(lists.flatten())
    data, offsets = flat.buffers()[2], np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1)
    ends = offsets[lists.offsets.to_numpy()]
    view = memoryview(data if data else b"").cast("B")  # unsigned, as bytes compare
    return [view[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self._bytes = [pa.array(side.bytes, pa.large_binary()) for side in (self.a, self.b)]
        self._sizes = [pc.cast(pc.binary_length(x), pa.int64()) for x in self._bytes]
        # "id," or, at the end of a group's side, "id|" for A and "id;" for B
        labels = [f"{k}{mark}" for side, end in ((self.a, "|"), (self.b, ";")) for k in range(len(side.bytes)) for mark in (",", end)]
        self._labels = pa.array([label.encode() for label in labels], pa.large_binary())

    def _lists(self, texts: list[str]) -> list[pa.ListArray]:
        """Both sides' ids; none in either for texts that the tokens do not spell."""
        sides = [side.encode(texts) for side in (self.a, self.b)]
        wanted = [b" " + text.encode() if text else b"" for text in texts]
        spelt = [_joined(tokens, _list(rows)) for tokens, rows in zip(self._bytes, sides, strict=True)]
        bad = [row for row, want in enumerate(wanted) if spelt[0][row] != want or spelt[1][row] != want]
        for row in bad:
            sides[0][row] = sides[1][row] = np.zeros(0, np.uint32)
        return [_list(rows) for rows in sides]

    def align(self, texts: list[str]) -> tuple[list[pa.ListArray], pa.Table]:
        """Both sides' ids, and the links in order: document (row), place and id of the A token and of the B token."""
        lists, tables = self._lists(texts), []
        for rows, sizes, side in zip(lists, self._sizes, "ab", strict=True):
            ids, document = pc.list_flatten(rows), pc.list_parent_indices(rows)
            ends = pc.cumulative_sum(sizes.take(ids))
            # segmented: less the bytes of all rows before
            before = pa.array(np.concatenate([[0], ends.to_numpy()])[rows.offsets.to_numpy()[:-1]])
            ends = pc.subtract(ends, before.take(document))
            tables.append(pa.table({"document": document, "end": ends, f"at_{side}": np.arange(len(ids)), side: ids}))
        links = tables[0].join(tables[1], keys=["document", "end"], join_type="inner", use_threads=False)
        return lists, links.sort_by("at_a").combine_chunks()

    def digests(self, lists: list[pa.ListArray], links: pa.Table) -> list[str]:
        """SHA-256 of each row's groups as text, '' for rows without tokens."""
        at = [links.column(f"at_{side}").to_numpy() for side in "ab"]
        counts = [len(rows.flatten()) for rows in lists]
        last = [np.zeros(count, bool) for count in counts]
        group = []
        for side in (0, 1):
            last[side][at[side]] = True
            group.append(np.cumsum(last[side]) - last[side])
        # a group's A tokens follow all tokens of the groups before, its B tokens follow its A tokens
        place_a = np.arange(counts[0]) + np.concatenate([[0], at[1] + 1])[group[0]]
        place_b = np.arange(counts[1]) + (at[0] + 1)[group[1]]
        codes = np.zeros(sum(counts), np.int64)
        codes[place_a] = 2 * lists[0].flatten().to_numpy().astype(np.int64) + last[0]
        codes[place_b] = 2 * (len(self.a.bytes) + lists[1].flatten().to_numpy().astype(np.int64)) + last[1]
        text = self._labels.take(pa.array(codes))
        view = memoryview(text.buffers()[2] if text.buffers()[2] else b"")
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1)
        bounds = offsets[lists[0].offsets.to_numpy().astype(np.int64) + lists[1].offsets.to_numpy()]
        return [hashlib.sha256(view[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def _links(path_a: str, path_b: str):
    """Rows of documents with their links, then, once per task, rows of id pairs with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        aligner, counts = None, None
        for batch in batches:
            aligner = aligner or Aligner(path_a, path_b)
            schema = batch.schema.field("_id")
            for first, past, _, _ in text_slices(batch.column("_text"), SLICE_BYTES):
                texts = batch.column("_text").slice(first, past - first).to_pylist()
                lists, links = aligner.align([text or "" for text in texts])
                own = links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["a", "b", "n"])
                counts = own if counts is None else pa.concat_tables([counts, own])
                if len(counts) > 1 << 20:
                    counts = counts.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])
                rows = len(texts)
                bounds = np.searchsorted(links.column("document").to_numpy(), np.arange(rows + 1)).astype(np.int32)
                found = [
                    pa.ListArray.from_arrays(pa.array(bounds), links.column(side).combine_chunks().cast(pa.int32()))
                    for side in "ab"
                ]
                sizes = [pc.list_value_length(x).cast(pa.int64()) for x in (*lists, found[0])]
                none = [pa.nulls(rows, kind) for kind in (pa.int32(), pa.int32(), pa.int64())]
                columns = [batch.column("_id").slice(first, rows), *sizes, pa.array(aligner.digests(lists, links)), *found]
                yield pa.RecordBatch.from_arrays([*columns, *none, pa.array(np.zeros(rows, bool))], _NAMES)
        if counts is not None and len(counts):
            merged = counts.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
            merged = merged.rename_columns(["a", "b", "n"]).combine_chunks()
            rows = len(merged)
            none = [pa.nulls(rows, k) for k in (schema.type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
            pairs = [merged.column(x).combine_chunks().cast(k) for x, k in (("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*none, *pairs, pa.array(np.ones(rows, bool))], _NAMES)

    return run


def _scorer(counts: pa.Table):
    """Adds to each document the counts of its links and how many of them are their B id's best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(f"links_{side}") for side in "ab"]
            links = pa.table({"row": pc.list_parent_indices(lists[0]), **{s: pc.list_flatten(x) for s, x in zip("ab", lists, strict=True)}})
            links = links.join(counts, keys=["a", "b"], join_type="inner", use_threads=False)
            sums = links.group_by("row", use_threads=False).aggregate([("n", "sum"), ("best", "sum")])
            found = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for values, name in zip(found, ("best_sum", "n_sum"), strict=True):
                values[sums.column("row").to_numpy()] = sums.column(name).to_numpy()
            columns = [batch.column(name) for name in ("_id", "n_a", "n_b", "n_groups")]
            columns += [pc.list_value_length(lists[0]).cast(pa.int64()), *map(pa.array, found), batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with their links, (a, b, n) of all id pairs linked), written once.

    Documents: _id, n_a, n_b, n_groups, groups_sha256, and links_a, links_b, the ids linked, in order. Texts that are
    NULL or empty, or that the tokens of either side do not spell, have no tokens. Each row is a document of its own,
    whatever its id; other columns do not matter; an empty table gives empty ones.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    schema = _SCHEMA.format(kind=given.schema["_id"].dataType.simpleString())
    aligned, path = given.mapInArrow(_links(path_a, path_b), schema), new_path(spark, "aligned")
    aligned.write.partitionBy("counts").parquet(path)
    both = spark.read.schema(aligned.schema).parquet(path)
    pairs = both.filter("counts").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return both.filter("not counts").drop("a", "b", "n", "counts"), pairs


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document, see ``align_documents``.

    ``count_sum`` adds up, over the document's links, how many links of the corpus hold the same pair of ids;
    ``n_best`` counts those links whose pair is the most frequent one of its B id, ties included.
    """
    links, pairs = align_documents(docs, path_a, path_b, id_col, text_col)
    best = pairs.groupBy("b").agg(F.max("n").alias("most"))
    marked = pairs.join(best, "b").select("a", "b", "n", (F.col("n") == F.col("most")).cast("bigint").alias("best"))
    bound = pair_bound(ByteTokens(path_a).bytes, PieceTokens(path_b).bytes)
    counts = marked.limit(bound + 1).toArrow()
    if len(counts) > bound:
        raise RuntimeError("more id pairs than tokens can form")
    schema = links.schema["_id"].dataType.simpleString()
    schema = f"_id {schema}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return links.mapInArrow(_scorer(counts), schema).withColumnRenamed("_id", id_col)
