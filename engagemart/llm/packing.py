"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Documents become pieces (only longer ones are cut). Pieces are dealt at random into parts
of bounded size, and each part is packed on its own: longest first, each into the open
sequence with the least room that still fits, found in a segment tree over room. Loose
sequences of all parts are opened again and packed together in fewer parts, so little
is lost by packing in parts.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import counted, hand_back, id_and_text, new_path, parts, small_batches, with_keys, without_keys
from engagemart.llm.words import text_slices

CAPACITY, END_ID = 4096, 1
#: Pieces packed by one task; words, and parts of words, whose ids a worker keeps at hand.
PART_PIECES, KEPT_WORDS = 8_000, 500_000
#: Sequences with more than this part of their room left are packed again.
LOOSE = 0.01


#: What the tokenizer's own split finds in lower-cased words of Latin-1 characters.
_LETTERS, _DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+")
_PLAIN = re.compile("[!-~¡-ÿ]+")


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in shown]
    return [chr(byte) if byte in shown else chr(256 + others.index(byte)) for byte in range(256)]


class _WordIds:
    """Ids of words as little-endian bytes.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its
    words one after the other; each word is encoded once per worker. Words of Latin-1
    characters only, which normalising leaves alone but for case, are split here and go to the
    vocabulary's merges part by part; others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model, self._letters = self._tokenizer.model, _byte_letters()
        self._words: dict[bytes, bytes] = {}
        self._parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self._parts.get(part)
        if found is None:
            shown = part if part.isascii() else "".join([self._letters[byte] for byte in part.encode()])
            ids = [token.id for token in self._model.tokenize(shown)]
            found = self._parts[part] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([self._part(part) for part in _PARTS.findall(text.lower())])
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def texts(self, texts: list[str]) -> list[bytes]:
        words, ids = [text.encode().split() for text in texts], self._words
        for kept in (ids, self._parts):
            if len(kept) > KEPT_WORDS:
                kept.clear()
        for word in set().union(*words).difference(ids):
            ids[word] = self._word(word)
        return [b"".join([ids[word] for word in row]) for row in words]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """(_id, piece, start, length, ids_crc32[, ids]) of every document, its end id included."""
    given = id_and_text(docs, id_col, text_col)
    names = ["_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end, width = np.array([END_ID], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        words = _WordIds(tokenizer)
        for batch in batches:
            for first, last, _, _ in text_slices(batch.column("_text")):
                part = batch.slice(first, last - first)
                rows: list[list] = [[] for _ in names]
                for name, ids in zip(part.column("_id").to_pylist(), words.texts(part.column("_text").to_pylist()), strict=True):
                    ids += end
                    for number, start in enumerate(range(0, len(ids), width)):
                        cut = ids[start : start + width]
                        values = [name, number, start // 4, len(cut) // 4, zlib.crc32(cut)]
                        for column, value in zip(rows, values, strict=False):
                            column.append(value)
                        if with_ids:
                            rows[-1].append(np.frombuffer(cut, "<u4").astype(np.int32))
                kinds = [part.schema.field("_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(rows, kinds, strict=False)], names
                )

    kind = given.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return given.mapInArrow(run, schema + ", ids array<int>" * with_ids)


class RoomTree:
    """Segment tree over room 0 to ``capacity``: how many open sequences have each amount."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._counts = [0] * (2 * self._leaves)

    def add(self, room: int, change: int) -> None:
        node = room + self._leaves
        while node:
            self._counts[node] += change
            node >>= 1

    def tightest(self, length: int) -> int:
        """The least room of at least ``length`` that is open, or -1."""
        counts, node = self._counts, length + self._leaves
        if counts[node]:
            return length
        while node > 1:  # up to the first right-hand neighbour that holds anything, then down its left
            if not node & 1 and counts[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if counts[2 * node] else 2 * node + 1
                return node - self._leaves
            node >>= 1
        return -1


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Sequence and offset of each length (given longest first), and the room each sequence keeps."""
    tree, open_at, room = RoomTree(capacity), {}, []
    chosen, offsets = [], []
    for length in lengths:
        best = tree.tightest(length)
        if best < 0:
            best, sequence = capacity, len(room)
            room.append(capacity)
        else:
            sequence = open_at[best].pop()
            tree.add(best, -1)
        chosen.append(sequence)
        offsets.append(capacity - best)
        room[sequence] = best - length
        open_at.setdefault(best - length, []).append(sequence)
        tree.add(best - length, 1)
    return chosen, offsets, room


def _packer(capacity: int, level: int, last: bool):
    """Packs one part; the pieces of loose sequences are marked unless this is the last level."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        hand_back()
        frame = frame.sort_values(["length", "_id", "piece"], ascending=[False, True, True], kind="stable")
        chosen, offsets, room = best_fit(frame["length"].tolist(), capacity)
        loose = np.array(room, np.int64)[chosen] > capacity * LOOSE
        names = (level << 56) + (int(frame["_part"].iloc[0]) << 28) + np.array(chosen, np.int64)
        return frame.drop(columns="_part").assign(sequence_id=names, offset=offsets, loose=loose & (not last))

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """``cut`` (from ``pieces``) with sequence_id and offset. Same input, same result."""
    spark, rows = cut.sparkSession, cut.count()
    given = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in cut.schema)
    schema = given + ", sequence_id bigint, offset bigint, loose boolean"
    done, level = [], 0
    while True:
        dealt = parts(rows, part_pieces)
        last = dealt == 1 or level == 3

        key = F.pmod(F.xxhash64(F.lit(level), "_id", "piece"), F.lit(dealt))
        packed = cut.withColumn("_part", key).groupBy("_part").applyInPandas(_packer(capacity, level, last), schema)
        path = new_path(spark, "packed")
        packed.write.partitionBy("loose").parquet(path)
        result = spark.read.schema(packed.schema).parquet(path)
        done.append(result.filter("not loose").drop("loose"))
        again = result.filter("loose").drop("loose", "sequence_id", "offset")
        left = 0 if last else again.count()
        if not left:
            break
        cut, rows, level = again, left, level + 1
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    part_pieces: int = PART_PIECES,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids are its text's (NULL: none) and the end id, so every document has at
    least one piece. Only documents longer than ``capacity`` are cut. Repeated rows are packed
    each on its own.
    """
    small_batches(docs.sparkSession)
    named, (docs, last) = docs, with_keys(docs, id_col)
    cut, _ = counted(pieces(docs, tokenizer, id_col, text_col, capacity), "pieces")
    return without_keys(pack(cut, capacity, part_pieces).withColumnRenamed("_id", id_col), last, named, id_col)


def sequences(packed: DataFrame, cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from ``pieces`` with ids."""
    ids = cut.select(F.col("_id").alias(id_col), "piece", "ids")
    return (
        packed.join(ids, [id_col, "piece"])
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
    )
