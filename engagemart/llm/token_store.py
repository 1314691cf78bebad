"""Token ids of a corpus as raw binary shards, with a minimal perfect hash index from document to place.

Layout of a store's folder:

* ``shards/*.ids``: ids as little-endian unsigned numbers (16 bits if the vocabulary allows, else 32) and
  nothing else, documents in ascending order of id, each closed by the end id;
* ``documents``: Parquet, one row per document with its id and place, written through Spark's commit, so
  only files of attempts that counted are named in it;
* ``shards.json``: one entry per shard file with its documents, ids and the ids of all shards before it;
* ``index/*.mph``: one file per part of the keys: a minimal perfect hash and one entry per key with a
  fingerprint of the key, its shard, first id and number of ids.

A key is a document id and, where ids repeat, the how-manieth document of that id it is (from 0). NULL ids
come last and share one such count. A key is found with one hash, one entry and one read, whatever the corpus' size.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.llm.common import hand_back, id_and_text, new_path, parts, small_batches
from engagemart.llm.packing import END_ID
from engagemart.llm.perfect_hash import PerfectHash
from engagemart.llm.word_tokens import WordTokens, vocabulary_size, with_end
from engagemart.llm.words import mix, text_slices
from engagemart.scratch import literal_rows

#: Text bytes that one task encodes (more where there would be over MOST_TASKS tasks), ids of a shard file.
TASK_BYTES, MOST_TASKS, SHARD_IDS = 32 << 20, 20_000, 1 << 28
#: Keys of one index part; bytes of text encoded, and of ids read, at a time.
PART_KEYS, SLICE_BYTES, READ_BYTES = 1 << 15, 8 << 20, 8 << 20
_ENTRY = np.dtype([("print", "<u4"), ("shard", "<i4"), ("start", "<u8"), ("n", "<u4")])
_SEED = 42  # of Spark's xxhash64
_DOCUMENTS = "_id bigint, _run bigint, _place bigint, _start bigint, _n bigint, _file string, _task int, _part int"
_SHARDS = "shard int, _file string, _first bigint, _carry bigint, base bigint, docs bigint, ids bigint"
_PLACES = "_id bigint, ordinal bigint, shard int, start bigint, n_tokens bigint"


def _hash(values: tuple[int | None, ...]) -> int:
    """Spark's xxhash64 of bigint columns, unsigned."""
    seed = _SEED
    for value in values:
        seed = seed if value is None else xxhash.xxh64_intdigest(struct.pack("<q", value), seed)
    return seed


def _with_hashes(keys: DataFrame, index_parts: int) -> DataFrame:
    first, second = F.xxhash64("_id", "ordinal"), F.xxhash64("ordinal", "_id")
    return keys.withColumns({"_h1": first, "_h2": second, "_part": F.pmod(first, F.lit(index_parts)).cast("int")})


def _prints(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(first ^ mix(~second)) >> np.uint64(32)).astype(np.uint32)


def _unsigned(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def _write_file(store: fs.FileSystem, path: str, data: bytes) -> None:
    """The whole file or nothing of it, also if attempts race."""
    beside = f"{path}.{uuid4().hex}"
    with store.open_output_stream(beside) as out:
        out.write(data)
    store.move(beside, path)


class _IndexPart:
    """One index file: the hash of its keys and their entries."""

    def __init__(self, data: bytes):
        self._numbers, place = PerfectHash.from_bytes(data)
        self._entries = np.frombuffer(data, _ENTRY, self._numbers.size, place)

    @staticmethod
    def make(first: np.ndarray, second: np.ndarray, shard: np.ndarray, start: np.ndarray, n: np.ndarray) -> bytes:
        numbers = PerfectHash.build(first, second)
        entries = np.zeros(len(first), _ENTRY)
        at = numbers(first, second)
        for name, values in (("print", _prints(first, second)), ("shard", shard), ("start", start), ("n", n)):
            entries[name][at] = values
        return numbers.to_bytes() + entries.tobytes()

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The keys' entries; shard -1 for keys that are not in the store."""
        at = self._numbers(first, second)
        found = np.zeros(len(at), _ENTRY)
        found["shard"] = -1
        met = np.flatnonzero(at >= 0)
        met = met[self._entries["print"][at[met]] == _prints(first, second)[met]]
        found[met] = self._entries[at[met]]
        return found


def _encoder(tokenizer: str, folder: str, kind: str, shard_ids: int, end_id: int):
    """Writes one task's documents, which come in order, to shard files; one row out per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        words, store, out = None, None, None
        task, part, place, start, last, run_ = TaskContext.get().partitionId(), -1, 0, 0, (), 0
        try:
            for batch in batches:
                if words is None:
                    words, (store, root) = WordTokens(tokenizer), fs.FileSystem.from_uri(folder)
                    store.create_dir(f"{root}/shards", recursive=True)
                for first, past, data, offsets in text_slices(batch.column("_text"), SLICE_BYTES):
                    ids, bounds = with_end(*words.encode(data, offsets), end_id)
                    if out is None or start + len(ids) > shard_ids and start:
                        if out is not None:
                            out.close()
                        part, place, start, last = part + 1, 0, 0, ()
                        file = f"{task:06d}-{part:04d}-{uuid4().hex}.ids"
                        out = store.open_output_stream(f"{root}/shards/{file}")
                    out.write(ids.astype(kind).tobytes())
                    rows, runs = past - first, []
                    names = batch.column("_id").slice(first, rows).to_pylist()
                    for name in names:
                        run_ = run_ + 1 if last == (name,) else 0
                        last = (name,)
                        runs.append(run_)
                    columns = [
                        pa.array(names, pa.int64()), pa.array(runs, pa.int64()), pa.array(place + np.arange(rows)),
                        pa.array(start + bounds[:-1]), pa.array(np.diff(bounds)), pa.array([file] * rows),
                        pa.array(np.full(rows, task, np.int32)), pa.array(np.full(rows, part, np.int32)),
                    ]
                    place, start = place + rows, start + len(ids)
                    yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _DOCUMENTS.split(", ")])
        finally:
            if out is not None:
                out.close()

    return run


def _shards(documents: DataFrame) -> list[dict]:
    """One entry per shard file, in order, with the ids before it and the documents before it of its first id."""
    grouped = documents.groupBy("_task", "_part", "_file").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum("_n").alias("ids"),
        F.min_by(F.struct("_id"), "_place")["_id"].alias("first"),
        F.max_by(F.struct("_id", "_run"), "_place").alias("last"),
    )
    found, base, carry, before = [], 0, 0, ()
    for number, row in enumerate(sorted(grouped.collect(), key=lambda r: (r["_task"], r["_part"]))):
        carry = carry if before == (row["first"],) else 0
        found.append({"shard": number, "_file": row["_file"], "_first": row["first"], "_carry": carry,
                      "base": base, "docs": row["docs"], "ids": row["ids"]})
        base, before = base + row["ids"], (row["last"]["_id"],)
        carry = row["last"]["_run"] + 1 + (carry if row["first"] == row["last"]["_id"] else 0)
    return found


class TokenStore:
    """A written store; see the module's text for what it holds."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._format = json.loads(_read_file(folder, "shards.json"))
        self._index_parts, self._kind = self._format["index_parts"], self._format["kind"]

    def shards(self) -> DataFrame:
        """One row per shard file: shard, docs, ids, and base, the ids of all shards before it."""
        return literal_rows(self.spark, self._format["shards"], T.StructType.fromDDL(_SHARDS))

    def _documents(self) -> DataFrame:
        own = self.spark.read.schema(_DOCUMENTS).parquet(f"{self.folder}/documents")
        carry = F.when(F.col("_id").eqNullSafe(F.col("_first")), F.col("_carry")).otherwise(0)
        # as many rows as shard files of half a gigabyte
        return own.join(F.broadcast(self.shards()), "_file").withColumn("ordinal", F.col("_run") + carry)

    def keys(self) -> DataFrame:
        """(_id, ordinal) of every document."""
        return self._documents().select("_id", "ordinal")

    def locate(self, keys: DataFrame) -> DataFrame:
        """(_id, ordinal, shard, start, n_tokens) of the keys by the index; shard is NULL for keys not in the store.

        ``start`` counts from the shard's first id. Keys go to the index part their hash names, so a task
        opens a part once and probes it for all its keys.
        """
        folder, parted = self.folder, _with_hashes(keys.select("_id", "ordinal"), self._index_parts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened, index = -1, None
            for batch in batches:
                numbers = batch.column("_part").to_numpy()
                cuts = np.flatnonzero(np.diff(numbers)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                    if a == b:
                        continue
                    if numbers[a] != opened:
                        opened, index = numbers[a], _IndexPart(_read_file(folder, f"index/{numbers[a]:07d}.mph"))
                    rows = batch.slice(a, b - a)
                    found = index.find(_unsigned(rows.column("_h1")), _unsigned(rows.column("_h2")))
                    lost = found["shard"] < 0
                    more = [
                        pa.array(found["shard"], mask=lost),
                        pa.array(found["start"].astype(np.int64), mask=lost),
                        pa.array(found["n"].astype(np.int64), mask=lost),
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("_id"), rows.column("ordinal"), *more], [x.split()[0] for x in _PLACES.split(", ")]
                    )

        return parted.repartition("_part").sortWithinPartitions("_part").mapInArrow(run, _PLACES)

    def payloads(self, located: DataFrame, with_ids: bool = True) -> DataFrame:
        """(_id, ordinal, start, n_tokens, ids_crc32[, ids]) of located documents, read from the shard files.

        ``start`` counts from the store's first id. Keys go to their shard's task in the order they lie there, and
        documents next to each other are read together, a few megabytes at a time.
        """
        folder, kind = self.folder, self._kind
        schema = "_id bigint, ordinal bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
        placed = located.join(F.broadcast(self.shards().select("shard", "_file", "base")), "shard")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = fs.FileSystem.from_uri(folder)
            name, file, width = None, None, np.dtype(kind).itemsize
            for batch in batches:
                files, start, n = batch.column("_file").to_pylist(), batch.column("start").to_numpy(), batch.column("n_tokens").to_numpy()
                first = 0
                while first < len(files):
                    past = first + 1  # as many neighbours as fit one read
                    while (
                        past < len(files)
                        and files[past] == files[first]
                        and start[past] == start[past - 1] + n[past - 1]
                        and (start[past] + n[past] - start[first]) * width <= READ_BYTES
                    ):
                        past += 1
                    if files[first] != name:
                        if file is not None:
                            file.close()
                        name = files[first]
                        file = store.open_input_file(f"{root}/shards/{name}")
                    count = int(start[past - 1] + n[past - 1] - start[first])
                    raw = file.read_at(count * width, int(start[first]) * width)
                    ids = np.frombuffer(raw, kind).astype("<u4")
                    if len(ids) != count:
                        raise ValueError(f"{name} is cut short")
                    cuts = np.concatenate([start[first:past] - start[first], [count]])
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    rows = batch.slice(first, past - first)
                    columns = [rows.column("_id"), rows.column("ordinal"), pa.array(rows.column("base").to_numpy() + start[first:past]),
                               rows.column("n_tokens"), pa.array(sums, pa.int64())]
                    names = ["_id", "ordinal", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                    first = past
            if file is not None:
                file.close()

        return placed.repartition("shard").sortWithinPartitions("shard", "start").mapInArrow(run, schema)

    def get(self, key: int | None, ordinal: int = 0) -> np.ndarray | None:
        """Ids of one document without Spark; None if the store has no such key."""
        first, second = (np.array([_hash(x)], np.uint64) for x in ((key, ordinal), (ordinal, key)))
        signed = int(first.view(np.int64)[0])
        part = signed % self._index_parts
        entry = _IndexPart(_read_file(self.folder, f"index/{part:07d}.mph")).find(first, second)[0]
        if entry["shard"] < 0:
            return None
        store, root = fs.FileSystem.from_uri(self.folder)
        width = np.dtype(self._kind).itemsize
        with store.open_input_file(f"{root}/shards/{self._format['shards'][entry['shard']]['_file']}") as file:
            return np.frombuffer(file.read_at(int(entry["n"]) * width, int(entry["start"]) * width), self._kind)


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def _read_file(folder: str, name: str) -> bytes:
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/{name}") as file:
        return file.read()


def write_store(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    task_bytes: int = TASK_BYTES,
    shard_ids: int = SHARD_IDS,
    part_keys: int = PART_KEYS,
) -> TokenStore:
    """Encode every whole text (NULL: empty), add ``end_id`` and write a store to ``folder`` (NULL: scratch space).

    Ids must be whole numbers. Documents lie in ascending order of id; rows that share an id lie together in no
    stated order but that equal texts are next to each other; rows without an id come last. Texts move once, to
    the task that writes their range of ids; an id held by very many rows is cut into ranges by text and by row.
    An empty table gives a store without shards. Other columns do not matter.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = _uri((folder or new_path(spark, "token-store")).rstrip("/"))
    given = id_and_text(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("bigint"))
    size = given.agg(F.sum(F.octet_length("_text"))).head()[0] or 0
    tasks = min(MOST_TASKS, parts(size, task_bytes))
    order = [F.col("_id").asc_nulls_last(), F.xxhash64("_text"), F.monotonically_increasing_id()]
    ordered = given.select("_id", "_text", order[1].alias("_tie"), order[2].alias("_row"))
    order = [order[0], F.col("_tie"), F.col("_row")]
    ordered = ordered.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("_id", "_text")
    kind = "<u2" if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else "<u4"
    documents = f"{folder}/documents"
    ordered.mapInArrow(_encoder(tokenizer, folder, kind, shard_ids, end_id), _DOCUMENTS).write.parquet(documents)

    shards = _shards(spark.read.schema(_DOCUMENTS).parquet(documents))
    index_parts = max(1, ceil(sum(shard["docs"] for shard in shards) / part_keys))
    store, root = fs.FileSystem.from_uri(folder)
    for name in ("shards", "index"):
        store.create_dir(f"{root}/{name}", recursive=True)
    content = {"kind": kind, "end_id": end_id, "index_parts": index_parts, "shards": shards}
    _write_file(store, f"{root}/shards.json", json.dumps(content).encode())

    written = TokenStore(spark, folder)

    def build(table: pa.Table) -> pa.Table:
        own, path = fs.FileSystem.from_uri(folder)
        number = table.column("_part")[0].as_py()
        table = table.filter(pc.is_valid(table.column("shard")))
        column = {name: table.column(name).combine_chunks() for name in table.column_names}
        data = _IndexPart.make(
            _unsigned(column["_h1"]), _unsigned(column["_h2"]),
            *[column[name].to_numpy() for name in ("shard", "_start", "_n")],
        )
        _write_file(own, f"{path}/index/{number:07d}.mph", data)
        return pa.table({"part": [number], "keys": [table.num_rows]}, pa.schema([("part", pa.int32()), ("keys", pa.int64())]))

    # a part holds about part_keys keys, whichever ids there are: keys are distinct and dealt by hash;
    # a row without a place stands for every part, so parts that no key meets have a file too
    keyed = _with_hashes(written._documents(), index_parts).select("_part", "_h1", "_h2", "shard", "_start", "_n")
    every = spark.range(index_parts).select(F.col("id").cast("int").alias("_part"))
    keys = keyed.unionByName(every, allowMissingColumns=True).groupBy("_part").applyInArrow(build, "part int, keys bigint").agg(F.sum("keys")).head()[0]
    if keys != sum(shard["docs"] for shard in shards):
        raise RuntimeError("the index lacks keys")
    return written


def roundtrip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from a store just written, each key found through the index.

    ``start`` counts the ids of all documents before; ``n_tokens`` includes the end id; ids_crc32 is taken over
    unsigned 32-bit little-endian ids. NULL ids stay NULL. One row per row of ``docs``.
    """
    store = write_store(docs, tokenizer, None, id_col, text_col, **sizes)
    found = store.payloads(store.locate(store.keys()), with_ids=False)
    return found.select(F.col("_id").cast(docs.schema[id_col].dataType).alias(id_col), "start", "n_tokens", "ids_crc32")
