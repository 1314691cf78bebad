"""Multi-line JSON documents read by many tasks, however large one file is.

A file is cut into byte ranges. Whether a brace counts depends on whether it lies in a string, and that on
all bytes before, so each range is first summarised for both states it may begin in: the state it ends
in and how far it goes up or down in nesting. Combining the summaries in order gives every range its
true state and depth. Each range then cuts the documents that begin in it: elements of an array at the top
level, or top-level values that follow one another. A document that reaches into later ranges brings only
those ranges' bytes up to its end.

The summaries are two numbers per range; documents never pass through the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions that run in tasks travel by value, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a range.
RANGE_BYTES = 8 << 20
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_OPEN, _CLOSE, _COMMA = np.frombuffer(b"[{", np.uint8), np.frombuffer(b"]}", np.uint8), ord(",")
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n")] = True


def _in_string(data: np.ndarray, inside: bool, escaped: bool) -> tuple[np.ndarray, bool, bool]:
    """Which bytes lie in strings (quotes included), if the first byte does or is escaped; and the states after the last."""
    slashes = data == _BACKSLASH
    # an odd run of backslashes escapes the byte after it
    changes = np.flatnonzero(np.diff(np.concatenate([[False], slashes, [False]])))
    begins, ends = changes[::2], changes[1::2]
    odd = (ends - begins + (escaped & (begins == 0))) % 2 == 1
    after = np.zeros(len(data) + 1, bool)
    after[ends[odd]] = True
    if escaped and not (len(begins) and begins[0] == 0):
        after[0] = True
    quotes = (data == _QUOTE) & ~after[:-1]
    states = np.cumsum(quotes) + inside
    return (states % 2 == 1) | quotes, bool((np.count_nonzero(quotes) + inside) % 2), bool(after[-1])


def _steps(data: np.ndarray, inside: bool, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool, bool]:
    """Nesting after each byte, relative to the first, which bytes lie in strings, and the states after the last."""
    strings, inside, escaped = _in_string(data, inside, escaped)
    step = np.isin(data, _OPEN).astype(np.int64) - np.isin(data, _CLOSE)
    step[strings] = 0
    return np.cumsum(step), strings, inside, escaped


_STATES = [(False, False), (True, False), (True, True)]  # outside; in a string; in a string after an escape


def summarise(data: bytes) -> list[tuple[int, int, bool, bool]]:
    """For each state a range may begin in: the state it ends in, its change of nesting, whether its first visible byte
    opens an array and whether it has a visible byte at all."""
    array = np.frombuffer(data, np.uint8)
    found = []
    for inside, escaped in _STATES:
        nesting, strings, inside, escaped = _steps(array, inside, escaped)
        visible = np.flatnonzero(~_BLANK[array])
        opens = bool(len(visible)) and array[visible[0]] == ord("[")
        end = _STATES.index((inside, escaped)) if inside else 0
        found.append((end, int(nesting[-1]) if len(nesting) else 0, bool(opens), bool(len(visible))))
    return found


def combine(ranges: list[list[tuple[int, int, bool, bool]]]) -> list[tuple[int, int, bool]]:
    """Each range's true state, nesting at its first byte, and whether the file's first visible byte opens an array."""
    state, nesting, array, seen, found = 0, 0, False, False, []
    for summary in ranges:
        if not seen and summary[state][3]:
            array, seen = summary[state][2], True
        found.append((state, nesting))
        state, nesting = summary[state][0], nesting + summary[state][1]
    return [(state, nesting, array) for state, nesting in found]


def cuts(data: bytes, state: int, nesting: int, array: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where documents begin in a range, and where its bytes end one (the place after the last byte).

    In an array a document is what lies between brackets and commas at depth one; otherwise it is a value
    at depth zero.
    """
    values = np.frombuffer(data, np.uint8)
    after, strings, _, _ = _steps(values, *_STATES[state])
    after = after + nesting
    before = np.concatenate([[nesting], after[:-1]]) if len(values) else after
    level = 1 if array else 0
    if array:
        # what ends a document, and makes room for the next: a comma at depth one, or the closing bracket
        stops = ~strings & (before == 1) & ((values == _COMMA) | ((values == ord("]")) & (after == 0)))
        ends = np.flatnonzero(stops)
        rooms = np.concatenate([ends[values[ends] == _COMMA], np.flatnonzero(~strings & (after == 1) & (before == 0))]) + 1
        return np.sort(rooms), ends
    opens = ~strings & (before == level) & (after == level + 1)
    closes = ~strings & (before == level + 1) & (after == level)
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def _ranges(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """(path, number) of every range of every file, from file sizes only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    numbers = F.sequence(F.lit(0), F.floor((F.greatest("length", F.lit(1)) - 1) / range_bytes).cast("int"))
    return files.select("path", F.explode(numbers).alias("number"))


def _read(path: str, start: int, size: int) -> bytes:
    from pyarrow import fs

    # Spark writes local paths as file:/x
    store, name = fs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and path[6:7] != "/" else path)
    with store.open_input_file(name) as file:
        return file.read_at(size, start)


def json_documents(
    spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, partitions: int | None = None
) -> DataFrame:
    """(path, document) of the JSON documents below ``path``: elements of each file's array, or its top-level objects.

    Texts are cut out unchanged; files are read by as many tasks as they have ranges. Files must be UTF-8
    without a byte-order mark. Blank files hold no documents.
    """
    ranges = _ranges(spark, path, range_bytes)
    tasks = partitions or 4 * spark.sparkContext.defaultParallelism

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, number in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found = summarise(_read(name, number * range_bytes, range_bytes))
                columns = [[name], [number], *[[[s[k] for s in found]] for k in range(4)]]
                yield pa.RecordBatch.from_pydict(dict(zip(_SUMMARY.names, columns, strict=True)), _SUMMARY)

    schema = "path string, number int, ends array<int>, steps array<bigint>, opens array<boolean>, seen array<boolean>"
    dealt = ranges.repartition(tasks, "path", "number")
    summary = dealt.mapInArrow(summaries, schema)

    # one small row per range; a file's are combined in order
    def starts(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        rows = table.to_pylist()
        states = combine([list(zip(r["ends"], r["steps"], r["opens"], r["seen"], strict=True)) for r in rows])
        return pa.table(
            {
                "path": [r["path"] for r in rows],
                "number": [r["number"] for r in rows],
                "state": [s[0] for s in states],
                "nesting": [s[1] for s in states],
                "array": [s[2] for s in states],
                "last": [rows[-1]["number"]] * len(rows),
            },
            _START,
        )

    known = summary.groupBy("path").applyInArrow(
        starts, "path string, number int, state int, nesting bigint, array boolean, last int"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = list(_documents_of(row, range_bytes))
                yield pa.RecordBatch.from_pydict({"path": [row["path"]] * len(texts), "document": texts}, _DOCUMENT)

    spread = known.repartition(tasks, "path", "number")
    return spread.mapInArrow(documents, "path string, document string")


def _documents_of(row: dict, range_bytes: int) -> Iterator[str]:
    """Texts of the documents that begin in a range. The last may reach into later ranges, which are read up to its end."""
    data = _read(row["path"], row["number"] * range_bytes, range_bytes)
    begins, ends = cuts(data, row["state"], row["nesting"], row["array"])
    if not len(begins):
        return
    # what ends before the first beginning belongs to a document of an earlier range
    ends = ends[np.searchsorted(ends, begins[0], "left" if row["array"] else "right") :]
    for begin, end in zip(begins, ends, strict=False):
        text = data[begin:end].strip()
        if text:
            yield text.decode()
    if len(ends) >= len(begins):
        return
    pieces, state, nesting = [data[begins[-1] :]], row["state"], row["nesting"]
    summary = summarise(data)[state]
    for number in range(row["number"] + 1, row["last"] + 1):
        state, nesting = summary[0], nesting + summary[1]
        data = _read(row["path"], number * range_bytes, range_bytes)
        _, ends = cuts(data, state, nesting, row["array"])
        if len(ends):
            pieces.append(data[: ends[0]])
            break
        pieces.append(data)
        summary = summarise(data)[state]
    text = b"".join(pieces).strip()
    if text:
        yield text.decode()


_SUMMARY = pa.schema(
    [("path", pa.string()), ("number", pa.int32()), ("ends", pa.list_(pa.int32())), ("steps", pa.list_(pa.int64())),
     ("opens", pa.list_(pa.bool_())), ("seen", pa.list_(pa.bool_()))]
)
_START = pa.schema(
    [("path", pa.string()), ("number", pa.int32()), ("state", pa.int32()), ("nesting", pa.int64()),
     ("array", pa.bool_()), ("last", pa.int32())]
)
_DOCUMENT = pa.schema([("path", pa.string()), ("document", pa.string())])


def read_documents(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fields of the documents below ``path``, as Spark's multi-line reader gives them, by many tasks per file."""
    documents = json_documents(spark, path, range_bytes)
    return documents.select(F.from_json("document", schema).alias("_fields")).select("_fields.*")
