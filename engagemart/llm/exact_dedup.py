"""Exact deduplication: group by a 128-bit content hash, compare bytes inside groups.

One pass hashes every normalised text; only ids, lengths and hashes are written and shuffled. Groups are formed on
the hash alone. Texts travel only where a hash has two rows or more (or falls on the slot of one that has): there
they are grouped by their bytes, with the
sums that tasks make before the shuffle collapsing most copies, and a hash that turns out to hold several texts is
split by them, so two different texts with one hash never share a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import BLANKS, given_ids, id_and_text, keep_rows, row_keys, with_keys, without_keys, written

_BLANKS = BLANKS.encode()
#: A hash with more than one part in so many of the repeated rows is spread over as many tasks.
HOT_PARTS = 256
#: Slots that hashes of repeated texts mark, and how many of them one row of marks holds: 2,048 rows of 4 KB.
SLOTS, SLOTS_PER_ROW = 1 << 26, 1 << 15


def fingerprints(docs: DataFrame, id_col: str, text_col: str, hash_bytes: int = 16) -> DataFrame:
    """(_id, _chars, _hash, _sha) of every row; ``hash_bytes`` shortens the hash for tests."""
    given = id_and_text(docs, id_col, text_col)
    fields = [("_chars", pa.int64()), ("_hash", pa.binary()), ("_sha", pa.string())]

    def row(text: str) -> tuple:
        norm = text.encode().translate(None, _BLANKS)
        return len(text), hashlib.md5(norm).digest()[:hash_bytes], hashlib.sha256(norm).hexdigest()

    kind = given.schema["_id"].dataType.simpleString()
    return given.mapInArrow(_by_text(row, fields), f"_id {kind}, _chars bigint, _hash binary, _sha string")


def contents(docs: DataFrame, id_col: str, text_col: str, hash_bytes: int = 16) -> DataFrame:
    """(_id, _chars, _hash, _norm) of every row, with the normalised bytes."""
    given = id_and_text(docs, id_col, text_col)
    fields = [("_chars", pa.int64()), ("_hash", pa.binary()), ("_norm", pa.binary())]

    def row(text: str) -> tuple:
        norm = text.encode().translate(None, _BLANKS)
        return len(text), hashlib.md5(norm).digest()[:hash_bytes], norm

    kind = given.schema["_id"].dataType.simpleString()
    return given.mapInArrow(_by_text(row, fields), f"_id {kind}, _chars bigint, _hash binary, _norm binary")


def _by_text(
    row: Callable[[str], tuple], fields: list[tuple[str, pa.DataType]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                rows = [row(text.as_py()) for text in piece.column("_text")]
                columns = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([piece.column("_id"), *columns], ["_id", *(n for n, _ in fields)])

    return run


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bytes: int = 16
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting ASCII blanks; NULL counts as empty, and
    empty texts form one group. The row with the most code points in the original text stays,
    then the smallest id. Rows without an id come after
    all ids; of those alone one stays, and ``keep_id`` is NULL. Rows repeating one id and text share their verdict. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    named, (docs, last) = docs, with_keys(docs, id_col)
    prints = written(fingerprints(docs, id_col, text_col, hash_bytes), "exact-prints")
    # the best row as one number: most code points first, then the smallest id
    best = F.max(F.struct("_chars", (-F.col("_id")).alias("_minus")))
    sizes = [(-F.col("_best._minus")).alias("_keep"), "_size"]
    formed = prints.groupBy("_hash").agg(best.alias("_best"), F.count(F.lit(1)).alias("_size"))
    by_hash = written(formed.select("_hash", *sizes), "exact-groups")
    repeated = written(by_hash.filter("_size > 1").select("_hash", "_size"), "exact-repeated")
    # texts of repeated hashes meet their equals, byte by byte
    texts = contents(docs, id_col, text_col, hash_bytes)
    grouped = _of_hashes(texts, repeated).groupBy("_hash", "_norm").agg(best.alias("_best"), F.count(F.lit(1)).alias("_size"))
    by_text = written(grouped.select("_hash", *sizes), "exact-texts")
    shared = by_text.groupBy("_hash").agg(F.count(F.lit(1)).alias("_texts")).filter("_texts > 1").select("_hash")
    rows = prints.select("_id", "_hash", "_sha")
    if shared.isEmpty():
        joined = rows.join(by_hash, "_hash")
    else:  # several texts under one hash: those rows find their group by its bytes
        shared = written(shared, "exact-shared")
        single = rows.join(shared, "_hash", "left_anti").join(by_hash, "_hash")
        forms = grouped.select("_hash", "_norm", *sizes).join(shared, "_hash", "left_semi")
        several = texts.join(shared, "_hash", "left_semi").join(forms, ["_hash", "_norm"])
        several = several.withColumn("_sha", F.sha2("_norm", 256))
        joined = single.unionByName(several.select(single.columns))
    result = joined.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_id") == F.col("_keep")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return without_keys(result, last, named, id_col, "keep_id")


def _marked(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """The texts whose hash falls on a slot that a hash of ``repeated`` has marked: all of those, few others.

    The marks have a fixed size (``SLOTS`` bits) whatever the input; if most slots are marked, most texts pass.
    """
    slot = F.pmod(F.xxhash64("_hash"), F.lit(SLOTS))
    place = {"_group": F.floor(slot / SLOTS_PER_ROW), "_bit": F.pmod(slot, F.lit(SLOTS_PER_ROW))}
    marks = repeated.withColumns(place).groupBy("_group").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = "cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    set_there = F.expr(f"(shiftright({byte}, cast(_bit % 8 as int)) & 1) = 1")
    columns = texts.columns
    return texts.withColumns(place).join(F.broadcast(marks), "_group").filter(set_there).select(*columns)


def _of_hashes(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """The texts whose hash is in ``repeated``; those of a hash with very many rows meet it in many tasks."""
    rows = repeated.agg(F.sum("_size")).head()[0] or 0
    hot = repeated.filter(F.col("_size") * HOT_PARTS > rows).select("_hash", F.lit(True).alias("_hot"))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_PARTS - 1))).otherwise(F.array(F.lit(0)))
    # fewer than HOT_PARTS hashes can hold more than one part in HOT_PARTS of the rows each
    hot = F.broadcast(hot)
    wanted = repeated.join(hot, "_hash", "left").select("_hash", F.explode(salts).alias("_salt"))
    salt = F.when(F.col("_hot"), F.monotonically_increasing_id() % HOT_PARTS).otherwise(0).cast("int")
    dealt = _marked(texts, repeated).join(hot, "_hash", "left").withColumn("_salt", salt).drop("_hot")
    return dealt.join(wanted, ["_hash", "_salt"], "left_semi")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, also of rows repeating an id and text. All columns unchanged."""
    keyed = row_keys(docs, id_col)
    return given_ids(keep_rows(keyed, exact_groups(keyed, id_col, text_col).filter("kept"), id_col), docs, id_col)
