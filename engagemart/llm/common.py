"""Helpers shared by the training-data operators.

Operators read the id and text columns under private names, so further columns of the
input, whatever they are called, never clash with working columns.
"""

from __future__ import annotations

import ctypes
from functools import reduce
from math import ceil
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagemart.scratch import materialize, new_path

#: Largest estimated size of a side that is broadcast.
BROADCAST_BYTES = 32 * 1024**2
#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: Bytes of a batch that goes to a Python worker, unless one row is longer.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, as ``_id`` and ``_text`` (never NULL)."""
    return docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))


def with_keys(docs: DataFrame, id_col: str) -> tuple[DataFrame, int | None]:
    """``docs`` whose rows without an id have keys above all ids instead, each its own, and the largest id.

    The number is None, and ``docs`` as given, if all rows have ids. Otherwise ids turn into bigint; rows without
    one are written once, so their keys hold still, and come after all others.
    """
    found = docs.agg(F.max(docs[id_col]), F.count_if(docs[id_col].isNull())).head()
    if not found[1]:
        return docs, None
    last = -1 if found[0] is None else int(found[0])
    key = F.lit(last + 1).cast("bigint") + F.monotonically_increasing_id()
    without = written(docs.filter(docs[id_col].isNull()).withColumn(id_col, key), "without-id")
    return docs.filter(docs[id_col].isNotNull()).withColumn(id_col, F.col(id_col).cast("bigint")).unionByName(without), last


def without_keys(df: DataFrame, last: int | None, like: DataFrame, id_col: str, *more: str) -> DataFrame:
    """``df`` with ids of the type in ``like``; keys from ``with_keys`` in ``id_col`` and ``more`` are NULL again."""
    if last is None:
        return df
    kind = like.schema[id_col].dataType
    return df.withColumns({name: F.when(F.col(name) <= last, F.col(name)).cast(kind) for name in (id_col, *more)})


def text_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int | None, DataFrame | None]:
    """``with_keys`` where, besides, rows that share an id but not the text have ids of their own.

    Of the texts of one id, one keeps it and the others get keys above all ids; equal rows stay equal. The third
    result is (_key, _given) of those keys, or None if each id has one text.
    """
    own = docs.select(docs[id_col].alias("_shared"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("_hash"))
    texts = own.filter("_shared is not null").groupBy("_shared").agg(F.min("_hash").alias("_low"), F.max("_hash").alias("_high"))
    several, count = counted(texts.filter("_low != _high").select("_shared"), "ids-of-several-texts")
    if not count:
        return *with_keys(docs, id_col), None
    columns = docs.columns
    last = int(docs.agg(F.max(docs[id_col])).head()[0])
    same, several = docs[id_col] == F.col("_shared"), small(several, count, 24)
    rows = docs.join(several, same, "left_semi").withColumn("_digest", F.md5(F.coalesce(text_col, F.lit(""))))
    forms = written(rows.select(F.col(id_col).alias("_given"), F.col("_digest").alias("_form")).distinct(), "texts-of-ids")
    first = forms.groupBy("_given").agg(F.min("_form").alias("_form"))
    forms = forms.join(first, ["_given", "_form"], "left_anti")
    forms, count = counted(forms.withColumn("_key", F.lit(last + 1).cast("bigint") + F.monotonically_increasing_id()), "keys-of-texts")
    keyed = rows.join(small(forms, count, 64), (F.col(id_col) == F.col("_given")) & (F.col("_digest") == F.col("_form")), "left")
    keyed = written(keyed.withColumn(id_col, F.coalesce("_key", F.col(id_col).cast("bigint"))).select(*columns), "texts-with-keys")
    others = docs.join(several, same, "left_anti").withColumn(id_col, F.col(id_col).cast("bigint"))
    docs, top = with_keys(others.unionByName(keyed), id_col)
    return docs, last if top is None else top, forms.select("_key", "_given")


def with_names(df: DataFrame, last: int | None, forms: DataFrame | None, like: DataFrame, id_col: str, *more: str) -> DataFrame:
    """``df`` with the ids that ``text_keys`` was given; those of rows without one are NULL."""
    if forms is None:
        return without_keys(df, last, like, id_col, *more)
    kind, columns = like.schema[id_col].dataType, df.columns
    for name in (id_col, *more):
        df = df.join(forms, df[name] == F.col("_key"), "left")
        plain = F.when(F.col(name) <= last, F.col(name))
        df = df.withColumn(name, F.coalesce("_given", plain).cast(kind)).select(*columns)
    return df


def row_keys(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with an id of its own in every row, and the given one in ``_given_id``; ``docs`` as given if it is so already.

    Rows without an id, and all but one of the rows that share one, get keys above all ids. They are written once.
    """
    last, missing = docs.agg(F.max(docs[id_col]), F.count_if(docs[id_col].isNull())).head()
    again = docs.groupBy(docs[id_col].alias("_again")).agg(F.count(F.lit(1)).alias("_rows"))
    again, shared = counted(again.filter("_again is not null and _rows > 1").select("_again"), "shared-ids")
    if not missing and not shared:
        return docs
    docs = docs.withColumn("_given_id", docs[id_col])
    own, others = docs.filter(docs[id_col].isNotNull()), docs.filter(docs[id_col].isNull())
    if shared:
        same, again = F.col("_given_id") == F.col("_again"), small(again, shared, 24)
        others = others.unionByName(own.join(again, same, "left_semi"))
        own = own.join(again, same, "left_anti")
    others = written(others.withColumn("_place", F.monotonically_increasing_id()), "without-own-id")
    first = others.filter("_given_id is not null").groupBy("_given_id").agg(F.min("_place").alias("_first")).select("_first")
    key = F.lit(-1 if last is None else int(last)).cast("bigint") + 1 + F.col("_place")
    others = others.join(first, F.col("_place") == F.col("_first"), "left").withColumn(
        id_col, F.when(F.col("_first").isNotNull(), F.col("_given_id").cast("bigint")).otherwise(key)
    )
    others = written(others.select(*docs.columns), "row-keys")
    return own.withColumn(id_col, F.col(id_col).cast("bigint")).unionByName(others)


def given_ids(df: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``row_keys(docs)`` with the ids and columns of ``docs``."""
    if "_given_id" in df.columns and "_given_id" not in docs.columns:
        df = df.withColumn(id_col, F.col("_given_id"))
    return df.select(*docs.columns)


def small_batches(spark: SparkSession) -> None:
    """Long texts then reach Python workers a few at a time; rows and results stay the same."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def hand_back() -> None:
    """Return what earlier tasks have left in this Python worker, which is kept between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back as a plain scan."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``written`` with the number of rows."""
    result = materialize(df, label)
    return result.frame, result.rows


def parts(rows: int, per_part: int) -> int:
    """Partitions needed so that each holds about ``per_part`` rows."""
    return max(1, ceil(rows / per_part))


def bucket(column: Column, buckets: int) -> Column:
    """Stable pseudo-random bucket of a value."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` of it stay under the checked size."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def salted(rows: DataFrame, columns: list[str], most: int) -> DataFrame:
    """``rows`` with ``_salt``, which spreads groups of more than ``most`` rows that agree in ``columns``; else 0.

    ``rows`` is a written table with a row number ``_row``.
    """
    names = {name: f"_many{name}" for name in columns}
    many = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    many, count = counted(many.select(*(F.col(name).alias(other) for name, other in names.items())), "many-rows")
    if not count:
        return rows.withColumn("_salt", F.lit(0).cast("long"))
    same = reduce(and_, (F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()))
    found = rows.join(small(many.withColumn("_many", F.lit(True)), count, 16 * len(columns)), same, "left")
    return found.withColumn("_salt", F.when(F.col("_many"), F.col("_row")).otherwise(0)).drop("_many", *names.values())


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is in ``kept``, all columns unchanged."""
    kept, count = counted(kept.select(kept[id_col].alias("_kept")).distinct(), "kept")
    return docs.join(small(kept, count, 24), docs[id_col] == F.col("_kept"), "left_semi").select(*docs.columns)
