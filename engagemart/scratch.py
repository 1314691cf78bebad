"""Shared scratch space for written intermediate results.

A result that is read more than once is written to the folder the cluster names
in ``spark.checkpoint.dir`` and read back, so losing executors never costs more
than the running stage.
"""

from __future__ import annotations

import json
import tempfile
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach; a local one only for local sessions."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="engagemart-")
    return _local_folder.name


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/engagemart/{label}-{uuid4().hex}"


def literal_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few constant rows in one partition, carried in the plan as a single literal."""
    parsed = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(schema))
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame of the given schema."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0, 0, 1, 1).select(*columns)


@dataclass(frozen=True)
class Materialized:
    frame: DataFrame
    rows: int


def materialize(df: DataFrame, label: str) -> Materialized:
    """Write ``df`` once and return it as a plain scan with its row count.

    The count reads file footers only.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    return Materialized(frame, frame.count())
