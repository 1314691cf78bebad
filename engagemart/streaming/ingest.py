"""Incremental ingestion: every raw slice that has arrived since the last run.

A file stream keeps track of what was read. A micro-batch may hold many slices (folders);
they are staged, checked and loaded one after the other, oldest first, each under its own hour.
A slice is known by the stream's id, the batch number and its folder, so a batch that is
retried replaces itself, and a stream started afresh never touches what another one loaded.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from engagemart.plans.etl import document_schema, load_slice
from engagemart.scratch import new_path
from engagemart.sinks.loads import RawStore
from engagemart.sinks.tables import STAGING_FORMAT
from engagemart.sources.slices import DEFAULT_PATTERN

_FOLDER, _KEY = "_slice_folder", "_slice_key"
# Set by Spark for the jobs of a streaming query; survives restarts from its checkpoint.
_STREAM_ID = "sql.streaming.queryId"


def slice_time(folder: str, default: str) -> str:
    """The hour a slice folder is named after, as ISO text; ``default`` if its name has none."""
    found = re.search(r"\d{4}-\d{2}-\d{2}_\d{2}$", folder)
    if not found:
        return default
    return datetime.strptime(found[0], DEFAULT_PATTERN).replace(tzinfo=timezone.utc).isoformat()


def ingest_available(
    store: RawStore,
    entity: str,
    raw_path: str,
    stage_root: str,
    checkpoint: str,
    logical_date: str,
    contract: Sequence[Row] | None = None,
    multi_line: bool = True,
    files_per_batch: int | None = None,
    fmt: str = STAGING_FORMAT,
) -> StreamingQuery:
    """Load all new files below ``raw_path`` (globs allowed), then stop.

    Slices whose folder ends in ``YYYY-MM-DD_HH`` are loaded with that hour, others with
    ``logical_date``. A failed check stops before its slice is loaded; that slice and the
    later ones stay pending.
    """
    reader = (
        store.spark.readStream.schema(document_schema(entity, contract))
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", "true")
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load_batch(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        stream_id = spark.sparkContext.getLocalProperty(_STREAM_ID)
        # Raw files are parsed once; each slice then reads its own folder of the copy.
        path = new_path(spark, f"ingest-{entity}")
        raw.withColumn(_KEY, F.xxhash64(_FOLDER)).write.partitionBy(_KEY).parquet(path)
        schema = raw.schema.add(_KEY, "long")
        copy = spark.read.schema(schema).parquet(path)
        # one row per pending folder
        pending = [(row[_FOLDER].rsplit("/", 1)[-1], *row) for row in copy.select(_FOLDER, _KEY).distinct().collect()]
        for name, folder, key in sorted(pending, key=lambda row: (slice_time(row[0], logical_date), row)):
            documents = copy.where((F.col(_KEY) == key) & (F.col(_FOLDER) == folder)).drop(_FOLDER, _KEY)
            slice_id = f"{stream_id}-{batch_id:09d}-{name}-{key & 0xFFFFFFFFFFFFFFFF:016x}"
            stage_path = f"{stage_root}/{slice_id}"
            load_slice(
                store, entity, documents, stage_path, slice_time(name, logical_date), slice_id, contract, fmt
            )

    query = (
        reader.json(raw_path)
        .withColumn(_FOLDER, F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
