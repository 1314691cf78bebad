"""Hourly raw slices: addressing, reading, inventory and copying."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.sources.json_arrays import read_documents

DEFAULT_PATTERN = "%Y-%m-%d_%H"


class EmptySliceError(Exception):
    """The slice directory is missing or holds no files."""


def slice_name(table: str, logical_time: datetime, pattern: str = DEFAULT_PATTERN) -> str:
    """``{table}_{date}/{table}_{hour}`` relative to the raw folder."""
    return f"{table}_{logical_time:%Y-%m-%d}/{table}_{logical_time.strftime(pattern)}"


def read_slice(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, split: bool = False
) -> DataFrame:
    """JSON documents below ``path``, read with a fixed schema.

    Spark's reader gives each multi-line file (one array, or objects one after the other) to one task.
    With ``split`` a file is read by as many tasks as it has ranges; rows then come without file metadata.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    try:
        raw = read_documents(spark, path, schema) if split and multi_line else reader.json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise EmptySliceError(path) from error
        raise
    files = spark.read.format("binaryFile").load(path).select("path")
    if files.isEmpty():
        raise EmptySliceError(path)
    return raw


def decode_json(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Replace a JSON text column by the fields it holds."""
    others = [name for name in df.columns if name != column]
    return df.withColumn("_decoded", F.from_json(column, schema)).select(*others, "_decoded.*")


def slice_inventory(raw: DataFrame, levels: int = 1) -> DataFrame:
    """Rows and files per slice directory (the last ``levels`` directories of the path)."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    directory = F.slice(parts, F.size(parts) - levels, levels)
    return (
        raw.select(
            F.array_join(directory, "/").alias("slice"), F.col("_metadata.file_path").alias("file")
        )
        .groupBy("slice")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))
    )


def copy_slice(
    spark: SparkSession, source: str, target: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Copy a slice as JSON lines; fails on an empty slice. Returns the copy."""
    read_slice(spark, source, schema, multi_line).write.mode("overwrite").json(target)
    return spark.read.schema(schema).json(target)


def write_partitioned(df: DataFrame, path: str, time_column: str, fmt: str = "parquet") -> None:
    """Lay rows out by date and hour, so a slice filter prunes directories.

    Rows of one hour are brought together first, which keeps files few; adaptive
    execution splits hours that are too large for one task.
    """
    time = F.col(time_column)
    hourly = df.withColumns({"ds": F.to_date(time), "hh": F.hour(time)})
    hourly = hourly.hint("rebalance", "ds", "hh")
    hourly.write.mode("overwrite").partitionBy("ds", "hh").format(fmt).save(path)
