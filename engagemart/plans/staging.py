"""Raw documents -> staged rows, one function per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart import constants as K
from engagemart.functions import columns as C


def stage_brand(raw: DataFrame, logical_date: str) -> DataFrame:
    run_time = C.logical_time_text(logical_date)
    return raw.withColumns(
        {
            "user_id": F.col("user_id").cast("string"),
            "name": C.filled_name(F.col("name"), F.col("user_name")),
            "del_yn": F.lit(K.ACTIVE_FLAG),
            "tag_name": C.tag_name(F.col("user_name")),
            "created_at": run_time,
            "updated_at": run_time,
        }
    )


def stage_media(raw: DataFrame, logical_date: str) -> DataFrame:
    run_time = C.logical_time_text(logical_date)
    return _with_source_time(raw).withColumns(
        {"del_yn": F.lit(K.ACTIVE_FLAG), "created_at": run_time, "updated_at": run_time}
    )


def stage_media_hashtag(raw: DataFrame, logical_date: str) -> DataFrame:
    return _with_source_time(raw).withColumn("created_at", C.logical_time_text(logical_date))


def _with_source_time(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnRenamed("timestamp", "ts")
    return renamed.withColumn("ts", C.source_time_text(F.col("ts")))


STAGERS = {
    "brand": stage_brand,
    "media": stage_media,
    "media_hashtag": stage_media_hashtag,
}
