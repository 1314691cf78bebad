"""Small raw tables with every edge the marts have to get right."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from engagemart.schemas import RAW_TABLES

T0 = datetime(2024, 2, 1, 3)
MEDIA_COLUMNS = [
    "media_id", "user_id", "ts", "like_count", "comments_count", "media_type", "media_product_type",
    "created_at", "updated_at",
]
SUNDAY, MONDAY = datetime(2024, 1, 7, 23, 30), datetime(2024, 1, 8, 5)


def _frame(spark: SparkSession, table: str, records: list[dict]) -> DataFrame:
    schema = RAW_TABLES[table]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.fieldNames()) for r in records], schema)


def brand(spark):
    def row(user_id, tag, followers):
        return dict(
            user_id=user_id, user_name=tag, name=tag, tag_name=tag, profile_picture_url=f"u{user_id}",
            followers_count=followers, media_count=3, del_yn="N", created_at=T0, updated_at=T0,
        )

    return _frame(spark, "brand", [row("1", "aa", 100), row("2", "bb", 0), row("3", "cc", 4000), row("4", "dd", 100)])


def media(spark):
    def row(media_id, user_id, likes, comments, kind, ts=SUNDAY):
        return dict(
            media_id=media_id, user_id=user_id, like_count=likes, comments_count=comments, ts=ts,
            media_type="IMAGE", media_product_type=kind, del_yn="N", created_at=T0, updated_at=T0,
        )

    return _frame(
        spark,
        "media",
        [
            row("m1", "1", 10, 5, "FEED"),
            row("m2", "1", 20, 5, "REELS", MONDAY),
            row("m3", "2", 10, 5, "FEED"),
            row("m4", "3", 107, 1, "FEED"),
            row("m5", "9", 10, 5, "FEED"),
            row("m6", "1", 10, 5, "STORY"),
            row("m7", "3", None, 5, "REELS"),
            row("m8", "8", 1, 1, "REELS"),
        ],
    )


def media_hashtag(spark):
    def row(media_id, user_id, caption):
        return dict(media_id=media_id, user_id=user_id, caption=caption, ts=MONDAY, media_type="IMAGE", created_at=T0)

    return _frame(
        spark,
        "media_hashtag",
        [
            row("h1", "1", "x ##a#b # c#d\n#e, #Ä"),
            row("h1", "1", "again #a"),
            row("h2", "2", None),
            row("h3", "9", "#a"),
            row("h4", "3", "nohash"),
            row("h5", "3", "#b"),
        ],
    )


def brand_log(spark):
    rows = [("1", 90), ("1", 100), ("9", 5)]
    return _frame(
        spark, "brand_log", [dict(user_id=u, followers_count=f, created_at=T0) for u, f in rows]
    )


def tables(spark) -> dict[str, DataFrame]:
    return {f.__name__: f(spark) for f in (brand, media, media_hashtag, brand_log)}
