from pyspark.sql import types as T

from engagemart.plans import staging as S
from engagemart.schemas import RAW_DOCUMENTS

RUN = "2024-02-01T03:00:00+00:00"
STAMP = "2024-02-01 03:00:00"


def test_stage_brand(spark):
    raw = spark.createDataFrame(
        [(1, "maisonexample", "", "u", 10, 2), (2, "b", None, None, None, None)], RAW_DOCUMENTS["brand"]
    )
    staged = S.stage_brand(raw, RUN)
    assert staged.schema["user_id"].dataType == T.StringType()
    assert [r.asDict() for r in staged.collect()] == [
        dict(user_id="1", user_name="maisonexample", name="maisonexample", profile_picture_url="u",
             followers_count=10, media_count=2, del_yn="N", tag_name="example",
             created_at=STAMP, updated_at=STAMP),
        dict(user_id="2", user_name="b", name=None, profile_picture_url=None, followers_count=None,
             media_count=None, del_yn="N", tag_name="b", created_at=STAMP, updated_at=STAMP),
    ]


def test_stage_media(spark):
    raw = spark.createDataFrame(
        [("m", "1", "2024-01-01T00:00:00+0900", 1, 2, "IMAGE", "FEED")], RAW_DOCUMENTS["media"]
    )
    staged = S.stage_media(raw, RUN).first().asDict()
    assert staged == dict(
        media_id="m", user_id="1", ts="2023-12-31 15:00:00", like_count=1, comments_count=2,
        media_type="IMAGE", media_product_type="FEED", del_yn="N", created_at=STAMP, updated_at=STAMP,
    )


def test_stage_media_hashtag_has_no_flag_or_update_time(spark):
    raw = spark.createDataFrame([("m", "1", "#a", "bad", "IMAGE")], RAW_DOCUMENTS["media_hashtag"])
    staged = S.stage_media_hashtag(raw, RUN)
    assert staged.columns == ["media_id", "user_id", "caption", "ts", "media_type", "created_at"]
    assert tuple(staged.first()) == ("m", "1", "#a", None, "IMAGE", STAMP)


def test_extra_columns_pass_through(spark):
    raw = spark.createDataFrame([(1, "a", "b", "x")], "user_id long, user_name string, name string, extra string")
    assert "extra" in S.stage_brand(raw, RUN).columns
