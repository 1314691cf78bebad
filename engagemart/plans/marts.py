"""The analytics tables as functions from DataFrames to DataFrames.

Functions that attach brand columns take the brand table as a measured
:class:`~engagemart.operators.lookup.Lookup`, so it is measured once per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart import constants as K
from engagemart.functions import columns as C
from engagemart.functions import hashtags as H
from engagemart.operators.lookup import Lookup, left_lookup, measure
from engagemart.operators.ranking import Rank, add_ranks

_BRAND_COLUMNS = ["user_id", "tag_name", "media_count", "followers_count", "updated_at"]
_PROFILE = ["tag_name", "profile_picture_url", "followers_count", "user_id"]
_POSTING_TIME = ["post_time", "day_of_week", "post_day_of_week"]


def brand_lookup(brand: DataFrame) -> Lookup:
    """The brand columns the marts attach, measured."""
    return measure(brand.select(*_BRAND_COLUMNS))


def brand_tags(brand: DataFrame) -> Lookup:
    """Only the key and the tag name, for marts that need nothing else."""
    return measure(brand.select("user_id", "tag_name"))


def brand_basic_info(brand: DataFrame) -> DataFrame:
    return brand.select(*_PROFILE)


def feed_and_reels(media: DataFrame) -> DataFrame:
    return media.where(F.col("media_product_type").isin(*K.POST_PRODUCT_TYPES))


def brand_information(
    media: DataFrame, brands: Lookup, with_post_time: bool = True
) -> DataFrame:
    """One row per feed or reels post with brand columns and engagement.

    ``user_id`` is the brand's, hence NULL for posts of unknown accounts.
    """
    joined = left_lookup(feed_and_reels(media), brands, "user_id")
    engaged = C.engagement(F.col("fact.like_count"), F.col("fact.comments_count"))
    posting = C.posting_time(F.col("fact.ts")) if with_post_time else {}
    return joined.select(
        "lookup.tag_name",
        "lookup.user_id",
        "lookup.media_count",
        "lookup.followers_count",
        "lookup.updated_at",
        "fact.media_id",
        "fact.like_count",
        "fact.comments_count",
        "fact.ts",
        "fact.media_type",
        "fact.media_product_type",
        engaged.alias("engagement"),
        C.engagement_rate(engaged, F.col("lookup.followers_count")).alias("engagement_rate"),
        *[column.alias(name) for name, column in posting.items()],
    )


def followers_growth(brand_log: DataFrame, brands: Lookup) -> DataFrame:
    """Follower history with tag names; counts are the history's own."""
    facts = brand_log.select("user_id", "followers_count", "created_at")
    return left_lookup(facts, brands, "user_id").select(
        "lookup.tag_name", "fact.followers_count", "fact.created_at"
    )


def hashtag_search(media_hashtag: DataFrame, brands: Lookup) -> DataFrame:
    """Hashtag posts with tag names; ``user_id`` is the post's, so never lost."""
    return left_lookup(media_hashtag, brands, "user_id").select(
        "lookup.tag_name",
        "fact.media_id",
        "fact.caption",
        "fact.ts",
        "fact.user_id",
        "fact.created_at",
    )


def trending_topics(search: DataFrame) -> DataFrame:
    return H.positioned_hashtags(search, ["ts", "tag_name", "created_at"])


def hashtag_count(captions: DataFrame, top_k: int | None = K.TOP_HASHTAGS) -> DataFrame:
    """Hashtag frequencies straight from captions.

    The brand join of ``hashtag_search`` adds no rows while brand ids are unique,
    which the quality gate guarantees, so it is left out.
    """
    return H.hashtag_frequency(H.hashtags(captions), top_k)


def hashtag_count_of_topics(topics: DataFrame, top_k: int | None = K.TOP_HASHTAGS) -> DataFrame:
    """Hashtag frequencies from already extracted topics."""
    return H.hashtag_frequency(topics.select("related_hashtag"), top_k)


def aggregated_brand_information(
    information: DataFrame,
    round_avg: int | None = K.AVERAGE_DIGITS,
    media_ids_unique: bool = False,
) -> DataFrame:
    """Average rate and number of posts per tag.

    Where post ids are known to be unique (the quality gate checks it), plain counting
    gives the distinct count and only partial sums are shuffled instead of all ids.
    """
    average = C.exact_average(F.col("engagement_rate"), round_avg)
    posts = F.count("media_id") if media_ids_unique else F.count_distinct("media_id")
    return information.groupBy("tag_name").agg(
        average.alias("avg_engagement_rate"), posts.alias("brand_media_cnt")
    )


def aggregated_hashtag_search(search: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct posts per tag; exact unless an estimate is asked for."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return search.groupBy("tag_name").agg(distinct("media_id").alias("hashtaged_media_cnt"))


def popularity_factor_early_stage(by_brand: DataFrame, by_hashtag: DataFrame) -> DataFrame:
    """Both aggregates side by side. The NULL tag group never finds a partner."""
    brands, reach = by_brand.alias("b"), by_hashtag.alias("h")
    return brands.join(reach, F.col("b.tag_name") == F.col("h.tag_name"), "left").select(
        "b.tag_name", "b.avg_engagement_rate", "h.hashtaged_media_cnt"
    )


def popularity_inputs(early: DataFrame, basic_info: DataFrame) -> DataFrame:
    """What the popularity ranks order by. Expects unique tag names."""
    inputs, profile = early.alias("e"), basic_info.alias("p")
    return inputs.join(profile, F.col("e.tag_name") == F.col("p.tag_name"), "left").select(
        "e.tag_name", "e.avg_engagement_rate", "e.hashtaged_media_cnt", "p.followers_count"
    )


def popularity_factor(inputs: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Ranks by rate, reach and followers. ``inputs`` as returned by ``rankable``."""
    measures = ["avg_engagement_rate", "hashtaged_media_cnt", "followers_count"]
    ranked = add_ranks(inputs, [Rank(name, f"rank_{name}") for name in measures], max_rows)
    return ranked.withColumns({f"rank_{name}": F.col(f"rank_{name}").cast("int") for name in measures})


def popularity_calculation(factor: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Rank of the rank sum, best first. ``factor`` as returned by ``rankable``."""
    summed = factor.select(
        "tag_name",
        (
            F.col("rank_avg_engagement_rate")
            + F.col("rank_hashtaged_media_cnt")
            + F.col("rank_followers_count")
        ).alias("sum_rank"),
    )
    ranked = add_ranks(summed, [Rank("sum_rank", "popularity_rank", descending=False)], max_rows)
    return ranked.withColumn("popularity_rank", F.col("popularity_rank").cast("int"))


def popularity_bound(brands: Lookup) -> int:
    """Most rows the popularity marts can have.

    Every brand row meets at most one tag group, and posts without a brand form one.
    """
    return brands.rows + 1


def brand_media_post_time(information: DataFrame) -> DataFrame:
    """Posting times, from an information table with or without those columns."""
    if "post_time" not in information.columns:
        information = information.withColumns(C.posting_time(F.col("ts")))
    return information.select("ts", "tag_name", *_POSTING_TIME)
