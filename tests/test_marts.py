import raw
from pyspark.sql import functions as F

from engagemart.plans import marts as M


def information(spark, **options):
    return M.brand_information(raw.media(spark), M.brand_lookup(raw.brand(spark)), **options)


def test_brand_basic_info(spark):
    assert M.brand_basic_info(raw.brand(spark)).columns == [
        "tag_name", "profile_picture_url", "followers_count", "user_id",
    ]


def test_brand_information(spark, rows):
    df = information(spark)
    assert df.columns == [
        "tag_name", "user_id", "media_count", "followers_count", "updated_at", "media_id", "like_count",
        "comments_count", "ts", "media_type", "media_product_type", "engagement", "engagement_rate",
        "post_time", "day_of_week", "post_day_of_week",
    ]
    assert rows(df, "media_id", "tag_name", "user_id", "engagement", "engagement_rate") == [
        ("m1", "aa", "1", 15, 15.0),
        ("m2", "aa", "1", 25, 25.0),
        ("m3", "bb", "2", 15, None),
        ("m4", "cc", "3", 108, 2.7),
        ("m5", None, None, 15, None),
        ("m7", "cc", "3", None, None),
        ("m8", None, None, 2, None),
    ]
    posted = {r.media_id: (r.post_time, r.day_of_week, r.post_day_of_week) for r in df.collect()}
    assert posted["m1"] == (23, 1, "Sunday") and posted["m2"] == (5, 2, "Monday")


def test_brand_information_without_post_time(spark, rows):
    short = information(spark, with_post_time=False)
    assert "post_time" not in short.columns
    assert rows(M.brand_media_post_time(short)) == rows(M.brand_media_post_time(information(spark)))


def test_followers_growth_keeps_history_counts(spark, rows):
    df = M.followers_growth(raw.brand_log(spark), M.brand_tags(raw.brand(spark)))
    assert rows(df, "tag_name", "followers_count") == [("aa", 100), ("aa", 90), (None, 5)]


def search(spark):
    return M.hashtag_search(raw.media_hashtag(spark), M.brand_tags(raw.brand(spark)))


def test_hashtag_search_keeps_unmatched_user(spark, rows):
    assert rows(search(spark), "media_id", "user_id", "tag_name") == [
        ("h1", "1", "aa"), ("h1", "1", "aa"), ("h2", "2", "bb"), ("h3", "9", None),
        ("h4", "3", "cc"), ("h5", "3", "cc"),
    ]


def test_hashtags(spark, rows):
    topics = M.trending_topics(search(spark))
    assert topics.columns == ["ts", "tag_name", "created_at", "pos", "related_hashtag"]
    counts = [("#a", 3), ("#b", 2), ("#d\n", 1), ("#e,", 1), ("#Ä", 1)]
    assert rows(M.hashtag_count_of_topics(topics)) == sorted(counts, key=repr)
    assert rows(M.hashtag_count(raw.media_hashtag(spark))) == sorted(counts, key=repr)
    assert [tuple(r) for r in M.hashtag_count(raw.media_hashtag(spark), 3).collect()] == [
        ("#a", 3), ("#b", 2), ("#d\n", 1),
    ]


def by_brand(spark, **options):
    return M.aggregated_brand_information(information(spark), **options)


def test_aggregates(spark, rows):
    expected = [("aa", 20.0, 2), ("bb", None, 1), ("cc", 2.7, 2), (None, None, 2)]
    assert rows(by_brand(spark)) == expected
    assert rows(by_brand(spark, media_ids_unique=True)) == expected
    assert rows(M.aggregated_hashtag_search(search(spark))) == [
        ("aa", 1), ("bb", 1), ("cc", 2), (None, 1),
    ]


def test_estimated_reach_is_opt_in(spark, rows):
    estimated = M.aggregated_hashtag_search(search(spark), approximate=True)
    assert rows(estimated) == rows(M.aggregated_hashtag_search(search(spark)))


def test_average_rounding_is_optional(spark):
    df = spark.createDataFrame([("t", "m1", 1.0), ("t", "m2", 1.0), ("t", "m3", 2.0)],
                               "tag_name string, media_id string, engagement_rate double")
    assert M.aggregated_brand_information(df).first().avg_engagement_rate == 1.3333
    assert M.aggregated_brand_information(df, round_avg=None).first().avg_engagement_rate == 4 / 3


def inputs(spark):
    early = M.popularity_factor_early_stage(by_brand(spark), M.aggregated_hashtag_search(search(spark)))
    return M.popularity_inputs(early, M.brand_basic_info(raw.brand(spark)))


def test_null_tag_group_joins_nothing(spark, rows):
    assert rows(inputs(spark)) == [
        ("aa", 20.0, 1, 100), ("bb", None, 1, 0), ("cc", 2.7, 2, 4000), (None, None, None, None),
    ]


def test_popularity(spark, rows):
    factor = M.popularity_factor(inputs(spark))
    assert factor.columns[-3:] == [
        "rank_avg_engagement_rate", "rank_hashtaged_media_cnt", "rank_followers_count",
    ]
    assert rows(factor, "tag_name", *factor.columns[-3:]) == [
        ("aa", 1, 2, 2), ("bb", 3, 2, 3), ("cc", 2, 1, 1), (None, 3, 4, 4),
    ]
    assert rows(M.popularity_calculation(factor)) == [
        ("aa", 5, 2), ("bb", 8, 3), ("cc", 4, 1), (None, 11, 4),
    ]


def test_popularity_bound_holds(spark):
    brand = raw.brand(spark)
    doubled = brand.unionAll(brand.withColumn("user_id", F.concat(F.lit("x"), "user_id")))
    lookup = M.brand_lookup(doubled)
    early = M.popularity_factor_early_stage(by_brand(spark), M.aggregated_hashtag_search(search(spark)))
    assert M.popularity_inputs(early, doubled).count() <= M.popularity_bound(lookup)
