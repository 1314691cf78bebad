"""Partial states per slice against marts built from everything."""

from datetime import datetime

import raw
from pyspark.sql import functions as F

from engagemart.plans import incremental as I
from engagemart.plans import marts as M
from engagemart.schemas import RAW_TABLES
from engagemart.scratch import new_path
from engagemart.sinks.loads import RawStore

T1, T2, T3 = (datetime(2024, 1, day) for day in (1, 2, 3))
SCHEMA = "media_id string, like_count int, updated_at timestamp_ntz"


def test_changes(spark, rows):
    stored = spark.createDataFrame([("a", 1, T2), ("b", 1, T2), ("c", 1, T2), ("z", 1, T1)], SCHEMA)
    batch = spark.createDataFrame([("a", 2, T3), ("a", 5, T1), ("b", 2, T1), ("c", 1, T2), ("n", 7, None)], SCHEMA)
    changed = I.changes(batch, stored, "media_id", ["updated_at"])
    assert rows(changed, "media_id", "like_count", "sign") == [("a", 1, -1), ("a", 2, 1), ("n", 7, 1)]
    later = I.changes(batch.where("media_id != 'a'"), stored, "media_id")  # without recency the batch wins
    assert rows(later, "media_id", "like_count", "sign") == [("b", 1, -1), ("b", 2, 1), ("n", 7, 1)]


def test_states_follow_the_store(spark, rows):
    store = RawStore(spark, new_path(spark, "tables"), {**RAW_TABLES, **I.STATE_TABLES}, 2)
    posts, brands = raw.media(spark), M.brand_lookup(raw.brand(spark))
    moved = posts.withColumns({"user_id": F.lit("3"), "updated_at": F.lit(T3).cast("timestamp_ntz") + F.expr("interval 900 days")})
    half = F.col("media_id") < posts.agg(F.max("media_id")).first()[0]
    for name, batch in (("h1", posts), ("h2", moved.where(half)), ("h2", moved.where(half)), ("h3", posts), ("h4", posts.limit(0))):
        I.load_with_rates(store, batch, brands, name)
        full = M.aggregated_brand_information(M.brand_information(store.read("media"), brands))
        assert rows(I.merged_rates(store.read(I.RATE_STATES))) == rows(full)


def test_reach_of_slices_in_any_cut(spark, rows):
    search = spark.createDataFrame(
        [("x", "5"), ("x", "5"), ("x", "70000"), ("x", None), ("y", "5"), (None, "9"), (None, "9"), ("y", "123456789012")],
        "tag_name string, media_id string",
    )
    wanted = rows(M.aggregated_hashtag_search(search))
    for cut in (F.lit("one"), F.monotonically_increasing_id().cast("string"), F.col("media_id")):
        states = I.reach_state(search.withColumn("slice", cut), "slice")
        assert rows(I.merged_reach(states)) == wanted


def test_reach_state_grows_with_its_posts_not_with_their_numbers(spark, rows, plan):
    search = spark.range(3000).selectExpr("concat('t', id % 3) tag_name", "cast(id % 1500 * 1000003 - 7 as string) media_id")
    states = I.reach_state(search)
    held = [len(row.bits) if isinstance(row.bits, bytes | bytearray) else 8 for row in states.collect()]
    assert sum(held) <= 8 * 3000
    assert "SortAggregate" not in plan(I.merged_reach(states))  # buffers of fixed size
    assert rows(I.merged_reach(states)) == rows(M.aggregated_hashtag_search(search))


def test_reach_of_all_bits_of_a_word(spark, rows):
    search = spark.range(-70, 200).selectExpr("'x' tag_name", "cast(id as string) media_id")
    assert rows(I.merged_reach(I.reach_state(search))) == [("x", 270)]
