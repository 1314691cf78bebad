import pytest
from pyspark.sql import functions as F

from engagemart.operators.lookup import hot_keys, left_lookup, measure


def facts(spark, n=6000):
    """A third of the rows on one key, a sixth NULL, the rest spread and partly unmatched."""
    key = """case when id % 3 = 0 then 'hot' when id % 6 = 1 then null
             when id % 600 = 2 then 'hot-unknown' else cast(id % 500 as string) end"""
    return spark.range(n).selectExpr("id", f"{key} user_id")


def brands(spark):
    keys = spark.range(300).selectExpr("cast(id as string) user_id", "concat('t', id) tag_name")
    return keys.unionAll(spark.sql("select 'hot', 'thot'")).unionAll(spark.sql("select cast(null as string), 'tnull'"))


def joined(spark, lookup, share=1 / 50):
    return left_lookup(facts(spark), lookup, "user_id", share).select(
        "fact.id", "fact.user_id", "lookup.tag_name", F.col("lookup.user_id").alias("found")
    )


def expected(spark):
    f, b = facts(spark), brands(spark)
    return f.join(b, f.user_id == b.user_id, "left").select(f.id, f.user_id, b.tag_name, b.user_id.alias("found"))


def test_measure(spark):
    lookup = measure(brands(spark))
    assert lookup.rows == 302 and lookup.bytes > 302 * 16 and lookup.fits_broadcast
    empty = measure(brands(spark).where("false"))
    assert (empty.rows, empty.bytes) == (0, 0)


def test_small_lookup_is_broadcast_and_facts_not_shuffled(spark, rows, plan):
    result = joined(spark, measure(brands(spark)))
    assert rows(result) == rows(expected(spark))
    assert "BroadcastHashJoin" in plan(result) and "hashpartitioning" not in plan(result)


def test_hot_keys(spark, rows):
    assert rows(hot_keys(facts(spark), "user_id", 1 / 50)) == [("hot",)]


@pytest.mark.parametrize("share", [1 / 50, 1 / 20_000, 1.0])
def test_large_lookup_splits_hot_keys(spark, rows, share):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = measure(brands(spark), limit=500)
        assert not lookup.fits_broadcast
        assert rows(joined(spark, lookup, share)) == rows(expected(spark))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_spread_keys_are_shuffled(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup = measure(brands(spark), limit=500)
        result = joined(spark, lookup)
        text = plan(result)
        result.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1
    assert "LeftAnti" in text and "BroadcastHashJoin" in text


def test_repeated_lookup_keys_fan_out(spark, rows):
    double = brands(spark).unionAll(brands(spark))
    f = facts(spark)
    want = f.join(double, f.user_id == double.user_id, "left").select(f.id, f.user_id, double.tag_name, double.user_id)
    for limit in (500, 64 << 20):
        assert rows(joined(spark, measure(double, limit=limit))) == rows(want)
