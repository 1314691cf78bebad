from datetime import datetime

import pytest
import raw
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from engagemart.operators.latest import latest_per_key
from engagemart.plans.etl import raw_store
from engagemart.schemas import RAW_TABLES
from engagemart.scratch import new_path
from engagemart.sinks import loads as L
from engagemart.sinks.log import CommitConflict

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
SCHEMA = "media_id string, like_count int, updated_at timestamp_ntz"


def batch(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def store(spark, buckets=4):
    return raw_store(spark, new_path(spark, "test-tables"), buckets)


def stored(s):
    return sorted((r.media_id, r.like_count) for r in s.read("media").collect())


def test_align_matches_by_name(spark):
    df = spark.createDataFrame([("2024-02-01 03:00:00", 5, "x")], "updated_at string, like_count bigint, other string")
    aligned = L.align(df, RAW_TABLES["media"])
    assert aligned.columns == RAW_TABLES["media"].fieldNames()
    row = aligned.first()
    assert (row.like_count, row.updated_at, row.media_id) == (5, datetime(2024, 2, 1, 3), None)


def test_latest_per_key(spark):
    df = batch(spark, ("a", 1, T1), ("a", 2, T2), ("a", 9, T1), ("b", 3, None), ("b", 1, None), ("c", 7, T1))
    assert sorted(tuple(r)[:2] for r in latest_per_key(df, "media_id", ["updated_at"]).collect()) == [
        ("a", 2), ("b", 3), ("c", 7),
    ]
    assert latest_per_key(df.select("media_id"), "media_id").count() == 3


def test_upsert_frame(spark, rows):
    target = batch(spark, ("a", 1, T1), ("b", 1, T1))
    new = batch(spark, ("b", 2, T2), ("c", 3, T2), ("c", 4, T1))
    once = L.upsert(target, new, "media_id", ["updated_at"])
    assert rows(once, "media_id", "like_count") == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(L.upsert(once, new, "media_id", ["updated_at"])) == rows(once)


def test_upsert_store(spark):
    s = store(spark)
    s.upsert("media", batch(spark, ("a", 1, T1), ("b", 1, T1)), "media_id", ["updated_at"])
    for _ in range(2):
        s.upsert("media", batch(spark, ("b", 2, T2), ("c", 3, T2), ("c", 4, T1)), "media_id", ["updated_at"])
        assert stored(s) == [("a", 1), ("b", 2), ("c", 3)]


def test_empty_upsert_changes_nothing(spark):
    s = store(spark)
    s.upsert("media", batch(spark), "media_id")
    assert stored(s) == []
    s.upsert("media", batch(spark, ("a", 1, T1)), "media_id")
    s.upsert("media", batch(spark), "media_id")
    assert stored(s) == [("a", 1)]


def test_upsert_rejects_null_keys(spark):
    s = store(spark)
    with pytest.raises(ValueError):
        s.upsert("media", batch(spark, (None, 1, T1)), "media_id")


def test_bucket_count_stays_with_the_table(spark):
    first = store(spark, buckets=4)
    first.upsert("media", batch(spark, *[(str(i), i, T1) for i in range(50)]), "media_id")
    again = raw_store(spark, first.root, 9)
    again.upsert("media", batch(spark, *[(str(i), -i, T2) for i in range(50)]), "media_id")
    assert stored(again) == sorted((str(i), -i) for i in range(50))
    with pytest.raises(ValueError):
        again.upsert("media", batch(spark, ("a", 1, T1)), "like_count")


def test_upsert_with_keys_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    s = store(spark)
    s.upsert("media", batch(spark, *[(str(i), i, T1) for i in range(100)]), "media_id")
    s.upsert("media", batch(spark, *[(str(i), -i, T2) for i in range(50, 150)]), "media_id")
    assert stored(s) == sorted([(str(i), i) for i in range(50)] + [(str(i), -i) for i in range(50, 150)])


def files(df):
    return set(df.inputFiles())


def test_an_upsert_rewrites_nothing(spark):
    s = store(spark, buckets=16)
    s.upsert("media", batch(spark, *[(str(i), i, T1) for i in range(200)]), "media_id")
    before = files(s.read("media"))
    s.upsert("media", batch(spark, ("7", -7, T2)), "media_id")
    after = files(s.read("media"))
    assert before < after and len(after - before) == 1


def test_untouched_buckets_are_left_alone(spark):
    s = store(spark, buckets=16)
    s.upsert("media", batch(spark, *[(str(i), i, T1) for i in range(200)]), "media_id")
    before = files(s.read("media"))
    s.upsert("media", batch(spark, ("7", -7, T2)), "media_id")
    s.fold("media")
    gone = before - files(s.read("media"))
    assert len({path.split("key_bucket=")[1].split("/")[0] for path in gone}) == 1
    assert dict(stored(s))["7"] == -7 and len(stored(s)) == 200


def written_rows(s):
    """Rows in all files that uncounted, replaced and current loads have left."""
    folder = f"{s.root}/media/runs"
    return s.spark.read.option("recursiveFileLookup", "true").schema(RAW_TABLES["media"]).parquet(folder).count()


def test_bytes_written_grow_with_the_batch(spark):
    s = store(spark, buckets=4)
    s.upsert("media", batch(spark, *[(f"{i:05d}", i, T1) for i in range(4000)]), "media_id", ["updated_at"])
    first, size = written_rows(s), 20
    for hour in range(16):
        records = [(f"{(hour * 977 + i * 31) % 4500:05d}", hour, datetime(2024, 1, 2, hour)) for i in range(size)]
        s.upsert("media", batch(spark, *records), "media_id", ["updated_at"])
    # sixteen batches, each merged into a larger run once, and the table never rewritten
    assert written_rows(s) - first <= 2 * 16 * size
    state = s.versions("media").state()
    assert len(state.below("media/run/")) < L.TIER_RUNS
    assert len(stored(s)) == len({k for k, _ in stored(s)}) > 4000


def test_runs_are_folded_once_they_are_a_fair_part(spark):
    s = store(spark, buckets=2)
    s.upsert("media", batch(spark, *[(f"{i:03d}", i, T1) for i in range(40)]), "media_id", ["updated_at"])
    for hour in range(L.TIER_RUNS):
        s.upsert("media", batch(spark, *[(f"{i:03d}", -hour, datetime(2024, 1, 2, hour)) for i in range(5)]), "media_id", ["updated_at"])
    state = s.versions("media").state()
    assert not state.below("media/run/") and sum(e["rows"] for e in state.below("media/base/").values()) == 40
    assert stored(s)[:6] == [(f"{i:03d}", 1 - L.TIER_RUNS) for i in range(5)] + [("005", 5)]


@pytest.mark.parametrize("limit", [L.BROADCAST_BYTES, 0])
def test_batches_in_any_order_give_the_same_table(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(L, "BROADCAST_BYTES", limit)
    T3 = datetime(2024, 1, 3)
    loads = [
        [("a", 1, T1), ("b", 5, T2), ("c", 1, None)],
        [("a", 2, T2), ("b", 4, T1), ("d", 1, T1)],
        [("a", 3, T2), ("c", 2, None), ("d", 9, T3)],
    ]
    seen = set()
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        s = store(spark)
        for number in order:
            s.upsert("media", batch(spark, *loads[number]), "media_id", ["updated_at"])
        once = tuple(stored(s))
        s.fold("media")
        assert tuple(stored(s)) == once
        seen.add(once)
    assert seen == {(("a", 3), ("b", 5), ("c", 2), ("d", 9))}


def test_an_older_batch_leaves_newer_rows(spark):
    s = store(spark)
    s.upsert("media", batch(spark, ("a", 2, T2)), "media_id", ["updated_at"])
    s.upsert("media", batch(spark, ("a", 1, T1)), "media_id", ["updated_at"])
    assert stored(s) == [("a", 2)]
    with pytest.raises(ValueError, match="ordered by"):
        s.upsert("media", batch(spark, ("a", 3, T2)), "media_id")


def test_files_out_of_the_range_of_keys_are_not_opened(spark):
    s = store(spark, buckets=1)
    s.upsert("media", batch(spark, *[(f"{i:03d}", i, T1) for i in range(100)]), "media_id", ["updated_at"])
    s.upsert("media", batch(spark, ("005", -5, T2), ("007", -7, T2)), "media_id", ["updated_at"])
    s.upsert("media", batch(spark, ("500", 500, T2)), "media_id", ["updated_at"])
    everything, near, far = s.read_keys("media"), s.read_keys("media", "004", "006"), s.read_keys("media", "400")
    assert len(files(everything)) == 3 and len(files(near)) == 2 and len(files(far)) == 1
    assert sorted((r.media_id, r.like_count) for r in near.collect()) == [("004", 4), ("005", -5), ("006", 6)]
    assert [(r.media_id, r.like_count) for r in far.collect()] == [("500", 500)]
    assert s.read_keys("media", "6").collect() == []


def test_a_fold_that_another_writer_has_done_is_refused(spark, monkeypatch):
    s = store(spark)
    s.upsert("media", batch(spark, ("a", 1, T1)), "media_id", ["updated_at"])
    s.upsert("media", batch(spark, ("a", 2, T2)), "media_id", ["updated_at"])
    merged, again = s._merged, []

    def slow(*args):
        if not again:
            again.append(1)
            raw_store(spark, s.root, 4).fold("media")
        return merged(*args)

    monkeypatch.setattr(s, "_merged", slow)
    with pytest.raises(CommitConflict):
        s.fold("media")
    assert stored(s) == [("a", 2)]


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, monkeypatch):
    s = store(spark)
    s.upsert("media", batch(spark, ("a", 1, T1)), "media_id")
    monkeypatch.setattr("engagemart.sinks.publish.Run.commit", lambda run: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        s.upsert("media", batch(spark, ("a", 2, T2), ("b", 2, T2)), "media_id")
    assert stored(s) == [("a", 1)]


def test_a_reader_keeps_its_version_during_an_upsert(spark):
    s = store(spark)
    s.upsert("media", batch(spark, ("a", 1, T1)), "media_id")
    reader = s.read("media")
    s.upsert("media", batch(spark, ("a", 2, T2)), "media_id")
    assert [r.like_count for r in reader.collect()] == [1]
    assert stored(s) == [("a", 2)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 5)), max_size=15), min_size=1, max_size=3))
def test_upserts_follow_a_dictionary(spark, batches):
    s, expected = store(spark), {}
    for hour, pairs in enumerate(batches):
        records = [(str(k), v, datetime(2024, 1, 1, hour)) for k, v in pairs]
        s.upsert("media", batch(spark, *records), "media_id", ["updated_at"])
        newest = {}
        for key, value, _ in records:
            newest[key] = max(value, newest.get(key, value))
        expected |= newest
    assert stored(s) == sorted(expected.items())


def test_append_is_idempotent_per_slice(spark):
    s = store(spark)
    posts = raw.media_hashtag(spark)
    for slice_id in ("h1", "h2", "h2"):
        s.append("media_hashtag", posts, slice_id)
    assert s.read("media_hashtag").count() == 2 * posts.count()
    assert s.read("media_hashtag").columns == posts.columns
    assert {r[0] for r in s.read_slices("media_hashtag").select(L.SLICE_COLUMN).distinct().collect()} == {"h1", "h2"}


def test_an_emptied_slice_is_empty(spark, rows):
    s = store(spark)
    posts = raw.media_hashtag(spark)
    s.append("media_hashtag", posts, "h1")
    s.append("media_hashtag", posts, "h2")
    s.append("media_hashtag", posts.limit(0), "h1")
    assert [r[0] for r in s.read_slices("media_hashtag").select(L.SLICE_COLUMN).distinct().collect()] == ["h2"]
    assert s.read_slices("media_hashtag", ["h1"]).count() == 0
    s.append("media_hashtag", posts, "h1")
    assert s.read_slices("media_hashtag", ["h1", "h3"]).count() == posts.count()
    manifest = s.versions("media_hashtag").state().below("media_hashtag/slice/")
    assert {name.rsplit("/", 1)[1]: entry["rows"] for name, entry in manifest.items()} == {"h1": 6, "h2": 6}


def test_many_slices_at_once(spark):
    s = store(spark)
    posts = raw.media_hashtag(spark)
    s.append("media_hashtag", posts, F.col("user_id"))
    users = {r[0] for r in posts.select("user_id").distinct().collect()}
    assert {r[0] for r in s.read_slices("media_hashtag").select(L.SLICE_COLUMN).distinct().collect()} == users
    gone = sorted(users)[0]
    s.append("media_hashtag", posts.where(F.col("user_id") != gone), F.col("user_id"), slices=sorted(users))
    assert s.read("media_hashtag").count() == posts.where(F.col("user_id") != gone).count()


def test_load_strategies(spark):
    s = store(spark)
    brand, media = raw.brand(spark), raw.media(spark)
    L.load(s, "brand", brand, "h1", "REPLACE", has_log=True)
    L.load(s, "brand", brand.where("user_id = '1'"), "h2", "REPLACE", has_log=True)
    assert (s.read("brand").count(), s.read("brand_log").count()) == (1, 5)
    for _ in range(2):
        L.load(s, "media", media, "h1", "UPSERT", "media_id", True)
    assert (s.read("media").count(), s.read("media_log").count()) == (8, 8)
    L.load(s, "media_hashtag", raw.media_hashtag(spark), "h1", "APPEND")
    assert s.read("media_hashtag").count() == 6


def test_load_rejects_bad_requests(spark):
    with pytest.raises(ValueError):
        L.load(store(spark), "media", raw.media(spark), "h1", "UPSERT")
    with pytest.raises(ValueError):
        L.load(store(spark), "media", raw.media(spark), "h1", "MERGE")


def test_merge_into_needs_a_table_format_with_merge(spark):
    name = "plain_parquet_media"
    path = new_path(spark, name)
    batch(spark, ("a", 1, T1)).write.option("path", path).mode("overwrite").saveAsTable(name)
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            L.merge_into(batch(spark, ("a", 2, T2)), name, "media_id", ["updated_at"])
    finally:
        spark.sql(f"drop table {name}")


def test_base_and_runs_beyond_a_broadcast_are_merged_in_one_shuffle(spark, plan, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    s = store(spark)
    for n in range(3):  # the first is folded into the base, the others are runs
        s.upsert("media", batch(spark, ("a", n, T1), ("b", 5 - n, T1), (f"c{n}", n, T2)), "media_id")
    merged = s.read("media")
    assert stored(s) == [("a", 2), ("b", 3), ("c0", 0), ("c1", 1), ("c2", 2)]
    assert plan(merged.select("media_id", "like_count")).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
