"""Aggregate marts kept up to date by the hour: mergeable partial states per slice.

A slice's state holds what the slice changes, so an hour costs the hour; the mart is the sum of all states.
Both forms are exact:

* rates per tag: whole hundredths, rated posts and posts, with a sign. A post that replaces an older one
  takes the older one's contribution back;
* distinct posts per tag: bits over post numbers, merged with OR, so a post that recurs counts once.

States are written through the append manifest, one per slice, so a slice that is loaded again does not count twice.
Ids of posts must be whole numbers for the bits, one bit a number; a row of the state is a word of 64 of them,
so a state has no more rows than its slice, however far apart the numbers lie. Posts without an id have no bit, so
a tag with no other posts is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart import constants as K
from engagemart.functions import columns as C
from engagemart.operators.latest import latest_per_key
from engagemart.operators.lookup import Lookup
from engagemart.plans import marts as M
from engagemart.schemas import struct
from engagemart.scratch import materialize
from engagemart.sinks.loads import RawStore, align

RATE_STATES, REACH_STATES = "rate_states", "reach_states"
STATE_TABLES = {
    RATE_STATES: struct(
        tag_name=T.StringType(), hundredths=T.DecimalType(38, 0), rated=T.LongType(), posts=T.LongType()
    ),
    REACH_STATES: struct(tag_name=T.StringType(), bucket=T.LongType(), bits=T.LongType()),
}


def changes(batch: DataFrame, stored: DataFrame, key: str, recency: Sequence[str] = ()) -> DataFrame:
    """What an upsert of ``batch`` changes: rows that come, with ``sign`` 1, and the stored rows they replace, with -1.

    ``stored`` has one row per key, as before the upsert. Rows of the batch that are older than the stored one,
    or equal to it, change nothing.
    """
    newest = latest_per_key(batch, key, recency).withColumn("sign", F.lit(1))
    names = [name for name in newest.columns if name != "sign"]
    known = stored.select(*names).join(newest.select(key), key, "left_semi").withColumn("sign", F.lit(-1))
    values = [name for name in names if name != key]
    order = [*recency, *[name for name in values if name not in recency]] if recency else []
    both = newest.unionByName(known).withColumn("_later", F.col("sign"))
    # at most two rows a key: what wins comes, and the stored one goes unless it is what wins
    kept = F.max_by(F.struct("sign", *values), F.struct(*order, "_later")).alias("_kept")
    old = F.max(F.when(F.col("sign") == -1, F.struct("sign", *values))).alias("_old")
    pair = both.groupBy(key).agg(kept, old).where(F.col("_kept.sign") == 1)
    sides = [F.struct(*[F.col(f"{side}.{name}") for name in values]) for side in ("_kept", "_old")]
    moved = pair.where(F.col("_old").isNull() | ~sides[0].eqNullSafe(sides[1]))
    rows = moved.select(key, F.explode(F.array_compact(F.array("_kept", "_old"))).alias("_row"))
    return rows.select(key, "_row.*").select(*names, "sign")


def rate_state(changed: DataFrame, brands: Lookup) -> DataFrame:
    """Signed sums per tag of changed posts."""
    parts = [
        M.brand_information(changed.where(F.col("sign") == sign), brands, with_post_time=False).withColumn("sign", F.lit(sign))
        for sign in (1, -1)
    ]
    rows = parts[0].unionAll(parts[1])
    hundredths = F.rint(F.col("engagement_rate") * 10**K.RATE_DIGITS).cast("bigint")
    return rows.groupBy("tag_name").agg(
        F.sum((hundredths * F.col("sign")).cast("decimal(18,0)")).cast("decimal(38,0)").alias("hundredths"),
        F.sum(F.when(F.col("engagement_rate").isNotNull(), F.col("sign"))).cast("bigint").alias("rated"),
        F.sum("sign").cast("bigint").alias("posts"),
    )


def merged_rates(states: DataFrame, round_avg: int = K.AVERAGE_DIGITS) -> DataFrame:
    """The mart ``aggregated_brand_information`` from the states of all slices."""
    sums = states.groupBy("tag_name").agg(
        F.sum("hundredths").alias("hundredths"),
        F.coalesce(F.sum("rated"), F.lit(0)).alias("rated"),
        F.sum("posts").alias("brand_media_cnt"),
    )
    average = C.ratio_of_hundredths(F.col("hundredths").cast("decimal(28,0)"), F.col("rated"), round_avg)
    return sums.where("brand_media_cnt > 0").select("tag_name", average.alias("avg_engagement_rate"), "brand_media_cnt")


def load_with_rates(
    store: RawStore, posts: DataFrame, brands: Lookup, slice_id: str, recency: Sequence[str] = ("updated_at",)
) -> None:
    """Upsert a slice of posts and write what it changes in the rates.

    The state is computed against the table as it was, once, and committed before the posts. A slice that is repeated
    keeps its state and upserts the same posts again, which changes nothing, so a failure in between does no harm.
    Slices are loaded one after the other; a change of the brands' followers asks for a full build, as the mart does.
    """
    posts = align(posts, store.schemas["media"])
    if f"{RATE_STATES}/slice/{slice_id}" not in store.versions(RATE_STATES).state().entries:
        low, high = posts.agg(F.min("media_id"), F.max("media_id")).first()
        stored = store.read_keys("media", low, high)
        changed = materialize(changes(posts, stored, "media_id", recency), "changed-posts").frame
        store.append(RATE_STATES, rate_state(changed, brands), slice_id)
    store.upsert("media", posts, "media_id", recency, slice_id)


def _words(rows: DataFrame, groups: list[str], bits: str) -> DataFrame:
    """One word per group. Tasks hold the words of one partition each, of as many as the session plans; a scan's
    task, or one of partitions merged by their packed size, would hold far more."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, *groups).groupBy(*groups).agg(F.bit_or(bits).alias("bits"))


def reach_state(search: DataFrame, *slices: str) -> DataFrame:
    """Bits of the posts of each tag, by the slice columns if there are any: one word for 64 numbers."""
    number = F.col("media_id").cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))
    numbered = search.where("media_id is not null").select(
        *slices, "tag_name", F.shiftright(number, 6).alias("bucket"), bit.alias("_bit")
    )
    return _words(numbered, [*slices, "tag_name", "bucket"], "_bit")


def merged_reach(states: DataFrame) -> DataFrame:
    """The mart ``aggregated_hashtag_search`` from the states of all slices."""
    merged = _words(states, ["tag_name", "bucket"], "bits")
    return merged.groupBy("tag_name").agg(F.sum(F.bit_count("bits")).alias("hashtaged_media_cnt"))
