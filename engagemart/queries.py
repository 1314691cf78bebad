"""One runnable query per operator over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from engagemart import constants as K
from engagemart import fixtures as X
from engagemart.operators import quality as Q
from engagemart.operators import uniqueness
from engagemart.operators.latest import latest_per_key
from engagemart.operators.lookup import Lookup
from engagemart.operators.ranking import Rank, add_ranks, rankable
from engagemart.plans import incremental as I
from engagemart.plans import marts as M
from engagemart.plans import staging as S
from engagemart.plans.elt import run_elt
from engagemart.plans.etl import document_schema, raw_store, run_etl
from engagemart.scratch import materialize, new_path
from engagemart.schemas import RAW_TABLES
from engagemart.sinks.loads import RawStore
from engagemart.sinks.publish import TableStore, publish
from engagemart.sinks.tables import write_staging
from engagemart.sources import contract as contracts
from engagemart.sources import json_arrays, slices
from engagemart.sources.tables import read_tables
from engagemart.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]
LOGICAL_DATE = "2024-02-01T03:00:00+00:00"
EARLIER_DATE = "2024-02-01T02:00:00+00:00"
RANGE_ROWS = 5_000
BUCKETS = 8
BACKLOG_HOURS = 4
SMALL_BATCHES = 50
#: Rows of one file of a batch, so a large batch is read by many tasks.
BATCH_FILE_ROWS = 100_000

MEDIA_CONTRACT = [
    Row(column_name=name, is_nullable=null, data_type=kind,
        character_maximum_length=length, unique_name=unique)
    for name, null, kind, length, unique in (
        ("media_id", "NO", "character varying", 20, "media_id"),
        ("ts", "YES", "timestamp without time zone", None, None),
        ("media_type", "NO", "character varying", 5, None),
        ("media_product_type", "NO", "character varying", 4, None),
        ("like_count", "YES", "integer", None, None),
        ("comments_count", "YES", "integer", None, None),
        ("user_id", "NO", "character varying", 20, None),
    )
]


# --- marts -------------------------------------------------------------------


def brand_basic_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.brand_basic_info(X.brand(spark, sf_dir))


def feed_reels_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.feed_and_reels(X.media(spark, sf_dir)).select("media_id", "media_product_type")


def brand_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.brand_information(X.media(spark, sf_dir), M.brand_lookup(X.brand(spark, sf_dir)))


def followers_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.followers_growth(X.brand_log(spark, sf_dir), M.brand_tags(X.brand(spark, sf_dir)))


def hashtag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.hashtag_search(X.media_hashtag(spark, sf_dir), M.brand_tags(X.brand(spark, sf_dir)))


def trending_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.trending_topics(hashtag_search(spark, sf_dir))


def hashtag_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.hashtag_count(X.media_hashtag(spark, sf_dir), top_k=None)


def hashtag_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.hashtag_count(X.media_hashtag(spark, sf_dir), top_k=10)


def hashtag_count_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.hashtag_count_of_topics(trending_topics(spark, sf_dir), K.TOP_HASHTAGS)


def aggregated_brand_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.aggregated_brand_information(brand_information(spark, sf_dir))


def aggregated_hashtag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.aggregated_hashtag_search(hashtag_search(spark, sf_dir))


def _early_stage(spark: SparkSession, sf_dir: str, brands: Lookup) -> DataFrame:
    information = M.brand_information(X.media(spark, sf_dir), brands)
    search = M.hashtag_search(X.media_hashtag(spark, sf_dir), brands)
    return M.popularity_factor_early_stage(
        M.aggregated_brand_information(information), M.aggregated_hashtag_search(search)
    )


def _ranked_popularity(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    brand = X.brand(spark, sf_dir)
    brands = M.brand_lookup(brand)
    early = _early_stage(spark, sf_dir, brands)
    inputs = M.popularity_inputs(early, M.brand_basic_info(brand))
    inputs, rows = rankable(inputs, M.popularity_bound(brands), "popularity")
    return M.popularity_factor(inputs, rows), rows


def popularity_factor_early_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _early_stage(spark, sf_dir, M.brand_lookup(X.brand(spark, sf_dir)))


def popularity_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked_popularity(spark, sf_dir)[0]


def popularity_calculation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.popularity_calculation(*rankable(*_ranked_popularity(spark, sf_dir), "factor"))


def brand_media_post_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.brand_media_post_time(brand_information(spark, sf_dir))


def publish_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a mart twice under one run id; readers see one whole copy."""
    store = TableStore(spark, new_path(spark, "marts"))
    mart = materialize(aggregated_hashtag_search(spark, sf_dir), "mart").frame
    for _ in range(2):
        publish(store, "aggregated_hashtag_search", mart, "hour-03")
    return store.read("aggregated_hashtag_search")


def mart_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and publish all twelve marts; rows per published mart."""
    store = TableStore(spark, new_path(spark, "marts"))
    run_elt(X.raw_tables(spark, sf_dir), store, "hour-03", with_gate=False, all_marts=True)
    published = store.read_all((*K.CORE_MARTS, *K.EXTRA_MARTS))
    counts = [
        mart.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows"))
        for name, mart in published.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def _gated(mart: str) -> Query:
    """One mart as published by the whole job with its gate, on posts that pass it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = TableStore(spark, new_path(spark, "marts"))
        raw = X.raw_tables(spark, sf_dir)
        raw["media"] = raw["media"].fillna("NONE", ["media_product_type"])
        run_elt(raw, store, "hour-03")
        return store.read(mart)

    return query


GATED = ("hashtag_count", "aggregated_brand_information", "popularity_calculation")


# --- sources and staging -----------------------------------------------------


def scan_raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"supplier": "s_suppkey", "events": "user_id", "lineitem": "l_suppkey", "orders": "o_custkey"}
    tables = read_tables(spark, X.source(sf_dir), keys)
    counts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.min(keys[name]).alias("lowest_key"),
            F.max(keys[name]).alias("highest_key"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = X.source(sf_dir).read(spark, "events").select("event_id", "props")
    return slices.decode_json(events, "props", "k int")


def stage_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_brand(X.brand_documents(spark, sf_dir), LOGICAL_DATE)


def stage_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_media(X.media_documents(spark, sf_dir), LOGICAL_DATE)


def stage_media_hashtag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stage_media_hashtag(X.media_hashtag_documents(spark, sf_dir), LOGICAL_DATE)


def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stage")
    write_staging(stage_media(spark, sf_dir), path)
    return spark.read.parquet(path)


def slice_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "raw-events")
    events = X.source(sf_dir).read(spark, "events")
    slices.write_partitioned(events, path, "ts", "json")
    raw = slices.read_slice(spark, path, events.schema, multi_line=False)
    return slices.slice_inventory(raw, levels=2).select("slice", "rows")


def slice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "events-by-hour")
    events = X.source(sf_dir).read(spark, "events").select("event_id", "ts", "value")
    slices.write_partitioned(events, path, "ts")
    hourly = spark.read.parquet(path).where("ds between date'2024-01-08' and date'2024-01-14'")
    return hourly.select("event_id", "value", F.col("ds").cast("string").alias("ds"), "hh")


def etl_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON slice -> staging -> checks -> upsert, run twice for the same hour."""
    root = new_path(spark, "etl")
    X.media_documents(spark, sf_dir).write.json(f"{root}/raw")
    store = raw_store(spark, f"{root}/tables", BUCKETS)
    for _ in range(2):
        run_etl(
            store, "media", f"{root}/raw", f"{root}/stage", LOGICAL_DATE, "hour-03", multi_line=False
        )
    return store.read("media")


#: A column that only the contract knows of.
WIDER_CONTRACT = [
    *MEDIA_CONTRACT,
    *[
        Row(column_name=name, is_nullable="YES", data_type=kind, character_maximum_length=None, unique_name=None)
        for name, kind in (("shortcode", "character varying"), ("view_count", "bigint"))
    ],
]


def etl_contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line array files of about 256 MB, each read by many tasks, with columns that only the contract knows of."""
    root = new_path(spark, "etl-wide")
    documents = X.wide_documents(spark, sf_dir).where("media_type = 'IMAGE' and media_product_type is not null")
    X.write_array(documents, f"{root}/raw")
    store = raw_store(spark, f"{root}/tables", BUCKETS, {"media": WIDER_CONTRACT})
    run_etl(store, "media", f"{root}/raw", f"{root}/stage", LOGICAL_DATE, "hour-03", WIDER_CONTRACT)
    return store.read("media").select("media_id", "ts", "like_count", "media_type", "shortcode", "view_count")


def json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as indented JSON array files of about 256 MB, each cut into documents by many tasks."""
    path = new_path(spark, "json-array")
    pages = X.source(sf_dir).read(spark, "pages")
    X.write_array(pages, path)
    return json_arrays.read_documents(spark, path, pages.schema, range_bytes=64 << 10)


def contract_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of raw documents against the ones the entity and its contract expect."""
    documents = X.wide_documents(spark, sf_dir).select(F.to_json(F.struct("*")).alias("document"))
    expected = [*document_schema("media", WIDER_CONTRACT).names, "location"]
    return contracts.drift(documents, "document", expected)


def ingest_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same slice through the incremental file stream; the second run finds nothing new."""
    root = new_path(spark, "ingest")
    X.media_hashtag_documents(spark, sf_dir).write.json(f"{root}/raw/media_hashtag_slice")
    store = raw_store(spark, f"{root}/tables")
    for _ in range(2):
        ingest_available(
            store, "media_hashtag", f"{root}/raw", f"{root}/stage", f"{root}/checkpoint",
            LOGICAL_DATE, multi_line=False,
        )
    return store.read("media_hashtag")


def ingest_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four hours pending at once, each with a later state of the same posts."""
    root = new_path(spark, "backlog")
    event = F.col("media_id").cast("bigint")
    documents = X.media_documents(spark, sf_dir).withColumn("hour", F.pmod(event, F.lit(BACKLOG_HOURS)))
    documents = documents.withColumn("media_id", F.floor(event / BACKLOG_HOURS).cast("string"))
    for hour in range(BACKLOG_HOURS):
        pending = documents.where(F.col("hour") == hour).drop("hour")
        pending.write.json(f"{root}/raw/media_2024-02-01_0{hour}")
    store = raw_store(spark, f"{root}/tables", BUCKETS)
    ingest_available(
        store, "media", f"{root}/raw", f"{root}/stage", f"{root}/checkpoint", LOGICAL_DATE, multi_line=False
    )
    return store.read("media")


# --- quality -----------------------------------------------------------------


def _battery(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rules = Q.BATTERIES[table]
        return Q.flags(Q.verify(getattr(X, table)(spark, sf_dir), rules, table), rules)

    return query


def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.failures(Q.verify_tables(X.raw_tables(spark, sf_dir)))


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicates(X.media_hashtag(spark, sf_dir), "media_id")


def check_unique_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys of four columns, found through hashes: one of unique keys, one of NULLs besides, two of repeats."""
    columns = (("orders", "o_orderkey"), ("customer", "c_name"), ("media_hashtag", "media_id"), ("media", "media_product_type"))
    counts = []
    for table, column in columns:
        rows = getattr(X, table)(spark, sf_dir) if hasattr(X, table) else X.source(sf_dir).read(spark, table)
        found = uniqueness.repeats(rows, column, rows.count(), slot_rows=RANGE_ROWS)
        counts.append(found.select(F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"), "n"))
    return reduce(DataFrame.unionAll, counts)


def check_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = X.media_hashtag(spark, sf_dir)
    return Q.verify(posts, [Q.complete(name) for name in posts.columns], "media_hashtag")


def check_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("media_id", "user_id", "caption", "media_type")
    rules = [Q.integral(name) for name in columns]
    return Q.verify(X.media_hashtag(spark, sf_dir), rules, "media_hashtag")


def check_non_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = X.source(sf_dir).read(spark, "customer")
    rules = [Q.non_negative("c_acctbal"), Q.non_negative("c_nationkey")]
    return Q.verify(customers, rules, "customer")


def check_max_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [Q.max_length("caption", 40), Q.max_length("media_type", 5)]
    return Q.verify(X.media_hashtag(spark, sf_dir), rules, "media_hashtag")


def contract_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.project(stage_media(spark, sf_dir), MEDIA_CONTRACT)


def contract_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules a contract implies, length rules included, checked on the posts."""
    rules = Q.rules_from_contract(MEDIA_CONTRACT, with_max_length=True)
    return Q.verify(X.media(spark, sf_dir), rules, "media")


# --- loads -------------------------------------------------------------------


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier brand slice, then the current one."""
    store = raw_store(spark, new_path(spark, "tables"))
    documents = X.brand_documents(spark, sf_dir)
    store.replace("brand", S.stage_brand(documents, EARLIER_DATE), "hour-02")
    store.replace("brand", S.stage_brand(documents, LOGICAL_DATE), "hour-03")
    return store.read("brand")


def load_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts upserted with a batch that has new, known and repeated keys; batch loaded twice."""
    store = raw_store(spark, new_path(spark, "tables"), BUCKETS)
    posts = X.media(spark, sf_dir).withColumn("updated_at", F.col("ts"))
    batch = X.source(sf_dir).read(spark, "lineitem").selectExpr(
        "cast(l_orderkey as string) media_id",
        "cast(l_suppkey as string) user_id",
        "cast(l_quantity as int) like_count",
        "l_linenumber comments_count",
        "l_shipdate updated_at",
    )
    for rows in (posts, batch, batch):  # without recency, the later load wins
        newest = latest_per_key(rows, "media_id", ["updated_at"])
        store.upsert("media", newest, "media_id", keys_unique=True)
    return store.read("media").select(
        "media_id", "user_id", "like_count", "comments_count", "media_type", "updated_at"
    )


def load_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts, loaded in fifty small batches that come in no order of time; each post recurs in several."""
    store = raw_store(spark, new_path(spark, "tables"), BUCKETS)
    posts = X.order_states(spark, sf_dir).withColumn(
        "batch", F.pmod(F.xxhash64("media_id", "updated_at"), F.lit(SMALL_BATCHES))
    )
    path = new_path(spark, "batches")
    posts.repartition("batch").write.partitionBy("batch").option("maxRecordsPerFile", BATCH_FILE_ROWS).parquet(path)
    for number in range(SMALL_BATCHES):
        arrived = spark.read.schema(posts.drop("batch").schema).parquet(f"{path}/batch={number}")
        store.upsert("media", arrived, "media_id", ["updated_at"], f"batch-{number:02d}")
    return store.read("media").select("media_id", "user_id", "like_count", "comments_count", "updated_at")


def load_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of posts loaded latest first: stored rows that are more recent stay."""
    store = raw_store(spark, new_path(spark, "tables"), BUCKETS)
    posts = X.order_states(spark, sf_dir)
    middle = F.expr("timestamp_ntz'1995-01-01 00:00:00'")
    for rows in (posts.where(F.col("updated_at") >= middle), posts.where(F.col("updated_at") < middle)):
        store.upsert("media", rows, "media_id", ["updated_at"])
    return store.read("media").select("media_id", "user_id", "like_count", "comments_count", "updated_at")


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashtag posts appended as one slice per ship year, then the same slices again."""
    store = raw_store(spark, new_path(spark, "tables"))
    posts = X.media_hashtag(spark, sf_dir)
    for _ in range(2):
        store.append("media_hashtag", posts, F.date_format("created_at", "yyyy"))
    return store.read("media_hashtag")


def load_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three brand slices in the history table, one of them loaded twice."""
    store = raw_store(spark, new_path(spark, "tables"))
    documents = X.brand_documents(spark, sf_dir)
    hours = {"hour-02": EARLIER_DATE, "hour-03": LOGICAL_DATE, "hour-04": "2024-02-01T04:00:00+00:00"}
    for slice_id in ("hour-02", "hour-03", "hour-03", "hour-04"):
        store.append("brand_log", S.stage_brand(documents, hours[slice_id]), slice_id)
    return store.read_slices("brand_log").select(
        "user_id", "tag_name", "followers_count", "created_at", "load_slice"
    )


def load_append_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices by ship year; a second load corrects all of them, and those of odd years have become empty."""
    store = raw_store(spark, new_path(spark, "tables"))
    posts = X.media_hashtag(spark, sf_dir)
    year = F.date_format("created_at", "yyyy")
    store.append("media_hashtag", posts, year)
    years = [row[0] for row in posts.select(year).distinct().collect()]
    even = posts.where(F.year("created_at") % 2 == 0)
    store.append("media_hashtag", even, year, slices=years)
    return store.read_slices("media_hashtag").select("media_id", "caption", "created_at", "load_slice")


# --- marts by the hour -------------------------------------------------------


def incremental_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates per tag from the states of four slices, in which a third of the posts also have an older version."""
    store = RawStore(spark, new_path(spark, "tables"), {**RAW_TABLES, **I.STATE_TABLES}, BUCKETS)
    event = F.col("media_id").cast("bigint")
    final = X.media(spark, sf_dir).withColumns(
        {"updated_at": F.expr("timestamp_ntz'2024-02-02 00:00:00'"), "slice": F.pmod(event, F.lit(4))}
    )
    older = final.where(event % 3 == 0).withColumns(
        {
            "updated_at": F.expr("timestamp_ntz'2024-02-01 00:00:00'"),
            "slice": F.pmod(event + 1, F.lit(4)),
            "like_count": F.col("like_count") + 5,
            "user_id": F.lit("1"),
            "media_product_type": F.lit("FEED"),
        }
    )
    versions = materialize(final.unionByName(older), "versions").frame
    brands = M.brand_lookup(X.brand(spark, sf_dir))
    for number in (0, 1, 1, 2, 3):  # one of them repeated
        I.load_with_rates(store, versions.where(F.col("slice") == number), brands, f"hour-{number}")
    return I.merged_rates(store.read(I.RATE_STATES))


def incremental_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct posts per tag from the bits of 24 slices, in which posts recur."""
    store = RawStore(spark, new_path(spark, "tables"), I.STATE_TABLES)
    search = hashtag_search(spark, sf_dir)
    hour = F.pmod(F.xxhash64("media_id", "caption", "created_at"), F.lit(24)).cast("string")
    states = I.reach_state(search.withColumn("hour", hour), "hour")
    store.append(I.REACH_STATES, states, F.col("hour"))
    return I.merged_reach(store.read(I.REACH_STATES))


# --- ranking -----------------------------------------------------------------


def distributed_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level ranks over three orders: many values, heavy ties, ascending."""
    items = X.source(sf_dir).read(spark, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey"
    )
    ranks = [
        Rank("l_extendedprice", "rank_price"),
        Rank("l_quantity", "rank_quantity"),
        Rank("l_partkey", "rank_part", descending=False),
    ]
    return add_ranks(items, ranks, rows_per_range=RANGE_ROWS)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        brand_basic_info,
        feed_reels_filter,
        brand_information,
        followers_growth,
        hashtag_search,
        trending_topics,
        hashtag_count,
        hashtag_topk,
        hashtag_count_canonical,
        aggregated_brand_information,
        aggregated_hashtag_search,
        popularity_factor_early_stage,
        popularity_factor,
        popularity_calculation,
        brand_media_post_time,
        publish_mart,
        mart_row_counts,
        scan_raw_tables,
        json_decode,
        stage_brand,
        stage_media,
        stage_media_hashtag,
        stage_roundtrip,
        slice_inventory,
        slice_filter,
        etl_media,
        etl_contract_columns,
        json_array_split,
        contract_drift,
        ingest_available_now,
        ingest_backlog,
        quality_failures,
        check_unique,
        check_unique_hashed,
        check_complete,
        check_integral,
        check_non_negative,
        check_max_length,
        contract_projection,
        contract_rules,
        load_replace,
        load_upsert,
        load_upsert_batches,
        load_upsert_late,
        load_append,
        load_append_corrected,
        load_log_append,
        incremental_rates,
        incremental_reach,
        distributed_rank,
    )
} | {f"quality_{table}": _battery(table) for table in Q.BATTERIES} | {f"elt_gated_{mart}": _gated(mart) for mart in GATED}
