"""The shared test tables mapped onto raw tables and raw documents.

suppliers stand in for brands, events for posts, line items with parts for hashtag
posts and orders for the follower history. Every mapping covers its whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engagemart.sources.tables import TableSource

#: Text of an array file at which a producer begins the next.
ARRAY_BYTES = 256 << 20


def source(sf_dir: str) -> TableSource:
    return TableSource(f"{sf_dir}/{{table}}.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return source(sf_dir).read(spark, name)


def brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as string) user_id",
        "lower(s_name) user_name",
        "regexp_replace(lower(s_name), 'supplier|#', '') tag_name",
        "concat('https://img.example/', cast(s_suppkey as string)) profile_picture_url",
        "cast(greatest(0, floor(s_acctbal)) as int) followers_count",
        "cast(s_nationkey as int) media_count",
        "timestamp_ntz'2024-02-01 00:00:00' updated_at",
    )


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "cast(event_id as string) media_id",
        "cast(user_id as string) user_id",
        "cast(floor(value) as int) like_count",
        "cast(floor(value * 3) as int) % 40 comments_count",
        "ts",
        "case when event_id % 3 = 0 then 'VIDEO' else 'IMAGE' end media_type",
        """case event_type when 'view' then 'FEED' when 'click' then 'REELS'
           when 'signup' then 'STORY' when 'error' then 'AD' end media_product_type""",
    )


def media_hashtag(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, parts = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "part")
    return items.join(parts, items.l_partkey == parts.p_partkey, "left").selectExpr(
        "cast(l_orderkey as string) media_id",
        "cast(l_suppkey as string) user_id",
        """case when l_linenumber = 7 then null when l_linenumber = 6 then ''
           else concat(l_returnflag, ' #', p_type, '##', replace(p_name, ' ', '#'), ' # ', p_brand)
           end caption""",
        "l_shipdate ts",
        "'IMAGE' media_type",
        "l_shipdate created_at",
    )


def brand_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey % 120 as string) user_id",
        "cast(floor(o_totalprice) as int) followers_count",
        "o_orderdate created_at",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    builders = (brand, media, media_hashtag, brand_log)
    return {build.__name__: build(spark, sf_dir) for build in builders}


def brand_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = "replace(lower(s_name), '#', '')"
    user_name = (
        f"concat(case when s_nationkey % 2 = 0 then 'maison' else '' end, {plain}, "
        "case when s_nationkey % 3 = 0 then 'official' else '' end)"
    )
    return _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey user_id",
        f"{user_name} user_name",
        """case when s_nationkey % 5 = 0 then '' when s_nationkey % 7 = 0 then null
           else upper(s_name) end name""",
        "concat('https://img.example/', cast(s_suppkey as string)) profile_picture_url",
        "cast(greatest(0, floor(s_acctbal)) as int) followers_count",
        "cast(s_nationkey as int) media_count",
    )


def media_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = media(spark, sf_dir)
    wall = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return posts.selectExpr(
        "media_id",
        "user_id",
        f"""case when cast(media_id as bigint) % 10 = 0 then 'bad'
            when media_type = 'VIDEO' then concat({wall}, '+0900')
            else concat({wall}, 'Z') end timestamp""",
        "like_count",
        "comments_count",
        "media_type",
        "media_product_type",
    )


def media_hashtag_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    wall = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return media_hashtag(spark, sf_dir).selectExpr(
        "media_id", "user_id", "caption", f"concat({wall}, 'Z') timestamp", "media_type"
    )


def order_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as states of one post per order, each with its own time."""
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) media_id",
        "cast(l_suppkey as string) user_id",
        "cast(l_quantity as int) like_count",
        "cast(l_linenumber as int) comments_count",
        "l_shipdate updated_at",
    )


def wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with fields that no fixed schema names: two that a contract may, one that none does."""
    return media_documents(spark, sf_dir).selectExpr(
        "*",
        """concat('p"[{', media_id) shortcode""",
        "cast(media_id as bigint) * 7 view_count",
        "if(like_count > 20, media_type, null) campaign",
    )


def write_array(df: DataFrame, path: str, file_bytes: int = ARRAY_BYTES) -> None:
    """All rows as indented JSON, a field a line, as upstream producers write it: one file that is one array.

    Beyond ``file_bytes`` of text a producer begins the next file, also an array, so no task writes more than that or
    than a partition of ``df``. Rows pass one after the other and are not sorted.
    """
    rows = df.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    size = rows.agg(F.sum(F.octet_length("value"))).first()[0] or 0

    def array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # commas close all documents but the last
        yield pa.RecordBatch.from_pydict({"value": ["["]})
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                values = batch.column(0).slice(first, 1000).to_pylist()
                given = [f"{value}," for value in ([] if last is None else [last]) + values[:-1]]
                last = values[-1]
                yield pa.RecordBatch.from_pydict({"value": pa.array(given, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": ["]"] if last is None else [last, "]"]})

    rows.coalesce(max(1, -(-size // file_bytes))).mapInArrow(array, "value string").write.text(path)
