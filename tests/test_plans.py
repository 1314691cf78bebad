"""What the physical plans must and must not contain."""

import pytest
import raw

from __spark_entry__ import entry, oracle_sql, queries
from engagemart.oracle import ORACLE_SQL
from engagemart.plans import marts as M
from engagemart.queries import QUERIES

SF = "/root/testdata/sf0.001"
LAZY = [
    "brand_information", "followers_growth", "hashtag_search", "trending_topics", "hashtag_count",
    "aggregated_brand_information", "aggregated_hashtag_search", "stage_brand", "stage_media",
    "quality_media", "distributed_rank", "check_integral",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_in_the_plan(spark, plan, name):
    text = plan(queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_mart_scan_is_filtered_and_pruned(spark, plan):
    text = plan(queries()["feed_reels_filter"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in text


def test_fact_marts_do_not_shuffle_facts(spark, plan):
    for name in ("brand_information", "followers_growth"):
        assert "hashpartitioning" not in plan(queries()[name](spark, SF))


def test_hashtag_count_needs_no_brand_join(spark, plan):
    assert "supplier" not in plan(queries()["hashtag_count"](spark, SF))


def test_distinct_count_spreads_hot_groups(spark, plan):
    text = plan(queries()["aggregated_hashtag_search"](spark, SF))
    assert "hashpartitioning(tag_name#" in text and "media_id#" in text.split("hashpartitioning(", 2)[-1]


def test_raw_scan_gets_the_filter_and_only_needed_columns(spark, plan, tmp_path):
    raw.media(spark).write.parquet(str(tmp_path / "media"))
    media = spark.read.parquet(str(tmp_path / "media"))
    text = plan(M.brand_information(media, M.brand_lookup(raw.brand(spark))))
    assert "PushedFilters: [In(media_product_type, [FEED,REELS])]" in text
    read = next(line for line in text.splitlines() if "FileScan" in line)
    assert "like_count" in read and "del_yn" not in read and "created_at" not in read


def test_partitioned_writes_bring_slices_together(spark, plan):
    rows = spark.range(10).selectExpr("id", "id % 3 load_slice")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(rows.hint("rebalance", "load_slice"))


def test_entry(spark):
    assert entry(spark).columns == ["tag_name", "sum_rank", "popularity_rank"]


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(oracle_sql()) <= set(queries())
