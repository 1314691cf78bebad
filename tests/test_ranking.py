import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from engagemart.operators.ranking import Rank, add_ranks, rankable
from engagemart.scratch import materialize


def both_ways(df, column):
    ranks = [Rank(column, "down"), Rank(column, "up", descending=False)]
    got = add_ranks(df, ranks, rows_per_range=7).select("id", "down", "up")
    want = df.select(
        "id",
        F.rank().over(Window.orderBy(F.col(column).desc_nulls_last())).cast("bigint"),
        F.rank().over(Window.orderBy(F.col(column).asc_nulls_first())).cast("bigint"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def frame(spark, values, kind):
    df = spark.createDataFrame(list(enumerate(values)), f"id bigint, v {kind}")
    return materialize(df, "rank-test").frame


numbers = st.one_of(st.none(), st.integers(-5, 5), st.integers(-(2**31), 2**31 - 1))
doubles = st.one_of(
    st.none(), st.sampled_from([0.0, -0.0, 1.5, math.inf, -math.inf, math.nan, 5e-324]), st.floats(-100, 100)
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(numbers, max_size=120))
def test_integers_match_window_rank(spark, values):
    both_ways(frame(spark, values, "int"), "v")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(doubles, max_size=120))
def test_doubles_match_window_rank(spark, values):
    both_ways(frame(spark, values, "double"), "v")


@pytest.mark.parametrize(
    "values",
    [[], [1], [None] * 40, [7] * 40, [2**53 + i for i in range(40)] * 2, [-(2**60) + i % 3 for i in range(60)]],
)
def test_edge_cases(spark, values):
    both_ways(frame(spark, values, "bigint"), "v")


def test_decimals(spark):
    from decimal import Decimal

    values = [Decimal(2**53 + i % 5).scaleb(-2) for i in range(60)]
    both_ways(frame(spark, values, "decimal(38,2)"), "v")


def test_hot_value_is_split(spark):
    """A third of the rows share one value, another third are NULL."""
    values = [5 if i % 3 == 0 else None if i % 3 == 1 else i for i in range(3000)]
    df = frame(spark, values, "int")
    ranked = add_ranks(df, [Rank("v", "r")], rows_per_range=100)
    want = df.select("id", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("r"))
    assert sorted(map(tuple, ranked.select("id", "r").collect())) == sorted(map(tuple, want.collect()))


def test_no_single_partition_on_the_data_path(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    ranks = [Rank("l_extendedprice", "a"), Rank("l_quantity", "b")]
    text = plan(add_ranks(df, ranks, rows_per_range=500))
    assert "SinglePartition" not in text
    assert text.count("FileScan") == 1


def test_small_frames_use_the_plain_window(spark, plan):
    df = spark.createDataFrame([(1,)], "v int")
    assert "Window" in plan(add_ranks(df, [Rank("v", "r")], max_rows=1))


def test_only_numbers(spark):
    df = spark.createDataFrame([("a",)] * 3, "v string")
    with pytest.raises(TypeError):
        add_ranks(df, [Rank("v", "r")], rows_per_range=1)


def test_rankable(spark):
    df = spark.range(10)
    assert rankable(df, 10, "x") == (df, 10)
    written, rows = rankable(df, 10**9, "x")
    assert rows == 10 and written is not df
