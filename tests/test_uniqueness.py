import pytest
from pyspark.sql import functions as F

from engagemart.operators import quality as Q
from engagemart.operators import uniqueness as U


def frame(spark, values, kind, parts=4):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}").repartition(parts)


@pytest.mark.parametrize(
    "values, kind, expected",
    [
        ([], "string", []),
        ([None, None], "string", []),
        (["a", "b", "", None], "string", []),
        (["a", "a", "", "", "", "b", None, None], "string", [("", 3), ("a", 2)]),
        ([0.0, -0.0, 1.5, None], "double", [(0.0, 2)]),
        ([2**62, 2**62, -(2**63), 2**62 + 1], "bigint", [(2**62, 2)]),
    ],
)
@pytest.mark.parametrize("most", [0, 10_000])
def test_repeats(spark, values, kind, expected, most):
    for parts in (1, 4):
        found = U.repeats(frame(spark, values, kind, parts), "c", 8, most, slot_rows=2).collect()
        assert sorted(("nan" if r.c != r.c else r.c, r.n) for r in found) == sorted(expected)


def test_hot_value_and_unique_keys(spark):
    """A third of all rows share one value; all others are unique but for two pairs."""
    ids = spark.range(0, 60_000, 1, 12).withColumn("c", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    ids = ids.withColumn("c", F.when(F.col("id") == 1, 2).when(F.col("id") == 59_999, 4).otherwise(F.col("c")))
    found = {r.c: r.n for r in U.repeats(ids, "c", 60_000, slot_rows=4_000).collect()}
    assert found == {-1: 20_000, 2: 2, 4: 2}


def test_suspects_of_unique_keys_are_few(spark, tmp_path):
    spark.range(0, 300_000, 1, 6).select(F.col("id").cast("string").alias("c")).write.parquet(str(tmp_path / "t"))
    keys = spark.read.parquet(str(tmp_path / "t"))
    # about ten chance meetings of 300,000 random 32-bit numbers, and at most 1,001 cells that might be frequent
    assert U.suspects(keys, "c", 1).count() < 1_200
    assert U.suspects(keys, "c", 64).count() < 1_200
    assert U.repeats(keys, "c", 300_000, slot_rows=5_000).count() == 0


def test_rule_on_large_tables(spark, monkeypatch, tmp_path, rows):
    monkeypatch.setattr(Q, "LARGE_ROWS", 3)
    df = frame(spark, ["a", "a", "b", "b", "c", None], "string")
    small = Q.verify(df, [Q.unique("c"), Q.complete("c")], "t")
    large = Q.verify(df, [Q.unique("c"), Q.complete("c")], "t", rows=6)
    written = Q.verify_written(df, [Q.unique("c"), Q.complete("c")], "t", str(tmp_path / "w"))
    assert rows(small) == rows(large) == rows(written)
    assert Q.failures(large).count() == 2
