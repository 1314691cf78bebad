import random

import pytest
from pyspark.sql import functions as F

from engagemart.__main__ import parse
from engagemart.sources import splits
from engagemart.sources.tables import PlannedSplit, TableSource


def counts(spark, values, partitions):
    """Rows per planned predicate; Spark stands in for the database."""
    spark.createDataFrame([(v,) for v in values], "k bigint").coalesce(2).createOrReplaceTempView("split_me")
    queries = []

    def run(query):
        queries.append(query)
        return spark.sql(query).collect()

    predicates = splits.plan(run, "split_me", "k", partitions)
    table = spark.table("split_me")
    row = table.agg(*[F.count_if(F.expr(p)).alias(f"p{n}") for n, p in enumerate(predicates)]).first()
    assert sum(row) == len(values), predicates  # every row once
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    assert table.where(hits != 1).count() == 0
    return list(row), predicates, queries


@pytest.mark.parametrize("values", [[], [None, None], [5], [5, None], [-3, -3, -3], [0, 10**18, -(10**18), None]])
def test_small_tables(spark, values):
    counts(spark, values, 4)


def test_skewed_values(spark):
    r = random.Random(1)
    # nine tenths lie in a millionth of the range
    values = [r.randrange(10**12) for _ in range(400)] + [500_000_000 + r.randrange(10**6) for _ in range(3600)]
    rows, predicates, queries = counts(spark, values, 8)
    assert max(rows) <= 4000 / 8 and len(predicates) <= 17
    plain = [sum(n * 10**12 // 8 <= v < (n + 1) * 10**12 // 8 for v in values) for n in range(8)]
    assert max(plain) > 3600 and len(queries) < 60


def test_one_heavy_value(spark):
    rows, _, _ = counts(spark, [7] * 900 + list(range(1000, 2000)) + [None] * 50, 10)
    assert sorted(rows)[-1] >= 900 and sorted(rows)[-2] <= 200


def test_reads_by_predicates(monkeypatch, spark):
    asked = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    monkeypatch.setattr("engagemart.sources.tables.planned.plan", lambda run, table, column, n: [f"{table} {column} {n}"])
    source = TableSource("raw.{table}", "jdbc", {"url": "u", "driver": "d"}, {"media": PlannedSplit("media_id", 3)})
    source.read(Session(), "media")
    assert asked == {"url": "u", "table": "raw.media", "predicates": ["raw.media media_id 3"], "properties": {"driver": "d"}}
    with pytest.raises(ValueError):
        TableSource("raw.{table}", "connector", {}, {"media": PlannedSplit("media_id", 3)}).read(spark, "media")


def test_command_line():
    base = ["elt", "--source", "raw.{table}", "--format", "jdbc", "--marts", "m", "--run-id", "r"]
    args = parse([*base, "--split", "media=id:64", "--split", "brand_log=log:id:8"])
    assert dict(args.split) == {"media": PlannedSplit("id", 64), "brand_log": PlannedSplit("log:id", 8)}
    for wrong in ("media", "media=id", "media=id:0", "media=:4"):
        with pytest.raises(SystemExit):
            parse([*base, "--split", wrong])
