import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from engagemart.schemas import RAW_DOCUMENTS
from engagemart.sinks import tables as sinks
from engagemart.sources import slices
from engagemart.sources.tables import Split, TableSource, read_tables

BRAND = dict(user_id=1, user_name="maisonexample", name="", profile_picture_url="u", followers_count=10, media_count=2)


def test_slice_name():
    when = datetime(2024, 2, 1, 3)
    assert slices.slice_name("media", when) == "media_2024-02-01/media_2024-02-01_03"
    assert slices.slice_name("media", when, "%Y%m%d%H") == "media_2024-02-01/media_2024020103"


def test_multi_line_documents(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([BRAND, BRAND | {"user_id": 2}], indent=2))
    (tmp_path / "b.json").write_text(json.dumps(BRAND | {"user_id": 3, "unknown": {"x": 1}}, indent=2))
    df = slices.read_slice(spark, str(tmp_path), RAW_DOCUMENTS["brand"])
    assert rows(df, "user_id", "name") == [(1, ""), (2, ""), (3, "")]
    inventory = slices.slice_inventory(df).first()
    assert (inventory.rows, inventory.files) == (3, 2)
    copied = slices.copy_slice(spark, str(tmp_path), str(tmp_path / "copy"), RAW_DOCUMENTS["brand"])
    assert rows(copied) == rows(df)


@pytest.mark.parametrize("missing", [True, False])
def test_empty_slice_fails(spark, tmp_path, missing):
    path = tmp_path / "slice"
    if not missing:
        path.mkdir()
    with pytest.raises(slices.EmptySliceError):
        slices.read_slice(spark, str(path), RAW_DOCUMENTS["brand"])


def test_decode_json(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "{}"), (3, None), (4, "broken")], "id int, props string")
    got = {r.id: r.k for r in slices.decode_json(df, "props", "k int").collect()}
    assert got == {1: 5, 2: None, 3: None, 4: None}


def test_slice_filter_prunes_directories(spark, plan, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    days = events.where("ts < timestamp_ntz'2024-01-03 00:00:00'")
    slices.write_partitioned(days, str(tmp_path / "t"), "ts")
    hour = spark.read.parquet(str(tmp_path / "t")).where("ds = date'2024-01-02' and hh = 5")
    assert "PartitionFilters: [isnotnull(ds" in plan(hour)
    want = days.where((F.to_date("ts") == "2024-01-02") & (F.hour("ts") == 5)).count()
    assert hour.count() == want


def test_read_tables(spark):
    got = read_tables(spark, TableSource("/root/testdata/sf0.001/{table}.parquet"), ["supplier", "nation"])
    assert got["supplier"].count() == 10 and got["nation"].count() == 25


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("raw_brand")
    assert TableSource("raw_{table}", "table").read(spark, "brand").count() == 3


def test_jdbc_options():
    source = TableSource(
        "raw_data.{table}", "jdbc", {"url": "jdbc:x", "driver": "d"},
        {"media": Split("id", "0", "1000", 50)},
    )
    assert source.reader_options("brand") == {"url": "jdbc:x", "driver": "d", "dbtable": "raw_data.brand"}
    assert source.reader_options("media") == {
        "url": "jdbc:x", "driver": "d", "dbtable": "raw_data.media", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "50",
    }
    assert sinks.jdbc_options("jdbc:x", "analytics.t", "d", connections=4)["numPartitions"] == "4"


def test_warehouse_target_options(monkeypatch):
    calls = []
    monkeypatch.setattr(sinks, "write_table", lambda df, fmt, options, truncate: calls.append((fmt, options, truncate)))
    sinks.TableTarget("analytics.{table}", "jdbc", {"url": "jdbc:x"}).write(None, "brand_information")
    sinks.TableTarget("{table}", "connector", {"schema": "ANALYTICS"}, truncate=False).write(None, "t")
    assert calls == [
        ("jdbc", {"url": "jdbc:x", "dbtable": "analytics.brand_information"}, True),
        ("connector", {"schema": "ANALYTICS", "dbtable": "t"}, False),
    ]


def test_write_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.write_table(spark.range(4), "parquet", {"path": path}, truncate=True)
    assert spark.read.parquet(path).count() == 4
    sinks.write_staging(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
