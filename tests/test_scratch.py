from types import SimpleNamespace

import pytest

from engagemart import scratch
from engagemart.schemas import BUCKET_LAYOUT


def session(master, folder=None, checkpoint=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
    )


def test_the_session_names_the_folder():
    assert scratch.shared_folder(session("yarn", "s3://shared/x")) == "s3://shared/x"
    assert scratch.shared_folder(session("yarn", None, "hdfs:/y")) == "hdfs:/y"
    assert scratch.new_path(session("yarn", "/x/"), "a").startswith("/x/engagemart/a-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch.shared_folder(session("yarn"))
    first = scratch.shared_folder(session("local[2]"))
    assert first == scratch.shared_folder(session("local[2]"))


def test_materialize_keeps_schema_and_counts(spark):
    written = scratch.materialize(spark.range(5).selectExpr("id", "cast(null as string) s"), "t")
    assert written.rows == 5 and written.frame.columns == ["id", "s"]
    empty = scratch.materialize(spark.range(0), "t")
    assert empty.rows == 0 and empty.frame.collect() == []


def test_literal_rows(spark):
    values = [{"key": f"a'\"\\n{i}", "buckets": i} for i in range(5000)] + [{"key": None, "buckets": None}]
    got = scratch.literal_rows(spark, values, BUCKET_LAYOUT)
    assert [r.asDict() for r in got.collect()] == values
    assert scratch.literal_rows(spark, [], BUCKET_LAYOUT).count() == 0
