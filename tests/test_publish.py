import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from engagemart.scratch import new_path
from engagemart.sinks import log
from engagemart.sinks.log import CommitConflict, CommitLog
from engagemart.sinks.publish import TableStore, publish, publish_all


def store(spark):
    return TableStore(spark, new_path(spark, "test-marts"))


def test_publish_replaces(spark, rows):
    s = store(spark)
    publish(s, "t", spark.range(3), "r1")
    publish(s, "t", spark.range(5, 7), "r2")
    assert rows(s.read("t")) == [(5,), (6,)]


def test_repeated_run_does_not_add_rows(spark):
    s = store(spark)
    for _ in range(2):
        publish(s, "t", spark.range(3), "r1")
    assert s.read("t").count() == 3
    assert s.superseded().count() == 1


def test_a_table_can_be_rebuilt_from_itself(spark, rows):
    s = store(spark)
    publish(s, "t", spark.range(2), "r1")
    publish(s, "t", s.read("t").selectExpr("id + 10 id"), "r2")
    assert rows(s.read("t")) == [(10,), (11,)]


def test_nothing_is_visible_before_commit(spark):
    s = store(spark)
    publish_all(s, {"a": spark.range(1), "b": spark.range(1)}, "r1")
    run = s.run("r2")
    run.write("a", spark.range(9))
    assert s.read("a").count() == 1
    with pytest.raises(Exception):
        run.write("b", spark.sql("select raise_error('broken') id"))
    assert {name: df.count() for name, df in s.read_all(["a", "b"]).items()} == {"a": 1, "b": 1}


def test_missing_table(spark):
    with pytest.raises(LookupError):
        store(spark).read("nothing")


def test_empty_table(spark):
    s = store(spark)
    publish(s, "t", spark.range(0), "r1")
    assert s.read("t").count() == 0 and s.read("t").columns == ["id"]


def test_expire_removes_only_old_replaced_versions(spark):
    s = store(spark)
    for n in (1, 2, 3):
        publish(s, "t", spark.range(n), f"r{n}")
    publish(s, "other", spark.range(4), "r3")
    before_third = s.log().where("run_id = 'r3'").agg(F.min("published_at")).first()[0]
    old = s.superseded().collect()
    assert s.expire(before_third) == 1
    assert (s.read("t").count(), s.read("other").count()) == (3, 4)
    left = [row.path for row in old if os.path.exists(row.path.removeprefix("file:"))]
    assert len(old) == 2 and len(left) == 1
    assert s.expire(datetime.now() + timedelta(days=2)) == 1
    assert (s.read("t").count(), s.read("other").count()) == (3, 4)


def test_parts_are_replaced_one_by_one(spark, rows):
    s = store(spark)
    df = spark.range(6).selectExpr("id", "cast(id % 3 as int) part")
    schema = df.select("id").schema
    assert rows(s.read_parts("t", schema)) == []
    run = s.run("r1")
    run.write_parts("t", df, "part", [0, 1, 2])
    assert rows(s.read_parts("t", schema)) == []
    run.commit()
    run = s.run("r2")
    run.write_parts("t", df.where("part = 1").withColumn("id", -df.id), "part", [1])
    run.commit()
    assert rows(s.read_parts("t", schema)) == sorted([(0,), (3,), (-1,), (-4,), (2,), (5,)], key=repr)
    assert rows(s.read_parts("t", schema, [1, 7])) == [(-1,), (-4,)]
    assert s.superseded().first().table_name == "t/1"


def test_of_two_writers_one_is_refused(spark):
    s = store(spark)
    publish(s, "t", spark.range(1), "r0")
    first, second, other = s.run("r1"), s.run("r2"), s.run("r3")
    for run, name, n in ((first, "t", 2), (second, "t", 3), (other, "elsewhere", 4)):
        run.write(name, spark.range(n))
    first.commit()
    with pytest.raises(CommitConflict, match="t"):
        second.commit()
    other.commit()  # not in the way of the first
    assert (s.read("t").count(), s.read("elsewhere").count()) == (2, 4)


def test_a_number_is_taken_once(spark):
    commits = CommitLog(spark, new_path(spark, "log"))
    content = {"run_id": "", "put": {"a": {"path": "x"}}, "drop": [], "forget": [], "published_at": 1}
    assert commits._put_if_absent(1, ".json", content)
    assert not commits._put_if_absent(1, ".json", {**content, "put": {}})
    assert list(commits.state().entries) == ["a"]
    assert commits.commit({"b": {"path": "y"}}).version == 2


def test_readers_open_one_snapshot_and_its_tail(spark, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 5)
    commits = CommitLog(spark, new_path(spark, "log"))
    for n in range(13):
        commits.commit({f"t{n % 3}": {"path": f"p{n}"}}, drop=["gone"] if n == 4 else [], run_id=str(n))
    opened = []
    read = CommitLog._read
    monkeypatch.setattr(CommitLog, "_read", lambda self, version, ending: opened.append((version, ending)) or read(self, version, ending))
    state = commits.state()
    assert opened == [(10, ".snapshot"), (11, ".json"), (12, ".json"), (13, ".json")]
    assert {name: entry["path"] for name, entry in state.entries.items()} == {"t0": "p12", "t1": "p10", "t2": "p11"}
    assert len(state.replaced) == 10
    assert commits.trim(2**62) == 10  # nine commits and the first snapshot
    assert commits.state().entries == state.entries


def test_sweep_removes_what_never_committed(spark):
    s = store(spark)
    publish(s, "t", spark.range(3), "r1")
    publish(s, "t", spark.range(2), "r2")
    s.run("r3").write("t", spark.range(9))
    assert s.sweep(datetime.now() - timedelta(days=2)) == 0
    assert s.sweep(datetime.now() + timedelta(days=2)) == 1
    assert s.read("t").count() == 2 and s.superseded().count() == 1
