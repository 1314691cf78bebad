"""Large JSON files cut by many tasks, against the whole-file parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from engagemart import fixtures
from engagemart.schemas import text_documents
from engagemart.sources import json_arrays as J
from engagemart.sources import slices


def _value(r, depth=0):
    kind = r.randint(0, 6 if depth < 3 else 4)
    if kind == 0:
        return r.randint(-5, 10**6)
    if kind in (1, 2):
        return "".join(r.choice('ab"\\{}[],: \né\U0001f600') for _ in range(r.randint(0, 12)))
    if kind in (3, 4):
        return r.choice([None, True, "", "\\", '\\"'])
    if kind == 5:
        return [_value(r, depth + 1) for _ in range(r.randint(0, 3))]
    return {f"k{n}" + r.choice(["", '"', "\\"]): _value(r, depth + 1) for n in range(r.randint(0, 3))}


def _cut(text, size, monkeypatch):
    data = text.encode()
    count = max(1, -(-len(data) // size))
    monkeypatch.setattr(J, "_read", lambda path, start, length: data[start : start + length])
    starts = J.combine([J.summarise(data[n * size : (n + 1) * size]) for n in range(count)])
    rows = [
        {"path": "x", "number": n, "state": s[0], "nesting": s[1], "array": s[2], "last": count - 1}
        for n, s in enumerate(starts)
    ]
    return [json.loads(text) for row in rows for text in J._documents_of(row, size)]


@pytest.mark.parametrize("seed", range(40))
def test_documents_are_cut_wherever_ranges_end(seed, monkeypatch):
    r = random.Random(seed)
    documents = [{"id": n, "v": _value(r)} for n in range(r.randint(0, 5))]
    plain = r.random() < 0.5
    indented = [json.dumps(d, indent=r.choice([None, 2]), ensure_ascii=plain) for d in documents]
    texts = [
        r.choice(["", "\n "]) + json.dumps(documents, indent=r.choice([None, 2]), ensure_ascii=plain) + r.choice(["", " \n"]),
        "\n".join(indented),
        "".join(indented),
    ]
    for text in texts:
        for size in (2, 5, 33, 1000):
            assert _cut(text, size, monkeypatch) == documents


def test_odd_backslashes_at_a_range_end(monkeypatch):
    documents = [{"a": "\\" * n + '"', "b": n} for n in range(6)]
    for size in range(1, 40):
        assert _cut(json.dumps(documents), size, monkeypatch) == documents


def _media(n):
    return {"media_id": str(n), "user_id": "7", "like_count": n, "media_type": 'IM"A{[\\GE', "more": {"x": [1, "]}"]}}


def test_one_file_is_read_by_many_tasks(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([_media(n) for n in range(2000)], indent=2))
    (tmp_path / "b.json").write_text("\n".join(json.dumps(_media(n)) for n in range(2000, 2100)))
    (tmp_path / "c.json").write_text(" \n")
    schema = text_documents("media")
    got = J.read_documents(spark, str(tmp_path), schema, range_bytes=4000)
    whole = spark.read.schema(schema).option("multiLine", True).json(str(tmp_path / "a.json"))
    lines = spark.read.schema(schema).json(str(tmp_path / "b.json"))
    assert rows(got) == rows(whole.unionAll(lines))
    parts = J.json_documents(spark, str(tmp_path), 4000).select(F.spark_partition_id().alias("p"), "path")
    assert parts.where(F.col("path").endswith("a.json")).select("p").distinct().count() > 4


def test_arrays_are_written_by_many_tasks(spark, rows, tmp_path):
    documents = spark.range(0, 3000, 1, 12).selectExpr("id", "concat('a\"]},[\\n', id) text", "if(id % 2 = 0, id, null) even")
    counts = {}
    for size in (1 << 30, 20_000, 1):
        path = str(tmp_path / str(size))
        fixtures.write_array(documents, path, size)
        arrays = [json.loads(file.read_text()) for file in (tmp_path / str(size)).glob("part-*")]
        counts[size] = len(arrays)
        assert sorted(d["id"] for array in arrays for d in array) == list(range(3000))
        assert rows(J.read_documents(spark, path, documents.schema, range_bytes=4000)) == rows(documents)
    assert counts[1 << 30] == 1 and counts[20_000] > 4 and counts[1] == 12
    fixtures.write_array(documents.where("id < 0"), str(tmp_path / "none"))
    assert [json.loads(file.read_text()) for file in (tmp_path / "none").glob("part-*")] == [[]]


def test_split_slices_of_nothing_fail(spark, tmp_path):
    with pytest.raises(slices.EmptySliceError):
        slices.read_slice(spark, str(tmp_path / "none"), text_documents("media"), split=True)
    (tmp_path / "empty").mkdir()
    with pytest.raises(slices.EmptySliceError):
        slices.read_slice(spark, str(tmp_path / "empty"), text_documents("media"), split=True)
