"""The pipeline's stages against their plain versions on the smallest tables, and the SQL of the operators."""

import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from engagemart.llm import common, mixing
from engagemart.llm.oracle import ORACLE_SQL
from engagemart.llm.packing import CAPACITY
from engagemart.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def test_stages_follow_one_another(spark):
    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).cache()
        before = [(r.doc_id, r.text) for r in docs.collect()]
        if k < 4:
            columns = columns or docs.columns
            assert out.columns == columns
            ids = sorted(r.doc_id for r in out.collect())
        if k == 1:
            assert ids == [r[0] for r in brute.exact(before) if r[3]]
        if k == 2:
            assert ids == [r[0] for r in brute.near(before) if r[0] == r[2]]
        if k == 4:
            assert out.select("doc_id").distinct().count() == len({i for i, _ in before})
        docs = out
    assert docs.count() > 0


def test_all_stages_and_run_on_repeated_rows(spark, nasty, tmp_path):
    rows = [(i, t, "ab"[i % 2]) for i, t in nasty]
    rows += [*rows[:9], *rows[30:45], *rows[30:35], (None, " ".join(f"n{k}" for k in range(40)), "a")]
    sf = str(tmp_path)
    columns = "doc_id bigint, text string, source string"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")

    def ready(stage, docs):  # what run() writes after each stage
        return corpus_pipeline.written(stage(spark, docs, sf), "test")

    def held(docs):
        return Counter((r.doc_id, r.text) for r in docs.collect())

    quality, exact, near, mix, pack = (stage for _, stage in corpus_pipeline.STAGES)
    docs, texts, none = spark.read.parquet(f"{sf}/documents.parquet"), dict(nasty) | {None: rows[-1][1]}, 10**6
    good = ready(quality, docs)
    counted = [(i, t, brute.counts(t)) for i, t, _ in rows]
    assert held(good) == Counter((i, t) for i, t, c in counted if c[0] >= 20 and 100 * c[4] <= 30 * c[0])
    assert max(held(good).values()) > 1
    distinct = [(none if i is None else i, t) for i, t in held(good)]
    one = ready(exact, good)
    kept = [r[0] for r in brute.exact(distinct) if r[3]]
    assert held(one) == Counter((None if i == none else i, texts[None if i == none else i]) for i in kept)
    distinct = [(none if i is None else i, t) for i, t in held(one)]
    wanted = Counter((None if i == none else i, texts[None if i == none else i]) for i, _, c in brute.near(distinct) if i == c)
    apart = ready(near, one)
    assert held(apart) == wanted
    repeated = [(none if i is None else i, t) for i, t in held(good)]  # alone it keeps one row of each as well
    repeated = [i for i, _, c in brute.near(repeated) if i == c]
    assert held(ready(near, good)) == Counter((None if i == none else i, texts[None if i == none else i]) for i in repeated)
    mixed = ready(mix, apart)
    copies = Counter()
    for r in mixing.mix(common.row_keys(apart, "doc_id")).collect():
        copies[r.doc_id if r.doc_id in texts else None] += r.copies
    assert Counter(i for i, _ in held(mixed).elements()) == +copies
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = Counter()
    for (i, text), n in held(mixed).items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), CAPACITY):
            pieces[i, k, len(ids[k : k + CAPACITY]), zlib.crc32(ids[k : k + CAPACITY].tobytes())] += n
    packed = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    room = Counter()
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == room[r.sequence_id]
        room[r.sequence_id] += r.length
    assert max(room.values()) <= CAPACITY


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from oracle_check import compare, connect

    assert compare(spark, connect(SF), name, QUERIES[name], ORACLE_SQL[name], SF) == ""
