"""Every operator against its plain version, on awkward texts, repeated rows and empty tables."""

from __future__ import annotations

import gzip
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import ceil

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from engagemart.llm import (
    anchors,
    bwt_dedup,
    common,
    decision_list,
    exact_dedup,
    license_scan,
    mixing,
    packing,
    partenum,
    sharding,
    suffix_trees,
    warc,
)
from engagemart.llm.anchors import Windows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def got(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("hash_bytes", [16, 1])
def test_exact(frame, nasty, hash_bytes):
    df = exact_dedup.exact_groups(frame(nasty), hash_bytes=hash_bytes)
    assert got(df, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(nasty)


def test_exact_repeated_rows_share_their_verdict(frame, nasty):
    rows = got(exact_dedup.exact_groups(frame(nasty, repeat=True)), "doc_id", "kept")
    assert len(rows) == len(nasty) + 7 and len(set(rows)) == len(nasty)


def test_only_texts_of_marked_slots_travel(spark):
    rows = spark.range(20_000).select(F.md5(F.col("id").cast("string")).cast("binary").alias("_hash"), "id")
    repeated = rows.filter("id % 10 = 0")
    passed = {r.id for r in exact_dedup._marked(rows, repeated).collect()}
    assert {r.id for r in repeated.collect()} <= passed and len(passed) < 2_100


def test_exact_with_one_text_in_most_rows(frame):
    rows = [(k, "the same  text" if k % 3 else f"text {k // 6}") for k in range(900)]
    df = exact_dedup.exact_groups(frame(rows))
    assert got(df, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(rows)


def test_sharding(frame, nasty):
    rows = sharding.shard_documents(frame(nasty, repeat=True), 4).collect()
    texts = dict(nasty)
    loads, slots, place = Counter(), defaultdict(list), {}
    for row in rows:
        data = (texts[row.doc_id] or "").encode()
        assert (row["size"], row.text_crc32, row.law, row.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        loads[row.shard] += row["size"]
        slots[row.shard].append(row.slot)
        assert place.setdefault(data, row.shard) == row.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for row in rows:
        groups[texts[row.doc_id] or ""] += row["size"]
    largest = max(groups.values())
    assert max(loads.values()) <= max(sum(loads.values()) / 4 * 1.05, largest)


def test_sharding_in_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ITEMS", 50)
    monkeypatch.setattr(sharding, "LAST_ITEMS", 400)
    rows = [(f"{k:04d}", 100 + k * 7919 % 1000) for k in range(1500)] + [("hot", 30_000)]
    shards = sharding.karmarkar_karp(spark.createDataFrame(rows, "_group string, _bytes bigint"), 8).collect()
    sizes, loads = dict(rows), Counter()
    for group, shard in shards:
        loads[shard] += sizes[group]
    assert len(shards) == len(rows) and max(loads.values()) - min(loads.values()) < sum(loads.values()) / 8 * 0.02


def test_differencing_beats_dealing_in_turn():
    sizes = np.array(sorted(np.random.default_rng(1).integers(1, 10_000, 500), reverse=True))
    loads = np.bincount(sharding.difference(sizes, 7), weights=sizes)
    assert loads.max() - loads.min() <= 5


def test_licenses(frame, nasty):
    df = license_scan.license_scan(frame(nasty))
    wanted = sorted((i, *brute.licenses(text, license_scan.PHRASES)) for i, text in nasty)
    rows = sorted(df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())
    assert [tuple(r) for r in rows] == wanted


def test_license_blocks_are_all_found(frame):
    notice = license_scan.words_of(license_scan.TEMPLATES["mit-terms"])
    filler = [b"word%d" % k for k in range(90)]
    rows = []
    for k in range(40):
        damaged = notice[: len(notice) - k]
        rows.append((k, " ".join(x.decode() for x in [*filler[: k * 2], *damaged, *filler])))
    found = {r.doc_id: r.blocks for r in license_scan.license_scan(frame(rows)).collect()}
    ready = license_scan.prepare(license_scan.TEMPLATES, 0.8, Counter())
    for i, text in rows:
        words = license_scan.words_of(text)
        wanted = set()
        for t in ready:  # every block of every template, counted in full
            for start in range(0, len(words), t.length):
                shared = len(set(words[start : start + 2 * t.length]) & set(t.words))
                if shared >= t.needed:
                    wanted.add((t.label, start, round(shared / len(t.words), 9)))
        assert {(b.label, b.first_word, round(b.share, 9)) for b in found[i]} == wanted
    assert any(found[0])


def test_licenses_are_told_from_others(frame):
    wanted = [
        ("Licensed under the Mozilla Public License, Version 2.0.", set()),
        ("Licensed under the Educational Community License, Version 2.0 (the License); you may not use this file except "
         "in compliance with the License. You may obtain a copy of the License at", set()),
        ("Licensed under the Apache License, Version 1.0.", {"apache"}),
        ("Licensed under CC BY 4.0.", set()),
        ("Licensed under CC BY-NC 3.0.", set()),
        ("Licensed under CC BY-NC-SA 4.0.", set()),
        ("Released under the BSD License.", set()),
        ("This work is licensed under the GNU Lesser General Public License, version 2.", {"gpl"}),
        ("This work is licensed under the GNU Affero General Public License, version 3.", {"gpl"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"gpl"}),
        ("This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
         "General Public License as published by the Free Software Foundation", {"gpl"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0-statement"}),
        ("Licensed under the Apache License 2.0", {"apache", "apache-2.0-statement"}),
        ("Licensed under Version 2.0 of the Apache License.", {"apache", "apache-2.0-statement"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0-statement"}),
        ("Released under the MIT License.", {"mit", "mit-statement"}),
        ("Released under the MIT.", {"mit-statement"}),
        ("This work is licensed under version 3 of the GNU General Public License.", {"gpl", "gpl-3.0-statement"}),
        ("This work is licensed under the GNU General Public License, version 2 or 3.", {"gpl", "gpl-3.0-statement"}),
        ("This work is licensed under the GNU Public License v3, version 3.", {"gpl-3.0-statement"}),
    ]
    rows = [(k, text) for k, (text, _) in enumerate(wanted)]
    found = {r.doc_id: set(r.labels.split(",")) - {""} for r in license_scan.license_scan(frame(rows)).collect()}
    assert found == {k: labels for k, (_, labels) in enumerate(wanted)}


def test_license_blocks_from_every_word_count(frame):
    sentence, rows = license_scan.words_of(license_scan.TEMPLATES["mit-terms"]), []
    for k in range(60):  # stretched to nearly a block, so that most lie in none that starts at a multiple
        inner = [x for n, w in enumerate(sentence) for x in [w] + [b"x%d" % n] * (n < len(sentence) - 2)]
        rows.append((k, b" ".join([*(b"y%d" % n for n in range(k)), *inner, *(b"z%d" % n for n in range(70))]).decode()))
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.license_scan(frame(rows)).collect()}
    (ready,) = license_scan.prepare({"mit-terms": license_scan.TEMPLATES["mit-terms"]}, 0.8, Counter())
    for k, text in rows:
        words = license_scan.words_of(text)
        best = max(len(set(words[s : s + 2 * ready.length]) & set(ready.words)) for s in range(len(words)))
        assert best >= ready.needed and found[k] == ("mit-terms", best / len(ready.words))


def test_license_filters_lose_nothing_and_save_counts(nasty):
    texts = [text or "" for _, text in nasty] + list(license_scan.TEMPLATES.values())
    long = " ".join(license_scan.TEMPLATES.values())
    shuffled = license_scan.words_of(long)
    random.Random(3).shuffle(shuffled)
    texts += [long, b" ".join(shuffled).decode(), ("filler of the words " * 40 + license_scan.TEMPLATES["isc"]) * 3]
    frequency = Counter(word for text in texts for word in set(license_scan.words_of(text)))
    ready = license_scan.prepare(license_scan.TEMPLATES, 0.8, frequency)
    index, tally, every = license_scan.prefix_index(ready), Counter(), 0
    for text in texts:
        words = license_scan.words_of(text)
        found = {t.label: best for t, best, _ in license_scan.meetings(words, ready, index, tally)}
        wanted = {}
        for t in ready:  # every block from every word on, no filter
            names = license_scan.name_places(words, t)
            for start in range(len(words)):
                end = start + 2 * t.length
                if names is None or any(start <= a and b <= end for a, b in names):
                    every += 1
                    count = len(set(words[start:end]) & set(t.words))
                    if count >= t.needed:
                        wanted[t.label] = max(count, wanted.get(t.label, 0))
        assert found == wanted
    assert 0 < tally["counted"] < tally["blocks"] < every and tally["counted"] * 20 < every


def test_whole_licenses_and_short_forms(frame):
    wanted = {
        "SPDX-License-Identifier: Apache-2.0": {"apache-2.0-spdx"},
        "SPDX-License-Identifier: MIT": {"mit-spdx"},
        "SPDX-License-Identifier: MIT-0": set(),
        "SPDX-License-Identifier: BSD-3-Clause": set(),
        "Creative Commons Attribution-NonCommercial 4.0": {"cc-by-nc-4.0-name"},
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0": set(),
        "Creative Commons Attribution 4.0": set(),
        license_scan.TEMPLATES["mit-warranty"]: {"mit-warranty"},
        license_scan.TEMPLATES["mit-license"]: {"mit-license", "mit-terms", "mit-warranty"},
        license_scan.TEMPLATES["bsd-2-clause"]: {"bsd-2-clause", "bsd-terms"},
        license_scan.TEMPLATES["isc"]: {"isc"},
        license_scan.TEMPLATES["zlib"]: {"zlib"},
    }
    found = license_scan.license_scan(frame(list(enumerate(wanted)))).collect()
    labels = list(wanted.values())
    assert {r.doc_id: set(r.labels.split(",")) - {""} for r in found} == dict(enumerate(labels))


def test_quality_counts(spark, frame, nasty):
    df = decision_list.quality(frame(nasty), labels_of(spark, []))
    rows = got(df, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    wanted = []
    for i, text in nasty:
        c = brute.counts(text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        wanted.append((i, *c, failed, not failed))
    assert rows == sorted(wanted)


def test_quality_learns_on_one_half_and_holds_on_the_other(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    stats = decision_list.statistics(docs).cache()
    rules = decision_list.learn(stats, labels.filter("doc_id % 2 = 0"))
    assert rules
    held = stats.join(labels.filter("doc_id % 2 = 1"), "doc_id").withColumn("keeps", decision_list.verdict(rules))
    kept_good = held.filter("quality = 1 and keeps").count() / held.filter("quality = 1").count()
    dropped = held.filter("quality = 0 and not keeps").count() / held.filter("quality = 0").count()
    assert kept_good >= 0.99 and dropped >= 0.6


def test_conflicting_and_missing_labels(spark, frame, nasty):
    labels = labels_of(spark, [(0, 1, 0), (0, 0, 0), (1, None, 0), (None, 1, 0), (9999, 0, 0)])
    assert decision_list.quality(frame(nasty), labels).count() == len(nasty)


@pytest.mark.parametrize("width,reach,group", [(50, 25, 4000), (8, 3, 4000), (50, 25, 2)])
def test_substrings(frame, nasty, width, reach, group):
    df = suffix_trees.dedup_digest(frame(nasty), windows=Windows(width, reach), group_contexts=group)
    assert got(df, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substrings(nasty, width)


@pytest.mark.parametrize("group", [4000, 2])
def test_substrings_repeated_inside_their_least_document(frame, group):
    def words(name, n):
        return [f"{name}{k}" for k in range(n)]

    passage, stretch = words("p", 60), words("q", 40) + words("p", 60) + words("u", 40)
    rows = [(0, words("r", 40) + passage + words("s", 40)), (1, stretch + words("v", 80) + stretch), (2, words("w", 9) + stretch)]
    rows = [(i, " ".join(text)) for i, text in rows]
    df = suffix_trees.dedup_digest(frame(rows), group_contexts=group)
    wanted = brute.substrings(rows)
    assert wanted[1][2] == 120
    assert got(df, "doc_id", "n_words", "n_removed", "kept_sha256") == wanted


@pytest.mark.parametrize("width,reach,group", [(400, 64, 4000), (60, 20, 4000), (400, 64, 2)])
def test_byte_spans(frame, nasty, width, reach, group):
    df = bwt_dedup.dedup_digest(frame(nasty), windows=Windows(width, reach), group_contexts=group)
    assert got(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_spans(nasty, width)


def test_hashing_windows_takes_bounded_memory():
    class Texts:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    r = random.Random(3)
    texts = ["".join(r.choices("abcdefgh \n", k=2000)) for _ in range(1500)]
    batch = pa.record_batch([pa.array(range(1500), pa.int64()), pa.array(texts)], ["_id", "_text"])
    run = anchors.anchor_blobs(Texts(), 4, bwt_dedup.WINDOWS, bwt_dedup._sequences)
    tracemalloc.start()
    blobs = list(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    found = sum(len(blob) for b in blobs for blob in b.column("_key").to_pylist()) // 8
    assert found >= 1500 * (2000 - 400) / 64
    assert peak < 48 << 20


def test_contexts_are_compared_in_as_many_tasks_as_slots(frame):
    def passage(k):
        return " ".join(f"p{k}x{n}" for n in range(90))

    def compare(table):
        from pyspark import TaskContext

        return pa.table({"_doc": [TaskContext.get().partitionId()], "_from": [0], "_to": [1]})

    rows = [(2 * k + side, f"{side}" * (k + 7) + passage(k) + f"{side}" * 70) for k in range(40) for side in (0, 1)]
    tasks = anchors.repeated_windows(
        frame(rows), "doc_id", "text", bwt_dedup.WINDOWS, lambda size, doc, least: np.zeros(len(size), bool),
        bwt_dedup._sequences, bwt_dedup._symbols, compare, None, group_contexts=4,
    )
    assert tasks.count() >= 20


@pytest.mark.parametrize("shards", [1, 2, 3, 5])
def test_merged_transforms_find_repeats(shards):
    r = np.random.default_rng(shards)
    strings = [r.integers(1, 4, r.integers(1, 40)) for _ in range(30)]
    again = bwt_dedup.repeated_places(strings, 5, shards)
    at, seen = 0, Counter(tuple(s[k : k + 5]) for s in strings for k in range(len(s) - 4))
    for s in strings:
        for k in range(len(s) - 4):
            assert again[at + k] == (seen[tuple(s[k : k + 5])] > 1)
        at += len(s) + 1


def test_near(frame, nasty):
    df = partenum.near_components(frame(nasty))
    assert got(df, "doc_id", "n_shingles", "component_id") == brute.near(nasty)


def test_near_with_parts_for_all_but_tiny_sets(frame, nasty):
    df = partenum.near_components(frame(nasty), part_size=60)
    assert got(df, "doc_id", "n_shingles", "component_id") == brute.near(nasty)


def test_near_in_blocks(frame, nasty, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK", 3)
    monkeypatch.setattr(partenum, "PARTNERS", 2)
    df = partenum.near_components(frame(nasty))
    assert got(df, "doc_id", "n_shingles", "component_id") == brute.near(nasty)


def test_packing(frame, nasty):
    rows = packing.pack_documents(frame(nasty), TOKENIZER, capacity=128).collect()
    tokenizer, texts = Tokenizer.from_file(TOKENIZER), dict(nasty)
    bins, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        bins[row.sequence_id].append((row.offset, row.length))
        pieces[row.doc_id].append((row.piece, row.start, row.length, row.ids_crc32))
    for i, text in nasty:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        cuts = [ids[k : k + 128] for k in range(0, len(ids), 128)]
        assert sorted(pieces[i]) == [(n, 128 * n, len(c), zlib.crc32(c.tobytes())) for n, c in enumerate(cuts)]
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= 128
    assert len(bins) <= ceil(sum(r.length for r in rows) / 128) * 1.05 + 1


def test_packing_in_parts_and_sequences(frame, nasty):
    cut = packing.pieces(frame(nasty), TOKENIZER, capacity=128, with_ids=True).cache()
    packed = packing.pack(cut.drop("ids"), 128, part_pieces=20).withColumnRenamed("_id", "doc_id")
    assert packed.count() == cut.count()
    lengths = {r.sequence_id: len(r.ids) for r in packing.sequences(packed, cut).collect()}
    assert max(lengths.values()) <= 128 and sum(lengths.values()) == cut.agg({"length": "sum"}).head()[0]


def test_best_fit_takes_the_tightest():
    chosen, offsets, room = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert (chosen, offsets, room) == ([0, 1, 0, 1, 1], [0, 0, 6, 5, 8], [0, 0])


def test_words_with_odd_characters_are_encoded_as_the_tokenizer_does():
    tokenizer, words = Tokenizer.from_file(TOKENIZER), packing._WordIds(TOKENIZER)
    for text in ("it'S", "<|endoftext|>x", "J̌", "İb", "a\x01b \x01", "ªµº ½²", "naïve  Ünder", "é", "x y\u0085z"):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.texts([text]) == [ids]


def test_mixing(frame, nasty):
    source = {i: (None, "", "b", "a", "ä")[i % 5] for i, _ in nasty}
    sizes, taken = Counter(), Counter()
    rows = mixing.mix(frame(nasty)).collect()
    for i, text in nasty:
        sizes[source[i]] += len(brute.WORD.findall(text or ""))
    wanted = brute.mix_targets({s: sizes[s] for s in set(source.values())})
    for row in rows:
        s = source[row.doc_id]
        assert row.source_size == sizes[s] and row.target == pytest.approx(wanted[s])
        assert 0 <= row.taken <= 2 * row["size"]
        taken[s] += row.taken
    for s, target in wanted.items():
        assert abs(taken[s] - target) <= 2 * mixing.BLOCK_WORDS + 1
    assert sorted(rows) == sorted(mixing.mix(frame(nasty)).collect())


def test_highest_quotients(spark):
    shares = [53, 24, 23, 1, 0, 1000]
    rows = spark.createDataFrame([(0, k, float(s), 77) for k, s in enumerate(shares)], "g int, k int, s double, n int")
    given = dict(mixing.sainte_lague(rows, "g", "k", "s", "n").select("k", "_quota").collect())
    best = sorted(((s / (2 * n - 1), -k) for k, s in enumerate(shares) for n in range(1, 78)), reverse=True)[:77]
    assert given == {k: Counter(-b[1] for b in best)[k] for k in range(len(shares))}


def test_warc(spark):
    pages = [(1, "u", "same"), (2, None, "same"), (3, "a b\r\nc", None), (4, "u", ""), (5, "u", "é" * 9000), (9, "u", "same"), (6, "u", "s")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(2)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    for least in (0, 3):
        rows = sorted(tuple(r) for r in warc.roundtrip(df, least).select(*columns).collect())
        assert rows == brute.revisits([(i, h) for i, _, h in pages], least)


def test_warc_filters_and_payloads(spark, tmp_path):
    pages = [(k, f"u{k}", f"page {k % 5} " + "z" * 300_000 * (k % 3)) for k in range(20)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    warc.register(spark)
    path = str(tmp_path / "w")
    warc.archive_records(df).write.format("warc").option("fileBytes", 500_000).mode("append").save(path)
    read = spark.read.format("warc").option("partitionBytes", 1_000_000).load(path)
    assert read.rdd.getNumPartitions() > 1
    html = dict((i, h) for i, _, h in pages)
    for row in read.filter("record_type = 'response'").collect():
        assert bytes(row.payload).decode() == html[int(row.record_id.split(":")[-1])]
    revisits = read.filter("record_type = 'revisit' and payload_bytes > 100")
    assert all(r.payload is None and r.refers_to for r in revisits.collect())
    assert read.filter("record_id in ('urn:page:3', 'urn:page:19')").count() == 2


def test_warc_of_other_writers(spark, tmp_path):
    """No manifest, gzip members, warcinfo and request records, absent headers, a wrong digest, odd blank lines."""

    def record(head, block=b""):
        return b"WARC/1.0\r\n" + head + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    http, long = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n", b"z" * 700_000
    response = b"WARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\n"
    records = [
        record(b"WARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\n", b"software: x\r\n\r\n"),
        record(b"WARC-Type: request\r\nContent-Type: application/http\r\n", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n"),
        record(response + b"WARC-Record-ID: <r1>\r\nWARC-Payload-Digest: sha1:WRONG\r\n", http + b"body\r\n\r\nmore"),
        record(response + b"WARC-Record-ID: <r2>\r\n", http + long) + b"\r\n",
        record(b"WARC-Type: resource\r\nWARC-Record-ID: <r3>\r\nContent-Type: text/plain\r\n", b"plain"),
        record(b"WARC-Type: revisit\r\nWARC-Record-ID: <r4>\r\nWARC-Refers-To: <r1>\r\nWARC-Payload-Digest: sha1:ABC\r\n"),
        record(response + b"WARC-Record-ID: <r5>\r\n", http),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "note.txt").write_text("no archive")
    warc.register(spark)
    read = spark.read.format("warc").load(str(tmp_path))
    assert Counter(r.record_type for r in read.collect()) == Counter(
        {"warcinfo": 2, "request": 2, "response": 6, "resource": 2, "revisit": 2}
    )
    payloads = {(r.record_id, bytes(r.payload)) for r in read.filter("record_type in ('response', 'resource')").collect()}
    assert payloads == {("r1", b"body\r\n\r\nmore"), ("r2", long), ("r3", b"plain"), ("r5", b"")}
    found = Counter(tuple(r) for r in warc.read_back(spark, str(tmp_path)).collect())
    bodies = {"r1": b"body\r\n\r\nmore", "r2": long, "r5": b""}
    wanted = {(i, "response", None, len(b), warc.base32_sha1(b)): 2 for i, b in bodies.items()}
    assert found == Counter(wanted | {("r4", "revisit", "r1", None, "ABC"): 2})


def test_hot_ids(spark, monkeypatch):
    """Half of the rows without an id, and one id in a sixth, of one text: shards and slots stay spread."""
    monkeypatch.setattr(mixing, "SHARD_ROWS", 200)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 200)
    rows = [(None if k % 2 else k, f"{'w ' * (k % 40)}text {k}", "a") for k in range(5000)] + [(7, "same words here", "a")] * 1000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    mixed = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in mixed) == Counter((i, len(t.split())) for i, t, _ in rows)
    total = sum(len(t.split()) for _, t, _ in rows)
    # a shard's last block may be short
    assert abs(sum(r.taken for r in mixed) - 1.5 * total) <= mixing.BLOCK_WORDS * len(rows) / 200
    held = common.salted(
        spark.createDataFrame([(i, hash(t), n) for n, (i, t, _) in enumerate(rows)], "_id bigint, _hash bigint, _row bigint"),
        ["_id", "_hash"], 200,
    )
    assert Counter(r._salt != 0 for r in held.collect()) == Counter({False: 5000, True: 1000})
    shards = sharding.shard_documents(docs, 3).collect()
    slots = defaultdict(list)
    for r in shards:
        slots[r.shard].append(r.slot)
    assert len(shards) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_tables(spark, frame):
    empty = frame([(0, "x")]).filter("doc_id < 0")
    none = labels_of(spark, [])
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    for df in (
        exact_dedup.exact_groups(empty), sharding.shard_documents(empty), license_scan.license_scan(empty),
        decision_list.quality(empty, none), bwt_dedup.dedup_digest(empty), suffix_trees.dedup_digest(empty),
        partenum.near_components(empty), packing.pack_documents(empty, TOKENIZER), mixing.mix(empty), warc.roundtrip(pages),
    ):
        assert df.collect() == []


def test_rows_without_an_id(spark, nasty):
    """They count as rows of their own, behind all ids."""
    rows = [(None if i % 4 == 1 else i, t) for i, t in nasty]
    copy = " ".join(f"w{k}" for k in range(400))
    rows += [(5000, copy), (None, copy), (6000, copy + " end"), (None, "alone " + " ".join(f"v{k}" for k in range(60)))]
    keys = [(10_000 + n if i is None else i, t) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id int, text string, source string").coalesce(1)

    def real(i):
        return None if i >= 10_000 else i

    def check(df, columns, wanted, ids=(0,)):
        wanted = [tuple(real(v) if k in ids else v for k, v in enumerate(row)) for row in wanted]
        assert Counter(map(tuple, df.select(*columns).collect())) == Counter(wanted)
        assert df.schema["doc_id"].dataType.simpleString() == "int"

    check(exact_dedup.exact_groups(docs), ("doc_id", "keep_id", "group_size", "kept", "text_sha256"), brute.exact(keys), (0, 1))
    check(partenum.near_components(docs), ("doc_id", "n_shingles", "component_id"), brute.near(keys), (0, 2))
    check(suffix_trees.dedup_digest(docs), ("doc_id", "n_words", "n_removed", "kept_sha256"), brute.substrings(keys))
    check(bwt_dedup.dedup_digest(docs), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), brute.byte_spans(keys))
    texts = dict(keys)
    check(exact_dedup.drop_exact(docs), ("doc_id", "text"), [(r[0], texts[r[0]]) for r in brute.exact(keys) if r[3]])
    check(partenum.drop_near(docs), ("doc_id", "text"), [(r[0], texts[r[0]]) for r in brute.near(keys) if r[0] == r[2]])
    good = [(i, t) for i, t in keys if (c := brute.counts(t))[0] >= 20 and 100 * c[4] <= 30 * c[0]]
    check(decision_list.keep_good(docs, labels_of(spark, [(6001, 0, 0), (6002, 1, 0)])), ("doc_id", "text"), good)
    keyed, last = common.with_keys(docs, "doc_id")
    assert last == 6000
    mixed = mixing.mix(keyed).join(keyed.select("doc_id", "text"), "doc_id").collect()
    check(mixing.mix_documents(docs), ("doc_id", "text"), [(r.doc_id + 10_000 * (r.doc_id > last), r.text) for r in mixed for _ in range(r.copies)])
    packed = packing.pack_documents(docs, TOKENIZER, capacity=128)
    assert packed.filter("doc_id is null").select("sequence_id", "offset").distinct().count() >= sum(i is None for i, _ in rows)


def test_kept_rows_keep_their_columns(spark, frame, nasty):
    docs = frame(nasty, repeat=True)
    for kept in (exact_dedup.drop_exact(docs), partenum.drop_near(docs), mixing.mix_documents(docs), decision_list.keep_good(docs, labels_of(spark, []))):
        assert kept.columns == docs.columns and kept.exceptAll(docs.unionByName(docs)).isEmpty()


def test_texts_that_share_an_id_are_judged_alone(spark):
    first, other = (" ".join(f"{x}{k}" for k in range(120)) for x in "ab")
    rows = [(1, first), (2, first), (2, other), (2, other), (3, "short"), (None, first)]
    docs = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id bigint")
    words = Counter((r.doc_id, r.n_words, r.n_removed) for r in suffix_trees.dedup_digest(docs).collect())
    assert words == Counter([(1, 120, 0), (2, 120, 120), (2, 120, 0), (2, 120, 0), (3, 1, 0), (None, 120, 120)])
    size = len(first.encode())
    gone = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in bwt_dedup.dedup_digest(docs).collect())
    assert gone == Counter([(1, size, size), (2, size, size), (2, size, size), (2, size, size), (3, 5, 0), (None, size, size)])
    near = Counter((r.doc_id, r.n_shingles, r.component_id) for r in partenum.near_components(docs).collect())
    assert near == Counter([(1, 116, 1), (2, 116, 1), (2, 116, 2), (2, 116, 2), (3, 1, 3), (None, 116, 1)])


def test_unrelated_text_of_a_shared_id_loses_nothing(spark):
    first, other = (" ".join(f"{x}{k}" for k in range(120)) for x in "ab")
    docs = spark.createDataFrame([(1, first), (2, first), (2, other)], "doc_id bigint, text string")
    gone = Counter((r.doc_id, r.n_removed) for r in bwt_dedup.dedup_digest(docs).collect())
    assert gone == Counter([(1, len(first)), (2, len(first)), (2, 0)])
