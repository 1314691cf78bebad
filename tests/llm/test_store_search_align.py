"""The token store, ranked search and tokenizer alignment against their plain versions."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from engagemart.llm import alignment, lexical, token_store
from engagemart.llm.packing import _byte_letters
from engagemart.llm.perfect_hash import PerfectHash
from engagemart.llm.word_tokens import WordTokens
from engagemart.llm.words import text_slices

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES, PIECES = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = "abcdefghijk  the of XYZ0123'.,!-éüß×½²<|>_\x00\x1c\x85  ▁İΣ中文 😀é\t\n ﬁ"


def odd_texts(count, seed=3):
    r = random.Random(seed)
    texts = ["".join(r.choice(ODD) for _ in range(r.randint(0, 50))) for _ in range(count)]
    return texts + [None, "", " ", "<|endoftext|> x <|startoftext|>", "</s> <unk> <0x41>", "don't DON'T", "x" * 3000, "w " * 3000, "ÀÉ ÿ"]


@pytest.fixture(scope="module")
def mixed(nasty):
    """Rows with NULL ids, ids that repeat with other texts, and rows that repeat wholly."""
    rows = [*nasty, *[(1000 + k, text) for k, text in enumerate(odd_texts(60))]]
    rows += [(7, "another text of seven"), (7, "a third"), (None, "no id"), (None, "no id"), (None, None), (8, "twice"), (8, "twice")]
    return rows


def plain_frame(spark, rows):
    data = [(text, i, "w", 5) for i, text in rows]
    return spark.createDataFrame(data, "text string, doc_id bigint, _id string, n_tokens int").repartition(3)


# -- words, perfect hash -------------------------------------------------------------------------------


def test_words_encode_as_the_library_does():
    own, library = WordTokens(WORDS), Tokenizer.from_file(WORDS)
    texts = odd_texts(3000)
    for limit in (500, 1 << 20):
        for first, past, data, offsets in text_slices(pa.array(texts), limit):
            ids, bounds = own.encode(data, offsets)
            for row in range(first, past):
                wanted = library.encode(texts[row] or "", add_special_tokens=False).ids
                assert ids[bounds[row - first] : bounds[row - first + 1]].tolist() == wanted


def test_words_of_other_vocabularies():
    own, library = WordTokens(BYTES), Tokenizer.from_file(BYTES)
    texts = ["one two", "", "drei  vier\n"]
    (_, _, data, offsets), *_ = text_slices(pa.array(texts))
    ids, bounds = own.encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [
        library.encode(text, add_special_tokens=False).ids for text in texts
    ]


@pytest.mark.parametrize("count", [0, 1, 2, 63, 1000, 40_000])
def test_perfect_hash_is_minimal(count):
    r = np.random.default_rng(count)
    first, second = r.integers(0, 1 << 63, (2, count), np.uint64)
    built = PerfectHash.build(first, second)
    again, size = PerfectHash.from_bytes(built.to_bytes() + b"more")
    assert size == len(built.to_bytes()) and again.size == count
    assert sorted(again(first, second).tolist()) == list(range(count))
    assert len(built.to_bytes()) <= 100 + count  # bits, not bytes, a key


def test_perfect_hash_refuses_equal_keys():
    same = np.array([5, 5], np.uint64)
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(same, same)


# -- token store -----------------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [{}, {"task_bytes": 4000, "shard_ids": 900, "part_keys": 5}])
def test_token_store(spark, mixed, sizes):
    library = Tokenizer.from_file(WORDS)
    rows = token_store.roundtrip(plain_frame(spark, mixed), WORDS, **sizes).collect()
    wanted = Counter()
    for i, text in mixed:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == wanted
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: (i is None, i))


def test_token_store_by_key(spark, mixed, tmp_path):
    library = Tokenizer.from_file(WORDS)
    store = token_store.write_store(plain_frame(spark, mixed), WORDS, str(tmp_path / "s"), task_bytes=4000, shard_ids=900, part_keys=7)
    texts = dict(mixed[:50])
    for i in (0, 11, 33):
        assert store.get(i).tolist() == [*library.encode(texts[i] or "", add_special_tokens=False).ids, 1]
    sevens = {tuple(store.get(7, k).tolist()) for k in range(3)}
    assert len(sevens) == 3 and store.get(7, 3) is None and store.get(10**9) is None
    assert store.get(None, 2) is not None and store.get(None, 3) is None
    wanted = spark.createDataFrame([(7, 2), (10**9, 0), (8, 1)], "_id bigint, ordinal bigint")
    found = {(r._id, r.ordinal): r.shard for r in store.locate(wanted).collect()}
    assert found.keys() == {(7, 2), (10**9, 0), (8, 1)} and [k for k, shard in found.items() if shard is None] == [(10**9, 0)]
    ids = {tuple(r.ids) for r in store.payloads(store.locate(wanted)).collect()}
    assert len(ids) == 2 and tuple(store.get(7, 2).tolist()) in ids


def test_token_store_places_shards_of_one_id(spark):
    rows = [(5, f"row {k}") for k in range(40)] + [(4, "before"), (6, "after")]
    store = token_store.write_store(plain_frame(spark, rows), WORDS, task_bytes=60, shard_ids=12, part_keys=4)
    assert store.shards().count() > 3
    assert sorted(tuple(k) for k in store.keys().collect()) == [(4, 0), *[(5, k) for k in range(40)], (6, 0)]


def test_empty_token_store(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_store.roundtrip(empty, WORDS).collect() == []
    assert token_store.write_store(empty, WORDS).get(1) is None


# -- ranked search -------------------------------------------------------------------------------------


def items_frame(spark, items):
    return spark.createDataFrame([(text, i, 0) for i, text in items], "text string, item_id string, rank int")


@pytest.mark.parametrize(("k", "limit", "most_items"), [(50, True, 2000), (3, True, 30), (3, False, 2000), (1, True, 60)])
def test_search(spark, mixed, k, limit, most_items, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 20_000)
    items = [("a", "license MIT one"), ("b", None), (None, "alpha1 beta2 GAMMA3 nothing"), ("b", "ünder5 Été7 7x alpha1 alpha1"), ("c", "zzz"), ("d", "")]
    items += [(f"r{n}", text) for n, (_, text) in enumerate(mixed) if n % 9 == 0]
    df = lexical.search(plain_frame(spark, mixed), items_frame(spark, items), k, limit=limit, most_items=most_items)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, df.collect()), key=repr) == brute.search(mixed, items, k)


def test_search_of_empty_tables(spark, mixed):
    none = spark.createDataFrame([], "text string, item_id string")
    docs = plain_frame(spark, mixed)
    assert lexical.search(docs, none).collect() == []
    assert lexical.search(docs.limit(0), items_frame(spark, [("a", "one")])).collect() == []
    assert lexical.search(plain_frame(spark, [(1, None), (2, " . ")]), items_frame(spark, [("a", "one")])).collect() == []


def test_accumulators_are_limited_and_scores_exact():
    r = np.random.default_rng(6)
    docs, k = 2000, 10
    lists = []
    for df, gain in ((15, 900), (40, 600), (300, 90), (1200, 9), (1900, 2)):
        own = np.sort(r.choice(docs, df, replace=False))
        lists.append((own, r.integers(gain // 2, gain + 1, df)))
    full, every, all_made = lexical.accumulate(lists, docs, k, 1, limit=False)
    scores, made, making = lexical.accumulate(lists, docs, k, 1)
    assert all_made == len(lists) and making < len(lists) and made.sum() < every.sum() / 2
    assert np.array_equal(scores[made], full[made])
    kth = np.sort(full)[-k]
    assert made[full >= kth].all()


def test_accumulators_keep_ties():
    # the second list could still lift others to the k-th score, not above it: ties are decided by id, so they count
    lists = [(np.array([3]), np.array([10])), (np.array([0, 1]), np.array([10, 4]))]
    scores, made, making = lexical.accumulate(lists, 5, 1, 1)
    assert making == 2 and scores.tolist() == [10, 4, 0, 10, 0]


# -- alignment -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides():
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    letters = {letter: number for number, letter in enumerate(_byte_letters())}
    bytes_a = {n: bytes(letters[c] for c in t) for t, n in a.get_vocab(with_added_tokens=True).items() if set(t) <= letters.keys()}
    pieces = [b.id_to_piece(n) for n in range(b.get_piece_size())]
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    return lambda text: a.encode(" " + text, add_special_tokens=False).ids, bytes_a, b.encode, bytes_b


@pytest.mark.parametrize("slice_bytes", [2 << 20, 700])
def test_alignment(spark, mixed, sides, slice_bytes, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_BYTES", slice_bytes)
    rows = [*mixed, *[(5000 + k, text) for k, text in enumerate(odd_texts(400, 9))]]
    df = alignment.alignment(plain_frame(spark, rows), BYTES, PIECES)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    wanted = brute.alignment(rows, *sides)
    assert sorted(map(tuple, df.collect()), key=repr) == wanted
    assert any(w[1] == 0 for w in wanted) and any(w[5] < w[4] for w in wanted)


def test_alignment_links_add_up(spark, mixed):
    docs, pairs = alignment.align_documents(plain_frame(spark, mixed), BYTES, PIECES)
    links = Counter(link for row in docs.collect() for link in zip(row.links_a, row.links_b, strict=True))
    assert links == {(r.a, r.b): r.n for r in pairs.collect()}


def test_alignment_of_an_empty_table(spark):
    assert alignment.alignment(spark.createDataFrame([], "doc_id bigint, text string"), BYTES, PIECES).collect() == []


def test_pairs_are_bounded_by_suffixes():
    a, b = [b"ab", b"b", b"xab"], [b"b", b"ab", b"zzb"]
    wanted = sum(x.endswith(y) or y.endswith(x) for x in a for y in b)
    assert alignment.pair_bound(a, b) == wanted
