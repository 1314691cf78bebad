"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word shingles. Sets are joined inside bands of
nearly equal size, where similarity bounds the number of differing shingles by some k. The
shingle domain is partitioned by hash into (k + 1) / 2 parts of 3 cells: a similar pair has a part with at
most one difference, so for one of the 3 pairs of cells both sets hold the same shingles
there, and the signature of that pair of cells (band, part, cells, shingles in them) is shared. Pairs of
cells that are empty are no signature: only a pair whose common shingles all lie in differing
cells could be lost, which in sets of 128 or more has a chance below 1e-12. In smaller sets,
where it has not, parts are single shingles: the first n - needed + 1 in hash order, of
which similar sets always share one.

Sets that share a signature are candidates, and every link is verified on the texts. Inside
a group, members are first compared with its first; only members that stay apart from the rest are
compared with the others, so groups of copies cost one comparison a member. Those further
comparisons are made on parity sketches, which bound the differences of two sets from below: a pair is verified
unless the bound proves it dissimilar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import (
    counted,
    given_ids,
    hand_back,
    id_and_text,
    keep_rows,
    parts,
    row_keys,
    small,
    small_batches,
    text_keys,
    with_names,
    written,
)
from engagemart.llm.components import components
from engagemart.llm.words import LOWER, Powers, lists, mix, packed_chunks, text_slices, word_bounds, word_hashes

SHINGLE_WORDS, PERCENT = 5, 80
#: Smallest sets that get signatures of parts; smaller ones get single shingles.
PART_SIZE = 128
#: Text per reduce task of the signature join; partners compared with one document by one task.
SLOT_BYTES, PARTNERS = 16 << 20, 64
#: A size band uses one of so many parts of the tasks.
BAND_SHARE = 8
#: Bits of a set's parity sketch; members of one group whose sketches one task compares.
SKETCH_BITS, BLOCK = 2048, 4_000
#: Signatures a worker holds before it hands them on.
HELD_SIGNATURES = 1 << 19
#: Turns in which a task groups the signatures of its slot.
TURNS = 8
_CELLS = 3
_NEXT = 0xD6E8FEB86659FD93


def bands(percent: int, most: int) -> np.ndarray:
    """First size of each band: sets similar to one of a band lie in it or the next above or below."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    edges.append(-(-edges[-1] * 100 // percent))
    return np.array(edges, np.int64)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, powers: Powers, width: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, ascending, one row after the other, and their counts."""
    data = LOWER[data]
    starts, ends, before = word_bounds(data, offsets)
    hashes, rows = word_hashes(data, starts, ends, powers), len(offsets) - 1
    counts = np.diff(before)
    row_of = np.repeat(np.arange(rows), counts)
    total = np.zeros(len(hashes), np.uint64)
    left = np.arange(len(hashes)) - before[row_of]
    left = counts[row_of] - left  # words from here to the end of the row
    for step in range(width):
        there = np.flatnonzero(left > step)
        total[there] += hashes[there + step] * np.uint64(pow(_NEXT, step, 1 << 64))
    # a whole window, or the start of a row of fewer words
    keep = (left >= width) | ((counts[row_of] < width) & (left == counts[row_of]))
    shingles = mix(total[keep] + np.minimum(counts[row_of[keep]], width).astype(np.uint64))
    owner = row_of[keep]
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    first = np.ones(len(shingles), bool)
    first[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[first], np.bincount(owner[first], minlength=rows)


def signatures(
    shingles: np.ndarray, counts: np.ndarray, percent: int = PERCENT, part_size: int = PART_SIZE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, row, band joined) of every row's set, in the join of its band and of the band below."""
    found, rows = [], np.arange(len(counts))
    edges = bands(percent, int(counts.max(initial=1)))
    band = np.searchsorted(edges, counts, "right") - 1
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    needed = -(-counts * percent // 100)
    prefix = np.where(counts > 0, counts - needed + 1, 0)
    # single shingles: all sets that a smaller one can be similar to
    few = counts < -(-part_size * 100 // percent)
    owner = np.repeat(rows[few], prefix[few])
    place = np.arange(len(owner)) - np.repeat(np.cumsum(prefix[few]) - prefix[few], prefix[few])
    singles = shingles[begin[owner] + place]
    many = counts >= part_size
    member = np.repeat(rows, counts)
    chosen = np.flatnonzero(many[member])
    member, own = member[chosen], shingles[chosen]
    spread = mix(own ^ np.uint64(0x5851F42D4C957F2D))
    weight = mix(own + np.uint64(0x14057B7EF767814F))
    for down in (0, 1):
        join = np.maximum(band - down, 0)
        name = mix(join.astype(np.uint64) + np.uint64(1) << np.uint64(32))
        found.append((mix(singles ^ name[owner]), owner, join[owner]))
        # differences of a similar pair whose smaller set is in the band, at the most
        differ = (edges[join + 1] - 1) * (100 + percent) // percent * (100 - percent) // (100 + percent) + 1
        part_count = np.where(many, differ // 2 + 1, 0)
        first = np.concatenate([[0], np.cumsum(part_count)])
        part = (spread >> np.uint64(32)) * part_count[member].astype(np.uint64) >> np.uint64(32)
        cell = (spread & np.uint64(0xFFFFFFFF)) * np.uint64(_CELLS) >> np.uint64(32)
        sums = np.zeros(first[-1] * _CELLS, np.uint64)
        np.add.at(sums, ((first[member] + part.astype(np.int64)) * _CELLS + cell.astype(np.int64)), weight)
        sums = sums.reshape(-1, _CELLS)
        row = np.repeat(rows, part_count)
        label = name[row] + (np.arange(len(row)) - first[row]).astype(np.uint64)
        for left_out in range(_CELLS):
            one, other = sums[:, (left_out + 1) % _CELLS], sums[:, (left_out + 2) % _CELLS]
            held = np.flatnonzero((one != 0) | (other != 0))
            value = mix(label[held] * np.uint64(_CELLS) + np.uint64(left_out)) + one[held] + mix(other[held])
            found.append((mix(value), row[held], join[row[held]]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _set_prints(shingles: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """128 bits per set."""
    halves = []
    for salt in (1, 2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(shingles + np.uint64(salt * _NEXT % (1 << 64))))])
        ends = np.cumsum(counts)
        halves.append(sums[ends] - sums[ends - counts])
    return [a.tobytes() + b.tobytes() for a, b in zip(*halves, strict=True)]


def _sketches(shingles: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """For each set and bit, whether an odd number of its shingles fall on the bit.

    A shingle in one set only changes one bit, so sets differ in at least as many shingles as
    their sketches in bits.
    """
    bit = (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.int64) % SKETCH_BITS
    begins, found = np.concatenate([[0], np.cumsum(counts)]), []
    for first in range(0, len(counts), 256):  # a bounded table of bits at a time
        amounts = counts[first : first + 256]
        row = np.repeat(np.arange(len(amounts)), amounts)
        own = bit[begins[first] : begins[first + len(amounts)]]
        odd = np.bincount(row * SKETCH_BITS + own, minlength=len(amounts) * SKETCH_BITS) & 1
        bits = np.packbits(odd.astype(np.uint8).reshape(-1, SKETCH_BITS), axis=1)
        found += [line.tobytes() for line in bits]
    return found


def set_prints(given: DataFrame, width: int) -> DataFrame:
    """(_id, _n, _print, _sketch) of each document's set: size, fingerprint and parity sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        powers = Powers()
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column("_text")):
                shingles, counts = shingle_sets(data, offsets, powers, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(first, last - first),
                        pa.array(counts.astype(np.int64)),
                        pa.array(_set_prints(shingles, counts), pa.binary()),
                        pa.array(_sketches(shingles, counts), pa.binary()),
                    ],
                    ["_id", "_n", "_print", "_sketch"],
                )

    kind = given.schema["_id"].dataType.simpleString()
    return given.mapInArrow(run, f"_id {kind}, _n bigint, _print binary, _sketch binary")


def _distinct_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The pairs in order, each once, as two rows."""
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    fresh = np.ones(len(first), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return np.stack([first[fresh], second[fresh]])


def signature_stars(given: DataFrame, slots: int, width: int, percent: int, part_size: int) -> DataFrame:
    """(_a, _others): documents that are first in groups with one signature, and the others in those groups.

    A document can come once from each slot. Of equal sets in one input partition, the first stands for all.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        powers, seen, held, size = Powers(), set(), [], 0

        def blobs_of() -> pa.RecordBatch:
            values, owners, joins = (np.concatenate(column) for column in zip(*held, strict=True))
            # a band goes to a share of the slots, so that a group's signatures meet in few
            first = mix(joins.astype(np.uint64)) % np.uint64(slots)
            spread = (values >> np.uint64(40)) % np.uint64(max(1, slots // BAND_SHARE))
            slot = ((first + spread) % np.uint64(slots)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            cuts = np.searchsorted(slot[order], np.arange(slots + 1))
            full = np.flatnonzero(np.diff(cuts))
            blobs = [
                [column[order[cuts[s] : cuts[s + 1]]].tobytes() for s in full] for column in (values, owners)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), *(pa.array(b, pa.binary()) for b in blobs)],
                ["_slot", "_signatures", "_owners"],
            )

        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for first, _, data, offsets in text_slices(batch.column("_text")):
                shingles, counts = shingle_sets(data, offsets, powers, width)
                prints = _set_prints(shingles, counts)
                fresh = np.zeros(len(counts), bool)
                for k, own in enumerate(prints):
                    if counts[k] and own not in seen:
                        seen.add(own)
                        fresh[k] = True
                shingles = shingles[np.repeat(fresh, counts)]
                values, rows, joins = signatures(shingles, np.where(fresh, counts, 0), percent, part_size)
                held.append((values, ids[first + rows], joins))
                size += len(values)
                if size >= HELD_SIGNATURES:
                    yield blobs_of()
                    held, size = [], 0
        if size:
            yield blobs_of()

    def groups(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """(first member, other member) of every group with one signature, each once."""
        order = np.argsort(values)
        ordered = values[order]
        same = ordered[1:] == ordered[:-1]
        again = np.zeros(len(order), bool)  # a signature of one document needs no more work
        again[1:] |= same
        again[:-1] |= same
        order = order[again]
        values, owners = values[order], owners[order]
        order = np.lexsort((owners, values))
        values, owners = values[order], owners[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
        values, owners = values[fresh], owners[fresh]
        heads = np.ones(len(values), bool)
        heads[1:] = values[1:] != values[:-1]
        cuts = np.flatnonzero(heads)
        first = np.repeat(owners[cuts], np.diff(np.append(cuts, len(values))) - 1)
        return _distinct_pairs(first, owners[~heads])

    def gather(table: pa.Table) -> pa.Table:
        hand_back()
        values = packed_chunks(table.column("_signatures"), np.uint64)
        owners = packed_chunks(table.column("_owners"), np.int64)
        found = []
        for turn in range(TURNS):  # a share of the signatures at a time
            own = [chunk % np.uint64(TURNS) == turn for chunk in values]
            found.append(
                groups(
                    np.concatenate([chunk[mine] for chunk, mine in zip(values, own, strict=True)]),
                    np.concatenate([chunk[mine] for chunk, mine in zip(owners, own, strict=True)]),
                )
            )
        pairs = _distinct_pairs(*np.concatenate(found, axis=1))
        heads = np.ones(pairs.shape[1], bool)
        heads[1:] = pairs[0, 1:] != pairs[0, :-1]
        heads = np.flatnonzero(heads)
        amounts = np.diff(np.append(heads, pairs.shape[1]))
        return pa.table({"_a": pairs[0, heads], "_others": lists(pairs[1], amounts)})

    blobs = given.mapInArrow(emit, "_slot int, _signatures binary, _owners binary")
    return blobs.groupBy("_slot").applyInArrow(gather, "_a bigint, _others array<bigint>")


def verified(given: DataFrame, pairs: DataFrame, count: int, width: int, percent: int) -> DataFrame:
    """The links among ``pairs`` (_a, _b), each counted exactly on the two texts.

    Each task gets one document and up to about ``PARTNERS`` others, so a document with any number of
    partners is compared in pieces.
    """
    amounts = pairs.groupBy("_a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("_pieces"))
    amounts, known = counted(amounts, "near-amounts")
    pairs = pairs.join(small(amounts, known, 40), "_a").withColumn("_piece", F.pmod(F.xxhash64("_b"), "_pieces").cast("int"))
    partners = given.join(
        small(pairs.select("_a", "_b", "_piece"), count, 60), given["_id"] == F.col("_b")
    ).select("_a", "_piece", "_b", "_text")
    amounts = amounts.select("_a", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("_piece"))
    heads = given.join(small(amounts, count, 40), given["_id"] == F.col("_a")).select(
        "_a", "_piece", F.lit(None).cast(given.schema["_id"].dataType).alias("_b"), "_text"
    )
    together = heads.unionByName(partners).repartition("_a", "_piece").sortWithinPartitions("_a", "_piece", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        powers, head, owner = Powers(), np.zeros(0, np.uint64), None
        for batch in batches:
            first_ids, second_ids = batch.column("_a").to_pylist(), batch.column("_b").to_pylist()
            found: list[tuple] = []
            for first, last, data, offsets in text_slices(batch.column("_text")):
                shingles, counts = shingle_sets(data, offsets, powers, width)
                at = np.concatenate([[0], np.cumsum(counts)])
                for k in range(first, last):
                    own = shingles[at[k - first] : at[k - first + 1]]
                    if second_ids[k] is None:
                        head, owner = own, first_ids[k]
                    elif first_ids[k] == owner:
                        shared = len(np.intersect1d(head, own, assume_unique=True))
                        if 100 * shared >= percent * (len(head) + len(own) - shared):
                            found.append((owner, second_ids[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in found], pa.int64()) for k in (0, 1)], ["_a", "_b"]
            )

    return written(together.mapInArrow(run, "_a bigint, _b bigint"), "near-links")


def _pairs_of_block(percent: int):
    """Pairs of a block that are in different components, one of them unsettled, and not proven dissimilar."""

    def run(table: pa.Table) -> pa.Table:
        hand_back()
        ids, sizes, component, block = (table.column(c).to_numpy() for c in ("_b", "_n", "_component", "_block"))
        odd = table.column("_odd").to_numpy(zero_copy_only=False)
        sketch = np.frombuffer(b"".join(x.as_py() for x in table.column("_sketch")), np.uint64)
        sketch = sketch.reshape(len(ids), SKETCH_BITS // 64)
        low, high = table.column("_low")[0].as_py(), table.column("_high")[0].as_py()
        one, other = np.flatnonzero((block == low) & odd), np.flatnonzero(block == high)
        if low != high:
            one = np.concatenate([one, np.flatnonzero((block == high) & odd)])
            other = np.concatenate([other, np.flatnonzero(block == low)])
        found = []
        for k in one:
            total = sizes[other] + sizes[k]
            fits = (component[other] != component[k]) & (
                100 * np.minimum(sizes[other], sizes[k]) >= percent * np.maximum(sizes[other], sizes[k])
            )
            near = other[fits]
            differ = np.bitwise_count(sketch[near] ^ sketch[k]).sum(axis=1)
            near = near[differ * (100 + percent) <= (100 - percent) * total[fits]]
            found.append(np.stack([np.minimum(ids[near], ids[k]), np.maximum(ids[near], ids[k])]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"_a": pairs[0], "_b": pairs[1]})

    return run


def possible(pairs: DataFrame, count: int, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (_a, _b) that their sizes and sketches do not prove dissimilar."""
    for side in ("_a", "_b"):
        known = sets.select(F.col("_id").alias(side), F.col("_n").alias(f"{side}n"), F.col("_sketch").alias(f"{side}s"))
        pairs = small(pairs, count, 350).join(known, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [
                np.frombuffer(b"".join(x.as_py() for x in batch.column(c)), np.uint64).reshape(-1, SKETCH_BITS // 64)
                for c in ("_as", "_bs")
            ]
            total = batch.column("_an").to_numpy() + batch.column("_bn").to_numpy()
            differ = np.bitwise_count(sketches[0] ^ sketches[1]).sum(axis=1).astype(np.int64)
            yield batch.select(["_a", "_b"]).filter(pa.array(differ * (100 + percent) <= (100 - percent) * total))

    fits = 100 * F.least("_an", "_bn") >= percent * F.greatest("_an", "_bn")
    return pairs.filter(fits).mapInArrow(run, "_a bigint, _b bigint").distinct()


def _rest_pairs(stars: DataFrame, sets: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Pairs (_a, _b) of members of one group that the links so far leave open.

    ``stars`` has (_a first member, _b other member). A member in the first's component is
    settled with it; every other member is compared with all members, large groups block by block.
    """
    known, count = counted(components(linked), "near-components")
    for side in ("_a", "_b"):
        column = small(known.select(F.col("_node").alias(side), F.col("_component").alias(f"{side}c")), count, 24)
        stars = stars.join(column, side, "left").withColumn(f"{side}c", F.coalesce(f"{side}c", side))
    stars = stars.withColumn("_odd", F.col("_ac") != F.col("_bc"))
    sizes = stars.groupBy("_a").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"), F.count_if("_odd").alias("_odds")
    )
    sizes, groups = counted(sizes.filter("_odds > 0").select("_a", "_blocks"), "near-open")
    members = stars.join(small(sizes, groups, 24), "_a").select("_a", "_b", "_odd", F.col("_bc").alias("_component"), "_blocks")
    members, rows = counted(members, "near-members")
    if not rows:
        return members.select("_a", "_b")
    members = small(members, rows, 64).join(sets.select(F.col("_id").alias("_b"), "_n", "_sketch").distinct(), "_b")
    members = members.withColumn("_block", F.pmod(F.xxhash64("_b"), "_blocks").cast("int"))
    members = members.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    members = members.withColumns({"_low": F.least("_block", "_with"), "_high": F.greatest("_block", "_with")})
    pairs = members.groupBy("_a", "_low", "_high").applyInArrow(_pairs_of_block(percent), "_a bigint, _b bigint")
    return pairs.distinct()


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """One row per document: id, n_shingles, class_id, component_id.

    Words are runs of non-blank characters after lower-casing A-Z; a text of fewer words than a
    shingle is one shingle. Documents link when their sets' Jaccard similarity is at least
    ``percent``. ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id reachable by
    links. NULL, empty and blank texts have the empty set and stay alone. Shingles
    are compared by 64-bit hashes. Ids are integers; rows that repeat id and text share their fate, rows that
    share an id but not the text are documents of their own.
    Rows without an id are documents of their own and come after all ids; NULL is the smallest id where there is no other.
    """
    small_batches(docs.sparkSession)
    named, (docs, last, forms) = docs, text_keys(docs, id_col, text_col)
    given = id_and_text(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(text_col))).head()[0] or 0
    sets = written(set_prints(given, width), "near-sets")
    classes = sets.filter("_n > 0").groupBy("_print").agg(F.min("_id").alias("_class"))
    nodes, rows = counted(
        sets.join(classes, "_print", "left").select("_id", "_n", F.coalesce("_class", "_id").alias("_class")), "near-nodes"
    )
    groups = written(
        signature_stars(given, parts(size, SLOT_BYTES), width, percent, part_size), "near-groups"
    )

    def apart(pairs: DataFrame, linked: DataFrame) -> DataFrame:
        """The pairs that links so far do not connect."""
        known, count = counted(components(linked), "near-components")
        for side in ("_a", "_b"):
            column = small(known.select(F.col("_node").alias(side), F.col("_component").alias(f"{side}c")), count, 24)
            pairs = pairs.join(column, side, "left").withColumn(f"{side}c", F.coalesce(f"{side}c", side))
        return pairs.filter("_ac != _bc").drop("_ac", "_bc")

    def compare(pairs: DataFrame) -> DataFrame:
        pairs, count = counted(pairs, "near-pairs")
        return verified(given, pairs, count, width, percent) if count else pairs

    stars = groups.select("_a", F.explode("_others").alias("_b")).distinct()
    for side in ("_a", "_b"):  # ids as their classes
        known = nodes.select(F.col("_id").alias(side), F.col("_class").alias(f"{side}c")).distinct()
        stars = stars.join(small(known, rows, 24), side).drop(side)
    stars = stars.filter("_ac != _bc").select(F.col("_ac").alias("_a"), F.col("_bc").alias("_b")).distinct()
    stars, count = counted(stars, "near-stars")
    fitting = written(possible(stars, count, sets, percent), "near-fitting")
    # one comparison each first: most documents of a group of copies are linked by it
    links = compare(fitting.groupBy("_b").agg(F.min("_a").alias("_a")).select("_a", "_b"))
    links = links.unionByName(compare(apart(fitting, links)))
    links = links.unionByName(compare(_rest_pairs(stars, sets, links, percent)))
    final = components(links)
    result = (
        nodes.join(final, F.col("_class") == F.col("_node"), "left")
        .select(
            F.col("_id").alias(id_col),
            F.col("_n").alias("n_shingles"),
            F.col("_class").alias("class_id"),
            F.coalesce("_component", "_class").alias("component_id"),
        )
    )
    if forms is not None:  # a group's smallest id may be one that another text has kept
        given = F.coalesce("_given", F.when(F.col(id_col) <= last, F.col(id_col)))
        for name in ("class_id", "component_id"):
            least = result.join(forms, F.col(id_col) == F.col("_key"), "left").groupBy(F.col(name).alias("_group")).agg(F.min(given).alias("_least"))
            result = result.join(least, F.col(name) == F.col("_group")).withColumn(name, F.col("_least")).drop("_group", "_least")
        kind = named.schema[id_col].dataType
        result = result.withColumns({name: F.col(name).cast(kind) for name in ("class_id", "component_id")})
        return with_names(result, last, forms, named, id_col)
    return with_names(result, last, forms, named, id_col, "class_id", "component_id")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: the smallest id. All columns unchanged.

    Of rows sharing an id, all but one count as behind all ids.
    """
    keyed = row_keys(docs, id_col)
    kept = near_components(keyed, id_col, text_col).filter(F.col(id_col) == F.col("component_id"))
    return given_ids(keep_rows(keyed, kept, id_col), docs, id_col)
