"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Sources get equal blocks of words by highest quotients; a source's blocks are shared out
over its shards the same way, so every shard has an integer quota. Inside a shard the
documents lie end to end in seeded order, cut into blocks; the quota is met by whole
passes over all blocks plus an evenly spaced choice, with a seeded start, of the rest.
How many words of a document are taken follows from its place by arithmetic alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from engagemart.llm.common import counted, given_ids, row_keys, salted, small

WEIGHTS = (3, 1, 2)
#: Words mixed per word available, and the most times a word is taken.
TOTAL_SHARE, MOST_TIMES = 1.5, 2
BLOCK_WORDS, SHARD_ROWS, SEED = 64, 4_000, 17


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL has none."""
    pieces = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.size(F.array_remove(pieces, "")).cast("long")


def sainte_lague(rows: DataFrame, group: str, key: str, share: str, seats: str) -> DataFrame:
    """``rows`` with ``_quota``: each group's ``seats`` given to its keys by the highest
    quotients share / (2 n - 1); ties go to the smaller key.

    Rounding to the fair share takes exactly the quotients above one bound; only the few
    seats that rounding gives too many or too few are then settled by rank.
    """
    whole = Window.partitionBy(group)
    rows = rows.withColumn("_sum", F.sum(share).over(whole))
    fair = F.when(F.col("_sum") > 0, F.col(share) * F.col(seats) / F.col("_sum")).otherwise(0.0)
    rows = rows.withColumn("_near", F.floor(fair + 0.5))
    rows = rows.withColumn("_lack", F.when(F.col("_sum") > 0, F.col(seats)).otherwise(0) - F.sum("_near").over(whole))
    lack = F.abs(F.col("_lack"))
    # more tries than a key can win of the seats in question
    tries = F.least(lack, F.ceil(F.col("_near") * lack / F.greatest(F.col(seats), F.lit(1))) + 2)
    tries = F.when(F.col("_lack") < 0, F.least(tries, F.col("_near"))).otherwise(tries)
    steps = F.when(tries > 0, F.sequence(F.lit(1).cast("long"), tries.cast("long")))
    more = F.col("_lack") > 0
    divisor = F.when(more, 2 * (F.col("_near") + F.col("_step")) - 1).otherwise(
        2 * (F.col("_near") - F.col("_step")) + 1
    )
    quotient = F.col(share) / divisor
    order = Window.partitionBy(group).orderBy(
        F.when(more, -quotient).otherwise(quotient).asc_nulls_last(), F.when(more, F.col(key)).otherwise(-F.col(key))
    )
    settled = (
        rows.select(group, key, share, "_near", "_lack", F.explode(steps).alias("_step"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= F.abs(F.col("_lack")))
        .groupBy(group, key)
        .agg(F.sum(F.signum("_lack")).cast("long").alias("_change"))
    )
    return (
        rows.join(settled, [group, key], "left")
        .withColumn("_quota", (F.col("_near") + F.coalesce("_change", F.lit(0))).cast("long"))
        .drop("_sum", "_near", "_lack", "_change")
    )


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (_source, _words) with ``_number`` (code point order from 0, NULL last) and ``_target``.

    Targets share the total by weight but stop at ``MOST_TIMES`` times the source; what is
    over goes to the others by weight. The common level is found in one pass over the
    sources ordered by the level at which each of them stops.
    """
    named = Window.orderBy(F.col("_source").asc_nulls_last())
    rows = sources.withColumn("_number", F.row_number().over(named) - 1)
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    rows = rows.withColumn("_weight", F.element_at(weights, F.pmod("_number", F.lit(len(WEIGHTS))) + 1))
    rows = rows.withColumn("_cap", F.col("_words") * float(MOST_TIMES)).withColumn("_stop", F.col("_cap") / F.col("_weight"))
    before = Window.orderBy("_stop", "_number").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    full, used = F.coalesce(F.sum("_cap").over(before), F.lit(0.0)), F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = (F.sum("_words").over(whole) * TOTAL_SHARE - full) / (F.sum("_weight").over(whole) - used)
    rows = rows.withColumn("_level", level)
    reached = F.struct("_stop", "_number", F.col("_level").alias("level"))
    common = F.min(F.when(F.col("_level") <= F.col("_stop"), reached)).over(whole)["level"]
    target = F.least("_cap", F.coalesce(common * F.col("_weight"), F.col("_cap")))
    return rows.withColumn("_target", target).select("_source", "_words", "_rows", "_number", "_target")


def _chosen_before(block: Column, blocks: Column, extra: Column) -> Column:
    """Blocks chosen among the first ``block`` of an endless run in which each ``blocks`` hold ``extra``."""
    whole = F.floor(block / blocks)
    return whole * extra + F.floor((block - whole * blocks) * extra / blocks)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken and ``copies``.

    ``size`` is the document's words (NULL text: 0), ``taken`` the words the mix takes of
    it, repeats counted, at most twice its size. ``copies`` is how often the block of its
    first word is taken: the number of whole copies for mixes of whole documents. Documents without
    words have 0 of both. NULL is a source of its own, last in order, and differs from the
    empty name. Repeated rows are documents of their own, and so are rows without an id. Reruns agree. There is one row
    per source in the apportionment; rows are never gathered by source.
    """
    rows, _ = counted(
        docs.select(
            docs[id_col].alias("_id"),
            docs[source_col].alias("_source"),
            word_count(docs[text_col]).alias("_size"),
            F.xxhash64(docs[text_col]).alias("_hash"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "mix-documents",
    )
    totals = rows.groupBy("_source").agg(F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_rows"))
    sources = targets(totals).withColumn("_all", F.lit(0))
    blocks = F.round(F.sum("_target").over(Window.partitionBy("_all")) / BLOCK_WORDS).cast("long")
    sources = sainte_lague(sources.withColumn("_seats", blocks), "_all", "_number", "_target", "_seats")
    sources = sources.withColumn("_shards", F.ceil(F.col("_rows") / SHARD_ROWS)).select(
        F.col("_source").alias("_name"), "_number", "_words", "_target", "_shards", F.col("_quota").alias("_seats")
    )
    sources, known = counted(sources, "mix-sources")
    rows = rows.join(small(sources, known, 100), F.col("_source").eqNullSafe(F.col("_name")))
    # rows without an id, or of one id, go by their texts; masses of equal rows by their place
    rows = salted(rows, ["_id", "_hash"], SHARD_ROWS)
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64("_id", "_hash", "_salt"), "_shards"))

    shards = rows.groupBy("_number", "_shard").agg(F.sum("_size").alias("_held"), F.first("_seats").alias("_seats"))
    shards = sainte_lague(shards, "_number", "_shard", "_held", "_seats")
    block_count = F.greatest(F.ceil(F.col("_held") / BLOCK_WORDS), F.lit(1))
    shards = shards.withColumn("_blocks", block_count)
    shards = shards.withColumn("_passes", F.floor(F.col("_quota") / F.col("_blocks")))
    shards = shards.withColumn("_extra", F.col("_quota") - F.col("_passes") * F.col("_blocks"))
    shards = shards.withColumn("_start", F.pmod(F.xxhash64(F.lit(SEED), "_number", "_shard"), "_blocks"))
    shards, count = counted(shards.drop("_seats", "_held", "_quota"), "mix-shards")
    rows = rows.join(small(shards, count, 80), ["_number", "_shard"])

    seeded = Window.partitionBy("_number", "_shard").orderBy(F.xxhash64(F.lit(SEED), "_id", "_hash"), "_id", "_size", "_salt")
    begin = F.coalesce(F.sum("_size").over(seeded.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_begin", begin)

    def chosen(block: Column) -> Column:
        return _chosen_before(block + F.col("_start"), F.col("_blocks"), F.col("_extra"))

    def hit(block: Column) -> Column:
        return chosen(block + 1) - chosen(block)

    def words_before(place: Column) -> Column:
        block = F.floor(place / BLOCK_WORDS)
        return chosen(block) * BLOCK_WORDS + (place - block * BLOCK_WORDS) * hit(block)

    size, begin = F.col("_size"), F.col("_begin")
    taken = F.col("_passes") * size + words_before(begin + size) - words_before(begin)
    copies = F.when(size > 0, F.col("_passes") + hit(F.floor(begin / BLOCK_WORDS))).otherwise(0)
    return rows.select(
        F.col("_id").alias(id_col),
        size.alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        F.least(taken, size * MOST_TIMES).cast("long").alias("taken"),
        F.least(copies, F.lit(MOST_TIMES)).cast("int").alias("copies"),
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, each as often as the mix takes it."""
    named, docs = docs, row_keys(docs, id_col)
    taken = mix(docs, id_col).filter("copies > 0").groupBy(F.col(id_col).alias("_taken")).agg(F.max("copies").alias("_copies"))
    taken, count = counted(taken, "mix-copies")
    given = docs.join(small(taken, count, 28), docs[id_col] == F.col("_taken"))
    given = given.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*docs.columns)
    return given_ids(given, named, id_col)
