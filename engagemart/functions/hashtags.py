"""Hashtag extraction from captions.

A hashtag starts at a ``#``, runs to the next space or ``#`` and has at least one
character after the ``#``. Newlines, tabs and punctuation belong to the tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engagemart import constants as K


def caption_tokens(caption: Column) -> Column:
    """All space-separated tokens, empty ones included, with every tag split off."""
    return F.split(F.regexp_replace(caption, K.HASH_RUN, K.HASH_BREAK), K.TOKEN_SEPARATOR)


def positioned_hashtags(captions: DataFrame, keep: list[str]) -> DataFrame:
    """One row per hashtag with its 0-based place among all tokens."""
    tokens = F.posexplode(caption_tokens(F.col("caption"))).alias("pos", "related_hashtag")
    return captions.select(*keep, tokens).where(F.col("related_hashtag").like(K.HASHTAG_LIKE))


def hashtags(captions: DataFrame) -> DataFrame:
    """The same hashtags without positions.

    One regular expression picks the tags, so the words between them are never
    turned into rows.
    """
    tags = F.regexp_extract_all(F.col("caption"), F.lit("#[^# ]+"), F.lit(0))
    return captions.select(F.explode(tags).alias("related_hashtag"))


def hashtag_frequency(tags: DataFrame, top_k: int | None = None) -> DataFrame:
    """Rows per hashtag, optionally only the ``top_k`` most frequent ones.

    Ties at the limit go to the alphabetically first hashtag.
    """
    counts = tags.groupBy("related_hashtag").agg(F.count(F.lit(1)).alias("hashtag_frequency"))
    if top_k is None:
        return counts
    return counts.orderBy(F.desc("hashtag_frequency"), F.asc("related_hashtag")).limit(top_k)
