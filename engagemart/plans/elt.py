"""Mart job: check the raw tables, build the marts, publish them together.

Each mart is written once and the marts on top of it are built from the written
table, so the fact tables are scanned once per use of a column and no intermediate
result has to stay in executor memory.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from engagemart import constants as K
from engagemart.operators import quality as Q
from engagemart.operators.ranking import rankable
from engagemart.plans import marts as M
from engagemart.sinks.publish import TableStore
from engagemart.sinks.tables import TableTarget


def run_elt(
    raw: dict[str, DataFrame],
    store: TableStore,
    run_id: str,
    with_gate: bool = True,
    all_marts: bool = False,
    round_avg: int | None = K.AVERAGE_DIGITS,
    top_k: int | None = K.TOP_HASHTAGS,
    with_post_time: bool = True,
) -> None:
    """Publish the core marts, or all twelve with ``all_marts``.

    Nothing becomes visible unless the gate passes and every mart is written. The
    gate also proves brand and post ids unique, which spares the hashtag counts the
    brand join and the post counts a distinct; without it both are done in full.
    """
    if with_gate:
        Q.enforce(Q.verify_tables(raw))
    run = store.run(run_id)
    brands = M.brand_lookup(raw["brand"])

    def profiles() -> DataFrame:
        run.write("followers_growth", M.followers_growth(raw["brand_log"], brands))
        return run.write("brand_basic_info", M.brand_basic_info(raw["brand"]))

    def posts() -> DataFrame:
        information = M.brand_information(raw["media"], brands, with_post_time)
        information = run.write("brand_information", information)
        run.write("brand_media_post_time", M.brand_media_post_time(information))
        by_brand = M.aggregated_brand_information(information, round_avg, media_ids_unique=with_gate)
        return run.write("aggregated_brand_information", by_brand)

    def hashtags() -> DataFrame:
        search = M.hashtag_search(raw["media_hashtag"], brands)
        if all_marts:
            search = run.write("hashtag_search", search)
            topics = run.write("trending_topics", M.trending_topics(search))
            run.write("hashtag_count", M.hashtag_count_of_topics(topics, top_k))
        else:
            captions = raw["media_hashtag"] if with_gate else search
            run.write("hashtag_count", M.hashtag_count(captions, top_k))
        return run.write("aggregated_hashtag_search", M.aggregated_hashtag_search(search))

    # Independent branches are submitted together, so one fills the cluster while the
    # last tasks of another still run.
    with ThreadPoolExecutor() as pool:
        branches = [
            pool.submit(inheritable_thread_target(store.spark)(branch))
            for branch in (posts, hashtags, profiles)
        ]
        by_brand, by_hashtag, basic = [branch.result() for branch in branches]

    early = M.popularity_factor_early_stage(by_brand, by_hashtag)
    if all_marts:
        early = run.write("popularity_factor_early_stage", early)
    inputs, rows = rankable(
        M.popularity_inputs(early, basic), M.popularity_bound(brands), "popularity"
    )
    factor = run.write("popularity_factor", M.popularity_factor(inputs, rows))
    run.write("popularity_calculation", M.popularity_calculation(factor, rows))
    run.commit()


def export_marts(
    store: TableStore, target: TableTarget, names: Iterable[str] = K.CORE_MARTS
) -> None:
    """Copy published marts of one moment into a warehouse, each replacing its table.

    The published files stay the source, so an export that breaks off is repeated
    without computing anything again.
    """
    for name, mart in store.read_all(tuple(names)).items():
        target.write(mart, name)
