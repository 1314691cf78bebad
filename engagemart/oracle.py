"""Expected results of the registered queries as SQL over the shared test tables."""

from __future__ import annotations

from engagemart.constants import CORE_MARTS, EXTRA_MARTS

_VIEWS = {
    "brand": """
select cast(s_suppkey as varchar) user_id, lower(s_name) user_name,
  regexp_replace(lower(s_name), 'supplier|#', '', 'g') tag_name,
  concat('https://img.example/', cast(s_suppkey as varchar)) profile_picture_url,
  cast(greatest(0, floor(s_acctbal)) as int) followers_count, cast(s_nationkey as int) media_count,
  timestamp'2024-02-01 00:00:00' updated_at
from supplier""",
    "media": """
select cast(event_id as varchar) media_id, cast(user_id as varchar) user_id,
  cast(floor(value) as int) like_count, cast(floor(value * 3) as int) % 40 comments_count, ts,
  case when event_id % 3 = 0 then 'VIDEO' else 'IMAGE' end media_type,
  case event_type when 'view' then 'FEED' when 'click' then 'REELS'
    when 'signup' then 'STORY' when 'error' then 'AD' end media_product_type
from events""",
    "media_hashtag": """
select cast(l_orderkey as varchar) media_id, cast(l_suppkey as varchar) user_id,
  case when l_linenumber = 7 then null when l_linenumber = 6 then ''
    else l_returnflag || ' #' || p_type || '##' || replace(p_name, ' ', '#') || ' # ' || p_brand
    end caption,
  l_shipdate ts, 'IMAGE' media_type, l_shipdate created_at
from lineitem left join part on l_partkey = p_partkey""",
    "brand_log": """
select cast(o_custkey % 120 as varchar) user_id,
  cast(floor(o_totalprice) as int) followers_count, o_orderdate created_at
from orders""",
    "brand_information": """
select b.tag_name, b.user_id, b.media_count, b.followers_count, b.updated_at, m.media_id,
  m.like_count, m.comments_count, m.ts, m.media_type, m.media_product_type,
  m.like_count + m.comments_count engagement,
  round((m.like_count + m.comments_count) / nullif(b.followers_count, 0) * 100, 2) engagement_rate,
  cast(hour(m.ts) as int) post_time, cast(dayofweek(m.ts) + 1 as int) day_of_week,
  dayname(m.ts) post_day_of_week
from media m left join brand b on m.user_id = b.user_id
where m.media_product_type in ('FEED', 'REELS')""",
    "brand_basic_info": "select tag_name, profile_picture_url, followers_count, user_id from brand",
    "followers_growth": """
select b.tag_name, l.followers_count, l.created_at
from brand_log l left join brand b on l.user_id = b.user_id""",
    "hashtag_search": """
select b.tag_name, h.media_id, h.caption, h.ts, h.user_id, h.created_at
from media_hashtag h left join brand b on h.user_id = b.user_id""",
    "trending_topics": """
select ts, tag_name, created_at, cast(i - 1 as int) pos, parts[i] related_hashtag from (
  select ts, tag_name, created_at, parts, unnest(range(1, len(parts) + 1)) i from (
    select ts, tag_name, created_at,
      string_split(regexp_replace(caption, '#+', ' #', 'g'), ' ') parts
    from hashtag_search where caption is not null))
where parts[i] like '#_%'""",
    "hashtag_count": """
select related_hashtag, count(*) hashtag_frequency from trending_topics group by related_hashtag""",
    "aggregated_brand_information": """
select tag_name,
  cast(sign(hundredths) * ((200 * abs(hundredths) + rated) // (2 * nullif(rated, 0))) as double) / 10000
    avg_engagement_rate,
  brand_media_cnt
from (
  select tag_name, sum(cast(round(engagement_rate * 100) as bigint)) hundredths,
    count(engagement_rate) rated, count(distinct media_id) brand_media_cnt
  from brand_information group by tag_name)""",
    "aggregated_hashtag_search": """
select tag_name, count(distinct media_id) hashtaged_media_cnt from hashtag_search group by tag_name""",
    "popularity_factor_early_stage": """
select a.tag_name, a.avg_engagement_rate, h.hashtaged_media_cnt
from aggregated_brand_information a left join aggregated_hashtag_search h
  on a.tag_name = h.tag_name""",
    "popularity_factor": """
select p.tag_name, p.avg_engagement_rate, p.hashtaged_media_cnt, b.followers_count,
  cast(rank() over (order by p.avg_engagement_rate desc nulls last) as int) rank_avg_engagement_rate,
  cast(rank() over (order by p.hashtaged_media_cnt desc nulls last) as int) rank_hashtaged_media_cnt,
  cast(rank() over (order by b.followers_count desc nulls last) as int) rank_followers_count
from popularity_factor_early_stage p left join brand_basic_info b on p.tag_name = b.tag_name""",
    "popularity_calculation": """
select tag_name, sum_rank, cast(rank() over (order by sum_rank) as int) popularity_rank from (
  select tag_name,
    rank_avg_engagement_rate + rank_hashtaged_media_cnt + rank_followers_count sum_rank
  from popularity_factor)""",
    "brand_media_post_time": """
select ts, tag_name, post_time, day_of_week, post_day_of_week from brand_information""",
    "brand_documents": """
select s_suppkey user_id,
  concat(case when s_nationkey % 2 = 0 then 'maison' else '' end, replace(lower(s_name), '#', ''),
    case when s_nationkey % 3 = 0 then 'official' else '' end) user_name,
  case when s_nationkey % 5 = 0 then '' when s_nationkey % 7 = 0 then null
    else upper(s_name) end as name,
  concat('https://img.example/', cast(s_suppkey as varchar)) profile_picture_url,
  cast(greatest(0, floor(s_acctbal)) as int) followers_count, cast(s_nationkey as int) media_count
from supplier""",
    "stage_brand": """
select cast(user_id as varchar) user_id, user_name,
  case when name = '' then user_name else name end as name,
  profile_picture_url, followers_count, media_count, 'N' del_yn,
  regexp_replace(user_name, 'maison|official', '', 'g') tag_name,
  '2024-02-01 03:00:00' created_at, '2024-02-01 03:00:00' updated_at
from brand_documents""",
    "stage_media": """
select media_id, user_id,
  case when cast(media_id as bigint) % 10 = 0 then null
    when media_type = 'VIDEO' then strftime(ts - interval 9 hour, '%Y-%m-%d %H:%M:%S')
    else strftime(ts, '%Y-%m-%d %H:%M:%S') end ts,
  like_count, comments_count, media_type, media_product_type,
  'N' del_yn, '2024-02-01 03:00:00' created_at, '2024-02-01 03:00:00' updated_at
from media""",
    "stage_media_hashtag": """
select media_id, user_id, caption, strftime(ts, '%Y-%m-%d %H:%M:%S') ts, media_type,
  '2024-02-01 03:00:00' created_at
from media_hashtag""",
}

# Which views each view reads, in an order that satisfies WITH.
_ORDER = list(_VIEWS)


def _uses(sql: str, name: str) -> bool:
    words = "".join(c if c.isalnum() or c == "_" else " " for c in sql).split()
    return name in words


def _with_views(sql: str) -> str:
    needed, pending = set(), [sql]
    while pending:
        text = pending.pop()
        for name in _ORDER:
            if name not in needed and _uses(text, name):
                needed.add(name)
                pending.append(_VIEWS[name])
    blocks = [f"{name} as ({_VIEWS[name]})" for name in _ORDER if name in needed]
    return f"with {', '.join(blocks)} {sql}" if blocks else sql


def _check(table: str, constraint: str, column: str, metric: str, threshold: float, passed: str) -> str:
    return (
        f"select '{table}' table_name, '{constraint}' constraint_name, '{column}' column_name, "
        f"cast({metric} as double) metric, cast({threshold} as double) threshold, "
        f"{passed} passed from {table}"
    )


def _complete(table: str, column: str) -> str:
    metric = f"count(*) - count({column})"
    return _check(table, "complete", column, metric, 0, f"count(*) = count({column})")


def _unique(table: str, column: str) -> str:
    metric = (
        f"(select count(*) from (select {column} from {table} where {column} is not null "
        f"group by {column} having count(*) > 1))"
    )
    return _check(table, "unique", column, metric, 0, f"count(distinct {column}) = count({column})")


def _integral(table: str, column: str) -> str:
    text = f"trim(cast({column} as varchar))"
    whole = f"regexp_full_match({text}, '[+-]?[0-9]+') and try_cast({text} as bigint) is not null"
    bad = f"count(*) filter (where {column} is not null and not ({whole}))"
    return _check(table, "integral", column, bad, 0, f"{bad} = 0")


def _non_negative(table: str, column: str) -> str:
    bad = f"count(*) filter (where {column} < 0)"
    return _check(table, "non_negative", column, bad, 0, f"{bad} = 0")


def _max_length(table: str, column: str, limit: int) -> str:
    longest = f"max(length({column}))"
    return _check(table, "max_length", column, longest, limit, f"coalesce({longest} <= {limit}, true)")


def _share(table: str, constraint: str, column: str, default: str) -> str:
    share = (
        f"100 - count(case when {column} = {default} then 1 end) * 100 / nullif(count({column}), 0)"
    )
    return _check(table, constraint, column, share, 50, f"coalesce({share} > 50, false)")


_BATTERY_CHECKS = {
    "brand": {
        "isunique_user_id": _unique("brand", "user_id"),
        "isnotnull_user_id": _complete("brand", "user_id"),
        "isunique_tag_name": _unique("brand", "tag_name"),
        "isnotnull_tag_name": _complete("brand", "tag_name"),
    },
    "brand_log": {"isnotnull_user_id": _complete("brand_log", "user_id")},
    "media": {
        "isnotnull_user_id": _complete("media", "user_id"),
        "isunique_media_id": _unique("media", "media_id"),
        "isnotnull_media_id": _complete("media", "media_id"),
        "nonzero_share_like_count": _share("media", "nonzero_share", "like_count", "0"),
        "nonzero_share_comments_count": _share("media", "nonzero_share", "comments_count", "0"),
        "isnotnull_media_type": _complete("media", "media_type"),
        "isnotnull_media_product_type": _complete("media", "media_product_type"),
    },
    "media_hashtag": {
        "isnotnull_user_id": _complete("media_hashtag", "user_id"),
        "isnotnull_media_id": _complete("media_hashtag", "media_id"),
        "nonempty_share_caption": _share("media_hashtag", "nonempty_share", "caption", "''"),
        "isnotnull_media_type": _complete("media_hashtag", "media_type"),
    },
}


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


def _battery(table: str) -> str:
    picks = [
        f"(select passed from ({check})) {flag}" for flag, check in _BATTERY_CHECKS[table].items()
    ]
    return "select " + ", ".join(picks)


_ALL_CHECKS = [check for battery in _BATTERY_CHECKS.values() for check in battery.values()]

_LOADED_MEDIA = """
select media_id, user_id, like_count, comments_count, cast(ts as timestamp) ts, media_type,
  media_product_type, del_yn, cast(created_at as timestamp) created_at,
  cast(updated_at as timestamp) updated_at
from stage_media"""

_CAUGHT_UP = f"""
select cast(post as varchar) media_id, user_id, like_count, comments_count, ts, media_type,
  media_product_type, del_yn, arrived created_at, arrived updated_at
from (
  select *, row_number() over (partition by post order by arrived desc) place
  from (
    select *, cast(media_id as bigint) // 4 post,
      timestamp'2024-02-01 00:00:00' + to_hours(cast(media_id as bigint) % 4) arrived
    from ({_LOADED_MEDIA})))
where place = 1"""

_UPSERTED = """
select media_id, user_id, like_count, comments_count, cast(null as varchar) media_type, updated_at
from (
  select *, row_number() over (partition by media_id
    order by updated_at desc, user_id desc, like_count desc, comments_count desc) place
  from (select cast(l_orderkey as varchar) media_id, cast(l_suppkey as varchar) user_id,
      cast(l_quantity as int) like_count, cast(l_linenumber as int) comments_count,
      l_shipdate updated_at from lineitem))
where place = 1
union all
select media_id, user_id, like_count, comments_count, media_type, ts updated_at
from media m where not exists (
  select 1 from lineitem where cast(l_orderkey as varchar) = m.media_id)"""

_LATEST_STATES = """
select media_id, user_id, like_count, comments_count, updated_at
from (
  select *, row_number() over (partition by media_id
    order by updated_at desc, user_id desc, like_count desc, comments_count desc) place
  from (select cast(l_orderkey as varchar) media_id, cast(l_suppkey as varchar) user_id,
      cast(l_quantity as int) like_count, cast(l_linenumber as int) comments_count,
      l_shipdate updated_at from lineitem))
where place = 1"""


def _logged(hour: str, time: str) -> str:
    return (
        "select user_id, tag_name, followers_count, "
        f"timestamp'{time}' created_at, '{hour}' load_slice from stage_brand"
    )


def _counted(name: str) -> str:
    rows = "least(count(*), 1000)" if name == "hashtag_count" else "count(*)"
    return f"select '{name}' mart, cast({rows} as bigint) as \"rows\" from {name}"


def _scanned(table: str, key: str) -> str:
    return (
        f"select '{table}' table_name, count(*) as \"rows\", cast(min({key}) as bigint) lowest_key, "
        f"cast(max({key}) as bigint) highest_key from {table}"
    )


_TOP = """
select related_hashtag, hashtag_frequency from hashtag_count
order by hashtag_frequency desc, related_hashtag limit {limit}"""

_PLAIN = {
    name: f"select * from {name}"
    for name in (
        "brand_basic_info",
        "brand_information",
        "followers_growth",
        "hashtag_search",
        "trending_topics",
        "hashtag_count",
        "aggregated_brand_information",
        "aggregated_hashtag_search",
        "popularity_factor_early_stage",
        "popularity_factor",
        "popularity_calculation",
        "brand_media_post_time",
        "stage_brand",
        "stage_media",
        "stage_media_hashtag",
    )
}

_QUERIES = _PLAIN | {
    "feed_reels_filter": """
select media_id, media_product_type from media where media_product_type in ('FEED', 'REELS')""",
    "hashtag_topk": _TOP.format(limit=10),
    "hashtag_count_canonical": _TOP.format(limit=1000),
    "publish_mart": "select * from aggregated_hashtag_search",
    "mart_row_counts": _union([_counted(name) for name in (*CORE_MARTS, *EXTRA_MARTS)]),
    "scan_raw_tables": _union(
        [
            _scanned("supplier", "s_suppkey"),
            _scanned("events", "user_id"),
            _scanned("lineitem", "l_suppkey"),
            _scanned("orders", "o_custkey"),
        ]
    ),
    "json_decode": "select event_id, cast(json_extract(props, '$.k') as int) k from events",
    "stage_roundtrip": "select * from stage_media",
    "slice_inventory": """
select concat('ds=', strftime(ts, '%Y-%m-%d'), '/hh=', cast(hour(ts) as varchar)) slice,
  count(*) as "rows" from events group by 1""",
    "slice_filter": """
select event_id, value, strftime(ts, '%Y-%m-%d') ds, cast(hour(ts) as int) hh from events
where cast(ts as date) between date'2024-01-08' and date'2024-01-14'""",
    "etl_media": _LOADED_MEDIA,
    "ingest_backlog": _CAUGHT_UP,
    "etl_contract_columns": """
select media_id, cast(ts as timestamp) ts, like_count, media_type,
  concat('p"[{', media_id) shortcode, cast(media_id as bigint) * 7 view_count
from stage_media where media_type = 'IMAGE' and media_product_type is not null""",
    "json_array_split": "select * from pages",
    "contract_drift": """
select field, cast(sum(documents) as bigint) documents,
  case when not max(expected) then 'unknown' when sum(documents) = 0 then 'missing' else 'known' end status
from (
  select unnest(['media_id', 'user_id', 'timestamp', 'like_count', 'comments_count', 'media_type',
    'media_product_type', 'shortcode', 'view_count', 'location']) field, 0 documents, true expected
  union all select unnest(['media_id', 'user_id', 'timestamp', 'like_count', 'comments_count', 'media_type',
    'shortcode', 'view_count']), 1, false from media
  union all select 'media_product_type', 1, false from media where media_product_type is not null
  union all select 'campaign', 1, false from media where like_count > 20)
group by field""",
    "elt_gated_hashtag_count": _TOP.format(limit=1000),
    "elt_gated_aggregated_brand_information": "select * from aggregated_brand_information",
    "elt_gated_popularity_calculation": "select * from popularity_calculation",
    "ingest_available_now": """
select media_id, user_id, caption, cast(ts as timestamp) ts, media_type,
  cast(created_at as timestamp) created_at from stage_media_hashtag""",
    "quality_failures": f"select * from ({_union(_ALL_CHECKS)}) where not passed",
    "check_unique": """
select media_id, count(*) n from media_hashtag group by media_id having count(*) > 1""",
    "check_unique_hashed": " union all ".join(
        f"""select '{column}' column_name, cast({column} as varchar) as "value", count(*) n from {table}
where {column} is not null group by {column} having count(*) > 1"""
        for table, column in (
            ("orders", "o_orderkey"), ("customer", "c_name"), ("media_hashtag", "media_id"), ("media", "media_product_type"),
        )
    ),
    "check_complete": _union(
        [
            _complete("media_hashtag", column)
            for column in ("media_id", "user_id", "caption", "ts", "media_type", "created_at")
        ]
    ),
    "check_integral": _union(
        [_integral("media_hashtag", c) for c in ("media_id", "user_id", "caption", "media_type")]
    ),
    "check_non_negative": _union(
        [_non_negative("customer", "c_acctbal"), _non_negative("customer", "c_nationkey")]
    ),
    "check_max_length": _union(
        [_max_length("media_hashtag", "caption", 40), _max_length("media_hashtag", "media_type", 5)]
    ),
    "contract_projection": """
select media_id, ts, media_type, media_product_type, like_count, comments_count, user_id
from stage_media""",
    "contract_rules": _union(
        [
            _unique("media", "media_id"),
            *[_complete("media", c) for c in ("media_id", "media_type", "media_product_type", "user_id")],
            _integral("media", "like_count"),
            _non_negative("media", "like_count"),
            _integral("media", "comments_count"),
            _non_negative("media", "comments_count"),
            _max_length("media", "media_type", 5),
            _max_length("media", "media_product_type", 4),
        ]
    ),
    "load_replace": """
select user_id, user_name, name, tag_name, profile_picture_url, followers_count, media_count,
  del_yn, cast(created_at as timestamp) created_at, cast(updated_at as timestamp) updated_at
from stage_brand""",
    "load_upsert": _UPSERTED,
    "load_upsert_batches": _LATEST_STATES,
    "load_upsert_late": _LATEST_STATES,
    "load_append": "select media_id, user_id, caption, ts, media_type, created_at from media_hashtag",
    "load_append_corrected": """
select media_id, caption, created_at, strftime(created_at, '%Y') load_slice
from media_hashtag where year(created_at) % 2 = 0""",
    "load_log_append": _union(
        [_logged(f"hour-0{h}", f"2024-02-01 0{h}:00:00") for h in (2, 3, 4)]
    ),
    "incremental_rates": "select * from aggregated_brand_information",
    "incremental_reach": "select * from aggregated_hashtag_search",
    "distributed_rank": """
select l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_partkey,
  rank() over (order by l_extendedprice desc nulls last) rank_price,
  rank() over (order by l_quantity desc nulls last) rank_quantity,
  rank() over (order by l_partkey nulls first) rank_part
from lineitem""",
    **{f"quality_{table}": _battery(table) for table in _BATTERY_CHECKS},
}

ORACLE_SQL = {name: _with_views(sql) for name, sql in _QUERIES.items()}
