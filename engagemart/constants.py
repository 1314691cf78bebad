"""Fixed values.

Everything in this file is part of the published meaning of the marts and the
staging tables. Changing a value changes results.
"""

# Raw and mart vocabularies
POST_PRODUCT_TYPES = ("FEED", "REELS")
ACTIVE_FLAG = "N"
WEEKDAYS = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)

# Text patterns
TAG_NAME_NOISE = "maison|official"
HASH_RUN = "#+"
HASH_BREAK = " #"
TOKEN_SEPARATOR = " "
HASHTAG_LIKE = "#_%"

# Time formats
SOURCE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"

# Rounding, limits and thresholds
RATE_DIGITS = 2
AVERAGE_DIGITS = 4
TOP_HASHTAGS = 1000
MIN_SHARE_PERCENT = 50

# Load strategy per entity: method, key, history table
LOAD_METHODS = {
    "brand": ("REPLACE", None, True),
    "media": ("UPSERT", "media_id", True),
    "media_hashtag": ("APPEND", None, False),
}

# Marts of the gated run, and the extra ones of the full run
CORE_MARTS = (
    "brand_basic_info",
    "brand_information",
    "followers_growth",
    "aggregated_brand_information",
    "aggregated_hashtag_search",
    "popularity_factor",
    "popularity_calculation",
    "brand_media_post_time",
    "hashtag_count",
)
EXTRA_MARTS = ("hashtag_search", "trending_topics", "popularity_factor_early_stage")
