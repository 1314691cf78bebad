"""Explicit schemas: raw JSON documents, raw tables and the column contract.

Reading JSON with a schema saves the inference pass over the slice and keeps
types from drifting between slices.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG, _TIME = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.TimestampNTZType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_DOCUMENTS = {
    "brand": struct(
        user_id=_LONG,
        user_name=_STRING,
        name=_STRING,
        profile_picture_url=_STRING,
        followers_count=_INT,
        media_count=_INT,
    ),
    "media": struct(
        media_id=_STRING,
        user_id=_STRING,
        timestamp=_STRING,
        like_count=_INT,
        comments_count=_INT,
        media_type=_STRING,
        media_product_type=_STRING,
    ),
    "media_hashtag": struct(
        media_id=_STRING,
        user_id=_STRING,
        caption=_STRING,
        timestamp=_STRING,
        media_type=_STRING,
    ),
}

def text_documents(entity: str) -> T.StructType:
    """The fields of a raw document as text, so that a wrong value can be checked before it is cast."""
    return struct(**{field.name: _STRING for field in RAW_DOCUMENTS[entity].fields})


RAW_TABLES = {
    "brand": struct(
        user_id=_STRING,
        user_name=_STRING,
        name=_STRING,
        tag_name=_STRING,
        profile_picture_url=_STRING,
        followers_count=_INT,
        media_count=_INT,
        del_yn=_STRING,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "media": struct(
        media_id=_STRING,
        user_id=_STRING,
        like_count=_INT,
        comments_count=_INT,
        ts=_TIME,
        media_type=_STRING,
        media_product_type=_STRING,
        del_yn=_STRING,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "media_hashtag": struct(
        media_id=_STRING,
        user_id=_STRING,
        caption=_STRING,
        ts=_TIME,
        media_type=_STRING,
        created_at=_TIME,
    ),
}
RAW_TABLES["brand_log"] = RAW_TABLES["brand"]
RAW_TABLES["media_log"] = RAW_TABLES["media"]

CONTRACT = T.StructType(
    [
        T.StructField("column_name", _STRING, False),
        T.StructField("is_nullable", _STRING),
        T.StructField("data_type", _STRING),
        T.StructField("character_maximum_length", _INT),
        T.StructField("unique_name", _STRING),
    ]
)

# Warehouse type names -> Spark types, for contracts read from a catalog.
CONTRACT_TYPES = {
    "integer": _INT,
    "bigint": _LONG,
    "smallint": T.ShortType(),
    "double precision": T.DoubleType(),
    "real": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "character varying": _STRING,
    "character": _STRING,
    "text": _STRING,
    "timestamp without time zone": _TIME,
    "timestamp with time zone": T.TimestampType(),
}

# What queries over a publication log need of its commits.
COMMITS = struct(
    run_id=_STRING, published_at=_LONG, put=T.MapType(_STRING, struct(path=_STRING))
)
SUPERSEDED = struct(table_name=_STRING, path=_STRING, micros=_LONG)

CHECK_RESULTS = struct(
    table_name=_STRING,
    constraint_name=_STRING,
    column_name=_STRING,
    metric=T.DoubleType(),
    threshold=T.DoubleType(),
    passed=T.BooleanType(),
)

BUCKET_LAYOUT = struct(key=_STRING, buckets=_INT)
STORE_LAYOUT = T.StructType([*BUCKET_LAYOUT.fields, T.StructField("recency", T.ArrayType(_STRING))])
