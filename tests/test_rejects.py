"""Wrong values in raw documents stop the load and are listed."""

import json

import pytest

from engagemart.operators.quality import QualityError
from engagemart.operators.ranking import Rank, add_ranks
from engagemart.plans.etl import raw_store, run_etl

DATE = "2024-02-01T03:00:00+00:00"


def _media(number, likes):
    return {
        "media_id": str(number), "user_id": "7", "timestamp": "2024-01-01T00:00:00+0000", "like_count": likes,
        "comments_count": 1, "media_type": "IMAGE", "media_product_type": "FEED",
    }


def _run(spark, tmp_path, entity, documents):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text(json.dumps(documents))
    store = raw_store(spark, str(tmp_path / "store"))
    run_etl(store, entity, str(tmp_path / "raw"), str(tmp_path / "stage"), DATE, "s1")
    return store.read(entity)


@pytest.mark.parametrize(
    "bad,constraint", [("abc", "integral"), (3000000000, "fits_integer"), (12.5, "integral"), (-1, "non_negative")]
)
def test_wrong_counts_stop_the_load(spark, tmp_path, bad, constraint):
    with pytest.raises(QualityError) as error:
        _run(spark, tmp_path, "media", [_media(1, 5), _media(2, bad), _media(3, None)])
    assert [(f.column_name, f.constraint_name, f.metric) for f in error.value.failures] == [
        ("like_count", constraint, 1.0)
    ]


def test_right_counts_load_as_integers(spark, tmp_path):
    rows = _run(spark, tmp_path, "media", [_media(1, 5), _media(2, "6"), _media(3, None)])
    assert dict(rows.dtypes)["like_count"] == "int"
    assert sorted((r.media_id, r.like_count) for r in rows.collect()) == [("1", 5), ("2", 6), ("3", None)]


def test_brand_ids_may_be_text_or_numbers(spark, tmp_path):
    documents = [
        {"user_id": "17841400000000000", "user_name": "a", "name": "A", "followers_count": 1, "media_count": 2},
        {"user_id": 42, "user_name": "b", "name": "B", "followers_count": 1, "media_count": 2},
    ]
    rows = _run(spark, tmp_path, "brand", documents)
    assert sorted(r.user_id for r in rows.collect()) == ["17841400000000000", "42"]


@pytest.mark.parametrize("rows_per_range", [1, 100])
def test_ranking_refuses_text_at_every_size(spark, rows_per_range):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    with pytest.raises(TypeError):
        add_ranks(df, [Rank("c", "r")], rows_per_range=rows_per_range)


def test_hot_decimal_is_split(spark):
    df = spark.range(0, 3000).selectExpr("cast(if(id % 3 = 0, 5, id) as decimal(15,2)) c")
    ranked = add_ranks(df, [Rank("c", "r")], rows_per_range=100)
    plain = add_ranks(df, [Rank("c", "r")], rows_per_range=10_000)
    assert sorted(ranked.collect()) == sorted(plain.collect())
