from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from engagemart.functions import columns as C
from engagemart.functions import hashtags as H

EXAMPLE = "x ##a#b # c#d\n#e, #Ä"


def test_engagement_and_rate(spark):
    data = [
        (10, 5, 100, 15, 15.0),
        (10, 5, 0, 15, None),
        (10, 5, None, 15, None),
        (None, 5, 100, None, None),
        (107, 0, 4000, 107, 2.68),  # 2.675 rounds half up
        (2**31 - 1, 1, 10, None, None),
    ]
    df = spark.createDataFrame(data, "likes int, comments int, followers int, e int, r double")
    engaged = C.engagement(F.col("likes"), F.col("comments"))
    got = df.select(engaged.alias("a"), C.engagement_rate(engaged, F.col("followers")).alias("b"), "e", "r")
    for row in got.collect():
        assert (row.a, row.b) == (row.e, row.r)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(-(10**4), 10**6), st.integers(0, 10**13)), max_size=50),
    st.sampled_from([0, 1, 2, 4, 6]),
)
def test_average_is_exact(spark, hundredths, digits):
    data = [(None if h is None else h / 100,) for h in hundredths]
    got = spark.createDataFrame(data, "r double").agg(C.exact_average(F.col("r"), digits)).first()[0]
    present = [h for h in hundredths if h is not None]
    if not present:
        assert got is None
        return
    scaled = Fraction(sum(present), 100 * len(present)) * 10**digits
    rounded = int(abs(scaled) + Fraction(1, 2)) * (1 if scaled >= 0 else -1)
    assert got == rounded / 10**digits


def test_average_rounds_a_tie_up_in_any_order(spark):
    rates = [1.0] * 7 + [0.99]  # the mean is exactly 0.99875
    for order in (rates, rates[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "r double").repartition(3)
        assert df.agg(C.exact_average(F.col("r"), 4)).first()[0] == 0.9988


def test_weekday_names(spark):
    df = spark.createDataFrame([("2024-01-07 23:59:59",), ("2024-01-08 00:00:00",), (None,)], "t string")
    posting = C.posting_time(F.col("t").cast("timestamp_ntz"))
    got = [tuple(r) for r in df.select(*posting.values()).collect()]
    assert got == [(23, 1, "Sunday"), (0, 2, "Monday"), (None, None, None)]


def test_tag_name_and_name_fill(spark):
    df = spark.createDataFrame(
        [("officialmaisonXofficial", ""), ("maison", None), ("Maison", "N")], "user_name string, name string"
    )
    got = df.select(C.tag_name(F.col("user_name")), C.filled_name(F.col("name"), F.col("user_name")))
    assert [tuple(r) for r in got.collect()] == [
        ("X", "officialmaisonXofficial"),
        ("", None),
        ("Maison", "N"),
    ]


def test_source_time(spark):
    data = {
        "2024-02-01T03:00:00+0000": "2024-02-01 03:00:00",
        "2024-02-01T03:00:00Z": "2024-02-01 03:00:00",
        "2024-02-01T03:00:00+09": "2024-01-31 18:00:00",
        "2024-02-01T03:00:00+0900": "2024-01-31 18:00:00",
        "2024-02-01T03:00:00+00:00": None,
        "bad": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in data], "t string")
    got = df.select("t", C.source_time_text(F.col("t"))).collect()
    assert {r[0]: r[1] for r in got} == data


def test_times_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([("2024-03-31T01:30:00Z",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        got = df.select(
            C.source_time_text(F.col("t")), C.logical_time_text("2024-03-31T01:30:00+00:00")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("2024-03-31 01:30:00",) * 2


def test_hashtag_positions(spark):
    df = spark.createDataFrame([(1, EXAMPLE), (2, None), (3, ""), (4, "nohash"), (5, "#")], "id int, caption string")
    got = {(r.id, r.pos, r.related_hashtag) for r in H.positioned_hashtags(df, ["id"]).collect()}
    assert got == {(1, 2, "#a"), (1, 3, "#b"), (1, 7, "#d\n"), (1, 8, "#e,"), (1, 10, "#Ä")}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="#ab \n\t,Ä😀", max_size=30), min_size=1, max_size=60))
def test_both_extractions_agree(spark, captions):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(captions)], "id int, caption string")
    with_positions = sorted(r.related_hashtag for r in H.positioned_hashtags(df, []).collect())
    without = sorted(r.related_hashtag for r in H.hashtags(df).collect())
    by_hand = []
    for caption in captions:
        for piece in caption.split("#")[1:]:
            if piece.split(" ")[0]:
                by_hand.append("#" + piece.split(" ")[0])
    assert with_positions == without == sorted(by_hand)


def test_top_hashtags_break_ties_by_name(spark, plan):
    tags = spark.createDataFrame([("#b",), ("#a",), ("#c",), ("#c",)], "related_hashtag string")
    top = H.hashtag_frequency(tags, 2)
    assert [tuple(r) for r in top.collect()] == [("#c", 2), ("#a", 1)]
    assert "TakeOrderedAndProject" in plan(top)
    assert H.hashtag_frequency(tags).count() == 3
