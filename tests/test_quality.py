import pytest
from pyspark.sql import Row

from engagemart.operators import quality as Q


def outcome(df, rule):
    row = Q.verify(df, [rule], "t").first()
    return row.metric, row.passed


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c int")


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c string")


@pytest.mark.parametrize(
    "values, expected",
    [([], (0.0, True)), ([None, None], (0.0, True)), ([1, 2, None], (0.0, True)), ([1, 1, 2, 2, 3], (2.0, False))],
)
def test_unique(spark, values, expected):
    assert outcome(ints(spark, values), Q.unique("c")) == expected


@pytest.mark.parametrize("values, expected", [([], (0.0, True)), ([1], (0.0, True)), ([1, None], (1.0, False))])
def test_complete(spark, values, expected):
    assert outcome(ints(spark, values), Q.complete("c")) == expected


@pytest.mark.parametrize(
    "values, expected",
    [
        (["1", "-2", "+3", " 4 ", None], (0.0, True)),
        (["1.5", "x", "", "1e3", "99999999999999999999"], (5.0, False)),
    ],
)
def test_integral_text(spark, values, expected):
    assert outcome(texts(spark, values), Q.integral("c")) == expected


def test_integral_follows_try_cast(spark):
    df = texts(spark, ["1", "-2", " 7", "7 ", "+", "-", "", "1.0", "0x1", "9223372036854775808", None, "٣"])
    expected = df.selectExpr("count_if(c is not null and try_cast(c as bigint) is null) n").first().n
    assert Q.verify(df, [Q.integral("c")], "t").first().metric == expected


def test_integral_double_fails(spark):
    df = spark.createDataFrame([(1.0,)], "c double")
    assert outcome(df, Q.integral("c")) == (1.0, False)


@pytest.mark.parametrize("values, expected", [([0, 1, None], (0.0, True)), ([-1, 1], (1.0, False))])
def test_non_negative(spark, values, expected):
    assert outcome(ints(spark, values), Q.non_negative("c")) == expected


def test_max_length(spark):
    assert outcome(texts(spark, ["abc", None]), Q.max_length("c", 3)) == (3.0, True)
    assert outcome(texts(spark, ["abcd"]), Q.max_length("c", 3)) == (4.0, False)
    assert outcome(texts(spark, []), Q.max_length("c", 3)) == (None, True)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([0, 1], (50.0, False)),
        ([0, 1, 1], (100 - 100 / 3, True)),
        ([], (None, False)),
        ([None, None], (None, False)),
        ([None, 1], (100.0, True)),
    ],
)
def test_nonzero_share(spark, values, expected):
    assert outcome(ints(spark, values), Q.nonzero_share("c")) == expected


def test_nonempty_share(spark):
    assert outcome(texts(spark, ["", "a", None]), Q.nonempty_share("c")) == (50.0, False)


CONTRACT = [
    Row(column_name="id", is_nullable="NO", data_type="character varying", character_maximum_length=3, unique_name="id"),
    Row(column_name="n", is_nullable="YES", data_type="integer", character_maximum_length=None, unique_name=None),
    Row(column_name="s", is_nullable="NO", data_type="character varying", character_maximum_length=5, unique_name=None),
]


def test_rules_from_contract():
    assert Q.rules_from_contract(CONTRACT) == [
        Q.unique("id"), Q.complete("id"), Q.complete("s"), Q.integral("n"), Q.non_negative("n"),
    ]
    assert Q.rules_from_contract(CONTRACT, with_max_length=True)[-1:] == [Q.max_length("s", 5)]


def test_enforce_names_every_failure(spark):
    df = spark.createDataFrame([("a", -1, None), ("a", 1, "s")], "id string, n int, s string")
    results = Q.verify(df, Q.rules_from_contract(CONTRACT), "t")
    with pytest.raises(Q.QualityError) as error:
        Q.enforce(results)
    failed = {(f.constraint_name, f.column_name) for f in error.value.failures}
    assert failed == {("unique", "id"), ("complete", "s"), ("non_negative", "n")}
    assert "t.id" in str(error.value) and "t.s" in str(error.value)
    Q.enforce(Q.verify(df, [Q.complete("id")], "t"))


def test_no_rules(spark):
    assert Q.verify(ints(spark, [1]), [], "t").collect() == []


def test_flags_row(spark):
    df = spark.createDataFrame([("1", "t"), ("2", None)], "user_id string, tag_name string")
    rules = Q.BATTERIES["brand"]
    assert Q.flags(Q.verify(df, rules, "brand"), rules).first().asDict() == {
        "isunique_user_id": True,
        "isnotnull_user_id": True,
        "isunique_tag_name": True,
        "isnotnull_tag_name": False,
    }


@pytest.mark.parametrize("values", [[], [1, 1, None, -4], [3]])
def test_checks_riding_on_the_write_agree(spark, rows, tmp_path, values):
    df = ints(spark, values)
    rules = [Q.unique("c"), Q.complete("c"), Q.non_negative("c"), Q.nonzero_share("c"), Q.integral("c")]
    direct = Q.verify(df, rules, "t")
    written = Q.verify_written(df, rules, "t", str(tmp_path / "w"))
    assert rows(direct) == rows(written)
    assert rows(spark.read.parquet(str(tmp_path / "w"))) == rows(df)


def test_uniqueness_only_on_write(spark, tmp_path):
    results = Q.verify_written(ints(spark, [1, 1]), [Q.unique("c")], "t", str(tmp_path / "w"))
    assert results.first().passed is False


def test_additive_rules_share_one_aggregate_without_row_shuffle(spark, plan):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_type c", "value v", "user_id u"
    )
    results = Q.verify(df, [Q.complete("c"), Q.non_negative("v"), Q.nonzero_share("u")], "t")
    text = plan(results)
    assert text.count("FileScan") == 1
    assert "Exchange SinglePartition" in text and "hashpartitioning" not in text


def test_views_and_whole_gate(spark):
    import raw

    tables = raw.tables(spark)
    Q.register_views(spark, tables)
    assert spark.sql("select count(*) from media").first()[0] == 8
    results = Q.verify_tables(tables)
    assert results.count() == sum(len(rules) for rules in Q.BATTERIES.values()) == 16
    Q.enforce(results)
