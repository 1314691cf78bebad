import json
from datetime import datetime

import pytest
import raw
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

from engagemart import constants as K
from engagemart.__main__ import main
from engagemart.operators.quality import QualityError
from engagemart.plans import marts as M
from engagemart.plans.elt import export_marts, run_elt
from engagemart.plans.etl import raw_store, run_etl
from engagemart.scratch import new_path
from engagemart.session import settings
from engagemart.sinks.publish import TableStore
from engagemart.sinks.tables import TableTarget
from engagemart.sources.contract import ContractError
from engagemart.streaming.ingest import ingest_available

RUN = "2024-02-01T03:00:00+00:00"


def brand(user_id, name="", followers=10):
    return dict(user_id=user_id, user_name=f"maisonx{user_id}", name=name, profile_picture_url="u",
                followers_count=followers, media_count=2)


def media(media_id, likes=3, ts="2024-01-07T23:30:00+0000"):
    return dict(media_id=media_id, user_id="1", timestamp=ts, like_count=likes, comments_count=1,
                media_type="IMAGE", media_product_type="FEED")


def slice_of(tmp_path, name, documents):
    folder = tmp_path / "raw" / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text(json.dumps(documents, indent=1))
    return str(folder)


def etl(store, tmp_path, entity, name, documents, **options):
    run_etl(store, entity, slice_of(tmp_path, name, documents), str(tmp_path / "stage" / name), RUN, name, **options)


@pytest.fixture
def store(spark):
    return raw_store(spark, new_path(spark, "test-jobs"), 4)


def test_etl_brand_replaces_and_logs(store, tmp_path, rows):
    etl(store, tmp_path, "brand", "h1", [brand(1), brand(2)])
    for _ in range(2):
        etl(store, tmp_path, "brand", "h2", [brand(2, "n"), brand(3)])
    assert rows(store.read("brand"), "user_id", "name", "tag_name", "del_yn") == [
        ("2", "n", "x2", "N"), ("3", "maisonx3", "x3", "N"),
    ]
    assert store.read("brand").first().created_at == datetime(2024, 2, 1, 3)
    assert store.read("brand_log").count() == 4


def test_etl_media_upserts(store, tmp_path, rows):
    etl(store, tmp_path, "media", "h1", [media("a"), media("b")])
    etl(store, tmp_path, "media", "h2", [media("b", 9, "bad"), media("c")])
    assert rows(store.read("media"), "media_id", "like_count", "ts") == [
        ("a", 3, datetime(2024, 1, 7, 23, 30)), ("b", 9, None), ("c", 3, datetime(2024, 1, 7, 23, 30)),
    ]
    assert store.read("media_log").count() == 4


def test_failed_check_loads_nothing(store, tmp_path):
    etl(store, tmp_path, "media", "h1", [media("a")])
    with pytest.raises(QualityError, match="non_negative"):
        etl(store, tmp_path, "media", "h2", [media("b", -1)])
    assert store.read("media").count() == 1 and store.read("media_log").count() == 1


CONTRACT = [
    Row(column_name=name, is_nullable=null, data_type=kind, character_maximum_length=None, unique_name=unique)
    for name, null, kind, unique in (
        ("media_id", "NO", "character varying", "media_id"),
        ("ts", "NO", "timestamp without time zone", None),
        ("like_count", "YES", "integer", None),
    )
]


def test_contract_rules_and_columns_apply(spark, store, tmp_path):
    etl(store, tmp_path, "media", "h1", [media("a")], contract=CONTRACT)
    assert spark.read.parquet(str(tmp_path / "stage" / "h1")).columns == ["media_id", "ts", "like_count"]
    assert store.read("media").first().user_id is None
    with pytest.raises(QualityError, match="media.ts: complete"):
        etl(store, tmp_path, "media", "h2", [media("b", ts="bad")], contract=CONTRACT)
    missing = [*CONTRACT, Row(column_name="nope", is_nullable="YES", data_type="integer",
                              character_maximum_length=None, unique_name=None)]
    with pytest.raises(ContractError, match="nope"):
        etl(store, tmp_path, "media", "h3", [media("b")], contract=missing)


def test_contract_without_unique_key_keeps_the_newest_row(store, tmp_path):
    loose = [Row(**(row.asDict() | {"unique_name": None})) for row in CONTRACT]
    etl(store, tmp_path, "media", "h1", [media("a", 1), media("a", 5), media("b")], contract=loose)
    assert sorted((r.media_id, r.like_count) for r in store.read("media").collect()) == [("a", 5), ("b", 3)]


def test_elt_publishes_core_marts(spark, rows):
    store = TableStore(spark, new_path(spark, "test-marts"))
    tables = raw.tables(spark)
    for run_id in ("h1", "h1", "h2"):
        run_elt(tables, store, run_id)
    published = store.read_all(K.CORE_MARTS)
    assert set(store.current_paths()) == set(K.CORE_MARTS)
    assert rows(published["popularity_calculation"]) == [("aa", 5, 2), ("bb", 8, 3), ("cc", 4, 1), (None, 11, 4)]
    assert rows(published["hashtag_count"]) == rows(M.hashtag_count(tables["media_hashtag"]))


def test_elt_variants_agree(spark, rows):
    tables = raw.tables(spark)
    core, full = (TableStore(spark, new_path(spark, "test-marts")) for _ in range(2))
    run_elt(tables, core, "h1")
    run_elt(tables, full, "h1", with_gate=False, all_marts=True)
    assert set(full.current_paths()) == {*K.CORE_MARTS, *K.EXTRA_MARTS}
    left, right = core.read_all(K.CORE_MARTS), full.read_all(K.CORE_MARTS)
    for name in K.CORE_MARTS:
        assert rows(left[name]) == rows(right[name]), name
    ungated = TableStore(spark, new_path(spark, "test-marts"))
    run_elt(tables, ungated, "h1", with_gate=False, with_post_time=False, top_k=1, round_avg=None)
    assert ungated.read("hashtag_count").count() == 1
    assert "post_time" not in ungated.read("brand_information").columns
    assert rows(ungated.read("brand_media_post_time")) == rows(left["brand_media_post_time"])


def test_gate_stops_before_anything_is_visible(spark):
    store = TableStore(spark, new_path(spark, "test-marts"))
    tables = raw.tables(spark)
    run_elt(tables, store, "h1")
    before = store.current_paths()
    tables["brand"] = tables["brand"].unionAll(tables["brand"])
    with pytest.raises(QualityError) as error:
        run_elt(tables, store, "h2")
    assert {f.column_name for f in error.value.failures} == {"user_id", "tag_name"}
    assert store.current_paths() == before


def test_a_failing_branch_publishes_nothing(spark):
    store = TableStore(spark, new_path(spark, "test-marts"))
    tables = raw.tables(spark)
    run_elt(tables, store, "h1")
    before = store.current_paths()
    broken = tables["media_hashtag"].withColumn("caption", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        run_elt(tables | {"media_hashtag": broken}, store, "h2", with_gate=False)
    assert store.current_paths() == before


def ingest(store, tmp_path, entity, **options):
    ingest_available(store, entity, str(tmp_path / "raw"), str(tmp_path / "stage"),
                     str(tmp_path / "checkpoint"), RUN, **options)


def test_ingest_reads_only_new_slices(store, tmp_path):
    slice_of(tmp_path, "media_2024-02-01/media_02", [media("a"), media("b")])
    ingest(store, tmp_path, "media")
    ingest(store, tmp_path, "media")
    assert store.read("media_log").count() == 2
    slice_of(tmp_path, "media_2024-02-01/media_03", [media("b", 7), media("c")])
    ingest(store, tmp_path, "media", files_per_batch=1)
    assert sorted((r.media_id, r.like_count) for r in store.read("media").collect()) == [("a", 3), ("b", 7), ("c", 3)]
    assert store.read("media_log").count() == 4


def test_ingest_catches_up_slice_by_slice(store, tmp_path):
    for hour, likes in (("03", 5), ("02", 3), ("04", 8)):
        day = f"media_2024-02-01/media_2024-02-01_{hour}"
        slice_of(tmp_path, day, [media("a", likes), media(f"only{hour}")])
    ingest(store, tmp_path, "media")
    found = {r.media_id: (r.like_count, r.updated_at.hour) for r in store.read("media").collect()}
    assert found == {"a": (8, 4), "only02": (3, 2), "only03": (3, 3), "only04": (3, 4)}
    assert store.read("media_log").count() == 6
    ingest(store, tmp_path, "media")
    assert store.read("media_log").count() == 6


def test_a_failed_slice_leaves_itself_and_later_ones_pending(store, tmp_path):
    folders = {
        hour: slice_of(tmp_path, f"media_2024-02-01/media_2024-02-01_{hour}", [media("a", likes), media(hour)])
        for hour, likes in (("02", 3), ("03", -5), ("04", 8))
    }
    with pytest.raises(StreamingQueryException, match="non_negative"):
        ingest(store, tmp_path, "media")
    assert sorted(r.media_id for r in store.read("media").collect()) == ["02", "a"]
    with open(f"{folders['03']}/part.json", "w") as file:
        json.dump([media("a", 5), media("03")], file)
    ingest(store, tmp_path, "media")
    assert {r.media_id: r.like_count for r in store.read("media").collect()} == {"a": 8, "02": 3, "03": 3, "04": 3}
    assert store.read("media_log").count() == 6


def test_a_fresh_stream_keeps_what_another_loaded(store, tmp_path):
    post = dict(user_id="1", caption="#a", timestamp="2024-01-01T00:00:00Z", media_type="IMAGE")
    for name in ("one", "two"):
        folder = tmp_path / name
        folder.mkdir()
        slice_of(folder, "h1", [post | {"media_id": name}])
        ingest(store, folder, "media_hashtag")
    assert sorted(r.media_id for r in store.read("media_hashtag").collect()) == ["one", "two"]


def test_ingest_keeps_files_pending_after_a_failed_check(store, tmp_path):
    folder = slice_of(tmp_path, "h1", [media("a", -5)])
    with pytest.raises(StreamingQueryException, match="non_negative"):
        ingest(store, tmp_path, "media")
    assert store.read("media").count() == 0
    with open(f"{folder}/part.json", "w") as file:
        json.dump([media("a", 5)], file)
    ingest(store, tmp_path, "media")
    assert store.read("media").count() == 1


def test_export_copies_what_is_published(spark, rows, tmp_path):
    store = TableStore(spark, new_path(spark, "test-marts"))
    run_elt(raw.tables(spark), store, "h1")
    target = TableTarget(str(tmp_path / "warehouse" / "{table}"), "parquet")
    for _ in range(2):
        export_marts(store, target)
    for name, mart in store.read_all(K.CORE_MARTS).items():
        assert rows(spark.read.parquet(str(tmp_path / "warehouse" / name))) == rows(mart)


def test_command_line(spark, tmp_path, rows):
    root = new_path(spark, "test-cli")
    documents = {
        "brand": [brand(1), brand(2)],
        "media": [media("a"), media("b")],
        "media_hashtag": [dict(media_id="h", user_id="1", caption="#a", timestamp="2024-01-01T00:00:00Z",
                               media_type="IMAGE")],
    }
    contract = tmp_path / "contract.json"
    contract.write_text("\n".join(json.dumps(dict(column_name=c, is_nullable="NO")) for c in raw.MEDIA_COLUMNS))
    for entity, documents_of in documents.items():
        path = slice_of(tmp_path, f"{entity}_03", documents_of)
        extra = ["--contract", str(contract)] if entity == "media" else []
        main(["etl", entity, "--slice", path, "--stage", str(tmp_path / "stage" / entity), "--store", root,
              "--logical-date", RUN, *extra])
    assert spark.read.parquet(str(tmp_path / "stage" / "media")).columns == raw.MEDIA_COLUMNS
    main(["ingest", "media", "--raw", str(tmp_path / "raw" / "media_03"), "--stage", str(tmp_path / "s"),
          "--store", root, "--checkpoint", str(tmp_path / "c"), "--logical-date", RUN])
    main(["elt", "--store", root, "--marts", f"{root}-marts", "--run-id", "h3"])
    marts = TableStore(spark, f"{root}-marts")
    assert marts.read("popularity_calculation").count() == 1

    tables = str(tmp_path / "tables" / "{table}")
    for name, df in raw.tables(spark).items():
        df.write.parquet(tables.format(table=name))
    main(["elt", "--source", tables, "--marts", f"{root}-marts", "--run-id", "h4", "--all-marts"])
    main(["export", "--marts", f"{root}-marts", "--target", str(tmp_path / "w" / "{table}"),
          "--format", "orc", "--option", "compression=none", "--all-marts"])
    variant = TableStore(spark, f"{root}-variant")
    main(["elt", "--source", tables, "--marts", variant.root, "--run-id", "h4", "--no-gate", "--no-post-time",
          "--top-hashtags", "2", "--average-digits", "-1"])
    assert variant.read("hashtag_count").count() == 2
    assert "post_time" not in variant.read("brand_information").columns
    main(["expire", "--versions", f"{root}-marts", "--before", "2999-01-01T00:00:00"])
    assert TableStore(spark, f"{root}-marts").read("popularity_calculation").count() == 4
    exported = spark.read.orc(str(tmp_path / "w" / "popularity_calculation"))
    assert rows(exported) == [("aa", 5, 2), ("bb", 8, 3), ("cc", 4, 1), (None, 11, 4)]


def test_settings_grow_with_the_input():
    assert settings()["spark.sql.shuffle.partitions"] == "200"
    assert settings(100 * 1024**4)["spark.sql.shuffle.partitions"] == "200000"
    assert settings(1024**4)["spark.sql.shuffle.partitions"] == "5243"
