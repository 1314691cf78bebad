import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from engagemart.plans.etl import document_schema, load_slice, raw_store
from engagemart.schemas import CONTRACT, RAW_TABLES
from engagemart.sources import contract as C


@pytest.fixture
def catalog(spark):
    constraints = spark.createDataFrame(
        [(100, "u", [1, 3]), (100, "p", [2]), (200, "u", [1]), (100, "u", [3])],
        "conrelid int, contype string, conkey array<smallint>",
    )
    relations = spark.createDataFrame([(100, "media"), (200, "brand")], "oid int, relname string")
    attributes = spark.createDataFrame(
        [(100, 1, "media_id"), (100, 2, "user_id"), (100, 3, "code"), (200, 1, "user_id")],
        "attrelid int, attnum smallint, attname string",
    )
    columns = spark.createDataFrame(
        [
            ("raw_data", "media", 2, "user_id", "NO", "character varying", 20),
            ("raw_data", "media", 1, "media_id", "NO", "character varying", 20),
            ("raw_data", "media", 3, "code", "YES", "integer", None),
            ("other", "media", 1, "x", "YES", "integer", None),
            ("raw_data", "brand", 1, "user_id", "NO", "character varying", 20),
        ],
        "table_schema string, table_name string, ordinal_position int, column_name string, "
        "is_nullable string, data_type string, character_maximum_length int",
    )
    return constraints, relations, attributes, columns


def test_unique_columns(catalog, rows):
    constraints, relations, attributes, _ = catalog
    assert rows(C.unique_columns(constraints, relations, attributes, "media")) == [("code",), ("media_id",)]
    assert rows(C.unique_columns(constraints, relations, attributes, "nothing")) == []


def test_contract_columns(catalog):
    constraints, relations, attributes, columns = catalog
    unique = C.unique_columns(constraints, relations, attributes, "media")
    contract = C.contract_columns(columns, unique, "raw_data", "media")
    assert contract.columns == CONTRACT.fieldNames()
    rows = C.load_contract(contract)
    assert [(r.column_name, r.is_nullable, r.unique_name) for r in rows] == [
        ("media_id", "NO", "media_id"), ("user_id", "NO", None), ("code", "YES", "code"),
    ]
    assert C.to_schema(rows) == T.StructType(
        [
            T.StructField("media_id", T.StringType(), False),
            T.StructField("user_id", T.StringType(), False),
            T.StructField("code", T.IntegerType(), True),
        ]
    )


def test_catalog_contract(catalog):
    constraints, relations, attributes, columns = catalog
    frames = {
        "pg_constraint": constraints.where("contype = 'u'"), "pg_class": relations, "pg_attribute": attributes,
        "information_schema": columns,
    }
    asked = []

    def query(text):
        asked.append(text)
        return next(frame for name, frame in frames.items() if name in text)

    rows = C.catalog_contract(query, "raw_data", "media")
    assert [(r.column_name, r.data_type, r.unique_name) for r in rows] == [
        ("media_id", "character varying", "media_id"), ("user_id", "character varying", None), ("code", "integer", "code"),
    ]
    assert len(asked) == 4 and "'raw_data' and c.relname = 'media'" in asked[1]
    with pytest.raises(C.ContractError, match="no columns"):
        C.catalog_contract(query, "raw_data", "nothing")
    with pytest.raises(C.ContractError, match="plain name"):
        C.catalog_contract(query, "raw' or 1=1 --", "media")


def test_catalog_on_the_command_line(spark, monkeypatch):
    from engagemart import __main__ as cli

    base = ["etl", "media", "--slice", "s", "--stage", "g", "--store", "t", "--logical-date", "2024-02-01"]
    with pytest.raises(SystemExit):
        cli.parse([*base, "--contract", "c", "--catalog", "raw_data"])
    args = cli.parse([*base, "--catalog", "raw_data", "--catalog-option", "url=jdbc:x"])
    monkeypatch.setattr(cli, "read_query", lambda *given: given)
    monkeypatch.setattr(cli, "catalog_contract", lambda query, *names: (query("q")[1:], *names))
    assert cli._contract(spark, args) == (("q", "jdbc", {"url": "jdbc:x"}), "raw_data", "media")
    assert cli._contract(spark, cli.parse(base)) is None


def test_project(spark, catalog):
    constraints, relations, attributes, columns = catalog
    unique = C.unique_columns(constraints, relations, attributes, "media")
    rows = C.load_contract(C.contract_columns(columns, unique, "raw_data", "media"))
    df = spark.createDataFrame([(1, "u", "m", "x")], "code int, user_id string, media_id string, extra string")
    assert C.project(df, rows).columns == ["media_id", "user_id", "code"]
    with pytest.raises(C.ContractError, match="code"):
        C.project(df.drop("code"), rows)


def _further(name, kind):
    return Row(column_name=name, is_nullable="YES", data_type=kind, character_maximum_length=None, unique_name=None)


def test_a_contract_widens_documents_and_tables(spark):
    contract = [_further("media_id", "character varying"), _further("ts", "timestamp without time zone"), _further("views", "bigint")]
    assert [f.name for f in C.further_fields(contract, RAW_TABLES["media"])] == ["views"]
    assert C.widen(RAW_TABLES["media"], contract)["views"].dataType.typeName() == "long"
    schema = document_schema("media", contract)
    assert (schema.names[-1], schema["views"].dataType.typeName()) == ("views", "string")
    assert document_schema("media").names == schema.names[:-1]


def test_a_store_without_the_contracts_columns_is_refused(spark, tmp_path):
    contract = [_further("media_id", "character varying"), _further("views", "bigint")]
    raw = spark.createDataFrame([("1", "2")], "media_id string, views string")
    with pytest.raises(C.ContractError, match="views"):
        load_slice(raw_store(spark, str(tmp_path / "t")), "media", raw, str(tmp_path / "s"), "2024-02-01T03:00:00+00:00", "h", contract)


def test_drift(spark, rows):
    documents = spark.createDataFrame([('{"a": 1, "b": {"c": 2}}',), ('{"a": null}',), ("[1]",), ("broken",), (None,)], "d string")
    assert rows(C.drift(documents, "d", ["a", "z"]), "field", "documents", "status") == [
        ("a", 2, "known"), ("b", 1, "unknown"), ("z", 0, "missing"),
    ]
