"""The column contract of a table: names, nullability, types, lengths, unique columns.

A contract is a small DataFrame, one row per column. It can be given directly or
built from the four catalog relations of a warehouse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.schemas import CONTRACT_TYPES, struct
from engagemart.scratch import literal_rows


class ContractError(Exception):
    """A frame does not carry the columns its contract names."""


def unique_columns(
    constraints: DataFrame, relations: DataFrame, attributes: DataFrame, table: str
) -> DataFrame:
    """Names of the columns that take part in a unique constraint of ``table``."""
    owner = relations.where(F.col("relname") == table).select(F.col("oid").alias("conrelid"))
    keys = (
        constraints.where(F.col("contype") == "u")
        .join(owner, "conrelid")
        .select(F.col("conrelid").alias("attrelid"), F.explode("conkey").alias("attnum"))
    )
    names = attributes.join(keys, ["attrelid", "attnum"])
    return names.select(F.col("attname").alias("unique_name")).distinct()


def contract_columns(columns: DataFrame, unique: DataFrame, schema: str, table: str) -> DataFrame:
    """Contract rows of ``schema.table`` in column order."""
    own = columns.where((F.col("table_schema") == schema) & (F.col("table_name") == table))
    marked = own.join(unique, F.col("column_name") == F.col("unique_name"), "left")
    return marked.orderBy("ordinal_position").select(
        "column_name", "is_nullable", "data_type", "character_maximum_length", "unique_name"
    )


#: The columns a contract needs of each catalog relation, as the database is asked for them.
CATALOG_QUERIES = {
    "constraints": "select conrelid, contype, conkey from pg_catalog.pg_constraint where contype = 'u'",
    "relations": "select c.oid, c.relname from pg_catalog.pg_class c join pg_catalog.pg_namespace n "
    "on n.oid = c.relnamespace where n.nspname = '{schema}' and c.relname = '{table}'",
    "attributes": "select attrelid, attnum, attname from pg_catalog.pg_attribute where attnum > 0",
    "columns": "select table_schema, table_name, ordinal_position, column_name, is_nullable, data_type, "
    "character_maximum_length from information_schema.columns where table_schema = '{schema}' and table_name = '{table}'",
}


def catalog_contract(query: Callable[[str], DataFrame], schema: str, table: str) -> list[Row]:
    """Contract of ``schema.table`` from the catalog of a database that ``query`` reads.

    Raises if the catalog knows no column of the table, rather than giving a contract that fits anything.
    """
    for name in (schema, table):
        if not name.isidentifier():
            raise ContractError(f"{name!r} is no plain name of a schema or table")
    parts = {name: query(text.format(schema=schema, table=table)) for name, text in CATALOG_QUERIES.items()}
    unique = unique_columns(parts["constraints"], parts["relations"], parts["attributes"], table)
    contract = load_contract(contract_columns(parts["columns"], unique, schema, table))
    if not contract:
        raise ContractError(f"the catalog has no columns of {schema}.{table}")
    return contract


def load_contract(contract: DataFrame) -> list[Row]:
    """The contract on the driver: one row per column, collected once per run."""
    return contract.collect()


def project(df: DataFrame, contract: list[Row]) -> DataFrame:
    """Exactly the contract's columns in its order; names what is missing."""
    wanted = [row.column_name for row in contract]
    missing = [name for name in wanted if name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df.select(*wanted)


def to_schema(contract: list[Row]) -> T.StructType:
    """Spark schema of a contract."""
    return T.StructType(
        [
            T.StructField(row.column_name, CONTRACT_TYPES[row.data_type], row.is_nullable != "NO")
            for row in contract
        ]
    )


def further_fields(contract: Sequence[Row], known: T.StructType) -> list[T.StructField]:
    """Fields that the contract names and ``known`` lacks, with the contract's types."""
    return to_schema([row for row in contract if row.column_name not in known.names]).fields


def widen(schema: T.StructType, contract: Sequence[Row]) -> T.StructType:
    """``schema`` with the contract's further columns at its end, nullable, as older rows do not have them."""
    more = [T.StructField(field.name, field.dataType) for field in further_fields(contract, schema)]
    return T.StructType([*schema.fields, *more])


def drift(documents: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    """(field, documents, status): fields of JSON texts against those expected.

    ``unknown`` fields are in some document but not expected, ``missing`` ones in none, ``known`` ones in both.
    Documents that are no JSON object have no fields.
    """
    fields = documents.select(F.explode(F.json_object_keys(column)).alias("field"))
    # one row per distinct field name; a name twice in one document counts twice
    counts = fields.groupBy("field").agg(F.count(F.lit(1)).alias("documents"))
    names = literal_rows(documents.sparkSession, [{"expected": name} for name in expected], struct(expected=T.StringType()))
    both = counts.join(names, F.col("field") == F.col("expected"), "full")
    status = F.when(F.col("expected").isNull(), "unknown").when(F.col("field").isNull(), "missing").otherwise("known")
    return both.select(
        F.coalesce("field", "expected").alias("field"), F.coalesce("documents", F.lit(0)).alias("documents"), status.alias("status")
    )
