"""Hourly job of one entity: read a slice, stage it, check it, load it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart import constants as K
from engagemart.operators import quality as Q
from engagemart.plans.staging import STAGERS
from engagemart.schemas import RAW_DOCUMENTS, RAW_TABLES, text_documents
from engagemart.sinks.loads import DEFAULT_BUCKETS, RawStore, load
from engagemart.sinks.tables import STAGING_FORMAT
from engagemart.sources import contract as contracts
from engagemart.sources.slices import read_slice


def default_rules(entity: str) -> list[Q.Rule]:
    """Rules used when no contract is given: keys present, counts sane."""
    rules = {
        "brand": [Q.unique("user_id"), Q.unique("tag_name"), Q.complete("user_id")],
        "media": [Q.unique("media_id"), Q.complete("media_id"), Q.complete("user_id")],
        "media_hashtag": [Q.complete("media_id"), Q.complete("user_id")],
    }[entity]
    for field in RAW_DOCUMENTS[entity].fields:
        if field.dataType.typeName() == "integer":
            rules += [Q.integral(field.name), Q.fits_integer(field.name), Q.non_negative(field.name)]
    return rules


def rules_for(entity: str, contract: Sequence[Row] | None = None) -> list[Q.Rule]:
    return default_rules(entity) if contract is None else Q.rules_from_contract(contract)


def further_fields(entity: str, contract: Sequence[Row] | None) -> list[T.StructField]:
    """Columns that only the contract knows of; documents have them under the same names."""
    return contracts.further_fields(contract or [], RAW_TABLES[entity])


def document_schema(entity: str, contract: Sequence[Row] | None = None) -> T.StructType:
    """Fields read from raw documents, as text: the entity's own and those its contract adds."""
    more = [T.StructField(field.name, T.StringType()) for field in further_fields(entity, contract)]
    return T.StructType([*text_documents(entity).fields, *more])


def stage_and_check(
    raw: DataFrame,
    entity: str,
    logical_date: str,
    stage_path: str,
    contract: Sequence[Row] | None = None,
    fmt: str = STAGING_FORMAT,
) -> DataFrame:
    """Write the staged slice and return it; raises before anything is loaded.

    What is checked and loaded is what was written, in the contract's columns. Numbers are
    staged and checked as text and cast when they have passed, so a wrong value is
    reported and never becomes NULL.
    """
    numbers = {
        field.name: field.dataType.simpleString()
        for field in RAW_DOCUMENTS[entity].fields
        if isinstance(field.dataType, T.IntegerType) and field.name in raw.columns
    }
    numbers |= {field.name: field.dataType.simpleString() for field in further_fields(entity, contract)}
    raw = raw.withColumns({name: F.trim(F.col(name).cast("string")) for name in numbers})
    staged = STAGERS[entity](raw, logical_date)
    if contract is not None:
        staged = contracts.project(staged, list(contract))
    Q.enforce(Q.verify_written(staged, rules_for(entity, contract), entity, stage_path, fmt))
    written = raw.sparkSession.read.schema(staged.schema).format(fmt).load(stage_path)
    return written.withColumns(
        {name: F.col(name).cast(kind) for name, kind in numbers.items() if name in staged.columns}
    )


def load_slice(
    store: RawStore,
    entity: str,
    raw: DataFrame,
    stage_path: str,
    logical_date: str,
    slice_id: str,
    contract: Sequence[Row] | None = None,
    fmt: str = STAGING_FORMAT,
) -> None:
    """Stage, check and load one slice with the entity's strategy."""
    lost = [f.name for f in further_fields(entity, contract) if f.name not in store.schemas[entity].names]
    if lost:
        raise contracts.ContractError(f"the store of {entity} has no columns {', '.join(lost)}")
    staged = stage_and_check(raw, entity, logical_date, stage_path, contract, fmt)
    method, key, has_log = K.LOAD_METHODS[entity]
    checked_unique = key is not None and Q.unique(key) in rules_for(entity, contract)
    load(store, entity, staged, slice_id, method, key, has_log, keys_unique=checked_unique)


def run_etl(
    store: RawStore,
    entity: str,
    slice_path: str,
    stage_path: str,
    logical_date: str,
    slice_id: str,
    contract: Sequence[Row] | None = None,
    multi_line: bool = True,
    fmt: str = STAGING_FORMAT,
) -> None:
    raw = read_slice(store.spark, slice_path, document_schema(entity, contract), multi_line, split=True)
    load_slice(store, entity, raw, stage_path, logical_date, slice_id, contract, fmt)


def raw_store(
    spark: SparkSession,
    root: str,
    buckets: int = DEFAULT_BUCKETS,
    contracts_by_entity: Mapping[str, Sequence[Row]] | None = None,
) -> RawStore:
    """The raw tables under ``root``, with the further columns that contracts name.

    ``buckets`` sizes new upsert tables: aim for 10 GB each.
    """
    schemas = dict(RAW_TABLES)
    for entity, contract in (contracts_by_entity or {}).items():
        for name in (entity, f"{entity}_log"):
            if name in schemas:
                schemas[name] = contracts.widen(schemas[name], contract)
    return RawStore(spark, root, schemas, buckets)
