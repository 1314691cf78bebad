"""Command line for ``spark-submit``: ``etl``, ``ingest``, ``elt``, ``export`` and ``expire``.

    spark-submit run.py etl media --slice PATH --stage PATH --store ROOT \
        --logical-date 2024-02-01T03:00:00+00:00
"""

from __future__ import annotations

import argparse
from datetime import datetime
from pathlib import PurePosixPath

from pyspark.sql import Row, SparkSession

from engagemart.constants import AVERAGE_DIGITS, CORE_MARTS, EXTRA_MARTS, TOP_HASHTAGS
from engagemart.functions.columns import MOST_AVERAGE_DIGITS
from engagemart.plans.elt import export_marts, run_elt
from engagemart.plans.etl import raw_store, run_etl
from engagemart.schemas import CONTRACT
from engagemart.session import build_session
from engagemart.sinks.publish import TableStore
from engagemart.sinks.tables import TableTarget
from engagemart.sources.contract import catalog_contract, load_contract
from engagemart.sources.tables import RAW_TABLE_NAMES, PlannedSplit, TableSource, read_query, read_tables
from engagemart.streaming.ingest import ingest_available

ENTITIES = ("brand", "media", "media_hashtag")


def _pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def _split(text: str) -> tuple[str, PlannedSplit]:
    table, sep, rest = text.partition("=")
    column, colon, partitions = rest.rpartition(":")
    if not (sep and colon and column and partitions.isdecimal() and int(partitions)):
        raise argparse.ArgumentTypeError(f"{text!r} is not TABLE=COLUMN:PARTITIONS")
    return table, PlannedSplit(column, int(partitions))


def _ingestion_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("entity", choices=ENTITIES)
    job.add_argument("--stage", required=True, help="folder for staged slices")
    job.add_argument("--store", required=True, help="root of the raw tables")
    job.add_argument("--logical-date", required=True, help="ISO time of the run")
    contract = job.add_mutually_exclusive_group()
    contract.add_argument("--contract", help="JSON lines with the table's contract rows, in order")
    contract.add_argument("--catalog", metavar="SCHEMA", help="take the contract from this schema of a database's catalog")
    job.add_argument("--catalog-format", default="jdbc", help="jdbc or a connector that takes a query")
    job.add_argument("--catalog-option", action="append", type=_pair, default=[], metavar="KEY=VALUE")
    job.add_argument("--json-lines", action="store_true", help="one document per line")
    job.add_argument("--stage-format", default="parquet")


def _connection_arguments(job: argparse.ArgumentParser) -> None:
    job.add_argument("--format", default="parquet", help="parquet, jdbc, table or a connector")
    job.add_argument("--option", action="append", type=_pair, default=[], metavar="KEY=VALUE")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="engagemart")
    parser.add_argument("--input-bytes", type=int, default=0, help="raw bytes, sizes the shuffles")
    jobs = parser.add_subparsers(dest="job", required=True)

    etl = jobs.add_parser("etl", help="stage, check and load one slice")
    _ingestion_arguments(etl)
    etl.add_argument("--slice", required=True)

    ingest = jobs.add_parser("ingest", help="load every slice that is new")
    _ingestion_arguments(ingest)
    ingest.add_argument("--raw", required=True)
    ingest.add_argument("--checkpoint", required=True)

    elt = jobs.add_parser("elt", help="check raw tables and publish the marts")
    source = elt.add_mutually_exclusive_group(required=True)
    source.add_argument("--store", help="root of the raw tables")
    source.add_argument("--source", help="path or table template with {table}")
    _connection_arguments(elt)
    elt.add_argument(
        "--split", action="append", type=_split, default=[], metavar="TABLE=COLUMN:PARTITIONS",
        help="read a JDBC table in parallel, by about equal rows of a whole-number column",
    )
    elt.add_argument("--marts", required=True)
    elt.add_argument("--run-id", required=True)
    elt.add_argument("--all-marts", action="store_true")
    elt.add_argument("--no-gate", action="store_true")
    elt.add_argument("--no-post-time", action="store_true", help="brand_information without it")
    elt.add_argument("--top-hashtags", type=int, default=TOP_HASHTAGS, help="0 keeps all")
    elt.add_argument(
        "--average-digits", type=int, default=AVERAGE_DIGITS, choices=range(-1, MOST_AVERAGE_DIGITS + 1),
        metavar="N", help=f"at most {MOST_AVERAGE_DIGITS}; -1 for no rounding",
    )

    export = jobs.add_parser("export", help="copy published marts into a warehouse")
    export.add_argument("--marts", required=True)
    export.add_argument("--target", required=True, help="path or table template with {table}")
    _connection_arguments(export)
    export.add_argument("--all-marts", action="store_true")

    expire = jobs.add_parser("expire", help="delete versions replaced before a time")
    expire.add_argument("--versions", required=True, help="a marts root, or STORE/brand or STORE/media")
    expire.add_argument("--before", required=True, type=datetime.fromisoformat)
    return parser.parse_args(argv)


def _contract(spark: SparkSession, args: argparse.Namespace) -> list[Row] | None:
    if args.catalog:
        options = dict(args.catalog_option)
        return catalog_contract(
            lambda query: read_query(spark, query, args.catalog_format, options), args.catalog, args.entity
        )
    # coalesce(1) keeps the file's column order; a contract is one row per column.
    return load_contract(spark.read.schema(CONTRACT).json(args.contract).coalesce(1)) if args.contract else None


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"engagemart-{args.job}", args.input_bytes)
    contract = _contract(spark, args) if args.job in ("etl", "ingest") else None
    further = {args.entity: contract} if contract else {}
    if args.job == "etl":
        run_etl(
            raw_store(spark, args.store, contracts_by_entity=further),
            args.entity,
            args.slice,
            args.stage,
            args.logical_date,
            PurePosixPath(args.slice).name,
            contract,
            not args.json_lines,
            args.stage_format,
        )
    elif args.job == "ingest":
        ingest_available(
            raw_store(spark, args.store, contracts_by_entity=further),
            args.entity,
            args.raw,
            args.stage,
            args.checkpoint,
            args.logical_date,
            contract,
            not args.json_lines,
            fmt=args.stage_format,
        )
    elif args.job == "elt":
        if args.store:
            store = raw_store(spark, args.store)
            raw = {name: store.read(name) for name in RAW_TABLE_NAMES}
        else:
            raw = read_tables(spark, TableSource(args.source, args.format, dict(args.option), dict(args.split)))
        run_elt(
            raw,
            TableStore(spark, args.marts),
            args.run_id,
            with_gate=not args.no_gate,
            all_marts=args.all_marts,
            round_avg=None if args.average_digits < 0 else args.average_digits,
            top_k=args.top_hashtags or None,
            with_post_time=not args.no_post_time,
        )
    elif args.job == "expire":
        TableStore(spark, args.versions).expire(args.before)
    else:
        names = (*CORE_MARTS, *EXTRA_MARTS) if args.all_marts else CORE_MARTS
        target = TableTarget(args.target, args.format, dict(args.option))
        export_marts(TableStore(spark, args.marts), target, names)


if __name__ == "__main__":
    main()
