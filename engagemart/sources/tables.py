"""Reading raw tables from files, catalogs, JDBC databases and connectors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from engagemart.sources import splits as planned

FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv")
RAW_TABLE_NAMES = ("brand", "media", "media_hashtag", "brand_log")


@dataclass(frozen=True)
class Split:
    """How to cut a JDBC table into parallel reads over a numeric or time column."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class PlannedSplit:
    """Cut a JDBC table into reads of about equal rows, by counts that the database makes over a whole-number column."""

    column: str
    partitions: int


@dataclass(frozen=True)
class TableSource:
    """Where raw tables live.

    ``location`` is a template with ``{table}``: a path for file formats, a table
    name for ``jdbc`` and other connectors (passed as ``dbtable``). Credentials and
    driver settings come from the caller in ``options``.
    """

    location: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split | PlannedSplit] = field(default_factory=dict)

    def reader_options(self, table: str) -> dict[str, str]:
        options = dict(self.options)
        if self.format not in FILE_FORMATS:
            options["dbtable"] = self.location.format(table=table)
        split = self.splits.get(table)
        if isinstance(split, Split):
            options |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return options

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.format == "table":
            return spark.read.table(self.location.format(table=table))
        if isinstance(self.splits.get(table), PlannedSplit):
            return self._read_planned(spark, table, self.splits[table])
        reader = spark.read.format(self.format).options(**self.reader_options(table))
        if self.format in FILE_FORMATS:
            return reader.load(self.location.format(table=table))
        return reader.load()

    def _read_planned(self, spark: SparkSession, table: str, split: PlannedSplit) -> DataFrame:
        if self.format != "jdbc":
            raise ValueError(f"reads of {table} can only be planned for jdbc, not {self.format}")
        name, options = self.location.format(table=table), dict(self.options)
        # one small row per counted range
        predicates = planned.plan(
            lambda query: read_query(spark, query, "jdbc", options).collect(), name, split.column, split.partitions
        )
        return spark.read.jdbc(options.pop("url"), name, predicates=predicates, properties=options)


def read_tables(
    spark: SparkSession, source: TableSource, names: Iterable[str] = RAW_TABLE_NAMES
) -> dict[str, DataFrame]:
    return {name: source.read(spark, name) for name in names}


def read_query(
    spark: SparkSession, query: str, fmt: str, options: Mapping[str, str]
) -> DataFrame:
    """Result of a statement that the source database runs itself."""
    return spark.read.format(fmt).options(**options).option("query", query).load()
