"""Writing single tables: staging files, JDBC databases and connectors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from engagemart.sources.tables import FILE_FORMATS

STAGING_FORMAT = "parquet"


def write_staging(df: DataFrame, path: str, fmt: str = STAGING_FORMAT) -> None:
    """Overwrite a staging slice; ``fmt="avro"`` where that module is deployed."""
    df.write.mode("overwrite").format(fmt).save(path)


def jdbc_options(
    url: str, table: str, driver: str, connections: int = 16, batch_size: int = 10_000
) -> dict[str, str]:
    """Options for a bulk JDBC write with a bounded number of connections."""
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


@dataclass(frozen=True)
class TableTarget:
    """A warehouse schema to write into; ``location`` is a template with ``{table}``."""

    location: str
    format: str = "jdbc"
    options: Mapping[str, str] = field(default_factory=dict)
    truncate: bool = True

    def write(self, df: DataFrame, table: str) -> None:
        name = self.location.format(table=table)
        key = "path" if self.format in FILE_FORMATS else "dbtable"
        write_table(df, self.format, {**self.options, key: name}, truncate=self.truncate)


def write_table(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    mode: str = "overwrite",
    truncate: bool = False,
) -> None:
    """Write to a JDBC database or connector.

    ``truncate`` keeps the target's definition when overwriting (JDBC). Each task
    commits on its own there, so publish into a side table and swap it inside the
    database where readers must never see a partial table.
    """
    writer = df.write.format(fmt).options(**options).mode(mode)
    if truncate:
        writer = writer.option("truncate", "true")
    writer.save()
