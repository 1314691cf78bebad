"""Publishing tables so that readers see all of a run or nothing of it.

Every run writes its tables into folders of its own. One numbered commit makes them current, all at
once (:mod:`engagemart.sinks.log`). A run that fails part-way, or is repeated, leaves what readers see
untouched until its own commit is in the log. A table can also be published in parts, each replaced on
its own.

Writers need no lock: a run that would replace what another one has replaced since it began is refused.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.schemas import COMMITS, SUPERSEDED
from engagemart.scratch import literal_rows, no_rows
from engagemart.sinks.log import CommitLog, State


def _part(name: str, number: int) -> str:
    return f"{name}/{number}"


class TableStore:
    """Versioned tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.commits = CommitLog(spark, f"{self.root}/_published")

    def log(self) -> DataFrame:
        """Every publication that the log still holds."""
        if not self.state().version:
            return no_rows(self.spark, T.StructType.fromDDL("table_name string, path string, run_id string, published_at timestamp"))
        commits = self.spark.read.schema(COMMITS).json(f"{self.commits.folder}/*.json")
        return commits.select("run_id", "published_at", F.explode("put").alias("table_name", "entry")).select(
            "table_name", F.col("entry.path").alias("path"), "run_id", F.timestamp_micros("published_at").alias("published_at")
        )

    def state(self) -> State:
        return self.commits.state()

    def current_paths(self) -> dict[str, str]:
        """Folder of the current version of every table or part."""
        return {name: entry["path"] for name, entry in self.state().entries.items() if entry["path"]}

    def read(self, name: str) -> DataFrame:
        return self.read_all([name])[name]

    def read_all(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Several tables, all as of the same moment."""
        paths = self.current_paths()
        missing = [name for name in names if name not in paths]
        if missing:
            raise LookupError(f"not published under {self.root}: {', '.join(missing)}")
        return {name: self.spark.read.parquet(paths[name]) for name in names}

    def read_parts(
        self, name: str, schema: T.StructType, numbers: Iterable[int] | None = None
    ) -> DataFrame:
        """Some or all parts of a table as of one moment; parts never written are empty."""
        paths = self.current_paths()
        if numbers is None:
            chosen = [path for key, path in paths.items() if key.startswith(f"{name}/")]
        else:
            chosen = [paths[_part(name, n)] for n in numbers if _part(name, n) in paths]
        return self.read_paths(chosen, schema)

    def read_paths(self, paths: Iterable[str], schema: T.StructType) -> DataFrame:
        paths = list(paths)
        if not paths:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def run(self, run_id: str) -> Run:
        return Run(self, run_id)

    def superseded(self, before: datetime | None = None) -> DataFrame:
        """Folders that are no longer current, optionally only those replaced before a time."""
        replaced = [
            {"table_name": entry["name"], "path": entry["path"], "micros": entry["replaced_at"]}
            for entry in self._replaced(before)
        ]
        return literal_rows(self.spark, replaced, SUPERSEDED).select(
            "table_name", "path", F.timestamp_micros("micros").alias("replaced_at")
        )

    def _replaced(self, before: datetime | None = None) -> list[dict[str, Any]]:
        entries = self.state().replaced
        return [e for e in entries if before is None or e["replaced_at"] < before.timestamp() * 1_000_000]

    def _delete(self, path: str) -> bool:
        return bool(self.commits.files.delete(self.commits._path(path), True))

    def expire(self, before: datetime) -> int:
        """Delete folders replaced before a time; returns how many there were to delete.

        Choose a time older than any query that may still read the replaced versions. Each folder is
        visited once: the log then forgets it, together with commits that a snapshot has made dispensable.
        """
        paths = {entry["path"] for entry in self._replaced(before)}
        removed = sum(self._delete(path) for path in sorted(paths))
        if paths:
            self.commits.commit({}, forget=paths, run_id="expire")
        self.commits.trim(int(before.timestamp() * 1_000_000))
        return removed

    def sweep(self, before: datetime) -> int:
        """Delete what runs that never committed have left, if older than ``before``; returns the number of folders.

        Choose a time older than any run that may still commit.
        """
        files, path = self.commits.files, self.commits._path
        runs, state, removed = path(f"{self.root}/runs"), self.state(), 0
        if not files.exists(runs):
            return 0
        kept = [e["path"] for e in (*state.entries.values(), *state.replaced) if e["path"]]
        for run in files.listStatus(runs):
            for attempt in files.listStatus(run.getPath()):
                folder = attempt.getPath()
                named = any(f"/{folder.getParent().getName()}/{folder.getName()}/" in f"{k}/" for k in kept)
                if not named and attempt.getModificationTime() < before.timestamp() * 1000:
                    removed += bool(files.delete(folder, True))
        return removed


class Run:
    """Tables written by one run; invisible until :meth:`commit`."""

    def __init__(self, store: TableStore, run_id: str):
        self.store = store
        self.run_id = run_id
        self._folder = f"{store.root}/runs/{run_id}/{uuid4().hex}"
        self._written: dict[str, dict[str, Any]] = {}
        self._dropped: set[str] = set()
        self._base = store.state()

    @property
    def base(self) -> State:
        """What was current when the run began."""
        return self._base

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table and return it as a scan, for tables built on top of it."""
        path = f"{self._folder}/{name}"
        df.write.parquet(path)
        self._written[name] = {"path": path}
        return self.store.spark.read.schema(df.schema).parquet(path)

    def write_observed(self, folder: str, df: DataFrame, **facts: Any) -> tuple[str, dict[str, Any]]:
        """Write rows without naming them yet; returns the path and aggregates taken while writing."""
        path, seen = f"{self._folder}/{folder}", Observation()
        df.observe(seen, *[column.alias(name) for name, column in facts.items()]).write.parquet(path)
        return path, seen.get

    def write_parts(self, name: str, df: DataFrame, column: str, numbers: Iterable[int]) -> None:
        """Write the given parts of a table, told apart by ``column``; each must have rows."""
        path = self.write_divided(name, df, column)
        for n in numbers:
            self.put(_part(name, n), f"{path}/{column}={n}")

    def write_divided(self, folder: str, df: DataFrame, column: str) -> str:
        """Write rows into one folder per value of ``column`` without naming them yet."""
        path = f"{self._folder}/{folder}"
        df.write.partitionBy(column).parquet(path)
        return path

    def put(self, name: str, path: str | None, **facts: Any) -> None:
        """Name something written, with facts for those who read it; None stands for no rows."""
        self._written[name] = {"path": path, **facts}

    def drop(self, name: str) -> None:
        self._dropped.add(name)

    def commit(self) -> State:
        """Make everything written current at once, unless another writer has replaced any of it meanwhile."""
        return self.store.commits.commit(self._written, self._dropped, self._base, self.run_id)


def publish(store: TableStore, name: str, df: DataFrame, run_id: str) -> DataFrame:
    """Replace one table."""
    run = store.run(run_id)
    written = run.write(name, df)
    run.commit()
    return written


def publish_all(store: TableStore, frames: dict[str, DataFrame], run_id: str) -> None:
    """Replace several tables together."""
    run = store.run(run_id)
    for name, df in frames.items():
        run.write(name, df)
    run.commit()
