"""Load strategies for raw tables: replace, upsert, append and history append.

Columns are matched by name. Every load is safe to repeat: replace publishes a new version, an
upsert of the same batch changes nothing, and append puts a slice in place of itself.

Upserts write no more than their batch: each adds a run, sorted by bucket and key, and reading merges the
runs with the base. Which row of a key wins is decided over all of them by recency, then by the remaining
values, so batches may arrive in any order. Runs of similar size are merged into larger ones, and folded
into the base once they are a fair part of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.constants import LOAD_METHODS
from engagemart.operators.latest import latest_per_key
from engagemart.operators.lookup import BROADCAST_BYTES, row_bytes
from engagemart.schemas import STORE_LAYOUT
from engagemart.scratch import literal_rows, no_rows
from engagemart.sinks.log import CommitConflict, State
from engagemart.sinks.publish import Run, TableStore, publish

SLICE_COLUMN = "load_slice"
BUCKET_COLUMN = "key_bucket"
DEFAULT_BUCKETS = 64
#: Runs of one tier (within a factor) that are merged; share of the base at which runs are folded into it.
TIER_RUNS, TIER_FACTOR, FOLD_SHARE = 8, 8, 0.25
_SLICE_FIELD = T.StructField(SLICE_COLUMN, T.StringType())
_BUCKET_FIELD = T.StructField(BUCKET_COLUMN, T.IntegerType())
_SLICE_FOLDER, _ORDER = "slice_folder", "_load"


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, cast to its types; missing ones become NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def upsert(
    target: DataFrame, batch: DataFrame, key: str, recency: Sequence[str] = ()
) -> DataFrame:
    """``target`` with the rows of ``batch`` inserted, or put in place of the same key.

    With ``recency`` a row of the target stays if it is more recent than the batch's. Keys are unique in the target.
    """
    newest = latest_per_key(batch, key, recency)
    both = target.withColumn(_ORDER, F.lit(0)).unionByName(newest.withColumn(_ORDER, F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, key, _precedence(recency)).drop(_ORDER)


def _precedence(recency: Sequence[str]) -> list[str]:
    """What decides between rows of one key before their values do: recency, else the order of loads."""
    return list(recency) or [_ORDER]


def merge_into(batch: DataFrame, table: str, key: str, recency: Sequence[str] = ()) -> None:
    """Upsert through ``MERGE INTO``, for catalog tables whose format supports it."""
    newest = latest_per_key(batch, key, recency).alias("batch")
    (
        newest.mergeInto(table, F.expr(f"{table}.`{key}` = batch.`{key}`"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


class RawStore:
    """Raw tables below one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: dict[str, T.StructType],
        buckets: int = DEFAULT_BUCKETS,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = schemas
        self.buckets = buckets
        self._layouts: dict[str, dict[str, Any]] = {}

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def versions(self, table: str) -> TableStore:
        """Published versions of a replaced or upserted table."""
        return TableStore(self.spark, self._path(table))

    def replace(self, table: str, batch: DataFrame, slice_id: str) -> None:
        """The batch becomes the table."""
        publish(self.versions(table), table, align(batch, self.schemas[table]), slice_id)

    def append(
        self, table: str, batch: DataFrame, slice_id: str | Column, slices: Iterable[str] = ()
    ) -> None:
        """Add a slice; loading the same slice again puts it in place of itself, also if it has become empty.

        A column as ``slice_id`` loads many slices at once; rows are then brought together by slice first,
        with large slices split, to keep files few. ``slices`` names those the batch stands for: the ones it
        has no rows of are empty from now on. What a slice holds is what the manifest says, whichever files exist.
        """
        run = self.versions(table).run("append")
        if isinstance(slice_id, Column):
            rows = align(batch.withColumn(SLICE_COLUMN, slice_id), T.StructType([*self.schemas[table].fields, _SLICE_FIELD]))
            rows = rows.hint("rebalance", SLICE_COLUMN).withColumn(_SLICE_FOLDER, F.col(SLICE_COLUMN))
            path = run.write_divided(table, rows, _SLICE_FOLDER)
            folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
            kept = T.StructType([_SLICE_FIELD])
            # one row per slice
            found = self.spark.read.schema(kept).parquet(path).select(SLICE_COLUMN, folder.alias("folder"))
            for row in found.groupBy(SLICE_COLUMN, "folder").agg(F.count(F.lit(1)).alias("rows")).collect():
                run.put(f"{table}/slice/{row[SLICE_COLUMN]}", row["folder"], rows=row["rows"])
                slices = [name for name in slices if name != row[SLICE_COLUMN]]
            for name in slices:
                run.put(f"{table}/slice/{name}", None, rows=0)
        else:
            rows = align(batch, self.schemas[table]).withColumn(SLICE_COLUMN, F.lit(slice_id))
            path, seen = run.write_observed(table, rows, rows=F.count(F.lit(1)))
            run.put(f"{table}/slice/{slice_id}", path if seen["rows"] else None, rows=seen["rows"])
        run.commit()

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        key: str,
        recency: Sequence[str] = (),
        slice_id: str = "load",
        keys_unique: bool = False,
    ) -> None:
        """Insert or replace rows by key. Writes the batch, and now and then merges what earlier batches wrote.

        With ``recency`` columns, a stored row stays if it is more recent; without, the later load wins. They are
        fixed when the table is created, as its key and number of buckets are. ``keys_unique`` spares the search
        for the newest row per key where a check has already proven that no key occurs twice in the batch.
        """
        layout = self._layout(table, key, recency)
        newest = align(batch, self.schemas[table])
        if not keys_unique:
            newest = latest_per_key(newest, key, recency)
        else:
            newest = newest.hint("rebalance")  # few files; the search for the newest has seen to it otherwise
        run = self.versions(table).run(slice_id)
        seen = self._write_run(run, table, newest, layout, {})
        if seen["nulls"]:
            raise ValueError(f"upsert into {table}: {key} must not be NULL")
        if not seen["rows"]:
            return
        state = run.commit()
        try:
            self._tidy(table, layout, state)
        except CommitConflict:
            pass  # another writer is at it; the batch is in, and runs left over wait for the next load

    def _write_run(self, run: Run, table: str, rows: DataFrame, layout: dict[str, Any], facts: dict[str, Any]) -> dict[str, Any]:
        """One sorted run; returns what was seen while writing."""
        key = layout["key"]
        if BUCKET_COLUMN not in rows.columns:
            rows = rows.withColumn(BUCKET_COLUMN, F.pmod(F.xxhash64(key), F.lit(layout["buckets"])).cast("int"))
        rows = rows.sortWithinPartitions(BUCKET_COLUMN, key)
        path, seen = run.write_observed(
            table,
            rows,
            rows=F.count(F.lit(1)),
            nulls=F.count_if(F.col(key).isNull()),
            low=F.min(key),
            high=F.max(key),
            bytes=F.sum(row_bytes(rows)),
        )
        kept = {name: seen[name] for name in ("rows", "low", "high", "bytes")}
        run.put(f"{table}/run/{path.rsplit('/', 2)[-2]}", path, **kept, **facts)
        return seen

    def _tidy(self, table: str, layout: dict[str, Any], state: State) -> None:
        """Fold the runs into the base once they are a fair part of it, else merge a tier of many similar runs.

        A row is so rewritten a bounded number of times: once per tier, and by folds that the base has
        to outgrow by a constant factor each.
        """
        runs, base = state.below(f"{table}/run/"), state.below(f"{table}/base/")
        if len(runs) < TIER_RUNS and base:
            return
        stored = sum(entry["rows"] for entry in base.values())
        if sum(entry["rows"] for entry in runs.values()) >= FOLD_SHARE * stored:
            self.fold(table)
            return
        tiers: dict[int, list[str]] = {}
        for name, entry in runs.items():
            tier = 0
            while entry["rows"] >= TIER_FACTOR ** (tier + 1):
                tier += 1
            tiers.setdefault(tier, []).append(name)
        for names in tiers.values():
            if len(names) >= TIER_RUNS:
                self._merge_runs(table, layout, names)

    def _merge_runs(self, table: str, layout: dict[str, Any], names: list[str]) -> None:
        """Several runs become one that stands where the latest of them stood."""
        run = self.versions(table).run("merge")
        entries = [run.base.entries[name] for name in names]
        rows = latest_per_key(self._runs(table, entries), layout["key"], _precedence(layout["recency"]))
        facts = {"order": max(entry.get("order", entry["version"]) for entry in entries)}
        self._write_run(run, table, rows.drop(_ORDER), layout, facts)
        for name in names:
            run.drop(name)
        run.commit()

    def fold(self, table: str) -> None:
        """Merge all runs into the base; only buckets that the runs touch are read and written.

        The new base is published together: readers see it as a whole, and a failure, or another writer
        who was faster, leaves the table as it was.
        """
        run = self.versions(table).run("fold")
        layout, runs = self._stored_layout(table), run.base.below(f"{table}/run/")
        if not runs:
            return
        changed = self._runs(table, runs.values())
        # at most one number per bucket
        touched = [row[0] for row in changed.select(BUCKET_COLUMN).distinct().collect()]
        base = [e["path"] for n in touched if (e := run.base.entries.get(f"{table}/base/{n}"))]
        merged = self._merged(table, layout, base, list(runs.values()))
        bucket = F.pmod(F.xxhash64(layout["key"]), F.lit(layout["buckets"])).cast("int")
        merged = merged.withColumn(BUCKET_COLUMN, bucket).hint("rebalance", BUCKET_COLUMN)
        path = run.write_divided(table, merged.sortWithinPartitions(BUCKET_COLUMN, layout["key"]), BUCKET_COLUMN)
        written = self.spark.read.schema(T.StructType([self.schemas[table][layout["key"]], _BUCKET_FIELD])).parquet(path)
        ranges = written.groupBy(BUCKET_COLUMN).agg(
            F.count(F.lit(1)).alias("rows"), F.min(layout["key"]).alias("low"), F.max(layout["key"]).alias("high")
        )
        for row in ranges.collect():
            facts = {name: row[name] for name in ("rows", "low", "high")}
            run.put(f"{table}/base/{row[BUCKET_COLUMN]}", f"{path}/{BUCKET_COLUMN}={row[BUCKET_COLUMN]}", **facts)
        for name in runs:
            run.drop(name)
        run.commit()

    def _runs(self, table: str, entries: Iterable[dict[str, Any]]) -> DataFrame:
        """Rows of runs with their bucket and the place of their load among all loads."""
        schema = T.StructType([*self.schemas[table].fields, _BUCKET_FIELD])
        found = None
        for entry in entries:
            rows = self.spark.read.schema(schema).parquet(entry["path"])
            rows = rows.withColumn(_ORDER, F.lit(entry.get("order", entry["version"])).cast("long"))
            found = rows if found is None else found.unionAll(rows)
        return found

    def _merged(self, table: str, layout: dict[str, Any], base: list[str], runs: list[dict[str, Any]]) -> DataFrame:
        """Base and runs, one row per key.

        While the runs fit a broadcast, the base's rows stay in their tasks and are compared with the runs' there;
        beyond that all of them are aggregated by key together, in one shuffle.
        """
        key, precedence = layout["key"], _precedence(layout["recency"])
        schema = self.schemas[table]
        stored = self.versions(table).read_paths(base, schema)
        if not runs:
            return stored
        loaded = self._runs(table, runs).drop(BUCKET_COLUMN)
        newest = latest_per_key(loaded, key, precedence)
        if not base:
            return newest.select(*schema.names)
        stored = stored.withColumn(_ORDER, F.lit(0).cast("long"))
        if sum(entry["bytes"] for entry in runs) > BROADCAST_BYTES:
            return latest_per_key(stored.unionByName(loaded), key, precedence).select(*schema.names)
        ordered = [*precedence, *[n for n in stored.columns if n != key and n not in precedence]]
        low, high = min(entry["low"] for entry in runs), max(entry["high"] for entry in runs)
        known = stored.where(F.col(key).between(low, high)).select(key)
        known = known.join(F.broadcast(newest.select(key)), key, "left_semi")
        fresh = newest.join(F.broadcast(known), key, "left_anti").select(*schema.names)
        rivals = newest.select(F.col(key).alias("_key"), F.struct(*ordered).alias("_rival"))
        kept = stored.join(F.broadcast(rivals), F.col(key) == F.col("_key"), "left")
        best = F.greatest(F.struct(*ordered), "_rival").alias("_best")
        return kept.select(key, best).select(key, "_best.*").select(*schema.names).unionAll(fresh)

    def read_keys(self, table: str, low: Any = None, high: Any = None) -> DataFrame:
        """Current rows of an upserted table, of all keys or those from ``low`` to ``high``; other files are not opened."""
        state = self.versions(table).state()

        def wanted(entry: dict[str, Any]) -> bool:
            return (high is None or entry["low"] <= high) and (low is None or entry["high"] >= low)

        base = [e["path"] for e in state.below(f"{table}/base/").values() if wanted(e)]
        runs = [e for e in state.below(f"{table}/run/").values() if wanted(e)]
        if not base and not runs:
            return no_rows(self.spark, self.schemas[table])
        layout = self._stored_layout(table)
        rows = self._merged(table, layout, base, runs)
        key = F.col(layout["key"])
        rows = rows if low is None else rows.where(key >= low)
        return rows if high is None else rows.where(key <= high)

    def _layout(self, table: str, key: str, recency: Sequence[str]) -> dict[str, Any]:
        """Key, number of buckets and recency columns a table was created with; recorded on first use."""
        if not isinstance(self.schemas[table][key].dataType, (T.StringType, T.IntegralType)):
            raise ValueError(f"{table} cannot be keyed by {key}: keys are texts or whole numbers")
        if table not in self._layouts:
            made = literal_rows(
                self.spark, [{"key": key, "buckets": self.buckets, "recency": list(recency)}], STORE_LAYOUT
            )
            made.write.mode("ignore").json(self._layout_path(table))
        stored = self._stored_layout(table)
        if stored["key"] != key:
            raise ValueError(f"{table} is keyed by {stored['key']}, not {key}")
        if stored["recency"] != list(recency):
            raise ValueError(f"{table} is ordered by {stored['recency']}, not {list(recency)}")
        return stored

    def _layout_path(self, table: str) -> str:
        return f"{self.root}/_layout/{table}"

    def _stored_layout(self, table: str) -> dict[str, Any]:
        if table not in self._layouts:
            row = self.spark.read.schema(STORE_LAYOUT).json(self._layout_path(table)).first()
            self._layouts[table] = {"key": row["key"], "buckets": row["buckets"], "recency": row["recency"] or []}
        return self._layouts[table]

    def read(self, table: str) -> DataFrame:
        """Current rows of a table, whichever way it is loaded."""
        method = LOAD_METHODS[table][0] if table in LOAD_METHODS else "APPEND"
        if method == "REPLACE":
            return self.versions(table).read(table)
        if method == "UPSERT":
            return self.read_keys(table)
        return self.read_slices(table).drop(SLICE_COLUMN)

    def read_slices(self, table: str, slices: Iterable[str] | None = None) -> DataFrame:
        """Rows of an appended table with the slice each came from, of all slices or of some."""
        schema = T.StructType([*self.schemas[table].fields, _SLICE_FIELD])
        entries = self.versions(table).state().below(f"{table}/slice/")
        names = entries if slices is None else [n for s in slices if (n := f"{table}/slice/{s}") in entries]
        paths = [entries[name]["path"] for name in names if entries[name]["path"]]
        return self.versions(table).read_paths(paths, schema)


def load(
    store: RawStore,
    table: str,
    batch: DataFrame,
    slice_id: str,
    method: str,
    key: str | None = None,
    has_log: bool = False,
    recency: Sequence[str] = ("updated_at",),
    keys_unique: bool = False,
) -> None:
    """Load a checked batch with the entity's strategy, then its history."""
    if method == "REPLACE":
        store.replace(table, batch, slice_id)
    elif method == "UPSERT":
        if key is None:
            raise ValueError("UPSERT needs a key")
        known = [name for name in recency if name in batch.columns]
        store.upsert(table, batch, key, known, slice_id, keys_unique)
    elif method == "APPEND":
        store.append(table, batch, slice_id)
    else:
        raise ValueError(f"unknown load method {method}")
    if has_log:
        store.append(f"{table}_log", batch, slice_id)
