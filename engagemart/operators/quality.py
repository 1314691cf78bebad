"""Declarative quality rules, checked in as few passes as the rules allow.

All rules except uniqueness are additive and share one pass over the table without
a shuffle. A uniqueness rule shuffles only its own column, and of a table known to be large only
short hashes of it and the values that may be repeated.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart import constants as K
from engagemart.operators import uniqueness
from engagemart.schemas import CHECK_RESULTS
from engagemart.scratch import no_rows


@dataclass(frozen=True)
class Rule:
    """One constraint on one column."""

    constraint: str
    column: str
    threshold: float = 0.0

    @property
    def flag(self) -> str:
        prefix = {"unique": "isunique", "complete": "isnotnull"}.get(self.constraint, self.constraint)
        return f"{prefix}_{self.column}"


def unique(column: str) -> Rule:
    """No value occurs twice; NULLs are ignored."""
    return Rule("unique", column)


def complete(column: str) -> Rule:
    """No NULLs."""
    return Rule("complete", column)


def integral(column: str) -> Rule:
    """Every non-NULL value reads as a whole number."""
    return Rule("integral", column)


def fits_integer(column: str) -> Rule:
    """Every whole number fits a 32-bit integer."""
    return Rule("fits_integer", column)


def non_negative(column: str) -> Rule:
    """No value below zero; NULL passes."""
    return Rule("non_negative", column)


def max_length(column: str, length: int) -> Rule:
    """No text longer than ``length`` characters."""
    return Rule("max_length", column, float(length))


def nonzero_share(column: str, percent: float = K.MIN_SHARE_PERCENT) -> Rule:
    """More than ``percent`` of the non-NULL values differ from zero; no values fail."""
    return Rule("nonzero_share", column, float(percent))


def nonempty_share(column: str, percent: float = K.MIN_SHARE_PERCENT) -> Rule:
    """More than ``percent`` of the non-NULL values differ from ''; no values fail."""
    return Rule("nonempty_share", column, float(percent))


BATTERIES: dict[str, tuple[Rule, ...]] = {
    "brand": (
        unique("user_id"),
        complete("user_id"),
        unique("tag_name"),
        complete("tag_name"),
    ),
    "brand_log": (complete("user_id"),),
    "media": (
        complete("user_id"),
        unique("media_id"),
        complete("media_id"),
        nonzero_share("like_count"),
        nonzero_share("comments_count"),
        complete("media_type"),
        complete("media_product_type"),
    ),
    "media_hashtag": (
        complete("user_id"),
        complete("media_id"),
        nonempty_share("caption"),
        complete("media_type"),
    ),
}


class QualityError(Exception):
    """Raised by :func:`enforce`; lists every failed constraint."""

    def __init__(self, failures: Sequence[Row]):
        self.failures = list(failures)
        lines = [
            f"{f.table_name}.{f.column_name}: {f.constraint_name} "
            f"(metric {f.metric}, threshold {f.threshold})"
            for f in self.failures
        ]
        super().__init__("quality check failed: " + "; ".join(lines))


def rules_from_contract(contract: Iterable[Row], with_max_length: bool = False) -> list[Rule]:
    """Rules for one table from its contract rows.

    Length rules are off unless asked for, and never apply to id columns.
    """
    rows = list(contract)
    rules = [unique(r.column_name) for r in rows if r.unique_name is not None]
    rules += [complete(r.column_name) for r in rows if r.is_nullable == "NO"]
    for r in rows:
        if r.data_type == "integer":
            rules += [integral(r.column_name), non_negative(r.column_name)]
    if with_max_length:
        rules += [
            max_length(r.column_name, r.character_maximum_length)
            for r in rows
            if r.character_maximum_length is not None and not r.column_name.endswith("id")
        ]
    return rules


def _reads_as_bigint(column: Column) -> Column:
    # The pattern decides nearly always; a failing try_cast is far slower per row.
    text = F.trim(column.cast("string"))
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint").isNotNull()).otherwise(False)


def _additive_metric(df: DataFrame, rule: Rule) -> Column:
    column = F.col(rule.column)
    if rule.constraint == "complete":
        return F.count_if(column.isNull())
    if rule.constraint == "integral":
        if isinstance(df.schema[rule.column].dataType, T.IntegralType):
            return F.count_if(F.lit(False))
        return F.count_if(column.isNotNull() & ~_reads_as_bigint(column))
    if rule.constraint == "fits_integer":
        whole = column.cast("string").try_cast("decimal(38,0)")
        return F.count_if(~whole.between(-(2**31), 2**31 - 1) & _reads_as_bigint(column))
    if rule.constraint == "non_negative":
        if isinstance(df.schema[rule.column].dataType, T.StringType):
            column = column.try_cast("double")
        return F.count_if(column < 0)
    if rule.constraint == "max_length":
        return F.max(F.length(column))
    if rule.constraint in ("nonzero_share", "nonempty_share"):
        default = F.lit(0) if rule.constraint == "nonzero_share" else F.lit("")
        return 100 - F.try_divide(F.count_if(column == default) * 100, F.count(column))
    raise ValueError(f"unknown constraint {rule.constraint}")


def _passed(rule: Rule, metric: Column) -> Column:
    if rule.constraint in ("nonzero_share", "nonempty_share"):
        return F.coalesce(metric > rule.threshold, F.lit(False))
    return F.coalesce(metric <= rule.threshold, F.lit(True))


def _result(table: str, rule: Rule, metric: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule.constraint).alias("constraint_name"),
        F.lit(rule.column).alias("column_name"),
        metric.cast("double").alias("metric"),
        F.lit(rule.threshold).alias("threshold"),
        _passed(rule, metric.cast("double")).alias("passed"),
    )


#: From so many rows on, hashes are shuffled instead of values.
LARGE_ROWS = 20_000_000


def duplicates(df: DataFrame, column: str, rows: int | None = None) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows.

    ``rows`` is given where the number of rows is known and ``df`` can be read twice.
    """
    if rows is not None and rows >= LARGE_ROWS:
        return uniqueness.repeats(df, column, rows)
    return uniqueness.count_repeats(df.select(column), column)


def _unique_result(df: DataFrame, table: str, rule: Rule, rows: int | None = None) -> DataFrame:
    counted = duplicates(df, rule.column, rows).agg(F.count(F.lit(1)).alias("metric"))
    return counted.select(F.inline(F.array(_result(table, rule, F.col("metric")))))


def _split(rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    additive = [rule for rule in rules if rule.constraint != "unique"]
    return additive, [rule for rule in rules if rule.constraint == "unique"]


def verify(df: DataFrame, rules: Sequence[Rule], table: str, rows: int | None = None) -> DataFrame:
    """One result row per rule; ``rows`` as for :func:`duplicates`."""
    additive, distinct = _split(rules)
    parts = [_unique_result(df, table, rule, rows) for rule in distinct]
    if additive:
        metrics = [_additive_metric(df, rule).alias(f"m{i}") for i, rule in enumerate(additive)]
        results = [_result(table, rule, F.col(f"m{i}")) for i, rule in enumerate(additive)]
        parts.append(df.agg(*metrics).select(F.inline(F.array(*results))))
    if not parts:
        return no_rows(df.sparkSession, CHECK_RESULTS)
    return reduce(DataFrame.unionAll, parts)


def verify_written(
    df: DataFrame, rules: Sequence[Rule], table: str, path: str, fmt: str = "parquet"
) -> DataFrame:
    """Write ``df`` to ``path`` and check it; the additive rules ride on the write."""
    spark = df.sparkSession
    additive, distinct = _split(rules)
    if not additive:
        df.write.mode("overwrite").format(fmt).save(path)
        return verify(spark.read.schema(df.schema).format(fmt).load(path), rules, table)
    observation = Observation()
    metrics = [
        _additive_metric(df, rule).cast("double").alias(f"m{i}") for i, rule in enumerate(additive)
    ]
    metrics.append(F.count(F.lit(1)).alias("rows"))
    df.observe(observation, *metrics).write.mode("overwrite").format(fmt).save(path)
    seen = observation.get
    results = [
        _result(table, rule, F.lit(seen[f"m{i}"]).cast("double")) for i, rule in enumerate(additive)
    ]
    parts = [spark.range(0, 1, 1, 1).select(F.inline(F.array(*results)))]
    if distinct:
        written = spark.read.schema(df.schema).format(fmt).load(path)
        parts += [_unique_result(written, table, rule, seen["rows"]) for rule in distinct]
    return reduce(DataFrame.unionAll, parts)


def flags(results: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Results of one table as a single row of named booleans."""
    return results.agg(
        *[
            F.max(
                F.when(
                    (F.col("constraint_name") == rule.constraint)
                    & (F.col("column_name") == rule.column),
                    F.col("passed"),
                )
            ).alias(rule.flag)
            for rule in rules
        ]
    )


def failures(results: DataFrame) -> DataFrame:
    """The failed constraints only."""
    return results.where(~F.col("passed"))


def enforce(results: DataFrame) -> None:
    """Raise :class:`QualityError` if any constraint failed (one small row per rule)."""
    failed = failures(results).collect()
    if failed:
        raise QualityError(failed)


def verify_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Results of the fixed batteries for the given raw tables."""
    parts = [verify(df, BATTERIES[name], name) for name, df in tables.items() if name in BATTERIES]
    return reduce(DataFrame.unionAll, parts)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make raw tables addressable from SQL under their own names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
