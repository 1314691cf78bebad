"""Global ``rank()`` without sorting everything in one task.

The order column is cut into value ranges of similar size. Rows of one range are
ranked together and shifted by the number of rows in the ranges ahead. A value with
very many rows gets a range of its own; its rows all share one rank, so that range
is split into as many pieces as its size asks for and is never gathered anywhere.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, inf, isfinite, nextafter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.scratch import materialize

# Frames up to this many rows are ranked by the plain window function.
ROWS_PER_RANGE = 500_000
_MAX_RANGES = 20_000
_SAMPLES_PER_RANGE = 100
_EXACT_DOUBLE = 2**53
# Decimals of so many digits stay distinct as doubles.
_EXACT_DIGITS = 15
_NULL_RANGE = -1


@dataclass(frozen=True)
class Rank:
    """``output = rank() over (order by column)``; NULLs rank last when descending."""

    column: str
    output: str
    descending: bool = True

    @property
    def ordering(self) -> Column:
        column = F.col(self.column)
        return column.desc_nulls_last() if self.descending else column.asc_nulls_first()


def rankable(df: DataFrame, max_rows: int, label: str) -> tuple[DataFrame, int]:
    """``df`` in a form :func:`add_ranks` can read repeatedly, with a bound on its rows.

    ``max_rows`` is a proven bound. A frame that small is ranked in one go and stays
    as it is; a larger one is written out first.
    """
    if max_rows <= ROWS_PER_RANGE:
        return df, max_rows
    written = materialize(df, label)
    return written.frame, written.rows


def add_ranks(
    df: DataFrame,
    ranks: Sequence[Rank],
    max_rows: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add one bigint rank column per entry of ``ranks``.

    ``max_rows`` is a bound on the rows where the caller has one; otherwise they are
    counted. A frame above ``rows_per_range`` rows is read several times, so it must
    be a scan or a written table.
    """
    for rank in ranks:  # at every size, not only where ranges need numbers
        _order_key(df, rank.column)
    if max_rows is None:
        max_rows = df.count()
    if max_rows <= rows_per_range:
        for rank in ranks:
            window = Window.orderBy(rank.ordering)
            df = df.withColumn(rank.output, F.rank().over(window).cast("bigint"))
        return df
    return _ranked_by_range(df, ranks, max_rows, rows_per_range)


def _order_key(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"cannot rank {column}: {kind.simpleString()} is not numeric")
    # Adding zero turns -0.0 into 0.0, which rank() treats as equal.
    return F.col(column).cast("double") + F.lit(0.0)


def _cuts(df: DataFrame, ranks: Sequence[Rank], rows: int, rows_per_range: int) -> list[list[float]]:
    """Values that cut each order column into ranges, from quantiles of a bounded sample.

    The sample only places the cuts; ranks come from exact counts.
    """
    ranges = min(_MAX_RANGES, ceil(rows / rows_per_range))
    fraction = min(1.0, _SAMPLES_PER_RANGE * ranges / rows)
    sample = df.select(*[_order_key(df, r.column).alias(f"k{i}") for i, r in enumerate(ranks)])
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=0)
    shares = [i / ranges for i in range(1, ranges)]
    accuracy = max(10_000, 20 * ranges)
    quantiles = sample.agg(
        *[F.percentile_approx(name, shares, accuracy).alias(name) for name in sample.columns]
    ).first()
    return [sorted({value for value in values or [] if isfinite(value)}) for values in quantiles]


def _inexact_columns(df: DataFrame, ranks: Sequence[Rank]) -> set[str]:
    """Order columns with distinct values that look alike as doubles."""
    kinds = {rank.column: df.schema[rank.column].dataType for rank in ranks}
    inexact = {
        name
        for name, kind in kinds.items()
        if isinstance(kind, T.DecimalType) and kind.precision > _EXACT_DIGITS
    }
    longs = [name for name, kind in kinds.items() if isinstance(kind, T.LongType)]
    if longs:
        beyond = [F.max((F.col(n) > _EXACT_DOUBLE) | (F.col(n) < -_EXACT_DOUBLE)) for n in longs]
        inexact |= {name for name, found in zip(longs, df.agg(*beyond).first()) if found}
    return inexact


def _ranked_by_range(
    df: DataFrame, ranks: Sequence[Rank], rows: int, rows_per_range: int
) -> DataFrame:
    from pyspark.ml.feature import Bucketizer

    columns = df.columns
    inexact = _inexact_columns(df, ranks)
    cuts = _cuts(df, ranks, rows, rows_per_range)

    # Each cut becomes a range that holds just this value: [cut, next double).
    splits = [sorted({-inf, inf, *c, *(nextafter(v, inf) for v in c)}) for c in cuts]
    splits = [s if len(s) > 2 else [-inf, 0.0, inf] for s in splits]
    # Numbering the rows of a scan is repeatable; it spreads the rows of a single value.
    placed = df.withColumn("_row", F.monotonically_increasing_id())
    placed = placed.withColumns({f"_key{i}": _order_key(df, r.column) for i, r in enumerate(ranks)})
    placed = Bucketizer(
        splitsArray=splits,
        inputCols=[f"_key{i}" for i in range(len(ranks))],
        outputCols=[f"_bucket{i}" for i in range(len(ranks))],
        handleInvalid="keep",
    ).transform(placed)
    placed = placed.select(
        *columns,
        "_row",
        *[
            F.coalesce(F.col(f"_bucket{i}").cast("int"), F.lit(_NULL_RANGE)).alias(f"_range{i}")
            for i in range(len(ranks))
        ],
    )

    counts = _range_counts(placed, len(ranks))
    for i, rank in enumerate(ranks):
        single = {_NULL_RANGE, len(splits[i]) - 1}  # NULL, and NaN above everything
        if rank.column not in inexact:
            single |= {n for n, start in enumerate(splits[i]) if start in set(cuts[i])}
        placed = _shifted_rank(placed, rank, i, counts[i], single, rows_per_range)
    return placed.select(*columns, *[rank.output for rank in ranks])


def _range_counts(placed: DataFrame, ranks: int) -> dict[int, list[tuple[int, int]]]:
    """Rows per range: a few small numbers per range, counted in one pass."""
    pairs = [F.struct(F.lit(i).alias("rank"), F.col(f"_range{i}").alias("range")) for i in range(ranks)]
    counted = placed.select(F.inline(F.array(*pairs))).groupBy("rank", "range").count()
    result = defaultdict(list)
    for row in counted.collect():
        result[row["rank"]].append((row["range"], row["count"]))
    return result


def _shifted_rank(
    placed: DataFrame,
    rank: Rank,
    index: int,
    counts: list[tuple[int, int]],
    single: set[int],
    rows_per_range: int,
) -> DataFrame:
    ahead, shifts = 0, []
    for number, count in sorted(counts, reverse=rank.descending):
        pieces = ceil(count / rows_per_range) if number in single else 1
        shifts.append((number, ahead, pieces))
        ahead += count
    schema = f"_range{index} int, _ahead bigint, _pieces bigint"
    # At most two ranges per cut plus NULL and NaN.
    shift_frame = placed.sparkSession.createDataFrame(shifts, schema)
    piece = F.pmod(F.col("_row"), F.col("_pieces"))
    within = Window.partitionBy(f"_range{index}", "_piece").orderBy(rank.ordering)
    return (
        placed.join(F.broadcast(shift_frame), f"_range{index}")
        .withColumn("_piece", piece)
        .withColumn(rank.output, F.col("_ahead") + F.rank().over(within))
        .drop("_ahead", "_pieces", "_piece", f"_range{index}")
    )
