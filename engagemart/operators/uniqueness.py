"""Repeated values of a column without shuffling all values.

Every value is reduced to a slot and a 32-bit number, both from its hash. Tasks collect the numbers of
each slot into arrays, which are what the first pass shuffles: about four bytes a value, however
long the values are. Numbers met twice are suspects. The second pass shuffles only the values
of suspects, and counts them exactly. A key that is unique, as keys should be, moves next to nothing there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from engagemart.scratch import materialize

#: Values per slot aimed at, and the most slots: a task's share of a slot should stay above some dozens.
SLOT_ROWS, MOST_SLOTS = 1 << 20, 8_192
#: Values above this share of all are never gathered.
HOT_SHARE = 0.001
#: Suspects up to this many are broadcast (16 bytes each); a column with more is counted by a plain shuffle.
MOST_SUSPECTS = 4_000_000


def count_repeats(values: DataFrame, column: str) -> DataFrame:
    """(column, n) of non-NULL values that occur more than once, by a shuffle of all values given."""
    return (
        values.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def _cell(df: DataFrame, column: str, slots: int) -> tuple[Column, Column]:
    value = F.col(column)
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0).cast(kind)  # -0.0 and 0.0 are one value
    mixed = F.xxhash64(value)
    low = F.shiftright(F.shiftleft(mixed, 32), 32)
    return F.pmod(F.shiftright(mixed, 32), F.lit(slots)).cast("int"), low.cast("int")


def _slots(rows: int, slot_rows: int) -> int:
    return max(1, min(MOST_SLOTS, rows // slot_rows))


def _frequent(cells: DataFrame) -> DataFrame:
    """Cells that may hold more than ``HOT_SHARE`` of all values; none that does is missing.

    At most about 1 / ``HOT_SHARE`` numbers, counted by tasks without a shuffle of values.
    """
    hot = cells.select(F.shiftleft(F.col("_slot").cast("bigint"), 32).bitwiseOR(_unsigned("_low")).alias("_cell"))
    packed = hot.stat.freqItems(["_cell"], HOT_SHARE)
    found = packed.select(F.explode("_cell_freqItems").alias("_cell"))
    low = F.shiftright(F.shiftleft("_cell", 32), 32)
    return found.select(F.shiftright("_cell", 32).cast("int").alias("_slot"), low.cast("int").alias("_low"))


def _unsigned(column: str) -> Column:
    return F.col(column).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))


def suspects(df: DataFrame, column: str, slots: int) -> DataFrame:
    """(_slot, _low): cells that may hold a value twice; every repeated value is in one of them.

    Frequent cells are suspects without being gathered, so no slot gets more than its share of numbers.
    """
    slot, low = _cell(df, column, slots)
    cells = df.where(F.col(column).isNotNull()).select(slot.alias("_slot"), low.alias("_low"))
    hot = materialize(_frequent(cells), "frequent").frame
    rest = cells.join(F.broadcast(hot), ["_slot", "_low"], "left_anti")
    # arrays travel; the numbers of a slot are counted where its arrays have met
    met = rest.groupBy("_slot").agg(F.collect_list("_low").alias("_lows"))
    again = met.select("_slot", F.explode("_lows").alias("_low")).groupBy("_slot", "_low").agg(F.count(F.lit(1)).alias("_n"))
    return again.where("_n > 1").select("_slot", "_low").unionAll(hot)


def repeats(
    df: DataFrame, column: str, rows: int, most_suspects: int = MOST_SUSPECTS, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """(column, n) of non-NULL values of ``df`` that occur more than once.

    ``rows`` is about the number of rows and only sizes the work. ``df`` is read twice, so it must be a scan or a
    written table. Exact at any number of suspects.
    """
    values = df.select(column)
    slots = _slots(rows, slot_rows)
    found = materialize(suspects(values, column, slots), "suspects")
    if found.rows > most_suspects:
        return count_repeats(values, column)
    slot, low = _cell(values, column, slots)
    cells = F.broadcast(found.frame)
    suspected = values.join(cells, (slot == F.col("_slot")) & (low == F.col("_low")), "left_semi")
    return count_repeats(suspected, column)
