"""Parallel reads of a database table by predicates of about equal rows.

The database counts the rows of equally wide ranges of a whole-number column; heavy ranges are cut and
counted again, light neighbours are joined. Every query is plain SQL with one row per range as its result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

#: Ranges counted per wanted partition and round, and the most rounds of cutting heavy ones.
FINENESS, MOST_ROUNDS = 4, 6
#: Ranges counted by one query.
RANGES_PER_QUERY = 200

#: Runs a statement in the database and returns its rows.
Run = Callable[[str], Sequence[Sequence]]


@dataclass(frozen=True)
class _Range:
    """Values from ``low`` up to but not including ``high``."""

    low: int
    high: int
    rows: int


def _count(run: Run, table: str, column: str, edges: list[int]) -> list[_Range]:
    """Rows between neighbouring ``edges``."""
    counted = []
    for first in range(0, len(edges) - 1, RANGES_PER_QUERY):
        part = edges[first : first + RANGES_PER_QUERY + 1]
        piece = " ".join(f"when {column} < {edge} then {n}" for n, edge in enumerate(part[1:]))
        rows = run(
            f"select piece, count(*) from (select case {piece} end as piece from {table} "
            f"where {column} >= {part[0]} and {column} < {part[-1]}) pieces group by piece"
        )
        found = {int(number): int(n) for number, n in rows}
        counted += [_Range(low, high, found.get(n, 0)) for n, (low, high) in enumerate(zip(part, part[1:]))]
    return counted


def _edges(low: int, high: int, pieces: int) -> list[int]:
    pieces = max(1, min(pieces, high - low))
    return [low + (high - low) * n // pieces for n in range(pieces + 1)]


def _joined(ranges: list[_Range], wanted: float) -> list[_Range]:
    """Neighbours joined while they stay within ``wanted`` rows."""
    result: list[_Range] = []
    for one in ranges:
        if result and result[-1].rows + one.rows <= wanted:
            result[-1] = _Range(result[-1].low, one.high, result[-1].rows + one.rows)
        else:
            result.append(one)
    return result


def plan(run: Run, table: str, column: str, partitions: int) -> list[str]:
    """Predicates that together hold every row of ``table`` exactly once, NULLs included.

    ``column`` holds whole numbers. Each predicate has at most about 1 / ``partitions`` of the rows, save where one value
    alone has more. There are at most about twice ``partitions``. The outermost ranges are open, so rows that
    arrive outside the counted bounds are read too.
    """
    low, high, rows, filled = run(f"select min({column}), max({column}), count(*), count({column}) from {table}")[0]
    if not filled:
        return ["1 = 1"]
    low, high = int(low), int(high) + 1
    wanted = int(filled) / partitions
    ranges = _count(run, table, column, _edges(low, high, FINENESS * partitions))
    for _ in range(MOST_ROUNDS):
        heavy = [r for r in ranges if r.rows > wanted / 2 and r.high - r.low > 1]
        if not heavy:
            break
        ranges = [r for r in ranges if r not in heavy]
        for one in heavy:  # fewer than twice ``partitions``
            ranges += _count(run, table, column, _edges(one.low, one.high, FINENESS * 2))
        ranges.sort(key=lambda r: r.low)
    ranges = _joined(ranges, wanted)
    inner = [r.low for r in ranges[1:]]
    bounds = [None, *inner, None]
    predicates = []
    for start, end in zip(bounds, bounds[1:]):
        tests = [f"{column} >= {start}"] * (start is not None) + [f"{column} < {end}"] * (end is not None)
        predicates.append(" and ".join(tests) or f"{column} is not null")
    return [*predicates, f"{column} is null"] if int(rows) > int(filled) or len(predicates) > 1 else ["1 = 1"]
