"""Quality rules: a decision list learned by sequential covering, in DataFrame functions only.

Each document gets a few statistics of its whole text. Labelled documents are counted in
a grid of thresholds on these statistics; on that table, rules for bad documents (conjunctions of thresholds) are
grown by information gain on one fold and pruned on another, one after the other, until
the next would not be precise enough. The list is applied as one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import keep_rows, with_keys, without_keys, written

WINDOW = 8
SHORT_WORDS, REPEAT_PERCENT = 20, 30
#: Labelled rows learned from: all of them up to about this many, then a seeded sample.
MOST_LABELLED = 20_000
MOST_RULES, MOST_CONDITIONS, LEAST_PRECISION, LEAST_HITS = 12, 4, 0.95, 4
QUANTILES = [0.01, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.85, 0.9, 0.95, 0.98, 0.99]
FEATURES = ("n_words", "word_length", "symbol_rate", "upper_rate", "mark_rate", "dup_line_rate", "repeat_rate")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over each whole text (NULL: none), one row per document.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_upper (A-Z), n_marks (``!``), n_lines.
    """
    blank = "[\\x20\\x09-\\x0D]+"
    rows = docs.select(docs[id_col].alias("_id"), F.coalesce(docs[text_col], F.lit("")).alias("_text"))
    rows = rows.withColumns(
        {
            "_words": F.array_remove(F.split("_text", blank), ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
        }
    )

    def left_of(pattern: str) -> Column:
        return F.length(F.regexp_replace("_text", pattern, "")).cast("long")

    rows = rows.select(
        "_id",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        left_of("[^#*$%&|<>]+").alias("n_symbols"),
        left_of("[^A-Z]+").alias("n_upper"),
        left_of("[^!]+").alias("n_marks"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    places = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(1), (F.col("n_words") - WINDOW + 1).cast("int")))
    rows = rows.withColumn(
        "_windows", F.transform(places, lambda place: F.xxhash64(F.slice(F.col("_hashes"), place, WINDOW)))
    )
    # distinct hashes mean distinct windows; only other texts compare the windows themselves
    rows = rows.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows")).drop("_hashes", "_windows")
    spelled = F.transform(
        places, lambda place: F.struct(F.array_join(F.slice(F.col("_words"), place, WINDOW), " ").alias("w"), place.alias("at"))
    )
    rows = rows.withColumn("_sorted", F.when(F.col("_repeats"), F.sort_array(spelled))).drop("_words")
    ordinals = F.sequence(F.lit(0), F.size("_sorted") - 1)

    def again(k: Column) -> Column:
        own, sorted_ = F.get("_sorted", k), F.col("_sorted")
        same = (own["w"] == F.get(sorted_, k - 1)["w"]) | (own["w"] == F.get(sorted_, k + 1)["w"])
        return F.when(same, own["at"])

    found = F.sort_array(F.array_compact(F.transform(ordinals, again)))
    rows = rows.withColumn("_found", F.when(F.col("_sorted").isNotNull(), found)).drop("_sorted")
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "_found",
        nothing,
        lambda a, at: F.struct((a["n"] + at + WINDOW - F.greatest(at, a["end"])).alias("n"), (at + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    return rows.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_upper",
        "n_marks",
        "n_lines",
    )


def features() -> dict[str, Column]:
    """The measures that rules test, from ``statistics``; rates of nothing are 0."""

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": rate("word_chars", "n_words"),
        "symbol_rate": rate("n_symbols", "n_words"),
        "upper_rate": rate("n_upper", "word_chars"),
        "mark_rate": rate("n_marks", "n_words"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class _Cell:
    """Labelled rows with the same steps: how many thresholds of each measure they reach."""

    steps: tuple[int, ...]
    bad: int
    good: int


def _holds(cell: _Cell, tests: list[tuple[int, bool, int]]) -> bool:
    return all((cell.steps[f] >= step) == at_least for f, at_least, step in tests)


def _counts(cells: list[_Cell], tests: list[tuple[int, bool, int]]) -> tuple[int, int]:
    held = [c for c in cells if _holds(c, tests)]
    return sum(c.bad for c in held), sum(c.good for c in held)


def _grow(cells: list[_Cell], grid: list[list[float]]) -> list[tuple[int, bool, int]]:
    """Tests added one by one, each with the most information gained over the bad rows it keeps."""
    tests: list[tuple[int, bool, int]] = []
    while len(tests) < MOST_CONDITIONS:
        bad, good = sum(c.bad for c in cells), sum(c.good for c in cells)
        if not bad or not good:
            break
        best, best_gain = None, 1e-9
        for feature, thresholds in enumerate(grid):
            at = [[0, 0] for _ in range(len(thresholds) + 1)]
            for cell in cells:
                at[cell.steps[feature]][0] += cell.bad
                at[cell.steps[feature]][1] += cell.good
            below_bad = below_good = 0
            for step in range(1, len(at)):
                below_bad, below_good = below_bad + at[step - 1][0], below_good + at[step - 1][1]
                for at_least, b, g in ((True, bad - below_bad, good - below_good), (False, below_bad, below_good)):
                    gain = b * (log2(b / (b + g)) - log2(bad / (bad + good))) if b else 0
                    if gain > best_gain:
                        best, best_gain = (feature, at_least, step), gain
        if best is None:
            break
        tests.append(best)
        cells = [c for c in cells if _holds(c, [best])]
    return tests


def _prune(tests: list[tuple[int, bool, int]], cells: list[_Cell]) -> list[tuple[int, bool, int]]:
    """The leading tests that separate the other fold best."""

    def worth(n: int) -> float:
        bad, good = _counts(cells, tests[:n])
        return (bad - good) / (bad + good) if bad + good else -1.0

    return tests[: max(range(1, len(tests) + 1), key=worth, default=0)]


def cover(grown: list[_Cell], held_out: list[_Cell], grid: list[list[float]]) -> list[Rule]:
    """The ordered rules for bad rows."""
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        tests = _prune(_grow(grown, grid), held_out)
        bad, good = _counts(held_out, tests)
        if not tests or bad < LEAST_HITS or bad < LEAST_PRECISION * (bad + good):
            break
        rules.append(tuple(Condition(FEATURES[f], at_least, grid[f][step - 1]) for f, at_least, step in tests))
        grown = [c for c in grown if not _holds(c, tests)]
        held_out = [c for c in held_out if not _holds(c, tests)]
    return rules


def learn(
    stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = MOST_LABELLED
) -> list[Rule]:
    """The decision list for documents labelled 0.

    Labels that are NULL or name no document are left out; an id with both labels counts as 0.
    About ``most`` labelled rows are used, chosen by a hash of the id. What reaches the driver is the
    thresholds and at most one counted row per labelled row used.
    """
    marked = (
        labels.filter(labels[label_col].isNotNull() & labels[id_col].isNotNull())
        .groupBy(labels[id_col].alias("_label_id"))
        .agg(F.min(labels[label_col]).alias("_label"))
    )
    known = marked.count()
    if not known:
        return []
    share = min(1.0, most / known)
    marked = marked.filter(F.pmod(F.xxhash64(F.lit(3), "_label_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    values = [column.alias(name) for name, column in features().items()]
    fold = F.pmod(F.xxhash64(F.lit(5), "_label_id"), F.lit(3)) > 0
    rows = written(
        stats.join(marked, stats[id_col] == F.col("_label_id")).select(
            (F.col("_label") == 0).alias("_bad"), fold.alias("_grow"), *values
        ),
        "labelled",
    )
    cuts = rows.agg(*(F.percentile_approx(name, QUANTILES, 10_000).alias(name) for name in FEATURES)).head()
    grid = [sorted(set(cuts[name] or [])) for name in FEATURES]
    steps = [
        sum((F.when(F.col(name) >= cut, 1).otherwise(0) for cut in row), F.lit(0)).alias(f"_{name}")
        for name, row in zip(FEATURES, grid, strict=True)
    ]
    counted = rows.select("_bad", "_grow", *steps).groupBy("_grow", *(f"_{name}" for name in FEATURES)).agg(
        F.count_if("_bad").alias("_n_bad"), F.count_if(~F.col("_bad")).alias("_n_good")
    )
    folds: dict[bool, list[_Cell]] = {True: [], False: []}
    for row in sorted(counted.collect()):
        folds[row["_grow"]].append(_Cell(tuple(row[f"_{n}"] for n in FEATURES), row["_n_bad"], row["_n_good"]))
    return cover(folds[True], folds[False], grid)


def verdict(rules: list[Rule]) -> Column:
    """True for documents the list keeps: the first rule that holds decides."""
    result = None
    for rule in rules:
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column()
        result = F.when(held, False) if result is None else result.when(held, False)
    return F.lit(True) if result is None else result.otherwise(True)


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its counts, base_failed and kept.

    A text fails the base rules with under 20 words or over 30 % of its words in repeated
    8-word windows; any other is kept unless the learned list rejects it. Without labels nothing more is rejected.
    NULL and empty texts have no words and fail. Repeated rows each get a row.
    """
    stats = written(statistics(docs, id_col, text_col), "statistics")
    failed = (F.col("n_words") < SHORT_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & verdict(learn(stats, labels, id_col))
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged; rows of one id and text fall together."""
    keyed, last = with_keys(docs, id_col)
    if last is not None:  # labels beyond the ids name no document
        labels = labels.filter(labels[id_col] <= last)
    return without_keys(keep_rows(keyed, quality(keyed, labels, id_col).filter("kept"), id_col), last, docs, id_col)
