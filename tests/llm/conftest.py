import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


def _words(r, n):
    return [r.choice("alpha beta gamma delta Ünder été 7 MIT license x,y".split()) + str(r.randint(0, 60)) for _ in range(n)]


@pytest.fixture(scope="session")
def nasty():
    """(id, text) of texts with NULLs, blanks, ties, copies, near copies, shared passages and long rows."""
    r = random.Random(5)
    base, long = _words(r, 300), _words(r, 4000)
    passage = " ".join(_words(r, 70))
    rows = [None, "", " \n\t", "one", "one two  three", "x" * 5000, "ab " * 900, "license MIT license mit license", "a b\x85c"]
    rows += [" ".join(base), "  ".join(base), " ".join(base).upper(), "\n".join(base)]
    for k in range(12):
        near = list(base)
        for _ in range(k * 3):
            near[r.randrange(len(near))] = f"edit{r.randint(0, 9)}"
        rows.append(" ".join(near))
    rows += [" ".join(_words(r, 30)) + " " + passage + " " + " ".join(_words(r, r.randint(0, 60))) for _ in range(25)]
    rows += [" ".join(long), " ".join(long[:3900]), " ".join(long) + " end", "Released under the MIT License.\n" + " ".join(base[:40])]
    tiny = _words(r, 14)
    rows += [" ".join(tiny[: 14 - k]) for k in range(5)] + ["é" * 399, "é" * 400 + "z", "line one here\nline one here\nother"]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.fixture(scope="session")
def frame(spark):
    """(id, text) rows as documents, with further columns whose names clash with working columns."""

    def make(rows, repeat=False):
        rows = [*rows, *rows[:7]] if repeat else rows
        data = [(i, t, (None, "", "b", "a", "ä")[i % 5], "size", i, "w") for i, t in rows]
        columns = "doc_id bigint, text string, source string, kept string, _id bigint, n_words string"
        return spark.createDataFrame(data, columns).repartition(3)

    return make
