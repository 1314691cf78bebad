"""License scan: base phrases, and an exact set-similarity join of text blocks with templates.

A block is a run of twice a template's words. It meets a template when it holds at least a threshold
share of its distinct words and, whole, a name that the template asks for: sentences of other
licences share most words with it. Labels and score count blocks from every word on; those listed
overlap by half. Words are ordered by how many documents of the whole corpus hold them, rarest first.

An inverted index of the templates' rarest n - needed + 1 words names the templates a text may meet (prefix filter).
In a text, only blocks that begin at one of the template's words, or at its name, can hold the most. Such a block is
passed over without a count unless it holds a prefix word, has enough of the template's words with repeats (length
filter), and, from its rarest one on, the template and the block have enough left, and more than the best block yet
(positional filter). Blocks that pass are counted in full.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import id_and_text

THRESHOLD = 0.8
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label and text of each template.
TEMPLATES = {
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "apache-2.0-spdx": "SPDX-License-Identifier: Apache-2.0",
    "apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
        "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
        "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-terms": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "cc-by-nc-4.0-name": "Creative Commons Attribution-NonCommercial 4.0",
    "cc-by-nc-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-statement": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "mit-license": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mit-spdx": "SPDX-License-Identifier: MIT",
    "mit-statement": "Released under the MIT License.",
    "mit-terms": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction"
    ),
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"
    ),
    "zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
        "removed or altered from any source distribution."
    ),
}


def _numbered(name: bytes, number: bytes) -> bytes:
    """``name`` with ``number`` as its version: the first one after it, one of a choice, or "version N of the" before it."""
    other = rb"(?!v?[0-9]{1,2} )[^ ]+ |v?[0-9] (?:[0-9] )?(?=(?:or|and) (?:version )?v?" + number + rb" )"
    after = rb"(?:" + other + rb"){0,12}?v?" + number + b" "
    before = rb"(?<![^ ])(?:version |v)" + number + rb" (?:0 )?(?:or (?:any )?later )?of the (?:terms of the )?(?:gnu )?"
    return rb"(?<![^ ])" + name + after + b"|" + before + name


_APACHE = _numbered(b"apache ", b"2")
_CC_BY_NC = _numbered(
    rb"(?<!sa )(?<!nd )(?:nc|noncommercial|non commercial) (?!(?:by )?(?:sa |nd |share|noderiv|no deriv))", b"4"
)
_GPL = rb"(?<!lesser )(?<!library )(?<!affero )(?:gnu (?:general )?|(?<!gnu )general )(?:public )?licen[cs]es? "
#: What a block must name, by template, as patterns over words that are each followed by one blank. Terms without
#: a name (bsd-terms, mit-terms, whole licences) ask for none.
NAMES = {
    "apache-2.0-notice": _APACHE,
    "apache-2.0-spdx": _APACHE,
    "apache-2.0-statement": _APACHE,
    "cc-by-nc-4.0-name": _CC_BY_NC,
    "cc-by-nc-4.0-statement": _CC_BY_NC,
    "gpl-3.0-statement": _numbered(_GPL, b"3").replace(b"(?:gnu )?" + _GPL, _GPL),
    "gpl-notice": rb"(?<![^ ])" + _GPL,
    "mit-spdx": rb"(?<![^ ])spdx license identifier mit (?!0 )",
    "mit-statement": (
        rb"(?<![^ ])(?:under|or|and|licen[cs]e) (?:the |terms |of |an? |is )*mit (?!0 )|(?<![^ ])mit (?!0 )(?:[^ ]+ )?licen[cs]es? "
    ),
    "mit-warranty": rb"(?<![^ ])noninfringement ",
}
#: Word characters are a-z, 0-9 and all that is not ASCII; A-Z is lower-cased, the rest is blank.
_FOLD = bytes(
    c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]  # distinct, rarest in the corpus first
    length: int  # words with repeats
    needed: int
    name: re.Pattern | None = None

    @property
    def prefix(self) -> tuple[bytes, ...]:
        return self.words[: len(self.words) - self.needed + 1]


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], id_col: str, text_col: str) -> Counter:
    """In how many documents each word of the vocabulary stands, over all documents."""
    given = id_and_text(docs, id_col, text_col).select("_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("_text"):
                seen.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
        )

    total = given.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return Counter({bytes(row["word"]): row["n"] for row in total.collect()})


def prepare(
    templates: dict[str, str], threshold: float, frequency: Counter, names: dict[str, bytes] = NAMES
) -> list[Template]:
    found = []
    for label, text in sorted(templates.items()):
        words = words_of(text)
        ordered = tuple(sorted(set(words), key=lambda w: (frequency[w], w)))
        if ordered:
            name = re.compile(rb"(?=(" + names[label] + rb"))") if label in names else None
            found.append(Template(label, ordered, len(words), max(1, ceil(threshold * len(ordered) - 1e-9)), name))
    return found


def name_places(words: list[bytes], template: Template) -> list[tuple[int, int]] | None:
    """First word and end of every place where the template's name stands, in order; None if it asks for none."""
    if template.name is None:
        return None
    line = b" ".join([*words, b""])
    spans = [found.span(1) for found in template.name.finditer(line)]
    if not spans:
        return []
    begins = list(accumulate((len(word) + 1 for word in words), initial=0))
    return [(bisect_left(begins, a), bisect_left(begins, b)) for a, b in spans]


def least_ends(places: list[tuple[int, int]] | None, count: int) -> list[int]:
    """For each word, where the first name that starts from it on ends; one more than ``count`` if none does."""
    ends = [count + 1 if places is not None else 0] * (count + 1)
    for first, end in places or ():
        ends[first] = min(ends[first], end)
    if places:
        for at in range(count - 1, -1, -1):
            ends[at] = min(ends[at], ends[at + 1])
    return ends


class Blocks:
    """The blocks of one text against one template: filters first, counts of what passes.

    ``tally`` counts the blocks looked at and those counted in full.
    """

    def __init__(self, words: list[bytes], template: Template, tally: Counter | None = None):
        rank = {word: k for k, word in enumerate(template.words)}
        self.template, self.size, self.tally = template, 2 * template.length, tally
        held = [(at, rank[word]) for at, word in enumerate(words) if word in rank]
        self.places, self.ranks = [at for at, _ in held], [k for _, k in held]
        rare = [(at, k) for at, k in held if k < len(template.prefix)]
        self.rare_places, self.rare_ranks = [at for at, _ in rare], [k for _, k in rare]
        self.names = name_places(words, template)
        self.ends = least_ends(self.names, len(words))

    def shared(self, start: int, least: int) -> int:
        """How many of the template's words the block from ``start`` on holds; 0 if under ``least`` or unnamed."""
        if self.tally is not None:
            self.tally["blocks"] += 1
        end = start + self.size
        first, last = bisect_left(self.rare_places, start), bisect_left(self.rare_places, end)
        if first == last:  # prefix filter
            return 0
        low, high = bisect_left(self.places, start), bisect_left(self.places, end)
        if high - low < least or self.ends[start] > end:  # length filter
            return 0
        rarest = min(self.rare_ranks[first:last])
        if len(self.template.words) - rarest < least:  # positional filter
            return 0
        if self.tally is not None:
            self.tally["counted"] += 1
        found = len(set(self.ranks[low:high]))
        return found if found >= least else 0

    def best(self) -> int:
        """The most of the template's words that a block from any word on holds; 0 if too few."""
        best, least = 0, self.template.needed
        starts = sorted({*self.places, *(first for first, _ in self.names or ())})
        at = 0
        while at < len(starts) and least <= len(self.template.words):
            start = starts[at]
            near = bisect_left(self.rare_places, start)
            if near == len(self.rare_places):
                break
            if (reach := self.rare_places[near] - self.size + 1) > start:  # no prefix word before there
                at = bisect_left(starts, reach, at + 1)
                continue
            if found := self.shared(start, least):
                best, least = found, found + 1
            at += 1
        return best

    def listed(self) -> list[tuple[int, int]]:
        """(first word, shared words) of the blocks met that start at multiples of the template's length."""
        step = self.template.length
        starts = {max(0, at // step + back) * step for at in self.rare_places for back in (-1, 0)}
        found = ((start, self.shared(start, self.template.needed)) for start in sorted(starts))
        return [(start, count) for start, count in found if count]


def prefix_index(templates: list[Template]) -> dict[bytes, list[int]]:
    """Numbers of the templates that have a word in their prefix, by word."""
    index: dict[bytes, list[int]] = {}
    for number, template in enumerate(templates):
        for word in template.prefix:
            index.setdefault(word, []).append(number)
    return index


def meetings(
    words: list[bytes], templates: list[Template], index: dict[bytes, list[int]], tally: Counter | None = None
) -> Iterator[tuple[Template, int, list[tuple[int, int]]]]:
    """(template, its most words in a block, blocks) of every template met."""
    met = {number for word in index.keys() & set(words) for number in index[word]}
    for number in sorted(met):
        blocks = Blocks(words, templates[number], tally)
        if blocks.names != [] and (best := blocks.best()):
            yield templates[number], best, blocks.listed()


def base_places(words: list[bytes], phrases: dict[bytes, str]) -> list[tuple[int, str]]:
    """(word, label) of every place where a phrase stands."""
    line, places = b" " + b" ".join(words) + b" ", []
    for phrase, label in phrases.items():
        wanted, at = b" " + phrase + b" ", -1
        while (at := line.find(wanted, at + 1)) >= 0:
            places.append((line.count(b" ", 0, at), label))
    return places


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    phrases: dict[str, str] = PHRASES,
    names: dict[str, bytes] = NAMES,
) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    ``labels`` has the labels of phrases and of templates met; ``score`` is 1 if a phrase
    stands in the text, else the largest share of a met template's words that a block
    holds, else 0. Blocks from every word count. ``blocks`` lists (label, first word, share) of those that start at
    multiples of their template's length. A block meets a template in ``names`` only if it has its name. NULL and empty texts
    have no words. Rows without an id, or repeating one, are judged one by one like all others; further columns are not
    read, and an empty table gives an empty result. Templates are a short list and travel with the job.
    """
    vocabulary = {word for text in templates.values() for word in words_of(text)}
    ready = prepare(templates, threshold, word_frequencies(docs, vocabulary, id_col, text_col), names)
    spelled = {b" ".join(words_of(phrase)): label for phrase, label in phrases.items()}
    index = prefix_index(ready)
    given = id_and_text(docs, id_col, text_col)
    block = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("share", pa.float64())])
    kinds = {
        "n_words": pa.int64(),
        "n_base": pa.int64(),
        "first_word": pa.int64(),
        "last_word": pa.int64(),
        "base_labels": pa.string(),
        "labels": pa.string(),
        "score": pa.float64(),
        "blocks": pa.list_(block),
    }

    def scan(text: str) -> tuple:
        words = words_of(text)
        places = base_places(words, spelled)
        found = list(meetings(words, ready, index))
        met = [(t.label, start, shared / len(t.words)) for t, _, blocks in found for start, shared in blocks]
        base = {label for _, label in places}
        return (
            len(words),
            len(places),
            min(places)[0] if places else None,
            max(places)[0] if places else None,
            ",".join(sorted(base)),
            ",".join(sorted(base | {t.label for t, _, _ in found})),
            1.0 if places else max((best / len(t.words) for t, best, _ in found), default=0.0),
            [dict(zip(("label", "first_word", "share"), m, strict=True)) for m in met],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                rows = [scan(text.as_py()) for text in part.column("_text")]
                columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds.values())]
                yield pa.RecordBatch.from_arrays([part.column("_id"), *columns], [id_col, *kinds])

    id_kind = given.schema["_id"].dataType.simpleString()
    return given.mapInArrow(
        run,
        f"{id_col} {id_kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, blocks array<struct<label:string,first_word:bigint,share:double>>",
    )
