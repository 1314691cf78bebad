"""Ids of whole Arrow text columns, every distinct word of a slice encoded once.

For vocabularies whose tokens end with their word and whose tokenizer drops white space, a text's ids
are those of its words one after the other. Words are told apart by Arrow's dictionary encoding over
the text buffer itself; words not met before go to the merges together, in one call; ids of all
occurrences are then gathered with numpy.
"""

from __future__ import annotations

import json
import os
import re
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa

from engagemart.llm.packing import _DIGITS, _LETTERS, _byte_letters
from engagemart.llm.words import word_bounds

#: Words whose ids a worker keeps; beyond it the table starts afresh.
KEPT_WORDS = 1_000_000
_WORD_END = "</w>"
#: The tokenizer's own split of lower-cased words of Latin-1 characters, one word a line; line ends stand alone.
_PARTS = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}\n]+")
_PLAIN_LINES = re.compile("[\n!-~¡-ÿ]*")


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


class WordTokens:
    """Encodes with a word-end vocabulary; other vocabularies go through the library text by text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        model = json.loads(Path(path).read_text())["model"]
        self._by_word = model.get("end_of_word_suffix") == _WORD_END
        if self._by_word:
            self._merges(model["vocab"])
        self._forget()

    def _merges(self, vocabulary: dict[str, int]) -> None:
        """The merges as ranks over bytes; byte 0 stands for the end of a part and joins its last byte first."""
        import tiktoken

        byte = {letter: number for number, letter in enumerate(_byte_letters())}
        ranks = {}
        for token, number in vocabulary.items():
            stem = token.removesuffix(_WORD_END)
            ranks[bytes([byte[letter] for letter in stem]) + b"\0" * (stem != token)] = number
        self._encoding = tiktoken.Encoding("parts", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})
        self._line_end = ranks[b"\n\0"]

    def _forget(self) -> None:
        self._rows: dict[bytes, int] = {}
        self._starts, self._lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self._ids, self._used = np.zeros(1 << 16, np.uint32), 0

    def _plain(self, lines: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words on ``lines`` and how many each has."""
        ids = np.array(self._encoding.encode_ordinary("\0".join(_PARTS.findall(lines.lower())) + "\0"), np.uint32)
        ends = np.flatnonzero(ids == self._line_end)
        lengths = np.diff(np.concatenate([[-1], ends])) - 1
        return ids[ids != self._line_end], lengths

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lines = b"\n".join([*words, b""]).decode()
        if "<|" not in lines and _PLAIN_LINES.fullmatch(lines):
            return self._plain(lines)
        texts = lines.split("\n")[:-1]
        plain = np.array(["<|" not in text and bool(_PLAIN_LINES.fullmatch(text)) for text in texts])
        easy, lengths = np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        if plain.any():
            easy, lengths[plain] = self._plain("".join([text + "\n" for text, p in zip(texts, plain, strict=True) if p]))
        hard = self._tokenizer.encode_batch([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False)
        lengths[~plain] = [len(found.ids) for found in hard]
        ids = np.zeros(lengths.sum(), np.uint32)
        from_easy = np.repeat(plain, lengths)
        ids[from_easy] = easy
        ids[~from_easy] = np.array([i for found in hard for i in found.ids], np.uint32)
        return ids, lengths

    def _learn(self, words: list[bytes]) -> None:
        ids, lengths = self._encode_words([word.rstrip() for word in words])
        first, count, end = len(self._rows), len(words), self._used + len(ids)
        if first + count > len(self._starts):
            more = np.zeros(first + 2 * count, np.int64)
            self._starts, self._lengths = np.concatenate([self._starts, more]), np.concatenate([self._lengths, more])
        if end > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros(2 * end, np.uint32)])
        self._starts[first : first + count] = self._used + np.cumsum(lengths) - lengths
        self._lengths[first : first + count] = lengths
        self._ids[self._used : end], self._used = ids, end
        self._rows.update(zip(words, range(first, first + count), strict=True))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]`` one after the other, and where each text's begin (n + 1)."""
        if not self._by_word:
            texts = [bytes(data[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            found = [np.array(x.ids, np.uint32) for x in self._tokenizer.encode_batch(texts, add_special_tokens=False)]
            counts = np.array([len(ids) for ids in found], np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.concatenate([[0], np.cumsum(counts)])
        if len(self._rows) > KEPT_WORDS:
            self._forget()
        starts, _, before = word_bounds(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        # a word reaches to the next one's start, so words lie one after the other as Arrow wants them
        bounds = np.append(starts, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        rows = np.array(list(map(self._rows.get, distinct, repeat(-1))), np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = len(self._rows) + np.arange(len(new))
            self._learn([distinct[k] for k in new])
        rows = rows[coded.indices.to_numpy()]
        lengths = self._lengths[rows]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(self._starts[rows] - ends[:-1], lengths) + np.arange(ends[-1])
        return self._ids[place], ends[before]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text's ids with ``end_id`` after them, and where each text's begin (n + 1)."""
    rows = len(bounds) - 1
    ended = np.full(len(ids) + rows, end_id, ids.dtype)
    ended[np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(bounds))] = ids
    return ended, bounds + np.arange(rows + 1)
