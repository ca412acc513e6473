"""Encoding whole texts with public vocabularies, each distinct word once per worker.

Both kinds of vocabulary used here never join characters across a space or a line feed, so a text's
ids are those of its space-separated parts, one after the other.  A slice of rows is split with
Arrow, its distinct parts are looked up in a table of parts seen before, only new ones go to the
tokenizer, and the ids are gathered with numpy.  The table is emptied when it is full; that costs
time and changes nothing.
"""

from __future__ import annotations

import os
import sys
import types
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm import textkit

KNOWN_PARTS = 500_000
PLAIN_LETTERS = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
_ASCII_LETTER = textkit.byte_class((0x61, 0x7A))
_STOP = textkit.byte_class((0x2C, 0x2C), (0x2E, 0x2E))
_SPACE = textkit.byte_class((0x20, 0x20), (0x0A, 0x0A))


def per_process(key, make):
    """What ``make()`` gives, made once per Python worker; only the last one is held."""
    held = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    if getattr(held, "key", None) != key:
        held.key, held.value = None, None
        held.value, held.key = make(), key
    return held.value


class PartTable:
    """Ids of parts seen so far, one run after the other."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.place, self.used = {}, 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        if n <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(len(array), n - len(array)), array.dtype)])

    def add(self, texts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, end = len(self.place), self.used + len(ids)
        self.ids = self._room(self.ids, end)
        self.starts, self.sizes = (self._room(x, n + len(texts)) for x in (self.starts, self.sizes))
        self.ids[self.used:end] = ids
        self.starts[n:n + len(texts)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + len(texts)] = sizes
        self.place.update(zip(texts, range(n, n + len(texts))))
        self.used = end

    def lookup(self, parts: pa.Array, encode_parts) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of the ids of each of the distinct parts, within ``ids``."""
        if len(self.place) > KNOWN_PARTS:
            self.clear()
        texts = parts.to_pylist()
        at = np.fromiter(map(self.place.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.place) + np.arange(len(new))
            unseen = [texts[i] for i in new.tolist()]
            self.add(unseen, *encode_parts(parts.take(pa.array(new)), unseen))
        return self.starts[at], self.sizes[at].astype(np.int64)


def gathered(table: PartTable, encode_parts, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, sizes)``: the ids of all rows one after the other, and how many each row has."""
    rows = len(bounds) - 1
    data = np.where(buf == 0x0A, np.uint8(0x20), buf)
    texts = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
    split = pc.split_pattern(texts, " ")
    parts = split.flatten().dictionary_encode()
    if not len(parts):
        return np.zeros(0, np.uint32), np.zeros(rows, np.int64)
    starts, sizes = table.lookup(parts.dictionary, encode_parts)
    code = parts.indices.to_numpy()
    starts, sizes = starts[code], sizes[code]
    ends = np.cumsum(sizes)
    ids = table.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]
    before = np.concatenate([[0], ends])
    edges = split.offsets.to_numpy()
    return ids, before[edges[1:]] - before[edges[:-1]]


class BpeEncoder:
    """The tokenizers library's BPE with word ends, lower case, white space dropped."""

    def __init__(self, path: str):
        # tasks run side by side already; the library's own threads would only hold more memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends_word = np.zeros(self.size, bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith("</w>")
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = PartTable()

    def _each(self, parts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _encode_parts(self, parts: pa.Array, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts of plain letters are one word each and go as one text; each ends at a word-end id."""
        plain = pc.match_substring_regex(parts, PLAIN_LETTERS).to_numpy(zero_copy_only=False)
        ids = np.array(self.tokenizer.encode_batch_fast(
            [" ".join(t for t, p in zip(texts, plain.tolist()) if p)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != plain.sum():
            plain, ids, ends = np.zeros(len(texts), bool), ids[:0], ends[:0]
        others = self._each([t for t, p in zip(texts, plain.tolist()) if not p])
        sizes = np.empty(len(texts), np.int64)
        sizes[plain] = np.diff(ends, prepend=0)
        sizes[~plain] = [len(o) for o in others]
        # the two kinds side by side, then in the order of the parts
        pool = np.concatenate([ids, np.fromiter(chain.from_iterable(others), np.uint32)])
        starts = np.empty(len(texts), np.int64)
        for kind, first in ((plain, 0), (~plain, len(ids))):
            starts[kind] = first + np.cumsum(sizes[kind]) - sizes[kind]
        before = np.cumsum(sizes) - sizes
        return pool[np.repeat(starts - before, sizes) + np.arange(len(pool))], sizes

    def encode(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of the rows of a slice, as the library encodes each whole text."""
        rows = len(bounds) - 1
        data = buf.tobytes()
        if any(s in data for s in self.specials):
            each = self._each([data[bounds[i]:bounds[i + 1]].decode() for i in range(rows)])
            return np.array([i for ids in each for i in ids], np.uint32), np.array([len(i) for i in each], np.int64)
        low = textkit.LOWER[buf]
        if any(s in low.tobytes() for s in self.specials):
            low = buf  # lower-casing would make a special token
        # a comma or full stop after a letter and before a space is a word of its own
        at = np.flatnonzero(_STOP[low])
        at = at[at > 0]
        last = np.zeros(len(low) + 1, bool)
        last[bounds] = True
        at = at[_ASCII_LETTER[low[at - 1]] & ~last[at]]
        after = np.append(low, np.uint8(0x20))[at + 1]
        at = at[_SPACE[after] | last[at + 1]]
        return gathered(self.table, self._encode_parts, np.insert(low, at, 0x20), bounds + np.searchsorted(at, bounds))


class PieceEncoder:
    """A sentencepiece vocabulary with byte fallback; parts are encoded as words of their own."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.table = PartTable()

    def _encode_parts(self, parts: pa.Array, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def encode(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gathered(self.table, self._encode_parts, buf, bounds)
