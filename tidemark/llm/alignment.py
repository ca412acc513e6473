"""Two tokenizers side by side: which tokens of one end where tokens of the other end.

Texts are grouped by their whole text first, so every distinct text is tokenized and aligned once,
however many documents hold it; its pair counts weigh as many times, and its measures are joined
to the ids of all its documents by a 256 bit digest.

Inside a task a text is cut before spaces and line feeds that follow a visible character.  Neither
vocabulary has a token across such a place (this is checked when the vocabularies are loaded; else
texts stay whole), so tokens end there on both sides and each part is aligned by itself.  Distinct
parts of a batch are looked up in a table of parts seen before; only new ones go to the libraries.

Tokens that end together have bytes of which one is the end of the other.  So the vocabularies alone
bound the number of pairs that can ever be linked, by the letters of all tokens, whatever the corpus.
These pairs are listed once (``PairList``) and numbered; counts are an array of that size, which may
go to the driver and to all tasks.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import small_batches, written
from tidemark.llm.vocab import per_process

KNOWN_PARTS = 400_000
SLICE_BYTES = 4 << 20
BLOCK_PARTS = 400_000   # parts whose groups are spelled out at once
COUNTED = 1 << 21       # links counted at once

_GAP = textkit.byte_class((0x20, 0x20), (0x0A, 0x0A))
_VISIBLE = textkit.byte_class((0x21, 0x7E))
_TAIL = textkit.byte_class((0x80, 0xBF))
_TWO_BYTES = textkit.byte_class((0xC3, 0xDF))   # leads of two-byte characters beyond the controls and U+00A0


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _unicode_to_byte() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    return table | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


class Spelling:
    """Bytes of every id of a vocabulary, and its ids as decimal digits."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)
        digits = [str(i).encode() for i in range(len(tokens))]
        self.width = len(digits[-1]) + 1
        self.n_digits = np.fromiter(map(len, digits), np.int64, len(digits))
        self.digits = np.frombuffer(b"".join(d.ljust(self.width, b"\0") for d in digits), np.uint8).reshape(
            len(tokens), self.width)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[ranges(self.starts[ids], self.sizes[ids])]


def byte_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary of the tokenizers library."""
    from tokenizers import Tokenizer

    table = _unicode_to_byte()
    tokenizer = Tokenizer.from_file(path)
    special = set(tokenizer.get_added_tokens_decoder())
    vocabulary = tokenizer.get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = token.encode() if i in special or any(c not in table for c in token) \
            else bytes(table[c] for c in token)
    return out


def piece_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a sentencepiece vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]


class PairList:
    """All pairs of ids whose tokens can end together, in order."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        of_a, of_b = defaultdict(list), defaultdict(list)
        for tokens, of in ((a, of_a), (b, of_b)):
            for i, t in enumerate(tokens):
                if t:
                    of[t].append(i)
        keys = []
        for t, ids in of_a.items():
            for cut in range(len(t)):
                for j in of_b.get(t[cut:], ()):
                    keys += [i * len(b) + j for i in ids]
        for t, ids in of_b.items():
            for cut in range(1, len(t)):
                for i in of_a.get(t[cut:], ()):
                    keys += [i * len(b) + j for j in ids]
        self.keys, self.width = np.unique(np.array(keys, np.int64)), len(b)

    def b_ids(self) -> np.ndarray:
        return self.keys % self.width


class Encoders:
    """Both libraries, and the table of parts seen so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks run side by side already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.spell_a, self.spell_b = Spelling(byte_tokens(path_a)), Spelling(piece_tokens(path_b))
        kind = json.loads(self.a.to_str())
        before = kind.get("pre_tokenizer") or {}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.prefix = self.b.piece_to_id("▁")
        self.cuts = (kind.get("normalizer") is None and before.get("type") == "ByteLevel"
                     and before.get("use_regex", True) and not before.get("add_prefix_space")
                     and not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
                     and self.b.encode("\nx")[:1] == [self.prefix])
        self.clear()

    def clear(self):
        self.place = {}
        self.numbers = np.zeros((4, 1 << 14), np.int64)   # tokens of A, of B, groups, and 1 if no alignment exists
        self.runs = {"links": [0, np.zeros(1 << 16, np.int32)], "text": [0, np.zeros(1 << 18, np.uint8)]}
        self.starts = {k: np.zeros(1 << 14, np.int64) for k in self.runs}
        self.sizes = {k: np.zeros(1 << 14, np.int64) for k in self.runs}

    def parts(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(bytes, bounds of parts, first part of each row)``; a space goes before every row."""
        data = np.insert(buf, bounds[:-1], 0x20)
        rows = bounds + np.arange(len(bounds))
        cut = np.zeros(len(data) + 1, bool)
        if self.cuts and len(data) > 2:
            after = _VISIBLE[data[:-1]]
            after[1:] |= _TAIL[data[1:-1]] & _TWO_BYTES[data[:-2]]
            cut[1:-1] = _GAP[data[1:]] & after
        cut[rows] = True
        places = np.flatnonzero(cut)
        return data, places, np.searchsorted(places, rows)

    def _ids_a(self, texts: list[str], data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts; parts that end visibly go as one text, whose tokens never cross parts."""
        ends = np.cumsum(sizes)
        plain = _VISIBLE[data[ends - 1]] | _TAIL[data[ends - 1]] & _TWO_BYTES[data[ends - 2]] & (sizes > 1)
        plain &= self.cuts
        flags = plain.tolist()
        joined = np.array(self.a.encode("".join(t for t, p in zip(texts, flags) if p), add_special_tokens=False).ids,
                          np.int64)
        ends = np.cumsum(self.spell_a.sizes[joined])
        at = np.searchsorted(ends, np.cumsum(sizes[plain]))
        if len(at) and (at[-1] != len(joined) - 1 or (ends[at] != np.cumsum(sizes[plain])).any()):
            raise ValueError("a token lies across two parts")  # cannot be: parts are words of the vocabulary's pattern
        others = [e.ids for e in self.a.encode_batch_fast([t for t, p in zip(texts, flags) if not p],
                                                          add_special_tokens=False)]
        number = np.empty(len(texts), np.int64)
        number[plain] = np.diff(at + 1, prepend=0)
        number[~plain] = [len(o) for o in others]
        pool = np.concatenate([joined, np.fromiter(chain.from_iterable(others), np.int64)])
        starts = np.empty(len(texts), np.int64)
        for kind, first in ((plain, 0), (~plain, len(joined))):
            starts[kind] = first + np.cumsum(number[kind]) - number[kind]
        return pool[ranges(starts, number)], number

    def _ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts; the library's own leading space stands for a part's first one."""
        found = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for i, t in enumerate(texts):
            if t[0] != " ":
                found[i] = found[i][1:]
            elif len(t) == 1:
                found[i] = [self.prefix]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes

    def _add(self, texts: list[str], pairs: np.ndarray, width: int) -> None:
        """Encode and align new parts."""
        raw = [t.encode() for t in texts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        a, n_a = self._ids_a(texts, data, sizes)
        b, n_b = self._ids_b(texts)
        part_a, part_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        good = np.ones(len(texts), bool)
        for ids, part, spell in ((a, part_a, self.spell_a), (b, part_b, self.spell_b)):
            good &= np.bincount(part, spell.sizes[ids], len(texts)).astype(np.int64) == sizes
        for ids, part, spell in ((a, part_a, self.spell_a), (b, part_b, self.spell_b)):
            same = spell.bytes_of(ids[good[part]]) == data[np.repeat(good, sizes)]
            where = np.repeat(np.arange(len(texts)), np.where(good, sizes, 0))
            good[where[~same]] = False
        a, part_a, b, part_b = a[good[part_a]], part_a[good[part_a]], b[good[part_b]], part_b[good[part_b]]
        end_a, end_b = np.cumsum(self.spell_a.sizes[a]), np.cumsum(self.spell_b.sizes[b])
        total = int(end_a[-1]) if len(end_a) else 0
        both = np.zeros(total + 1, bool)
        both[end_a] = True
        mark = np.zeros(total + 1, bool)
        mark[end_b] = True
        both &= mark
        last_a, last_b = both[end_a], both[end_b]
        keys = a[last_a] * width + b[last_b]
        links = np.searchsorted(pairs, keys)
        if len(keys) and (links.max() >= len(pairs) or (pairs[links] != keys).any()):
            raise ValueError("linked tokens of which none is the end of the other")
        groups = np.bincount(part_a[last_a], minlength=len(texts))
        text, text_sizes = self._spelled(a, b, end_a, end_b, both, part_a, part_b, len(texts))
        n = len(self.place)
        self.place.update(zip(texts, range(n, n + len(texts))))
        self.numbers = self._room(self.numbers, n + len(texts))
        self.numbers[:, n:n + len(texts)] = np.where(good, n_a, 0), np.where(good, n_b, 0), groups, ~good
        for name, values, number in (("links", links, groups), ("text", text, text_sizes)):
            used, pool = self.runs[name]
            pool = self._room(pool, used + len(values))
            pool[used:used + len(values)] = values
            self.runs[name] = [used + len(values), pool]
            for held, new in ((self.starts, used + np.cumsum(number) - number), (self.sizes, number)):
                held[name] = self._room(held[name], n + len(texts))
                held[name][n:n + len(texts)] = new

    def _spelled(self, a, b, end_a, end_b, both, part_a, part_b, n):
        """``a1,a2|b1;`` for each group, part after part, and the bytes of each part."""
        before = np.cumsum(both)
        group_a, group_b = before[end_a - 1], before[end_b - 1]
        groups = int(before[-1]) if len(before) else 0
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        upto_b = np.cumsum(np.bincount(group_b, minlength=groups))
        place_a = np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b] if groups else np.zeros(0, np.int64)
        width = max(self.spell_a.width, self.spell_b.width)
        rows, sizes = np.zeros((len(a) + len(b), width), np.uint8), np.zeros(len(a) + len(b), np.int64)
        for ids, place, last, spell, end in ((a, place_a, both[end_a], self.spell_a, ord("|")),
                                             (b, place_b, both[end_b], self.spell_b, ord(";"))):
            rows[place, :spell.width] = spell.digits[ids]
            sizes[place] = spell.n_digits[ids]
            rows[place, spell.n_digits[ids]] = np.where(last, end, ord(","))
        part = np.empty(len(rows), np.int64)
        part[place_a], part[place_b] = part_a, part_b
        return rows[np.arange(width) <= sizes[:, None]], np.bincount(part, sizes + 1, n).astype(np.int64)

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        have = array.shape[-1]
        if n <= have:
            return array
        more = np.zeros((*array.shape[:-1], max(have, n - have)), array.dtype)
        return np.concatenate([array, more], axis=-1)

    def lookup(self, parts: list[str], pairs: np.ndarray, width: int) -> np.ndarray:
        """Places of the distinct parts in the table."""
        if len(self.place) > KNOWN_PARTS:
            self.clear()
        at = np.fromiter(map(self.place.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.place) + np.arange(len(new))
            self._add([parts[i] for i in new.tolist()], pairs, width)
        return at

    def align(self, buf: np.ndarray, bounds: np.ndarray, pairs: np.ndarray, width: int):
        """``(numbers, digests, links, n_links)`` of the rows; rows without alignment have zeros and ''."""
        data, places, first = self.parts(buf, bounds)
        texts = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int64)),
                                                 pa.py_buffer(data)).dictionary_encode()
        at = self.lookup(texts.dictionary.to_pylist(), pairs, width)[texts.indices.to_numpy()]
        sums = np.zeros((4, len(at) + 1), np.int64)
        np.cumsum(self.numbers[:, at], axis=1, out=sums[:, 1:])
        numbers = sums[:, first[1:]] - sums[:, first[:-1]]
        good = numbers[3] == 0
        numbers[:, ~good] = 0
        rows = len(bounds) - 1
        at[np.repeat(~good, np.diff(first))] = -1
        digests, hashes, links, row = [""] * rows, None, [], 0
        for low in range(0, len(at), BLOCK_PARTS):
            high = min(len(at), low + BLOCK_PARTS)
            here = at[low:high]
            known = here >= 0
            link_sizes = np.where(known, self.sizes["links"][here], 0)
            links.append(self.runs["links"][1][ranges(self.starts["links"][here], link_sizes)])
            sizes = np.where(known, self.sizes["text"][here], 0)
            text = memoryview(self.runs["text"][1][ranges(self.starts["text"][here], sizes)])
            edge = np.concatenate([[0], np.cumsum(sizes)])
            while row < rows and first[row] < high:
                start, end = max(low, first[row]), min(high, first[row + 1])
                whole = first[row + 1] <= high
                if good[row]:
                    hashes = hashes or hashlib.sha256()
                    hashes.update(text[edge[start - low]:edge[end - low] - (1 if whole else 0)])
                    if whole:
                        digests[row], hashes = hashes.hexdigest(), None
                if not whole:
                    break
                row += 1
        return numbers, digests, np.concatenate(links) if links else np.zeros(0, np.int32), numbers[2]


def aligned(texts: DataFrame, path_a: str, path_b: str, pairs: PairList) -> DataFrame:
    """Each row of ``digest, times, text`` with its numbers and its links (compressed numbers of pairs)."""
    held = texts.sparkSession.sparkContext.broadcast(pairs.keys)
    width = pairs.width

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tools = per_process(("align", path_a, path_b), lambda: Encoders(path_a, path_b))
            for at, rows, buf, bounds in textkit.slices(textkit.column(batch, "text"), SLICE_BYTES):
                numbers, digests, links, sizes = tools.align(buf, bounds, held.value, width)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                packed = [pa.compress(links[i:j].tobytes(), "zstd", asbytes=True) if j > i else b""
                          for i, j in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [textkit.column(batch, "digest").slice(at, rows), textkit.column(batch, "times").slice(at, rows),
                     *[pa.array(x, pa.int64()) for x in numbers[:3]], pa.array(sizes, pa.int64()),
                     pa.array(digests), pa.array(packed, pa.binary())],
                    names=["digest", "times", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    return texts.mapInArrow(run, "digest binary, times long, n_a long, n_b long, n_groups long, n_links long, "
                                 "groups_sha256 string, links binary")


def _links(packed: list, sizes: list[int]) -> np.ndarray:
    return np.concatenate([np.frombuffer(pa.decompress(x, 4 * n, "zstd", asbytes=True), np.int32) if n
                           else np.zeros(0, np.int32) for x, n in zip(packed, sizes)] or [np.zeros(0, np.int32)])


def pair_counts(texts: DataFrame, size: int) -> DataFrame:
    """``pair, n``: how many links of all documents hold each pair; a text counts as often as it occurs."""
    def run(batches):
        total, held, weights, waiting = np.zeros(size, np.int64), [], [], 0

        def add():
            # the weights of one block stay far below 2**53, so their sums are exact
            total[:] += np.bincount(np.concatenate(held), np.concatenate(weights), size).astype(np.int64)

        for batch in batches:
            times, sizes, packed = (textkit.column(batch, c) for c in ("times", "n_links", "links"))
            held.append(_links(packed.to_pylist(), sizes.to_pylist()))
            weights.append(np.repeat(times.to_numpy(), sizes.to_numpy()))
            waiting += len(held[-1])
            if waiting > COUNTED:
                add()
                held, weights, waiting = [], [], 0
        if held:
            add()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())],
                                         names=["pair", "n"])

    return texts.select("times", "n_links", "links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n"))


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row the measures of its alignment: the id, ``n_a``, ``n_b`` (tokens), ``n_groups``
    (spans between places where tokens of both end), ``n_links`` (token pairs that end together),
    ``n_best`` (links whose pair is the most frequent one of its B id, ties included), ``count_sum``
    (sum of the links' counts over the corpus) and ``groups_sha256`` of ``a1,a2|b1;a3|b2,b3``.

    A is a byte-level vocabulary of the tokenizers library and reads a space and the text; B is a
    sentencepiece vocabulary, which adds the space itself.  Null and empty texts, and texts that a
    vocabulary does not spell back byte for byte, have zeros and ''.  Repeated rows and rows without
    id are rows of their own.  Only the two named columns are read, so other columns may have any name.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    given = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    pairs = PairList(byte_tokens(path_a), piece_tokens(path_b))
    # shuffled by the whole text, with partial counts: a text that many documents hold is a row per task
    distinct = given.filter("text <> ''").groupBy("text").agg(F.count("*").alias("times")).select(
        F.unhex(F.sha2("text", 256)).alias("digest"), "times", "text")
    texts = written(aligned(distinct, path_a, path_b, pairs), "aligned")
    counted = pair_counts(texts, len(pairs.keys)).toArrow()  # at most as many rows as the list of pairs
    counts = np.zeros(len(pairs.keys), np.int64)
    counts[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    highest = np.zeros(pairs.width, np.int64)
    np.maximum.at(highest, pairs.b_ids(), counts)
    best = counts == highest[pairs.b_ids()]
    held = spark.sparkContext.broadcast((counts, best))

    def measure(batches):
        counts, best = held.value
        for batch in batches:
            sizes = textkit.column(batch, "n_links")
            links = _links(textkit.column(batch, "links").to_pylist(), sizes.to_pylist())
            edges = np.concatenate([[0], np.cumsum(sizes.to_numpy())])
            out = []
            for values in (best[links], counts[links]):
                sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                out.append(pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64()))
            names = ["digest", "n_a", "n_b", "n_groups", "n_links"]
            yield pa.RecordBatch.from_arrays(
                [*[textkit.column(batch, c) for c in names], *out, textkit.column(batch, "groups_sha256")],
                names=[*names, "n_best", "count_sum", "groups_sha256"])

    measures = texts.mapInArrow(measure, "digest binary, n_a long, n_b long, n_groups long, n_links long, "
                                         "n_best long, count_sum long, groups_sha256 string")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return given.select("id", F.unhex(F.sha2("text", 256)).alias("digest")).join(measures, "digest", "left").select(
        F.col("id").alias(doc_id), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
