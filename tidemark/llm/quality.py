"""Quality rules: counts of words, symbols and repeats, and the fertility of a public tokenizer.

A public vocabulary with byte fallback is measured on every whole text: characters per token, share of
byte-fallback tokens, and the entropy of the tokens relative to the most that so many tokens can
have.  For each language and length class the middle and the spread of these measures over all
documents that pass the base rules give a band; a document outside its band is rejected.  Where such
a cell has few documents, the band of the language over all lengths holds, or else that of the whole
corpus.  The bands are wide, several spreads on either side, so ordinary documents stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import free, small_batches, written
from tidemark.llm.vocab import PieceEncoder

WINDOW = 8
SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
MEASURES = ("chars_per_token", "byte_share", "token_entropy")
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _between(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of flags per row."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are found twice or more in their row."""
    key = values ^ textkit.mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def base_counts(buf: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The rules' counts for each row of a slice."""
    rows = len(bounds) - 1
    starts, ends, first = textkit.words(buf, bounds, textkit.SPACED)
    hashes = textkit.word_hashes(buf, starts, ends)
    n_words = np.diff(first)
    word_chars = _between(textkit.SPACED[buf] & ((buf & 0xC0) != 0x80), bounds)
    # lines: cut at line feeds and row ends
    feeds = np.flatnonzero(buf == 0x0A)
    low = np.concatenate([bounds[:-1], feeds + 1])
    high = np.concatenate([bounds[1:], feeds])
    low.sort()
    high.sort()
    worded = np.searchsorted(starts, high) > np.searchsorted(starts, low)
    low, high = low[worded], high[worded]
    line_row = np.searchsorted(bounds, low, "right") - 1
    line = textkit.word_hashes(buf, low, high)
    key = line ^ textkit.mix(line_row.astype(np.uint64) + np.uint64(1))
    _, earliest = np.unique(key, return_index=True)
    dup = np.ones(len(key), bool)
    dup[earliest] = False
    # words inside windows found twice or more
    g = textkit.grams(hashes, WINDOW)
    row, ok = textkit.gram_rows(first, WINDOW, len(g))
    at = np.flatnonzero(ok)
    twice = at[_repeated(row[ok], g[ok])]
    change = np.zeros(len(hashes) + 1, np.int64)
    change[twice] += 1
    change[twice + WINDOW] -= 1
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": _between(SYMBOLS[buf], bounds),
            "n_dup_lines": np.bincount(line_row[dup], minlength=rows),
            "n_repeat_words": _between(np.cumsum(change[:-1]) > 0, first)}


def token_measures(encoder, buf, bounds, chars: np.ndarray) -> dict[str, np.ndarray]:
    """Fertility of each row; NaN without tokens."""
    rows = len(bounds) - 1
    ids, sizes = encoder.encode(buf, bounds)
    row = np.repeat(np.arange(rows, dtype=np.uint64), sizes)
    key = np.sort((row << np.uint64(32)) | ids.astype(np.uint64))
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(edge, len(key)))
    of = (key[edge] >> np.uint64(32)).astype(np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = counts / sizes[of]
        entropy = np.bincount(of, weights=-p * np.log2(p), minlength=rows)
        most = np.log2(np.minimum(sizes, encoder.size))
        ends = np.cumsum(sizes)
        return {"chars_per_token": chars / np.where(sizes, sizes, np.nan),
                "byte_share": _between(encoder.fallback[ids], np.concatenate([[0], ends])) / np.where(
                    sizes, sizes, np.nan),
                "token_entropy": np.where(sizes > 1, entropy / np.where(sizes > 1, most, 1), np.nan)}


def measured(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the counts, ``chars_per_token``, ``byte_share`` and ``token_entropy``.

    Columns of these names are replaced.  A null text has no words.
    """
    docs = small_batches(docs).drop(*_COUNTS, *MEASURES)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or PieceEncoder(vocabulary)
            for low, rows, buf, bounds in textkit.slices(batch.column(at)):
                counts = base_counts(buf, bounds)
                more = token_measures(encoder, buf, bounds, counts["word_chars"])
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(low, rows) for c in batch.columns),
                     *(pa.array(counts[c].astype(np.int64)) for c in _COUNTS),
                     *(pa.array(more[c].astype(float), from_pandas=True) for c in MEASURES)],
                    names=[*names, *_COUNTS, *MEASURES])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    fields += [f"{c} long" for c in _COUNTS] + [f"{c} double" for c in MEASURES]
    return docs.mapInArrow(run, ", ".join(fields))


def base_failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _length_class():
    """Doublings of the number of words; measures of longer texts spread less."""
    return F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)))).cast("int")


def bands(measures: DataFrame, lang: str = "lang", reach: float = 5.0, entropy_reach: float = 4.0,
          least_docs: int = 30) -> DataFrame:
    """The limits of the measures, ``_band``, per ``_level``: 0 a language (null is one) and length class,
    1 a language, 3 the whole corpus.

    Every document that passes the base rules counts.  The limits lie ``reach`` spreads (from the
    quartiles) from the median, and at least some share of the median.  ``least_docs`` documents
    make a band of a cell or a language; the corpus has one however small it is.  Shares of tokens of
    short texts spread more, so over all lengths the spreads widen for texts of fewer words than the median.
    """
    spread = [F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(c) for c in MEASURES]
    q = measures.filter(~base_failed()) \
        .select(F.col(lang).alias("_lang"), _length_class().alias("_class"), "n_words", *MEASURES) \
        .rollup("_lang", "_class").agg(F.grouping_id().cast("int").alias("_level"), F.count("*").alias("_docs"),
                                       F.percentile_approx("n_words", 0.5, 10000).alias("_words"), *spread) \
        .filter((F.col("_docs") >= least_docs) | (F.col("_level") == 3))

    def sigma(c):
        return (F.col(c)[2] - F.col(c)[0]) / 1.349

    chars, bytes_, entropy = MEASURES
    return q.select("_level", "_lang", "_class", F.struct(
        F.when(F.col("_level") > 0, F.col("_words")).alias("words"),
        F.col(chars)[1].alias("chars"), (reach * sigma(chars)).alias("chars_off"),
        F.col(bytes_)[1].alias("bytes"), (reach * sigma(bytes_)).alias("bytes_off"),
        (F.col(entropy)[1] - F.greatest(entropy_reach * sigma(entropy), 0.02 * F.col(entropy)[1])).alias("least_entropy"),
    ).alias("_band"))


def judged(measures: DataFrame, lang: str = "lang", **options) -> DataFrame:
    """Add ``base_failed`` and ``kept``; ``measures`` is read twice, so it should be written first.

    A measure that is null (a single token) does not reject.  Columns named ``base_failed`` or ``kept`` are
    replaced; others may have any name.
    """
    measures = measures.drop("base_failed", "kept")
    # one row for each language and doubling of length, one for each language, and one
    limits = written(bands(measures, lang, **options), "bands")
    own = {c: free(c, measures) for c in ("_lang", "_class", "_cell_band", "_lang_of", "_lang_band", "_whole_band", "_band")}
    cells = limits.filter("_level = 0").select(F.col("_lang").alias(own["_lang"]), F.col("_class").alias(own["_class"]),
                                               F.col("_band").alias(own["_cell_band"]))
    langs = limits.filter("_level = 1").select(F.col("_lang").alias(own["_lang_of"]),
                                               F.col("_band").alias(own["_lang_band"]))
    whole = limits.filter("_level = 3").select(F.col("_band").alias(own["_whole_band"]))
    band = {c: F.col(own["_band"])[c] for c in ("words", "chars", "chars_off", "bytes", "bytes_off", "least_entropy")}
    wide = F.coalesce(F.greatest(F.lit(1.0), F.sqrt(band["words"] / F.greatest("n_words", F.lit(1)))), F.lit(1.0))
    inside = (F.col("chars_per_token").between(
        band["chars"] - F.greatest(band["chars_off"] * wide, 0.02 * band["chars"]),
        band["chars"] + F.greatest(4 * band["chars_off"] * wide, 0.5 * band["chars"]))
        & (F.col("byte_share") <= band["bytes"] + F.greatest(band["bytes_off"] * wide, band["bytes"], F.lit(0.1)))
        & (F.col("token_entropy") >= band["least_entropy"]))
    # Spark broadcasts the bands while they are small; with as many labels as a corpus of dirty ones has, it shuffles
    return measures.join(cells, measures[lang].eqNullSafe(cells[own["_lang"]])
                         & (_length_class() == cells[own["_class"]]), "left") \
        .join(langs, measures[lang].eqNullSafe(langs[own["_lang_of"]]), "left") \
        .join(F.broadcast(whole), F.lit(True), "left") \
        .withColumn(own["_band"], F.coalesce(own["_cell_band"], own["_lang_band"], own["_whole_band"])) \
        .withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))) \
        .drop(*own.values())


def quality(docs: DataFrame, vocabulary: str, text: str = "text", lang: str = "lang", keep_text: bool = True,
            **options) -> DataFrame:
    """All columns of ``docs`` (``keep_text``: the text too), the counts and measures, ``base_failed`` and ``kept``."""
    measures = measured(docs, vocabulary, text)
    return judged(written(measures if keep_text else measures.drop(text), "quality"), lang, **options)
