"""Language identification by nearest centroid.

A text becomes the counts of its byte bigrams and trigrams (lower-cased, letters only, a run of
anything else is one space), hashed into ``DIMS`` places, damped by a logarithm, weighted by
inverse document frequency and normalised.  Every language has several centroids, made by
spherical k-means; a text gets the language of the centroid with the largest cosine.  Each
centroid has a rejection distance from the spread of its own members, beyond which the language is
"unknown".

Document frequencies cover all training documents.  The clusters are fitted on at most
``sample`` documents per language, chosen by hash; everything else sees all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textkit
from tidemark.llm.scratch import free, small_batches

DIMS = 4096
ROWS_AT_ONCE = 64

# ASCII letters and all bytes of other characters stay, the rest becomes a space
_KEEP = np.where(textkit.byte_class((0x61, 0x7A), (0x80, 0xFF)), np.arange(256), 0x20).astype(np.uint8)


@dataclass
class Model:
    languages: list[str]
    owner: np.ndarray        # language number of each centroid
    centroids: np.ndarray    # (centroids, DIMS), unit length
    least: np.ndarray        # smallest cosine that is not rejected, per centroid
    idf: np.ndarray


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def count_rows(texts: pa.Array):
    """``(first row, counts)`` with counts of shape (rows, DIMS), for a bounded number of rows at once."""
    lowered = pc.utf8_lower(pc.fill_null(texts, ""))
    for at in range(0, len(lowered), ROWS_AT_ONCE):
        part = lowered.slice(at, ROWS_AT_ONCE)
        counts = np.zeros((len(part), DIMS), np.float32)
        for first, rows, buf, bounds in textkit.slices(part):
            buf = _KEEP[buf]
            # one space between letters, and at both ends of each row
            rownum = np.repeat(np.arange(rows), np.diff(bounds))
            space = buf == 0x20
            keep = np.ones(len(buf), bool)
            keep[1:] = ~(space[1:] & space[:-1])
            buf, rownum = buf[keep].astype(np.uint32), rownum[keep]
            if len(buf) < 3:
                continue
            two = (buf[:-1] << 8) | buf[1:]
            three = (two[:-1] << 8) | buf[2:]
            for gram, size in ((two, 2), (three, 3)):
                n = len(gram)
                same = rownum[:n] == rownum[size - 1:]
                place = ((gram * np.uint32(2654435761) + np.uint32(size * 40503)) >> np.uint32(20)) % DIMS
                flat = rownum[:n][same] * DIMS + place[same]
                counts[first:first + rows] += np.bincount(flat, minlength=rows * DIMS).reshape(rows, DIMS)
        yield at, counts


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(counts) * idf
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means with farthest-first seeds; the centroids and each row's cosine to its own."""
    seeds = [x.mean(axis=0)]
    best = x @ seeds[0]
    for _ in range(min(k, len(x)) - 1):
        seeds.append(x[int(best.argmin())])
        best = np.maximum(best, x @ seeds[-1])
    c = np.array(seeds, np.float32)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        near = (x @ c.T).argmax(axis=1)
        c = np.array([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))], np.float32)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    cos = x @ c.T
    return c, cos


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", clusters: int = 4,
        sample: int = 600, reject: float = 3.0) -> Model:
    """Learn from the rows of ``train`` with a language and a letter.

    ``sample`` bounds the rows per language that the clusters see (about; the rows with the smallest
    hash of the key).  ``reject`` is the distance beyond which a text is rejected, in standard deviations
    of a cluster's own distances.
    """
    rows = small_batches(train).filter(F.col(lang).isNotNull() & has_letter(F.col(text))).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
        F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 11).alias("draw"))

    def frequencies(batches):
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for _, counts in count_rows(textkit.column(batch, "text")):
                total += (counts > 0).sum(axis=0)
                n += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(DIMS)], pa.int32()),
                                          pa.array([n, *total.tolist()], pa.int64())], names=["dim", "n"])

    # DIMS + 1 rows, whatever the number of documents
    table = rows.select("text").mapInArrow(frequencies, "dim int, n long").groupBy("dim").agg(
        F.sum("n").alias("n")).toArrow()
    found = dict(zip(table["dim"].to_pylist(), table["n"].to_pylist()))
    idf = np.log((1 + found.get(-1, 0)) / (1 + np.array([found.get(i, 0) for i in range(DIMS)]))) + 0.1
    idf = idf.astype(np.float32)
    per_lang = rows.groupBy("lang").agg(F.count("*").alias("rows_of"))
    chosen = rows.join(F.broadcast(per_lang), "lang").filter(
        F.col("draw") < F.lit(float(1 << 53)) * sample / F.col("rows_of")).select("lang", "text")

    def clustered(batch: pa.Table) -> pa.Table:
        x = np.concatenate([vectors(counts, idf) for _, counts in count_rows(batch["text"].combine_chunks())])
        c, cos = _kmeans(x, clusters)
        near, own = cos.argmax(axis=1), cos.max(axis=1)
        least = [float(own[near == i].mean() - reject * own[near == i].std()) if (near == i).sum() > 1
                 else 0.0 for i in range(len(c))]
        return pa.table({"lang": [batch["lang"][0].as_py()] * len(c),
                         "centroid": pa.array([v.astype(np.float32).tobytes() for v in c], pa.binary()),
                         "least": least})

    got = chosen.groupBy("lang").applyInArrow(clustered, "lang string, centroid binary, least double").collect()
    got = sorted(got, key=lambda r: (r["lang"], bytes(r["centroid"])))
    languages = sorted({r["lang"] for r in got})
    return Model(languages, np.array([languages.index(r["lang"]) for r in got], np.int64),
                 np.array([np.frombuffer(r["centroid"], np.float32) for r in got], np.float32).reshape(-1, DIMS),
                 np.array([r["least"] for r in got]), idf)


def predict(docs: DataFrame, model: Model, text: str = "text", none: str = "und") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred, score, rejected``, which replace columns of these names.

    ``lang_pred`` is the nearest language, ``score`` the cosine (0 to 1), ``rejected`` whether the distance is
    beyond the centroid's limit.  A null text, a text without a letter, and every text of a model that
    learned nothing get ``none`` and score 0.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    given = small_batches(docs).withColumn(free("_letter", docs), has_letter(F.col(text)))
    names = [f.name for f in given.schema.fields]
    at = names.index(text)
    held = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: executors need no installed package

    def run(batches):
        m = Model(**held.value)
        for batch in batches:
            letters = batch.column(len(names) - 1).to_numpy(zero_copy_only=False)
            best = np.zeros(batch.num_rows, np.int64)
            score = np.zeros(batch.num_rows)
            ok = letters & bool(len(m.centroids))
            if ok.any():
                for first, counts in count_rows(batch.column(at)):
                    cos = vectors(counts, m.idf) @ m.centroids.T
                    best[first:first + len(cos)] = cos.argmax(axis=1)
                    score[first:first + len(cos)] = np.clip(cos.max(axis=1), 0, 1)
            lang = [m.languages[m.owner[b]] if o else none for b, o in zip(best, ok)]
            rejected = ok & (score < (m.least[best] if len(m.least) else 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(np.where(ok, score, 0.0)),
                 pa.array(rejected)],
                names=[*names[:-1], "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return given.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
