"""Line deduplication with DataFrame functions only.

Every document is split into lines; a line's key is trimmed and lower-cased, and only a 128 bit hash
of it travels.  Keys of enough characters that enough documents hold are joined back to the places
where they stand, the places are gathered per document, and the lines that stay are reassembled by
position.  Counting goes over (key, document) first and then over the key, so a line that a third of
all documents hold arrives as a few partial counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import free

BLANK = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Stripped of blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def drop_repeated_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, doc_id: str = "doc_id",
                        text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text's repeated lines gone, and ``n_lines, n_dropped``.

    A key of ``least_chars`` code points that ``least_docs`` documents hold loses all lines but those in the
    largest id that holds it.  Rows of one id are one document when counting; rows of equal id and
    text are treated alike.  Null ids count as one document, the smallest.  A null or empty text is one
    empty line.  Columns named ``n_lines`` or ``n_dropped`` are replaced; others may have any name.
    """
    docs = docs.drop("n_lines", "n_dropped")
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.struct(F.col(doc_id).alias("id")).alias("doc"), F.xxhash64(whole).alias("version"),
                        F.split(whole, "\n", -1).alias("lines"))
    hashes = F.transform("lines", lambda x: F.transform(
        F.array(line_key(x)), lambda k: F.when(F.char_length(k) >= least_chars, F.struct(
            F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k).alias("b"))))[0])
    places = keyed.select("doc", "version", F.posexplode(hashes).alias("place", "key")) \
        .filter(F.col("key").isNotNull())
    counted = places.groupBy("key", "doc").agg(F.lit(1).alias("one")).groupBy("key").agg(
        F.count("*").alias("docs"), F.max("doc").alias("keeper")).filter(F.col("docs") >= least_docs)
    gone = places.join(counted.select("key", "keeper"), "key").filter(~F.col("doc").eqNullSafe(F.col("keeper"))) \
        .groupBy("doc", "version").agg(F.collect_set("place").alias("gone"))
    doc, version, places_gone = (free(name, docs) for name in ("_doc", "_version", "gone"))
    out = docs.withColumns({doc: F.struct(F.col(doc_id).alias("id")), version: F.xxhash64(whole)}) \
        .join(gone.withColumnsRenamed({"doc": doc, "version": version, "gone": places_gone}), [doc, version], "left")
    lines = F.split(whole, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places_gone))
    kept = F.when(F.col(places_gone).isNull(), whole).otherwise(
        F.array_join(F.transform(F.array_sort(stay), lambda i: F.get(lines, i)), "\n"))
    return out.select(
        *[(kept if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(places_gone), F.lit(0)).cast("long").alias("n_dropped"))
