"""Groups of spelling variants: words one edit apart, found by PartEnum signatures.

A word's letters are a multiset, that is a binary vector over (letter, how-manieth).  One inserted or
deleted letter changes the vector in one place, one replaced letter in two, so words one edit apart
have a Hamming distance of at most two.  The letters of the alphabet are dealt into ``PARTS`` classes of
about equal weight, as counted over the words, which cuts every vector into as many parts.

* Words of lengths l and l + 1 differ in one class at most: the parts without one class are a
  signature, ``PARTS`` of them for a word as the shorter one, and as many as the longer one.
* Words of equal length differ in two classes at most: the parts without two classes, for all pairs
  of classes.

Signatures hold the lengths of the pair they stand for, so an equi-join on them gives all pairs that
are one edit apart, and others; Spark's bounded edit distance decides.  Signatures are hashes of 64 bit:
a collision adds a candidate and loses nothing.

A word's form is its most frequent neighbour if that is at least twice as frequent.  Frequencies at least
double from word to form, so forms make a forest; roots are found by doubling the steps.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

RUN = "([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = 7
SLIPS = 97


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, run``: every maximal run of letters of every text, A to Z in lower case."""
    found = F.regexp_extract_all(F.translate(F.col(text).cast("string"), UPPER, LOWER), F.lit(RUN), F.lit(1))
    return docs.select(F.col(doc_id).cast("string").alias("id"), F.explode(found).alias("run"))


def slipped(run: Column, id_: Column, slips: int = SLIPS) -> Column:
    """The run, with one letter left out if ``slips`` divides the checksum of id and run; never without an id."""
    h = F.crc32(F.concat(id_, F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % slips == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
                  ).otherwise(run)


def counted(words: DataFrame, least_length: int = 5, least: int = 3) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough; partial counts go into the shuffle."""
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(
        F.col("n") >= least)


def letter_classes(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters that occur, dealt into classes of about equal weight; one row per letter reaches the driver.

    Only the letters of one alphabet block can occur, so that is a few dozen rows for any corpus.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(
        F.count("*").alias("n")).collect()
    classes, weights = [""] * parts, [0] * parts
    for r in sorted(letters, key=lambda r: (-r["n"], r["letter"])):
        lightest = min(range(parts), key=lambda i: (weights[i], i))
        classes[lightest] += r["letter"]
        weights[lightest] += r["n"]
    return classes


def signatures(words: DataFrame, classes: list[str]) -> DataFrame:
    """``word, n, role, key``: role 0 pairs words of one length, 1 is the shorter and 2 the longer of two lengths."""
    alphabet = "".join(classes)
    ordered = words.select("word", "n", F.length("word").alias("size"),
                           F.array_join(F.array_sort(F.split("word", "")), "").alias("letters"))
    for i, letters in enumerate(classes):  # the letters of one class, the others taken away
        others = "".join(c for c in alphabet if c not in letters)
        ordered = ordered.withColumn(f"part{i}", F.translate("letters", others, "") if others else F.col("letters"))

    def key(role: int, shorter: Column, left_out: tuple[int, ...]) -> Column:
        kept = [F.col(f"part{i}") for i in range(len(classes)) if i not in left_out]
        return F.struct(F.lit(role).alias("role"), F.xxhash64(
            F.lit(min(role, 1)), shorter, F.lit(sum(1 << i for i in left_out)), *kept).alias("key"))

    size = F.col("size")
    entries = [key(0, size, two) for two in combinations(range(len(classes)), 2)]
    for one in range(len(classes)):
        entries += [key(1, size, (one,)), key(2, size - 1, (one,))]
    return ordered.select("word", F.explode(F.array(*entries)).alias("e")).select("word", "e.role", "e.key")


def near_pairs(words: DataFrame, classes: list[str], held: Scratch) -> DataFrame:
    """``a, b``: all pairs of words that one inserted, deleted or replaced letter turns into each other, once."""
    entries = held.written(signatures(words, classes), "signatures")
    x, y = entries.alias("x"), entries.alias("y")
    one_edit = F.levenshtein("x.word", "y.word", 1) == 1
    same_length = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.role") == 0) & (F.col("y.role") == 0)
                         & (F.col("x.word") < F.col("y.word")) & one_edit)
    lengths = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.role") == 1) & (F.col("y.role") == 2) & one_edit)
    pair = [F.col("x.word").alias("a"), F.col("y.word").alias("b")]
    out = held.written(same_length.select(*pair).union(lengths.select(*pair)).distinct(), "pairs")
    held.drop("signatures")
    return out


def roots(forms: DataFrame, held: Scratch) -> DataFrame:
    """``word, root`` of ``word, form``: the word reached when forms are followed to the last; steps double."""
    now, step = held.written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots-0"), 0
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = held.written(now.join(further, "root").select("word", F.col("further").alias("root"),
                                                            (F.col("further") != F.col("root")).alias("moved")),
                           f"roots-{step + 1}")
        held.drop(f"roots-{step}")
        step += 1
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least: int = 3,
             slips: int = SLIPS) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    Words are runs of Latin letters, A to Z in lower case, with one letter left out of every
    ``slips``-th pair of document and run, as slips of the pen; those of at least ``least_length``
    letters that occur ``least`` times.  ``n_near`` counts the words one edit apart.  ``form`` is the
    most frequent of them (ties: the smallest in code-point order) if it is at least twice as
    frequent as the word, else null; ``root`` is the last form of all, or the word itself.

    Null and empty texts have no words.  Repeated rows count again.  Rows without an id keep their
    words as they are.  Only the two named columns are read, so other columns may have any name.
    An empty table gives an empty result.
    """
    held = Scratch(docs.sparkSession)
    spelled = runs(docs, doc_id, text).select(slipped(F.col("run"), F.col("id"), slips).alias("word")
                                              if slips else F.col("run").alias("word"))
    words = held.written(counted(spelled, least_length, least), "words")
    pairs = near_pairs(words, letter_classes(words), held)
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b").groupBy("a").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("b").alias("form"))).alias("best"))
    enough = -F.col("best.less") >= 2 * F.col("n")
    forms = held.written(words.join(near.withColumnRenamed("a", "word"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    held.drop("pairs", "words")
    return forms.join(roots(forms, held), "word")
