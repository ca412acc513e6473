"""Connected components of a graph that may be larger than any machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


DRAWN = 3  # rows of a key that the others of it meet once more


def labelled(marks: DataFrame, parts: DataFrame, *columns: str) -> DataFrame:
    """``marks`` with the label of each id's component, its own id if it is in none."""
    return marks.join(parts.withColumnRenamed("node", "id"), "id", "left").select(
        "id", *columns, F.coalesce("label", "id").alias("label"))


def still_apart(shared: DataFrame, known: DataFrame) -> DataFrame:
    """The rows ``key, id`` of the keys whose ids are not in one component, of keys with the same ids one.

    Near copies share very many keys, and those of the same ids would all give the same pairs.
    """
    labels = shared.select("key", "id").join(known.select("id", "label"), "id")
    # the ids as four sums of 32 bits of two hashes, which repeated ids and their order leave sound
    sums = [F.sum(part).alias(f"_{i}{j}") for i in range(2) for h in [F.xxhash64(F.lit(i), "id")]
            for j, part in enumerate((h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)))]
    split = labels.groupBy("key").agg(
        F.min("label").alias("l"), F.max("label").alias("h"), F.count(F.lit(1)).alias("n"), *sums).filter("l <> h")
    one = split.groupBy("n", "_00", "_01", "_10", "_11").agg(F.min("key").alias("key"))
    return shared.select("key", "id").join(one.select("key"), "key", "left_semi")


def drawn_pairs(rows: DataFrame, near: Column | None = None) -> DataFrame:
    """Pairs ``a, b`` of every row ``key, id, label`` and a few of its key, drawn by hash, of other components.

    They pass ``near`` (of ``x`` and ``y``, with all columns of the rows).
    """
    whole = F.struct(*[c for c in rows.columns if c != "key"])
    drawn = rows.groupBy("key").agg(F.array(*[F.min_by(
        whole, F.xxhash64(F.lit(i), "key", "id")) for i in range(DRAWN)]).alias("drawn"))
    met = rows.join(drawn, "key").select(whole.alias("x"), F.explode("drawn").alias("y")).filter("x.label <> y.label")
    if near is not None:
        met = met.filter(near)
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def pairs_across(rows: DataFrame, near: Column) -> DataFrame:
    """All pairs ``a, b`` of rows of one key and two components that pass ``near`` (of ``x`` and ``y``).

    Only the rows outside a key's largest component are paired with the others, so a large group in which
    few rows stand apart takes a few times its size, not its square.
    """
    counts = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    major = counts.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("major"))
    marked = rows.join(major, "key").withColumn("minor", F.col("label") != F.col("major")).drop("major")
    x, y = marked.filter("minor").alias("x"), marked.alias("y")
    on = (F.col("x.key") == F.col("y.key")) & (F.col("x.label") != F.col("y.label")) & (
        ~F.col("y.minor") | (F.col("x.id") < F.col("y.id"))) & near
    return x.join(y, on).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges (a, b)``; the label is the component's smallest node.

    Alternates large and small stars until nothing changes: every node points to the smallest of its
    neighbourhood, which takes about log(nodes) rounds.  A hub's smallest neighbour is an aggregate
    with partial sums per task; what is joined back are its edges, which Spark can split.  Every round
    is written to the shared folder, and dropped there once the next one is; only a count and a hash
    reach the driver.  Null nodes are ignored.
    """
    held, step = Scratch(edges.sparkSession), 0
    now = held.written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), "links-0")
    mark = None
    while True:
        # large star: both directions, the larger neighbours of u point to the smallest
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        # small star: u and its smaller neighbours point to the smallest
        least = _least_neighbour(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = held.written(small, f"links-{step + 1}")
        held.drop(f"links-{step}")
        step += 1
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
