"""Mixing sources to target weights with a multivariate hypergeometric splitting tree.

Every source gets a target number of words.  Its documents are dealt into blocks by a seeded hash;
the blocks in hash order are a random permutation of the source.  Whole passes take every block,
the last one takes the first blocks and a part of the next, whose cut is found by refining a
histogram of the hash, so no source is ever sorted or gathered.  The exact numbers of blocks of all
sources (the quotas) are divided among the output shards by a binary tree: at each node a
multivariate hypergeometric draw decides how many blocks of each source go left, so every shard
has the same number of blocks and a random, exact share of each source.  A shard then takes its
disjoint range of the permuted blocks, and is shuffled locally by another hash.

What reaches the driver is one row per source (the weights are given per source) and one count per
source and shard.  Everything else is row-local: a document's copies and shards follow from its
hash and its source's row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import written

WORD = r"[^\x20\x09-\x0D]+"
#: The hash has 60 bits, refined 12 at a time.
BITS, STEP = 60, 12
#: Rows of all sources that reach the driver at once when gaps are closed.
COLLECTED = 100_000


def targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Share ``total`` by weight; a source stops at ``most`` times its size, the excess is shared again."""
    out, open_, left = {s: 0.0 for s in sizes}, {s for s in sizes if weights[s] > 0 and sizes[s] > 0}, float(total)
    while open_ and left > 0:
        share = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * share > most * sizes[s]}
        if not full:
            out.update((s, weights[s] * share) for s in open_)
            break
        out.update((s, float(most * sizes[s])) for s in full)
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def splitting_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source in each shard: ``(sources, shards)``; rows sum to the quotas."""
    if shards == 1:
        return quotas[:, None]
    half = shards // 2
    draws, left = int(quotas.sum()) * half // shards, np.zeros_like(quotas)
    rest = int(quotas.sum())
    for i, quota in enumerate(quotas.tolist()):
        rest -= quota
        left[i] = rng.hypergeometric(quota, rest, draws) if draws and quota else 0
        draws -= int(left[i])
    return np.concatenate([splitting_tree(left, half, rng),
                           splitting_tree(quotas - left, shards - half, rng)], axis=1)


def _permuted(seed: int, *columns: Column) -> Column:
    """A seeded hash of the document, from 0 to 2**BITS - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 64 - BITS)


def _cuts(slim: DataFrame, rest: dict[object, float]) -> dict[object, int]:
    """Per source the hash below which documents hold ``rest`` words, or less by the next one, by refinement.

    Each step bins the one open bin of every source; sources are few, so the open bins travel as a
    literal table.
    """
    spark = slim.sparkSession
    open_ = {s: (0, 0) for s, words in rest.items() if words > 0}  # source: lowest hash of the bin, words before
    cuts = {s: 0 for s in rest}
    kind = slim.schema["source"].dataType.simpleString()
    for shift in range(BITS - STEP, -1, -STEP):
        if not open_:
            break
        bins = spark.createDataFrame([(s, low) for s, (low, _) in open_.items()], f"source {kind}, low long")
        inside = slim.join(F.broadcast(bins), slim["source"].eqNullSafe(bins["source"])).filter(
            (F.col("hash") >= F.col("low")) & (F.col("hash") - F.col("low") < F.lit(1 << (shift + STEP))))
        counted = inside.groupBy(slim["source"].alias("source"),
                                 F.shiftright(F.col("hash") - F.col("low"), shift).alias("bin")) \
            .agg(F.sum("size").alias("words"))
        # the window holds at most 2**STEP rows of a source
        order = Window.partitionBy("source").orderBy("bin")
        before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        wanted = spark.createDataFrame([(s, float(rest[s]) - open_[s][1]) for s in open_],
                                       f"source {kind}, wanted double").alias("w")
        edge = counted.withColumn("before", before).alias("c").join(
            F.broadcast(wanted), F.col("c.source").eqNullSafe(F.col("w.source"))) \
            .filter((F.col("before") < F.col("wanted")) & (F.col("before") + F.col("words") >= F.col("wanted"))) \
            .select("c.source", "bin", "before", "words", "wanted").collect()
        found = {r["source"]: r for r in edge}
        for source, (low, gone) in list(open_.items()):
            row = found.get(source)
            if row is None:  # rounding: all that is left belongs to the mix
                cuts[source] = low + (1 << (shift + STEP))
                del open_[source]
                continue
            low += row["bin"] << shift
            if shift == 0:
                cuts[source] = low + int(row["before"] + row["words"] == row["wanted"])
                del open_[source]
            else:
                open_[source] = (low, gone + row["before"])
    return cuts


def _fills(slim: DataFrame, cuts: dict, rest: dict) -> dict[object, list[tuple]]:
    """Ranges past the cut that close the gap: ``(low, high, most)``, documents of at most ``most`` words.

    In the order of the hash every document that still fits is taken, until none is left that does.
    A range ends where a document of at most ``most`` words is larger than the gap by then; the next one
    takes documents of at most that gap.  A histogram finds where the gap would be closed; of the
    documents from there on a bounded number reaches the driver.
    """
    spark, kind = slim.sparkSession, slim.schema["source"].dataType.simpleString()
    fills, end = {s: [] for s in cuts}, 1 << BITS
    table = F.broadcast(spark.createDataFrame([(s, cuts[s]) for s in cuts], f"source {kind}, cut long").alias("k"))
    taken = slim.alias("d").join(table, F.col("d.source").eqNullSafe(F.col("k.source"))) \
        .groupBy("d.source").agg(F.sum(F.when(F.col("hash") < F.col("cut"), F.col("size")).otherwise(0)).alias("n"))
    # source: first hash of the open window, its end, words that are missing
    open_ = {r["source"]: (cuts[r["source"]] + 1, end, rest[r["source"]] - r["n"]) for r in taken.collect()}

    def fitting(windows):
        """Documents of the windows ``(source, low, high, shift, gap)`` that the gaps hold."""
        w = F.broadcast(spark.createDataFrame(
            windows, f"source {kind}, low long, high long, shift int, gap double").alias("w"))
        return slim.alias("d").join(w, F.col("d.source").eqNullSafe(F.col("w.source"))).filter(
            (F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("high"))
            & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))

    while open_ := {s: w for s, w in open_.items() if w[2] >= 1 and w[0] < end}:
        most = max(50, COLLECTED // len(open_))
        shifts = {s: max(0, (high - low - 1).bit_length() - STEP) for s, (low, high, _) in open_.items()}
        counted = fitting([(s, low, high, shifts[s], float(gap)) for s, (low, high, gap) in open_.items()]) \
            .groupBy("d.source", "gap", F.expr("shiftright(hash - low, shift)").alias("bin")) \
            .agg(F.sum("size").alias("words"), F.count("*").alias("docs"))
        # the window holds at most 2**STEP rows of a source
        each = Window.partitionBy("source")
        crossing = F.col("sum_words") > F.col("gap")
        seen = counted.withColumn("sum_words", F.sum("words").over(each.orderBy("bin"))) \
            .withColumn("sum_docs", F.sum("docs").over(each.orderBy("bin"))) \
            .withColumn("first", F.min(F.when(crossing, F.col("bin"))).over(each)) \
            .withColumn("past", F.min(F.when(crossing, F.col("sum_docs") - F.col("docs"))).over(each)) \
            .groupBy("source").agg(
                F.max("first").alias("first"), F.sum("words").alias("words"),
                F.sum(F.when(F.col("bin") < F.col("first"), F.col("words"))).alias("before"),
                F.max(F.when(F.col("sum_docs") - F.col("past") <= most, F.col("bin"))).alias("upto")).collect()
        seen, near = {r["source"]: r for r in seen}, {}
        for s, (low, high, gap) in list(open_.items()):
            r = seen.get(s)
            if r is None:  # nothing in the window fits
                open_[s] = (high, end, gap)
                continue
            if r["first"] is None:  # all of it fits together
                fills[s].append((low, high, float(gap)))
                open_[s] = (high, end, gap - r["words"])
                continue
            at = low + (r["first"] << shifts[s])
            if r["before"]:
                fills[s].append((low, at, float(gap)))
                gap -= r["before"]
            if r["upto"] is not None and r["upto"] >= r["first"] or shifts[s] == 0:
                near[s] = (at, min(high, low + (max(r["upto"] or 0, r["first"]) + 1 << shifts[s])), gap)
            else:
                open_[s] = (at, min(high, at + (1 << shifts[s])), gap)
        if not near:
            continue
        rows = fitting([(s, low, high, 0, float(gap)) for s, (low, high, gap) in near.items()]) \
            .groupBy(F.col("d.source").alias("source"), "hash").agg(
                F.sum("size").alias("size"), F.max("size").alias("each")).collect()
        by_source = {s: [] for s in near}
        for r in rows:
            by_source[r["source"]].append(r)
        for s, (low, high, gap) in near.items():
            most_words, took = gap, 0
            for r in sorted(by_source[s], key=lambda r: r["hash"]):
                if r["each"] > most_words:
                    continue
                if r["size"] <= gap:
                    gap, took = gap - r["size"], took + 1
                    continue
                if took:
                    fills[s].append((low, r["hash"], float(most_words)))
                low, most_words, took = r["hash"] + 1, gap, 0
            if took:
                fills[s].append((low, high, float(most_words)))
            open_[s] = (high, end, gap)
    return fills


def _small(df: DataFrame, rows: int) -> DataFrame:
    """One row per source: broadcast while that is a configuration-sized list, else left to Spark."""
    return F.broadcast(df) if rows <= 20_000 else df


def _per_source(slim: DataFrame, weight_cycle, most, shards, block_bits, seed) -> DataFrame:
    """The mix as one row per source."""
    kind = slim.schema["source"].dataType.simpleString()
    sizes = {r["source"]: r["size"] for r in
             slim.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    # code point order is the order of UTF-8 bytes
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else str(s)))
    weights = {s: weight_cycle[i % len(weight_cycle)] for i, s in enumerate(order)}
    goal = targets(sizes, weights, sum(sizes.values()), most)
    whole = {s: int(goal[s] // sizes[s]) if sizes[s] else 0 for s in order}
    rest = {s: goal[s] - whole[s] * sizes[s] for s in order}
    cuts = _cuts(slim, rest)
    fills = _fills(slim, cuts, rest)
    quotas = np.array([(whole[s] << block_bits) + -(-cuts[s] // (1 << (BITS - block_bits))) for s in order], np.int64)
    split = splitting_tree(quotas, shards, np.random.default_rng(seed)).cumsum(axis=1) if order else []
    rows = [(s, sizes[s], goal[s], whole[s], cuts[s], fills[s], split[i].tolist()) for i, s in enumerate(order)]
    plan = slim.sparkSession.createDataFrame(
        rows, f"_source {kind}, source_size long, target double, _whole int, _cut long, "
              "_fills array<struct<low:long,high:long,most:double>>, "
              "_upto array<long>")
    return _small(plan, len(rows))


def _placed(keyed: DataFrame, source: str, size: Column, plan: DataFrame, shards: int, block_bits: int) -> DataFrame:
    """Add ``source_size, target, copies, places`` to rows that have ``_hash``; ``size`` is read past the cut only."""
    block = F.shiftright("_hash", BITS - block_bits)
    below = F.col("_hash") < F.col("_cut")
    inside = F.filter("_fills", lambda f: (F.col("_hash") >= f["low"]) & (F.col("_hash") < f["high"]))
    last = below | F.when(~below & (F.size(inside) > 0), (size > 0) & (size <= inside[0]["most"])).otherwise(False)
    # what fills a gap lies past the blocks of the quota, so it draws one of them
    drawn = F.pmod(F.xxhash64("_hash"), F.greatest(F.element_at("_upto", -1), F.lit(1)))
    rank = lambda k: F.when((k <= F.col("_whole")) | below, F.shiftleft(
        (k - 1).cast("long"), block_bits) + block).otherwise(drawn)
    # a block of a pass has a rank among all blocks of its source; shards take consecutive ranks
    places = F.transform(F.sequence(F.lit(1), F.col("copies")), lambda k: F.struct(
        k.alias("pass"),
        F.coalesce(F.nullif(F.array_position(F.transform(
            "_upto", lambda u: u > rank(k)), True), F.lit(0)) - 1,
            F.lit(shards - 1)).cast("int").alias("shard")))
    return keyed.join(plan, keyed[source].eqNullSafe(plan["_source"])) \
        .withColumn("copies", F.col("_whole") + last.cast("int")) \
        .withColumn("places", F.when(F.col("copies") > 0, places).otherwise(
            F.array().cast("array<struct<pass:int,shard:int>>"))) \
        .drop("_source", "_whole", "_cut", "_fills", "_upto")


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _slim(docs, seed, doc_id, text, source):
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        _words(F.col(text)).alias("size"),
        _permuted(seed, F.col(doc_id).cast("string"), F.col(text)).alias("hash"))


def planned(docs: DataFrame, weight_cycle=(5, 2, 1), most: float = 3, shards: int = 16, block_bits: int = 8,
            seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per document row its part in the mix: ``doc_id, source, size, source_size, target, copies, places``.

    ``places`` has one (pass, shard) for each copy.  Sources in code point order, null last, weigh the
    cycle's numbers in turn and share all words; a source stops at ``most`` times its size.  The
    size is the number of words; a null or empty text has none, and is taken in whole passes and
    below the cut like any other.  Equal rows get equal places.  Runs with the same seed agree.  Only
    whole documents are taken, in the order of the hash each that still fits, so a source stays below
    its target by less than the smallest document past the cut that the last pass leaves out.  An empty
    table gives an empty plan.
    """
    slim = written(_slim(docs, seed, doc_id, text, source), "mix")
    plan = _per_source(slim, weight_cycle, most, shards, block_bits, seed)
    return _placed(slim.withColumnRenamed("hash", "_hash"), "source", F.col("size"), plan, shards, block_bits) \
        .drop("_hash")


def mixed(docs: DataFrame, weight_cycle=(5, 2, 1), most: float = 3, shards: int = 16, block_bits: int = 8,
          seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every taken copy with all columns of ``docs``, then ``_shard, _rank``.

    ``_rank`` orders the copies of a shard at random; see ``planned`` for the rules.  Columns of these two
    names are replaced; others may have any name.
    """
    docs = docs.drop("_shard", "_rank")
    slim = written(_slim(docs, seed, doc_id, text, source), "mix")
    plan = _per_source(slim, weight_cycle, most, shards, block_bits, seed)
    keyed = docs.select(F.struct("*").alias("_row"), F.col(source).alias("_of"),
                        _permuted(seed, F.col(doc_id).cast("string"), F.col(text)).alias("_hash"))
    placed = _placed(keyed, "_of", _words(F.col(f"_row.`{text}`")), plan, shards, block_bits).withColumn("_place", F.explode("places"))
    return placed.select("_row.*", F.col("_place.shard").alias("_shard"),
                         F.xxhash64(F.lit(seed + 1), "_hash", F.col("_place.pass")).alias("_rank"))


def shuffled(mix: DataFrame) -> DataFrame:
    """The shards one after the other, each shuffled locally."""
    return mix.repartitionByRange("_shard", "_rank").sortWithinPartitions("_shard", "_rank")
