"""Grid cells that turn a geometry join into an equality join.

The grid has one level per power of two.  A geometry belongs to the level whose cells
are at least as large as its bounding box, so it covers at most four cells there, however
large or small it is.  The other side looks up its position on every level in use, of
which there are a few (one per power of two between the smallest and the largest
geometry).  Nothing is capped and no cell size has to be tuned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators._columns import spread
from tidemark.session import estimated_bytes

# Smallest level; points and tiny geometries live here (about 1e-6 units).
MIN_LEVEL = -20

CELL = ["_level", "_cx", "_cy"]

# Levels by which boxes are cut finer for what is looked up by one cell: at most 25 cells to a box.
FINER = 2
# Pieces that the pairs of all cells are cut into, per task of a shuffle.
PIECES_PER_TASK = 4


def level_of(box: Column, finer: int = 0) -> Column:
    extent = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    level = F.when(extent > 0, F.ceil(F.log2(extent))).otherwise(F.lit(MIN_LEVEL))
    return F.greatest(level - finer, F.lit(MIN_LEVEL)).cast("int")


def cell_at(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


SIDES = ("xmin", "ymin", "xmax", "ymax")


def placed(df: DataFrame, box: Column) -> DataFrame:
    """Add the box as four plain columns ``_xmin`` to ``_ymax``.

    Plain columns keep fields of nested columns out of the steps that follow, where
    Spark 4.1's nested column pruning can lose them.
    """
    return df.select("*", *[box[c].alias(f"_{c}") for c in SIDES])


def box_of(prefix: str = "_") -> Column:
    """The four plain columns as a box again."""
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in SIDES])


def cover(df: DataFrame, box: Column, band: int = 1, finer: int = 0) -> DataFrame:
    """One row per cell that a geometry's box covers on its own level.

    With ``band``, levels are rounded up to a multiple of it: fewer levels, larger cells.  With ``finer``,
    they are so many lower: more and smaller cells, in which fewer of what is looked up misses the box.
    """
    level = level_of(box_of(), finer)
    if band > 1:
        level = (F.ceil(level / band) * band).cast("int")
    return _cells_of_box(placed(df, box).withColumn("_level", level))


def _cells_of_box(df: DataFrame) -> DataFrame:
    level = F.col("_level")
    across = F.sequence(cell_at(F.col("_xmin"), level), cell_at(F.col("_xmax"), level))
    up = F.sequence(cell_at(F.col("_ymin"), level), cell_at(F.col("_ymax"), level))
    return df.withColumn("_cx", F.explode(across)).withColumn("_cy", F.explode(up))


def levels_in_use(df: DataFrame, box: Column, finer: int = 0) -> list[int]:
    """The levels that occur: a few numbers, one per power of two, found by one pass over the boxes."""
    found = df.select(level_of(box, finer).alias("level")).where("level is not null").distinct()
    return sorted(row["level"] for row in found.collect())


def _array_of(levels: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in levels]).cast("array<int>")


def look_up(df: DataFrame, box: Column, levels: list[int]) -> DataFrame:
    """One row per level in use: the cell of the box's lower left corner."""
    tall = placed(df, box).withColumn("_level", F.explode(_array_of(levels)))
    return tall.withColumns({
        "_cx": cell_at(F.col("_xmin"), F.col("_level")),
        "_cy": cell_at(F.col("_ymin"), F.col("_level")),
    })


def cover_levels(df: DataFrame, box: Column, levels: list[int]) -> DataFrame:
    """One row per covered cell, on the own level and on every larger level in use."""
    own = placed(df, box).withColumn("_own", level_of(box_of()))
    reached = F.array_union(F.array(F.col("_own")), _array_of(levels))
    tall = own.withColumn("_level", F.explode(reached))
    return _cells_of_box(tall.filter(F.col("_level") >= F.col("_own")))


def broadcast_limit(df: DataFrame) -> int:
    """Spark's own limit for automatic broadcasts, in bytes."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(str(conf.autoBroadcastJoinThreshold()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a side looks small enough for a join without a shuffle, by Catalyst's estimate."""
    return estimated_bytes(df) <= broadcast_limit(df)


def cells_fit_broadcast(df: DataFrame, geom: Column) -> bool:
    """Whether the cells of a side that looks small are so: its rows are counted, eight cells to each."""
    if not fits_broadcast(df):
        return False
    vertices = F.aggregate(F.flatten(geom["parts"]), F.lit(0), lambda n, ring: n + F.size(ring))
    held = df.agg(F.sum(8 * (F.lit(200) + 16 * vertices))).first()[0]
    return (held or 0) <= broadcast_limit(df)


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to the tasks of a shuffle, for a step that works long on few bytes.

    A file of a few MB is read by one or two tasks.  Input that is cut into more tasks than a shuffle
    has anyway is left as it is.
    """
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return df.repartition(width) if estimated_bytes(df) <= width * int(str(conf.filesMaxPartitionBytes())) else df


def salt_hot_cells(left: DataFrame, right: DataFrame, hot_rows: int | None = None):
    """Split cells whose pairs are too many for one task.

    A cell's work is the product of its rows on both sides.  It is cut into a grid of salts, about as many
    as it has shares of a task's work and each side by its size: a row gets a salt of its own side and
    one copy per salt of the other.  All cells together get a few pieces per task, so the copies grow
    with the rows, not with their product.  Both frames come back with ``_salt_l`` and ``_salt_r``, 0 nearly
    everywhere.  The cells that are split are a few per task at most, whatever the number of cells.
    With ``hot_rows``, cells of no more pairs than that many rows on both sides make are left whole.
    """
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def counted(df, name):
        return df.groupBy(*CELL).agg(F.count(F.lit(1)).cast("double").alias(name))

    work = counted(left, "_n_l").join(counted(right, "_n_r"), CELL).withColumn("_work", F.col("_n_l") * F.col("_n_r"))
    share = work.agg(F.greatest(F.sum("_work") / (PIECES_PER_TASK * width), F.lit(float(hot_rows or 1) ** 2)).alias("_share"))
    pieces = F.ceil(F.col("_work") / F.col("_share"))
    listed = work.join(F.broadcast(share)).withColumn("_pieces", pieces).filter("_pieces > 1")  # one share
    listed = listed.withColumn("_sl", F.ceil(F.least("_n_l", F.greatest(
        F.lit(1.0), F.sqrt(F.col("_pieces") * F.col("_n_l") / F.col("_n_r"))))).cast("int"))
    listed = listed.withColumn("_sr", F.ceil(F.least("_n_r", F.col("_pieces") / F.col("_sl"))).cast("int"))
    listed = F.broadcast(listed.select(*CELL, "_sl", "_sr"))

    def salted(df, own, own_salt, other, other_salt):
        plain = [c for c in df.columns if not c.startswith("_")]
        out = df.join(listed, CELL, "left").withColumns({
            "_sl": F.coalesce("_sl", F.lit(1)), "_sr": F.coalesce("_sr", F.lit(1))})
        return out.withColumn(own_salt, F.pmod(spread(df, plain), F.col(own)).cast("int")).withColumn(
            other_salt, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_sl", "_sr")

    return salted(left, "_sl", "_salt_l", "_sr", "_salt_r"), salted(right, "_sr", "_salt_r", "_sl", "_salt_l")
