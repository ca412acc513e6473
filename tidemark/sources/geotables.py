"""Geometry tables: EWKB plus four box columns, clustered in space.

The box columns are plain doubles, so parquet skips the row groups a spatial filter
cannot hit; clustering by a Z-order key keeps near geometries in the same row groups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geometry import DEFAULT_SRID, set_srid
from tidemark.functions.geotext import st_as_wkb, st_from_wkb
from tidemark.operators._columns import spread
from tidemark.operators.query import table_or_sql
from tidemark.operators.spatial import settle
from tidemark.sources.tables import Tables

BOX = ("xmin", "ymin", "xmax", "ymax")
# Bits per axis of the clustering key.
Z_BITS = 16


def _spread_bits(value: Column) -> Column:
    """The 16 bits of ``value`` on the even positions of a long."""
    # Shifts and masks of the usual bit interleaving.
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = F.lit(mask).cast("long").bitwiseAND(
            value.bitwiseOR(F.shiftleft(value, shift)))
    return value


def z_key(box: Column, extent: tuple[float, float, float, float]) -> Column:
    """Z-order key of a box's middle within ``extent`` (xmin, ymin, xmax, ymax)."""
    xmin, ymin, xmax, ymax = extent
    top = (1 << Z_BITS) - 1

    def scaled(low, high, start, size):
        share = ((low + high) / 2 - start) / (size or 1.0)
        return F.greatest(F.lit(0), F.least(F.lit(top), F.floor(share * top))).cast("long")

    across = scaled(box["xmin"], box["xmax"], xmin, xmax - xmin)
    up = scaled(box["ymin"], box["ymax"], ymin, ymax - ymin)
    return _spread_bits(across).bitwiseOR(F.shiftleft(_spread_bits(up), 1))


def extent_of(df: DataFrame, geom: str = "geometry") -> tuple[float, float, float, float]:
    """The box around all boxes: one row of one aggregate."""
    box = F.col(geom)["bbox"]
    r = df.agg(F.min(box["xmin"]), F.min(box["ymin"]), F.max(box["xmax"]), F.max(box["ymax"])).first()
    return tuple(r) if r[0] is not None else (0.0, 0.0, 1.0, 1.0)


def clustered(df: DataFrame, geom: str = "geometry",
              extent: tuple[float, float, float, float] | None = None,
              partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by place, within their own extent if none is given.

    The second range key is a hash, so a place that holds most of the rows is still cut
    into several partitions.
    """
    keyed = df.withColumn("_z", z_key(F.col(geom)["bbox"], extent or extent_of(df, geom)))
    plain = [f.name for f in df.schema.fields if f.name != geom]
    keyed = keyed.withColumn("_spread", spread(df, plain))
    cut = ["_z", "_spread"]
    ranged = keyed.repartitionByRange(partitions, *cut) if partitions else (
        keyed.repartitionByRange(*cut))
    return ranged.sortWithinPartitions("_z").drop("_z", "_spread")


def geometry_frame(df: DataFrame, geom: str = "geometry", srid: int | None = None,
                   layout: bool = True, extent=None) -> DataFrame:
    """The frame as it is stored: EWKB, box columns and SRID, clustered unless ``layout`` is off.

    ``srid`` overrides; without one, SRID 0 is an error.
    """
    out = df
    if srid is not None:
        out = out.withColumn(geom, set_srid(F.col(geom), srid))
    else:
        g = F.col(geom)
        known = F.when(g["srid"] != 0, g).when(g.isNotNull(), F.raise_error(F.lit(
            "geometry has no SRID; pass srid")).cast(df.schema[geom].dataType))
        out = out.withColumn(geom, known)
    if layout:
        out = clustered(out, geom, extent)
    box = F.col(geom)["bbox"]
    settled = settle(out, geom)
    return settled.select(
        *[F.col(f"`{c}`") for c in df.columns if c != geom],
        *[box[b].alias(f"{geom}_{b}") for b in BOX],
        F.col(geom)["srid"].alias(f"{geom}_srid"), st_as_wkb(F.col(geom)).alias(geom))


def write_geometry(df: DataFrame, path: str, geom: str = "geometry", srid: int | None = None,
                   layout: bool = True, extent=None) -> None:
    """Write geometry files to a new folder."""
    geometry_frame(df, geom, srid, layout, extent).write.mode("errorifexists").parquet(path)


def write_geometry_table(tables: Tables, df: DataFrame, name: str, if_exists: str = "fail",
                         primary_key: str | Iterable[str] | None = None, geom: str = "geometry",
                         srid: int | None = None, layout: bool = True) -> int:
    """Write a geometry table of the catalog: fail if it exists, replace it, or append to it.

    ``primary_key`` is checked unless appending.  The table is an ordinary one, so it takes
    upserts (of :func:`geometry_frame`), deletes and updates like any other.
    """
    return tables.write(geometry_frame(df, geom, srid, layout), name, if_exists, primary_key=primary_key)


def _decoded(raw: DataFrame, geom: str, within, srid: int) -> DataFrame:
    if within is not None:
        xmin, ymin, xmax, ymax = within
        raw = raw.filter(
            (F.col(f"{geom}_xmin") <= xmax) & (F.col(f"{geom}_xmax") >= xmin)
            & (F.col(f"{geom}_ymin") <= ymax) & (F.col(f"{geom}_ymax") >= ymin))
    helpers = [f"{geom}_{b}" for b in BOX] + [f"{geom}_srid"]
    return raw.withColumn(geom, st_from_wkb(F.col(geom), srid)).drop(*helpers)


def read_geometry(spark: SparkSession, path: str, geom: str = "geometry",
                  within: tuple[float, float, float, float] | None = None,
                  srid: int = DEFAULT_SRID) -> DataFrame:
    """Read geometry files; ``within`` keeps rows whose box meets the given box.

    The box test runs on plain columns and reaches the parquet scan; only the rows that
    pass are decoded.
    """
    return _decoded(spark.read.parquet(path), geom, within, srid)


def read_geometry_table(spark: SparkSession, table: str | None = None, query: str | None = None,
                        geom: str = "geometry", within: tuple[float, float, float, float] | None = None,
                        srid: int = DEFAULT_SRID) -> DataFrame:
    """Read a geometry table, or a query over one that keeps its columns, as :func:`read_geometry`."""
    return _decoded(table_or_sql(spark, table, query), geom, within, srid)
