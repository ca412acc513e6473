"""Spatial queries over one table, against a constant or a reference table.

Every query takes exactly one of ``point``, ``wkt``, ``geojson`` and (where it makes
sense) ``ref=(frame, geometry column)``, and ends with the common tail: extra predicate,
order, limit and columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import geodesic
from tidemark.functions.buffers import shape_buffer
from tidemark.functions.geometry import (
    DEFAULT_SRID,
    GEOMETRY,
    POINT,
    POLYGON,
    dimension,
    make_geometry,
    map_vertices,
    set_srid,
    st_area,
    st_centroid,
    st_contains,
    st_distance,
    st_intersects,
    st_perimeter,
)
from tidemark.functions.geotext import Shape, shape
from tidemark.functions.projections import from_utm, st_transform, to_utm, utm_zone
from tidemark.operators import grid
from tidemark.operators.filters import structured_select
from tidemark.operators.spatial_join import (
    reach,
    check_distance,
    contains_ref,
    dwithin_ref,
    intersects_ref,
    within_distance_test,
)

def settle(df: DataFrame, geom: str) -> DataFrame:
    """Compute the geometry column in a step of its own.

    A generator keeps Catalyst from copying the column's expression into every use, so
    it is computed once per row.  The Arrow kernels need it too: Catalyst does not move a
    Python function's input out of nested lambdas.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != geom]
    settled = df.select(*others, F.explode(F.array(F.col(geom))).alias(geom))
    return settled.select(*[F.col(f"`{c}`") for c in df.columns])


def _tail(df: DataFrame, extra: list[str], columns, where, order_by, limit) -> DataFrame:
    if columns is not None:
        columns = [*columns, *[c for c in extra if c not in columns]]
    return structured_select(df, columns, where, order_by, limit)


def _form(ref, srid: int, **forms) -> Shape | None:
    if ref is None:
        return shape(srid=srid, **forms)
    if any(v is not None for v in forms.values()):
        raise ValueError("give exactly one of point, wkt, geojson, ref")
    return None


def contains(
    df: DataFrame, geom: str = "geometry", *, point=None, wkt: str | None = None,
    geojson: Mapping | None = None, ref: tuple[DataFrame, str] | None = None,
    srid: int = DEFAULT_SRID, points: bool = False, columns: Iterable[str] | None = None,
    where=None, order_by=None, limit: int | None = None,
) -> DataFrame:
    """Rows whose geometry contains the input; with ``ref``, rows that some ref contains."""
    given = _form(ref, srid, point=point, wkt=wkt, geojson=geojson)
    if given is None:
        out = contains_ref(df, ref[0], geom, ref[1], points)
    else:
        out = df.filter(st_contains(F.col(geom), given.column, kb=given.kind))
    return _tail(out, [], columns, where, order_by, limit)


def intersects(
    df: DataFrame, geom: str = "geometry", *, point=None, wkt: str | None = None,
    geojson: Mapping | None = None, ref: tuple[DataFrame, str] | None = None,
    srid: int = DEFAULT_SRID, points: bool = False, columns: Iterable[str] | None = None,
    where=None, order_by=None, limit: int | None = None,
) -> DataFrame:
    """Rows whose geometry intersects the input (or some geometry of ``ref``)."""
    given = _form(ref, srid, point=point, wkt=wkt, geojson=geojson)
    if given is None:
        out = intersects_ref(df, ref[0], geom, ref[1], points)
    else:
        out = df.filter(st_intersects(F.col(geom), given.column, kb=given.kind))
    return _tail(out, [], columns, where, order_by, limit)


def dwithin(
    df: DataFrame, geom: str = "geometry", *, distance: float, point=None,
    wkt: str | None = None, geojson: Mapping | None = None,
    ref: tuple[DataFrame, str] | None = None, srid: int = DEFAULT_SRID, unit: str = "m",
    model: str = "spheroid", points: bool = False, columns: Iterable[str] | None = None,
    where=None, order_by=None, limit: int | None = None,
) -> DataFrame:
    """Rows within ``distance`` (inclusive), in metres or SRID units; ``points`` promises points with ``ref``."""
    check_distance(distance, unit, model)
    given = _form(ref, srid, point=point, wkt=wkt, geojson=geojson)
    if given is None:
        out = dwithin_ref(df, ref[0], distance, geom, ref[1], unit, model, points)
    else:
        out = _dwithin_shape(df, geom, given, distance, unit, model)
    return _tail(out, [], columns, where, order_by, limit)


def _dwithin_shape(df, geom, given: Shape, distance, unit, model) -> DataFrame:
    g, fixed = F.col(geom), given.column
    if unit == "srid":
        box = reach(fixed, distance, unit)[0]
        return df.filter(_box_test(g["bbox"], box) & (st_distance(g, fixed, kb=given.kind) <= distance))
    own = geodesic.geodesic_box(g)
    near = F.exists(reach(fixed, distance, unit), lambda box: _box_test(own, box))
    away = geodesic.sphere_distance(g, fixed, kb=given.kind)
    if model == "sphere":
        return df.filter(near & (away <= distance))
    close = df.filter(near & (away <= distance * (1 + geodesic.SPHERE_SLACK)))
    test = within_distance_test(unit, distance, model, kb=given.kind)
    return settle(close, geom).filter(test(g, fixed))


def _box_test(a: Column, b: Column) -> Column:
    return (
        (a["xmin"] <= b["xmax"]) & (a["xmax"] >= b["xmin"])
        & (a["ymin"] <= b["ymax"]) & (a["ymax"] >= b["ymin"])
    )


def distance(
    df: DataFrame, geom: str = "geometry", *, point=None, wkt: str | None = None,
    geojson: Mapping | None = None, srid: int = DEFAULT_SRID, unit: str = "m",
    model: str = "spheroid", columns: Iterable[str] | None = None, where=None, order_by=None,
    limit: int | None = None,
) -> DataFrame:
    """Every row with its ``distance`` to the input."""
    check_distance(0.0, unit, model)
    given, g = shape(point, wkt, geojson, srid), F.col(geom)
    if unit == "srid":
        out = df.withColumn("distance", st_distance(g, given.column, kb=given.kind))
    else:
        rows = df if model == "sphere" else settle(df, geom)
        out = rows.withColumn(
            "distance", geodesic.distance_m(g, given.column, model, kb=given.kind))
    return _tail(out, ["distance"], columns, where, order_by, limit)


def nearest(
    df: DataFrame, geom: str = "geometry", *, k: int = 5, point=None, wkt: str | None = None,
    geojson: Mapping | None = None, srid: int = DEFAULT_SRID,
    columns: Iterable[str] | None = None, where=None, tie_break: Iterable[str] = (),
) -> DataFrame:
    """The ``k`` rows nearest on the sphere; every task keeps only its own best ``k``."""
    if isinstance(k, bool) or not isinstance(k, int) or k < 1:
        raise ValueError("k must be a positive integer")
    given = shape(point, wkt, geojson, srid)
    away = geodesic.sphere_distance(F.col(geom), given.column, kb=given.kind)
    out = structured_select(df, where=where)
    out = out.orderBy(away.asc_nulls_last(), *tie_break).limit(k)
    return out.select(*columns) if columns is not None else out


def _measure(df, geom, name, unit, planar: Callable, metric: Callable, tail) -> DataFrame:
    check_distance(0.0, unit, "spheroid")
    g = F.col(geom)
    out = df.withColumn(name, planar(g)) if unit == "srid" else (
        settle(df, geom).withColumn(name, metric(g)))
    return _tail(out, [name], *tail)


def area(df: DataFrame, geom: str = "geometry", *, unit: str = "m", columns=None, where=None,
         order_by=None, limit=None) -> DataFrame:
    """Every row with its ``area`` in square metres or SRID units squared."""
    return _measure(df, geom, "area", unit, st_area, geodesic.area_m2,
                    (columns, where, order_by, limit))


def perimeter(df: DataFrame, geom: str = "geometry", *, unit: str = "m", columns=None,
              where=None, order_by=None, limit=None) -> DataFrame:
    """Every row with the ``perimeter`` of its polygon; 0 for points and lines."""
    return _measure(df, geom, "perimeter", unit, st_perimeter, geodesic.perimeter_m,
                    (columns, where, order_by, limit))


def centroid(df: DataFrame, geom: str = "geometry", *, columns=None, where=None, order_by=None,
             limit=None) -> DataFrame:
    """Every row with the planar ``centroid_x`` and ``centroid_y``."""
    middle = st_centroid(F.col(geom))
    out = df.withColumn("_middle", middle).withColumns(
        {"centroid_x": F.col("_middle.x"), "centroid_y": F.col("_middle.y")}).drop("_middle")
    return _tail(out, ["centroid_x", "centroid_y"], columns, where, order_by, limit)


def _zone_of(g: Column) -> tuple[Column, Column]:
    """The UTM zone in the middle of a geometry, and whether it lies south."""
    box = g["bbox"]
    return utm_zone((box["xmin"] + box["xmax"]) / 2), (box["ymin"] + box["ymax"]) / 2 < 0


def _in_zone(g: Column) -> Column:
    """The geometry in metres of its UTM zone; one that does not fit the zone raises."""
    box = g["bbox"]
    fits = (box["xmax"] - box["xmin"] <= 6) & (box["ymin"] >= -80) & (box["ymax"] <= 84)
    bad = F.raise_error(F.lit("a metre buffer needs a geometry that fits one UTM zone"))
    return F.when(fits, map_vertices(g, to_utm(*_zone_of(g)))).otherwise(bad.cast(GEOMETRY))


def _spare(df: DataFrame, name: str) -> str:
    """``name``, or one made from it, that is no column of ``df``."""
    while name in df.columns:
        name = f"_{name}"
    return name


def buffer(df: DataFrame, geom: str = "geometry", *, distance: float, unit: str = "m",
           columns=None, where=None, order_by=None, limit=None) -> DataFrame:
    """Every row with its ``buffer``: a polygon, or a multi-polygon where the parts stay apart.

    In metres, points get an exact geodesic circle; all other shapes are widened in their UTM
    zone.  Of unit ``srid``, any shape is widened in its own plane.  A null geometry has a null buffer,
    and so have lines and several points at distance 0.
    """
    check_distance(distance, unit, "spheroid")
    # the kernels work long on few bytes
    g, settled = F.col(geom), settle(grid.dealt(df), geom)
    if unit == "srid":
        out = settle(settled.withColumn("buffer", shape_buffer(g, distance)), "buffer")
        return _tail(out, ["buffer"], columns, where, order_by, limit)
    circle, flat, wide = (_spare(df, name) for name in ("_circle", "_flat", "_wide"))
    point = g["kind"] == POINT
    out = settled.withColumn(circle, geodesic.geodesic_circle(g, F.lit(float(distance))))
    out = settle(out.withColumn(flat, F.when(g.isNotNull() & ~point, _in_zone(g))), flat)
    out = settle(out.withColumn(wide, shape_buffer(F.col(flat), distance)), wide)
    around = make_geometry(F.lit(POLYGON), g["srid"], F.array(F.array(F.col(circle))))
    out = out.withColumn("buffer", F.when(point, around).when(
        F.col(wide).isNotNull(), map_vertices(F.col(wide), from_utm(*_zone_of(g))))).drop(circle, flat, wide)
    return _tail(out, ["buffer"], columns, where, order_by, limit)


def transform(df: DataFrame, to_srid: int, geom: str = "geometry", *, columns=None, where=None,
              order_by=None, limit=None) -> DataFrame:
    """Every row with ``geometry_transformed`` in another reference system."""
    out = df.withColumn("geometry_transformed", st_transform(F.col(geom), to_srid))
    return _tail(out, ["geometry_transformed"], columns, where, order_by, limit)


def geometry_profile(df: DataFrame, geom: str = "geometry") -> DataFrame:
    """Kinds, reference systems, counts and extent of a geometry column."""
    g = F.col(geom)
    return df.filter(g.isNotNull()).groupBy(
        g["kind"].alias("geometry_type"), g["srid"].alias("srid")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.max(dimension(g)).alias("dimension"),
        F.min(g["bbox"]["xmin"]).alias("xmin"), F.min(g["bbox"]["ymin"]).alias("ymin"),
        F.max(g["bbox"]["xmax"]).alias("xmax"), F.max(g["bbox"]["ymax"]).alias("ymax"),
    )


def set_missing_srid(df: DataFrame, srid: int, geom: str = "geometry") -> DataFrame:
    """Give geometries with SRID 0 the stated reference system."""
    g = F.col(geom)
    return df.withColumn(geom, F.when(g["srid"] == 0, set_srid(g, srid)).otherwise(g))
