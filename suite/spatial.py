"""Spatial queries over positions derived from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.fixtures import (
    SQL_DEPOTS,
    SQL_PATHS,
    SQL_PLOTS,
    SQL_SITES,
    SQL_YARDS,
    SQL_ZONES,
    corners,
    depots,
    fresh_name,
    paths,
    plots,
    read,
    sites,
    triangles,
    wedges,
    workspace,
    yards,
    zones,
)
from suite.registry import query
from tidemark.functions.buffers import shape_buffer
from tidemark.functions.geodesic import distance_m
from tidemark.functions.geometry import (
    first_vertex,
    make_geometry,
    set_srid,
    st_area,
    st_contains,
    st_envelope,
    st_intersection_area,
    st_perimeter,
    st_point,
    vertex,
)
from tidemark.functions.geotext import (
    st_as_geojson,
    st_as_wkt,
    st_from_geojson,
    st_from_wkt,
)
from tidemark.operators import filters, grid, spatial, spatial_join
from tidemark.operators.spatial import settle
from tidemark.sources import geotables

RADIUS = 6371008.771415059


def _spheroid(pairs: str) -> str:
    """CTEs that end in ``geodesic(id, metres)`` for ``pairs(id, x1, y1, x2, y2)``: Vincenty's iteration."""
    return f"""
ell AS (SELECT 6378137.0 AS a, 1 / 298.257223563 AS f, 6378137.0 * (1 - 1 / 298.257223563) AS b),
pairs AS ({pairs}),
red AS (SELECT id, f, radians((x2 - x1 + 540) % 360 - 180) AS l,
          atan((1 - f) * tan(radians(y1))) AS u1, atan((1 - f) * tan(radians(y2))) AS u2 FROM pairs, ell),
vin AS (SELECT id, f, l, sin(u1) AS su1, cos(u1) AS cu1, sin(u2) AS su2, cos(u2) AS cu2, l AS lam, 0 AS k FROM red
  UNION ALL
  SELECT id, f, l, su1, cu1, su2, cu2,
    l + (1 - cc) * f * sa * (sg + cc * ss * (c2m + cc * cs * (-1 + 2 * c2m * c2m))), k + 1
  FROM (SELECT *, f / 16 * c2a * (4 + f * (4 - 3 * c2a)) AS cc FROM (
    SELECT *, atan2(ss, cs) AS sg, CASE WHEN c2a = 0 THEN 0 ELSE cs - 2 * su1 * su2 / c2a END AS c2m FROM (
      SELECT *, 1 - sa * sa AS c2a FROM (
        SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM (
          SELECT *, sqrt((cu2 * sin(lam)) ** 2 + (cu1 * su2 - su1 * cu2 * cos(lam)) ** 2) AS ss,
            su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM vin WHERE k < 40))))) q),
geodesic AS (SELECT id, b * ca * (sg - cb * ss * (c2m + cb / 4 * (cs * (-1 + 2 * c2m * c2m)
    - cb / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))) AS metres
  FROM (SELECT *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS ca,
      w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS cb FROM (
    SELECT *, atan2(ss, cs) AS sg, c2a * (a * a - b * b) / (b * b) AS w,
      CASE WHEN c2a = 0 THEN 0 ELSE cs - 2 * su1 * su2 / c2a END AS c2m FROM (
      SELECT *, 1 - sa * sa AS c2a FROM (
        SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM (
          SELECT vin.*, a, b, sqrt((cu2 * sin(lam)) ** 2 + (cu1 * su2 - su1 * cu2 * cos(lam)) ** 2) AS ss,
            su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM vin, ell WHERE k = 40))))) q)"""


def _sphere(x1: str, y1: str, x2: str, y2: str) -> str:
    return (f"2 * {RADIUS} * asin(least(1.0, sqrt("
            f"sin((radians({y2}) - radians({y1})) / 2) ** 2 + cos(radians({y1})) * "
            f"cos(radians({y2})) * sin((radians({x2}) - radians({x1})) / 2) ** 2)))")


# The triangle's long side, in the same arithmetic as the ray test.
SQL_IN_TRIANGLE = """
x > x0 AND y > y0 AND y < y0 + 34.0
AND (x0 - (x0 + 72.0)) * (y - y0) - ((y0 + 34.0) - y0) * (x - (x0 + 72.0)) <> 0
AND x < (x0 - (x0 + 72.0)) * (y - y0) / ((y0 + 34.0) - y0) + (x0 + 72.0)"""


# --- joins ------------------------------------------------------------------------

@query(f"""
WITH {SQL_SITES}, {SQL_ZONES}
SELECT c_custkey, n_nationkey FROM sites JOIN zones
ON x > x0 AND x < x0 + 72.0 AND y > y0 AND y < y0 + 34.0""")
def spatial_within_join(spark, sf_dir):
    """Sites strictly inside zones."""
    return spatial_join.within_join(sites(spark, sf_dir), zones(spark, sf_dir),
                                    columns=["a.c_custkey", "b.n_nationkey"], points=True)


@query(f"""
WITH {SQL_SITES}, {SQL_DEPOTS}, {SQL_YARDS}
SELECT c_custkey, s_suppkey FROM sites s JOIN yards b
ON s.x > b.x AND s.x < b.x1 AND s.y > b.y AND s.y < b.y1""")
def spatial_within_join_shuffled(spark, sf_dir):
    """Sites in yards with both sides shuffled on cells, crowded cells salted."""
    return spatial_join.within_join(
        sites(spark, sf_dir), yards(spark, sf_dir), columns=["a.c_custkey", "b.s_suppkey"],
        points=True, allow_broadcast=False, hot_rows=50)


@query(f"""
WITH {SQL_SITES}, {SQL_ZONES}
SELECT c_custkey FROM sites WHERE EXISTS (SELECT 1 FROM zones WHERE {SQL_IN_TRIANGLE})""")
def contains_ref(spark, sf_dir):
    """Sites that some triangle contains."""
    return spatial.contains(sites(spark, sf_dir), ref=(triangles(spark, sf_dir), "geometry"),
                            points=True, columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_DEPOTS}, {SQL_YARDS}
SELECT c_custkey FROM sites s WHERE EXISTS (SELECT 1 FROM yards b
  WHERE s.x >= b.x AND s.x <= b.x1 AND s.y >= b.y AND s.y <= b.y1)""")
def intersects_ref(spark, sf_dir):
    """Sites that touch some yard, borders included."""
    return spatial.intersects(sites(spark, sf_dir), ref=(yards(spark, sf_dir), "geometry"),
                              points=True, columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_PLOTS}, {SQL_ZONES}
SELECT c_custkey FROM plots WHERE EXISTS (SELECT 1 FROM zones
  WHERE x <= x0 + 72.0 AND x1 >= x0 AND y <= y0 + 34.0 AND y1 >= y0)""")
def intersects_ref_areas(spark, sf_dir):
    """Plots that touch the zone of some nation."""
    return spatial.intersects(plots(spark, sf_dir), ref=(zones(spark, sf_dir), "geometry"),
                              columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_DEPOTS}
SELECT c_custkey FROM sites s WHERE EXISTS (SELECT 1 FROM depots d
  WHERE sqrt((s.x - d.x) * (s.x - d.x) + (s.y - d.y) * (s.y - d.y)) <= 3.25)""")
def dwithin_ref(spark, sf_dir):
    """Sites within 3.25 degrees (planar) of some depot."""
    return spatial.dwithin(sites(spark, sf_dir), ref=(depots(spark, sf_dir), "geometry"),
                           distance=3.25, unit="srid", points=True, columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_DEPOTS}
SELECT c_custkey FROM sites s WHERE EXISTS (SELECT 1 FROM depots d
  WHERE {_sphere('s.x', 's.y', 'd.x', 'd.y')} <= 300000.5)""")
def dwithin_ref_sphere(spark, sf_dir):
    """Sites within 300 km of some depot, across the antimeridian too."""
    return spatial.dwithin(sites(spark, sf_dir), ref=(depots(spark, sf_dir), "geometry"),
                           distance=300000.5, points=True, model="sphere", columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_DEPOTS}
SELECT c_custkey, s_suppkey FROM sites s JOIN depots d
ON {_sphere('s.x', 's.y', 'd.x', 'd.y')} <= 300000.5""")
def dwithin_pairs(spark, sf_dir):
    """All site and depot pairs within 300 km."""
    return spatial_join.dwithin_pairs(
        sites(spark, sf_dir), depots(spark, sf_dir), 300000.5, model="sphere", points=True
    ).select("a.c_custkey", "b.s_suppkey")


@query(f"""
WITH RECURSIVE {SQL_SITES}, {SQL_DEPOTS}, {_spheroid(f"""
  SELECT c_custkey AS id, s.x AS x1, s.y AS y1, d.x AS x2, d.y AS y2 FROM sites s, depots d
  WHERE {_sphere('s.x', 's.y', 'd.x', 'd.y')} <= 310000""")}
SELECT DISTINCT id AS c_custkey FROM geodesic WHERE metres <= 300000""")
def dwithin_ref_spheroid(spark, sf_dir):
    """Sites within 300 km of some depot on the spheroid."""
    return spatial.dwithin(sites(spark, sf_dir), ref=(depots(spark, sf_dir), "geometry"),
                           distance=300000.0, points=True, columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_PLOTS}, {SQL_DEPOTS}, {SQL_YARDS}
SELECT c_custkey FROM plots p WHERE EXISTS (SELECT 1 FROM yards q
  WHERE greatest(p.x - q.x1, q.x - p.x1, 0) ** 2 + greatest(p.y - q.y1, q.y - p.y1, 0) ** 2 <= 1.25 ** 2)""")
def dwithin_ref_areas(spark, sf_dir):
    """Plots within 1.25 degrees (planar) of some yard: areas on both sides."""
    return spatial.dwithin(plots(spark, sf_dir), ref=(yards(spark, sf_dir), "geometry"),
                           distance=1.25, unit="srid", columns=["c_custkey"])


@query(f"""
WITH {SQL_PATHS},
near AS (SELECT *, greatest(0, least(1, ((10.0 - xa) * (xb - xa) + (12.0 - ya) * (yb - ya))
           / ((xb - xa) ** 2 + (yb - ya) ** 2))) AS t FROM paths)
SELECT o_orderkey FROM near
WHERE (xa + t * (xb - xa) - 10.0) ** 2 + (ya + t * (yb - ya) - 12.0) ** 2 <= 20.25 ** 2""")
def geo_dwithin_lines(spark, sf_dir):
    """Paths that pass within 20.25 degrees (planar) of a point."""
    return spatial.dwithin(paths(spark, sf_dir), point=(10.0, 12.0), distance=20.25, unit="srid",
                           columns=["o_orderkey"])


@query(f"""
WITH {SQL_DEPOTS}, {SQL_YARDS}
SELECT a.s_suppkey AS id_a, b.s_suppkey AS id_b,
       round((least(a.x1, b.x1) - greatest(a.x, b.x)) *
             (least(a.y1, b.y1) - greatest(a.y, b.y)), 6) AS overlap_area
FROM yards a JOIN yards b ON a.s_suppkey < b.s_suppkey
 AND a.x <= b.x1 AND a.x1 >= b.x AND a.y <= b.y1 AND a.y1 >= b.y""")
def overlap_pairs(spark, sf_dir):
    """Yards that overlap, each pair once, with the shared area."""
    pairs = spatial_join.overlap_pairs(yards(spark, sf_dir), "s_suppkey")
    shared = st_intersection_area(F.col("a.geometry"), F.col("b.geometry"))
    return pairs.select(F.col("a.s_suppkey").alias("id_a"), F.col("b.s_suppkey").alias("id_b"),
                        (F.round(shared, 6) + 0.0).alias("overlap_area"))


@query(f"""
WITH {SQL_SITES}, {SQL_ZONES}
SELECT n_nationkey, n_name, count(c_custkey) AS n_sites,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM zones LEFT JOIN sites ON {SQL_IN_TRIANGLE} GROUP BY 1, 2""")
def zone_stats(spark, sf_dir):
    """Sites and their balance per triangle; empty ones are kept."""
    from suite.fixtures import exact_sum

    stats = spatial_join.zone_stats(
        triangles(spark, sf_dir), sites(spark, sf_dir), "n_nationkey",
        {"n_sites": F.count(F.lit(1)), "balance": exact_sum(F.col("b.c_acctbal"))},
        counts=["n_sites"], points=True)
    return stats.select("n_nationkey", "n_name", "n_sites", "balance")


# --- predicates against a constant --------------------------------------------------

@query(f"""
WITH {SQL_SITES}, {SQL_PLOTS}
SELECT c_custkey FROM plots WHERE x < 10.05 AND x1 > 10.05 AND y < 5.05 AND y1 > 5.05
AND c_acctbal > 0""")
def geo_contains(spark, sf_dir):
    """Plots that contain a point, with an extra predicate."""
    return spatial.contains(plots(spark, sf_dir), point=(10.05, 5.05), columns=["c_custkey"],
                            where="c_acctbal > 0")


@query(f"""
WITH {SQL_PATHS}, side AS (
  SELECT *, [(xb - xa) * (c[2] - ya) - (yb - ya) * (c[1] - xa)
             for c in [[-30.0, -20.0], [40.0, -20.0], [40.0, 35.0], [-30.0, 35.0]]] AS turns
  FROM paths)
SELECT o_orderkey FROM side
WHERE least(xa, xb) <= 40 AND greatest(xa, xb) >= -30 AND least(ya, yb) <= 35
  AND greatest(ya, yb) >= -20 AND list_min(turns) <= 0 AND list_max(turns) >= 0""")
def geo_intersects(spark, sf_dir):
    """Paths that cross a rectangle."""
    return spatial.intersects(
        paths(spark, sf_dir), wkt="POLYGON((-30 -20, 40 -20, 40 35, -30 35, -30 -20))",
        columns=["o_orderkey"])


@query(f"""
WITH {SQL_SITES}, {SQL_PLOTS}
SELECT c_custkey, x, y FROM plots
WHERE x >= -60 AND x1 <= 75 AND y >= -40 AND y1 <= 50""")
def bbox_filter(spark, sf_dir):
    """Plots within an envelope."""
    g = F.col("geometry")
    return filters.bbox_filter(plots(spark, sf_dir), "geometry", -60.0, -40.0, 75.0, 50.0).select(
        "c_custkey", first_vertex(g)["x"].alias("x"), first_vertex(g)["y"].alias("y"))


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey FROM sites
WHERE sqrt((x - 10.0) * (x - 10.0) + (y - 12.0) * (y - 12.0)) <= 25.0""")
def geo_dwithin(spark, sf_dir):
    return spatial.dwithin(sites(spark, sf_dir), point=(10.0, 12.0), distance=25.0, unit="srid",
                           columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey FROM sites WHERE {_sphere('x', 'y', '179.5', '12.0')} <= 2500000.5""")
def geo_dwithin_sphere(spark, sf_dir):
    """Within 2500 km of a point next to the antimeridian."""
    return spatial.dwithin(sites(spark, sf_dir), point=(179.5, 12.0), distance=2500000.5,
                           model="sphere", columns=["c_custkey"])


@query(f"""
WITH RECURSIVE {SQL_SITES}, {_spheroid(f"""
  SELECT c_custkey AS id, x AS x1, y AS y1, 179.5 AS x2, 12.0 AS y2 FROM sites
  WHERE {_sphere('x', 'y', '179.5', '12.0')} <= 2600000""")}
SELECT id AS c_custkey FROM geodesic WHERE metres <= 2500000""")
def geo_dwithin_spheroid(spark, sf_dir):
    return spatial.dwithin(sites(spark, sf_dir), point=(179.5, 12.0), distance=2500000.0,
                           columns=["c_custkey"])


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey, round(sqrt((x - 10.0) * (x - 10.0) + (y - 12.0) * (y - 12.0)), 6) AS distance
FROM sites""")
def geo_distance(spark, sf_dir):
    out = spatial.distance(sites(spark, sf_dir), point=(10.0, 12.0), unit="srid",
                           columns=["c_custkey"])
    return out.withColumn("distance", F.round("distance", 6))


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey, round({_sphere('x', 'y', '10.0', '12.0')}, 2) AS distance FROM sites""")
def geo_distance_sphere(spark, sf_dir):
    out = spatial.distance(sites(spark, sf_dir), point=(10.0, 12.0), model="sphere",
                           columns=["c_custkey"])
    return out.withColumn("distance", F.round("distance", 2))


@query(f"""
WITH RECURSIVE {SQL_SITES}, {_spheroid("SELECT c_custkey AS id, x AS x1, y AS y1, 10.0 AS x2, 12.0 AS y2 FROM sites")}
SELECT id AS c_custkey, round(metres) + 0.0 AS distance FROM geodesic""")
def geo_distance_spheroid(spark, sf_dir):
    """Whole metres."""
    out = spatial.distance(sites(spark, sf_dir), point=(10.0, 12.0), columns=["c_custkey"])
    return out.withColumn("distance", F.round("distance") + 0.0)


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey FROM sites
ORDER BY round({_sphere('x', 'y', '10.03', '12.07')}, 3), c_custkey LIMIT 25""")
def nearest_k(spark, sf_dir):
    """The 25 sites nearest to a point."""
    return spatial.nearest(sites(spark, sf_dir), k=25, point=(10.03, 12.07),
                           columns=["c_custkey"], tie_break=["c_custkey"])


# --- measures ---------------------------------------------------------------------

SQL_WEDGES = ("wedges AS (SELECT *, CAST(c_custkey % 7 + 1 AS DOUBLE) AS w, "
              "CAST(c_custkey % 5 + 1 AS DOUBLE) AS h FROM sites)")


@query(f"WITH {SQL_SITES}, {SQL_WEDGES} SELECT c_custkey, round(w * h / 2, 6) AS area FROM wedges")
def geo_area(spark, sf_dir):
    out = spatial.area(wedges(spark, sf_dir), unit="srid", columns=["c_custkey"])
    return out.withColumn("area", F.round("area", 6))


@query(f"""
WITH {SQL_SITES}, {SQL_WEDGES}
SELECT c_custkey, round(w + h + sqrt(w * w + h * h), 6) AS perimeter FROM wedges""")
def geo_perimeter(spark, sf_dir):
    out = spatial.perimeter(wedges(spark, sf_dir), unit="srid", columns=["c_custkey"])
    return out.withColumn("perimeter", F.round("perimeter", 6))


@query(f"""
WITH {SQL_SITES}, {SQL_WEDGES}
SELECT c_custkey, round(x + w / 3, 6) AS centroid_x, round(y + h / 3, 6) AS centroid_y
FROM wedges""")
def geo_centroid(spark, sf_dir):
    out = spatial.centroid(wedges(spark, sf_dir), columns=["c_custkey"])
    return out.select("c_custkey", F.round("centroid_x", 6).alias("centroid_x"),
                      F.round("centroid_y", 6).alias("centroid_y"))


@query()
def geo_area_spheroid(spark, sf_dir):
    return spatial.area(wedges(spark, sf_dir), columns=["c_custkey"])


@query(f"""
WITH RECURSIVE {SQL_SITES}, wedge AS (SELECT *, c_custkey % 7 + 1 AS w, c_custkey % 5 + 1 AS h FROM sites), {_spheroid("""
  SELECT c_custkey AS id, x AS x1, y AS y1, x + w AS x2, y AS y2 FROM wedge
  UNION ALL SELECT c_custkey, x + w, y, x, y + h FROM wedge UNION ALL SELECT c_custkey, x, y + h, x, y FROM wedge""")}
SELECT id AS c_custkey, round(sum(metres)) + 0.0 AS perimeter FROM geodesic GROUP BY id""")
def geo_perimeter_spheroid(spark, sf_dir):
    """Whole metres."""
    out = spatial.perimeter(wedges(spark, sf_dir), columns=["c_custkey"])
    return out.withColumn("perimeter", F.round("perimeter") + 0.0)


@query("""
SELECT c_custkey, round(16 * sin(2 * pi() / 32) * (c_custkey % 9 + 1) ** 2 * 0.25, 6) AS area
FROM customer""")
def geo_buffer_area(spark, sf_dir):
    """Area of a planar buffer around every site, with a radius per row."""
    from tidemark.functions.geometry import st_buffer

    radius = (F.col("c_custkey") % 9 + 1).cast("double") * 0.5
    return sites(spark, sf_dir).select(
        "c_custkey", F.round(st_area(st_buffer(F.col("geometry"), radius)), 6).alias("area"))


@query("""
WITH corner AS (SELECT c_custkey, CAST(c_custkey % 7 + 2 AS DOUBLE) AS arm, CAST(c_custkey % 3 + 1 AS DOUBLE) AS thick,
                       CAST(c_custkey % 4 + 1 AS DOUBLE) * 0.5 AS d FROM customer)
SELECT c_custkey, round(thick * (2 * arm + thick) + 4 * (arm + thick) * d
                        + 5 / 4 * 16 * sin(2 * pi() / 32) * d ** 2 - d ** 2, 6) AS area FROM corner""")
def geo_buffer_concave(spark, sf_dir):
    """Area of a planar buffer around L-shapes, with a radius per row."""
    radius = (F.col("c_custkey") % 4 + 1).cast("double") * 0.5
    placed = settle(grid.dealt(corners(spark, sf_dir).select("c_custkey", "geometry")), "geometry")
    wide = settle(placed.select("c_custkey", shape_buffer(F.col("geometry"), radius).alias("wide")), "wide")
    return wide.select("c_custkey", F.round(st_area(F.col("wide")), 6).alias("area"))


@query("""
WITH pair AS (SELECT o_orderkey, o_orderkey % 3 AS gap, o_orderkey % 5 AS low, o_orderkey % 5 + 1 + o_orderkey % 4 AS high
              FROM orders)
SELECT o_orderkey FROM pair WHERE high <= 2 OR (low >= 2 + gap AND high <= 5 + gap) OR (gap = 0 AND high <= 5)""")
def geo_contains_lines(spark, sf_dir):
    """Orders as two collinear lines, with or without a gap, that hold a third one."""
    key = F.col("o_orderkey")
    x, y = ((key * 37) % 360).cast("double"), ((key * 53) % 170).cast("double")

    def at(t):
        return vertex(x + t * 2, y + t)

    both_lines = make_geometry(F.lit("MULTILINESTRING"), F.lit(4326), F.array(
        F.array(F.array(at(F.lit(0)), at(F.lit(2)))), F.array(F.array(at(2 + key % 3), at(5 + key % 3)))))
    third = make_geometry(F.lit("LINESTRING"), F.lit(4326), F.array(F.array(
        F.array(at(key % 5 + 1 + key % 4), at(key % 5)))))
    return read(spark, sf_dir, "orders").filter(st_contains(both_lines, third)).select("o_orderkey")


@query("SELECT c_custkey, 5000.0 AS nearest, 5000.0 AS farthest FROM customer")
def geo_buffer_metres(spark, sf_dir):
    """A 5 km buffer around every site: how far its vertices lie from the site, in whole metres."""
    out = spatial.buffer(sites(spark, sf_dir), distance=5000.0, columns=["c_custkey", "geometry"])
    ring = out.select("c_custkey", "geometry", F.explode(F.flatten(F.flatten(F.col("buffer")["parts"]))).alias("v"))
    # a step of its own, as the kernel takes plain columns
    placed = settle(ring.select("c_custkey", "geometry", st_point(F.col("v.x"), F.col("v.y")).alias("vertex")), "vertex")
    away = placed.withColumn("away", distance_m(F.col("geometry"), F.col("vertex"), "spheroid", "POINT", "POINT"))
    return away.groupBy("c_custkey").agg((F.round(F.min("away")) + 0.0).alias("nearest"),
                                         (F.round(F.max("away")) + 0.0).alias("farthest"))


# The conic plane 2154.
SQL_CONIC = """
k AS (SELECT sqrt((1 / 298.257222101) * (2 - 1 / 298.257222101)) AS e),
m AS (SELECT e, cos(radians(44.0)) / sqrt(1 - (e * sin(radians(44.0))) ** 2) AS m1,
             cos(radians(49.0)) / sqrt(1 - (e * sin(radians(49.0))) ** 2) AS m2,
             atanh(sin(radians(44.0))) - e * atanh(e * sin(radians(44.0))) AS q1,
             atanh(sin(radians(49.0))) - e * atanh(e * sin(radians(49.0))) AS q2,
             atanh(sin(radians(46.5))) - e * atanh(e * sin(radians(46.5))) AS q0 FROM k),
c AS (SELECT e, q0, ln(m1 / m2) / (q2 - q1) AS n, m1, q1 FROM m),
p AS (SELECT e, n, 6378137.0 * m1 * exp(n * q1) / n AS r, 6378137.0 * m1 * exp(n * q1) / n * exp(-n * q0) AS r0 FROM c),
t AS (SELECT c_custkey, n, r0, x, r * exp(-n * (atanh(sin(radians(y))) - e * atanh(e * sin(radians(y))))) AS d
      FROM sites, p)"""


@query(f"""
WITH {SQL_SITES}, {SQL_CONIC}
SELECT c_custkey, round(700000.0 + d * sin(a), 1) + 0.0 AS x, round(6600000.0 + r0 - d * cos(a), 1) + 0.0 AS y
FROM (SELECT *, n * radians((x - 3.0 + 180 + 360) % 360 - 180) AS a FROM t) q""")
def geo_transform_2154(spark, sf_dir):
    """A conformal conic plane."""
    out = spatial.transform(sites(spark, sf_dir), 2154, columns=["c_custkey"])
    v = first_vertex(F.col("geometry_transformed"))
    return out.select("c_custkey", (F.round(v["x"], 1) + 0.0).alias("x"), (F.round(v["y"], 1) + 0.0).alias("y"))


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey, round(6378137.0 * radians(x), 2) + 0.0 AS x,
       round(6378137.0 * ln(tan(pi() / 4 + radians(y) / 2)), 2) + 0.0 AS y FROM sites""")
def geo_transform_3857(spark, sf_dir):
    out = spatial.transform(sites(spark, sf_dir), 3857, columns=["c_custkey"])
    v = first_vertex(F.col("geometry_transformed"))
    return out.select("c_custkey", (F.round(v["x"], 2) + 0.0).alias("x"),
                      (F.round(v["y"], 2) + 0.0).alias("y"))


@query("""
SELECT l_orderkey, l_linenumber, 'POLYGON' AS kind, 3857 AS srid, 5 AS n_vertices,
       CAST((l_quantity + 1) * (l_linenumber + 2) AS DOUBLE) AS area FROM lineitem""")
def wkt_parse(spark, sf_dir):
    """Parse a column of WKT text."""
    x, y = F.col("l_partkey"), F.col("l_suppkey")
    w = x + F.col("l_quantity").cast("long") + 1
    h = y + F.col("l_linenumber") + 2
    text = F.format_string("SRID=3857;POLYGON((%d %d, %d %d, %d %d, %d %d, %d %d))",
                           x, y, w, y, w, h, x, h, x, y)
    g = F.col("g")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t"))
    return spatial.settle(lines.withColumn("g", st_from_wkt(F.col("t"))), "g").select(
        "l_orderkey", "l_linenumber", g["kind"].alias("kind"), g["srid"].alias("srid"),
        F.size(g["parts"][0][0]).alias("n_vertices"), st_area(g).alias("area"))


@query("""
SELECT c_custkey, 'POINT(' || (c_custkey % 180) || ' ' || (c_custkey % 90) || '.5)' AS wkt,
       CAST(c_custkey % 180 AS DOUBLE) AS x, CAST(c_custkey % 90 AS DOUBLE) + 0.5 AS y
FROM customer""")
def geojson_parse(spark, sf_dir):
    """Parse GeoJSON, write it again, parse that, and show it as WKT."""
    key = F.col("c_custkey")
    text = F.format_string('{"type":"Point","coordinates":[%d,%d.5]}', key % 180, key % 90)
    g = st_from_geojson(st_as_geojson(st_from_geojson(text)))
    v = first_vertex(F.col("g"))
    return read(spark, sf_dir, "customer").select("c_custkey", g.alias("g")).select(
        "c_custkey", st_as_wkt(F.col("g")).alias("wkt"), v["x"].alias("x"), v["y"].alias("y"))


# --- tables -----------------------------------------------------------------------

@query(f"""
WITH {SQL_SITES}, {SQL_DEPOTS}, {SQL_YARDS}, {SQL_PATHS}
SELECT 'POINT' AS geometry_type, 4326 AS srid, count(*) AS n, 0 AS dimension, min(x) AS xmin,
       min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM sites
UNION ALL SELECT 'POLYGON', 4326, count(*), 2, min(x), min(y), max(x1), max(y1) FROM yards
UNION ALL SELECT 'LINESTRING', 4326, count(*), 1, min(least(xa, xb)), min(least(ya, yb)),
       max(greatest(xa, xb)), max(greatest(ya, yb)) FROM paths""")
def geometry_profile(spark, sf_dir):
    """Profile of a geometry column that mixes points, lines and polygons."""
    mixed = (sites(spark, sf_dir).select("geometry")
             .unionByName(yards(spark, sf_dir).select("geometry"))
             .unionByName(paths(spark, sf_dir).select("geometry")))
    return spatial.geometry_profile(mixed)


@query(f"""
WITH {SQL_SITES}, {SQL_PLOTS}
SELECT c_custkey, c_name, x, y, (x1 - x + y1 - y) * 2 AS border FROM plots""")
def geo_roundtrip(spark, sf_dir):
    """Write a geometry table and read it back."""
    path = f"{workspace(spark, 'geo').root}/plots"
    geotables.write_geometry(plots(spark, sf_dir), path)
    back = geotables.read_geometry(spark, path)
    v = first_vertex(F.col("geometry"))
    return back.select("c_custkey", "c_name", v["x"].alias("x"), v["y"].alias("y"),
                       st_perimeter(F.col("geometry")).alias("border"))


@query(f"""
WITH {SQL_PATHS}
SELECT o_orderkey, xa, ya, xb, yb FROM paths
WHERE least(xa, xb) <= 30 AND greatest(xa, xb) >= 10 AND least(ya, yb) <= 25
  AND greatest(ya, yb) >= 5""")
def geo_layout_query(spark, sf_dir):
    """Box query over a clustered geometry table."""
    path = f"{workspace(spark, 'layout').root}/paths"
    geotables.write_geometry(paths(spark, sf_dir), path)
    hit = geotables.read_geometry(spark, path, within=(10.0, 5.0, 30.0, 25.0))
    ring = F.col("geometry.parts")[0][0]
    return hit.select("o_orderkey", ring[0]["x"].alias("xa"), ring[0]["y"].alias("ya"),
                      ring[1]["x"].alias("xb"), ring[1]["y"].alias("yb"))


@query("""
SELECT CASE WHEN c_custkey % 3 = 1 THEN 3857 ELSE 4326 END AS srid, count(*) AS n
FROM customer GROUP BY 1""")
def set_missing_srid(spark, sf_dir):
    """Geometries without a reference system get one; others keep theirs."""
    key, g = F.col("c_custkey"), F.col("geometry")
    mixed = sites(spark, sf_dir).withColumn(
        "geometry", F.when(key % 3 == 0, set_srid(g, 0)).when(key % 3 == 1, set_srid(g, 3857))
        .otherwise(g))
    fixed = spatial.set_missing_srid(mixed, 4326)
    return fixed.groupBy(F.col("geometry.srid").alias("srid")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {SQL_PATHS}
SELECT o_orderkey, round(abs(xb - xa) * abs(yb - ya), 6) AS area FROM paths""")
def geo_envelope(spark, sf_dir):
    """Bounding rectangle of every path."""
    return paths(spark, sf_dir).select(
        "o_orderkey", F.round(st_area(st_envelope(F.col("geometry"))), 6).alias("area"))


@query(f"""
WITH {SQL_SITES}
SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN 1.5 ELSE x END AS x,
  CASE WHEN c_custkey % 10 = 0 THEN 2.5 ELSE y END AS y FROM sites WHERE c_custkey % 7 <> 0""")
def geo_write_modes(spark, sf_dir):
    """A geometry table: written, appended to, upserted by key, deleted from."""
    tables, name = workspace(spark, "geotable"), fresh_name("sites")
    every = sites(spark, sf_dir).select("c_custkey", "c_name", "geometry")
    geotables.write_geometry_table(tables, every.limit(0), name)
    geotables.write_geometry_table(tables, every.filter("c_custkey % 2 = 0"), name, "replace", "c_custkey")
    geotables.write_geometry_table(tables, every.filter("c_custkey % 2 = 1"), name, "append")
    moved = every.filter("c_custkey % 10 = 0").withColumn("geometry", st_point(F.lit(1.5), F.lit(2.5)))
    tables.upsert(geotables.geometry_frame(moved, layout=False), name, "c_custkey")
    tables.delete(name, "c_custkey % 7 = 0")
    try:
        geotables.write_geometry_table(tables, every, name)
    except ValueError:
        v = first_vertex(F.col("geometry"))
        return geotables.read_geometry_table(spark, query=f"SELECT * FROM {name}").select(
            "c_custkey", "c_name", v["x"].alias("x"), v["y"].alias("y"))
    raise AssertionError("an existing table is not written over")
