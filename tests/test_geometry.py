from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import geodesic, geometry as G, geotext as X, projections as P
from tidemark.operators import grid, spatial, spatial_join

WKT = [
    "POINT(1 2)", "LINESTRING(0 0,3 4)", "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1))",
    "MULTIPOINT((1 1),(2 2))", "MULTILINESTRING((0 0,1 1),(2 2,3 3.5))",
    "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((5 5,6 5,6 6,5 6,5 5)))",
]


def lit(wkt):
    return X.literal_geometry(wkt=wkt)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def geo(spark, items):
    return spark.createDataFrame(items, "id int, w string").select(
        "id", X.st_from_wkt(F.col("w")).alias("geometry"))


@pytest.fixture
def points(spark):
    return geo(spark, [(1, "POINT(0 0)"), (2, "POINT(0.1 0.1)"), (3, "POINT(10 10)")])


@pytest.fixture
def polygons(spark):
    return geo(spark, [(1, "POLYGON((0 0,1 0,1 1,0 1,0 0))"), (2, "POLYGON((5 5,6 5,6 6,5 6,5 5))")])


# --- text forms -------------------------------------------------------------------

def test_text_forms_round_trip(spark):
    df = spark.createDataFrame([(w,) for w in WKT] + [(None,)], "w string")
    g = X.st_from_wkt(F.col("w"))
    df = df.withColumn("g", g).withColumn("wkb", X.st_as_wkb(F.col("g")))
    out = df.select(
        "w", X.st_as_wkt(F.col("g")).alias("again"),
        F.col("g").eqNullSafe(X.st_from_wkb(F.col("wkb"))).alias("wkb_same"),
        F.col("g").eqNullSafe(X.st_from_geojson(X.st_as_geojson(F.col("g")))).alias("json_same"))
    for r in out.collect():
        assert r.again == r.w and r.wkb_same and r.json_same


def test_literals_equal_parsed_columns(spark):
    for w in [*WKT, "SRID=3857;POINT(.5 -1e3)", "MULTIPOINT(1 1, 2 2)"]:
        df = spark.createDataFrame([(w,)], "w string")
        assert df.select((X.st_from_wkt(F.col("w")) == lit(w)).alias("same")).first().same, w
    doc = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    assert value(spark, X.st_as_wkt(X.literal_geometry(geojson=doc))) == "POLYGON((0 0,1 0,1 1,0 0))"


def test_bad_text(spark):
    with pytest.raises(ValueError):
        X.shape(wkt="CIRCLE(0 0, 1)")
    with pytest.raises(ValueError):
        X.shape(point=(0, 0), wkt="POINT(0 0)")
    with pytest.raises(ValueError):
        X.shape()
    with pytest.raises(Exception, match="not a supported WKT"):
        value(spark, X.st_as_wkt(X.st_from_wkt(F.lit("POINT EMPTY"))))


# --- predicates -------------------------------------------------------------------

SQUARE = "POLYGON((0 0,4 0,4 4,0 4,0 0))"
RING = "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,3 1,3 3,1 3,1 1))"
CONTAINS = [
    (SQUARE, "POINT(1 1)", True), (SQUARE, "POINT(0 1)", False), (SQUARE, "POINT(5 1)", False),
    (RING, "POINT(2 2)", False), (RING, "POINT(1 2)", False), (RING, "POINT(0.5 2)", True),
    (SQUARE, "LINESTRING(1 1,2 2)", True), (SQUARE, "LINESTRING(0 0,4 0)", False),
    (SQUARE, "LINESTRING(0 0,4 4)", True), (SQUARE, "LINESTRING(1 1,5 1)", False),
    (RING, "LINESTRING(0.5 2,3.5 2)", False), (SQUARE, SQUARE, True),
    (SQUARE, "POLYGON((1 1,2 1,2 2,1 2,1 1))", True),
    (SQUARE, "POLYGON((3 3,5 3,5 5,3 5,3 3))", False),
    (RING, "POLYGON((1 1,3 1,3 3,1 3,1 1))", False), (RING, SQUARE, False), (SQUARE, RING, True),
    (RING, "POLYGON((0.5 0.5,3.5 0.5,3.5 3.5,0.5 3.5,0.5 0.5),(1 1,3 1,3 3,1 3,1 1))", True),
    ("POLYGON((0 0,4 0,4 4,0 4,0 0),(2 0.5,3.5 2,2 3.5,0.5 2,2 0.5))",
     "POLYGON((0.5 0.5,3.5 0.5,3.5 3.5,0.5 3.5,0.5 0.5))", False),
    ("POLYGON((0 0,4 0,4 4,2 1,0 4,0 0))", "LINESTRING(0 3.9,4 3.9)", False),
    ("LINESTRING(0 0,4 4)", "POINT(2 2)", True), ("LINESTRING(0 0,4 4)", "POINT(0 0)", False),
    ("POINT(1 1)", "POINT(1 1)", True), ("POINT(1 1)", SQUARE, False),
    (SQUARE, "MULTIPOINT((0 0),(1 1))", True), (SQUARE, "MULTIPOINT((0 0),(4 4))", False),
]
INTERSECTS = [
    (SQUARE, "POINT(0 1)", True), (SQUARE, "POINT(4.1 1)", False), (RING, "POINT(2 2)", False),
    (SQUARE, "LINESTRING(-1 -1,5 5)", True), (SQUARE, "LINESTRING(-1 5,5 5)", False),
    (SQUARE, "LINESTRING(4 4,5 5)", True), (RING, "LINESTRING(1.5 2,2.5 2)", False),
    (SQUARE, "POLYGON((1 1,2 1,2 2,1 1))", True), ("POLYGON((1 1,2 1,2 2,1 1))", SQUARE, True),
    (RING, "POLYGON((1.5 1.5,2.5 1.5,2.5 2.5,1.5 1.5))", False),
    ("LINESTRING(0 0,2 2)", "LINESTRING(0 2,2 0)", True),
    ("LINESTRING(0 0,1 1)", "LINESTRING(2 2,3 3)", False), ("POINT(1 1)", "POINT(1 1)", True),
    ("LINESTRING(0 0,2 2)", "POINT(1 1)", True),
    ("MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))", "POINT(5.5 5.2)", True),
]


@pytest.mark.parametrize("kernel,cases", [("st_contains", CONTAINS), ("st_intersects", INTERSECTS)])
def test_predicates(spark, kernel, cases):
    test = getattr(G, kernel)
    df = spark.createDataFrame([(i, a, b, w) for i, (a, b, w) in enumerate(cases)],
                               "i int, a string, b string, want boolean")
    df = df.select("i", "want", X.st_from_wkt(F.col("a")).alias("a"),
                   X.st_from_wkt(F.col("b")).alias("b"))
    out = df.select("i", "want", test(F.col("a"), F.col("b")).alias("got")).collect()
    assert [cases[r.i] for r in out if r.got != r.want] == []


LINES_IN_LINES = [
    ("LINESTRING(0 0,1 1)", "LINESTRING(0 0,1 1)", True), ("LINESTRING(0 0,4 4)", "LINESTRING(3 3,1 1)", True),
    ("LINESTRING(0 0,4 4)", "LINESTRING(3 3,5 5)", False), ("LINESTRING(0 0,4 0,4 4)", "LINESTRING(2 0,4 0,4 1)", True),
    ("LINESTRING(0 0,4 0,4 4)", "LINESTRING(2 0,4 2)", False),
    ("MULTILINESTRING((0 0,2 0),(2 0,5 0))", "LINESTRING(1 0,4 0)", True),
    ("MULTILINESTRING((0 0,2 0),(3 0,5 0))", "LINESTRING(1 0,4 0)", False),
    ("LINESTRING(0 0,2 0,1 0,5 0)", "MULTILINESTRING((0 0,1 0),(4 0,5 0))", True),
    ("LINESTRING(0 0,0 4)", "LINESTRING(0 1,0 1)", False), ("LINESTRING(0 0,4 0)", "LINESTRING(1 1,3 1)", False),
]


def test_lines_in_lines_by_brute_force(spark):
    """Random lattice paths: a path is held if all its half steps are among the other's."""
    rng = random.Random(17)

    def walk(n):
        x, y = rng.randrange(3), rng.randrange(3)
        out = [(x, y)]
        while len(out) < n:
            dx, dy = rng.choice(((1, 0), (0, 1), (-1, 0), (0, -1), (2, 0), (0, 2)))
            x, y = x + dx, y + dy
            out.append((x, y))
        return out

    def steps(path):
        out = set()
        for (x1, y1), (x2, y2) in zip(path, path[1:]):
            n = max(abs(x2 - x1), abs(y2 - y1))
            dots = [(x1 + (x2 - x1) * k // n, y1 + (y2 - y1) * k // n) for k in range(n + 1)]
            out |= {frozenset(s) for s in zip(dots, dots[1:])}
        return out

    def wkt(path):
        return f"LINESTRING({','.join(f'{x} {y}' for x, y in path)})"

    cases = list(LINES_IN_LINES)
    for _ in range(300):
        a, b = walk(rng.randrange(6, 30)), walk(rng.randrange(2, 4))
        cases.append((wkt(a), wkt(b), steps(b) <= steps(a)))
    assert {w for *_, w in cases[len(LINES_IN_LINES):]} == {True, False}
    df = spark.createDataFrame([(i, a, b, w) for i, (a, b, w) in enumerate(cases)], "i int, a string, b string, want boolean")
    df = df.select("i", "want", X.st_from_wkt(F.col("a")).alias("a"), X.st_from_wkt(F.col("b")).alias("b"))
    out = df.select("i", "want", G.st_contains(F.col("a"), F.col("b")).alias("got")).collect()
    assert [cases[r.i] for r in out if r.got != r.want] == []


# --- measures ---------------------------------------------------------------------

def test_planar_measures(spark):
    assert value(spark, G.st_area(lit(RING))) == 12
    assert value(spark, G.st_perimeter(lit(RING))) == 24
    assert value(spark, G.st_perimeter(lit("LINESTRING(0 0,3 4)"))) == 0
    assert tuple(value(spark, G.st_centroid(lit(RING)))) == pytest.approx((2, 2))
    assert tuple(value(spark, G.st_centroid(lit("LINESTRING(0 0,2 0,2 2)")))) == (1.5, 0.5)
    assert value(spark, G.st_distance(lit(SQUARE), lit("POINT(7 8)"))) == 5
    assert value(spark, G.st_distance(lit(SQUARE), lit("POINT(1 1)"))) == 0
    assert value(spark, G.st_distance(lit("LINESTRING(0 0,0 9)"), lit("LINESTRING(3 1,8 1)"))) == 3
    assert value(spark, G.st_intersection_area(lit(RING), lit(
        "POLYGON((2 2,6 2,6 6,2 6,2 2))"))) == pytest.approx(3)


def test_intersection_area_of_crossing_triangles(spark):
    a, b = "POLYGON((0 0,4 0,2 3,0 0))", "POLYGON((0 2,4 2,2 -1,0 2))"
    rng = np.random.default_rng(1)
    p = rng.uniform([0, -1], [4, 3], (400_000, 2))
    in_a = (p[:, 1] > 0) & (p[:, 1] < 1.5 * p[:, 0]) & (p[:, 1] < 1.5 * (4 - p[:, 0]))
    in_b = (p[:, 1] < 2) & (p[:, 1] > 2 - 1.5 * p[:, 0]) & (p[:, 1] > 2 - 1.5 * (4 - p[:, 0]))
    assert value(spark, G.st_intersection_area(lit(a), lit(b))) == pytest.approx(
        16 * (in_a & in_b).mean(), rel=0.01)


def test_buffers(spark):
    square = value(spark, G.st_area(G.st_buffer(lit("POLYGON((0 0,2 0,2 2,0 2,0 0))"), 1.0)))
    corner = 16 * math.sin(2 * math.pi / 32)
    assert square == pytest.approx(4 + 8 + corner)
    line = value(spark, G.st_area(G.st_buffer(lit("LINESTRING(0 0,0 5)"), 1.0)))
    assert line == pytest.approx(10 + corner)
    with pytest.raises(Exception, match="buffer supports"):
        value(spark, G.st_buffer(X.st_from_wkt(F.lit("LINESTRING(0 0,1 1,0 2)")), 1.0))


def test_spheroid_known_values(spark, points):
    length, _ = geodesic.inverse([0.0, 0.0], [0.0, 0.0], [1.0, 0.0], [0.0, 1.0])
    assert length[0] == pytest.approx(111319.4908, abs=1e-3)
    assert length[1] == pytest.approx(110574.3886, abs=1e-3)
    # Paris to New York
    length, _ = geodesic.inverse([2.3522], [48.8566], [-74.006], [40.7128])
    assert length[0] == pytest.approx(5852935, abs=2000)
    near = spatial.dwithin(points, point=(0, 0), distance=20_000, columns=["id"])
    assert rows_of(near) == [(1,), (2,)]
    assert rows_of(spatial.nearest(points, k=2, point=(0, 0), columns=["id"])) == [(1,), (2,)]


@settings(max_examples=60, deadline=None)
@given(st.floats(-180, 180), st.floats(-89, 89), st.floats(-180, 180), st.floats(-89, 89))
def test_inverse_and_direct_agree(lon1, lat1, lon2, lat2):
    length, azimuth = geodesic.inverse([lon1], [lat1], [lon2], [lat2])
    lon, lat = geodesic.direct(np.array([lon1]), np.array([lat1]), azimuth, length)
    gap, _ = geodesic.inverse(lon, lat, [lon2], [lat2])
    assert gap[0] < 0.01


def test_spheroid_area(spark):
    # a one-degree cell at the equator, and an eighth of the ellipsoid
    cell = geo(spark, [(1, "POLYGON((0 0,1 0,1 1,0 1,0 0))"), (2, "POLYGON((0 0,90 0,0 90,0 0))"),
                       (3, "POLYGON((0 60,90 60,180 60,270 60,0 60))"), (4, "POINT(0 0)")])
    area = {r.id: r.area for r in spatial.area(cell, columns=["id"]).collect()}
    assert area[1] == pytest.approx(12308778361.469, rel=1e-6)
    assert area[2] == pytest.approx(510065621724088.44 / 8, rel=1e-9)
    assert 0 < area[3] < 510065621724088 / 10
    assert area[4] == 0
    border = {r.id: r.perimeter for r in spatial.perimeter(cell, columns=["id"]).collect()}
    assert border[1] == pytest.approx(443770.917, rel=1e-5)


def test_distance_to_areas_in_metres(spark, polygons):
    out = {r.id: r.distance for r in spatial.distance(polygons, point=(0.5, 0.5),
                                                      columns=["id"]).collect()}
    assert out[1] == 0
    corner, _ = geodesic.inverse([0.5], [0.5], [5.0], [5.0])
    assert out[2] == pytest.approx(corner[0])
    sphere = {r.id: r.distance for r in spatial.distance(
        polygons, point=(0.5, 0.5), model="sphere", columns=["id"]).collect()}
    assert sphere[2] == pytest.approx(out[2], rel=0.006)


def test_metre_buffer_has_the_right_area(spark, points):
    out = spatial.buffer(points, distance=1000, columns=["id"]).select(
        "id", F.col("buffer").alias("geometry"))
    for r in spatial.area(out, columns=["id"]).collect():
        assert r.area == pytest.approx(16 * math.sin(2 * math.pi / 32) * 1e6, rel=1e-4)


def test_transform(spark):
    there = P.st_transform(X.st_from_wkt(F.lit("POINT(2.2945 48.8582)")), 32631)
    x, y = value(spark, G.first_vertex(there))
    assert (x, y) == pytest.approx((448251.8, 5411932.7), abs=0.5)
    x, y = value(spark, G.first_vertex(P.st_transform(P.st_transform(there, 3857), 4326)))
    assert (x, y) == pytest.approx((2.2945, 48.8582), abs=1e-9)
    with pytest.raises(ValueError):
        P.st_transform(lit("POINT(0 0)"), 27700)
    with pytest.raises(Exception, match="unsupported source SRID"):
        value(spark, P.st_transform(X.st_from_wkt(F.lit("SRID=27700;POINT(0 0)")), 3857))


@pytest.mark.parametrize("srid,lonlat,plane", [
    (2154, (2.2945, 48.8584), (648237.3, 6862271.7)), (2154, (3.0, 46.5), (700000.0, 6600000.0)),
    (3035, (5.0, 50.0), (3962799.45, 2999718.85)), (3035, (10.0, 52.0), (4321000.0, 3210000.0)),
    (3031, (50.0, -75.0), (1255380.79, 1053389.56))])
def test_planes_at_known_points(spark, srid, lonlat, plane):
    there = P.st_transform(G.st_point(F.lit(lonlat[0]), F.lit(lonlat[1])), srid)
    assert value(spark, G.first_vertex(there)) == pytest.approx(plane, abs=2.0 if srid == 2154 else 0.01)


@pytest.mark.parametrize("srid", [2154, 3035, 3031, 3413])
def test_planes_come_back(spark, srid):
    side = -1 if srid == 3031 else 1
    df = spark.range(60).select((F.col("id") * 0.7 - 12).alias("x"), (side * (F.col("id") * 0.55 + 41)).alias("y"))
    there = P.st_transform(G.st_point(F.col("x"), F.col("y")), srid)
    back = G.first_vertex(P.st_transform(there, 4326))
    far = df.select(F.greatest(F.abs(back["x"] - F.col("x")), F.abs(back["y"] - F.col("y"))).alias("d"))
    assert far.agg(F.max("d")).first()[0] < 1e-8  # under a millimetre or so


# --- queries and joins ------------------------------------------------------------

def test_contains_point(polygons):
    assert rows_of(spatial.contains(polygons, point=(0.5, 0.5), columns=["id"])) == [(1,)]
    with pytest.raises(ValueError):
        spatial.contains(polygons)
    with pytest.raises(ValueError):
        spatial.dwithin(polygons, point=(0, 0), distance=1, unit="mile")
    with pytest.raises(ValueError):
        spatial.nearest(polygons, point=(0, 0), k=0)


def _random_polygon(rng):
    x, y, r = rng.uniform(-50, 50), rng.uniform(-50, 50), 10 ** rng.uniform(-1, 1.3)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randrange(3, 8)))
    ring = [(x + r * math.cos(a), y + r * math.sin(a)) for a in angles]
    return "POLYGON((" + ",".join(f"{px!r} {py!r}" for px, py in [*ring, ring[0]]) + "))"


@pytest.mark.parametrize("small", [True, False])
def test_grid_joins_equal_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(grid, "fits_broadcast", lambda df: False)
        split = grid.salt_hot_cells
        monkeypatch.setattr(grid, "salt_hot_cells", lambda left, right, hot_rows: split(left, right, 3))
    rng = random.Random(11)
    areas = geo(spark, [(i, _random_polygon(rng)) for i in range(40)])
    spots = geo(spark, [(i, f"POINT({rng.uniform(-60, 60)!r} {rng.uniform(-60, 60)!r})")
                        for i in range(150)] + [(150 + i, "POINT(1.5 2.5)") for i in range(20)])
    cross = spots.alias("a").crossJoin(areas.alias("b"))
    ga, gb = F.col("a.geometry"), F.col("b.geometry")
    ids = ["a.id", "b.id"]

    inside = rows_of(cross.filter(G.st_contains(gb, ga)).select(*ids))
    assert inside and rows_of(spatial_join.within_join(spots, areas, columns=ids)) == inside
    assert rows_of(spatial_join.within_join(spots, areas, columns=ids, points=True)) == inside
    kept = {(i,) for i, _ in inside}
    contained = spatial_join.contains_ref(spots, areas).select("id")
    assert rows_of(contained) == rows_of(spark.createDataFrame(kept, "id int"))
    touching = sorted({(r[0],) for r in cross.filter(G.st_intersects(ga, gb)).select(*ids).collect()})
    for points in (True, False):
        got = spatial_join.intersects_ref(spots, areas, points=points).select("id")
        assert rows_of(got) == rows_of(spark.createDataFrame(touching, "id int"))

    pairs = areas.alias("a").crossJoin(areas.alias("b")).filter(
        (F.col("a.id") < F.col("b.id")) & G.st_intersects(ga, gb)).select(*ids)
    assert rows_of(spatial_join.overlap_pairs(areas, "id", columns=ids)) == rows_of(pairs)

    near = cross.filter(G.st_distance(ga, gb) <= 2.5).select(*ids)
    assert rows_of(spatial_join.dwithin_pairs(spots, areas, 2.5, unit="srid", points=True).select(*ids)) == (
        rows_of(near))


@pytest.mark.parametrize("model", ["sphere", "spheroid"])
def test_metre_joins_cross_the_antimeridian_and_poles(spark, model):
    rng = random.Random(5)
    spots = geo(spark, [(i, f"POINT({rng.choice([-179.9, 179.8, 10, 100])} {rng.uniform(-89, 89)!r})")
                        for i in range(80)])
    marks = geo(spark, [(i, w) for i, w in enumerate([
        "POINT(179.9 10)", "POINT(-179.5 -40)", "POINT(0 89.5)", "LINESTRING(170 60,179.9 60)",
        "POLYGON((95 -10,105 -10,105 10,95 10,95 -10))"])])
    cross = spots.alias("a").crossJoin(marks.alias("b")).select(
        F.col("a.id").alias("i"), F.col("b.id").alias("j"), F.col("a.geometry").alias("ga"),
        F.col("b.geometry").alias("gb"))
    far = geodesic.distance_m(F.col("ga"), F.col("gb"), model)
    settled = spatial.settle(spatial.settle(cross, "ga"), "gb")
    want = rows_of(settled.filter(far <= 900_000.0).select("i", "j"))
    got = spatial_join.dwithin_pairs(spots, marks, 900_000.0, model=model, points=True).select("a.id", "b.id")
    assert rows_of(got) == want and want
    kept = spatial_join.dwithin_ref(spots, marks, 900_000.0, model=model, points=True).select("id")
    assert rows_of(kept) == rows_of(spark.createDataFrame(sorted({(i,) for i, _ in want}), "i int"))


def test_points_promise_is_checked(spark, polygons):
    with pytest.raises(Exception, match="needs a column of points"):
        spatial_join.within_join(polygons, polygons, columns=["a.id"], points=True).collect()


def test_geometry_files_skip_by_box(spark, tmp_path, points):
    from tidemark.sources import geotables

    path = str(tmp_path / "points")
    geotables.write_geometry(points, path)
    hit = geotables.read_geometry(spark, path, within=(9, 9, 11, 11))
    assert rows_of(hit.select("id")) == [(3,)]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(geometry_xmin)" in plan
    bare = points.withColumn("geometry", G.set_srid(F.col("geometry"), 0))
    with pytest.raises(Exception, match="no SRID"):
        geotables.write_geometry(bare, str(tmp_path / "bare"))


def test_reference_systems_do_not_mix(spark):
    degrees, metres = G.st_point(F.lit(1.0), F.lit(2.0)), G.st_point(F.lit(1.0), F.lit(2.0), 3857)
    area = G.st_rectangle(F.lit(0.0), F.lit(0.0), F.lit(5.0), F.lit(5.0), 3857)
    one = spark.range(1)
    for wrong in (G.st_intersects(degrees, area), G.st_contains(area, degrees), G.st_distance(degrees, metres),
                  geodesic.distance_m(metres, metres, "sphere"), geodesic.distance_m(metres, metres),
                  geodesic.area_m2(area), geodesic.perimeter_m(area)):
        with pytest.raises(Exception, match="SRID"):
            one.select(wrong.alias("v")).collect()
    assert one.select(G.st_distance(metres, metres).alias("v")).first()["v"] == 0.0


@pytest.mark.parametrize("unit,distance", [("srid", 3.0), ("m", 400_000.0)])
def test_distance_joins_of_areas_and_lines(spark, unit, distance):
    """Any kind on either side, across the antimeridian too, each pair once."""
    rng = random.Random(5)
    left = geo(spark, [(i, _random_polygon(rng)) for i in range(15)] + [
        (50, "LINESTRING(-179 1, -170 3)"), (51, "LINESTRING(100 -60, 120 -65)"), (52, "POINT(3 4)")])
    right = geo(spark, [(i, _random_polygon(rng)) for i in range(15)] + [
        (60, "POINT(179.5 0.5)"), (61, "LINESTRING(118 -62, 119 -40)"), (62, "POLYGON((5 4, 6 4, 6 6, 5 4))")])
    cross = left.alias("a").crossJoin(right.alias("b"))
    ga, gb = F.col("a.geometry"), F.col("b.geometry")
    away = G.st_distance(ga, gb) if unit == "srid" else geodesic.sphere_distance(ga, gb)
    want = rows_of(cross.filter(away <= distance).select("a.id", "b.id"))
    got = spatial_join.dwithin_pairs(left, right, distance, unit=unit, model="sphere").select("a.id", "b.id")
    assert len(want) > 5 and rows_of(got) == want
    kept = spatial_join.dwithin_ref(left, right, distance, unit=unit, model="sphere").select("id")
    assert rows_of(kept) == sorted({(a,) for a, _ in want}, key=lambda r: str(r[0]))
