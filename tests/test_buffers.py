from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geometry as G
from tidemark.functions import geotext as X
from tidemark.functions.buffers import _signed_area, buffer_parts, shape_buffer
from tidemark.operators import spatial

ARC = 16 * math.sin(2 * math.pi / 32)  # area of the unit circle as the buffer draws it


def area(polygons):
    return sum(abs(_signed_area(ring[:-1])) * (-1 if i else 1) for p in polygons for i, ring in enumerate(p))


def gaps(points, edges):
    """Distance of each point from the nearest edge."""
    out = np.full(len(points), np.inf)
    for a, b in edges:
        a, r = np.array(a, float), np.array(b, float) - np.array(a, float)
        t = np.clip((points - a) @ r / (r @ r), 0, 1) if r.any() else np.zeros(len(points))
        out = np.minimum(out, np.hypot(*(points - a - t[:, None] * r).T))
    return out


def inside(points, polygons):
    out = np.zeros(len(points), bool)
    for ring in (r for p in polygons for r in p):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if y1 != y2:
                out ^= ((y1 <= points[:, 1]) != (y2 <= points[:, 1])) & (
                    x1 + (points[:, 1] - y1) * (x2 - x1) / (y2 - y1) > points[:, 0])
    return out


def check(kind, parts, d, seed):
    """Sampled points: those in the buffer are within ``d``, those out of it are farther than the arcs' chords
    (an arc rounds its turn to whole steps, so a chord spans at most one and a half)."""
    got = buffer_parts(kind, parts, d)
    xy = np.array([v for part in parts for ring in part for v in ring], float)
    points = np.random.default_rng(seed).uniform(xy.min(axis=0) - 1.5 * d, xy.max(axis=0) + 1.5 * d, (600, 2))
    away = gaps(points, [e for part in parts for r in part for e in (list(zip(r, r[1:])) or [(r[0], r[0])])])
    if kind.endswith("POLYGON"):
        away[inside(points, parts)] = 0
    held = inside(points, got)
    assert not (held & (away > d * (1 + 1e-7))).any()
    assert not (~held & (away < d * math.cos(1.5 * math.pi / 32) * (1 - 1e-7))).any()
    for polygon in got:
        assert all(ring[0] == ring[-1] and len(ring) > 3 for ring in polygon)
        assert _signed_area(polygon[0][:-1]) > 0 and all(_signed_area(hole[:-1]) < 0 for hole in polygon[1:])
    return got


@pytest.mark.parametrize("lattice", [True, False])
def test_paths_against_sampled_distances(lattice):
    rng = random.Random(3)
    for i in range(120):
        path = [(float(rng.randrange(8)), float(rng.randrange(8))) if lattice else (rng.uniform(0, 8), rng.uniform(0, 8))
                for _ in range(rng.randrange(1, 13))]
        check("LINESTRING", [[path]], rng.choice((0.25, 0.5, 0.7, 1.0, 2.0)), i)


def test_polygons_with_holes_against_sampled_distances():
    rng = random.Random(4)

    def star(cx, cy, low, high, n):
        corners = [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n))
                   for k in range(n) for r in [rng.uniform(low, high)]]
        return [*corners, corners[0]]

    for i in range(60):
        parts = [[star(0, 0, 5, 9, rng.randrange(4, 20)), star(0, 0, 1, 3, rng.randrange(3, 9))[::rng.choice((1, -1))]]]
        if i % 2:
            parts.append([star(rng.uniform(18, 22), 0, 2, 6, rng.randrange(3, 12))])
        check("MULTIPOLYGON" if i % 2 else "POLYGON", parts, rng.choice((0.1, 0.6, 1.5, 3.0)), i)


def test_areas_by_formula():
    corner = [[[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)]]]
    for d in (0.5, 1.0, 2.0):
        assert area(buffer_parts("POLYGON", corner, d)) == pytest.approx(12 + 16 * d + 5 / 4 * ARC * d * d - d * d)
    hole = [[[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (4, 6), (6, 6), (6, 4), (4, 4)]]]
    for d, holes in ((0.5, 1), (1.0, 0), (2.0, 0)):
        got = buffer_parts("POLYGON", hole, d)
        assert [len(p) for p in got] == [1 + holes]
        assert area(got) == pytest.approx(100 + 40 * d + ARC * d * d - max(0, 2 - 2 * d) ** 2)
    # far from the origin, as in metres of a plane
    far = [[[(x + 5e5, y + 5e6) for x, y in corner[0][0]]]]
    back = [[[(x - 5e5, y - 5e6) for x, y in ring] for ring in p] for p in buffer_parts("POLYGON", far, 1.0)]
    assert area(back) == pytest.approx(area(buffer_parts("POLYGON", corner, 1.0)), rel=1e-8)


def test_a_bend_of_two_vertices_a_step_apart_stays():
    """The two arms' buffers end on one place of the notch, where the grid of the cuts leaves two vertices."""
    x, y, o, d = -99.7, 35.7, 5.0, 2.0
    ring = [(x, y), (x + o, y), (x + o, y + 3), (x + 3, y + 3), (x + 3, y + o), (x, y + o), (x, y)]
    assert math.isclose(area(buffer_parts("POLYGON", [[ring]], d)), 21 + 20 * d + (5 / 4 * ARC - 1) * d ** 2, abs_tol=1e-6)


def test_a_long_path():
    """Two thousand edges, neighbours overlapping over and over."""
    rng = random.Random(5)
    path = [(math.cos(k / 50) * k + rng.random(), math.sin(k / 50) * k + rng.random()) for k in range(2000)]
    check("LINESTRING", [[path]], 5.0, 1)


def test_columns(spark):
    rows = [(1, "LINESTRING(0 0,1 1,0 2)", 0.3), (2, "MULTIPOINT((0 0),(5 0),(5.5 0))", 1.0), (3, "POINT(1 1)", 1.0),
            (4, "LINESTRING(0 0,0 5)", 1.0), (5, None, 1.0), (6, "LINESTRING(0 0,1 1,0 2)", None),
            (7, "POLYGON((0 0,2 0,2 2,0 2,0 0))", 0.0), (8, "LINESTRING(0 0,1 1,0 2)", 0.0),
            (9, "POLYGON((0 0,2 0,2 2,0 2,0 0))", 1.0)]
    df = spark.createDataFrame(rows, "id int, wkt string, d double").select(
        "id", "d", X.st_from_wkt(F.col("wkt")).alias("geometry"))
    df = spatial.settle(df, "geometry")
    wide = spatial.settle(df.select("id", shape_buffer(F.col("geometry"), F.col("d")).alias("b")), "b")
    got = {r["id"]: r for r in wide.select(
        "id", F.col("b")["kind"].alias("kind"), F.round(G.st_area(F.col("b")), 9).alias("area")).collect()}
    assert {i: r["kind"] for i, r in got.items()} == {
        1: "POLYGON", 2: "MULTIPOLYGON", 3: "POLYGON", 4: "POLYGON", 5: None, 6: None, 7: "POLYGON", 8: None, 9: "POLYGON"}
    assert got[3]["area"] == pytest.approx(ARC) and got[4]["area"] == pytest.approx(10 + ARC)
    assert got[7]["area"] == 4 and got[9]["area"] == pytest.approx(4 + 8 + ARC)
    with pytest.raises(Exception, match="negative"):
        df.select(shape_buffer(F.col("geometry"), F.lit(-1.0)).alias("b")).collect()


def test_metres(spark):
    """Concave polygons, bent lines and point sets in metres; names of internal columns stay the caller's."""
    rows = [(1, "POLYGON((2 48,2.04 48,2.04 48.02,2.02 48.02,2.02 48.04,2 48.04,2 48))"),
            (2, "LINESTRING(2 -48,2.01 -48.01,2.02 -48)"), (3, "MULTIPOINT((2 10),(2.5 10))"), (4, "POINT(2 10)"), (5, None)]
    df = spark.createDataFrame(rows, "id int, wkt string").select(
        "id", X.st_from_wkt(F.col("wkt")).alias("geometry"), F.lit("a").alias("_flat"), F.lit("b").alias("_circle"))
    out = spatial.buffer(df, distance=1000.0)
    assert out.columns == ["id", "geometry", "_flat", "_circle", "buffer"]
    got = {r["id"]: r for r in out.collect()}
    assert {(r["_flat"], r["_circle"]) for r in got.values()} == {("a", "b")}
    assert got[5]["buffer"] is None and got[3]["buffer"]["kind"] == "MULTIPOLYGON"
    vertices = out.select("id", "geometry", F.explode(F.flatten(F.flatten(F.col("buffer")["parts"]))).alias("v"))
    placed = spatial.settle(vertices.select("id", "geometry", G.st_point(F.col("v.x"), F.col("v.y")).alias("at")), "at")
    from tidemark.functions.geodesic import distance_m

    away = placed.select("id", distance_m(F.col("geometry"), F.col("at")).alias("m")).groupBy("id").agg(
        F.min("m").alias("least"), F.max("m").alias("most")).collect()
    assert len(away) == 4
    for r in away:  # within the scale of the zone and the chords at a bend
        assert 990 < r["least"] and r["most"] < 1003
