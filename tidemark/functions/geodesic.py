"""Measures in metres on the WGS 84 spheroid and on its mean sphere.

Sphere distances are native columns.  Spheroid measures run in Arrow functions that
work on all edges of a batch at once with numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geometry import (
    DEFAULT_SRID,
    MULTIPOLYGON,
    POINT,
    POLYGON,
    RING,
    both,
    choose,
    circle_offsets,
    first_vertex,
    is_areal,
    is_puntal,
    let,
    of_kind,
    segments,
)

# WGS 84 spheroid and the mean radius (2a + b) / 3.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
SPHERE_RADIUS = 6371008.771415059
# The spheroid distance differs from the sphere distance by less than this share.
SPHERE_SLACK = 0.006
MODELS = ("spheroid", "sphere")


# --- sphere, native ---------------------------------------------------------------

def haversine(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = (p2 - p1) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.sin(dp) * F.sin(dp) + F.cos(p1) * F.cos(p2) * F.sin(dl) * F.sin(dl)
    return F.lit(2 * SPHERE_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def _unit(lon: Column, lat: Column) -> Column:
    lo, la = F.radians(lon), F.radians(lat)
    return F.struct((F.cos(la) * F.cos(lo)).alias("x"), (F.cos(la) * F.sin(lo)).alias("y"),
                    F.sin(la).alias("z"))


def _cross(u: Column, v: Column) -> Column:
    return F.struct((u["y"] * v["z"] - u["z"] * v["y"]).alias("x"),
                    (u["z"] * v["x"] - u["x"] * v["z"]).alias("y"),
                    (u["x"] * v["y"] - u["y"] * v["x"]).alias("z"))


def _dot(u: Column, v: Column) -> Column:
    return u["x"] * v["x"] + u["y"] * v["y"] + u["z"] * v["z"]


def nearest_on_arc(s: Column, lon: Column, lat: Column) -> Column:
    """Point of a great-circle segment nearest to (lon, lat), as ``struct<x, y>``."""
    start = F.struct(s["x1"].alias("x"), s["y1"].alias("y"))
    end = F.struct(s["x2"].alias("x"), s["y2"].alias("y"))

    def with_normal(u):
        def on_circle(n):
            a, b, p = u["a"], u["b"], u["p"]
            # foot of the perpendicular on the segment's great circle
            off = F.coalesce(F.try_divide(_dot(p, n), _dot(n, n)), F.lit(0.0))

            def choose(q):
                foot = F.struct(
                    F.degrees(F.atan2(q["y"], q["x"])).alias("x"),
                    F.degrees(F.atan2(q["z"], F.sqrt(q["x"] * q["x"] + q["y"] * q["y"])))
                    .alias("y"))
                inside = (_dot(_cross(n, a), q) >= 0) & (_dot(_cross(b, n), q) >= 0)
                return (F.when((_dot(n, n) > 1e-24) & inside, foot)
                        .when(_dot(a, p) >= _dot(b, p), start).otherwise(end))

            return let(F.struct((p["x"] - off * n["x"]).alias("x"),
                                (p["y"] - off * n["y"]).alias("y"),
                                (p["z"] - off * n["z"]).alias("z")), choose)

        return let(_cross(u["a"], u["b"]), on_circle)

    ends = F.struct(_unit(s["x1"], s["y1"]).alias("a"), _unit(s["x2"], s["y2"]).alias("b"),
                    _unit(lon, lat).alias("p"))
    return let(ends, with_normal)


def _gap_to_arcs(v: Column, arcs: Column) -> Column:
    """Shortest great-circle distance from a vertex to any of the arcs."""
    return F.array_min(F.transform(arcs, lambda t: let(
        nearest_on_arc(t, v["x"], v["y"]),
        lambda q: haversine(v["x"], v["y"], q["x"], q["y"]))))


def nearest_gap(a: Column, b: Column) -> Column:
    """Shortest great-circle distance between two geometries that do not meet.

    Candidates are each vertex of one against each edge of the other.
    """
    def one_way(g, arcs):
        return F.array_min(F.transform(
            F.flatten(F.flatten(g["parts"])), lambda v: _gap_to_arcs(v, arcs)))

    return let(F.struct(segments(a).alias("a"), segments(b).alias("b")),
               lambda g: F.least(one_way(a, g["b"]), one_way(b, g["a"])))


def locate_on_sphere(segs: Column, lon: Column, lat: Column) -> Column:
    """Whether a point lies in rings whose edges are great-circle arcs: 1 or 0.

    Counts the arcs passed on the meridian from the point to the north pole.
    """
    def step(state, s):
        straddles = (s["x1"] > lon) != (s["x2"] > lon)
        tan_at = F.try_divide(
            F.tan(F.radians(s["y1"])) * F.sin(F.radians(s["x2"] - lon))
            + F.tan(F.radians(s["y2"])) * F.sin(F.radians(lon - s["x1"])),
            F.sin(F.radians(s["x2"] - s["x1"])))
        north = F.degrees(F.atan(tan_at)) > lat
        return F.when(straddles & F.coalesce(north, F.lit(False)), 1 - state).otherwise(state)

    return F.aggregate(segs, F.lit(0), step)


def _arcs_cross(s: Column, t: Column) -> Column:
    def of_normals(u):
        def at(x):
            return (
                (_dot(_cross(u["m"], u["a"]), x) >= 0) & (_dot(_cross(u["b"], u["m"]), x) >= 0)
                & (_dot(_cross(u["n"], u["c"]), x) >= 0) & (_dot(_cross(u["d"], u["n"]), x) >= 0)
            )

        def either(x):
            back = F.struct((-x["x"]).alias("x"), (-x["y"]).alias("y"), (-x["z"]).alias("z"))
            return (_dot(x, x) > 0) & (at(x) | at(back))

        return let(_cross(u["m"], u["n"]), either)

    def with_normals(u):
        return let(F.struct(
            u["a"], u["b"], u["c"], u["d"], _cross(u["a"], u["b"]).alias("m"),
            _cross(u["c"], u["d"]).alias("n")), of_normals)

    return let(F.struct(
        _unit(s["x1"], s["y1"]).alias("a"), _unit(s["x2"], s["y2"]).alias("b"),
        _unit(t["x1"], t["y1"]).alias("c"), _unit(t["x2"], t["y2"]).alias("d")), with_normals)


def _touching(a: Column, b: Column, ka: str | None, kb: str | None) -> Column:
    """Distance 0 on the sphere: a vertex lies inside the other area or arcs cross."""
    va, vb = first_vertex(a), first_vertex(b)
    point_a, point_b = of_kind(a, ka, POINT), of_kind(b, kb, POINT)
    area_a, area_b = of_kind(a, ka, POLYGON, MULTIPOLYGON), of_kind(b, kb, POLYGON, MULTIPOLYGON)

    def inside(points, rings):
        return F.exists(F.flatten(F.flatten(points)),
                        lambda v: locate_on_sphere(rings, v["x"], v["y"]) == 1)

    def general(g):
        crossing = F.exists(g["a"], lambda s: F.exists(g["b"], lambda t: _arcs_cross(s, t)))
        return (
            (is_areal(b) & inside(a["parts"], g["b"])) | (is_areal(a) & inside(b["parts"], g["a"]))
            | (~is_puntal(a) & ~is_puntal(b) & crossing)
        )

    return choose(
        (both(point_a, point_b), lambda: (va["x"] == vb["x"]) & (va["y"] == vb["y"])),
        (both(point_a, area_b), lambda: locate_on_sphere(segments(b), va["x"], va["y"]) == 1),
        (both(point_b, area_a), lambda: locate_on_sphere(segments(a), vb["x"], vb["y"]) == 1),
        (point_a, lambda: F.lit(False)),
        (point_b, lambda: F.lit(False)),
        (True, lambda: let(
            F.struct(segments(a).alias("a"), segments(b).alias("b")), general)))


# Fixed value: metres in the shortest degree of latitude on either model, less one percent.
DEGREE_METRES = 110574.0 / 1.01


def geographic(g: Column) -> Column:
    """True; metres are an error for anything but longitude and latitude (or NULL)."""
    return F.when(g["srid"] != DEFAULT_SRID, F.raise_error(F.concat(
        F.lit("metres need SRID 4326, not "), g["srid"])).cast("boolean")).otherwise(F.lit(True))


def _metres(value: Column, *geometries: Column) -> Column:
    """The value, after checking the reference systems."""
    checked = geographic(geometries[0])
    for g in geometries[1:]:
        checked = checked & geographic(g)
    return F.when(checked, value)


def geodesic_box(g: Column) -> Column:
    """Bounding box that also encloses the poleward bulge of great-circle edges."""
    box = g["bbox"]
    half = F.radians((box["xmax"] - box["xmin"]) / 2)

    def bulge(lat, pole):
        return F.when(half >= math.pi / 2 - 1e-9, F.lit(pole)).otherwise(
            F.degrees(F.atan(F.tan(F.radians(lat)) / F.cos(half))))

    top = F.when(is_puntal(g) | (box["ymax"] <= 0), box["ymax"]).otherwise(
        bulge(box["ymax"], 90.0))
    bottom = F.when(is_puntal(g) | (box["ymin"] >= 0), box["ymin"]).otherwise(
        bulge(box["ymin"], -90.0))
    return F.struct(box["xmin"].alias("xmin"), bottom.alias("ymin"),
                    box["xmax"].alias("xmax"), top.alias("ymax"))


def reach_boxes(g: Column, metres: float) -> Column:
    """Boxes (one, or two across the antimeridian) holding all points within ``metres``."""
    rise = metres / DEGREE_METRES

    def spread(box):
        low, high = box["ymin"] - rise, box["ymax"] + rise
        far = F.greatest(F.abs(low), F.abs(high))
        # the widest part of a circle around a point lies poleward of the point
        wide = F.when(far >= 89.9, F.lit(360.0)).otherwise(F.lit(rise) / F.cos(F.radians(far)))
        west, east = box["xmin"] - wide, box["xmax"] + wide

        def one(x0, x1):
            return F.struct(x0.alias("xmin"), low.alias("ymin"), x1.alias("xmax"), high.alias("ymax"))

        everywhere = F.array(one(F.lit(-180.0), F.lit(180.0)))
        return (
            F.when(east - west >= 360, everywhere)
            .when(west < -180, F.array(one(F.lit(-180.0), east), one(west + 360, F.lit(180.0))))
            .when(east > 180, F.array(one(west, F.lit(180.0)), one(F.lit(-180.0), east - 360)))
            .otherwise(F.array(one(west, east)))
        )

    return let(geodesic_box(g), spread)


def sphere_distance(a: Column, b: Column, ka: str | None = None,
                    kb: str | None = None) -> Column:
    va, vb = first_vertex(a), first_vertex(b)
    point_a, point_b = of_kind(a, ka, POINT), of_kind(b, kb, POINT)
    pair = both(point_a, point_b)
    if pair is True:
        return _metres(haversine(va["x"], va["y"], vb["x"], vb["y"]), a, b)
    return _metres(choose(
        (pair, lambda: haversine(va["x"], va["y"], vb["x"], vb["y"])),
        (_touching(a, b, ka, kb), lambda: F.lit(0.0)),
        (point_a, lambda: _gap_to_arcs(va, segments(b))),
        (point_b, lambda: _gap_to_arcs(vb, segments(a))),
        (True, lambda: nearest_gap(a, b))), a, b)


# --- spheroid, numpy --------------------------------------------------------------

def _series(alpha0_cos_sq):
    """Vincenty's A, B and the longitude coefficient C for one geodesic's equator angle."""
    u2 = alpha0_cos_sq * (WGS84_A**2 - WGS84_B**2) / WGS84_B**2
    big_a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    big_b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    c = WGS84_F / 16 * alpha0_cos_sq * (4 + WGS84_F * (4 - 3 * alpha0_cos_sq))
    return big_a, big_b, c


def _arc_length(big_a, big_b, sin_s, cos_s, sigma, cos_2m):
    delta = big_b * sin_s * (cos_2m + big_b / 4 * (
        cos_s * (2 * cos_2m**2 - 1)
        - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)))
    return WGS84_B * big_a * (sigma - delta)


def inverse(lon1, lat1, lon2, lat2):
    """Geodesic length (m) and start azimuth (rad) between points given in degrees."""
    lon1, lat1, lon2, lat2 = (np.asarray(v, float) for v in (lon1, lat1, lon2, lat2))
    u1 = np.arctan((1 - WGS84_F) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - WGS84_F) * np.tan(np.radians(lat2)))
    span = np.radians((lon2 - lon1 + 180.0) % 360.0 - 180.0)
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = span.copy()
    active = np.ones(lam.shape, bool)
    with np.errstate(all="ignore"):
        for _ in range(60):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_s = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cos_s = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(sin_s, cos_s)
            sin_a = np.where(sin_s == 0, 0.0, cu1 * cu2 * sl / np.where(sin_s == 0, 1, sin_s))
            cos_a2 = 1 - sin_a**2
            cos_2m = np.where(cos_a2 < 1e-15, 0.0, cos_s - 2 * su1 * su2 / np.where(
                cos_a2 < 1e-15, 1, cos_a2))
            c = WGS84_F / 16 * cos_a2 * (4 + WGS84_F * (4 - 3 * cos_a2))
            following = span + (1 - c) * WGS84_F * sin_a * (
                sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1)))
            active = np.abs(following - lam) > 1e-13
            # beyond half a turn the iteration has left the geodesic (near-antipodal points)
            lam = np.where(np.abs(following) > np.pi, np.nan, following)
            if not np.any(active & ~np.isnan(lam)):
                break
        big_a, big_b, _ = _series(cos_a2)
        length = _arc_length(big_a, big_b, sin_s, cos_s, sigma, cos_2m)
        azimuth = np.arctan2(cu2 * np.sin(lam), cu1 * su2 - su1 * cu2 * np.cos(lam))
    lost = np.isnan(lam) | active
    lost &= ~(np.isnan(lon1) | np.isnan(lat1) | np.isnan(lon2) | np.isnan(lat2))
    if np.any(lost):
        length, azimuth = np.array(length, float), np.array(azimuth, float)
        length[lost], azimuth[lost] = _inverse_by_bisection(
            u1[lost], u2[lost], span[lost])
    return length, azimuth


def _inverse_by_bisection(u1, u2, span):
    """Near-antipodal points: search the start azimuth whose geodesic ends at ``span``.

    With the first latitude the lower and the larger in size, the longitude reached at
    the second latitude grows with the azimuth.
    """
    swap = np.abs(u1) < np.abs(u2)
    low, high = np.where(swap, u2, u1), np.where(swap, u1, u2)
    flip = np.where(low > 0, -1.0, 1.0)
    # exactly on the equator, the start counts as just south of it
    low, high = np.minimum(low * flip, -1e-100), high * flip
    goal = np.abs(span)
    lo, hi = np.zeros_like(goal), np.full_like(goal, np.pi)
    for _ in range(70):
        mid = (lo + hi) / 2
        reached, _, _ = _follow(low, high, mid)
        lo, hi = np.where(reached < goal, mid, lo), np.where(reached < goal, hi, mid)
    azimuth = (lo + hi) / 2
    _, length, end = _follow(low, high, azimuth)
    # back to the given order and hemisphere
    start = np.where(swap, np.pi - end, azimuth)
    start = np.where(flip < 0, np.pi - start, start)
    return length, np.where(span < 0, -start, start)


def _follow(u1, u2, azimuth):
    """Longitude difference, length and end azimuth of the geodesic from u1 to u2."""
    sin_a = np.cos(u1) * np.sin(azimuth)
    cos_a2 = 1 - sin_a**2
    s1 = np.arctan2(np.sin(u1), np.cos(u1) * np.cos(azimuth))
    cos_end = np.sqrt(np.maximum(np.cos(u1)**2 * np.cos(azimuth)**2
                                 + np.cos(u2)**2 - np.cos(u1)**2, 0.0))
    s2 = np.arctan2(np.sin(u2), cos_end)
    omega = np.arctan2(sin_a * np.sin(s2), np.cos(s2)) - np.arctan2(sin_a * np.sin(s1), np.cos(s1))
    sigma = s2 - s1
    big_a, big_b, c = _series(cos_a2)
    cos_2m = np.cos(s1 + s2)
    sin_s, cos_s = np.sin(sigma), np.cos(sigma)
    lam = omega - (1 - c) * WGS84_F * sin_a * (
        sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1)))
    return lam, _arc_length(big_a, big_b, sin_s, cos_s, sigma, cos_2m), np.arctan2(sin_a, cos_end)


def direct(lon, lat, azimuth, length):
    """End point (degrees) of a geodesic from a point, azimuth (rad) and length (m)."""
    u1 = np.arctan((1 - WGS84_F) * np.tan(np.radians(lat)))
    su, cu, sa, ca = np.sin(u1), np.cos(u1), np.sin(azimuth), np.cos(azimuth)
    s1 = np.arctan2(su, cu * ca)
    sin_a = cu * sa
    cos_a2 = 1 - sin_a**2
    big_a, big_b, c = _series(cos_a2)
    sigma = length / (WGS84_B * big_a)
    for _ in range(12):
        cos_2m, sin_s, cos_s = np.cos(2 * s1 + sigma), np.sin(sigma), np.cos(sigma)
        delta = big_b * sin_s * (cos_2m + big_b / 4 * (
            cos_s * (2 * cos_2m**2 - 1)
            - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)))
        sigma = length / (WGS84_B * big_a) + delta
    cos_2m, sin_s, cos_s = np.cos(2 * s1 + sigma), np.sin(sigma), np.cos(sigma)
    end_lat = np.arctan2(su * cos_s + cu * sin_s * ca, (1 - WGS84_F) * np.hypot(
        sin_a, su * sin_s - cu * cos_s * ca))
    lam = np.arctan2(sin_s * sa, cu * cos_s - su * sin_s * ca)
    span = lam - (1 - c) * WGS84_F * sin_a * (
        sigma + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m**2 - 1)))
    return lon + np.degrees(span), np.degrees(end_lat)


def _strip(sin_lat):
    """Area per radian of longitude between the equator and a latitude."""
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    t = e * sin_lat
    return WGS84_B**2 / 2 * (sin_lat / (1 - t * t) + np.arctanh(t) / e)


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(20)


def edge_areas(lon1, lat1, lon2, lat2):
    """Signed area between each geodesic edge and the equator, and its longitude span."""
    length, azimuth = inverse(lon1, lat1, lon2, lat2)
    u1 = np.arctan((1 - WGS84_F) * np.tan(np.radians(lat1)))
    sin_a0 = np.cos(u1) * np.sin(azimuth)
    cos_a0 = np.hypot(np.cos(azimuth), np.sin(azimuth) * np.sin(u1))
    s1 = np.arctan2(np.sin(u1), np.cos(u1) * np.cos(azimuth))
    big_a, big_b, _ = _series(cos_a0**2)
    sigma = length / (WGS84_B * big_a)
    for _ in range(12):
        cos_2m = np.cos(2 * s1 + sigma)
        sin_s, cos_s = np.sin(sigma), np.cos(sigma)
        sigma = length / (WGS84_B * big_a) + big_b * sin_s * (cos_2m + big_b / 4 * (
            cos_s * (2 * cos_2m**2 - 1)
            - big_b / 6 * cos_2m * (4 * sin_s**2 - 3) * (4 * cos_2m**2 - 3)))
    half = sigma / 2
    area, span = np.zeros_like(length), np.zeros_like(length)
    k2 = (WGS84_A**2 - WGS84_B**2) / WGS84_B**2 * cos_a0**2
    for node, weight in zip(_NODES, _WEIGHTS):
        s = s1 + half * (1 + node)
        sin_u = cos_a0 * np.sin(s)
        cos_u2 = 1 - sin_u**2
        tan_lat = sin_u / np.sqrt(np.maximum(cos_u2, 1e-30)) / (1 - WGS84_F)
        sin_lat = tan_lat / np.sqrt(1 + tan_lat**2)
        rate = sin_a0 / np.maximum(cos_u2, 1e-30) - sin_a0 * WGS84_F * (2 - WGS84_F) / (
            1 + (1 - WGS84_F) * np.sqrt(1 + k2 * np.sin(s)**2))
        area += weight * half * rate * _strip(sin_lat)
        span += weight * half * rate
    # an edge that ends at a pole turns there to the longitude it is given
    pole = np.where(np.abs(lat1) > 90 - 1e-9, lat1, np.where(np.abs(lat2) > 90 - 1e-9, lat2, 0.0))
    whole = np.radians((np.asarray(lon2) - lon1 + 180.0) % 360.0 - 180.0)
    turned = np.where(pole != 0, whole - span, 0.0)
    return area + turned * _strip(np.sign(pole) * 1.0), span + turned


def _edge_columns(edges: pa.Array):
    """The four flat edge columns of a list array, and the list offsets."""
    lengths = np.asarray(edges.value_lengths().fill_null(0), np.int64)
    flat = np.asarray(edges.flatten(), float).reshape(-1, 4)
    ends = np.cumsum(lengths // 4)
    return flat.T, np.concatenate([[0], ends])


def _sum_rows(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1)
    rows = np.repeat(np.arange(len(out)), np.diff(offsets))
    np.add.at(out, rows, values)
    return out


def _vectors(lon, lat):
    lo, la = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=-1)


def _nearest_on_arcs(lon, lat, lon1, lat1, lon2, lat2):
    """Sphere-nearest point of each segment to each point, all arrays of one length."""
    p, a, b = _vectors(lon, lat), _vectors(lon1, lat1), _vectors(lon2, lat2)
    n = np.cross(a, b)
    norm = (n * n).sum(-1)
    off = (p * n).sum(-1) / np.where(norm > 0, norm, 1)
    q = p - off[:, None] * n
    inside = ((np.cross(n, a) * q).sum(-1) >= 0) & ((np.cross(b, n) * q).sum(-1) >= 0)
    inside &= norm > 1e-24
    nearer_a = (a * p).sum(-1) >= (b * p).sum(-1)
    foot_lon = np.degrees(np.arctan2(q[:, 1], q[:, 0]))
    foot_lat = np.degrees(np.arctan2(q[:, 2], np.hypot(q[:, 0], q[:, 1])))
    x = np.where(inside, foot_lon, np.where(nearer_a, lon1, lon2))
    y = np.where(inside, foot_lat, np.where(nearer_a, lat1, lat2))
    return x, y


def _closest(rows: np.ndarray, a: np.ndarray, b: np.ndarray, count: int):
    """Closest point pair per row, given edge pairs (4 x n each) and their row numbers."""
    best = [np.full(count, np.nan) for _ in range(4)]
    tries = []
    for one, other, swap in ((a, b, False), (b, a, True)):
        for at in (0, 2):
            x, y = _nearest_on_arcs(one[at], one[at + 1], *other)
            pair = (x, y, one[at], one[at + 1]) if swap else (one[at], one[at + 1], x, y)
            tries.append(np.stack(pair))
    row = np.tile(rows, len(tries))
    points = np.concatenate(tries, axis=1)
    gap = ((_vectors(points[0], points[1]) - _vectors(points[2], points[3])) ** 2).sum(-1)
    order = np.lexsort((gap, row))
    first = order[np.unique(row[order], return_index=True)[1]]
    for k in range(4):
        best[k][row[first]] = points[k][first]
    return best


# Edge pairs worked on at once; bounds the memory of one Python worker.
_PAIRS_AT_ONCE = 500_000


@F.arrow_udf(T.DoubleType())
def _edge_distance_udf(edges_a: pa.Array, edges_b: pa.Array) -> pa.Array:
    (a, a_at), (b, b_at) = _edge_columns(edges_a), _edge_columns(edges_b)
    na, nb = np.diff(a_at), np.diff(b_at)
    pairs = na * nb
    out = np.full(len(pairs), np.nan)
    group = (np.cumsum(pairs) - pairs) // _PAIRS_AT_ONCE
    for start, stop in _runs(group):
        sizes = pairs[start:stop]
        if not sizes.sum():
            continue
        rows = np.repeat(np.arange(start, stop), sizes)
        within = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left, right = a_at[rows] + within // nb[rows], b_at[rows] + within % nb[rows]
        ends = _closest(rows - start, a[:, left], b[:, right], stop - start)
        out[start:stop], _ = inverse(*ends)
    return pa.array(out, mask=np.isnan(out))


@F.arrow_udf(T.DoubleType())
def _point_distance_udf(lon1: pa.Array, lat1: pa.Array, lon2: pa.Array, lat2: pa.Array) -> pa.Array:
    ends = [np.asarray(c.fill_null(float("nan")), float) for c in (lon1, lat1, lon2, lat2)]
    out = np.full(len(ends[0]), np.nan)
    for at in range(0, len(out), _PAIRS_AT_ONCE):
        out[at:at + _PAIRS_AT_ONCE], _ = inverse(*(e[at:at + _PAIRS_AT_ONCE] for e in ends))
    return pa.array(out, mask=np.isnan(out))


def _runs(group: np.ndarray):
    """Start and stop of each run of equal values."""
    if not len(group):
        return
    starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    yield from zip(starts[:-1], starts[1:])


@F.arrow_udf(T.DoubleType())
def _length_udf(edges: pa.Array) -> pa.Array:
    columns, offsets = _edge_columns(edges)
    length, _ = inverse(*columns)
    return pa.array(_sum_rows(length, offsets))


@F.arrow_udf(T.DoubleType())
def _area_udf(edges: pa.Array, ring_edges: pa.Array, ring_signs: pa.Array) -> pa.Array:
    columns, _ = _edge_columns(edges)
    area, span = edge_areas(*columns)
    in_ring = np.asarray(ring_edges.flatten(), np.int64)
    ring_ends = np.concatenate([[0], np.cumsum(in_ring)])
    total, turn = _sum_rows(area, ring_ends), _sum_rows(span, ring_ends)
    cap = 2 * math.pi * float(_strip(np.float64(1.0)))
    size = np.where(np.abs(turn) > math.pi, cap - np.abs(total), np.abs(total))
    signed = size * np.asarray(ring_signs.flatten(), float)
    rings_in_row = np.asarray(ring_edges.value_lengths().fill_null(0), np.int64)
    return pa.array(_sum_rows(signed, np.concatenate([[0], np.cumsum(rings_in_row)])))


@F.arrow_udf(RING)
def _circle_udf(lon: pa.Array, lat: pa.Array, distance: pa.Array) -> pa.Array:
    offsets = np.array(circle_offsets())
    azimuth = np.arctan2(offsets[:, 0], offsets[:, 1])
    lon0, lat0, d = (np.asarray(c.fill_null(float("nan")), float)[:, None]
                     for c in (lon, lat, distance))
    x, y = direct(lon0, lat0, azimuth[None, :], d)
    flat = pa.StructArray.from_arrays([pa.array(x.ravel()), pa.array(y.ravel())], ["x", "y"])
    ends = np.arange(0, flat.__len__() + 1, len(offsets), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), flat)


# --- spheroid, columns ------------------------------------------------------------

def _flat_edges(segs: Column) -> Column:
    return F.flatten(F.transform(
        segs, lambda s: F.array(s["x1"], s["y1"], s["x2"], s["y2"])))


def spheroid_distance(a: Column, b: Column, ka: str | None = None,
                      kb: str | None = None) -> Column:
    """Metres on the spheroid between the points that are closest on the sphere."""
    if both(of_kind(a, ka, POINT), of_kind(b, kb, POINT)) is True:
        va, vb = first_vertex(a), first_vertex(b)
        return _metres(_point_distance_udf(va["x"], va["y"], vb["x"], vb["y"]), a, b)
    apart = _edge_distance_udf(_flat_edges(segments(a)), _flat_edges(segments(b)))
    return _metres(F.when(_touching(a, b, ka, kb), F.lit(0.0)).otherwise(apart), a, b)


def distance_m(a: Column, b: Column, model: str = "spheroid", ka: str | None = None,
               kb: str | None = None) -> Column:
    check_model(model)
    kernel = sphere_distance if model == "sphere" else spheroid_distance
    return kernel(a, b, ka, kb)


def area_m2(g: Column) -> Column:
    """Spheroid area in square metres: outer rings less holes; 0 for points and lines."""
    rings = F.flatten(g["parts"])
    signs = F.flatten(F.transform(g["parts"], lambda p: F.transform(
        p, lambda r, i: F.when(i == 0, F.lit(1)).otherwise(F.lit(-1)))))
    size = _area_udf(
        F.when(is_areal(g), _flat_edges(segments(g))),
        F.when(is_areal(g), F.transform(rings, lambda r: F.size(r) - 1)),
        F.when(is_areal(g), signs),
    )
    return F.when(g.isNotNull() & geographic(g), size)


def perimeter_m(g: Column) -> Column:
    edges = F.when(is_areal(g), _flat_edges(segments(g)))
    return F.when(g.isNotNull() & geographic(g), _length_udf(edges))


def geodesic_circle(g: Column, distance: Column) -> Column:
    v = first_vertex(g)
    return _metres(_circle_udf(
        F.when(g["kind"] == POINT, v["x"]), F.when(g["kind"] == POINT, v["y"]), distance), g)


def check_model(model: str) -> None:
    if model not in MODELS:
        raise ValueError(f"model must be one of {', '.join(MODELS)}")
