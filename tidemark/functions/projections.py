"""Reprojection between longitude/latitude, web Mercator, UTM zones and national or polar planes."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.geodesic import WGS84_A, WGS84_F
from tidemark.functions.geometry import GEOMETRY, let, map_vertices, vertex

# The supported reference systems and the UTM scale and false origins.
LONLAT, WEB_MERCATOR = 4326, 3857
UTM_NORTH, UTM_SOUTH = 32600, 32700
UTM_SCALE = 0.9996
UTM_EAST, UTM_SOUTH_SHIFT = 500000.0, 10000000.0

Move = Callable[[Column, Column], Column]


def _check_latitude(lat: Column, value: Column) -> Column:
    return F.when(F.abs(lat) < 90, value).when(
        lat.isNotNull(), F.raise_error(F.lit("a pole has no web Mercator position")).cast("double"))


def _to_mercator(lon: Column, lat: Column) -> Column:
    y = F.lit(WGS84_A) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))
    return vertex(F.lit(WGS84_A) * F.radians(lon), _check_latitude(lat, y))


def _from_mercator(x: Column, y: Column) -> Column:
    lat = F.lit(math.pi / 2) - 2 * F.atan(F.exp(-y / WGS84_A))
    return vertex(F.degrees(x / WGS84_A), F.degrees(lat))


# Krüger's series in the third flattening, to the order that gives sub-millimetre results.
_N = WGS84_F / (2 - WGS84_F)
_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_E = math.sqrt(WGS84_F * (2 - WGS84_F))


def utm_zone(lon: Column) -> Column:
    return (F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1).cast("int")


def _meridian(zone: Column) -> Column:
    return zone * 6 - 183


def _waves(series: tuple, wave: Column, sine, other_sine) -> Column:
    """Sum of coefficient * sine(2k north) * other_sine(2k east)."""
    total = F.lit(0.0)
    for k, factor in enumerate(series, start=1):
        total = total + F.lit(factor) * sine(2 * k * wave["n"]) * other_sine(2 * k * wave["e"])
    return total


def to_utm(zone: Column, south: Column) -> Move:
    scale = UTM_SCALE * _RADIUS
    shift = F.when(south, F.lit(UTM_SOUTH_SHIFT)).otherwise(F.lit(0.0))

    def on_plane(c):
        return vertex(
            F.lit(UTM_EAST) + F.lit(scale) * (c["e"] + _waves(_ALPHA, c, F.cos, F.sinh)),
            F.lit(scale) * (c["n"] + _waves(_ALPHA, c, F.sin, F.cosh)) + shift)

    def on_sphere(t):
        cos_lam = F.cos(t["lam"])
        north = F.atan2(t["tau"], cos_lam)
        east = F.asinh(F.sin(t["lam"]) / F.sqrt(t["tau"] * t["tau"] + cos_lam * cos_lam))
        return let(F.struct(north.alias("n"), east.alias("e")), on_plane)

    def move(lon, lat):
        sine = F.sin(F.radians(lat))
        lam = F.radians(F.pmod(lon - _meridian(zone) + 180, F.lit(360.0)) - 180)
        tau = F.sinh(F.atanh(sine) - F.lit(_E) * F.atanh(F.lit(_E) * sine))
        return let(F.struct(tau.alias("tau"), lam.alias("lam")), on_sphere)

    return move


def from_utm(zone: Column, south: Column) -> Move:
    scale = UTM_SCALE * _RADIUS
    shift = F.when(south, F.lit(UTM_SOUTH_SHIFT)).otherwise(F.lit(0.0))

    def on_ellipsoid(c):
        # fixed-point steps from the conformal to the geodetic latitude
        conformal = F.asin(F.sin(c["n"]) / F.cosh(c["e"]))
        phi = conformal
        base = F.atanh(F.sin(conformal))
        for _ in range(6):
            phi = F.asin(F.tanh(base + F.lit(_E) * F.atanh(F.lit(_E) * F.sin(phi))))
        lam = F.atan2(F.sinh(c["e"]), F.cos(c["n"]))
        return vertex(F.degrees(lam) + _meridian(zone), F.degrees(phi))

    def on_sphere(c):
        return let(F.struct(
            (c["n"] - _waves(_BETA, c, F.sin, F.cosh)).alias("n"),
            (c["e"] - _waves(_BETA, c, F.cos, F.sinh)).alias("e")), on_ellipsoid)

    def move(x, y):
        return let(F.struct(
            ((y - shift) / scale).alias("n"), ((x - UTM_EAST) / scale).alias("e")), on_sphere)

    return move


# --- conic, polar and equal-area planes ---------------------------------------------

GRS80_F = 1 / 298.257222101


def _isometric(lat: Column, e: float) -> Column:
    sine = F.sin(F.radians(lat))
    return F.atanh(sine) - F.lit(e) * F.atanh(F.lit(e) * sine)


def _isometric_number(lat: float, e: float) -> float:
    sine = math.sin(math.radians(lat))
    return math.atanh(sine) - e * math.atanh(e * sine)


def _latitude(isometric: Column, e: float) -> Column:
    """Geodetic latitude in degrees, by fixed-point steps."""
    phi = F.asin(F.tanh(isometric))
    for _ in range(6):
        phi = F.asin(F.tanh(isometric + F.lit(e) * F.atanh(F.lit(e) * F.sin(phi))))
    return F.degrees(phi)


def _parallel(lat: float, e: float) -> float:
    """Radius of a parallel over the equator's."""
    return math.cos(math.radians(lat)) / math.sqrt(1 - (e * math.sin(math.radians(lat))) ** 2)


def _turn(lon: Column, meridian: float) -> Column:
    return F.radians(F.pmod(lon - meridian + 180, F.lit(360.0)) - 180)


def _conic(flattening, south, north, lat0, lon0, x0, y0) -> tuple[Move, Move]:
    """Lambert's conformal conic with two parallels."""
    e = math.sqrt(flattening * (2 - flattening))
    low, high = _isometric_number(south, e), _isometric_number(north, e)
    n = math.log(_parallel(south, e) / _parallel(north, e)) / (high - low)
    size = WGS84_A * _parallel(south, e) * math.exp(n * low) / n
    middle = size * math.exp(-n * _isometric_number(lat0, e))

    def to(lon, lat):
        def on_plane(t):
            return vertex(F.lit(x0) + t["r"] * F.sin(t["a"]), F.lit(y0 + middle) - t["r"] * F.cos(t["a"]))

        return let(F.struct((F.lit(size) * F.exp(-n * _isometric(lat, e))).alias("r"),
                            (n * _turn(lon, lon0)).alias("a")), on_plane)

    def back(x, y):
        east, up = x - x0, F.lit(y0 + middle) - y
        return let(F.struct((-F.log(F.sqrt(east * east + up * up) / size) / n).alias("q"),
                            F.atan2(east, up).alias("a")),
                   lambda t: vertex(F.degrees(t["a"] / n) + lon0, _latitude(t["q"], e)))

    return to, back


def _polar(flattening, true_lat, lon0) -> tuple[Move, Move]:
    """Polar stereographic, true to scale on one parallel of its hemisphere."""
    e = math.sqrt(flattening * (2 - flattening))
    side = 1 if true_lat > 0 else -1
    size = WGS84_A * _parallel(true_lat, e) * math.exp(side * _isometric_number(true_lat, e))

    def to(lon, lat):
        return let(F.struct((F.lit(size) * F.exp(-side * _isometric(lat, e))).alias("r"),
                            _turn(lon, lon0).alias("a")),
                   lambda t: vertex(t["r"] * F.sin(t["a"]), -side * t["r"] * F.cos(t["a"])))

    def back(x, y):
        return let(F.struct((-side * F.log(F.sqrt(x * x + y * y) / size)).alias("q"),
                            F.atan2(x, -side * y).alias("a")),
                   lambda t: vertex(F.pmod(F.degrees(t["a"]) + lon0 + 180, F.lit(360.0)) - 180,
                                    _latitude(t["q"], e)))

    return to, back


def _equal_area(flattening, lat0, lon0, x0, y0) -> tuple[Move, Move]:
    """Lambert's azimuthal equal-area projection."""
    e2 = flattening * (2 - flattening)
    e = math.sqrt(e2)

    def share(sine, atanh):
        return (1 - e2) * (sine / (1 - e2 * sine * sine) + atanh / e)

    whole = share(1.0, math.atanh(e))
    sine0 = math.sin(math.radians(lat0))
    beta0 = math.asin(share(sine0, math.atanh(e * sine0)) / whole)
    radius = WGS84_A * math.sqrt(whole / 2)
    stretch = WGS84_A * _parallel(lat0, e) / (radius * math.cos(beta0))
    s0, c0 = math.sin(beta0), math.cos(beta0)
    series = (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040, 23 * e2**2 / 360 + 251 * e2**3 / 3780,
              761 * e2**3 / 45360)

    def to(lon, lat):
        sine = F.sin(F.radians(lat))
        beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), share(sine, F.atanh(F.lit(e) * sine)) / whole)))

        def on_plane(t):
            sb, cb, ca = F.sin(t["b"]), F.cos(t["b"]), F.cos(t["a"])
            scale = F.lit(radius) * F.sqrt(2 / (1 + s0 * sb + c0 * cb * ca))
            return vertex(F.lit(x0) + scale * stretch * cb * F.sin(t["a"]),
                          F.lit(y0) + scale / stretch * (c0 * sb - s0 * cb * ca))

        return let(F.struct(beta.alias("b"), _turn(lon, lon0).alias("a")), on_plane)

    def back(x, y):
        east, up = (x - x0) / stretch, (y - y0) * stretch

        def on_sphere(t):
            far = F.sqrt(t["x"] * t["x"] + t["y"] * t["y"])
            return let(F.struct(t["x"].alias("x"), t["y"].alias("y"), far.alias("r"),
                                (2 * F.asin(far / (2 * radius))).alias("c")), on_ellipsoid)

        def on_ellipsoid(t):
            sc, cc = F.sin(t["c"]), F.cos(t["c"])
            beta = F.asin(cc * s0 + F.when(t["r"] > 0, t["y"] * sc * c0 / t["r"]).otherwise(F.lit(0.0)))
            lam = F.atan2(t["x"] * sc, t["r"] * c0 * cc - t["y"] * s0 * sc)
            return let(F.struct(beta.alias("b"), lam.alias("a")), lambda u: vertex(
                F.degrees(u["a"]) + lon0,
                F.degrees(u["b"] + sum((F.sin((2 * k + 2) * u["b"]) * f for k, f in enumerate(series)), F.lit(0.0)))))

        return let(F.struct(east.alias("x"), up.alias("y")), on_sphere)

    return to, back


# Parameters of the planes, as the reference systems define them.
PLANES = {
    2154: _conic(GRS80_F, 44.0, 49.0, 46.5, 3.0, 700000.0, 6600000.0),
    3035: _equal_area(GRS80_F, 52.0, 10.0, 4321000.0, 3210000.0),
    3031: _polar(WGS84_F, -71.0, 0.0),
    3413: _polar(WGS84_F, 70.0, -45.0),
}


def _is_utm(srid: int) -> bool:
    return 1 <= srid - UTM_NORTH <= 60 or 1 <= srid - UTM_SOUTH <= 60


def _utm_of(srid: Column) -> tuple[Column, Column]:
    return srid % 100, srid >= UTM_SOUTH


def st_transform(g: Column, to_srid: int) -> Column:
    """Reproject to longitude/latitude (4326), web Mercator (3857), a WGS 84 UTM zone or one of ``PLANES``.

    Other reference systems raise.
    """
    if to_srid not in (LONLAT, WEB_MERCATOR, *PLANES) and not _is_utm(to_srid):
        raise ValueError(f"unsupported target SRID {to_srid}")
    return let(g, lambda geometry: _reproject(geometry, to_srid))


def _reproject(g: Column, to_srid: int) -> Column:
    source = g["srid"]
    from_zone = source.between(UTM_NORTH + 1, UTM_NORTH + 60) | source.between(
        UTM_SOUTH + 1, UTM_SOUTH + 60)
    bad = F.raise_error(F.concat(F.lit("unsupported source SRID "), source.cast("string")))
    lonlat = (
        F.when(source == LONLAT, g)
        .when(source == WEB_MERCATOR, map_vertices(g, _from_mercator, F.lit(LONLAT)))
        .when(from_zone, map_vertices(g, from_utm(*_utm_of(source)), F.lit(LONLAT)))
    )
    for srid, (_, back) in PLANES.items():
        lonlat = lonlat.when(source == srid, map_vertices(g, back, F.lit(LONLAT)))
    lonlat = lonlat.when(g.isNotNull(), bad.cast(GEOMETRY))
    if to_srid == LONLAT:
        return lonlat
    target = F.lit(to_srid)
    if to_srid in PLANES:
        move = PLANES[to_srid][0]
    else:
        move = _to_mercator if to_srid == WEB_MERCATOR else to_utm(*_utm_of(target))
    return F.when(source == to_srid, g).otherwise(map_vertices(lonlat, move, target))
