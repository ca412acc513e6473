"""Geometry as a Spark struct, with planar predicates and measures as native columns.

A geometry is ``struct<kind, srid, parts, bbox>``.  ``parts`` nests part, ring and
vertex; points and lines use a single ring per part.  Nothing here needs Python workers:
all kernels are higher-order functions over the vertex arrays.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Geometry kinds and the default spatial reference.
POINT, LINE, POLYGON = "POINT", "LINESTRING", "POLYGON"
MULTIPOINT, MULTILINE, MULTIPOLYGON = "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON"
KINDS = (POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON)
DEFAULT_SRID = 4326

VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(VERTEX)
PARTS = T.ArrayType(T.ArrayType(RING))
BBOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])
GEOMETRY = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("srid", T.IntegerType()),
    T.StructField("parts", PARTS), T.StructField("bbox", BBOX),
])

# Arc vertices per quarter turn in buffers.
QUADRANT_SEGMENTS = 8
# Relative slack when testing computed (not given) points against a border.
BORDER_SLACK = 1e-12


# --- construction -----------------------------------------------------------------

def _double(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("double")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def vertex(x, y) -> Column:
    return F.struct(_double(x).alias("x"), _double(y).alias("y"))


def _vertices(parts: Column) -> Column:
    return F.flatten(F.flatten(parts))


def make_geometry(kind: Column, srid: Column, parts: Column) -> Column:
    """A geometry from its parts; the bounding box is computed."""
    def made(p):
        box = let(_vertices(p), lambda vs: let(F.struct(
            F.transform(vs, lambda v: v["x"]).alias("x"),
            F.transform(vs, lambda v: v["y"]).alias("y")), lambda c: F.struct(
                F.array_min(c["x"]).alias("xmin"), F.array_min(c["y"]).alias("ymin"),
                F.array_max(c["x"]).alias("xmax"), F.array_max(c["y"]).alias("ymax"))))
        whole = F.struct(
            kind.alias("kind"), srid.cast("int").alias("srid"), p.alias("parts"),
            box.alias("bbox"))
        return F.when(p.isNotNull(), whole)

    return let(parts, made)


def st_point(x, y, srid: int = DEFAULT_SRID) -> Column:
    x, y = _double(x), _double(y)
    box = F.struct(x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax"))
    return F.struct(
        F.lit(POINT).alias("kind"), F.lit(srid).alias("srid"),
        F.array(F.array(F.array(vertex(x, y)))).alias("parts"), box.alias("bbox"),
    )


def _path(points: Sequence[tuple], kind: str, srid: int) -> Column:
    ring = F.array(*[vertex(x, y) for x, y in points])
    xs, ys = [_double(x) for x, _ in points], [_double(y) for _, y in points]
    box = F.struct(
        F.least(*xs).alias("xmin"), F.least(*ys).alias("ymin"),
        F.greatest(*xs).alias("xmax"), F.greatest(*ys).alias("ymax"),
    )
    return F.struct(
        F.lit(kind).alias("kind"), F.lit(srid).alias("srid"),
        F.array(F.array(ring)).alias("parts"), box.alias("bbox"),
    )


def st_line(points: Sequence[tuple], srid: int = DEFAULT_SRID) -> Column:
    """Line through the given (x, y) columns."""
    return _path(points, LINE, srid)


def st_polygon(points: Sequence[tuple], srid: int = DEFAULT_SRID) -> Column:
    """Polygon without holes; the ring is closed when it is not."""
    closed = list(points) if points[0] == points[-1] else [*points, points[0]]
    return _path(closed, POLYGON, srid)


def st_rectangle(xmin, ymin, xmax, ymax, srid: int = DEFAULT_SRID) -> Column:
    return st_polygon([(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)], srid)


def set_srid(g: Column, srid: int) -> Column:
    return F.when(g.isNotNull(), g.withField("srid", F.lit(srid)))


def map_vertices(g: Column, move, srid: Column | None = None) -> Column:
    """The geometry with every vertex replaced by ``move(x, y)``, a vertex struct."""
    def moved(geometry):
        parts = F.transform(geometry["parts"], lambda p: F.transform(
            p, lambda r: F.transform(r, lambda v: move(v["x"], v["y"]))))
        return make_geometry(
            geometry["kind"], geometry["srid"] if srid is None else srid, parts)

    return let(g, moved)


# --- kinds ------------------------------------------------------------------------

def is_puntal(g: Column) -> Column:
    return g["kind"].isin(POINT, MULTIPOINT)


def is_lineal(g: Column) -> Column:
    return g["kind"].isin(LINE, MULTILINE)


def is_areal(g: Column) -> Column:
    return g["kind"].isin(POLYGON, MULTIPOLYGON)


# Kernels take the kind of a side when the caller knows it (a literal, a column of
# points).  Branches that cannot apply are then left out of the expression.

def of_kind(g: Column, known: str | None, *kinds: str) -> Column | bool:
    return known in kinds if known is not None else g["kind"].isin(*kinds)


def both(a: Column | bool, b: Column | bool) -> Column | bool:
    if isinstance(a, bool) or isinstance(b, bool):
        plain, other = (a, b) if isinstance(a, bool) else (b, a)
        return other if plain else False
    return a & b


def choose(*cases) -> Column:
    """CASE over ``(condition, value thunk)``; conditions may be plain booleans."""
    out = None
    for condition, value in cases:
        if condition is False:
            continue
        if condition is True:
            return value() if out is None else out.otherwise(value())
        out = F.when(condition, value()) if out is None else out.when(condition, value())
    return out


def first_vertex(g: Column) -> Column:
    return g["parts"][0][0][0]


def is_box(g: Column) -> Column:
    """Whether the geometry is a rectangle along the axes, that is its own bounding box."""
    part = F.get(g["parts"], F.lit(0))
    ring = F.get(part, F.lit(0))
    v = [F.get(ring, F.lit(i)) for i in range(5)]
    out = (g["kind"] == POLYGON) & (F.size(g["parts"]) == 1) & (F.size(part) == 1) & (F.size(ring) == 5)
    for p, q in zip(v, v[1:]):
        out = out & ((p["x"] == q["x"]) | (p["y"] == q["y"]))
    for p, q in ((v[0], v[2]), (v[1], v[3])):
        out = out & (p["x"] != q["x"]) & (p["y"] != q["y"])
    return F.coalesce(out & (v[0]["x"] == v[4]["x"]) & (v[0]["y"] == v[4]["y"]), F.lit(False))


def box_gap(a: Column, b: Column) -> Column:
    """Planar distance of two bounding boxes; 0 when they meet."""
    dx = F.greatest(a["xmin"] - b["xmax"], b["xmin"] - a["xmax"], F.lit(0.0))
    dy = F.greatest(a["ymin"] - b["ymax"], b["ymin"] - a["ymax"], F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def dimension(g: Column) -> Column:
    return F.when(is_puntal(g), 0).when(is_lineal(g), 1).when(is_areal(g), 2)


# --- segments ---------------------------------------------------------------------

def _segment(a: Column, b: Column) -> Column:
    return F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
    )


def ring_segments(ring: Column) -> Column:
    """Consecutive vertex pairs; a lone vertex is a segment of no length."""
    n = F.size(ring)
    pairs = F.zip_with(
        F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))),
        _segment,
    )
    return F.when(n == 1, F.transform(ring, lambda v: _segment(v, v))).otherwise(pairs)


def segments(g: Column) -> Column:
    return F.flatten(F.transform(F.flatten(g["parts"]), ring_segments))


def _orient(ax, ay, bx, by, px, py) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _in_span(s: Column, px: Column, py: Column) -> Column:
    return (
        (px >= F.least(s["x1"], s["x2"])) & (px <= F.greatest(s["x1"], s["x2"]))
        & (py >= F.least(s["y1"], s["y2"])) & (py <= F.greatest(s["y1"], s["y2"]))
    )


def _on_segment(s: Column, px: Column, py: Column, slack: float = 0.0) -> Column:
    turn = _orient(s["x1"], s["y1"], s["x2"], s["y2"], px, py)
    if not slack:
        return (turn == 0) & _in_span(s, px, py)
    return _point_segment_sq(s, px, py) <= slack * slack * (
        px * px + py * py + F.lit(1.0)
    )


def _point_segment_sq(s: Column, px: Column, py: Column) -> Column:
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    length = dx * dx + dy * dy
    along = F.when(length == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0),
            ((px - s["x1"]) * dx + (py - s["y1"]) * dy) / length))
    )
    ex, ey = s["x1"] + along * dx - px, s["y1"] + along * dy - py
    return ex * ex + ey * ey


def locate(segs: Column, px: Column, py: Column, slack: float = 0.0) -> Column:
    """Where a point lies against closed rings: 1 inside, 0 outside, -1 on the border.

    One pass over the segments; holes and several parts follow from the even-odd rule.
    """
    def step(state, s):
        straddles = (s["y1"] > py) != (s["y2"] > py)
        meets = px < (s["x2"] - s["x1"]) * (py - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]
        return (
            F.when(state < 0, state)
            .when(_on_segment(s, px, py, slack), F.lit(-1))
            .when(straddles & meets, F.lit(1) - state)
            .otherwise(state)
        )

    return F.aggregate(segs, F.lit(0), step)


def _segments_meet(a: Column, b: Column) -> Column:
    d1 = _orient(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    d2 = _orient(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    d3 = _orient(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    d4 = _orient(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    crossing = (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)
    return (
        crossing
        | ((d1 == 0) & _in_span(b, a["x1"], a["y1"]))
        | ((d2 == 0) & _in_span(b, a["x2"], a["y2"]))
        | ((d3 == 0) & _in_span(a, b["x1"], b["y1"]))
        | ((d4 == 0) & _in_span(a, b["x2"], b["y2"]))
    )


# --- predicates -------------------------------------------------------------------

def same_srid(a: Column, b: Column) -> Column:
    """True; two geometries of different reference systems are an error."""
    return F.when(a["srid"] != b["srid"], F.raise_error(F.concat(
        F.lit("mixed SRIDs: "), a["srid"], F.lit(" and "), b["srid"])).cast("boolean")).otherwise(F.lit(True))


def bbox_meets(a: Column, b: Column) -> Column:
    return (
        (a["bbox"]["xmin"] <= b["bbox"]["xmax"]) & (a["bbox"]["xmax"] >= b["bbox"]["xmin"])
        & (a["bbox"]["ymin"] <= b["bbox"]["ymax"]) & (a["bbox"]["ymax"] >= b["bbox"]["ymin"])
    )


def _bbox_covers(a: Column, b: Column) -> Column:
    return (
        (a["bbox"]["xmin"] <= b["bbox"]["xmin"]) & (a["bbox"]["xmax"] >= b["bbox"]["xmax"])
        & (a["bbox"]["ymin"] <= b["bbox"]["ymin"]) & (a["bbox"]["ymax"] >= b["bbox"]["ymax"])
    )


def _some_part_starts_in(a: Column, b: Column) -> Column:
    return let(segments(b), lambda rings: F.exists(
        a["parts"], lambda p: locate(rings, p[0][0]["x"], p[0][0]["y"]) != 0))


def st_intersects(a: Column, b: Column, ka: str | None = None, kb: str | None = None) -> Column:
    """The geometries share at least one point; borders count."""
    va, vb = first_vertex(a), first_vertex(b)
    point_a, point_b = of_kind(a, ka, POINT), of_kind(b, kb, POINT)
    area_a, area_b = of_kind(a, ka, POLYGON, MULTIPOLYGON), of_kind(b, kb, POLYGON, MULTIPOLYGON)

    def general():
        crossing = let(segments(b), lambda rings: F.exists(
            segments(a), lambda s: F.exists(rings, lambda t: _segments_meet(s, t))))
        out = crossing
        for applies, start, area in ((area_b, a, b), (area_a, b, a)):
            if applies is not False:
                starts = _some_part_starts_in(start, area)
                out = out | (starts if applies is True else applies & starts)
        return out

    return same_srid(a, b) & bbox_meets(a, b) & choose(
        (both(point_a, point_b), lambda: (va["x"] == vb["x"]) & (va["y"] == vb["y"])),
        (both(point_a, area_b), lambda: locate(segments(b), va["x"], va["y"]) != 0),
        (both(point_b, area_a), lambda: locate(segments(a), vb["x"], vb["y"]) != 0),
        (True, general))


def _cut_positions(s: Column, cutters: Column) -> Column:
    """Positions along ``s`` (0 to 1) where one of ``cutters`` meets it, ends included."""
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    length = dx * dx + dy * dy

    def position(px, py):
        return ((px - s["x1"]) * dx + (py - s["y1"]) * dy) / length

    def meets(c):
        ex, ey = c["x2"] - c["x1"], c["y2"] - c["y1"]
        cross = dx * ey - dy * ex
        along = ((c["x1"] - s["x1"]) * ey - (c["y1"] - s["y1"]) * ex) / cross
        return F.when(cross != 0, F.array(along)).otherwise(
            F.array(position(c["x1"], c["y1"]), position(c["x2"], c["y2"]))
        )

    found = F.flatten(F.transform(cutters, meets))
    inner = F.filter(found, lambda t: (t > 0) & (t < 1))
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), inner)))


def _piece_places(segs: Column, rings: Column) -> Column:
    """For each piece of ``segs`` cut at ``rings``: where its midpoint lies (see locate)."""
    def middles(cuts):
        return F.zip_with(
            F.slice(cuts, F.lit(1), F.size(cuts) - 1), F.slice(cuts, F.lit(2), F.size(cuts) - 1),
            lambda t, u: (t + u) / 2,
        )

    def of_segment(s):
        return F.transform(let(_cut_positions(s, rings), middles), lambda m: locate(
            rings, s["x1"] + m * (s["x2"] - s["x1"]), s["y1"] + m * (s["y2"] - s["y1"]),
            BORDER_SLACK,
        ))

    return F.flatten(F.transform(segs, of_segment))


def _inner_point(part: Column) -> Column:
    """A point strictly inside one polygon part: middle of a scan line's first span."""
    def crossings(y):
        segs = F.flatten(F.transform(part, ring_segments))
        crossing = F.filter(segs, lambda s: (s["y1"] > y) != (s["y2"] > y))
        return F.array_sort(F.transform(crossing, lambda s: (
            (s["x2"] - s["x1"]) * (y - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"])))

    def on_line(y):
        return let(crossings(y), lambda xs: F.struct(
            ((xs[0] + xs[1]) / 2).alias("x"), y.alias("y")))

    heights = F.array_sort(F.array_distinct(F.transform(F.flatten(part), lambda v: v["y"])))
    return let(let(heights, lambda ys: (ys[0] + ys[1]) / 2), on_line)


def _points(g: Column) -> Column:
    return _vertices(g["parts"])


def _covered(s: Column, path: Column) -> Column:
    """Whether the edges of ``path`` that lie on the line through ``s`` cover it without a gap.

    Their extents are compared along the axis on which ``s`` is longer, so given vertices are never moved.
    """
    steep = F.abs(s["y2"] - s["y1"]) > F.abs(s["x2"] - s["x1"])

    def extent(t):
        first, second = F.when(steep, t["y1"]).otherwise(t["x1"]), F.when(steep, t["y2"]).otherwise(t["x2"])
        return F.struct(F.least(first, second).alias("low"), F.greatest(first, second).alias("high"))

    def on_carrier(t):
        ends = (s["x1"], s["y1"], s["x2"], s["y2"])
        return (_orient(*ends, t["x1"], t["y1"]) == 0) & (_orient(*ends, t["x2"], t["y2"]) == 0)

    pieces = F.array_sort(F.transform(F.filter(path, on_carrier), extent))
    return let(extent(s), lambda whole: F.aggregate(
        pieces, whole["low"], lambda reach, p: F.when(p["low"] <= reach, F.greatest(reach, p["high"])).otherwise(reach)
    ) >= whole["high"])


def st_contains(a: Column, b: Column, ka: str | None = None, kb: str | None = None) -> Column:
    """No point of ``b`` lies outside ``a`` and the interiors meet.

    So a point on the border of a polygon is not contained.  A line that contains a line
    is not supported and raises.
    """
    vb = first_vertex(b)

    def all_in_some_inside(places):
        return F.forall(places, lambda s: s != 0) & F.exists(places, lambda s: s == 1)

    def area_points():
        return let(segments(a), lambda rings: let(
            F.transform(_points(b), lambda v: locate(rings, v["x"], v["y"])), all_in_some_inside))

    def area_line():
        return let(segments(a), lambda rings: let(
            _piece_places(segments(b), rings), all_in_some_inside))

    def area_area():
        def holds(pair):
            rings, inner_rings = pair["a"], pair["b"]

            def part_inside(part):
                return let(_inner_point(part), lambda q: locate(rings, q["x"], q["y"]) == 1)

            return (
                F.forall(_piece_places(inner_rings, rings), lambda s: s != 0)
                & ~F.exists(_piece_places(rings, inner_rings), lambda s: s == 1)
                & F.forall(b["parts"], part_inside)
            )

        return let(F.struct(segments(a).alias("a"), segments(b).alias("b")), holds)

    def line_points():
        # a line's border is the set of its open ends
        ends = F.flatten(F.transform(F.flatten(a["parts"]), lambda r: F.when(
            r[0] != F.element_at(r, -1), F.array(r[0], F.element_at(r, -1))
        ).otherwise(F.slice(r, 1, 0))))
        on_line = let(segments(a), lambda path: F.forall(_points(b), lambda v: F.exists(
            path, lambda s: _on_segment(s, v["x"], v["y"]))))
        return on_line & F.exists(_points(b), lambda v: ~F.array_contains(ends, v))

    def line_line():
        edges = F.filter(segments(b), lambda s: (s["x1"] != s["x2"]) | (s["y1"] != s["y2"]))
        return let(F.struct(segments(a).alias("path"), edges.alias("edges")), lambda pair: (
            (F.size(pair["edges"]) > 0) & F.forall(pair["edges"], lambda s: _covered(s, pair["path"]))))

    def among():
        return F.forall(_points(b), lambda v: F.exists(
            _points(a), lambda u: (u["x"] == v["x"]) & (u["y"] == v["y"])))

    area = of_kind(a, ka, POLYGON, MULTIPOLYGON)
    line = of_kind(a, ka, LINE, MULTILINE)
    points_a, points_b = of_kind(a, ka, POINT, MULTIPOINT), of_kind(b, kb, POINT, MULTIPOINT)
    line_b = of_kind(b, kb, LINE, MULTILINE)
    return same_srid(a, b) & _bbox_covers(a, b) & choose(
        (both(area, of_kind(b, kb, POINT)),
         lambda: locate(segments(a), vb["x"], vb["y"]) == 1),
        (both(area, points_b), area_points),
        (both(area, line_b), area_line),
        (both(area, of_kind(b, kb, POLYGON, MULTIPOLYGON)), area_area),
        (both(line, points_b), line_points),
        (both(line, line_b), line_line),
        (both(points_a, points_b), among),
        (True, lambda: F.lit(False)))


def st_within(a: Column, b: Column) -> Column:
    return st_contains(b, a)


# --- measures ---------------------------------------------------------------------

def st_distance(a: Column, b: Column, ka: str | None = None, kb: str | None = None) -> Column:
    """Shortest planar distance; 0 when the geometries meet."""
    va, vb = first_vertex(a), first_vertex(b)
    point_a, point_b = of_kind(a, ka, POINT), of_kind(b, kb, POINT)

    def apart(s, t):
        return F.least(
            _point_segment_sq(s, t["x1"], t["y1"]), _point_segment_sq(s, t["x2"], t["y2"]),
            _point_segment_sq(t, s["x1"], s["y1"]), _point_segment_sq(t, s["x2"], s["y2"]),
        )

    def straight():
        dx, dy = va["x"] - vb["x"], va["y"] - vb["y"]
        return F.sqrt(dx * dx + dy * dy)

    def to_segments(v, g):
        return F.sqrt(F.array_min(F.transform(
            segments(g), lambda s: _point_segment_sq(s, v["x"], v["y"]))))

    def nearest():
        return F.sqrt(let(segments(b), lambda others: F.array_min(F.transform(
            segments(a), lambda s: F.array_min(F.transform(others, lambda t: apart(s, t)))))))

    return F.when(same_srid(a, b), choose(
        (both(point_a, point_b), straight),
        (st_intersects(a, b, ka, kb), lambda: F.lit(0.0)),
        (point_a, lambda: to_segments(va, b)),
        (point_b, lambda: to_segments(vb, a)),
        (True, nearest)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _ring_signed_area(ring: Column) -> Column:
    # relative to the ring's first vertex, which keeps far-away rings accurate
    ox, oy = ring[0]["x"], ring[0]["y"]
    return _sum(F.transform(ring_segments(ring), lambda s: (
        (s["x1"] - ox) * (s["y2"] - oy) - (s["x2"] - ox) * (s["y1"] - oy)) / 2))


def st_area(g: Column) -> Column:
    """Planar area: outer rings less holes; 0 for points and lines."""
    def of_part(part):
        return let(F.transform(part, lambda r: F.abs(_ring_signed_area(r))),
                   lambda sizes: 2 * sizes[0] - _sum(sizes))

    return F.when(is_areal(g), _sum(F.transform(g["parts"], of_part))).when(
        g.isNotNull(), F.lit(0.0))


def _ring_turn(ring: Column, place: Column) -> Column:
    """1 or -1, so that outer rings add and holes subtract, whatever their orientation."""
    return F.signum(_ring_signed_area(ring)) * F.when(place == 0, 1.0).otherwise(-1.0)


def _segment_length(s: Column) -> Column:
    dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
    return F.sqrt(dx * dx + dy * dy)


def st_perimeter(g: Column) -> Column:
    """Planar length of all rings of a polygon; 0 for points and lines."""
    return F.when(is_areal(g), _sum(F.transform(segments(g), _segment_length))).when(
        g.isNotNull(), F.lit(0.0))


def st_centroid(g: Column) -> Column:
    """Planar centroid as ``struct<x, y>``."""
    return let(g, _centroid_of)


def _centroid_of(g: Column) -> Column:
    ox, oy = first_vertex(g)["x"], first_vertex(g)["y"]

    def mean(items):
        total = _sum(F.transform(items, lambda i: i["w"]))
        return F.struct(
            (ox + _sum(F.transform(items, lambda i: i["w"] * i["x"])) / total).alias("x"),
            (oy + _sum(F.transform(items, lambda i: i["w"] * i["y"])) / total).alias("y"),
        )

    def weighted(items: Column) -> Column:
        return let(items, mean)

    def item(w, x, y):
        return F.struct(w.alias("w"), x.alias("x"), y.alias("y"))

    points = F.transform(_points(g), lambda v: item(F.lit(1.0), v["x"] - ox, v["y"] - oy))
    lines = F.transform(segments(g), lambda s: item(
        _segment_length(s), (s["x1"] + s["x2"]) / 2 - ox, (s["y1"] + s["y2"]) / 2 - oy))

    def ring_items(ring, place):
        def triangle(s, turn):
            x1, y1, x2, y2 = s["x1"] - ox, s["y1"] - oy, s["x2"] - ox, s["y2"] - oy
            return item(turn * (x1 * y2 - x2 * y1) / 2, (x1 + x2) / 3, (y1 + y2) / 3)

        return let(_ring_turn(ring, place), lambda turn: F.transform(
            ring_segments(ring), lambda s: triangle(s, turn)))

    areas = F.flatten(F.transform(
        g["parts"], lambda p: F.flatten(F.transform(p, lambda r, i: ring_items(r, i)))))
    return (
        F.when(g["kind"] == POINT, first_vertex(g))
        .when(is_puntal(g), weighted(points))
        .when(is_lineal(g), weighted(lines))
        .otherwise(weighted(areas))
    )


def st_intersection_area(a: Column, b: Column) -> Column:
    """Area shared by two polygons, for any valid polygons.

    A polygon is the signed sum of the strips below its edges, so the shared area is the
    sum over edge pairs of the integral of the lower of the two edges.  Two rectangles along the
    axes share a rectangle.
    """
    def strips(g):
        def of_ring(ring, place):
            # walked counter-clockwise, upper edges run towards smaller x
            return let(_ring_turn(ring, place), lambda turn: F.transform(
                ring_segments(ring), lambda s: F.struct(
                    s["x1"].alias("x1"), s["y1"].alias("y1"),
                    s["x2"].alias("x2"), s["y2"].alias("y2"),
                    (turn * F.signum(s["x1"] - s["x2"])).alias("sign"))))

        rings = F.flatten(F.transform(
            g["parts"], lambda p: F.flatten(F.transform(p, lambda r, i: of_ring(r, i)))))
        return F.filter(rings, lambda s: s["sign"] != 0)

    base = F.least(a["bbox"]["ymin"], b["bbox"]["ymin"])

    def shared(s, t):
        left = F.greatest(F.least(s["x1"], s["x2"]), F.least(t["x1"], t["x2"]))
        right = F.least(F.greatest(s["x1"], s["x2"]), F.greatest(t["x1"], t["x2"]))

        def height(e, x):
            return e["y1"] + (x - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"]) - base

        ends = F.struct(
            height(s, left).alias("p0"), height(s, right).alias("p1"),
            height(t, left).alias("q0"), height(t, right).alias("q1"))

        def below_both(h):
            g0, g1 = h["p0"] - h["q0"], h["p1"] - h["q1"]
            low = F.least(h["p0"], h["q0"]) + F.least(h["p1"], h["q1"])
            # when the edges cross, the lower envelope is bent upwards by a triangle
            bend = F.when(g0 * g1 < 0, F.abs(g0) * F.abs(g1) / (F.abs(g0) + F.abs(g1)))
            return (right - left) * (low + F.coalesce(bend, F.lit(0.0))) / 2

        return F.when(right > left, s["sign"] * t["sign"] * let(ends, below_both)).otherwise(
            F.lit(0.0))

    total = let(strips(b), lambda others: _sum(F.transform(strips(a), lambda s: _sum(F.transform(
        others, lambda t: shared(s, t))))))
    box_a, box_b = a["bbox"], b["bbox"]
    common = ((F.least(box_a["xmax"], box_b["xmax"]) - F.greatest(box_a["xmin"], box_b["xmin"]))
              * (F.least(box_a["ymax"], box_b["ymax"]) - F.greatest(box_a["ymin"], box_b["ymin"])))
    return F.when(is_areal(a) & is_areal(b) & bbox_meets(a, b), F.when(is_box(a) & is_box(b), common).otherwise(
        F.greatest(total, F.lit(0.0)))).otherwise(F.lit(0.0))


def st_envelope(g: Column) -> Column:
    box = g["bbox"]
    return F.when(g.isNotNull(), make_geometry(F.lit(POLYGON), g["srid"], F.array(F.array(F.array(
        vertex(box["xmin"], box["ymin"]), vertex(box["xmin"], box["ymax"]),
        vertex(box["xmax"], box["ymax"]), vertex(box["xmax"], box["ymin"]),
        vertex(box["xmin"], box["ymin"]))))))


# --- planar buffer ----------------------------------------------------------------

def circle_offsets() -> list[tuple[float, float]]:
    """Unit circle from (1, 0), clockwise and closed, with the buffer's arc vertices."""
    n = 4 * QUADRANT_SEGMENTS
    return [(math.cos(2 * math.pi * (k % n) / n), -math.sin(2 * math.pi * (k % n) / n))
            for k in range(n + 1)]


def _convex_outline(ring: Column, distance: Column) -> Column:
    """Outline at ``distance`` around a convex, counter-clockwise, open ring."""
    n = F.size(ring)
    step = math.pi / 2 / QUADRANT_SEGMENTS

    def corner(v, i):
        before, after = ring[(i + n - 1) % n], ring[(i + 1) % n]
        first = F.atan2(v["y"] - before["y"], v["x"] - before["x"]) - math.pi / 2
        second = F.atan2(after["y"] - v["y"], after["x"] - v["x"]) - math.pi / 2
        turn = F.pmod(second - first, F.lit(2 * math.pi))
        bend = F.struct(
            first.alias("start"), turn.alias("turn"),
            F.greatest(F.floor(turn / step + 0.5).cast("int"), F.lit(1)).alias("count"))

        def arc(c):
            return F.transform(F.sequence(F.lit(0), c["count"]), lambda k: F.struct(
                (v["x"] + distance * F.cos(c["start"] + c["turn"] * k / c["count"])).alias("x"),
                (v["y"] + distance * F.sin(c["start"] + c["turn"] * k / c["count"])).alias("y")))

        return let(bend, arc)

    return let(F.flatten(F.transform(ring, corner)),
               lambda path: F.concat(path, F.slice(path, 1, 1)))


def _is_convex(ring: Column) -> Column:
    n = F.size(ring)

    def turn(v, i):
        before, after = ring[(i + n - 1) % n], ring[(i + 1) % n]
        return _orient(before["x"], before["y"], v["x"], v["y"], after["x"], after["y"])

    return F.forall(F.transform(ring, turn), lambda t: t >= 0)


def st_buffer(g: Column, distance) -> Column:
    """Planar buffer of a point, a two-vertex line or a convex polygon without holes.

    Other shapes raise: their buffer needs a polygon union, as ``buffers.shape_buffer`` makes it.
    """
    both_in = F.struct(g.alias("g"), _double(distance).alias("d"))
    return let(both_in, lambda given: _buffer_of(given["g"], given["d"]))


def _buffer_of(g: Column, d: Column) -> Column:
    v = first_vertex(g)
    circle = F.array(*[F.struct((v["x"] + d * cx).alias("x"), (v["y"] + d * cy).alias("y"))
                       for cx, cy in circle_offsets()])
    outer = g["parts"][0][0]
    open_ring = F.slice(outer, F.lit(1), F.greatest(F.size(outer) - 1, F.lit(0)))
    ccw = F.when(_ring_signed_area(outer) < 0, F.reverse(open_ring)).otherwise(open_ring)
    simple = (F.size(g["parts"]) == 1) & (F.size(g["parts"][0]) == 1)
    unsupported = F.raise_error(F.lit(
        "buffer supports points, two-vertex lines and convex polygons without holes"
    )).cast(RING)
    ring = (
        F.when(d < 0, F.raise_error(F.lit("buffer distance must not be negative"))
               .cast(RING))
        .when(g["kind"] == POINT, circle)
        .when((g["kind"] == LINE) & (F.size(outer) == 2), _convex_outline(outer, d))
        .when((g["kind"] == POLYGON) & simple & let(ccw, _is_convex),
              let(ccw, lambda r: _convex_outline(r, d)))
        .otherwise(unsupported)
    )
    return F.when(g.isNotNull(), make_geometry(F.lit(POLYGON), g["srid"], F.array(F.array(ring))))
