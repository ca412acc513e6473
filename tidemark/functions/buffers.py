"""Planar buffers of any shape, as an Arrow function.

A buffer is the union of simple pieces: the shape itself, a strip beside every edge, a fan at every
bend and end, a circle around every point.  All pieces run counter-clockwise, so a place belongs to
the buffer if their edges wind around it.  Edges are cut where they meet, on a grid of 1e-11 of the
extent; a cut edge is border if the winding is zero on one of its sides only.  Border edges are
chained to rings, and rings are sorted into shells and holes.

The work for one geometry is about linear in its edges while they are short against the whole; rows are
handled one by one, so memory follows the largest geometry.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.geometry import (
    GEOMETRY,
    LINE,
    MULTIPOLYGON,
    POINT,
    POLYGON,
    QUADRANT_SEGMENTS,
    circle_offsets,
    st_buffer,
)

# Grid steps of the extent; the coarser ones are for shapes whose cuts fall together on the finer ones.
GRIDS = (1e-11, 1e-10, 1e-9, 1e-8)
# Pairs of edges that are compared at once.
_AT_ONCE = 1_000_000
# Vertices of a shape whose union is kept for equal ones of the batch.
SMALL = 64


# --- pieces -----------------------------------------------------------------------

def _off(v, n, by):
    return v[0] + by * n[0], v[1] + by * n[1]


def _fan(v, n, by, turn, m):
    """From the offset along ``n`` to the one along ``m``, counter-clockwise by ``turn``."""
    count = max(1, round(turn / (math.pi / 2 / QUADRANT_SEGMENTS)))
    start = math.atan2(by * n[1], by * n[0])
    reach = abs(by)
    arc = [(v[0] + reach * math.cos(start + turn * k / count), v[1] + reach * math.sin(start + turn * k / count))
           for k in range(1, count)]
    return [v, _off(v, n, by), *arc, _off(v, m, by)]


def _path_pieces(path, d, closed, both):
    """Strips and fans along a path without repeated vertices; ``both`` sides or the right one only."""
    ends = list(zip(path, path[1:] + path[:1] if closed else path[1:]))
    normals = []
    for p, q in ends:
        dx, dy = q[0] - p[0], q[1] - p[1]
        size = math.hypot(dx, dy)
        normals.append((dy / size, -dx / size))
    out = []
    for (p, q), n in zip(ends, normals):
        strip = [_off(p, n, d), _off(q, n, d), q]
        out.append(strip + ([_off(q, n, -d), _off(p, n, -d)] if both else []) + [p])
    for i, (n, m) in enumerate(zip(normals, normals[1:] + normals[:1])):
        v = ends[i][1]
        if not closed and i == len(normals) - 1:
            out.append(_fan(v, n, d, math.pi, (-n[0], -n[1])))
            first = normals[0]
            out.append(_fan(path[0], first, -d, math.pi, (-first[0], -first[1])))
            break
        turn = math.atan2(n[0] * m[1] - n[1] * m[0], n[0] * m[0] + n[1] * m[1])
        if turn > 0:
            out.append(_fan(v, n, d, turn, m))
        elif turn < 0 and both:
            out.append(_fan(v, m, -d, -turn, n))
    return out


def _signed_area(ring) -> float:
    x, y = np.array(ring, float).T
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def _pieces(kind, parts, d):
    """Closed pieces, each a list of vertices."""
    out = []
    for part in parts:
        for i, ring in enumerate(part):
            path = [v for k, v in enumerate(ring) if not k or v != ring[k - 1]]
            closed = len(path) > 2 and path[0] == path[-1]
            path = path[:-1] if closed else path
            if kind.endswith(POINT) or len(path) == 1:
                out += [[_off(v, (cx, -cy), d) for cx, cy in circle_offsets()[:-1]] for v in path]
            elif kind.endswith(LINE):
                out += _path_pieces(path, d, closed, True)
            elif len(path) > 2:
                path = path if (_signed_area(path) > 0) == (i == 0) else path[::-1]
                out += [path, *_path_pieces(path, d, True, False)]
    return out


# --- union ------------------------------------------------------------------------

class _Unclear(Exception):
    """The cuts do not close to rings on this grid."""


def _chunks(counts):
    """Runs of rows with at most ``_AT_ONCE`` pairs, or one row."""
    ends, start = np.cumsum(counts), 0
    while start < len(counts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + _AT_ONCE, "right")))
        yield start, stop
        start = stop


def _pairs(first, counts, start, stop):
    """Row and partner numbers for rows ``start`` to ``stop``, each with ``counts`` partners from ``first`` on."""
    size = counts[start:stop]
    row = np.repeat(np.arange(start, stop), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[start:stop], size)


def _net(edges):
    """Edges without length dropped, equal ones counted, opposite ones set off: ``edges, count``."""
    edges = edges[(edges[:, :2] != edges[:, 2:]).any(axis=1)]
    back = (edges[:, 0] > edges[:, 2]) | (edges[:, 0] == edges[:, 2]) & (edges[:, 1] > edges[:, 3])
    one = np.where(back[:, None], edges[:, [2, 3, 0, 1]], edges)
    kept, of = np.unique(one, axis=0, return_inverse=True)
    count = np.bincount(of.ravel(), np.where(back, -1, 1), len(kept)).astype(np.int64)
    flip = count < 0
    kept[flip] = kept[flip][:, [2, 3, 0, 1]]
    return kept[count != 0], np.abs(count[count != 0])


def _cut(edges, count):
    """Edges cut at all places where they cross or touch."""
    order = np.argsort(np.minimum(edges[:, 0], edges[:, 2]), kind="stable")
    edges, count = edges[order], count[order]
    low = np.minimum(edges[:, :2], edges[:, 2:]) - 1
    high = np.maximum(edges[:, :2], edges[:, 2:]) + 1
    first = np.arange(len(edges)) + 1
    partners = np.maximum(np.searchsorted(low[:, 0], high[:, 0], "right") - first, 0)
    at, where, share = [], [], []

    def add(edge, point, t):
        inside = (t > 0) & (t < 1)
        at.append(edge[inside])
        where.append(np.rint(point[inside]))
        share.append(t[inside])

    for start, stop in _chunks(partners):
        i, j = _pairs(first, partners, start, stop)
        meet = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        i, j = i[meet], j[meet]
        p, r = edges[i, :2], edges[i, 2:] - edges[i, :2]
        q, s = edges[j, :2], edges[j, 2:] - edges[j, :2]
        rr, ss = np.hypot(*r.T), np.hypot(*s.T)
        denom = r[:, 0] * s[:, 1] - r[:, 1] * s[:, 0]
        apart = q - p
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (apart[:, 0] * s[:, 1] - apart[:, 1] * s[:, 0]) / denom
            u = (apart[:, 0] * r[:, 1] - apart[:, 1] * r[:, 0]) / denom
        cross = (np.abs(denom) > 1e-12 * rr * ss) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        point = p[cross] + t[cross, None] * r[cross]
        add(i[cross], point, t[cross])
        add(j[cross], point, u[cross])
        # ends that lie on the other edge
        for edge, other, base, along, size in ((i, j, p, r, rr), (j, i, q, s, ss)):
            for end in (edges[other, :2], edges[other, 2:]):
                gap = end - base
                near = np.abs(along[:, 0] * gap[:, 1] - along[:, 1] * gap[:, 0]) <= size
                t_end = (gap * along).sum(axis=1) / size ** 2
                add(edge[near], end[near], t_end[near])
    n = len(edges)
    edge = np.concatenate([np.arange(n), np.arange(n), *at])
    point = np.concatenate([edges[:, :2], edges[:, 2:], *where])
    t = np.concatenate([np.zeros(n), np.ones(n), *share])
    order = np.lexsort((t, edge))
    edge, point = edge[order], point[order]
    same = edge[:-1] == edge[1:]
    pieces = np.concatenate([point[:-1], point[1:]], axis=1)[same]
    return np.repeat(pieces, count[edge[:-1][same]], axis=0)


def _winding(at, skip, edges, count):
    """Winding number just right of each point of ``at``, which lies on the edge ``skip``."""
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    strips = max(1, len(edges) // 8)
    step = max((high.max() - low.min()) / strips, 1e-9)
    begin = ((low - low.min()) // step).astype(np.int64)
    spans = ((high - low.min()) // step).astype(np.int64) - begin + 1
    owner, strip = _pairs(begin, spans, 0, len(edges))
    order = np.argsort(strip, kind="stable")
    owner, strip = owner[order], strip[order]
    mine = ((at[:, 1] - low.min()) // step).astype(np.int64)
    first = np.searchsorted(strip, mine, "left")
    counts = np.searchsorted(strip, mine, "right") - first
    out = np.zeros(len(at), np.int64)
    for start, stop in _chunks(counts):
        row, entry = _pairs(first, counts, start, stop)
        other = owner[entry]
        x1, y1, x2, y2 = edges[other].T
        x, y = at[row].T
        up = y2 > y1
        hit = (np.minimum(y1, y2) <= y) & (y < np.maximum(y1, y2)) & (other != skip[row])
        with np.errstate(divide="ignore", invalid="ignore"):
            hit &= x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x
        out += np.bincount(row, np.where(hit, np.where(up, count[other], -count[other]), 0),
                           len(at)).astype(np.int64)
    return out


def _border(edges, count):
    """The edges with the union on one side only, directed to have it on their left."""
    middle = (edges[:, :2] + edges[:, 2:]) / 2
    dx, dy = edges[:, 2] - edges[:, 0], edges[:, 3] - edges[:, 1]
    steep = np.abs(dy) >= np.abs(dx)
    left = np.zeros(len(edges), np.int64)
    number = np.arange(len(edges))
    if steep.any():
        right_of = _winding(middle[steep], number[steep], edges, count)
        left[steep] = np.where(dy[steep] > 0, right_of + count[steep], right_of)
    if not steep.all():
        flat = ~steep
        # mirrored at the diagonal, so that "right of" is "above"; a mirror turns windings around
        above = -_winding(middle[flat][:, ::-1], number[flat], edges[:, [1, 0, 3, 2]], count)
        left[flat] = np.where(dx[flat] > 0, above, above + count[flat])
    right = left - count
    inner, outer = (left > 0) & (right <= 0), (left <= 0) & (right > 0)
    return np.concatenate([edges[inner], edges[outer][:, [2, 3, 0, 1]]])


def _rings(border):
    """Chains of the directed edges; at a place where several leave, the sharpest turn to the left."""
    leaving = defaultdict(list)
    arriving = defaultdict(int)
    for x1, y1, x2, y2 in border.tolist():
        leaving[x1, y1].append((x2, y2))
        arriving[x2, y2] += 1
    if any(len(to) != arriving[v] for v, to in leaving.items()) or any(v not in leaving for v in arriving):
        raise _Unclear
    out = []
    for start in list(leaving):
        while leaving[start]:
            path, place, here = [start], {start: 0}, start
            while True:
                to = leaving[here]
                if not to:
                    raise _Unclear
                if len(to) > 1 and len(path) > 1:
                    back = math.atan2(path[-2][1] - here[1], path[-2][0] - here[0])
                    to.sort(key=lambda v: -((back - math.atan2(v[1] - here[1], v[0] - here[0])) % (2 * math.pi)))
                here = to.pop()
                if here in place:
                    loop = path[place[here]:]
                    out.append(loop)
                    for v in loop[1:]:
                        del place[v]
                    path = path[:place[here] + 1]
                    if here == start:
                        break
                else:
                    place[here] = len(path)
                    path.append(here)
    return out


def _straightened(ring):
    """Without the vertices that lie on the line between their neighbours.

    Neighbours go one after the other: two that lie a step apart at a bend are each on the line to the other.
    """
    v = np.array(ring)
    while len(v) > 2:
        before, after = np.roll(v, 1, axis=0), np.roll(v, -1, axis=0)
        along, to = after - before, v - before
        off = np.abs(along[:, 0] * to[:, 1] - along[:, 1] * to[:, 0])
        gone = off <= np.hypot(*along.T)
        for i in np.flatnonzero(gone):
            gone[i] = not (i and gone[i - 1])
        if gone[0] and gone[-1]:
            gone[-1] = False
        if not gone.any():
            break
        v = v[~gone]
    return v


def _holds(ring, point) -> bool:
    x1, y1 = ring.T
    x2, y2 = np.roll(ring, -1, axis=0).T
    x, y = point
    meets = (y1 <= y) != (y2 <= y)
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool((meets & (x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x)).sum() % 2)


def _union(pieces, step):
    """Polygons of the union in grid steps: lists of rings, shell first."""
    edges = np.rint(np.concatenate([np.concatenate([p, np.roll(p, -1, axis=0)], axis=1) for p in map(np.array, pieces)])
                    / step)
    edges, count = _net(_cut(*_net(edges)))
    shells, holes = [], []
    for ring in _rings(_border(edges, count)):
        ring = _straightened(ring)
        if len(ring) < 3:
            continue
        area = _signed_area(ring)
        if abs(area) > np.hypot(*(ring - np.roll(ring, 1, axis=0)).T).sum():  # thinner ones are rounding
            (shells if area > 0 else holes).append((abs(area), ring))
    shells.sort(key=lambda s: s[0])
    polygons = [[ring] for _, ring in shells]
    for _, hole in holes:
        inside = next((p for p in polygons if _holds(p[0], (hole[0] + hole[1]) / 2)), None)
        if inside is None:
            raise _Unclear
        inside.append(hole)
    if not polygons:
        raise _Unclear
    return polygons


def buffer_parts(kind: str, parts: list, d: float, seen: dict | None = None) -> list:
    """Polygons of the buffer at distance ``d`` > 0; parts, rings and ``(x, y)`` vertices as nested lists.

    The union is made around the shape's middle, from vertices on the finest grid of its cuts.  ``seen`` keeps
    that of small shapes, so equal ones in different places, as buildings and grid cells are, are united once.
    """
    flat = [v for part in parts for ring in part for v in ring]
    xs, ys = [v[0] for v in flat], [v[1] for v in flat]
    (west, south), (east, north) = (min(xs), min(ys)), (max(xs), max(ys))
    ox, oy = (west + east) / 2, (south + north) / 2
    extent = float(f"{max(east - west, north - south) / 2 + d:.9g}")
    step = extent * GRIDS[0]
    moved = tuple(tuple(tuple((round((x - ox) / step) * step, round((y - oy) / step) * step) for x, y in ring)
                        for ring in part) for part in parts)
    key = (kind, moved, extent, d)
    made = seen.get(key) if seen is not None else None
    if made is None:
        made = _around(*key)
        if seen is not None and len(flat) <= SMALL:
            seen[key] = made
    return [[[(x + ox, y + oy) for x, y in ring] for ring in polygon] for polygon in made]


def _around(kind: str, moved: tuple, extent: float, d: float) -> list:
    pieces = _pieces(kind, moved, d)
    for grid in GRIDS:
        try:
            polygons = _union(pieces, extent * grid)
        except _Unclear:
            continue
        return [[[(x * extent * grid, y * extent * grid) for x, y in [*ring, ring[0]]] for ring in polygon]
                for polygon in polygons]
    raise ValueError(f"no buffer found for this {kind}")


_VERTEX = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_SHAPE = pa.struct([("kind", pa.string()), ("srid", pa.int32()), ("parts", pa.list_(pa.list_(pa.list_(_VERTEX)))),
                    ("bbox", pa.struct([(c, pa.float64()) for c in ("xmin", "ymin", "xmax", "ymax")]))])


@F.arrow_udf(GEOMETRY)
def _buffer_udf(kind: pa.Array, srid: pa.Array, parts: pa.Array, distance: pa.Array) -> pa.Array:
    out, seen = [], {}
    for k, number, p, d in zip(kind.to_pylist(), srid.to_pylist(), parts.to_pylist(), distance.to_pylist()):
        if k is None or p is None or d is None:
            out.append(None)
            continue
        polygons = buffer_parts(k, [[[(v["x"], v["y"]) for v in ring] for ring in part] for part in p], d, seen)
        xs, ys = zip(*(v for polygon in polygons for v in polygon[0]))
        out.append({
            "kind": POLYGON if len(polygons) == 1 else MULTIPOLYGON, "srid": number,
            "parts": [[[{"x": x, "y": y} for x, y in ring] for ring in polygon] for polygon in polygons],
            "bbox": {"xmin": min(xs), "ymin": min(ys), "xmax": max(xs), "ymax": max(ys)}})
    return pa.array(out, _SHAPE)


def shape_buffer(g: Column, distance) -> Column:
    """Planar buffer of any geometry: a polygon, or a multi-polygon where it falls into pieces.

    Points and two-vertex lines take the native ``st_buffer``.  At distance 0 an areal geometry is its own
    buffer, and that of a line or several points is empty, so null.  A null geometry or distance gives null;
    a negative distance raises.  ``g`` must be a plain column, since Catalyst moves no Python function
    out of a lambda.
    """
    d = (distance if isinstance(distance, Column) else F.lit(distance)).cast("double")
    d = F.when(d < 0, F.raise_error(F.lit("buffer distance must not be negative")).cast("double")).otherwise(d)
    native = (g["kind"] == POINT) | (g["kind"] == LINE) & (F.size(g["parts"][0][0]) == 2) & (
        g["parts"][0][0][0] != g["parts"][0][0][1])
    areal = g["kind"].isin(POLYGON, MULTIPOLYGON)
    rest = ~native & (d > 0)
    union = _buffer_udf(F.when(rest, g["kind"]), g["srid"], F.when(rest, g["parts"]), d)
    return (F.when(native & d.isNotNull() & ((d > 0) | (g["kind"] == POINT)), st_buffer(g, d))
            .when(areal & (d == 0), g).otherwise(union))
