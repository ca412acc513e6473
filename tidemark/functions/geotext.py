"""Geometry from and to WKT, GeoJSON and WKB.

Text forms are parsed by native string functions over columns; WKB goes through one
Arrow function per direction.  Literal arguments are parsed once on the driver.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geometry import (
    DEFAULT_SRID,
    GEOMETRY,
    KINDS,
    LINE,
    MULTILINE,
    MULTIPOINT,
    MULTIPOLYGON,
    PARTS,
    POINT,
    POLYGON,
    let,
    make_geometry,
    vertex,
)

# WKB type codes and the GeoJSON names of the kinds.
WKB_CODES = {POINT: 1, LINE: 2, POLYGON: 3, MULTIPOINT: 4, MULTILINE: 5, MULTIPOLYGON: 6}
GEOJSON_NAMES = {
    POINT: "Point", LINE: "LineString", POLYGON: "Polygon",
    MULTIPOINT: "MultiPoint", MULTILINE: "MultiLineString", MULTIPOLYGON: "MultiPolygon",
}
EWKB_SRID_FLAG = 0x20000000


# --- WKT columns ------------------------------------------------------------------

def _number_text(value: Column) -> Column:
    # whole numbers without a fraction, others in the shortest form that reads back equal
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string"))


def _bad_text(what: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"not a supported {what}: "), value)).cast(PARTS)


def _coordinates(text: Column, depth: int) -> Column:
    """JSON coordinates nested ``depth`` deep, as vertices nested one less."""
    def vertices(value, level):
        if level == 1:
            return vertex(value[0], value[1])
        return F.transform(value, lambda inner: vertices(inner, level - 1))

    return vertices(F.from_json(text, "array<" * depth + "double" + ">" * depth), depth)


def st_from_wkt(text: Column, srid: int = DEFAULT_SRID) -> Column:
    """Geometry from WKT; an ``SRID=n;`` prefix wins over ``srid``."""
    head = r"(?i)^\s*(?:SRID=(\d+);)?\s*([A-Z]+)\s*(?=\()"
    tag, kind = F.regexp_extract(text, head, 1), F.upper(F.regexp_extract(text, head, 2))
    # coordinates as JSON: brackets for parentheses and around each vertex
    bare = F.regexp_replace(text, head, "")
    body = F.when(bare.rlike(r"[^\d]\.\d"), F.regexp_replace(
        bare, r"(?<![\d.])\.(?=\d)", "0.")).otherwise(bare)
    pairs = F.regexp_replace(
        body, r"([-+.\dEe]+)\s+([-+.\dEe]+)(?:\s+[-+.\dEe]+)*", "[$1,$2]")
    as_json = F.replace(F.replace(pairs, F.lit("("), F.lit("[")), F.lit(")"), F.lit("]"))
    taken = F.struct(text.alias("text"), tag.alias("tag"), kind.alias("kind"),
                     as_json.alias("json"))
    return let(taken, lambda t: _wkt_geometry(t["text"], t["tag"], t["kind"], t["json"], srid))


def _wkt_geometry(text: Column, tag: Column, kind: Column, coords: Column, srid: int) -> Column:
    # a multipoint may or may not wrap its points in parentheses of their own
    flat = F.regexp_replace(F.regexp_replace(coords, r"\[\s*\[\s*\[", "[["), r"\]\s*\](?=\s*,)", "]")
    flat = F.regexp_replace(F.regexp_replace(flat, r",\s*\[\s*\[", ",["), r"\]\s*\]\s*\]\s*$", "]]")
    parts = (
        F.when(kind.isin(POINT, LINE), F.array(F.array(_coordinates(coords, 2))))
        .when(kind == MULTIPOINT, F.transform(
            _coordinates(flat, 2), lambda v: F.array(F.array(v))))
        .when(kind == POLYGON, F.array(_coordinates(coords, 3)))
        .when(kind == MULTILINE, F.transform(_coordinates(coords, 3), lambda r: F.array(r)))
        .when(kind == MULTIPOLYGON, _coordinates(coords, 4))
    )
    checked = let(parts, lambda p: F.when(
        text.isNull() | (p.isNotNull() & ~_broken(p)), p
    ).otherwise(_bad_text("WKT", text)))
    return make_geometry(kind, F.when(tag != "", tag.cast("int")).otherwise(F.lit(srid)), checked)


def _broken(parts: Column) -> Column:
    """Some part, ring or vertex is missing."""
    vertices = F.flatten(F.flatten(parts))
    return vertices.isNull() | F.exists(
        vertices, lambda v: v["x"].isNull() | v["y"].isNull())


def st_as_wkt(g: Column) -> Column:
    return let(g, _wkt_of)


def _wkt_of(g: Column) -> Column:
    def point(v):
        return F.concat_ws(" ", _number_text(v["x"]), _number_text(v["y"]))

    def ring(r):
        return F.concat(F.lit("("), F.array_join(F.transform(r, point), ","), F.lit(")"))

    def part(p):
        return F.concat(F.lit("("), F.array_join(F.transform(p, ring), ","), F.lit(")"))

    flat = F.flatten(g["parts"])
    body = (
        F.when(g["kind"].isin(POINT, LINE), ring(flat[0]))
        .when(g["kind"] == POLYGON, part(g["parts"][0]))
        .when(g["kind"].isin(MULTIPOINT, MULTILINE),
              F.concat(F.lit("("), F.array_join(F.transform(flat, ring), ","), F.lit(")")))
        .otherwise(F.concat(
            F.lit("("), F.array_join(F.transform(g["parts"], part), ","), F.lit(")")))
    )
    return F.concat(g["kind"], body)


# --- GeoJSON columns --------------------------------------------------------------

def st_from_geojson(text: Column, srid: int = DEFAULT_SRID) -> Column:
    taken = F.struct(
        text.alias("text"), F.upper(F.get_json_object(text, "$.type")).alias("kind"),
        F.get_json_object(text, "$.coordinates").alias("coords"))
    return let(taken, lambda t: _json_geometry(t["text"], t["kind"], t["coords"], srid))


def _json_geometry(text: Column, kind: Column, coords: Column, srid: int) -> Column:
    parts = (
        F.when(kind == POINT, F.array(F.array(F.array(_coordinates(coords, 1)))))
        .when(kind == LINE, F.array(F.array(_coordinates(coords, 2))))
        .when(kind == MULTIPOINT, F.transform(
            _coordinates(coords, 2), lambda v: F.array(F.array(v))))
        .when(kind == POLYGON, F.array(_coordinates(coords, 3)))
        .when(kind == MULTILINE, F.transform(_coordinates(coords, 3), lambda r: F.array(r)))
        .when(kind == MULTIPOLYGON, _coordinates(coords, 4))
    )
    checked = let(parts, lambda p: F.when(
        text.isNull() | (p.isNotNull() & ~_broken(p)), p
    ).otherwise(_bad_text("GeoJSON geometry", text)))
    return make_geometry(kind, F.lit(srid), checked)


def st_as_geojson(g: Column) -> Column:
    return let(g, _json_of)


def _json_of(g: Column) -> Column:
    def point(v):
        return F.concat(
            F.lit("["), _number_text(v["x"]), F.lit(","), _number_text(v["y"]), F.lit("]"))

    def listed(items):
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))

    def ring(r):
        return listed(F.transform(r, point))

    def part(p):
        return listed(F.transform(p, ring))

    flat = F.flatten(g["parts"])
    coords = (
        F.when(g["kind"] == POINT, point(flat[0][0]))
        .when(g["kind"] == LINE, ring(flat[0]))
        .when(g["kind"] == MULTIPOINT, ring(F.flatten(flat)))
        .when(g["kind"] == POLYGON, part(g["parts"][0]))
        .when(g["kind"] == MULTILINE, part(flat))
        .otherwise(listed(F.transform(g["parts"], part)))
    )
    label = F.create_map(*[F.lit(x) for kv in GEOJSON_NAMES.items() for x in kv])[g["kind"]]
    return F.concat(
        F.lit('{"type":"'), label, F.lit('","coordinates":'), coords, F.lit("}"))


# --- WKB columns ------------------------------------------------------------------

def _write_wkb(kind, srid, xy, rings, parts) -> bytes:
    """EWKB bytes of one geometry given flat coordinates, ring sizes and part sizes."""
    code = WKB_CODES[kind]
    head = struct.pack("<BII", 1, code | EWKB_SRID_FLAG, srid)
    coords, at, ring_no, bodies = np.asarray(xy, "<f8"), 0, 0, []
    for count in parts:
        sizes = rings[ring_no:ring_no + count]
        ring_no += count
        chunks = []
        for size in sizes:
            chunks.append((size, coords[2 * at:2 * (at + size)].tobytes()))
            at += size
        if code in (1, 4):
            bodies.append(chunks[0][1])
        elif code in (2, 5):
            bodies.append(struct.pack("<I", chunks[0][0]) + chunks[0][1])
        else:
            bodies.append(struct.pack("<I", len(chunks))
                          + b"".join(struct.pack("<I", n) + raw for n, raw in chunks))
    if code <= 3:
        return head + bodies[0]
    member = struct.pack("<BI", 1, code - 3)
    return head + struct.pack("<I", len(bodies)) + b"".join(member + b for b in bodies)


def _read_wkb(raw: bytes) -> dict:
    """Flat coordinates, ring sizes and part sizes of one WKB or EWKB value."""
    names = {code: kind for kind, code in WKB_CODES.items()}
    xy: list[float] = []
    rings: list[int] = []
    parts: list[int] = []

    def header(at):
        order = "<" if raw[at] == 1 else ">"
        code, = struct.unpack_from(order + "I", raw, at + 1)
        at, srid = at + 5, None
        if code & EWKB_SRID_FLAG:
            srid, = struct.unpack_from(order + "I", raw, at)
            at += 4
        code &= ~EWKB_SRID_FLAG
        if code not in names:
            raise ValueError(f"unsupported WKB type {code}")
        return order, code, srid, at

    def path(order, at, n):
        xy.extend(struct.unpack_from(f"{order}{2 * n}d", raw, at))
        rings.append(n)
        return at + 16 * n

    def simple(order, code, at):
        count = 1
        if code == 1:
            at = path(order, at, 1)
        elif code == 2:
            n, = struct.unpack_from(order + "I", raw, at)
            at = path(order, at + 4, n)
        else:
            count, = struct.unpack_from(order + "I", raw, at)
            at += 4
            for _ in range(count):
                n, = struct.unpack_from(order + "I", raw, at)
                at = path(order, at + 4, n)
        parts.append(count)
        return at

    order, code, srid, at = header(0)
    if code <= 3:
        simple(order, code, at)
    else:
        members, = struct.unpack_from(order + "I", raw, at)
        at += 4
        for _ in range(members):
            inner_order, inner, _, at = header(at)
            at = simple(inner_order, inner, at)
    return {"kind": names[code], "srid": srid, "xy": xy, "rings": rings, "parts": parts}


@F.arrow_udf(T.BinaryType())
def _wkb_of(kind: pa.Array, srid: pa.Array, xy: pa.Array, rings: pa.Array,
            parts: pa.Array) -> pa.Array:
    columns = (c.to_pylist() for c in (kind, srid, xy, rings, parts))
    return pa.array([None if k is None else _write_wkb(k, s, p, r, q)
                     for k, s, p, r, q in zip(*columns)], pa.binary())


def _nested(values: pa.Array, sizes: list[int]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


@F.arrow_udf(GEOMETRY)
def _geometry_of(raw: pa.Array, default_srid: pa.Array) -> pa.Array:
    found = [None if b is None else _read_wkb(b) for b in raw.to_pylist()]
    given = [g for g in found if g is not None]
    coords = np.array([v for g in given for v in g["xy"]], float).reshape(-1, 2)
    vertices = pa.StructArray.from_arrays(
        [pa.array(coords[:, 0]), pa.array(coords[:, 1])], ["x", "y"])
    rings = _nested(vertices, [n for g in given for n in g["rings"]])
    parts = _nested(rings, [n for g in given for n in g["parts"]])
    geometries = _nested(parts, [len(g["parts"]) for g in given])
    starts = np.cumsum([0] + [len(g["xy"]) // 2 for g in given])[:-1]
    low, high = np.zeros((0, 2)), np.zeros((0, 2))
    if given:
        low, high = np.minimum.reduceat(coords, starts), np.maximum.reduceat(coords, starts)
    box = pa.StructArray.from_arrays(
        [pa.array(c) for c in (low[:, 0], low[:, 1], high[:, 0], high[:, 1])],
        ["xmin", "ymin", "xmax", "ymax"])
    srids = [s if g["srid"] is None else g["srid"]
             for g, s in zip(found, default_srid.to_pylist()) if g is not None]
    made = pa.StructArray.from_arrays(
        [pa.array([g["kind"] for g in given], pa.string()), pa.array(srids, pa.int32()),
         geometries, box], ["kind", "srid", "parts", "bbox"])
    # NULL values kept their place; put them back between the geometries
    places = np.cumsum([g is not None for g in found]) - 1
    return made.take(pa.array([int(i) if g is not None else None
                               for i, g in zip(places, found)], pa.int64()))


def st_as_wkb(g: Column) -> Column:
    """EWKB with the SRID."""
    flat = F.flatten(g["parts"])
    xy = F.flatten(F.transform(F.flatten(flat), lambda v: F.array(v["x"], v["y"])))
    return _wkb_of(g["kind"], g["srid"], xy, F.transform(flat, F.size),
                   F.transform(g["parts"], F.size))


def st_from_wkb(raw: Column, srid: int = DEFAULT_SRID) -> Column:
    """Geometry from WKB or EWKB; an embedded SRID wins over ``srid``."""
    return _geometry_of(raw, F.lit(srid))


# --- literal arguments ------------------------------------------------------------

@dataclass(frozen=True)
class Shape:
    """A constant geometry given by the caller."""

    kind: str
    srid: int
    parts: tuple

    def __post_init__(self):
        if self.kind not in KINDS or not self.vertices:
            raise ValueError(f"unsupported geometry: {self.kind}")

    @property
    def vertices(self) -> list[tuple[float, float]]:
        return [p for part in self.parts for ring in part for p in ring]

    @property
    def column(self) -> Column:
        """The geometry as a literal, which Catalyst folds once per query."""
        xs, ys = [float(p[0]) for p in self.vertices], [float(p[1]) for p in self.vertices]
        parts = F.array(*[F.array(*[F.array(*[vertex(float(x), float(y)) for x, y in ring])
                                    for ring in part]) for part in self.parts])
        return F.struct(
            F.lit(self.kind).alias("kind"), F.lit(self.srid).alias("srid"), parts.alias("parts"),
            F.struct(F.lit(min(xs)).alias("xmin"), F.lit(min(ys)).alias("ymin"),
                     F.lit(max(xs)).alias("xmax"), F.lit(max(ys)).alias("ymax")).alias("bbox"))


def _nest(kind: str, coords: Any) -> list:
    """GeoJSON-style coordinates as part, ring, vertex."""
    def pair(p):
        return (p[0], p[1])

    if kind == POINT:
        return [[[pair(coords)]]]
    if kind == LINE:
        return [[[pair(p) for p in coords]]]
    if kind == MULTIPOINT:
        return [[[pair(p)]] for p in coords]
    if kind == POLYGON:
        return [[[pair(p) for p in ring] for ring in coords]]
    if kind == MULTILINE:
        return [[[pair(p) for p in path]] for path in coords]
    if kind == MULTIPOLYGON:
        return [[[pair(p) for p in ring] for ring in part] for part in coords]
    raise ValueError(f"unsupported geometry: {kind}")


def _wkt_coordinates(text: str) -> tuple[str, Any, int | None]:
    match = re.match(r"(?is)^\s*(?:SRID=(\d+);)?\s*([A-Z]+)\s*(\(.*\))\s*$", text)
    if match is None:
        raise ValueError(f"not a supported WKT: {text!r}")
    kind = match.group(2).upper()
    listed = re.sub(
        r"([-+.\deE]+)\s+([-+.\deE]+)(?:\s+[-+.\deE]+)*", r"[\1,\2]", match.group(3))
    listed = listed.replace("(", "[").replace(")", "]")
    try:
        coords = json.loads(re.sub(r"(?<![\d.])\.(\d)", r"0.\1", listed))
    except json.JSONDecodeError as error:
        raise ValueError(f"not a supported WKT: {text!r}") from error
    if kind == POINT:
        coords = coords[0]
    elif kind == MULTIPOINT:
        coords = [p[0] if isinstance(p[0], list) else p for p in coords]
    return kind, coords, int(match.group(1)) if match.group(1) else None


def shape(
    point: tuple[float, float] | None = None,
    wkt: str | None = None,
    geojson: Mapping | str | None = None,
    srid: int = DEFAULT_SRID,
) -> Shape:
    """A constant geometry from exactly one of the three forms."""
    if sum(v is not None for v in (point, wkt, geojson)) != 1:
        raise ValueError("give exactly one of point, wkt, geojson")
    if point is not None:
        return Shape(POINT, srid, (((tuple(point),),),))
    if wkt is not None:
        kind, coords, tagged = _wkt_coordinates(wkt)
        return Shape(kind, srid if tagged is None else tagged, _nest(kind, coords))
    doc = json.loads(geojson) if isinstance(geojson, str) else geojson
    kind = str(doc["type"]).upper()
    return Shape(kind, srid, _nest(kind, doc["coordinates"]))


def literal_geometry(**form) -> Column:
    """:func:`shape` as a column."""
    return shape(**form).column
