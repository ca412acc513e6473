"""Joins on spatial predicates, as equality joins on grid cells plus an exact test.

When the covering side is small (its size is estimated and counted, never assumed) its cells are
broadcast, and the other side is at most dealt evenly to the tasks.  Otherwise both sides are shuffled
on the cell; crowded cells are salted, and AQE splits what is still skewed.

Points and rectangles along the axes are decided by their boxes; the exact test is for all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geodesic import (
    SPHERE_SLACK,
    check_model,
    distance_m,
    geodesic_box,
    reach_boxes,
    sphere_distance,
)
from tidemark.functions.geometry import (
    POINT,
    box_gap,
    is_box,
    same_srid,
    st_contains,
    st_distance,
    st_intersects,
)
from tidemark.operators import grid
from tidemark.operators._columns import named, names

Test = Callable[[Column, Column], Column]


def _box_covers(outer: Column, inner: Column) -> Column:
    return (
        (outer["xmin"] <= inner["xmin"]) & (outer["xmax"] >= inner["xmax"])
        & (outer["ymin"] <= inner["ymin"]) & (outer["ymax"] >= inner["ymax"])
    )


def _box_meets(a: Column, b: Column) -> Column:
    return (
        (a["xmin"] <= b["xmax"]) & (a["xmax"] >= b["xmin"])
        & (a["ymin"] <= b["ymax"]) & (a["ymax"] >= b["ymin"])
    )


# How a geometry is to be compared: only by the exact test, as a point, or as a rectangle.
_OTHER, _SPOT, _BOX = 0, 1, 2


def _formed(df: DataFrame, g: Column) -> DataFrame:
    return df.withColumn("_form", F.when(g["kind"] == POINT, _SPOT).when(is_box(g), _BOX).otherwise(_OTHER))


def _by_boxes(decided: Column, test: Test, ga: Column, gb: Column) -> Column:
    """``decided`` for pairs of points and rectangles, ``test`` for all others."""
    simple = (F.col("_form") != _OTHER) & (F.col("_b_form") != _OTHER)
    return F.when(simple, same_srid(ga, gb) & decided).otherwise(test(ga, gb))


def _holds(test: Test, ga: Column, gb: Column) -> Column:
    """``gb`` contains ``ga``, of pairs whose boxes do."""
    a, b, spot = grid.box_of(), grid.box_of("_b_"), F.col("_form") == _SPOT
    inside = ((a["xmin"] > b["xmin"]) & (a["xmin"] < b["xmax"]) & (a["ymin"] > b["ymin"]) & (a["ymin"] < b["ymax"]))
    return F.when((F.col("_b_form") == _BOX) & (F.col("_form") != _OTHER), same_srid(ga, gb) & (~spot | inside)) \
        .otherwise(test(ga, gb))


def _cell_join(looked_up: DataFrame, covered: DataFrame, extra: Column, small: bool,
               hot_rows: int | None = None, how: str = "inner") -> DataFrame:
    left, right, keys = looked_up, covered, list(grid.CELL)
    if small:
        left, right = grid.dealt(left), F.broadcast(right)
    else:
        left, right = grid.salt_hot_cells(left, right, hot_rows)
        keys += ["_salt_l", "_salt_r"]
    right = right.withColumnsRenamed({f"_{c}": f"_b_{c}" for c in (*grid.SIDES, "form")})
    on = extra
    for k in keys:
        right = right.withColumnRenamed(k, f"{k}_b")
        on = (F.col(k) == F.col(f"{k}_b")) & on
    return left.join(right, on, how)


def _covered(left: DataFrame, right: DataFrame, ga: Column, gb: Column, decision: Column, allow_broadcast: bool = True,
             hot_rows: int | None = None, how: str = "inner") -> DataFrame:
    """Left and right rows whose right box covers the left one and for which ``decision`` holds.

    The left side is looked up by one corner, so every pair is met exactly once.  A semi-join stops at a
    row's first match.
    """
    looked_up = grid.look_up(_formed(left, ga), ga["bbox"], grid.levels_in_use(right, gb["bbox"], grid.FINER))
    covered = grid.cover(_formed(right, gb), gb["bbox"], finer=grid.FINER)
    boxes = _box_covers(grid.box_of("_b_"), grid.box_of())
    small = allow_broadcast and grid.cells_fit_broadcast(right, gb)
    return _cell_join(looked_up, covered, boxes & decision, small, hot_rows, how)


def covered_pairs(left: DataFrame, right: DataFrame, left_geom: str, right_geom: str,
                  test: Test, allow_broadcast: bool = True, hot_rows: int | None = None,
                  sides: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Pairs where the right geometry contains the left one, by ``test(left, right)``.

    The columns are addressed by the names in ``sides``, e.g. ``"a.id"``.
    """
    a, b = sides
    ga, gb = F.col(f"{a}.{left_geom}"), F.col(f"{b}.{right_geom}")
    joined = _covered(left.alias(a), right.alias(b), ga, gb, _holds(test, ga, gb), allow_broadcast, hot_rows)
    return joined.select(f"{a}.*", f"{b}.*")


def meeting_pairs(left: DataFrame, right: DataFrame, left_geom: str, right_geom: str,
                  test: Test, extra: Column | None = None) -> DataFrame:
    """Pairs (a, b) that intersect, by ``test(a, b)``.

    Two boxes can share several cells; the pair is kept only in the cell that holds the
    lower left corner of their overlap, which needs no duplicate removal.
    """
    ga, gb = F.col(f"a.{left_geom}"), F.col(f"b.{right_geom}")
    left, right = _formed(left.alias("a"), ga), _formed(right.alias("b"), gb)
    decision = _by_boxes(F.lit(True), test, ga, gb)
    joined = _boxes_meet(left, right, ga["bbox"], gb["bbox"], grid.cells_fit_broadcast(right, gb),
                         decision if extra is None else extra & decision)
    return joined.select("a.*", "b.*")


def _boxes_meet(left: DataFrame, right: DataFrame, box_left: Column, box_right: Column, small: bool,
                extra: Column | None = None, how: str = "inner") -> DataFrame:
    """Rows of ``left`` and ``right`` whose boxes meet, each pair once; a semi-join takes any cell they share."""
    cells_a = grid.cover_levels(left, box_left, grid.levels_in_use(right, box_right))
    cells_b = grid.cover_levels(right, box_right, grid.levels_in_use(left, box_left))
    cells_b = cells_b.withColumnRenamed("_own", "_own_b")
    box_a, box_b, level = grid.box_of(), grid.box_of("_b_"), F.col("_level")
    condition = _box_meets(box_a, box_b)
    if how == "inner":
        condition = condition & (level == F.greatest("_own", "_own_b")) & (
            grid.cell_at(F.greatest(box_a["xmin"], box_b["xmin"]), level) == F.col("_cx")) & (
            grid.cell_at(F.greatest(box_a["ymin"], box_b["ymin"]), level) == F.col("_cy"))
    if extra is not None:
        condition = condition & extra
    return _cell_join(cells_a, cells_b, condition, small, how=how)


def _select(pairs: DataFrame, columns: Iterable[str | Column] | None) -> DataFrame:
    if columns is None:
        return pairs.select("a.*", "b.*")
    return pairs.select(*columns)


def within_join(
    left: DataFrame,
    right: DataFrame,
    left_geom: str = "geometry",
    right_geom: str = "geometry",
    columns: Iterable[str | Column] | None = None,
    where: Column | str | None = None,
    points: bool = False,
    allow_broadcast: bool = True,
    hot_rows: int | None = None,
) -> DataFrame:
    """Rows of ``left`` within rows of ``right``; all columns of both, or ``columns``.

    ``columns`` and ``where`` address the sides as ``a`` and ``b``, e.g. ``"a.id"``.
    ``points=True`` promises that ``left`` holds points only (checked per row), which
    makes for a much smaller test.  ``hot_rows`` is the crowding above which a cell is
    split when both sides are shuffled.
    """
    left, kind = _points_or_any(left, left_geom, points)
    pairs = covered_pairs(
        left, right, left_geom, right_geom, lambda a, b: st_contains(b, a, kb=kind),
        allow_broadcast, hot_rows)
    if where is not None:
        pairs = pairs.filter(where if isinstance(where, Column) else F.expr(f"({where})"))
    return _select(pairs, columns)


def intersects_join(
    left: DataFrame,
    right: DataFrame,
    left_geom: str = "geometry",
    right_geom: str = "geometry",
    columns: Iterable[str | Column] | None = None,
) -> DataFrame:
    return _select(
        meeting_pairs(left, right, left_geom, right_geom, st_intersects), columns)


def overlap_pairs(
    df: DataFrame, key: str, geom: str = "geometry", columns: Iterable[str | Column] | None = None
) -> DataFrame:
    """Pairs of rows of one table that intersect, each once (smaller key first)."""
    ordered = F.col(f"a.{key}") < F.col(f"b.{key}")
    return _select(meeting_pairs(df, df, geom, geom, st_intersects, ordered), columns)


# --- semi-joins -------------------------------------------------------------------

# Levels are merged four at a time for probing, so that geometries whose sizes differ by
# less than 16 times need a single probe.
PROBE_BAND = 4


def _probe_cells(ref: DataFrame, boxes: Column) -> tuple[DataFrame, list[int]] | None:
    """Cells of the reference with what lies in each, and their levels; None if too large to broadcast.

    The size is counted on the cells themselves, vertices included.
    """
    cells = grid.cover(ref.select(F.col("_ref"), boxes.alias("_reach")), F.col("_reach"), PROBE_BAND)
    vertices = F.aggregate(F.flatten(F.col("_ref")["parts"]), F.lit(0), lambda n, ring: n + F.size(ring))
    found = cells.groupBy("_level").agg(F.sum(F.lit(200) + 16 * vertices).alias("bytes")).collect()
    if sum(r["bytes"] or 0 for r in found) > grid.broadcast_limit(ref):
        return None
    held = cells.groupBy("_level", "_cx", "_cy").agg(F.collect_list(
        F.struct(F.col("_ref").alias("g"), grid.box_of().alias("reach"))).alias("_in_cell"))
    return held, sorted(r["_level"] for r in found)


def _keep_where_exists(df: DataFrame, geom: str, probe: tuple[DataFrame, list[int]], test: Test) -> DataFrame:
    """Rows with a match in a small reference: one scan of ``df`` and no shuffle.

    The row is looked up by the lower left corner of its box, so the boxes of the reference must hold
    every place where that corner can be.  A cell is one row of the broadcast side, so a row of ``df``
    stays one row on every level, and is kept if any level has a match.
    """
    held, levels = probe
    if not levels:
        return df.limit(0)
    out, hit, g = df, F.lit(False), F.col(geom)
    for n, level in enumerate(levels):
        here = held.filter(F.col("_level") == level).select(
            F.col("_cx").alias(f"_cx{n}"), F.col("_cy").alias(f"_cy{n}"), F.col("_in_cell").alias(f"_in{n}"))
        out = out.join(F.broadcast(here), (
            F.col(f"_cx{n}") == grid.cell_at(g["bbox"]["xmin"], F.lit(level)))
            & (F.col(f"_cy{n}") == grid.cell_at(g["bbox"]["ymin"], F.lit(level))), "left")
        hit = hit | F.coalesce(F.exists(
            F.col(f"_in{n}"), lambda r: _box_covers(r["reach"], g["bbox"]) & test(g, r["g"])), F.lit(False))
    return out.filter(hit).select(*[F.col(f"`{c}`") for c in df.columns])


def _keep_geometries(df: DataFrame, geom: str, matched: DataFrame) -> DataFrame:
    """Rows whose geometry is among the matched ones, ``a.g``."""
    found = matched.select(F.col("a.g").alias("_g")).distinct()
    return df.join(found, F.col(geom) == F.col("_g"), "left_semi")


def _geometries(df: DataFrame, geom: str, name: str) -> DataFrame:
    # copies of one geometry give the same answer, so each is tested once
    return df.select(F.col(geom).alias(name)).where(F.col(name).isNotNull()).distinct()


def contains_ref(df: DataFrame, ref: DataFrame, geom: str = "geometry",
                 ref_geom: str = "geometry", points: bool = False) -> DataFrame:
    """Rows of ``df`` that some geometry of ``ref`` contains."""
    df, kind = _points_or_any(df, geom, points)
    small = ref.select(F.col(ref_geom).alias("_ref"))

    def test(g, r):
        return st_contains(r, g, kb=kind)

    probe = _probe_cells(small, F.col("_ref")["bbox"]) if grid.fits_broadcast(small) else None
    if probe:
        return _keep_where_exists(df, geom, probe, test)
    a, b, ga, gb = _two_sides(df, geom, ref, ref_geom)
    return _keep_geometries(df, geom, _covered(a, b, ga, gb, _holds(test, ga, gb), how="left_semi"))


def _two_sides(df: DataFrame, geom: str, ref: DataFrame, ref_geom: str):
    """Both sides' distinct geometries as ``a.g`` and ``b.g``, and these columns."""
    return (_geometries(df, geom, "g").alias("a"), _geometries(ref, ref_geom, "g").alias("b"),
            F.col("a.g"), F.col("b.g"))


def intersects_ref(df: DataFrame, ref: DataFrame, geom: str = "geometry",
                   ref_geom: str = "geometry", points: bool = False) -> DataFrame:
    """Rows of ``df`` that intersect some geometry of ``ref``.

    ``points=True`` promises that ``df`` holds points only (checked per row); a small
    ``ref`` is then probed without shuffling ``df``.
    """
    df, kind = _points_or_any(df, geom, points)
    small = ref.select(F.col(ref_geom).alias("_ref"))

    def test(g, r):
        return st_intersects(g, r, kind)

    probe = _probe_cells(small, F.col("_ref")["bbox"]) if points and grid.fits_broadcast(small) else None
    if probe:
        return _keep_where_exists(df, geom, probe, test)
    a, b, ga, gb = _two_sides(df, geom, ref, ref_geom)
    decision = _by_boxes(F.lit(True), test, ga, gb)
    if points:
        return _keep_geometries(df, geom, _covered(a, b, ga, gb, decision, how="left_semi"))
    met = _boxes_meet(_formed(a, ga), _formed(b, gb), ga["bbox"], gb["bbox"], grid.cells_fit_broadcast(b, gb),
                      decision, "left_semi")
    return _keep_geometries(df, geom, met)


def _points_or_any(df: DataFrame, geom: str, points: bool) -> tuple[DataFrame, str | None]:
    return (_checked_points(df, geom), POINT) if points else (df, None)


def _checked_points(df: DataFrame, geom: str) -> DataFrame:
    g = F.col(geom)
    return df.filter(F.when(g["kind"] == POINT, True).when(g.isNotNull(), F.raise_error(
        F.lit("points=True needs a column of points")).cast("boolean")).otherwise(False))


def within_distance_test(unit: str, distance: float, model: str, ka: str | None = None,
                         kb: str | None = None) -> Test:
    """Exact test for ``distance(a, b) <= distance`` in SRID units or metres."""
    if unit == "srid":
        return lambda a, b: st_distance(a, b, ka, kb) <= distance
    return lambda a, b: distance_m(a, b, model, ka, kb) <= distance


def reach(g: Column, distance: float, unit: str) -> Column:
    """Boxes that hold everything within the distance of ``g``."""
    if unit == "m":
        return reach_boxes(g, distance)
    box = g["bbox"]
    return F.array(F.struct(
        (box["xmin"] - distance).alias("xmin"), (box["ymin"] - distance).alias("ymin"),
        (box["xmax"] + distance).alias("xmax"), (box["ymax"] + distance).alias("ymax")))


def dwithin_pairs(left: DataFrame, right: DataFrame, distance: float,
                  left_geom: str = "geometry", right_geom: str = "geometry",
                  unit: str = "m", model: str = "spheroid", points: bool = False) -> DataFrame:
    """Pairs (a, b) of geometries of ``left`` and ``right`` within a distance.

    ``points=True`` promises that ``left`` holds points only (checked per row), which are looked up by
    one cell per level; other geometries are joined by the cells of their boxes.
    """
    check_distance(distance, unit, model)
    ga, gb = F.col(f"a.{left_geom}"), F.col(f"b.{right_geom}")
    left, kind = _points_or_any(left, left_geom, points)
    test = within_distance_test(unit, distance, model, kind)
    joined = _within_reach(left.alias("a"), right.alias("b"), ga, gb, distance, unit, points,
                           _planar(distance, test, ga, gb) if unit == "srid" else None)
    if unit == "m":
        if model == "spheroid":
            # the cheap sphere distance decides most pairs before the numpy kernel runs
            joined = joined.filter(sphere_distance(ga, gb, kind) <= distance * (1 + SPHERE_SLACK))
        joined = joined.filter(test(ga, gb))
    return joined.select("a.*", "b.*").drop("_boxes", "_nth", "_reach")


def _planar(distance: float, test: Test, ga: Column, gb: Column) -> Column:
    """Whether a pair is within a distance in SRID units; boxes decide for points and rectangles."""
    return _by_boxes(box_gap(ga["bbox"], gb["bbox"]) <= distance, test, ga, gb)


def _within_reach(left: DataFrame, right: DataFrame, ga: Column, gb: Column, distance: float, unit: str,
                  points: bool, decision: Column | None = None, how: str = "inner") -> DataFrame:
    """Rows ``a`` and ``b`` whose boxes are within a distance and for which ``decision`` holds, each pair once."""
    small = grid.cells_fit_broadcast(right, gb)
    left, right = _formed(left, ga), _formed(right, gb)
    if points:
        near = right.select("*", F.explode(reach(gb, distance, unit)).alias("_reach"))
        looked_up = grid.look_up(left, ga["bbox"], grid.levels_in_use(near, F.col("_reach"), grid.FINER))
        covered = grid.cover(near, F.col("_reach"), finer=grid.FINER).drop("_reach")
        boxes = _box_covers(grid.box_of("_b_"), grid.box_of())
        return _cell_join(looked_up, covered, boxes if decision is None else boxes & decision, small, how=how)
    own = geodesic_box(ga) if unit == "m" else ga["bbox"]
    near = right.withColumn("_boxes", reach(gb, distance, unit)).select(
        "*", F.posexplode("_boxes").alias("_nth", "_reach"))
    if how == "inner":
        # of two boxes (across the antimeridian) the first that is met counts
        first = (F.col("_nth") == 0) | ~_box_meets(own, F.col("_boxes")[0])
        decision = first if decision is None else first & decision
    return _boxes_meet(left, near, own, F.col("_reach"), small, decision, how)


def dwithin_ref(df: DataFrame, ref: DataFrame, distance: float, geom: str = "geometry",
                ref_geom: str = "geometry", unit: str = "m", model: str = "spheroid",
                points: bool = False) -> DataFrame:
    """Rows of ``df`` within a distance of some geometry of ``ref``; ``points`` as in ``dwithin_pairs``."""
    check_distance(distance, unit, model)
    small = ref.select(F.col(ref_geom).alias("_ref"))
    native = points and (unit == "srid" or model == "sphere")
    near = small.withColumn("_near", F.explode(reach(F.col("_ref"), distance, unit)))
    probe = _probe_cells(near, F.col("_near")) if native and grid.fits_broadcast(small) else None
    if probe:
        test = within_distance_test(unit, distance, model, POINT)
        return _keep_where_exists(_checked_points(df, geom), geom, probe, test)
    df, kind = _points_or_any(df, geom, points)
    a, b, ga, gb = _two_sides(df, geom, ref, ref_geom)
    if unit == "m" and model == "spheroid":
        # a semi-join takes no Python function: the sphere decides what is near enough on any model
        sure = sphere_distance(ga, gb, kind) * (1 + SPHERE_SLACK) <= distance
        met = _within_reach(a, b, ga, gb, distance, unit, points, sure, "left_semi").select("a.g").distinct()
        rest = _geometries(df, geom, "g").join(met.withColumnRenamed("g", "_met"), F.col("g") == F.col("_met"), "left_anti")
        pairs = dwithin_pairs(rest, _geometries(ref, ref_geom, "g"), distance, "g", "g", unit, model, points)
        return _keep_geometries(df, geom, met.union(pairs.select("a.g")).alias("a"))
    test = within_distance_test(unit, distance, model, kind)
    decision = _planar(distance, test, ga, gb) if unit == "srid" else test(ga, gb)
    return _keep_geometries(df, geom, _within_reach(a, b, ga, gb, distance, unit, points, decision, "left_semi"))


def check_distance(distance: float, unit: str, model: str) -> None:
    if unit not in ("m", "srid"):
        raise ValueError("unit must be 'm' or 'srid'")
    if distance < 0:
        raise ValueError("distance must not be negative")
    check_model(model)


# --- aggregates per zone ----------------------------------------------------------

def zone_stats(
    zones: DataFrame,
    items: DataFrame,
    key: str | Iterable[str],
    aggregates: Mapping[str, Column | str],
    zone_geom: str = "geometry",
    item_geom: str = "geometry",
    counts: Iterable[str] = (),
    points: bool = False,
) -> DataFrame:
    """Aggregates of the items within each zone; zones without items are kept.

    Aggregates address the item as ``b``.  Names in ``counts`` are 0, not NULL, for an
    empty zone.
    """
    key = names(key)
    items, kind = _points_or_any(items, item_geom, points)
    pairs = covered_pairs(
        items, zones, item_geom, zone_geom, lambda a, b: st_contains(b, a, kb=kind),
        sides=("b", "z"))
    grouped = pairs.groupBy(*[F.col(f"z.{k}") for k in key]).agg(*named(aggregates))
    kept = zones.drop(zone_geom).join(grouped, key, "left")
    return kept.fillna(0, subset=names(counts)) if names(counts) else kept
