"""Zones less land, as geometry: areas, parts, slivers, and the pieces that a zone consists of.

Land is cut to square cells once, each polygon by halves, so that a zone meets only the land
of the cells that it touches, by an equality join.  All strips of a zone lie along one
bearing; in coordinates along and aside of it they are upright rectangles.  There a zone is
swept in slabs between all corners and crossings, in which no two boundaries cross: what is
left of the rectangles between the land's edges are trapezoids, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.lineage import kept
from ..functions.stats import holds

#: Lengths below this, in the units of the coordinates, are none.
NEAR = 1e-7
ZONES_PER_TASK = 20_000
#: Pairs of edges that are compared at once.
PAIRS = 1 << 20
_RINGS = f"array<{G.LINE}>"


def signed_area(ring: np.ndarray) -> float:
    """Positive for a ring that turns to the left."""
    moved = ring - ring[0]  # large coordinates lose no digits
    x, y = moved[:, 0], moved[:, 1]
    return float(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2


def clipped_half(ring: np.ndarray, axis: int, at: float, below: bool) -> np.ndarray:
    """The part of a ring on one side of a line across an axis; where it leaves and enters again, it follows the line."""
    beyond = (ring[:, axis] - at) * (1 if below else -1)
    after, follows = np.roll(ring, -1, 0), np.roll(beyond, -1)
    inside = beyond <= 0
    leaves = np.flatnonzero(inside != (follows <= 0))
    share = beyond[leaves] / (beyond[leaves] - follows[leaves])
    met = ring[leaves] + (after[leaves] - ring[leaves]) * share[:, None]
    met[:, axis] = at
    stay = np.flatnonzero(inside)
    order = np.argsort(np.concatenate([2 * stay, 2 * leaves + 1]), kind="stable")
    return np.concatenate([ring[stay], met])[order]


def ring_cells(ring: np.ndarray, cell: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(column, row, ring) of the cells that a ring touches, with its part there."""
    todo = [ring]
    while todo:
        part = todo.pop()
        if len(part) < 3 or not signed_area(part):
            continue
        low = np.floor(part.min(0) / cell).astype(np.int64)
        high = np.maximum(np.ceil(part.max(0) / cell).astype(np.int64) - 1, low)
        axis = int((high - low).argmax())
        if high[axis] == low[axis]:
            yield int(low[0]), int(low[1]), part
            continue
        at = float((low[axis] + high[axis] + 1) // 2 * cell)
        todo += [clipped_half(part, axis, at, True), clipped_half(part, axis, at, False)]


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner of each of so many, and its place with its owner."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _together(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of indexes of equal numbers; b ascends."""
    first = np.searchsorted(b, a, "left")
    i, place = _ragged(np.searchsorted(b, a, "right") - first)
    return i, first[i] + place


_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


def _values(points: pa.StructArray) -> np.ndarray:
    """Rows of a struct's fields, as doubles."""
    return np.stack([points.field(i).to_numpy(zero_copy_only=False).astype(float) for i in range(points.type.num_fields)], 1).reshape(-1, points.type.num_fields)


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _rings(points: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return _lists(counts, pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], fields=list(_POINT)))


def _after(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The index that follows each one in its ring; rings lie one after another."""
    after = np.arange(1, counts.sum() + 1)
    after[(starts + counts - 1)[counts > 0]] = starts[counts > 0]
    return after


def land_cells(polygons: DataFrame, cell: float) -> DataFrame:
    """(cx, cy, ring) of polygons (`rings`, the first of each its outer one): outer rings turn left, holes right.

    Rings may be closed or not.  Null and empty polygons have none, nor do rings of fewer than
    three vertices.  Rings within one cell are taken together; another ring's work is of the
    order of its vertices and cells.
    """
    schema = pa.schema([("cx", pa.int64()), ("cy", pa.int64()), ("ring", pa.list_(_POINT))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rings = batch.column(1)
            offsets = rings.offsets.to_numpy()
            points = _values(rings.values)[offsets[0] : offsets[-1]]
            counts = np.diff(offsets)
            starts = np.cumsum(counts) - counts
            moved = points - np.repeat(points[starts], counts, 0)
            follow = moved[_after(starts, counts)]
            area = np.add.reduceat(moved[:, 0] * follow[:, 1] - moved[:, 1] * follow[:, 0], starts)
            back = (area > 0) == (batch.column(0).to_numpy() > 0)
            low = np.floor(np.minimum.reduceat(points, starts) / cell).astype(np.int64)
            high = np.maximum(np.ceil(np.maximum.reduceat(points, starts) / cell).astype(np.int64) - 1, low)
            alone = (low == high).all(1)
            some = np.flatnonzero((area != 0) & alone)
            ring, place = _ragged(counts[some])
            at = starts[some][ring] + np.where(back[some][ring], counts[some][ring] - 1 - place, place)
            yield pa.RecordBatch.from_arrays([pa.array(low[some, 0]), pa.array(low[some, 1]), _rings(points[at], counts[some])], schema=schema)
            for k in np.flatnonzero((area != 0) & ~alone):
                own = points[starts[k] : starts[k] + counts[k]]
                parts = list(ring_cells(own[::-1] if back[k] else own, cell))
                if parts:
                    columns, rows, cut = zip(*parts, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(columns), pa.array(rows), _rings(np.concatenate(cut), np.array([len(c) for c in cut]))], schema=schema)

    rings = polygons.select(F.posexplode("rings").alias("k", "ring")).where(F.size("ring") > 2)
    return rings.mapInArrow(each, f"cx long, cy long, ring {G.LINE}")


def strip_origins(line: Column, spacing: float) -> Column:
    """The middles of equal steps along a line, no longer than spacing."""

    def along(n: Column) -> Column:
        count = F.greatest(F.lit(1), F.ceil(n / spacing).cast("int"))
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: (i + 0.5) * n / count)

    return G.let(G.length(line), lambda n: F.transform(along(n), lambda d: G.interpolate(line, d)))


def _slab_breaks(zones: int, of_rect: np.ndarray, rects: np.ndarray, of_edge: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zone, height), ascending: heights between which no corner lies and no two boundaries cross."""
    low, high = np.full(zones, np.inf), np.full(zones, -np.inf)
    np.minimum.at(low, of_rect, rects[:, 2])
    np.maximum.at(high, of_rect, rects[:, 3])
    found = [(of_rect, rects[:, 2]), (of_rect, rects[:, 3]), (of_edge, edges[:, 1]), (of_edge, edges[:, 3])]
    way = edges[:, 2:] - edges[:, :2]
    with np.errstate(divide="ignore", invalid="ignore"):
        e, r = _together(of_edge, of_rect)
        for side in (0, 1):
            share = (rects[r, side] - edges[e, 0]) / way[e, 0]
            met = (share > 0) & (share < 1)
            found.append((of_edge[e[met]], edges[e[met], 1] + share[met] * way[e[met], 1]))
        # Each edge with those of its zone, a block of edges at a time.
        number = np.bincount(of_edge, minlength=zones)[of_edge]
        block = np.cumsum(number) // PAIRS
        for some in np.split(np.arange(len(edges)), np.flatnonzero(np.diff(block)) + 1):
            k, j = _together(of_edge[some], of_edge)
            i = some[k]
            i, j = i[i < j], j[i < j]
            turn = way[i, 0] * way[j, 1] - way[i, 1] * way[j, 0]
            off = edges[j, :2] - edges[i, :2]
            one = (off[:, 0] * way[j, 1] - off[:, 1] * way[j, 0]) / turn
            two = (off[:, 0] * way[i, 1] - off[:, 1] * way[i, 0]) / turn
            met = (one > 0) & (one < 1) & (two > 0) & (two < 1)
            found.append((of_edge[i[met]], edges[i[met], 1] + one[met] * way[i[met], 1]))
    zone, height = (np.concatenate(x) for x in zip(*found, strict=True))
    inside = (height >= low[zone]) & (height <= high[zone])
    zone, height = zone[inside], height[inside]
    order = np.lexsort((height, zone))
    zone, height = zone[order], height[order]
    new = np.concatenate([[True], (np.diff(zone) > 0) | (np.diff(height) > NEAR)])[: len(zone)]
    return zone[new], height[new]


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each index is connected to by pairs."""
    label = np.arange(n)
    while (label[a] != label[b]).any():
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (label != label[label]).any():
            label = label[label]
    return label


def _slabs_left(zone: np.ndarray, a: np.ndarray, b: np.ndarray, of_rect: np.ndarray, rects: np.ndarray, of_edge: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slab, trapezoid) of slabs of zones from heights a to b: what is left of the rectangles between the edges, from left to right."""
    m = (a + b) / 2
    s, e = _together(zone, of_edge)
    on = (np.minimum(edges[e, 1], edges[e, 3]) < m[s]) & (np.maximum(edges[e, 1], edges[e, 3]) > m[s])
    s, e = s[on], edges[e[on]]
    um, ua, ub = (e[:, 0] + (e[:, 2] - e[:, 0]) * (v[s] - e[:, 1]) / (e[:, 3] - e[:, 1]) for v in (m, a, b))
    order = np.lexsort((um, s))
    s, e, um, ua, ub = s[order], e[order], um[order], ua[order], ub[order]
    # How often land turns around what lies between an edge and the next.
    step = np.where(e[:, 3] < e[:, 1], 1, -1)
    around = np.cumsum(step)
    start = np.searchsorted(s, s, "left")
    around = around - (around - step)[start] if len(s) else around
    opens, closes = np.flatnonzero(around == step), np.flatnonzero(around == 0)
    k = np.searchsorted(closes, opens)
    opens, k = opens[k < len(closes)], k[k < len(closes)]
    closes = closes[k]
    # Two cells' sides along their border hold nothing between them.
    wide = (s[opens] == s[closes]) & (um[closes] - um[opens] > NEAR)
    opens, closes = opens[wide], closes[wide]
    apart = (s[opens][1:] != s[opens][:-1]) | (um[opens][1:] - um[closes][:-1] > NEAR)
    x, y = opens[np.concatenate([[True], apart])[: len(opens)]], closes[np.concatenate([apart, [True]])[: len(closes)]]
    # The rectangles' spans, merged where they meet.
    of, r = _together(zone, of_rect)
    on = (rects[r, 2] <= m[of]) & (m[of] <= rects[r, 3])
    of, u0, u1 = of[on], rects[r[on], 0], rects[r[on], 1]
    order = np.lexsort((u1, u0, of))
    of, u0, u1 = of[order], u0[order], u1[order]
    far = pd.Series(u1).groupby(of).cummax().to_numpy()
    apart = (of[1:] != of[:-1]) | (u0[1:] > far[:-1] + NEAR)
    first, last = np.concatenate([[True], apart])[: len(of)], np.concatenate([apart, [True]])[: len(of)]
    of, u0, u1 = of[first], u0[first], far[last]
    # Land may begin before a span, or end beyond it.
    p, land = _together(of, s[x])
    on = (um[y[land]] > u0[p]) & (um[x[land]] < u1[p])
    p, land = p[on], land[on]
    between = np.bincount(p, minlength=len(of)) + 1
    owner, _ = _ragged(between)
    right = (np.cumsum(between) - between)[p] + np.arange(len(p)) - np.searchsorted(p, p, "left")
    sides = np.stack([u0[owner], u1[owner], u0[owner], u1[owner]], 1)
    sides[right, 1], sides[right, 3], sides[right + 1, 0], sides[right + 1, 2] = ua[x[land]], ub[x[land]], ua[y[land]], ub[y[land]]
    sides = np.minimum(u1[owner, None], np.maximum(u0[owner, None], sides))
    wide = np.maximum(sides[:, 1] - sides[:, 0], sides[:, 3] - sides[:, 2]) > NEAR
    of, sides = of[owner][wide], sides[wide]
    return of, np.stack([a[of], sides[:, 0], sides[:, 1], b[of], sides[:, 2], sides[:, 3]], 1)


def difference(zones: int, of_rect: np.ndarray, rects: np.ndarray, of_edge: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of each zone's union of rectangles (u0, u1, v0, v1) outside of what its edges (u1, v1, u2, v2) enclose.

    Edges count by winding: land is where they turn around a point, so that
    polygons may overlap and edges that come twice in opposite directions do not matter.
    Zones are numbered, rectangles and edges ascend by zone, and all zones are swept together.  A row is a trapezoid: its zone,
    its part (the number of the part's first row), and v, u left, u right at v, v', u left, u right at v'.
    """
    low, high = np.full(zones, np.inf), np.full(zones, -np.inf)
    np.minimum.at(low, of_rect, rects[:, 2])
    np.maximum.at(high, of_rect, rects[:, 3])
    some = (edges[:, 1] != edges[:, 3]) & (np.maximum(edges[:, 1], edges[:, 3]) > low[of_edge]) & (np.minimum(edges[:, 1], edges[:, 3]) < high[of_edge])
    of_edge, edges = of_edge[some], edges[some]
    zone, height = _slab_breaks(zones, of_rect, rects, of_edge, edges)
    same = zone[1:] == zone[:-1]
    zone, a, b = zone[:-1][same], height[:-1][same], height[1:][same]
    # A block of slabs at a time, by the edges and rectangles that they meet.
    meets = np.cumsum((np.bincount(of_edge, minlength=zones) + np.bincount(of_rect, minlength=zones))[zone])
    found = []
    for k in np.split(np.arange(len(zone)), np.flatnonzero(np.diff(meets // PAIRS)) + 1):
        slab, rows = _slabs_left(zone[k], a[k], b[k], of_rect, rects, of_edge, edges)
        found.append((slab + (k[0] if len(k) else 0), rows))
    slab, rows = (np.concatenate(x) for x in zip(*found, strict=True))
    # Slab by slab, what touches.
    begins = np.concatenate([[True], np.diff(zone) > 0])[: len(zone)]
    i, j = _together(np.where(begins[slab], -1, slab - 1), slab)
    touch = np.minimum(rows[i, 2], rows[j, 5]) - np.maximum(rows[i, 1], rows[j, 4]) > NEAR
    return zone[slab], _components(len(rows), i[touch], j[touch]), rows


def _zones_left(rects: pa.ListArray, land: pa.ListArray, sine: np.ndarray, cosine: np.ndarray, least: float) -> list[pa.Array]:
    """Area, areas of parts, number of parts removed, and pieces of each zone of a batch."""
    n = len(rects)
    lengths = lambda lists: lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    of_rect, _ = _ragged(lengths(rects))
    boxes = _values(rects.flatten())
    rings = land.flatten()  # of all zones
    of_ring, _ = _ragged(lengths(land))
    vertices = lengths(rings)
    points = _values(rings.flatten())
    of_edge = np.repeat(of_ring, vertices)
    # From a corner of the zone, so that large coordinates lose no digits.
    here = np.zeros((n, 2))
    here[of_rect[::-1]] = boxes[::-1][:, [0, 2]]
    turned = lambda p, s, c: np.stack([p[:, 0] * s + p[:, 1] * c, p[:, 0] * c - p[:, 1] * s], 1)  # its own inverse
    there = turned(here, sine, cosine)
    ends = turned(points - there[of_edge], sine[of_edge], cosine[of_edge])
    after = ends[_after(np.cumsum(vertices) - vertices, vertices)]
    zone, part, rows = difference(n, of_rect, boxes - here[of_rect][:, [0, 0, 1, 1]], of_edge, np.concatenate([ends, after], 1))
    parts, part = np.unique(part, return_inverse=True)
    of_part = zone[parts]
    area = np.bincount(part, ((rows[:, 2] - rows[:, 1]) + (rows[:, 5] - rows[:, 4])) / 2 * (rows[:, 3] - rows[:, 0]), len(parts))
    stay = area >= least - NEAR
    removed = np.bincount(of_part[(area > 0) & ~stay], minlength=n)
    order = np.argsort(part, kind="stable")
    order = order[stay[part[order]]]
    rows, zone = rows[order], zone[order]
    corners = turned(rows[:, [1, 0, 2, 0, 5, 3, 4, 3]].reshape(-1, 2), np.repeat(sine[zone], 4), np.repeat(cosine[zone], 4)) + np.repeat(there[zone], 4, 0)
    return [
        pa.array(np.bincount(of_part[stay], area[stay], n)), _lists(np.bincount(of_part[stay], minlength=n), pa.array(area[stay])), pa.array(removed.astype(np.int32)),
        _lists(np.bincount(zone, minlength=n), _rings(corners, np.full(len(rows), 4))),
    ]


def zones_less_land(
    segments: DataFrame, polygons: DataFrame, zones: Sequence[tuple[str, float, float]] = (("nearshore", 20, 100), ("coastal", 100, 300), ("context", 300, 750)),
    spacing: float = 100.0, cell: float = 250.0,
) -> DataFrame:
    """One row per segment and zone: ids, distances, zone_area_m2, zone_status, geometry_warnings, part areas and pieces.

    A zone is the union of strips as wide as `spacing`, from the middles of equal steps along
    the segment and along its seaward bearing, less the polygons (which may overlap).  Parts below max(1, 0.02 spacing^2) go,
    with a warning of how many; a warning also tells of several parts.  Segments that are
    ambiguous, or have no seaward bearing, have zones of no area.  The pieces are disjoint
    quadrilaterals, some of them triangles with a corner twice, whose union the zone is.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("t"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for n, a, b in zones])).alias("z")
    clear = holds((F.col("orientation_status") != "ambiguous") & ~F.isnan("seaward_bearing_deg") & (F.abs("seaward_bearing_deg") < float("inf")) & (F.size("line") > 1))
    rows = segments.withColumn("_clear", clear).withColumn("_o", F.when(F.col("_clear"), strip_origins(F.col("line"), spacing)))
    rows = kept(rows.select("segment_id", "orientation_status", "_clear", "_o", F.sin(F.radians("seaward_bearing_deg")).alias("_s"), F.cos(F.radians("seaward_bearing_deg")).alias("_c")))
    # The rows are small and their work is not, so that their bytes are no measure for a number of tasks.
    tasks = 1 + rows.count() * len(zones) // ZONES_PER_TASK
    rows = rows.select("*", kinds)
    s, c = F.col("_s"), F.col("_c")
    half = spacing / 2

    def rect(o: Column) -> Column:
        u, v = o["x"] * s + o["y"] * c, o["x"] * c - o["y"] * s
        return F.struct((u + F.col("z.a")).alias("u0"), (u + F.col("z.b")).alias("u1"), (v - half).alias("v0"), (v + half).alias("v1"))

    rows = rows.select(F.concat_ws(":", "segment_id", "z.t").alias("zone_id"), "segment_id", F.col("z.t").alias("zone_type"), F.col("z.a").alias("inner_distance_m"), F.col("z.b").alias("outer_distance_m"), "orientation_status", "_clear", "_s", "_c", F.transform("_o", rect).alias("_rects"))
    open_ = rows.where("_clear")
    corner = lambda u, v: F.transform("_rects", lambda r: F.struct((r[u] * s + r[v] * c).alias("x"), (r[u] * c - r[v] * s).alias("y")))
    corners = F.concat(*[corner(u, v) for u in ("u0", "u1") for v in ("v0", "v1")])
    boxed = open_.withColumn("_k", corners).withColumns({f"_{n}{a}": f(F.col("_k")[a]) for a in ("x", "y") for n, f in (("low", F.array_min), ("high", F.array_max))})
    cells = lambda a: F.explode(F.sequence(F.floor(F.col(f"_low{a}") / cell).cast("long"), F.floor(F.col(f"_high{a}") / cell).cast("long"))).alias(f"c{a}")
    bounds = ["_lowx", "_highx", "_lowy", "_highy"]
    spread = boxed.select("zone_id", *bounds, cells("x")).select("*", cells("y"))
    met = spread.join(land_cells(polygons, cell), ["cx", "cy"])
    near = (F.array_max("ring.x") >= F.col("_lowx")) & (F.array_min("ring.x") <= F.col("_highx")) & (F.array_max("ring.y") >= F.col("_lowy")) & (F.array_min("ring.y") <= F.col("_highy"))
    # The rings of the land near one zone, whose extent bounds them.
    around = met.where(near).select("zone_id", "ring").repartition(tasks, "zone_id").groupBy("zone_id").agg(F.collect_list("ring").alias("_land"))
    least = max(1.0, 0.02 * spacing * spacing)
    ids = ["zone_id", "segment_id", "zone_type", "inner_distance_m", "outer_distance_m", "orientation_status", "_clear"]
    joined = rows.repartition(tasks, "zone_id").join(around, "zone_id", "left").select(*ids, F.when(F.col("_clear"), F.col("_rects")).alias("_rects"), "_land", "_s", "_c")
    made = {"area": pa.float64(), "part_areas": pa.list_(pa.float64()), "removed": pa.int32(), "pieces": pa.list_(pa.list_(_POINT))}

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rects, land, sine, cosine = (batch.column(len(ids) + i) for i in range(4))
            out = _zones_left(rects, land, sine.to_numpy(zero_copy_only=False), cosine.to_numpy(zero_copy_only=False), least)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(ids)], *[v.cast(kind) for v, kind in zip(out, made.values(), strict=True)]], names=[*ids, *made])

    kept_types = [f"{name} {kind}" for name, kind in joined.select(*ids).dtypes]
    joined = joined.mapInArrow(left, ", ".join([*kept_types, "area double, part_areas array<double>, removed int", f"pieces {_RINGS}"]))
    joined = joined.select(*ids, F.struct(*made).alias("_z"))
    parts = F.size("_z.part_areas")
    warnings = F.concat_ws(
        ";", F.when(~F.col("_clear"), "orientation_unresolved"), F.when(F.col("_z.removed") > 0, F.format_string("tiny_slivers_removed:%d", "_z.removed")),
        F.when(parts > 1, F.format_string("disconnected_valid_parts:%d", parts)),
    )
    valid = holds(F.col("_z.area") > 0)
    status = F.when(~F.col("_clear"), "ambiguous_orientation").when(valid, "valid").otherwise("empty_after_land_exclusion")
    return joined.select(
        "zone_id", "segment_id", "zone_type", "inner_distance_m", "outer_distance_m", "orientation_status", F.coalesce("_z.area", F.lit(0.0)).alias("zone_area_m2"), status.alias("zone_status"), warnings.alias("geometry_warnings"),
        F.when(valid, F.col("_z.part_areas")).alias("part_areas_m2"), F.when(valid, F.col("_z.pieces")).alias("pieces"),
    )
