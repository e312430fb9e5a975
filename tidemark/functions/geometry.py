"""Lines and points as columns: a line is an array of (x, y) structs, an edge a pair of points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
LINE = f"array<{POINT}>"


def point(x: Column | float, y: Column | float) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.struct(as_column(x).cast("double").alias("x"), as_column(y).cast("double").alias("y"))


def let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with value computed once a row."""
    return F.transform(F.array(value), body)[0]


def separation(a: Column, b: Column) -> Column:
    return F.hypot(b["x"] - a["x"], b["y"] - a["y"])


def steps(line: Column) -> Column:
    """The lengths of a line's pieces; empty for fewer than two vertices."""
    n = F.size(line)
    return F.when(n > 1, F.zip_with(F.slice(line, F.lit(1), n - 1), F.slice(line, F.lit(2), n - 1), separation)).otherwise(F.array().cast("array<double>"))


def length(line: Column) -> Column:
    return F.aggregate(steps(line), F.lit(0.0), lambda s, x: s + x)


def distances(line: Column) -> Column:
    """The distance of each vertex from the start."""
    return F.aggregate(steps(line), F.array(F.lit(0.0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))


def interpolate(line: Column, distance: Column, cum: Column | None = None) -> Column:
    """The point at a distance along the line, clamped to its ends.  cum: the line's distances(), if they are at hand."""

    def at(cum: Column) -> Column:
        d = F.least(F.element_at(cum, -1), F.greatest(F.lit(0.0), distance))
        # The first vertex at or beyond the distance, by a search from the start, and the one before it.
        i = F.least(F.greatest(let(d, lambda v: F.size(F.filter(cum, lambda c: c < v))), F.lit(1)), F.size(cum) - 1)
        return let(F.struct(d.alias("d"), i.alias("i")), lambda k: on_piece(cum, k))

    def on_piece(cum: Column, k: Column) -> Column:
        from_, to = F.element_at(cum, k["i"]), F.element_at(cum, k["i"] + 1)
        t = F.coalesce(F.try_divide(k["d"] - from_, to - from_), F.lit(0.0))
        piece = F.struct(F.element_at(line, k["i"]).alias("a"), F.element_at(line, k["i"] + 1).alias("b"), t.alias("t"))
        return let(piece, lambda s: point(s["a"]["x"] + (s["b"]["x"] - s["a"]["x"]) * s["t"], s["a"]["y"] + (s["b"]["y"] - s["a"]["y"]) * s["t"]))

    return F.when(distance.isNull(), None).when(F.size(line) > 1, let(distances(line) if cum is None else cum, at)).when(F.size(line) == 1, F.element_at(line, 1))


def between(line: Column, start: Column, end: Column, cum: Column | None = None) -> Column:
    """The part of a line from one distance to another."""
    cum = distances(line) if cum is None else cum
    inner = let(cum, lambda c: F.transform(F.filter(F.arrays_zip(line.alias("p"), c.alias("d")), lambda v: (v["d"] > start) & (v["d"] < end)), lambda v: v["p"]))
    return F.concat(F.array(interpolate(line, start, cum)), inner, F.array(interpolate(line, end, cum)))


def bearing(a: Column, b: Column) -> Column:
    """Degrees clockwise from north of the way from a to b."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda s: F.pmod(F.degrees(F.atan2(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])), F.lit(360.0)))


def offset(origin: Column, degrees: Column, distance: Column | float) -> Column:
    """The point at a bearing and a distance."""
    return let(origin, lambda o: point(o["x"] + F.sin(F.radians(degrees)) * distance, o["y"] + F.cos(F.radians(degrees)) * distance))


def local_bearing(line: Column, distance: Column, window: float = 5.0, cum: Column | None = None) -> Column:
    """The bearing of the line around a distance: between the points a window before and after (a quarter of a short line)."""
    cum = distances(line) if cum is None else cum
    half = F.least(F.lit(window), F.element_at(cum, -1) / 4)
    return bearing(interpolate(line, distance - half, cum), interpolate(line, distance + half, cum))


def angle_between(a: Column, b: Column) -> Column:
    """The smaller angle between two bearings."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def area(ring: Column) -> Column:
    """The area within a ring of vertices, by the shoelace formula."""
    n = F.size(ring)
    following = F.concat(F.slice(ring, F.lit(2), F.greatest(F.lit(0), n - 1)), F.slice(ring, 1, 1))
    return F.abs(F.aggregate(F.zip_with(ring, following, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]), F.lit(0.0), lambda s, x: s + x)) / 2


def edge_distance(p: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The distance of a point from an edge."""
    t = F.coalesce(F.try_divide((p["x"] - x1) * (x2 - x1) + (p["y"] - y1) * (y2 - y1), (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))
    return F.hypot(p["x"] - (x1 + t * (x2 - x1)), p["y"] - (y1 + t * (y2 - y1)))


def hausdorff(a: Column, b: Column) -> Column:
    """The greatest distance of a vertex of either line from the other line; null if one has no vertex."""

    def gap(p: Column, line: Column) -> Column:
        n = F.size(line)
        # A line of one vertex is an edge without length.
        ends = F.when(n == 1, line).otherwise(F.slice(line, F.lit(2), F.greatest(F.lit(0), n - 1)))
        return F.array_min(F.zip_with(F.slice(line, F.lit(1), F.size(ends)), ends, lambda q, r: edge_distance(p, q["x"], q["y"], r["x"], r["y"])))

    ways = F.greatest(F.array_max(F.transform(a, lambda p: gap(p, b))), F.array_max(F.transform(b, lambda p: gap(p, a))))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), ways)


def crosses(p: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether a ray from the point to the right crosses the edge."""
    return ((y1 > p["y"]) != (y2 > p["y"])) & F.coalesce(p["x"] < F.try_divide((x2 - x1) * (p["y"] - y1), y2 - y1) + x1, F.lit(False))


def ring_edges(ring: list[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    return [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]


def covered_by(p: Column, edges: list[tuple[float, float, float, float]], tolerance: float = 1e-9) -> Column:
    """Whether a polygon of few fixed edges (all rings) covers a point; its boundary counts."""
    parity, nearest = F.lit(0), F.lit(float("inf"))
    for e in edges:
        ends = [F.lit(float(v)) for v in e]
        parity = parity + crosses(p, *ends).cast("int")
        nearest = F.least(nearest, edge_distance(p, *ends))
    return (parity % 2 == 1) | (nearest <= tolerance)
