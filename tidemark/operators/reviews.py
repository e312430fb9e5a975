"""Reviews of a region's tables: components of lines, segments beside the edges of tiles, ends of transects, classes of sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.lineage import kept
from ..functions.stats import holds
from .coast import covered_points

# Words in source classes that ask for a look.
SUSPICIOUS = ("MUELLE", "ROMPEOLAS", "SLCONS", "VARADERO", "RIVER")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of the ids in links (a, b): the least id that links lead to, in rounds of stars around least neighbours.

    Ids that only link to themselves or to null are not in the result.  Each round is two
    aggregations of least neighbours and two joins; rounds grow with the logarithm of the longest way.
    """
    stars = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    digest = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    before = digest(stars)
    while True:
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        stars = kept(large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small).distinct())
        after = digest(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).union(stars.select("b", "b").distinct())


def line_components(lines: DataFrame, key: str, tolerance: float) -> DataFrame:
    """(key, component) of lines (key, line): lines are together if ends of theirs are within a tolerance; the component is its least key.

    Ends go to square cells whose points are all within the tolerance, which count as one;
    points of cells nearby are compared, equal ones once.  So the work grows with the number
    of different ends within a few tolerances.  Keys are unique; a line without vertices has no component.
    """
    side = tolerance / 1.4142136
    at = lambda p, axis: F.floor(F.col(p)[axis] / F.lit(side)).cast("long")
    ends = lines.where(F.size("line") > 0).select(F.col(key).alias("k"), F.explode(F.array(F.element_at("line", 1), F.element_at("line", -1))).alias("p"))
    ends = ends.select("k", "p", at("p", "x").alias("cx"), at("p", "y").alias("cy"))
    nodes = kept(ends.groupBy("cx", "cy").agg(F.min("k").alias("node")))
    own = kept(ends.join(nodes, ["cx", "cy"]).select("k", "p", "cx", "cy", "node"))
    points = own.select("cx", "cy", "node", "p").distinct()
    # Of each pair of cells, the one that comes first looks at the other.
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(3) for j in range(-2, 3) if (i, j) > (0, 0)])
    ahead = points.select(F.col("node").alias("a"), F.col("p").alias("q"), "cx", "cy", F.explode(around).alias("o")).select("a", "q", (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"))
    near = ahead.join(points, ["cx", "cy"]).where(G.separation(F.col("q"), F.col("p")) <= tolerance).select("a", F.col("node").alias("b"))
    of_lines = own.groupBy("k").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    found = components(near.union(of_lines.select("a", "b")).distinct()).select(F.col("id").alias("a"), "component")
    named = of_lines.join(found, "a", "left").select(F.col("k").alias(key), F.coalesce("component", "a").alias("component"))
    return lines.select(key).join(named, key, "left")


def crossing(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Whether two edges (x1, y1, x2, y2) cross within both; edges that only touch or lie in one line may count as not crossing, their ends being at distance 0."""
    side = lambda e, x, y: F.signum((e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0]))
    return (side(a, b[0], b[1]) * side(a, b[2], b[3]) < 0) & (side(b, a[0], a[1]) * side(b, a[2], a[3]) < 0)


def edge_gap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """The distance of two edges (x1, y1, x2, y2)."""
    ends = [G.edge_distance(G.point(e[i], e[i + 1]), *f) for e, f in ((a, b), (b, a)) for i in (0, 2)]
    return F.when(crossing(a, b), F.lit(0.0)).otherwise(F.least(*ends))


def near_tile_edges(segments: DataFrame, tiles: DataFrame, tolerance: float, cell: float) -> DataFrame:
    """(segment_id, distance) of segments (line) within a tolerance of the boundary of a tile (min_x, min_y, max_x, max_y).

    Edges meet by an equality join on square cells of a side: near the segments' size.
    """
    at = lambda v: F.floor(v / F.lit(float(cell))).cast("long")
    low_x, low_y, high_x, high_y = (F.col(c).cast("double") for c in ("min_x", "min_y", "max_x", "max_y"))
    sides = F.array(*[F.struct(*[v.alias(n) for v, n in zip(e, ("u1", "v1", "u2", "v2"), strict=True)]) for e in (
        (low_x, low_y, high_x, low_y), (low_x, high_y, high_x, high_y), (low_x, low_y, low_x, high_y), (high_x, low_y, high_x, high_y))])
    edges = tiles.select(F.inline(sides)).distinct()
    edges = edges.select("*", F.explode(F.sequence(at(F.col("u1")), at(F.col("u2")))).alias("_cx")).select("*", F.explode(F.sequence(at(F.col("v1")), at(F.col("v2")))).alias("_cy"))
    n = F.size("line")
    steps = F.zip_with(F.slice("line", F.lit(1), n - 1), F.slice("line", F.lit(2), n - 1), lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))
    pieces = segments.where(n > 1).select("segment_id", F.inline(steps))
    reach = lambda a, b: F.explode(F.sequence(at(F.least(a, b) - tolerance), at(F.greatest(a, b) + tolerance)))
    pieces = pieces.select("*", reach("x1", "x2").alias("_cx")).select("*", reach("y1", "y2").alias("_cy"))
    gap = edge_gap([F.col(c) for c in ("x1", "y1", "x2", "y2")], [F.col(c) for c in ("u1", "v1", "u2", "v2")])
    return pieces.join(edges, ["_cx", "_cy"]).groupBy("segment_id").agg(F.min(gap).alias("distance")).where(F.col("distance") <= tolerance)


def self_crossings(lines: DataFrame, key: str, cell: float) -> DataFrame:
    """(key, crossings) of lines or closed rings (key, line): how many pairs of their pieces cross; touching does not count.  Keys are unique.

    Pieces of a line meet in square cells of a side: near the pieces' lengths.
    """
    at = lambda v: F.floor(v / F.lit(float(cell))).cast("long")
    n = F.size("line")
    steps = F.zip_with(F.slice("line", F.lit(1), n - 1), F.slice("line", F.lit(2), n - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    pieces = lines.where(n > 1).select(F.col(key).alias("k"), F.posexplode(steps).alias("i", "e")).select("k", "i", *[F.col(f"e.{p}.{a}").alias(f"{a}{m}") for m, p in ((1, "p"), (2, "q")) for a in "xy"])
    span = lambda a, b: F.explode(F.sequence(at(F.least(a, b)), at(F.greatest(a, b))))
    spread = pieces.select("*", span("x1", "x2").alias("cx")).select("*", span("y1", "y2").alias("cy"))
    other = spread.select("k", "cx", "cy", F.col("i").alias("j"), *[F.col(c).alias(f"_{c}") for c in ("x1", "y1", "x2", "y2")])
    ends = ("x1", "y1", "x2", "y2")
    met = spread.join(other, ["k", "cx", "cy"]).where(F.col("i") < F.col("j")).where(crossing([F.col(c) for c in ends], [F.col(f"_{c}") for c in ends]))
    counts = met.select("k", "i", "j").distinct().groupBy("k").agg(F.count(F.lit(1)).alias("crossings")).withColumnRenamed("k", key)
    return lines.select(key).join(counts, key, "left").select(key, F.coalesce("crossings", F.lit(0)).alias("crossings"))


def tile_edge_review(segments: DataFrame, features: DataFrame, tiles: DataFrame, resolution: float, cell: float = 1000.0) -> DataFrame:
    """One row: how many segments lie within 1.5 cells of a tile's edge, and how many of those lack terrain or have a slope that cannot be."""
    tolerance = 1.5 * resolution
    near = near_tile_edges(segments, tiles, tolerance, cell).select("segment_id")
    rows = near.join(features.select("segment_id", "terrain_valid_sample_share", "slope_max_deg"), "segment_id", "left")
    counts = rows.agg(
        F.count_distinct("segment_id").alias("segments_near_source_tile_edges"),
        F.count_if(holds(F.col("terrain_valid_sample_share") < 0.95)).alias("near_edge_segments_below_95pct_completeness"),
        F.count_if(holds((F.col("slope_max_deg") < 0) | (F.col("slope_max_deg") > 90))).alias("near_edge_segments_with_slope_outside_0_90"),
    )
    flag = (F.col("near_edge_segments_below_95pct_completeness") > 0) | (F.col("near_edge_segments_with_slope_outside_0_90") > 0)
    return counts.select(F.lit(float(tolerance)).alias("proximity_tolerance_m"), "*", flag.alias("automated_artifact_flag"))


def endpoint_review(transects: DataFrame, edges: DataFrame, cell: float = 1000.0) -> DataFrame:
    """One row: inland transects whose end is not on land, and offshore ones whose end is (transect_id, direction, line; edges x1, y1, x2, y2)."""
    ends = transects.where(F.size("line") > 0).select("transect_id", F.element_at("line", -1).alias("p"))
    found = transects.select("transect_id", "direction").join(covered_points(ends, "transect_id", edges, cell), "transect_id", "left")
    return found.agg(
        F.count_if((F.col("direction") == "inland") & ~holds(F.col("covered"))).alias("inland_endpoints_not_on_land"),
        F.count_if((F.col("direction") == "offshore") & holds(F.col("covered"))).alias("offshore_endpoints_on_land"),
    )


def source_class_review(audit: DataFrame) -> DataFrame:
    """(source_class, selected, n, suspicious) of an audit (source_class, selected_for_analysis): a suspicious class names a structure or a river."""
    of = F.coalesce(F.col("source_class").cast("string"), F.lit("missing"))
    odd = F.upper("source_class").rlike("|".join(SUSPICIOUS))
    return audit.groupBy(of.alias("source_class"), holds(F.col("selected_for_analysis")).alias("selected")).agg(F.count(F.lit(1)).alias("n")).withColumn("suspicious", F.col("selected") & holds(odd))


def clipped_lines(lines: DataFrame, key: str, box: tuple[float, float, float, float]) -> DataFrame:
    """(key, part, line): the parts of lines (key, line) within a box (min_x, min_y, max_x, max_y), numbered along the line.

    A part ends where the line leaves the box; what only touches it, and lines of fewer than
    two vertices, give nothing.  Column code throughout: no shuffle.
    """
    low_x, low_y, high_x, high_y = (F.lit(float(v)) for v in box)

    def cut(p: Column, q: Column) -> Column:
        # The share of the piece at which it enters the box, and that at which it leaves it.
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        bounds = F.array(*[F.struct(d.alias("d"), r.alias("r")) for d, r in ((-dx, p["x"] - low_x), (dx, high_x - p["x"]), (-dy, p["y"] - low_y), (dy, high_y - p["y"]))])
        share = lambda b: F.try_divide(b["r"], b["d"])
        enter = F.array_max(F.concat(F.array(F.lit(0.0)), F.transform(F.filter(bounds, lambda b: b["d"] < 0), share)))
        leave = F.array_min(F.concat(F.array(F.lit(1.0)), F.transform(F.filter(bounds, lambda b: b["d"] > 0), share)))
        outside = F.exists(bounds, lambda b: (b["d"] == 0) & (b["r"] < 0))
        return F.struct(p.alias("p"), q.alias("q"), enter.alias("a"), F.when(outside, F.lit(-1.0)).otherwise(leave).alias("b"))

    n = F.size("line")
    pieces = F.zip_with(F.slice("line", F.lit(1), n - 1), F.slice("line", F.lit(2), n - 1), cut)
    on = lambda s, t: F.when(t == 0, s["p"]).when(t == 1, s["q"]).otherwise(G.point(s["p"]["x"] + t * (s["q"]["x"] - s["p"]["x"]), s["p"]["y"] + t * (s["q"]["y"] - s["p"]["y"])))
    inside = F.transform(F.filter(pieces, lambda s: s["a"] < s["b"]), lambda s: F.struct((s["a"] > 0).alias("begins"), (s["b"] < 1).alias("ends"), F.array(on(s, s["a"]), on(s, s["b"])).alias("line")))
    # A piece goes on with the last part if that ended where this one begins.
    part = "array<struct<ends:boolean,line:array<struct<x:double,y:double>>>>"

    def joined(parts: Column, s: Column) -> Column:
        last = F.element_at(parts, -1)
        new = F.struct(s["ends"].alias("ends"), s["line"].alias("line"))
        longer = F.struct(s["ends"].alias("ends"), F.concat(last["line"], F.slice(s["line"], 2, 1)).alias("line"))
        goes_on = (F.size(parts) > 0) & ~s["begins"] & ~F.coalesce(F.get(parts, F.size(parts) - 1)["ends"], F.lit(True)) & (F.get(F.get(parts, F.size(parts) - 1)["line"], F.size(F.get(parts, F.size(parts) - 1)["line"]) - 1) == s["line"][0])
        return F.when(goes_on, F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(longer))).otherwise(F.concat(parts, F.array(new))).cast(part)

    rows = lines.where(n > 1).select(F.col(key), F.aggregate(inside, F.array().cast(part), joined).alias("parts"))
    return rows.select(key, F.posexplode("parts").alias("part", "p")).select(key, "part", F.col("p.line").alias("line"))
