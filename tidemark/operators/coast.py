"""Coast lines: parts, segments, orientation, transects and zones."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.stats import holds

#: Points of a cell that one task compares with the cell's strips.
POINTS_PER_BLOCK = 4096


def rings_to_parts(polygons: DataFrame, region: str, interiors: bool = False) -> DataFrame:
    """One row per ring of `rings` (the first of a polygon is its outer one): coastline_part_id and line, numbered by polygon_id and ring."""
    rings = polygons.select("polygon_id", F.posexplode("rings").alias("ring", "line")).where(F.lit(interiors) | (F.col("ring") == 0))
    # Numbers by counts per polygon: the list of polygons is ordered, not that of rings.
    from pyspark.sql import Window

    per = rings.groupBy("polygon_id").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("polygon_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = F.col("_before") + F.col("ring") + 1
    return rings.join(per, "polygon_id").select(F.format_string(f"{region}_part_%04d", number).alias("coastline_part_id"), "polygon_id", "ring", "line")


def simplified(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker, without recursion."""
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    todo = [(0, len(line) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        inner, way = line[a + 1 : b] - line[a], line[b] - line[a]
        size = float(way @ way)
        t = np.clip(inner @ way / size, 0, 1) if size else np.zeros(len(inner))
        far = np.hypot(*(inner - t[:, None] * way).T)
        i = int(far.argmax())
        if far[i] > tolerance:
            keep[a + 1 + i] = True
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return line[keep]


def cleaned(parts: DataFrame, tolerance: float = 0.0, line: str = "line") -> DataFrame:
    """Parts without empty or zero-length lines, simplified; adds length_change_percent and a warning above 1 %."""
    before = parts.where(G.length(F.col(line)) > 0).withColumn("_before", G.length(F.col(line)))
    if tolerance > 0:

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                lines = [simplified(np.array([(p["x"], p["y"]) for p in points]), tolerance) for points in pdf[line]]
                yield pdf.assign(**{line: [[{"x": float(x), "y": float(y)} for x, y in points] for points in lines]})

        before = before.mapInPandas(each, before.schema)
    change = (F.col("_before") - G.length(F.col(line))) / F.col("_before") * 100
    return before.withColumn("length_change_percent", change).withColumn("length_warning", F.abs("length_change_percent") > 1).where(G.length(F.col(line)) > 0).drop("_before")


def segment_breaks(length: Column, target: float, minimum: float) -> Column:
    """The distances at which a line is cut: whole targets; a short rest is spread over the segments, a longer one is a segment."""
    whole = F.floor(length / target)
    rest = length - whole * target
    n = F.when(length <= target, 1).when(rest <= 1e-8, whole).when(rest < minimum, whole).otherwise(whole + 1).cast("int")
    spread = holds((rest > 1e-8) & (rest < minimum)) & (length > target)
    step = F.when(spread, length / n).otherwise(F.lit(float(target)))
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.when(i == n, length).otherwise(i * step))


def segments(parts: DataFrame, region: str, target: float = 250.0, minimum: float = 75.0, version: str = "v1") -> DataFrame:
    """One row per segment: id, part, number, length, distances, midpoint, line and four bearings."""
    cum = F.col("_cum")
    rows = parts.withColumn("_cum", G.distances(F.col("line"))).withColumn("_breaks", segment_breaks(F.element_at(cum, -1), target, minimum))
    cut = rows.select("*", F.posexplode(F.slice("_breaks", F.lit(1), F.size("_breaks") - 1)).alias("segment_number", "start_distance_m"))
    cut = cut.withColumn("end_distance_m", F.element_at("_breaks", F.col("segment_number") + 2))
    middle = (F.col("start_distance_m") + F.col("end_distance_m")) / 2
    cut = cut.withColumn("midpoint", G.interpolate(F.col("line"), middle, cum)).withColumn("local_bearing_deg", G.local_bearing(F.col("line"), middle, cum=cum))
    turned = lambda d: F.pmod(F.col("local_bearing_deg") + d, F.lit(360.0))
    return cut.select(
        F.format_string(f"{region}_{version}_%s_%05d", "coastline_part_id", F.col("segment_number") + 1).alias("segment_id"),
        "coastline_part_id", (F.col("segment_number") + 1).alias("segment_number"),
        (F.col("end_distance_m") - F.col("start_distance_m")).alias("segment_length_m"), "start_distance_m", "end_distance_m", "midpoint",
        "local_bearing_deg", turned(180).alias("reverse_bearing_deg"), turned(-90).alias("left_normal_deg"), turned(90).alias("right_normal_deg"),
        G.between(F.col("line"), F.col("start_distance_m"), F.col("end_distance_m"), cum).alias("line"),
    )


def covered_points(points: DataFrame, key: str, edges: DataFrame, cell: float, tolerance: float = 1e-9) -> DataFrame:
    """key and `covered` of each point (key, p): an even-odd test against an edge table (x1, y1, x2, y2) of any size; the boundary counts.

    Space is cut into horizontal strips of height `cell`; an edge goes to the strips that it
    spans, a point to its own, and a point only meets the edges of its strip.
    """
    strip = lambda y: F.floor(y / cell).cast("long")
    low, high = F.least("y1", "y2") - tolerance, F.greatest("y1", "y2") + tolerance
    spread = edges.select("*", F.explode(F.sequence(strip(low), strip(high))).alias("_strip"))
    met = points.select(key, "p", strip(F.col("p")["y"]).alias("_strip")).join(spread, "_strip", "left")
    ends = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    test = met.groupBy(key).agg(F.coalesce(F.sum(G.crosses(F.col("p"), *ends).cast("int")), F.lit(0)).alias("_n"), F.min(G.edge_distance(F.col("p"), *ends)).alias("_d"))
    return test.select(key, ((F.col("_n") % 2 == 1) | holds(F.col("_d") <= tolerance)).alias("covered"))


def oriented(segments_: DataFrame, land: Sequence[tuple[float, float, float, float]], distances: Sequence[float] = (10.0, 20.0, 40.0), offsets: Sequence[float] = (0.0,)) -> DataFrame:
    """Adds orientation_status, landward and seaward bearings, votes and attempts.

    At each test distance, points left and right of the line at each offset vote where just
    one of them lies on land (fixed edges of few polygons).  The first distance at which the
    sides differ and the greater has votes enough (all but a third, or one of one) decides.
    """
    enough = 1 if len(offsets) == 1 else math.ceil(2 * len(offsets) / 3)
    middle = F.element_at("_cum", -1) / 2
    on_land = lambda p: G.let(p, lambda q: G.covered_by(q, list(land)))

    def vote(at: Column, d: float) -> Column:
        sides = F.struct(*[on_land(G.offset(at, F.col(c), d)).alias(n) for n, c in (("l", "left_normal_deg"), ("r", "right_normal_deg"))])
        return G.let(sides, lambda s: F.struct((s["l"] & ~s["r"]).cast("int").alias("l"), (s["r"] & ~s["l"]).cast("int").alias("r")))

    def attempt(i: int, d: float) -> Column:
        votes = F.array(*[G.let(G.interpolate(F.col("line"), middle + o, F.col("_cum")), lambda at: vote(at, d)) for o in offsets])
        total = lambda v, n: F.aggregate(v, F.lit(0), lambda s, x: s + x[n])
        return G.let(votes, lambda v: F.struct(F.lit(i).alias("i"), F.lit(float(d)).alias("d"), total(v, "l").alias("l"), total(v, "r").alias("r")))

    rows = segments_.withColumn("_cum", G.distances(F.col("line"))).withColumn("_attempts", F.array(*[attempt(i, d) for i, d in enumerate(distances)]))
    chosen = F.get(F.filter("_attempts", lambda a: (a["l"] != a["r"]) & (F.greatest(a["l"], a["r"]) >= enough)), F.lit(0))
    rows = rows.withColumn("_a", chosen)
    resolved, on_left = F.col("_a").isNotNull(), F.col("_a.l") > F.col("_a.r")
    side = lambda a, b: F.when(resolved, F.when(on_left, F.col(a)).otherwise(F.col(b)))
    return rows.withColumns(
        {
            "orientation_status": F.when(~resolved, "ambiguous").when(F.col("_a.i") == 0, "resolved").otherwise("resolved_fallback"),
            "landward_bearing_deg": side("left_normal_deg", "right_normal_deg"),
            "seaward_bearing_deg": side("right_normal_deg", "left_normal_deg"),
            "orientation_vote_count_landward": F.greatest("_a.l", "_a.r"),
            "orientation_vote_count_seaward": F.least("_a.l", "_a.r"),
            "orientation_attempts": F.transform(F.filter("_attempts", lambda a: ~resolved | (a["i"] <= F.col("_a.i"))), lambda a: a["d"]),
        }
    ).drop("_a", "_attempts", "_cum")


def transect_origins(length: Column, spacing: float, tail: float = 0.0) -> Column:
    """0, spacing, ... and the end, unless the last origin is within `tail` of it (or at it)."""
    inner = F.transform(F.sequence(F.lit(0), F.floor((length + 1e-7) / spacing).cast("int")), lambda i: i * F.lit(float(spacing)))
    gap = length - F.element_at(inner, -1)
    return F.when(gap > max(tail, 1e-6), F.concat(inner, F.array(length))).otherwise(inner)


def transects(oriented_: DataFrame, spacing: float = 25.0, inland: float = 100.0, offshore: float = 200.0) -> DataFrame:
    """Two lines per origin, inland and offshore, along the local normal on the landward (seaward) side.  Ambiguous segments have none."""
    cum, at = F.col("_cum"), F.col("origin_distance_m")
    rows = oriented_.where("landward_bearing_deg is not null").withColumn("_cum", G.distances(F.col("line")))
    rows = rows.select("*", F.posexplode(G.let(F.element_at(cum, -1), lambda n: transect_origins(n, spacing))).alias("_i", "origin_distance_m"))
    rows = rows.withColumn("_b", G.local_bearing(F.col("line"), at, cum=cum)).withColumn("_o", G.interpolate(F.col("line"), at, cum))
    left, right = F.pmod(F.col("_b") - 90, F.lit(360.0)), F.pmod(F.col("_b") + 90, F.lit(360.0))
    landward = F.when(G.angle_between(left, F.col("landward_bearing_deg")) <= G.angle_between(right, F.col("landward_bearing_deg")), left).otherwise(right)
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("direction"), F.lit(float(m)).alias("length_m"), F.lit(turn).alias("turn")) for n, m, turn in (("inland", inland, 0.0), ("offshore", offshore, 180.0))])).alias("k")
    rows = rows.withColumn("_land", landward).select("*", kinds).withColumn("bearing_deg", F.pmod(F.col("_land") + F.col("k.turn"), F.lit(360.0)))
    return rows.select(
        F.format_string("%s_t%03d_%s", "segment_id", F.col("_i") + 1, "k.direction").alias("transect_id"), "segment_id", (F.col("_i") + 1).alias("transect_number"),
        "origin_distance_m", F.col("k.direction").alias("direction"), "bearing_deg", F.col("k.length_m").alias("length_m"), "orientation_status",
        F.array("_o", G.offset(F.col("_o"), F.col("bearing_deg"), F.col("k.length_m"))).alias("line"),
    )


def seaward_transects(oriented_: DataFrame, spacing: float = 100.0, length: float = 500.0) -> DataFrame:
    """One line seawards per origin; the tail rule is half a spacing, the tangent is taken over 2 units either way."""
    rows = oriented_.where("seaward_bearing_deg is not null and orientation_status <> 'ambiguous'").withColumn("_cum", G.distances(F.col("line")))
    cum, at = F.col("_cum"), F.col("origin_distance_m")
    rows = rows.select("*", F.posexplode(G.let(F.element_at(cum, -1), lambda n: transect_origins(n, spacing, spacing / 2))).alias("_i", "origin_distance_m"))
    tangent = G.bearing(G.interpolate(F.col("line"), at - 2.0, cum), G.interpolate(F.col("line"), at + 2.0, cum))
    rows = rows.withColumn("_b", tangent).withColumn("_o", G.interpolate(F.col("line"), at, cum))
    left, right = F.pmod(F.col("_b") - 90, F.lit(360.0)), F.pmod(F.col("_b") + 90, F.lit(360.0))
    nearest = F.when(G.angle_between(left, F.col("seaward_bearing_deg")) <= G.angle_between(right, F.col("seaward_bearing_deg")), left).otherwise(right)
    return rows.withColumn("bearing_deg", nearest).select(
        F.format_string("%s_b%03d", "segment_id", F.col("_i") + 1).alias("bathymetry_transect_id"), "segment_id", "origin_distance_m", "bearing_deg",
        F.array("_o", G.offset(F.col("_o"), F.col("bearing_deg"), length)).alias("line"),
    )


def zone_strips(seaward: DataFrame, zones: Sequence[tuple[str, float, float]] = (("nearshore", 20, 100), ("coastal", 100, 300), ("context", 300, 750)), width: float = 100.0) -> DataFrame:
    """One rectangle per transect and zone: zone_id, segment_id, zone_type, origin, bearing, from and to distance, half width.

    A zone is the union of its strips; membership asks for any of them.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("t"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for n, a, b in zones])).alias("z")
    rows = seaward.select("segment_id", F.get("line", F.lit(0)).alias("origin"), "bearing_deg", kinds)
    return rows.select(F.concat_ws("_", "segment_id", "z.t").alias("zone_id"), "segment_id", F.col("z.t").alias("zone_type"), "origin", "bearing_deg", F.col("z.a").alias("from_m"), F.col("z.b").alias("to_m"), F.lit(width / 2).alias("half_width"))


def in_strip(p: Column, origin: Column, sine: Column, cosine: Column, from_m: Column, to_m: Column, half_width: Column) -> Column:
    """Whether a point lies in a strip along a bearing of that sine and cosine."""
    dx, dy = p["x"] - origin["x"], p["y"] - origin["y"]
    along, aside = dx * sine + dy * cosine, dx * cosine - dy * sine
    return (along >= from_m) & (along <= to_m) & (F.abs(aside) <= half_width)


def zone_membership(points: DataFrame, key: str, strips: DataFrame, cell: float = 250.0) -> DataFrame:
    """(key, zone_id) for each point (key, p) in a zone, once each.

    Points and strips meet by an equality join on square cells: a strip goes to all cells
    that its bounding box touches, a point to its own.  Sines are taken once per strip.  A
    zone's strips of one cell are one row there, so that a point meets a zone once and what is
    found, which may be of the order of points times zones, is not shuffled; only for keys
    of several points it is.  Crowded cells are dealt in blocks of points.
    """
    at = lambda v: F.floor(v / cell).cast("long")
    turned = strips.withColumns({"_s": F.sin(F.radians("bearing_deg")), "_c": F.cos(F.radians("bearing_deg"))})
    s, c, w = F.col("_s"), F.col("_c"), F.col("half_width")
    xs = [F.col("origin")["x"] + s * F.col(d) + k * c * w for d in ("from_m", "to_m") for k in (-1, 1)]
    ys = [F.col("origin")["y"] + c * F.col(d) - k * s * w for d in ("from_m", "to_m") for k in (-1, 1)]
    cells = lambda v: F.explode(F.sequence(at(F.least(*v)), at(F.greatest(*v))))
    spread = turned.withColumn("_cx", cells(xs)).withColumn("_cy", cells(ys))
    spots = points.select(F.col(key).alias("_key"), "p", at(F.col("p")["x"]).alias("_cx"), at(F.col("p")["y"]).alias("_cy")).where("_cx is not null and _cy is not null")
    # One row per cell of more than a block of points.
    crowded = spots.groupBy("_cx", "_cy").agg(F.ceil(F.count(F.lit(1)) / POINTS_PER_BLOCK).cast("int").alias("_blocks")).where("_blocks > 1")
    dealt = lambda df: df.join(F.broadcast(crowded), ["_cx", "_cy"], "left")
    blocks = F.coalesce("_blocks", F.lit(1))
    place = ["_cx", "_cy", "_block"]
    # The rows are few for what comes of them, so that their bytes are no measure for a number of tasks.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = ["zone_id", "zone_type", "segment_id"]
    strip = ["origin", "_s", "_c", "from_m", "to_m", "half_width"]
    there = dealt(spread.select(*own, *strip, "_cx", "_cy")).select(*own, *strip, "_cx", "_cy", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block")).repartition(tasks, *place)
    zones = there.groupBy(*own, *place).agg(F.collect_set(F.struct(*strip)).alias("_strips"))
    numbers = spots.groupBy(F.col("_key").alias("_same")).agg((F.count(F.lit(1)) == 1).alias("_once"))
    spots = dealt(spots.join(numbers, F.col("_key").eqNullSafe(F.col("_same"))))
    spots = spots.select("_key", "p", "_once", "_cx", "_cy", F.pmod(F.xxhash64("_key", "p"), blocks).cast("int").alias("_block")).repartition(tasks, *place)
    inside = lambda z: in_strip(F.col("p"), z["origin"], z["_s"], z["_c"], z["from_m"], z["to_m"], z["half_width"])
    one = zones.where(F.size("_strips") == 1).select(*own, *place, F.col("_strips")[0].alias("_strip")).select(*own, *place, "_strip.*")
    once, repeated = spots.where("_once"), spots.where("not _once")
    alone = once.join(one, place).where(in_strip(F.col("p"), F.col("origin"), s, c, F.col("from_m"), F.col("to_m"), w))
    several = once.join(zones.where(F.size("_strips") > 1), place).where(F.exists("_strips", inside))
    again = repeated.join(zones, place).where(F.exists("_strips", inside))
    out = [F.col("_key").alias(key), *own]
    return alone.select(*out).union(several.select(*out)).union(again.select(*out).distinct())


def within_distance(left: DataFrame, right: DataFrame, left_key: str, right_key: str, distance: float) -> DataFrame:
    """(left_key, right_key, distance) of points (columns p) no further apart than distance: an equality join on square cells and their neighbours."""
    at = lambda v: F.floor(v / F.lit(float(distance))).cast("long")
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])).alias("o")
    a = left.select(left_key, F.col("p").alias("_p"), at(F.col("p")["x"]).alias("_cx"), at(F.col("p")["y"]).alias("_cy"))
    b = right.select(right_key, F.col("p").alias("_q"), near).select(right_key, "_q", (at(F.col("_q")["x"]) + F.col("o.a")).alias("_cx"), (at(F.col("_q")["y"]) + F.col("o.b")).alias("_cy"))
    return a.join(b, ["_cx", "_cy"]).withColumn("distance", G.separation(F.col("_p"), F.col("_q"))).where(F.col("distance") <= distance).select(left_key, right_key, "distance")


def extent(df: DataFrame, line: str) -> DataFrame:
    """min_x, min_y, max_x and max_y over all vertices, from each line's own bounds."""
    own = [f(F.col(line)[axis]) for f in (F.array_min, F.array_max) for axis in ("x", "y")]
    bounds = df.select(*[c.alias(n) for c, n in zip(own, ("a", "b", "c", "d"), strict=True)])
    return bounds.agg(F.min("a").alias("min_x"), F.min("b").alias("min_y"), F.max("c").alias("max_x"), F.max("d").alias("max_y"))
