"""Polygons dissolved along shared edges, and lines merged at shared ends: chains of links, followed by pointer jumping.

All tables are of edges or lines, joined by the coordinates of their ends; the rounds number
the logarithm of the longest chain.  A ring or a merged line becomes one row at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import kept


def chained(links: DataFrame) -> DataFrame:
    """(id, chain, rest) of links (id, next): the last id of its path, or the least id of its cycle, and how many links follow.

    Each id has one link at most, and no two lead to one id; `next` is null at the end of a
    path.  In a cycle the least id comes first.  Each round doubles the window of ids ahead that an id knows; ids that
    have seen their path's end or all of their cycle take no part in the rounds that follow.
    """
    none = F.lit(None).cast("long")
    start = links.select("id", "next", F.col("next").isNotNull().cast("long").alias("rest"), F.coalesce("next", "id").alias("last"), F.col("id").alias("low"), F.lit(0).cast("long").alias("off"), none.alias("chain"), none.alias("left"))
    circle, ended = F.col("chain").isNotNull(), F.col("chain").isNull() & F.col("next").isNull()
    state, found, ends = kept(start), [], []
    while True:
        active, over = state.agg(F.count_if(~circle & ~ended), F.count_if(ended)).first()
        found.append(state.where(circle | ended).select("id", F.coalesce("chain", "last").alias("chain"), F.coalesce("left", "rest").alias("rest")))
        if not active:
            break
        if over:
            ends.append(state.where(ended))
        # A cycle's ids find it closed in one round or the next, so that those of the last round are still asked for; ends of paths are, until all is done.
        asked = reduce(DataFrame.union, ends, state.where(~ended))
        ahead = asked.select(F.col("id").alias("next"), *[F.col(c).alias(f"_{c}") for c in ("next", "rest", "last", "low", "off")])
        # The same least id in a window and the next: the two hold the whole cycle, and the least id comes again after its length.
        closed = F.col("low") == F.col("_low")
        state = kept(state.where(~circle & ~ended).join(ahead, "next", "left").select(
            "id", F.col("_next").alias("next"), (F.col("rest") + F.coalesce("_rest", F.lit(0))).alias("rest"), F.coalesce("_last", "last").alias("last"), F.least("low", "_low").alias("low"),
            F.when(F.col("_low") < F.col("low"), F.col("rest") + F.col("_off")).otherwise(F.col("off")).alias("off"),
            F.when(closed, F.col("low")).alias("chain"), F.when(closed, F.when(F.col("off") == 0, F.col("rest") + F.col("_off")).otherwise(F.col("off")) - 1).alias("left"),
        ))
    return reduce(DataFrame.union, found)


def ring_edges(polygons: DataFrame) -> DataFrame:
    """(x1, y1, x2, y2): the edges of all rings of `rings` (the first of a polygon its outer one), land to their left."""
    rings = polygons.select(F.posexplode("rings").alias("k", "ring"))
    open_ = F.when((F.size("ring") > 1) & (F.element_at("ring", 1) == F.element_at("ring", -1)), F.slice("ring", F.lit(1), F.size("ring") - 1)).otherwise(F.col("ring"))
    rings = rings.withColumn("ring", open_).where(F.size("ring") > 2)
    after = F.concat(F.slice("ring", F.lit(2), F.size("ring") - 1), F.slice("ring", 1, 1))
    # Differences from the first vertex, so that large coordinates lose no digits.
    first = F.element_at("ring", 1)
    turn = F.aggregate(F.zip_with("ring", after, lambda a, b: (a["x"] - first["x"]) * (b["y"] - first["y"]) - (b["x"] - first["x"]) * (a["y"] - first["y"])), F.lit(0.0), lambda s, x: s + x)
    ends = F.zip_with("ring", after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = rings.select((((turn > 0) == (F.col("k") == 0)) & (turn != 0)).alias("keep"), F.explode(ends).alias("e"))
    pick = lambda one, two, axis: F.when(F.col("keep"), F.col(f"e.{one}.{axis}")).otherwise(F.col(f"e.{two}.{axis}"))
    edges = rows.select(pick("a", "b", "x").alias("x1"), pick("a", "b", "y").alias("y1"), pick("b", "a", "x").alias("x2"), pick("b", "a", "y").alias("y2"))
    return edges.where("x1 <> x2 or y1 <> y2")


def dissolved(polygons: DataFrame) -> DataFrame:
    """The outline of polygons that meet edge to edge: ring_id, area (negative of a hole), line (open, land to its left).

    Polygons (`rings`) may share whole edges, with equal coordinates, and may come
    repeatedly; edges with land on both sides go.  Where rings touch in a vertex, each is
    followed by its sharpest left turn, so that rings do not cross themselves.  An empty table gives no rows.
    """
    at = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    one, two = F.struct(at[0].alias("x"), at[1].alias("y")), F.struct(at[2].alias("x"), at[3].alias("y"))
    ways = ring_edges(polygons).select(F.least(one, two).alias("p"), F.greatest(one, two).alias("q"), F.when(one < two, 1).otherwise(-1).alias("way"))
    net = ways.groupBy("p", "q").agg(F.min("way").alias("way"), F.max("way").alias("other")).where("way = other")
    ends = [F.when(F.col("way") > 0, F.col(a)).otherwise(F.col(b)) for a, b in (("p", "q"), ("q", "p"))]
    edges = kept(net.select(F.monotonically_increasing_id().alias("id"), ends[0].alias("a"), ends[1].alias("b")))
    onward = edges.select(F.col("id").alias("to"), F.col("a").alias("b"), F.col("b").alias("c"))
    dx, dy = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    ex, ey = F.col("c.x") - F.col("b.x"), F.col("c.y") - F.col("b.y")
    turn = F.atan2(dx * ey - dy * ex, dx * ex + dy * ey)
    links = edges.join(onward, "b", "left").groupBy("id").agg(F.max_by("to", F.struct(turn.alias("turn"), F.col("to"))).alias("next"))
    rings = edges.join(chained(links), "id").groupBy(F.col("chain").alias("ring_id")).agg(F.array_sort(F.collect_list(F.struct((-F.col("rest")).alias("k"), "a"))).alias("v"))
    line = F.transform("v", lambda v: v["a"])
    after = F.concat(F.slice("line", F.lit(2), F.size("line") - 1), F.slice("line", 1, 1))
    first = F.element_at("line", 1)
    area = F.aggregate(F.zip_with("line", after, lambda a, b: (a["x"] - first["x"]) * (b["y"] - first["y"]) - (b["x"] - first["x"]) * (a["y"] - first["y"])), F.lit(0.0), lambda s, x: s + x) / 2
    return rings.select("ring_id", line.alias("line")).select("ring_id", area.alias("area"), "line")


def merged_lines(lines: DataFrame) -> DataFrame:
    """Lines (`line`) joined where just two ends meet: line_ids (in order; ids are given here), closed, line.

    A line goes in either direction; the merged line has the direction that its first-numbered
    line has.  Ends meet by equal coordinates.  Lines of fewer than two vertices are left out.
    """
    rows = kept(lines.where(F.size("line") > 1).select(F.monotonically_increasing_id().alias("n"), "line"))
    first, last = F.element_at("line", 1), F.element_at("line", -1)
    halves = kept(rows.select("n", F.explode(F.array(F.struct((2 * F.col("n")).alias("id"), first.alias("a"), last.alias("b")), F.struct((2 * F.col("n") + 1).alias("id"), last.alias("a"), first.alias("b")))).alias("h")).select("n", "h.*"))
    # Where two halves start, the other half of each goes on with the other one, or, of a closed line alone, with itself.
    other = lambda c: F.col(c).bitwiseXOR(F.lit(1))
    meet = halves.groupBy("a").agg(F.count(F.lit(1)).alias("degree"), F.min("id").alias("s"), F.max("id").alias("t")).where("degree = 2")
    links = meet.select(F.explode(F.array(F.struct(other("s").alias("id"), F.col("t").alias("next")), F.struct(other("t").alias("id"), F.col("s").alias("next")))).alias("l")).select("l.*")
    links = halves.select("id").join(links, "id", "left")
    chains = chained(links).withColumn("n", F.shiftright("id", 1)).join(rows, "n")
    way = F.when(F.col("id") % 2 == 0, F.col("line")).otherwise(F.reverse("line"))
    # Each chain is there in both directions: the one that holds its least line as it is stays.
    whole = chains.select("chain", "id", "n", (-F.col("rest")).alias("k"), way.alias("line")).groupBy("chain").agg(F.min("id").alias("least"), F.array_sort(F.collect_list(F.struct("k", "n", "line"))).alias("parts"))
    whole = whole.where("least % 2 = 0")
    points = F.aggregate(F.slice("parts", F.lit(2), F.size("parts")), F.element_at("parts", 1)["line"], lambda s, p: F.concat(s, F.slice(p["line"], F.lit(2), F.size(p["line"]))))
    out = whole.select(F.transform("parts", lambda p: p["n"]).alias("line_ids"), points.alias("line"))
    return out.select("line_ids", (F.element_at("line", 1) == F.element_at("line", -1)).alias("closed"), "line")
