"""Grids laid onto grids of other coordinates: each target cell is looked up where it lies in each source.

Tiles are headers (path, crs, left, top, res_x, res_y, width, height) and cells (path, row,
col and layers).  Target cells meet the tiles by an equality join on square blocks, and the
tiles' cells by one on path, row and column, so no task holds a tile or a grid.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .coast import covered_points


def footprints(tiles: DataFrame, target_crs: str, source_crs: Sequence[str], steps: int = 20) -> DataFrame:
    """path and the box (min_x, min_y, max_x, max_y) of each tile in the target's coordinates.

    Of `steps` + 1 points a side, widened by a twentieth: a superset for tiles whose sides bend by less than that.
    """
    along, k = F.sequence(F.lit(0), F.lit(steps)), F.lit(float(steps))
    sides = F.flatten(F.transform(along, lambda i: F.array(*[F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")) for a, b in ((i / k, F.lit(0)), (i / k, F.lit(1)), (F.lit(0), i / k), (F.lit(1), i / k))])))
    points = tiles.select("path", "crs", "left", "top", "res_x", "res_y", "width", "height", F.explode(sides).alias("s"))
    points = points.withColumns({"_x": F.col("left") + F.col("s.a") * F.col("width") * F.col("res_x"), "_y": F.col("top") - F.col("s.b") * F.col("height") * F.col("res_y")})
    lon_lat = by_name(F.col("crs"), source_crs, lambda name: S.degrees_of(F.col("_x"), F.col("_y"), name))
    x, y = S.metres_of(F.col("_p.x"), F.col("_p.y"), target_crs)
    own = F.col("crs") == target_crs
    at = points.withColumn("_p", lon_lat).select("path", F.when(own, F.col("_x")).otherwise(x).alias("x"), F.when(own, F.col("_y")).otherwise(y).alias("y"))
    box = at.groupBy("path").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    dx, dy = (F.col("x1") - F.col("x0")) / 20, (F.col("y1") - F.col("y0")) / 20
    return box.select("path", (F.col("x0") - dx).alias("min_x"), (F.col("y0") - dy).alias("min_y"), (F.col("x1") + dx).alias("max_x"), (F.col("y1") + dy).alias("max_y"))


def by_name(crs: Column, names: Sequence[str], of: Callable[[str], tuple[Column, Column]]) -> Column:
    """The point (x, y) that `of` gives for the coordinates that `crs` names; an error if they are not among names."""
    point = lambda name: F.struct(*[v.cast("double").alias(axis) for v, axis in zip(of(name), "xy", strict=True)])
    unknown = F.raise_error(F.concat(F.lit("coordinates not among source_crs: "), F.coalesce(crs, F.lit("null")))).cast("struct<x:double,y:double>")
    first, *others = dict.fromkeys(names)
    return reduce(lambda case, name: case.when(crs == name, point(name)), others, F.when(crs == first, point(first))).otherwise(unknown)


def placed_in_tiles(target: DataFrame, tiles: DataFrame, target_crs: str, source_crs: Sequence[str], block: float) -> DataFrame:
    """(row, col, path, u, v) of each target cell (row, col, x, y) and each tile that its centre lies in; u and v count the tile's cells from its upper left corner.

    `block` is the side of the blocks in which they meet, in target units: near the tiles' size, so that a tile goes to few.
    """
    at = lambda v: F.floor(v / F.lit(float(block))).cast("long")
    boxes = footprints(tiles, target_crs, source_crs).select("path", F.explode(F.sequence(at(F.col("min_x")), at(F.col("max_x")))).alias("_bx"), "min_y", "max_y")
    boxes = boxes.select("path", "_bx", F.explode(F.sequence(at(F.col("min_y")), at(F.col("max_y")))).alias("_by"))
    headers = boxes.join(tiles.select("path", "crs", "left", "top", "res_x", "res_y", "width", "height"), "path")
    met = target.select("row", "col", "x", "y", at(F.col("x")).alias("_bx"), at(F.col("y")).alias("_by")).join(headers, ["_bx", "_by"])
    # The way back: from the target's coordinates to each tile's own.
    lon, lat = S.degrees_of(F.col("x"), F.col("y"), target_crs)
    met = met.withColumns({"_lon": lon, "_lat": lat})
    source = by_name(F.col("crs"), source_crs, lambda name: (F.col("x"), F.col("y")) if name == target_crs else S.metres_of(F.col("_lon"), F.col("_lat"), name))
    met = met.withColumn("_s", source).withColumns({"_u": (F.col("_s.x") - F.col("left")) / F.col("res_x"), "_v": (F.col("top") - F.col("_s.y")) / F.col("res_y")})
    # As rows of a generator, the places are computed once, and not again in each condition on them.
    once = F.inline(F.array(F.struct(F.col("_u").alias("u"), F.col("_v").alias("v"))))
    return met.select("row", "col", "path", "width", "height", once).where("u >= 0 and v >= 0 and u < width and v < height").select("row", "col", "path", "u", "v")


def warped(
    target: DataFrame, tiles: DataFrame, cells: DataFrame, target_crs: str, source_crs: Sequence[str], continuous: Sequence[str], categorical: Sequence[str] = (), block: float = 5000.0, reach: float = 1.0
) -> DataFrame:
    """target (row, col, x, y) with the layers of the tiles on it.

    Continuous layers are bilinear means of the known cells around, by weights that fall to
    zero at `reach` cells: 1, or, where target cells are larger, their size in source cells.
    Categorical layers are those of the cell that the centre lies in.  A layer comes from the
    first tile, by path, that has it there; null if none has.  Repeated target cells stay;
    a tile's cell or a path that comes twice is an error of the input.
    """
    n = max(1, math.ceil(reach))
    near = placed_in_tiles(target.select("row", "col", "x", "y").distinct(), tiles, target_crs, source_crs, block)
    near = near.withColumns({"_r": F.floor(F.col("v") - 0.5), "_c": F.floor(F.col("u") - 0.5)})
    spread = lambda at: F.explode(F.transform(F.sequence(F.lit(1 - n), F.lit(n)), lambda i: (F.col(at) + i).cast("long")))
    weight = lambda at, of: F.greatest(F.lit(0.0), 1 - F.abs(F.col(at) + 0.5 - F.col(of)) / F.lit(float(reach)))
    rows = near.select("row", "col", "path", "u", "v", "_c", spread("_r").alias("_sr")).withColumn("_wv", weight("_sr", "v")).where("_wv > 0")
    both = rows.select("row", "col", "path", "u", "v", "_sr", "_wv", spread("_c").alias("_sc")).withColumn("_wu", weight("_sc", "u")).where("_wu > 0")
    inside = (F.col("_sr") == F.floor("v")) & (F.col("_sc") == F.floor("u"))
    corners = both.select("row", "col", "path", "_sr", "_sc", (F.col("_wu") * F.col("_wv")).alias("_w"), inside.alias("_in"))
    layers = [*continuous, *categorical]
    source = cells.select("path", F.col("row").cast("long").alias("_sr"), F.col("col").cast("long").alias("_sc"), *[F.col(c).alias(f"_l{i}") for i, c in enumerate(layers)])
    # Both aggregations and the last join go by target cell: one shuffle for the three.
    met = corners.join(source, ["path", "_sr", "_sc"]).repartition("row", "col")
    w = F.col("_w")
    mean = lambda v: F.try_divide(F.sum(w * v), F.sum(F.when(v.isNotNull(), w)))
    own = [mean(F.col(f"_l{i}")) if i < len(continuous) else F.max(F.when(F.col("_in"), F.col(f"_l{i}"))) for i in range(len(layers))]
    by_tile = met.groupBy("row", "col", "path").agg(*[v.alias(f"_l{i}") for i, v in enumerate(own)])
    first = by_tile.groupBy("row", "col").agg(*[F.min_by(f"_l{i}", F.when(F.col(f"_l{i}").isNotNull(), F.col("path"))).alias(c) for i, c in enumerate(layers)])
    return target.join(first, ["row", "col"], "left")


def clipped(target: DataFrame, edges: DataFrame, strip: float) -> DataFrame:
    """The target cells whose centres polygons (edges x1, y1, x2, y2, in the target's coordinates) cover; strips of a height for the search."""
    key = target.select(F.struct("row", "col").alias("_k"), F.struct("x", "y").alias("p"))
    covered = covered_points(key, "_k", edges, strip).where("covered").select("_k.row", "_k.col")
    return target.join(covered, ["row", "col"], "left_semi")


def aligned(
    target: DataFrame, tiles: DataFrame, cells: DataFrame, target_crs: str, source_crs: Sequence[str], bands: Mapping[str, tuple[float, float, float | None]], classes: Sequence[str] = (), block: float = 5000.0
) -> DataFrame:
    """target with bands as reflectance (scale, offset and no-data by name) and classes, 0 where they are unknown."""
    known = {c: F.when(F.col(c) != F.lit(float(nodata)), F.col(c)) for c, (_, _, nodata) in bands.items() if nodata is not None}
    rows = warped(target, tiles, cells.withColumns(known), target_crs, source_crs, list(bands), classes, block)
    return rows.withColumns({c: S.reflectance(F.col(c), scale, offset, nodata) for c, (scale, offset, nodata) in bands.items()} | {c: F.coalesce(F.col(c), F.lit(0)) for c in classes})
