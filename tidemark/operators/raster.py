"""Grids as long tables (row, col, value), null where there is no data.

Neighbourhoods are joins, not windows over a row or a column of the grid: each cell sends
its value to the cells that need it, keyed by the target cell, so that the size of a task
depends on the number of cells and not on the width of the grid.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import finite


def sent(grid: DataFrame, keys: Sequence[str], offsets: Sequence[tuple[int, int]], value: str = "value") -> DataFrame:
    """Each cell's value at each cell that has it at an offset: keys, row, col, dr, dc, value."""
    to = F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in offsets])).alias("o")
    return grid.select(*keys, "row", "col", F.col(value).alias("value"), to).select(*keys, (F.col("row") - F.col("o.dr")).alias("row"), (F.col("col") - F.col("o.dc")).alias("col"), F.col("o.dr").alias("dr"), F.col("o.dc").alias("dc"), "value")


def gradients(grid: DataFrame, keys: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Per cell: keys, row, col, value, and `across` and `down`, its differences per cell: central, one-sided at the rim of the grid, null next to missing values."""
    around = sent(grid, keys, ((0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)), value).groupBy(*keys, "row", "col")
    at = lambda a, b: (F.col("dr") == a) & (F.col("dc") == b)
    cells = around.agg(
        F.bool_or(at(0, 0)).alias("_own"),
        *[F.max(F.when(at(a, b), F.col("value"))).alias(n) for n, a, b in (("_c", 0, 0), ("_n", -1, 0), ("_s", 1, 0), ("_w", 0, -1), ("_e", 0, 1))],
        *[F.coalesce(F.bool_or(at(a, b)), F.lit(False)).alias(n) for n, a, b in (("_hn", -1, 0), ("_hs", 1, 0), ("_hw", 0, -1), ("_he", 0, 1))],
    )

    def difference(before: str, after: str, has_before: str, has_after: str) -> Column:
        two = (F.col(after) - F.col(before)) / 2
        return F.when(F.col(has_before) & F.col(has_after), two).when(F.col(has_after), F.col(after) - F.col("_c")).when(F.col(has_before), F.col("_c") - F.col(before))

    return cells.where("_own").select(*keys, "row", "col", F.col("_c").alias("value"), difference("_w", "_e", "_hw", "_he").alias("across"), difference("_n", "_s", "_hn", "_hs").alias("down"))


def slope(grid: DataFrame, keys: Sequence[str] = (), resolution: float = 1.0, value: str = "value") -> DataFrame:
    """slope_deg per cell, 0 to 90 degrees, by gradients; null where the cell is missing or next to a missing one."""
    steep = F.degrees(F.atan(F.hypot(F.col("across") / resolution, F.col("down") / resolution)))
    cells = gradients(grid, keys, value).withColumn("_steep", steep)
    return cells.select(*keys, "row", "col", F.when(F.col("value").isNotNull() & F.col("_steep").isNotNull(), F.least(F.lit(90.0), F.greatest(F.lit(0.0), F.col("_steep")))).alias("slope_deg"))


def window_radius(metres: float, pixel: float) -> int:
    """The radius in pixels of a window of so many metres; a window of an even number of pixels widens."""
    return max(1, max(1, round(metres / pixel)) // 2)


def roughness(grid: DataFrame, keys: Sequence[str] = (), radius: int = 1, value: str = "value") -> DataFrame:
    """roughness per cell: the standard deviation of the values within the radius, null where the cell itself is missing.

    Sums along rows first, then along columns: 2 (2 r + 1) rows per cell, not (2 r + 1)^2.
    """
    span = range(-radius, radius + 1)
    v = F.col("value")
    across = sent(grid, keys, [(0, i) for i in span], value).groupBy(*keys, "row", "col").agg(
        F.bool_or(F.col("dc") == 0).alias("_own"), F.max(F.when(F.col("dc") == 0, v)).alias("_c"), F.count(v).alias("_n"), F.sum(v).alias("_s"), F.sum(v * v).alias("_q")
    )
    sums = across.withColumn("value", F.struct("_c", "_own", "_n", "_s", "_q"))
    down = sent(sums, keys, [(i, 0) for i in span]).groupBy(*keys, "row", "col").agg(
        F.bool_or((F.col("dr") == 0) & F.col("value._own")).alias("_own"), F.max(F.when(F.col("dr") == 0, F.col("value._c"))).alias("_c"),
        F.sum("value._n").alias("_n"), F.sum("value._s").alias("_s"), F.sum("value._q").alias("_q"),
    )
    mean = F.col("_s") / F.col("_n")
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.col("_q") / F.col("_n") - mean * mean))
    return down.where("_own").select(*keys, "row", "col", F.when(F.col("_c").isNotNull(), deviation).alias("roughness"))


def mosaic(tiles: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """One row per cell: the value of the first tile, by path, that has one; null if none has."""
    usable = finite(F.col(value))
    return tiles.groupBy("row", "col").agg(F.min(F.when(usable.isNotNull(), F.struct(F.col(path).alias("p"), usable.alias("v")))).alias("_f")).select("row", "col", F.col("_f.v").alias("value"), F.col("_f.p").alias("path"))


def cell_of(x: Column, y: Column, left: float = 0.0, top: float = 0.0, resolution: float = 1.0) -> tuple[Column, Column]:
    """Row and column of the cell that holds a point; rows run downwards."""
    return F.floor((F.lit(top) - y) / resolution).cast("long"), F.floor((x - F.lit(left)) / resolution).cast("long")


def nearest(points: DataFrame, grid: DataFrame, left: float = 0.0, top: float = 0.0, resolution: float = 1.0, name: str = "sample") -> DataFrame:
    """points (with x, y) and the value of the cell that each lies in; null outside the grid."""
    row, col = cell_of(F.col("x"), F.col("y"), left, top, resolution)
    return points.withColumns({"row": row, "col": col}).join(grid.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").alias(name)), ["row", "col"], "left").drop("row", "col")


def bilinear(points: DataFrame, grid: DataFrame, key: str, left: float = 0.0, top: float = 0.0, resolution: float = 1.0, name: str = "sample") -> DataFrame:
    """points (key, x, y) and the value between the four cell centres around each; null if one of them is missing."""
    u, v = (F.col("x") - F.lit(left)) / resolution - 0.5, (F.lit(top) - F.col("y")) / resolution - 0.5
    placed = points.withColumns({"_c": F.floor(u), "_r": F.floor(v)}).withColumns({"_fx": u - F.col("_c"), "_fy": v - F.col("_r")})
    corner = lambda a, b: F.struct((F.col("_r") + a).cast("long").alias("row"), (F.col("_c") + b).cast("long").alias("col"), ((F.col("_fy") if a else 1 - F.col("_fy")) * (F.col("_fx") if b else 1 - F.col("_fx"))).alias("w"))
    corners = placed.select(key, F.explode(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)])).alias("k")).select(key, "k.*")
    met = corners.join(grid.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "value"), ["row", "col"])
    sums = met.groupBy(key).agg(F.when(F.count("value") == 4, F.sum(F.col("w") * F.col("value"))).alias(name))
    return points.join(sums, key, "left")


def snapped(box: tuple[float, float, float, float], resolution: float) -> tuple[float, float, float, float]:
    """A box widened to whole multiples of the resolution."""
    low, high = (lambda v: math.floor(v / resolution) * resolution), (lambda v: math.ceil(v / resolution) * resolution)
    return low(box[0]), low(box[1]), high(box[2]), high(box[3])


def cells(spark: SparkSession, box: tuple[float, float, float, float], resolution: float) -> DataFrame:
    """The cells of a snapped box: row, col, and x and y of their centres; made by the tasks, so that a grid of any size is."""
    rows, cols = round((box[3] - box[1]) / resolution), round((box[2] - box[0]) / resolution)
    at = spark.range(rows * cols).select(F.floor(F.col("id") / cols).alias("row"), (F.col("id") % cols).alias("col"))
    return at.withColumns({"x": F.lit(box[0]) + (F.col("col") + 0.5) * resolution, "y": F.lit(box[3]) - (F.col("row") + 0.5) * resolution})


def resampled(target: DataFrame, source: DataFrame, continuous: Sequence[str], categorical: Sequence[str], left: float = 0.0, top: float = 0.0, resolution: float = 1.0) -> DataFrame:
    """target (row, col, x, y) with all layers of a source grid on it, in one join and one aggregation.

    Continuous layers are means of the known ones of the four cell centres around, weighted
    as bilinear does; categorical ones are those of the cell that the point lies in.  All
    are null where the point lies outside the source's cells.
    """
    u, v = (F.col("x") - F.lit(left)) / resolution - 0.5, (F.lit(top) - F.col("y")) / resolution - 0.5
    placed = target.withColumns({"_c": F.floor(u), "_r": F.floor(v)}).withColumns({"_fx": u - F.col("_c"), "_fy": v - F.col("_r")})
    down, right = (F.col("_fy") >= 0.5).cast("int"), (F.col("_fx") >= 0.5).cast("int")

    def corner(a: int, b: int) -> Column:
        weight = (F.col("_fy") if a else 1 - F.col("_fy")) * (F.col("_fx") if b else 1 - F.col("_fx"))
        return F.struct((F.col("_r") + a).cast("long").alias("_sr"), (F.col("_c") + b).cast("long").alias("_sc"), weight.alias("_w"), ((down == a) & (right == b)).alias("_in"))

    corners = placed.select("row", "col", F.explode(F.array(*[corner(a, b) for a in (0, 1) for b in (0, 1)])).alias("k")).select("row", "col", "k.*")
    layers = source.select(F.col("row").cast("long").alias("_sr"), F.col("col").cast("long").alias("_sc"), *continuous, *categorical)
    w = F.col("_w")
    mean = lambda c: F.try_divide(F.sum(w * F.col(c)), F.sum(F.when(F.col(c).isNotNull(), w)))
    found = corners.join(layers, ["_sr", "_sc"]).groupBy("row", "col").agg(
        F.bool_or("_in").alias("_inside"), *[mean(c).alias(c) for c in continuous], *[F.max(F.when(F.col("_in"), F.col(c))).alias(c) for c in categorical]
    )
    return target.join(found.where("_inside").drop("_inside"), ["row", "col"], "left")


def parent_cells(grid: DataFrame, factor: int = 2) -> DataFrame:
    """Row and column of the coarser cell that each cell lies in."""
    return grid.withColumns({"parent_row": F.floor(F.col("row") / factor).cast("long"), "parent_col": F.floor(F.col("col") / factor).cast("long")})
