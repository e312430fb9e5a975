"""Grids on other grids against closed formulas and plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as S
from tidemark.operators import raster, warp

HEADER = "path string, crs string, left double, top double, res_x double, res_y double, width int, height int"
CELLS = "path string, row long, col long, v double, k int"


@pytest.mark.parametrize("crs", ["EPSG:4326", "EPSG:3857", "EPSG:25831", "EPSG:32630"])
def test_projections_lead_back(spark, crs):
    rows = spark.createDataFrame([(lon / 4, lat) for lon in range(-4, 20) for lat in (0.0, 12.5, 39.7, 58.0)], "lon double, lat double")
    back = S.degrees_of(*S.metres_of(F.col("lon"), F.col("lat"), crs), crs)
    # Zone 30 ends at 0 degrees: five degrees beyond it the series still holds.
    worst = rows.select(F.max(F.abs(back[0] - F.col("lon"))), F.max(F.abs(back[1] - F.col("lat")))).first()
    assert max(worst) < 1e-8


def test_projections_know_points_and_refuse_others(spark):
    lon, lat = S.degrees_of(F.lit(448251.8), F.lit(5411932.7), "EPSG:32631")
    found = spark.range(1).select(lon, lat).first()
    assert found == pytest.approx((2.2945, 48.8582), abs=1e-4)
    for name in ("EPSG:32661", "EPSG:27700", "", "EPSG:3266x"):
        with pytest.raises(ValueError):
            S.metres_of(F.lit(1.0), F.lit(1.0), name)


def test_a_plane_in_utm_stays_a_plane_on_other_grids(spark):
    size, n, left, top = 10.0, 60, 450_000.0, 4_400_600.0
    plane = lambda x, y: 3.0 + 0.02 * (x - left) - 0.05 * (y - top)
    cells = spark.createDataFrame([("t", r, c, plane(left + (c + 0.5) * size, top - (r + 0.5) * size), 0) for r in range(n) for c in range(n)], CELLS)
    tiles = spark.createDataFrame([("t", "EPSG:25831", left, top, size, size, n, n)], HEADER)
    corner = spark.range(1).select(*S.metres_of(*S.degrees_of(F.lit(left + 50), F.lit(top - 550), "EPSG:25831"), "EPSG:3857")).first()
    box = raster.snapped((corner[0], corner[1], corner[0] + 500, corner[1] + 500), 7.0)
    target = raster.cells(spark, box, 7.0)
    on = warp.warped(target, tiles, cells, "EPSG:3857", ["EPSG:25831"], ["v"], block=200.0)
    back = S.metres_of(*S.degrees_of(F.col("x"), F.col("y"), "EPSG:3857"), "EPSG:25831")
    wrong = on.select("v", F.abs(F.col("v") - plane(back[0], back[1])).alias("d")).agg(F.count(F.lit(1)), F.count("v"), F.max("d")).first()
    assert wrong[0] == wrong[1] == target.count() and wrong[2] < 1e-6


def plain(tiles, cells, x, y, reach, layer):
    """The layer of the first tile by path, for grids of one kind of coordinates."""
    for path, _, left, top, rx, ry, width, height in sorted(tiles):
        u, v = (x - left) / rx, (top - y) / ry
        if not (0 <= u < width and 0 <= v < height):
            continue
        if layer == "k":
            found = cells.get((path, math.floor(v), math.floor(u)), (None, None))[1]
        else:
            total = weights = 0.0
            for r in range(height):
                for c in range(width):
                    w = max(0.0, 1 - abs(r + 0.5 - v) / reach) * max(0.0, 1 - abs(c + 0.5 - u) / reach)
                    value = cells.get((path, r, c), (None, None))[0]
                    if w > 0 and value is not None:
                        total, weights = total + w * value, weights + w
            found = total / weights if weights > 0 else None
        if found is not None:
            return found
    return None


@pytest.mark.parametrize("reach", [1.0, 1.6, 2.0, 3.0])
def test_overlapping_tiles_with_gaps_equal_a_plain_loop(spark, reach):
    pick = random.Random(3)
    tiles = [("b", "EPSG:3857", 0.0, 80.0, 10.0, 10.0, 8, 8), ("a", "EPSG:3857", 45.0, 63.0, 7.0, 9.0, 7, 6), ("c", "EPSG:3857", 1000.0, 1000.0, 10.0, 10.0, 3, 3)]
    cells = {(p, r, c): (pick.choice([None, pick.uniform(-5, 5)]), pick.choice([None, pick.randrange(4)])) for p, *_, w, h in tiles for r in range(h) for c in range(w) if pick.random() < 0.9}
    target = raster.cells(spark, (-20.0, -10.0, 120.0, 100.0), 5.0)
    found = warp.warped(target, spark.createDataFrame(tiles, HEADER), spark.createDataFrame([(*at, *v) for at, v in cells.items()], CELLS), "EPSG:3857", ["EPSG:3857"], ["v"], ["k"], block=37.0, reach=reach).collect()
    assert len(found) == 28 * 22
    for r in found:
        for layer in "vk":
            wanted = plain(tiles, cells, r.x, r.y, reach, layer)
            assert (r[layer] is None) == (wanted is None) and (wanted is None or r[layer] == pytest.approx(wanted, abs=1e-9)), r


def test_empty_tables_unknown_coordinates_and_repeated_cells(spark):
    target = raster.cells(spark, (0.0, 0.0, 20.0, 20.0), 10.0)
    tiles, cells = spark.createDataFrame([], HEADER), spark.createDataFrame([], CELLS)
    assert [r.v for r in warp.warped(target.union(target), tiles, cells, "EPSG:3857", ["EPSG:3857"], ["v"]).collect()] == [None] * 8
    assert warp.warped(target.limit(0), tiles, cells, "EPSG:3857", ["EPSG:3857"], ["v"]).isEmpty()
    odd = spark.createDataFrame([("t", "EPSG:25829", 0.0, 20.0, 10.0, 10.0, 2, 2)], HEADER)
    cells = spark.createDataFrame([("t", 0, 0, 1.0, 1)], CELLS)
    with pytest.raises(Exception, match="coordinates not among"):
        warp.warped(target, odd, cells, "EPSG:3857", ["EPSG:3857"], ["v"]).collect()


def test_clip_and_bands(spark):
    target = raster.cells(spark, (0.0, 0.0, 40.0, 40.0), 10.0)
    edges = spark.createDataFrame([(0.0, 0.0, 20.0, 0.0), (20.0, 0.0, 20.0, 40.0), (20.0, 40.0, 0.0, 40.0), (0.0, 40.0, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    inside = warp.clipped(target, edges, 15.0)
    assert {(r.row, r.col) for r in inside.collect()} == {(r, c) for r in range(4) for c in range(2)}
    tiles = spark.createDataFrame([("t", "EPSG:3857", 0.0, 40.0, 20.0, 20.0, 2, 2)], HEADER)
    cells = spark.createDataFrame([("t", 0, 0, 1000.0, 4), ("t", 0, 1, 0.0, 5), ("t", 1, 0, 3000.0, None), ("t", 1, 1, 0.0, 6)], CELLS)
    on = {(r.row, r.col): (r.v, r.k) for r in warp.aligned(inside, tiles, cells, "EPSG:3857", ["EPSG:3857"], {"v": (0.0001, -0.1, 0.0)}, ["k"]).collect()}
    # The no-data of the right column takes no part in the means.
    assert on[(0, 0)] == pytest.approx((0.0, 4)) and on[(3, 1)] == pytest.approx((0.2, 0)) and on[(1, 1)] == pytest.approx((0.05, 4))
