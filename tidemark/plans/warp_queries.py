"""Queries of grids laid onto grids of other coordinates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import warp
from .registry import query
from .views import GRID, grid, tidy

#: Where the grids lie: metres of UTM 31 and of EPSG:3857, and degrees; sides of cells, and rows of a tile.
UTM, DEGREES, MERCATOR = (400_000.0, 4_400_000.0, 10.0, 128), (1.832, 39.745, 0.0001, 50), (203_950.0, 4_828_950.0, 14.0)
#: The series of the flattening by which UTM follows from degrees.
N = 1 / (2 * 298.257222101 - 1)
KRUEGER = (N / 2 - 2 / 3 * N**2 + 5 / 16 * N**3, 13 / 48 * N**2 - 3 / 5 * N**3, 61 / 240 * N**3)
ECCENTRICITY, MEAN_RADIUS = 2 * math.sqrt(N) / (1 + N), 6378137.0 / (1 + N) * (1 + N**2 / 4 + N**4 / 64)

# From the target's centres to both sources, in units of their cells; u and v count over all tiles of a source.
PLACES = f"""target AS (SELECT row, col, {MERCATOR[0]} + (col + 0.5e0) * {MERCATOR[2]} AS x, {MERCATOR[1]} - (row + 0.5e0) * {MERCATOR[2]} AS y FROM grid),
turned AS (SELECT *, degrees(x / 6378137.0) AS lon, degrees(2 * atan(exp(y / 6378137.0)) - pi() / 2) AS lat FROM target),
sphere AS (SELECT *, sinh(atanh(sin(radians(lat))) - {ECCENTRICITY} * atanh({ECCENTRICITY} * sin(radians(lat)))) AS t, radians(lon - 3) AS d FROM turned),
cylinder AS (SELECT *, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM sphere),
metres AS (
  SELECT *, 500000 + {0.9996 * MEAN_RADIUS!r}e0 * (eta + {" + ".join(f"CAST({c!r} AS DOUBLE) * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(KRUEGER, 1))}) AS e,
    {0.9996 * MEAN_RADIUS!r}e0 * (xi + {" + ".join(f"CAST({c!r} AS DOUBLE) * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(KRUEGER, 1))}) AS n FROM cylinder
), places AS (
  SELECT row, col, 'a' AS kind, {UTM[3]} AS height, (e - {UTM[0]}) / {UTM[2]} AS u, ({UTM[1]} - n) / {UTM[2]} AS v FROM metres
  UNION ALL SELECT row, col, 'b', {DEGREES[3]}, (lon - {DEGREES[0]}) / {DEGREES[2]}, ({DEGREES[1]} - lat) / {DEGREES[2]} FROM metres
)"""


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The grid twice: in UTM, in tiles of 128 rows, and in degrees, upside down in sign, in tiles of 50 rows; headers and cells."""
    rows = grid(spark, sf_dir)

    def one(kind: str, crs: str, place: tuple[float, float, float, int], sign: float) -> tuple[DataFrame, DataFrame]:
        left, top, size, height = place
        tile = F.floor(F.col("row") / height)
        path = F.concat(F.lit(kind), tile)
        headers = rows.groupBy(tile.alias("t")).agg(F.lit(1)).select(
            F.concat(F.lit(kind), "t").alias("path"), F.lit(crs).alias("crs"), F.lit(left).alias("left"), (F.lit(top) - F.col("t") * height * size).alias("top"),
            F.lit(size).alias("res_x"), F.lit(size).alias("res_y"), F.lit(64).alias("width"), F.lit(height).alias("height"),
        )
        return headers, rows.select(path.alias("path"), (F.col("row") % height).alias("row"), "col", (F.col("value") * sign).alias("value"), F.col("label").cast("long").alias("label"))

    (ha, ca), (hb, cb) = one("a", "EPSG:25831", UTM, 1.0), one("b", "EPSG:4326", DEGREES, -1.0)
    return ha.union(hb), ca.union(cb)


@query(GRID + f""", {PLACES}, inside AS (SELECT * FROM places WHERE u >= 0 AND u < 64 AND v >= 0),
spread_rows AS (SELECT *, CAST(floor(v - 0.5) AS BIGINT) + unnest([0, 1]) AS r FROM inside),
corners AS (SELECT *, CAST(floor(u - 0.5) AS BIGINT) + unnest([0, 1]) AS c FROM spread_rows WHERE r >= 0 AND r // height = CAST(floor(v) AS BIGINT) // height),
met AS (
  SELECT p.row, p.col, kind, CASE kind WHEN 'a' THEN g.value ELSE -g.value END AS value, (1 - abs(r + 0.5 - v)) * (1 - abs(c + 0.5 - u)) AS w,
    CASE WHEN r = floor(v) AND c = floor(u) THEN g.label END AS label
  FROM corners p JOIN grid g ON g.row = p.r AND g.col = p.c
), tiles AS (SELECT row, col, kind, sum(w * value) / sum(w) FILTER (WHERE value IS NOT NULL) AS value, max(label) AS label FROM met GROUP BY ALL),
first_ AS (SELECT row, col, arg_min(value, kind) FILTER (WHERE value IS NOT NULL) AS value, arg_min(label, kind) FILTER (WHERE label IS NOT NULL) AS label FROM tiles GROUP BY ALL)
SELECT t.row, t.col, round(value, 3) + 0.0 AS value, label FROM target t LEFT JOIN first_ f ON f.row = t.row AND f.col = t.col""")
def q89_warped_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles in UTM and in degrees on one grid of EPSG:3857: bilinear values, of the first tile that has one, and the class of the cell beneath."""
    headers, cells = _sources(spark, sf_dir)
    left, top, size = MERCATOR
    target = grid(spark, sf_dir).select("row", "col", (F.lit(left) + (F.col("col") + 0.5) * size).alias("x"), (F.lit(top) - (F.col("row") + 0.5) * size).alias("y"))
    on = warp.warped(target, headers, cells, "EPSG:3857", ("EPSG:25831", "EPSG:4326"), ["value"], ["label"], block=1000.0)
    return tidy(on.select("row", "col", (F.round("value", 3) + F.lit(0.0)).alias("value"), "label"))
