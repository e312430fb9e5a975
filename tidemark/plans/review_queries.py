"""Queries of reviews of a region's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import reviews
from .registry import query
from .views import VERTICES, lines, rounded, table, tidy

LABEL_TILES = "SELECT DISTINCT -400.0 + label % 4 * 200 AS x0, -400.0 + label // 4 * 200 AS y0 FROM vertices"


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each step of each line as a segment of its own."""
    n = F.size("line")
    steps = F.zip_with(F.slice("line", F.lit(1), n - 1), F.slice("line", F.lit(2), n - 1), lambda p, q: F.array(p, q))
    rows = lines(spark, sf_dir).select("vec_id", F.posexplode(steps).alias("k", "line"))
    return rows.select(F.concat_ws("_", "vec_id", "k").alias("segment_id"), "vec_id", "k", "line")


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square tile by label, four in a row."""
    rows = lines(spark, sf_dir).select("label").distinct()
    x, y = -400.0 + F.col("label") % 4 * 200, -400.0 + F.floor(F.col("label") / 4) * 200
    return rows.select(x.alias("min_x"), y.alias("min_y"), (x + 200).alias("max_x"), (y + 200).alias("max_y"))


# The distance of a step from each side, which runs along an axis: 0 where they cross, else the least of four distances of ends.
GAPS = VERTICES + f""", tiles AS ({LABEL_TILES}),
sides AS (
  SELECT DISTINCT * FROM (SELECT true AS flat, x0 AS a, x0 + 200 AS b, y0 AS c FROM tiles UNION ALL SELECT true, x0, x0 + 200, y0 + 200 FROM tiles
    UNION ALL SELECT false, y0, y0 + 200, x0 FROM tiles UNION ALL SELECT false, y0, y0 + 200, x0 + 200 FROM tiles)
), steps AS (SELECT vec_id, k, x AS x1, y AS y1, x + dx AS x2, y + dy AS y2, dx, dy FROM pieces WHERE dx IS NOT NULL),
-- p runs along the side and q across it.
laid AS (
  SELECT vec_id, k, a, b, CASE WHEN flat THEN x1 ELSE y1 END AS p1, CASE WHEN flat THEN x2 ELSE y2 END AS p2, CASE WHEN flat THEN y1 ELSE x1 END - c AS q1, CASE WHEN flat THEN y2 ELSE x2 END - c AS q2 FROM steps, sides
), feet AS (
  SELECT *, least(1.0, greatest(0.0, ((a - p1) * (p2 - p1) - q1 * (q2 - q1)) / ((p2 - p1) ** 2 + (q2 - q1) ** 2))) AS ta,
    least(1.0, greatest(0.0, ((b - p1) * (p2 - p1) - q1 * (q2 - q1)) / ((p2 - p1) ** 2 + (q2 - q1) ** 2))) AS tb FROM laid
), gaps AS (
  SELECT vec_id, k, min(CASE WHEN q1 * q2 < 0 AND p1 + (p2 - p1) * q1 / (q1 - q2) BETWEEN a AND b THEN 0.0 ELSE least(
    sqrt((p1 - least(b, greatest(a, p1))) ** 2 + q1 ** 2), sqrt((p2 - least(b, greatest(a, p2))) ** 2 + q2 ** 2),
    sqrt((p1 + ta * (p2 - p1) - a) ** 2 + (q1 + ta * (q2 - q1)) ** 2), sqrt((p1 + tb * (p2 - p1) - b) ** 2 + (q1 + tb * (q2 - q1)) ** 2)) END) AS distance
  FROM feet GROUP BY ALL
)"""


@query(rounded(GAPS + "--SELECT SELECT vec_id || '_' || k AS segment_id, distance FROM gaps WHERE distance <= 15", "distance"))
def q90_near_tile_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(reviews.near_tile_edges(_steps(spark, sf_dir), _tiles(spark, sf_dir), 15.0, 100.0))


@query(GAPS + """, near AS (SELECT k, (vec_id * 31 + k) % 100 / 100.0 AS share, (vec_id + k) % 97 - 2 AS slope FROM gaps WHERE distance <= 15)
SELECT CAST(15.0 AS DOUBLE) AS proximity_tolerance_m, count(*) AS segments_near_source_tile_edges, count(*) FILTER (WHERE share < 0.95) AS near_edge_segments_below_95pct_completeness,
  count(*) FILTER (WHERE slope < 0 OR slope > 90) AS near_edge_segments_with_slope_outside_0_90, count(*) FILTER (WHERE share < 0.95 OR slope < 0 OR slope > 90) > 0 AS automated_artifact_flag FROM near""")
def q91_tile_edge_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _steps(spark, sf_dir)
    features = steps.select("segment_id", ((F.col("vec_id") * 31 + F.col("k")) % 100 / 100).alias("terrain_valid_sample_share"), ((F.col("vec_id") + F.col("k")) % 97 - 2).alias("slope_max_deg"))
    return reviews.tile_edge_review(steps, features, _tiles(spark, sf_dir), 10.0, 100.0)


@query("""
WITH RECURSIVE spots AS (SELECT c_custkey AS k, c_custkey // 7 AS g, c_custkey % 7 AS i FROM customer),
ends AS (
  SELECT k, g, CAST(10 * g + i AS DOUBLE) AS x, CAST(0.05 * (k % 3) AS DOUBLE) AS y FROM spots UNION ALL SELECT k, g, 10 * g + i + CASE WHEN k % 5 = 0 THEN 0.5 ELSE 1 END, 0.05 * ((k + 1) % 4) FROM spots
), near AS (SELECT DISTINCT a.k AS a, b.k AS b FROM ends a JOIN ends b ON a.g = b.g AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.12),
reached(k, c) AS (SELECT k, k FROM spots UNION SELECT r.k, n.b FROM reached r JOIN near n ON n.a = r.c)
SELECT k, min(c) AS component FROM reached GROUP BY k""")
def q92_line_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps along rows of customers by seven; some are short, and some ends lie too far aside."""
    k = F.col("c_custkey")
    x, y = 10 * F.floor(k / 7) + k % 7, F.lit(0.05) * (k % 3)
    step = F.array(G.point(x, y), G.point(x + F.when(k % 5 == 0, 0.5).otherwise(1.0), F.lit(0.05) * ((k + 1) % 4)))
    return reviews.line_components(table(spark, sf_dir, "customer").select(k.alias("k"), step.alias("line")), "k", 0.12)


@query(VERTICES + """, steps AS (SELECT vec_id, k, x AS x1, y AS y1, x + dx AS x2, y + dy AS y2, dx, dy FROM pieces WHERE dx IS NOT NULL),
pairs AS (
  SELECT a.vec_id, a.dx * (b.y1 - a.y1) - a.dy * (b.x1 - a.x1) AS s1, a.dx * (b.y2 - a.y1) - a.dy * (b.x2 - a.x1) AS s2, b.dx * (a.y1 - b.y1) - b.dy * (a.x1 - b.x1) AS s3, b.dx * (a.y2 - b.y1) - b.dy * (a.x2 - b.x1) AS s4
  FROM steps a JOIN steps b ON a.vec_id = b.vec_id AND b.k > a.k + 1
) SELECT vec_id, count(*) FILTER (WHERE s1 * s2 < 0 AND s3 * s4 < 0) AS crossings FROM pairs GROUP BY 1""")
def q93_self_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.self_crossings(lines(spark, sf_dir).select("vec_id", "line"), "vec_id", 100.0)


@query(rounded(VERTICES + """, halves AS (SELECT vec_id, k, x, y, k < 16 AS first FROM vertices),
edges AS (SELECT vec_id, x AS x1, y AS y1, x + dx AS x2, y + dy AS y2, dx, dy, k < 16 AS first FROM pieces WHERE dx IS NOT NULL AND k <> 15),
near AS (
  SELECT h.vec_id, h.k, min(sqrt((h.x - x1 - t * dx) ** 2 + (h.y - y1 - t * dy) ** 2)) AS d
  FROM (SELECT h.vec_id, h.k, h.x, h.y, x1, y1, dx, dy, least(1.0, greatest(0.0, ((h.x - x1) * dx + (h.y - y1) * dy) / (dx * dx + dy * dy))) AS t FROM halves h JOIN edges e ON e.vec_id = h.vec_id AND e.first <> h.first) h GROUP BY ALL
)
--SELECT SELECT vec_id, max(d) AS hausdorff FROM near GROUP BY 1""", "hausdorff"))
def q94_hausdorff_of_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance of a line's first 16 vertices from its last 16."""
    halves = [F.slice("line", start, 16) for start in (1, 17)]
    return tidy(lines(spark, sf_dir).select("vec_id", G.hausdorff(*halves).alias("hausdorff")))


@query(rounded(VERTICES + """, steps AS (SELECT vec_id, k, x, y, dx, dy FROM pieces WHERE dx IS NOT NULL),
cuts AS (
  SELECT vec_id, k, sqrt(dx * dx + dy * dy) AS len, greatest(0.0, least((-60 - x) / dx, (60 - x) / dx), least((-60 - y) / dy, (60 - y) / dy)) AS a, least(1.0, greatest((-60 - x) / dx, (60 - x) / dx), greatest((-60 - y) / dy, (60 - y) / dy)) AS b FROM steps
), within AS (SELECT *, a > 0 OR coalesce(lag(k) OVER w, -9) <> k - 1 AS begins FROM cuts WHERE a < b WINDOW w AS (PARTITION BY vec_id ORDER BY k))
--SELECT SELECT vec_id, count(*) FILTER (WHERE begins) AS parts, sum((b - a) * len) AS length FROM within GROUP BY 1""", "length"))
def q95_clipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = reviews.clipped_lines(lines(spark, sf_dir).select("vec_id", "line"), "vec_id", (-60.0, -60.0, 60.0, 60.0))
    return tidy(parts.groupBy("vec_id").agg(F.count(F.lit(1)).alias("parts"), F.sum(G.length(F.col("line"))).alias("length")))
