"""Queries of polygons laid over each other, of outlines and of merged lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import overlay, rings
from ..sources import located
from .registry import query
from .views import GRID, VERTICES, grid, lines, rounded, table, tidy

ZONES, SPACING = (("nearshore", 2, 10), ("coastal", 10, 24)), 4
# Parts orders sit in blocks of 40 by 40, a segment and a rectangle of land each.
PARTS = """
WITH spots AS (
  SELECT o_orderkey AS k, (o_orderkey % 500) * 40 AS bx, (o_orderkey // 500) * 40 AS bz FROM orders
), segments AS (
  SELECT CAST(k AS VARCHAR) AS segment_id, bx + 10 AS x, bz + 10 AS y, 90 * (k % 4) AS bearing, 4 * (1 + k % 3) AS len, k % 2 = 0 AS flat, CASE WHEN k % 11 = 0 THEN 'ambiguous' ELSE 'resolved' END AS st FROM spots
), land AS (
  SELECT bx + k % 17 AS lx, bz + 2 + k % 13 AS ly, 3 + k % 9 AS w, 2 + k % 19 AS h, k % 3 = 0 AS holed FROM spots
)"""


def _spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("k"), (k % 500 * 40).alias("bx"), (F.floor(k / 500) * 40).alias("by"))


def _segments(spots: DataFrame) -> DataFrame:
    k, n = F.col("k"), 4 * (1 + F.col("k") % 3)
    x, y = F.col("bx") + 10, F.col("by") + 10
    end = G.point(F.when(k % 2 == 0, x + n).otherwise(x), F.when(k % 2 == 0, y).otherwise(y + n))
    return spots.select(
        k.cast("string").alias("segment_id"), F.array(G.point(x, y), end).alias("line"), (90.0 * (k % 4)).alias("seaward_bearing_deg"),
        F.when(k % 11 == 0, "ambiguous").otherwise("resolved").alias("orientation_status"),
    )


def _box(x0, y0, x1, y1):  # noqa: ANN001, ANN202
    return F.array(*[G.point(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])


def _land(spots: DataFrame) -> DataFrame:
    """A rectangle a block; every third has a hole one unit within it, where there is room."""
    k = F.col("k")
    x0, y0 = F.col("bx") + k % 17, F.col("by") + 2 + k % 13
    x1, y1 = x0 + 3 + k % 9, y0 + 2 + k % 19
    holed = (k % 3 == 0) & (x1 - x0 > 2) & (y1 - y0 > 2)
    return spots.select(F.when(holed, F.array(_box(x0, y0, x1, y1), _box(x0 + 1, y0 + 1, x1 - 1, y1 - 1))).otherwise(F.array(_box(x0, y0, x1, y1))).alias("rings"))


@query(PARTS + f""", kinds(t, a, b) AS (VALUES {", ".join(f"('{t}', {a}, {b})" for t, a, b in ZONES)}),
strips AS (
  SELECT segment_id, t, bearing, a, b, x + CASE WHEN flat THEN 4 * i + 2 ELSE 0 END AS ox, y + CASE WHEN flat THEN 0 ELSE 4 * i + 2 END AS oy
  FROM segments, kinds, (SELECT unnest(range(3)) AS i) WHERE 4 * i < len AND st <> 'ambiguous'
), boxes AS (
  SELECT segment_id, t, CASE bearing WHEN 90 THEN ox + a WHEN 270 THEN ox - b ELSE ox - 2 END AS x0, CASE bearing WHEN 90 THEN ox + b WHEN 270 THEN ox - a ELSE ox + 2 END AS x1,
    CASE bearing WHEN 0 THEN oy + a WHEN 180 THEN oy - b ELSE oy - 2 END AS y0, CASE bearing WHEN 0 THEN oy + b WHEN 180 THEN oy - a ELSE oy + 2 END AS y1 FROM strips
), columns_ AS (SELECT segment_id, t, y0, y1, unnest(range(x0, x1)) AS cx FROM boxes),
units AS (SELECT DISTINCT segment_id, t, cx, unnest(range(y0, y1)) AS cy FROM columns_),
ground AS (SELECT *, unnest(range(lx, lx + w)) AS cx FROM land),
solid AS (SELECT *, unnest(range(ly, ly + h)) AS cy FROM ground),
dry AS (SELECT DISTINCT cx, cy FROM solid WHERE NOT (holed AND w > 2 AND h > 2 AND cx > lx AND cx < lx + w - 1 AND cy > ly AND cy < ly + h - 1)),
wet AS (SELECT segment_id, t, count(*) AS n FROM (SELECT u.* FROM units u LEFT JOIN dry d ON d.cx = u.cx AND d.cy = u.cy WHERE d.cx IS NULL) GROUP BY ALL)
SELECT s.segment_id || ':' || k.t AS zone_id, CAST(coalesce(n, 0) AS DOUBLE) AS zone_area_m2,
  CASE WHEN st = 'ambiguous' THEN 'ambiguous_orientation' WHEN n > 0 THEN 'valid' ELSE 'empty_after_land_exclusion' END AS zone_status
FROM segments s CROSS JOIN kinds k LEFT JOIN wet ON wet.segment_id = s.segment_id AND wet.t = k.t""")
def q85_zones_less_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = _spots(spark, sf_dir)
    zones = overlay.zones_less_land(_segments(spots), _land(spots), ZONES, float(SPACING), 40.0)
    return tidy(zones.select("zone_id", "zone_area_m2", "zone_status"))


@query(GRID + """, full_ AS (SELECT row, col FROM grid WHERE value > 0),
sides AS (
  SELECT row, col, row - 1 AS nrow, col AS ncol, col AS x1, row AS y1, col + 1 AS x2, row AS y2 FROM full_
  UNION ALL SELECT row, col, row, col + 1, col + 1, row, col + 1, row + 1 FROM full_
  UNION ALL SELECT row, col, row + 1, col, col + 1, row + 1, col, row + 1 FROM full_
  UNION ALL SELECT row, col, row, col - 1, col, row + 1, col, row FROM full_
)
SELECT CAST(s.x1 AS DOUBLE) AS x1, CAST(s.y1 AS DOUBLE) AS y1, CAST(s.x2 AS DOUBLE) AS x2, CAST(s.y2 AS DOUBLE) AS y2
FROM sides s LEFT JOIN full_ n ON n.row = s.nrow AND n.col = s.ncol WHERE n.row IS NULL""")
def q86_dissolved_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sides of the rings that cells of positive value dissolve to, taken from the rings' vertices in order."""
    cells = grid(spark, sf_dir).where("value > 0")
    x, y = F.col("col"), F.col("row")
    outlines = rings.dissolved(cells.select(F.array(_box(x, y, x + 1, y + 1)).alias("rings")))
    after = F.concat(F.slice("line", F.lit(2), F.size("line") - 1), F.slice("line", 1, 1))
    return outlines.select(F.inline(F.zip_with("line", after, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))))


@query(rounded("""
WITH c AS (SELECT c_custkey AS s, c_custkey % 7 + 1 AS n, c_custkey % 5 = 0 AS branch FROM customer),
-- A chain of n unit steps; a branch at its first inner vertex cuts it in two, and at the end of a single step prolongs it.
l AS (
  SELECT s, 0 AS a, n AS b, branch AND n = 1 AS bent, n = 6 AND NOT branch AS ring FROM c WHERE NOT branch OR n = 1
  UNION ALL SELECT s, 0, 1, false, false FROM c WHERE branch AND n > 1
  UNION ALL SELECT s, 1, n, false, false FROM c WHERE branch AND n > 1
)
--SELECT SELECT s, CAST(b - a + 1 + bent::INT + ring::INT AS BIGINT) AS n_vertices, CASE WHEN ring THEN 12.0 ELSE b - a + CASE WHEN bent THEN 0.5 ELSE 0 END END AS length, ring AS closed FROM l
  UNION ALL SELECT s, 2, 0.5, false FROM c WHERE branch AND n > 1""", "length"))
def q87_merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit steps along chains of customers, every other one turned round; chains of six steps close by one more line."""
    s = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(s.alias("s"), (s % 7 + 1).alias("n"), (s % 5 == 0).alias("branch"))
    at = lambda x, y: G.point(F.col("s") * 10 + x, y)
    steps = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    step = F.array(at(F.lit(0), F.col("i")), at(F.lit(0), F.col("i") + 1))
    lines = steps.select(F.when(F.col("i") % 2 == 0, step).otherwise(F.reverse(step)).alias("line"))
    branches = rows.where("branch").select(F.array(at(F.lit(0.5), F.lit(1.0)), at(F.lit(0), F.lit(1.0))).alias("line"))
    closing = rows.where("n = 6 and not branch").select(F.array(at(F.lit(0), F.lit(0.0)), at(F.lit(0), F.lit(6.0))).alias("line"))
    merged = rings.merged_lines(lines.union(branches).union(closing))
    of = F.floor(F.array_min(F.col("line")["x"]) / 10).cast("long")
    return tidy(merged.select(of.alias("s"), F.size("line").alias("n_vertices"), G.length(F.col("line")).alias("length"), "closed"))


@query(rounded(VERTICES + """, n AS (SELECT vec_id, count(*) AS n, min(x) AS min_x, max(y) AS max_y FROM vertices GROUP BY 1)
--SELECT SELECT vec_id, CAST(9 + 16 * n AS BIGINT) AS wkb_bytes, n AS n_vertices, len AS length, min_x, max_y FROM total JOIN n USING (vec_id)""", "length", "min_x", "max_y"))
def q88_binary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as well-known binary, and what is read back from it."""
    binary = lines(spark, sf_dir).select("vec_id", located.to_wkb(F.lit("line"), F.array(F.array("line"))).alias("wkb"))
    back = binary.select("vec_id", F.octet_length("wkb").alias("wkb_bytes"), located.from_wkb(F.col("wkb")).alias("g"))
    line, bounds = F.col("g.parts")[0][0], located.box(F.col("g.parts"))
    return tidy(back.select("vec_id", "wkb_bytes", F.size(line).alias("n_vertices"), G.length(line).alias("length"), bounds["min_x"].alias("min_x"), bounds["max_y"].alias("max_y")))
