"""Queries of terrain, depth, grids and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..functions.stats import quantiles
from ..operators import bathymetry, coast, raster, terrain
from .registry import query
from .views import GRID, SAMPLES, VERTICES, grid, lines, rounded, samples, table, tidy

STEEP, SEARCH = 60.0, 8.0
RELIEF = (10, 25, 40)


def _terrain_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).select("segment_id", "transect_id", F.col("distance").alias("sample_distance_m"), F.col("z").alias("elevation_m"), F.col("slope").alias("slope_deg"), F.col("rough").alias("roughness"))
    return terrain.with_origins(rows, search=SEARCH)


TERRAIN = (
    SAMPLES
    + """, firsts AS (
  SELECT transect_id, min(CASE WHEN z IS NOT NULL AND distance <= 8 THEN distance END) AS od FROM samples GROUP BY 1
), origins AS (
  SELECT f.transect_id, od, z AS oz, CASE WHEN od IS NULL THEN 'unavailable' WHEN od = 0 THEN 'exact' ELSE 'shifted_inland' END AS method FROM firsts f LEFT JOIN samples s ON s.transect_id = f.transect_id AND s.distance = f.od
)"""
)


@query(rounded(TERRAIN + "--SELECT SELECT transect_id, od AS origin_distance, oz AS origin_value, method AS origin_method FROM origins", "origin_distance", "origin_value"))
def q21_first_valid_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(terrain.first_valid(samples(spark, sf_dir), ["transect_id"], "distance", "z", SEARCH))


_NEAR = ", ".join(f"first(z ORDER BY distance) FILTER (WHERE z IS NOT NULL AND abs(distance - {d}) <= 2.500001) AS z{d}" for d in RELIEF)
_RELIEF = ", ".join(f"quantile_cont(z{d} - oz, {p}) AS land_relief_{d}m_p{round(100 * p)}_m" for d in RELIEF for p in (0.5, 0.9))
_ELEVATION = ", ".join(f"quantile_cont(CASE WHEN abs(distance - {d}) <= 2.500001 THEN z END, 0.5) AS elevation_{d}m_p50_m" for d in RELIEF)
TERRAIN_DOUBLES = [f"land_relief_{d}m_p{p}_m" for d in RELIEF for p in (50, 90)] + [f"elevation_{d}m_p50_m" for d in RELIEF] + (
    "elevation_coast_p50_m terrain_origin_elevation_m terrain_origin_shift_m distance_to_first_steep_sample_p50_m distance_to_max_slope_p50_m steep_nearshore_transect_share slope_p50_deg slope_p90_deg "
    "slope_max_deg steep_sample_share roughness_p50 roughness_p90 terrain_valid_transect_share terrain_valid_sample_share"
).split()


@query(rounded(TERRAIN + f""", transects AS (
  SELECT segment_id, s.transect_id, any_value(oz) AS oz, any_value(od) AS od, any_value(method) AS method, count(z) AS valid, min(CASE WHEN z IS NOT NULL AND slope >= {STEEP} THEN distance END) AS steep,
    first(distance ORDER BY slope DESC, distance) FILTER (WHERE z IS NOT NULL AND slope IS NOT NULL) AS steepest, max(CASE WHEN z IS NOT NULL AND slope IS NOT NULL THEN (slope >= {STEEP} AND distance <= 25)::INT END) AS nearshore, {_NEAR}
  FROM samples s JOIN origins USING (transect_id) GROUP BY ALL
), seg AS (
  SELECT segment_id, quantile_cont(oz, 0.5) AS elevation_coast_p50_m, quantile_cont(od, 0.5) AS terrain_origin_shift_m, {_RELIEF}, quantile_cont(steep, 0.5) AS distance_to_first_steep_sample_p50_m, quantile_cont(steepest, 0.5) AS distance_to_max_slope_p50_m,
    avg(nearshore) AS steep_nearshore_transect_share, count(*) AS terrain_transect_count, count(*) FILTER (WHERE valid > 0) AS terrain_valid_transect_count, bool_and(method = 'unavailable') AS none, bool_and(method = 'exact') AS exact FROM transects GROUP BY 1
), smp AS (
  SELECT segment_id, {_ELEVATION}, quantile_cont(slope, 0.5) AS slope_p50_deg, quantile_cont(slope, 0.9) AS slope_p90_deg, max(slope) AS slope_max_deg, avg((slope >= {STEEP})::INT) AS steep_sample_share, quantile_cont(rough, 0.5) AS roughness_p50, quantile_cont(rough, 0.9) AS roughness_p90,
    count(*) AS terrain_sample_count, count(z) AS terrain_valid_sample_count FROM samples GROUP BY 1
), spine AS (SELECT CAST(s_suppkey AS VARCHAR) AS segment_id, CASE WHEN s_suppkey % 10 = 0 THEN 'ambiguous' ELSE 'resolved' END AS st FROM supplier UNION ALL SELECT 'none', 'resolved'),
j AS (
  SELECT segment_id, st, none, exact, seg.* EXCLUDE (segment_id, none, exact, terrain_transect_count, terrain_valid_transect_count), smp.* EXCLUDE (segment_id, terrain_sample_count, terrain_valid_sample_count), coalesce(terrain_transect_count, 0) AS terrain_transect_count, coalesce(terrain_valid_transect_count, 0) AS terrain_valid_transect_count,
    coalesce(terrain_sample_count, 0) AS terrain_sample_count, coalesce(terrain_valid_sample_count, 0) AS terrain_valid_sample_count FROM spine LEFT JOIN seg USING (segment_id) LEFT JOIN smp USING (segment_id)
), k AS (
  SELECT *, CASE WHEN terrain_transect_count = 0 THEN 0.0 ELSE terrain_valid_transect_count / terrain_transect_count END AS terrain_valid_transect_share, CASE WHEN terrain_sample_count = 0 THEN 0.0 ELSE terrain_valid_sample_count / terrain_sample_count END AS terrain_valid_sample_share FROM j
)
--SELECT SELECT * EXCLUDE (st, none, exact), elevation_coast_p50_m AS terrain_origin_elevation_m, CASE WHEN coalesce(none, true) THEN 'unavailable' WHEN exact THEN 'exact' ELSE 'shifted_inland' END AS terrain_origin_method,
  CASE WHEN coalesce(none, true) THEN 'no_valid_inland_origin' WHEN exact THEN 'good' ELSE 'shifted' END AS terrain_origin_quality_flag,
  CASE WHEN st = 'ambiguous' THEN 'orientation_unresolved' WHEN terrain_valid_sample_count = 0 THEN 'outside_dem' WHEN terrain_valid_sample_share >= 0.5 THEN 'good' WHEN terrain_valid_sample_share >= 0.25 THEN 'partial' ELSE 'insufficient' END AS terrain_quality_flag FROM k""", *TERRAIN_DOUBLES))
def q20_terrain_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("segment_id"), F.when(F.col("s_suppkey") % 10 == 0, "ambiguous").otherwise("resolved").alias("orientation_status"))
    spine = spine.union(spark.range(1).select(F.lit("none"), F.lit("resolved")))
    return tidy(terrain.terrain_features(spine, _terrain_samples(spark, sf_dir), RELIEF, 5.0, STEEP, 0.5))


SCALE = 20
DEPTHS = bathymetry.Depths(native=50.0, gap=100.0, minimum_share=0.5, platform_depth=20.0, source={"bathymetry_source_id": "line_items"})
TARGETS, CONTOURS = (100, 250, 500, 1000), (5, 10, 20)


def _depth_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with a depth, the flags of which go by distance."""
    d = F.col("distance")
    return samples(spark, sf_dir).select(
        "segment_id", "transect_id", (d * SCALE).alias("distance_m"), (F.col("z") / 1999.3).alias("depth_m"), F.when(d % 5 != 0, (d % 2).cast("int")).alias("interpolation_flag"),
        F.when(d % 7 != 0, (d % 3).cast("int")).alias("source_reference"), F.col("rough").alias("quality_index"), F.col("slope").alias("depth_std_m"), F.when(d % 3 != 0, d).alias("observation_count"),
    )


PROFILES = (
    SAMPLES
    + """, profiles AS (
  SELECT segment_id, transect_id, count(*) AS sample_count, min(CASE WHEN z IS NOT NULL THEN distance * 20 END) AS first_valid_distance_m, """
    + ", ".join(f"max(CASE WHEN distance * 20 = {d} THEN z / 1999.3 END) AS d_{d}" for d in TARGETS)
    + ", "
    + ", ".join(f"min(CASE WHEN z / 1999.3 >= {c} THEN distance * 20 END) AS c_{c}" for c in CONTOURS)
    + """ FROM samples GROUP BY ALL
), g AS (
  SELECT *, (d_500 - d_100) / 400 AS g1, (d_1000 - d_250) / 750 AS g2, CASE WHEN first_valid_distance_m IS NULL THEN 'no_valid_bathymetry' WHEN first_valid_distance_m <= 25 THEN 'exact_or_near_coast' WHEN first_valid_distance_m > 100 THEN 'large_coastal_gap' ELSE 'shifted_offshore' END AS status FROM profiles
)"""
)
_DEPTHS = ", ".join([f"quantile_cont(d_{d}, {p}) AS depth_{d}m_p{round(100 * p)}_m" for d in TARGETS for p in (0.1, 0.5, 0.9)] + [f"count(d_{d}) / count(*) AS depth_{d}m_valid_transect_share" for d in TARGETS])
_GRADIENTS = ", ".join(f"quantile_cont({g}, {p}) AS gradient_{n}m_p{round(100 * p)}" for g, n in (("g1", "100_500"), ("g2", "250_1000")) for p in (0.5, 0.9))
_TRENDS = "avg(CASE WHEN g1 IS NOT NULL THEN (g1 > 0.0025)::INT END) AS deepening_transect_share, avg(CASE WHEN g1 IS NOT NULL THEN (g1 < -0.0025)::INT END) AS shoaling_transect_share, avg(CASE WHEN g1 IS NOT NULL THEN (abs(g1) <= 0.0025)::INT END) AS flat_or_uncertain_transect_share"
DEPTH_COLUMNS = [f"depth_{d}m_{x}" for d in TARGETS for x in ("p10_m", "p50_m", "p90_m", "valid_transect_share")] + [f"gradient_{n}m_p{p}" for n in ("100_500", "250_1000") for p in (50, 90)] + ["deepening_transect_share", "shoaling_transect_share", "flat_or_uncertain_transect_share"]


def _features(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    spine = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("segment_id"))
    rows = _depth_samples(spark, sf_dir)
    return bathymetry.bathymetry_features(spine, bathymetry.depth_profile(rows, DEPTHS), DEPTHS, rows if whole else None)


@query(rounded(PROFILES + f"--SELECT SELECT segment_id, {_DEPTHS}, {_GRADIENTS}, {_TRENDS} FROM g GROUP BY segment_id", *DEPTH_COLUMNS))
def q22_depth_targets_gradients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_features(spark, sf_dir).where("bathymetry_transect_count > 0").select("segment_id", *DEPTH_COLUMNS))


CONTOUR_COLUMNS = [x for c in CONTOURS for x in (f"distance_to_{c}m_depth_p50_m", f"reaches_{c}m_depth_transect_share")]


@query(rounded(PROFILES + "--SELECT SELECT segment_id, " + ", ".join(f"quantile_cont(c_{c}, 0.5) AS distance_to_{c}m_depth_p50_m, count(c_{c}) / count(*) AS reaches_{c}m_depth_transect_share" for c in CONTOURS) + ", avg(coalesce(c_20 <= 250, false)::INT) AS rapid_deepening_to_20m_share FROM g GROUP BY 1", *CONTOUR_COLUMNS, "rapid_deepening_to_20m_share"))
def q23_contour_first_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_features(spark, sf_dir).where("bathymetry_transect_count > 0").select("segment_id", *CONTOUR_COLUMNS, "rapid_deepening_to_20m_share"))


@query(rounded(PROFILES + """, s AS (SELECT segment_id, count(*) AS n, count(*) FILTER (WHERE status <> 'no_valid_bathymetry') AS v, avg((status = 'large_coastal_gap')::INT) AS gap FROM g GROUP BY 1)
--SELECT SELECT CAST(s_suppkey AS VARCHAR) AS segment_id, coalesce(n, 0) AS bathymetry_transect_count, coalesce(v / n, 0.0) AS bathymetry_valid_transect_share, coalesce(gap, 0.0) AS bathymetry_large_coastal_gap_share, CASE WHEN coalesce(v / n, 0) >= 0.5 THEN 'regional_screening' ELSE 'insufficient' END AS bathymetry_screening_class,
  CASE WHEN coalesce(v / n, 0) < 0.5 THEN 'insufficient' WHEN v / n < 0.9 THEN 'partial' ELSE 'usable_with_resolution_limits' END AS bathymetry_quality_flag, 'well_resolved' AS depth_100m_resolution_class,
  '["native_resolution_m=50","valid_transect_share=' || printf('%.3f', coalesce(v / n, 0.0)) || '","regional_proxy_not_site_safety_evidence"' || CASE WHEN coalesce(v / n, 0) < 0.5 THEN ',"below_minimum_valid_transect_share"' ELSE '' END || ']' AS bathymetry_screening_reasons
  FROM supplier LEFT JOIN s ON segment_id = CAST(s_suppkey AS VARCHAR)""", "bathymetry_valid_transect_share", "bathymetry_large_coastal_gap_share"))
def q24_screening_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("bathymetry_transect_count", "bathymetry_valid_transect_share", "bathymetry_large_coastal_gap_share", "bathymetry_screening_class", "bathymetry_quality_flag", "depth_100m_resolution_class", "bathymetry_screening_reasons")
    return tidy(_features(spark, sf_dir).select("segment_id", *columns))


_QUALITY = (("quality_index", "rough"), ("depth_std", "slope"), ("observation_count", "CASE WHEN distance % 3 <> 0 THEN distance END"))
SAMPLE_COLUMNS = ["interpolated_cell_share", "measured_or_source_supported_cell_share", "depth_below_5m_at_250m_share", "depth_below_10m_at_500m_share", *[f"{n}_p{p}" for n, _ in _QUALITY for p in (10, 50, 90)]]


@query(rounded(PROFILES + """, v AS (SELECT segment_id, distance, rough, slope, CASE WHEN distance % 5 <> 0 THEN CAST(distance AS BIGINT) % 2 END AS flag, CASE WHEN distance % 7 <> 0 THEN CAST(distance AS BIGINT) % 3 END AS ref FROM samples WHERE z IS NOT NULL),
r AS (SELECT segment_id, ref, count(*) AS n FROM v WHERE ref IS NOT NULL GROUP BY ALL), d AS (SELECT segment_id, count(*) AS refs, first(ref ORDER BY n DESC, ref) AS top FROM r GROUP BY 1),
q AS (SELECT segment_id, avg((flag = 1)::INT) AS interpolated_cell_share, avg((flag = 0)::INT) AS measured_or_source_supported_cell_share, """ + ", ".join(f"quantile_cont({c}, {p / 100}) AS {n}_p{p}" for n, c in _QUALITY for p in (10, 50, 90)) + """ FROM v GROUP BY 1),
p AS (SELECT segment_id, avg((d_250 < 5)::INT) AS depth_below_5m_at_250m_share, avg((d_500 < 10)::INT) AS depth_below_10m_at_500m_share, coalesce(avg((d_500 < 20)::INT) >= 0.6, false) AND count(d_500) / count(*) >= 0.5 AS platform FROM g GROUP BY 1)
--SELECT SELECT CAST(s_suppkey AS VARCHAR) AS segment_id, 'line_items' AS bathymetry_source_id, interpolated_cell_share, measured_or_source_supported_cell_share, coalesce(refs, 0) AS bathymetry_source_reference_count, top AS bathymetry_dominant_source_reference, depth_below_5m_at_250m_share, depth_below_10m_at_500m_share,
  coalesce(platform, false) AS broad_shallow_platform_proxy, """ + ", ".join(f"{n}_p{p}" for n, _ in _QUALITY for p in (10, 50, 90)) + """ FROM supplier LEFT JOIN q ON q.segment_id = CAST(s_suppkey AS VARCHAR) LEFT JOIN d ON d.segment_id = CAST(s_suppkey AS VARCHAR) LEFT JOIN p ON p.segment_id = CAST(s_suppkey AS VARCHAR)""", *SAMPLE_COLUMNS))
def q66_depth_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What depths rest on: platform, shares of shallow transects and of interpolated cells, sources, and quantiles of the quality fields."""
    columns = ("segment_id", "bathymetry_source_id", "bathymetry_source_reference_count", "bathymetry_dominant_source_reference", "broad_shallow_platform_proxy")
    return tidy(_features(spark, sf_dir, whole=True).select(*columns, *SAMPLE_COLUMNS))


@query("""WITH r AS (SELECT l_suppkey, CASE WHEN l_linenumber <> 3 THEN 'ref_' || CAST(l_quantity AS BIGINT) % 5 END AS ref FROM lineitem), c AS (SELECT l_suppkey, ref, count(*) AS n FROM r WHERE ref IS NOT NULL GROUP BY ALL)
SELECT l_suppkey, count(*) AS bathymetry_source_reference_count, first(ref ORDER BY n DESC, ref) AS bathymetry_dominant_source_reference FROM c GROUP BY 1""")
def q25_dominant_reference_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.when(F.col("l_linenumber") != 3, F.concat(F.lit("ref_"), F.col("l_quantity").cast("long") % 5)).alias("ref"))
    return bathymetry.dominant_reference(rows, ["l_suppkey"], "ref")


@query("""SELECT CASE WHEN l_linenumber <> 3 THEN 'ref_' || CAST(l_quantity AS BIGINT) % 5 END AS ref, l_linestatus AS kind, count(*) AS sample_count, count(*) FILTER (WHERE l_returnflag <> 'N') AS valid_sample_count FROM lineitem WHERE l_linenumber <> 3 GROUP BY ALL""")
def q26_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_linenumber") != 3, F.concat(F.lit("ref_"), F.col("l_quantity").cast("long") % 5)).alias("ref"), F.col("l_linestatus").alias("kind"), (F.col("l_returnflag") != "N").alias("ok"))
    return bathymetry.source_audit(rows, "ref", "kind", "ok")


@query(rounded(GRID + """, n AS (SELECT row, col, value AS c, lag(value) OVER r AS w, lead(value) OVER r AS e, lag(value) OVER k AS u, lead(value) OVER k AS d, lag(1) OVER r AS hw, lead(1) OVER r AS he, lag(1) OVER k AS hu, lead(1) OVER k AS hd FROM grid WINDOW r AS (PARTITION BY row ORDER BY col), k AS (PARTITION BY col ORDER BY row)),
g AS (SELECT row, col, c, CASE WHEN hw = 1 AND he = 1 THEN (e - w) / 2 WHEN he = 1 THEN e - c ELSE c - w END / 0.5 AS gx, CASE WHEN hu = 1 AND hd = 1 THEN (d - u) / 2 WHEN hd = 1 THEN d - c ELSE c - u END / 0.5 AS gy FROM n)
--SELECT SELECT row, col, CASE WHEN c IS NOT NULL THEN degrees(atan(sqrt(gx * gx + gy * gy))) END AS slope_deg FROM g""", "slope_deg"))
def q34_raster_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(raster.slope(grid(spark, sf_dir).drop("label"), resolution=0.5))


@query(rounded(GRID + """, a AS (SELECT row, col, value, count(value) OVER w AS n, sum(value) OVER w AS s, sum(value * value) OVER w AS q FROM grid WINDOW w AS (PARTITION BY row ORDER BY col RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
b AS (SELECT row, col, value, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q FROM a WINDOW w AS (PARTITION BY col ORDER BY row RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING))
--SELECT SELECT row, col, CASE WHEN value IS NOT NULL THEN sqrt(greatest(0, q / n - (s / n) * (s / n))) END AS roughness FROM b""", "roughness"))
def q35_raster_roughness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(raster.roughness(grid(spark, sf_dir).drop("label"), radius=2))


@query(rounded(GRID + """, tiles AS (SELECT row % 100 AS row, col, value, 'tile_' || row // 100 AS path FROM grid)
--SELECT SELECT row, col, first(value ORDER BY path) FILTER (WHERE value IS NOT NULL) AS value, first(path ORDER BY path) FILTER (WHERE value IS NOT NULL) AS path FROM tiles GROUP BY row, col""", "value"))
def q36_mosaic_first_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = grid(spark, sf_dir).select((F.col("row") % 100).alias("row"), "col", "value", F.concat(F.lit("tile_"), F.floor(F.col("row") / 100)).alias("path"))
    return tidy(raster.mosaic(tiles))


POINTS = """, points AS (SELECT o_orderkey, o_totalprice / 5000 AS x, 80 - o_totalprice / 700 % 90 AS y FROM orders)"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", (price / 5000).alias("x"), (80 - price / 700 % 90).alias("y"))


@query(rounded(GRID + POINTS + "--SELECT SELECT o_orderkey, value AS sample FROM points LEFT JOIN grid ON row = CAST(floor((80 - y) / 0.5) AS BIGINT) AND col = CAST(floor((x - 2) / 0.5) AS BIGINT)", "sample"))
def q37_nearest_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(raster.nearest(_points(spark, sf_dir), grid(spark, sf_dir), 2.0, 80.0, 0.5).select("o_orderkey", "sample"))


@query(rounded(GRID + POINTS + """, uv AS (SELECT o_orderkey, (x - 2) / 0.5 - 0.5 AS u, (80 - y) / 0.5 - 0.5 AS v FROM points), k AS (SELECT o_orderkey, CAST(floor(v) AS BIGINT) + a AS row, CAST(floor(u) AS BIGINT) + b AS col, (CASE a WHEN 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE b WHEN 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w FROM uv, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b))
--SELECT SELECT o_orderkey, CASE WHEN count(value) = 4 THEN sum(w * value) END AS sample FROM k LEFT JOIN grid USING (row, col) GROUP BY 1""", "sample"))
def q38_bilinear_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(raster.bilinear(_points(spark, sf_dir), grid(spark, sf_dir), "o_orderkey", 2.0, 80.0, 0.5).select("o_orderkey", "sample"))


@query(rounded("""WITH l AS (SELECT s_suppkey, abs(s_acctbal) AS len FROM supplier), n AS (SELECT *, floor(len / 250) AS whole, len - floor(len / 250) * 250 AS rest FROM l),
m AS (SELECT *, CAST(CASE WHEN len <= 250 THEN 1 WHEN rest <= 1e-8 OR rest < 75 THEN whole ELSE whole + 1 END AS BIGINT) AS k, CASE WHEN len > 250 AND rest > 1e-8 AND rest < 75 THEN len / whole ELSE 250 END AS step FROM n)
--SELECT SELECT s_suppkey, i AS number, CASE WHEN i = k THEN len ELSE i * step END AS break_m FROM m, unnest(range(0, k + 1)) AS t(i)""", "break_m"))
def q41_segment_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.posexplode(coast.segment_breaks(F.abs("s_acctbal"), 250.0, 75.0)).alias("number", "break_m"))
    return tidy(rows)


_AT = "(SELECT {c}.vec_id, {c}.x + {c}.dx * (q.d - {c}.at) / {c}.step AS px, {c}.y + {c}.dy * (q.d - {c}.at) / {c}.step AS py, q.n FROM cum {c} JOIN q ON q.vec_id = {c}.vec_id AND {c}.dx IS NOT NULL AND q.d > {c}.at AND q.d <= {c}.at + {c}.step)"


@query(rounded(VERTICES + """, q AS (SELECT vec_id, len / 2 - 5 AS d, 'a' AS n FROM total UNION ALL SELECT vec_id, len / 2 + 5, 'b' FROM total UNION ALL SELECT vec_id, len / 2, 'm' FROM total),
p AS """ + _AT.format(c="c") + """, w AS (SELECT vec_id, max(px) FILTER (WHERE n = 'm') AS mx, max(py) FILTER (WHERE n = 'm') AS my, degrees(atan2(max(px) FILTER (WHERE n = 'b') - max(px) FILTER (WHERE n = 'a'), max(py) FILTER (WHERE n = 'b') - max(py) FILTER (WHERE n = 'a'))) AS b FROM p GROUP BY 1),
j AS (SELECT vec_id, max(step) AS jump FROM cum GROUP BY 1)
--SELECT SELECT vec_id, len AS length, mx AS middle_x, my AS middle_y, CASE WHEN b < 0 THEN b + 360 ELSE b END AS bearing_deg, jump AS largest_step FROM total JOIN w USING (vec_id) JOIN j USING (vec_id)""", "length", "middle_x", "middle_y", "bearing_deg", "largest_step"))
def q42_line_length_bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).withColumn("length", G.length(F.col("line"))).withColumn("m", G.interpolate(F.col("line"), F.col("length") / 2))
    return tidy(rows.select("vec_id", "length", F.col("m.x").alias("middle_x"), F.col("m.y").alias("middle_y"), G.local_bearing(F.col("line"), F.col("length") / 2).alias("bearing_deg"), F.array_max(G.steps(F.col("line"))).alias("largest_step")))


CROSS = """
WITH line AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 1000 AS x1, CAST(embedding[2] AS DOUBLE) * 1000 AS y1, CAST(embedding[3] AS DOUBLE) * 1000 AS x2, CAST(embedding[4] AS DOUBLE) * 1000 AS y2, CAST(label AS BIGINT) AS label FROM embeddings),
m AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my FROM line), n AS (SELECT *, (x2 - x1) / len AS ux, (y2 - y1) / len AS uy, (degrees(atan2(x2 - x1, y2 - y1)) + 360) % 360 AS b FROM m)"""
LAND = [(-150.0, -150.0), (150.0, -150.0), (150.0, 150.0), (-150.0, 150.0)]


def _two_vertex_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, 2).select(F.col("vec_id").cast("string").alias("segment_id"), "vec_id", "line")
    b = G.bearing(F.get("line", F.lit(0)), F.get("line", F.lit(1)))
    return rows.withColumn("left_normal_deg", F.pmod(b - 90, F.lit(360.0))).withColumn("right_normal_deg", F.pmod(b + 90, F.lit(360.0)))


def _oriented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coast.oriented(_two_vertex_segments(spark, sf_dir), G.ring_edges(LAND), (20.0, 60.0), (0.0,))


ORIENTED = CROSS + """, tries AS (
  SELECT vec_id, b, i, d, abs(mx - uy * d) <= 150 AND abs(my + ux * d) <= 150 AS l, abs(mx + uy * d) <= 150 AND abs(my - ux * d) <= 150 AS r FROM n, (VALUES (0, 20.0), (1, 60.0)) t(i, d)
), chosen AS (SELECT vec_id, min(i) FILTER (WHERE l <> r) AS i FROM tries GROUP BY 1),
oriented AS (SELECT n.*, c.i, t.l, CASE WHEN c.i IS NULL THEN 'ambiguous' WHEN c.i = 0 THEN 'resolved' ELSE 'resolved_fallback' END AS status FROM n JOIN chosen c USING (vec_id) LEFT JOIN tries t ON t.vec_id = n.vec_id AND t.i = c.i)"""


@query(rounded(ORIENTED + "--SELECT SELECT vec_id, status AS orientation_status, CASE WHEN l THEN (b + 270) % 360 WHEN NOT l THEN (b + 90) % 360 END AS landward_bearing_deg FROM oriented", "landward_bearing_deg"))
def q44_orientation_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(_oriented(spark, sf_dir).select("vec_id", "orientation_status", "landward_bearing_deg"))


TRANSECTS = ORIENTED + """, origins AS (SELECT vec_id, b, l, len, x1, y1, ux, uy, step AS k, step * 50 AS d FROM oriented, unnest(range(0, 100)) AS t(step) WHERE l IS NOT NULL AND step * 50 <= len + 1e-7
  UNION ALL SELECT vec_id, b, l, len, x1, y1, ux, uy, CAST(floor((len + 1e-7) / 50) AS BIGINT) + 1, len FROM oriented WHERE l IS NOT NULL AND len - floor((len + 1e-7) / 50) * 50 > 1e-6),
dirs AS (SELECT *, CASE WHEN l = (direction = 'inland') THEN -1 ELSE 1 END AS side, CASE direction WHEN 'inland' THEN 100.0 ELSE 200.0 END AS length_m FROM origins, (VALUES ('inland'), ('offshore')) t(direction)),
transects AS (SELECT vec_id || printf('_t%03d_', k + 1) || direction AS transect_id, direction, d AS origin_distance_m, (b + 360 + side * 90) % 360 AS bearing_deg, x1 + ux * d + side * uy * length_m AS end_x, y1 + uy * d - side * ux * length_m AS end_y FROM dirs)"""


@query(rounded(TRANSECTS + "--SELECT SELECT * EXCLUDE (direction) FROM transects", "origin_distance_m", "bearing_deg", "end_x", "end_y"))
def q43_transect_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = coast.transects(_oriented(spark, sf_dir), 50.0, 100.0, 200.0)
    end = F.get("line", F.lit(1))
    return tidy(rows.select("transect_id", "origin_distance_m", "bearing_deg", end["x"].alias("end_x"), end["y"].alias("end_y")))


@query(ORIENTED + """, strips AS (SELECT vec_id, zone, x1 AS ox, y1 AS oy, a, b2, CASE WHEN l THEN uy ELSE -uy END AS sx, CASE WHEN l THEN -ux ELSE ux END AS sy FROM oriented, (VALUES ('nearshore', 20, 100), ('coastal', 100, 300)) t(zone, a, b2) WHERE l IS NOT NULL),
pts AS (SELECT vec_id AS point_id, x2 AS px, y2 AS py FROM n)
SELECT DISTINCT point_id, vec_id || '_' || zone AS zone_id FROM pts, strips WHERE (px - ox) * sx + (py - oy) * sy BETWEEN a AND b2 AND abs((px - ox) * sy - (py - oy) * sx) <= 50""")
def q45_zone_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _oriented(spark, sf_dir).where("seaward_bearing_deg is not null")
    seaward = rows.select("segment_id", F.array(F.get("line", F.lit(0))).alias("line"), F.col("seaward_bearing_deg").alias("bearing_deg"))
    strips = coast.zone_strips(seaward, (("nearshore", 20, 100), ("coastal", 100, 300)), 100.0)
    points = lines(spark, sf_dir, 2).select(F.col("vec_id").alias("point_id"), F.get("line", F.lit(1)).alias("p"))
    return coast.zone_membership(points, "point_id", strips, cell=60.0).select("point_id", "zone_id")


@query(rounded(CROSS + "--SELECT SELECT a.vec_id AS start_id, b.vec_id AS end_id, sqrt((a.x1 - b.x2) * (a.x1 - b.x2) + (a.y1 - b.y2) * (a.y1 - b.y2)) AS distance FROM line a, line b WHERE sqrt((a.x1 - b.x2) * (a.x1 - b.x2) + (a.y1 - b.y2) * (a.y1 - b.y2)) <= 10", "distance"))
def q46_distance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, 2)
    starts, ends = rows.select(F.col("vec_id").alias("start_id"), F.get("line", F.lit(0)).alias("p")), rows.select(F.col("vec_id").alias("end_id"), F.get("line", F.lit(1)).alias("p"))
    return tidy(coast.within_distance(starts, ends, "start_id", "end_id", 10.0))


@query(rounded(VERTICES + """, e AS (SELECT min(x) AS min_x, min(y) AS min_y, max(x) AS max_x, max(y) AS max_y FROM vertices)
--SELECT SELECT *, least(16.0, greatest(1.0, least(log2(1200 * 0.72 * 360 / 256 / greatest((max_x - min_x) / 100, 1e-6)), log2(650 * 0.72 * 170 / 256 / greatest((max_y - min_y) / 100, 1e-6))))) AS zoom FROM e""", "min_x", "min_y", "max_x", "max_y", "zoom"))
def q47_extent_fit_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = coast.extent(lines(spark, sf_dir), "line")
    return tidy(bounds.withColumn("zoom", S.fitting_zoom((F.col("max_x") - F.col("min_x")) / 100, (F.col("max_y") - F.col("min_y")) / 100)))


@query(rounded(CROSS + f""", edges AS (SELECT * FROM (VALUES {", ".join(str(e) for e in [*G.ring_edges(LAND), *G.ring_edges([(-40.0, -40.0), (40.0, -40.0), (40.0, 40.0), (-40.0, 40.0)])])}) t(ea, eb, ec, ed)),
t AS (SELECT vec_id, x1, y1, ((eb > y1) <> (ed > y1)) AND x1 < (ec - ea) * (y1 - eb) / nullif(ed - eb, 0) + ea AS hit FROM line, edges)
--SELECT SELECT vec_id, count(*) FILTER (WHERE hit) % 2 = 1 AS covered, sum(0) AS zero FROM t GROUP BY vec_id""", "zero"))
def q57_polygon_with_hole(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = G.ring_edges(LAND) + G.ring_edges([(-40.0, -40.0), (40.0, -40.0), (40.0, 40.0), (-40.0, 40.0)])
    edges = spark.createDataFrame(rings, "x1 double, y1 double, x2 double, y2 double")
    points = lines(spark, sf_dir, 2).select("vec_id", F.get("line", F.lit(0)).alias("p"))
    return coast.covered_points(points, "vec_id", edges, cell=50.0).withColumn("zero", F.lit(0.0))


@query(rounded(VERTICES + """, v AS (SELECT vec_id, k, x / 10 AS lon, y / 10 AS lat, lead(x / 10) OVER w AS lon2, lead(y / 10) OVER w AS lat2 FROM vertices WINDOW w AS (PARTITION BY vec_id ORDER BY k)),
a AS (SELECT vec_id, pow(sin(radians(lat2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon) / 2), 2) AS h FROM v WHERE lon2 IS NOT NULL)
--SELECT SELECT vec_id, max(2 * 6371.0088 * asin(sqrt(least(1.0, h)))) AS largest_step_km FROM a GROUP BY 1""", "largest_step_km"))
def q58_great_circle_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir).select("vec_id", F.transform("line", lambda p: F.struct((p["x"] / 10).alias("x"), (p["y"] / 10).alias("y"))).alias("line"))
    n = F.size("line")
    far = F.zip_with(F.slice("line", F.lit(1), n - 1), F.slice("line", F.lit(2), n - 1), lambda a, b: S.great_circle_km(a["x"], a["y"], b["x"], b["y"]))
    return tidy(rows.select("vec_id", F.array_max(far).alias("largest_step_km")))


@query(PROFILES + """, s AS (SELECT segment_id, median(g1) AS gradient, count(*) FILTER (WHERE status <> 'no_valid_bathymetry') / count(*) AS valid, median(d_100) AS relief FROM g GROUP BY 1)
SELECT segment_id, CASE WHEN relief IS NULL THEN 'Terrain is not available.' WHEN relief >= 20 THEN 'High land relief near the coast.' ELSE 'Low land relief near the coast.' END || ' ' ||
CASE WHEN NOT coalesce(valid > 0, false) THEN 'Depth is not available.' WHEN gradient IS NULL THEN 'Depth is known, its gradient is not.' WHEN gradient > 0.01 THEN 'The sea floor deepens fast.' WHEN gradient < -0.0025 THEN 'The sea floor shoals seawards.' ELSE 'The sea floor deepens gently.' END AS interpretation FROM s""")
def q59_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir).where("bathymetry_transect_count > 0")
    return rows.select("segment_id", S.interpretation(F.col("depth_100m_p50_m"), F.col("gradient_100_500m_p50"), F.col("bathymetry_valid_transect_share")).alias("interpretation"))


@query(rounded(GRID + """, fine AS (SELECT row, col, value, row // 2 AS prow, col // 2 AS pcol FROM grid), coarse AS (SELECT row AS prow, col AS pcol, value AS parent_value FROM grid)
--SELECT SELECT f.row, f.col, f.value, c.parent_value FROM fine f LEFT JOIN coarse c ON c.prow = f.prow AND c.pcol = f.pcol""", "value", "parent_value"))
def q60_parent_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = raster.parent_cells(grid(spark, sf_dir).drop("label"))
    coarse = grid(spark, sf_dir).select(F.col("row").alias("parent_row"), F.col("col").alias("parent_col"), F.col("value").alias("parent_value"))
    return tidy(fine.join(coarse, ["parent_row", "parent_col"], "left").select("row", "col", "value", "parent_value"))


@query(GRID + """, q AS (SELECT quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi FROM grid)
SELECT row, col, CASE WHEN value IS NOT NULL THEN CAST(round_even(least(1.0, greatest(0.0, (value - lo) / (hi - lo))) * 255, 0) AS BIGINT) END AS shade FROM grid, q""")
def q61_display_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = grid(spark, sf_dir)
    bounds = quantiles(cells, [], {"v": F.col("value")}, [("lo", "v", 0.02), ("hi", "v", 0.98)])
    return tidy(cells.crossJoin(F.broadcast(bounds)).select("row", "col", S.stretched(F.col("value"), F.col("lo"), F.col("hi")).alias("shade")))
