"""Queries of quality reports, contracts, samples and projections."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import scalars as S
from ..operators import bathymetry, catalogue, coast, filters, joins, optical, quality
from ..sources.tiles import tile_checks
from . import clarity_queries as clarity
from . import space_queries as space
from .metrics import metric_summary
from .registry import query
from .views import GRID, OBSERVATIONS, PERIODS, SAMPLES, SEASONAL, grid, lines, observations, rounded, samples, table, tidy


def _report_sql(ctes: str, *rows: tuple[str, str, str, str]) -> str:
    """A report from (check, value, low, high), each SQL."""
    union = " UNION ALL ".join(f"""SELECT '{name}' AS "check", CAST(({value}) AS DOUBLE) AS value, CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high""" for name, value, low, high in rows)
    passed = """(value IS NOT NULL OR (low IS NULL AND high IS NULL)) AND coalesce(value >= low, true) AND coalesce(value <= high, true)"""
    return rounded(f"""{ctes}, t AS ({union}) --SELECT SELECT "check", {passed} AS passed, value, low, high FROM t""", "value", "low", "high")


COAST = space.TRANSECTS + """, segs AS (SELECT 'p' || vec_id % 50 AS part, vec_id, len, status FROM oriented), parts AS (SELECT part, min(len) AS least, max(len) AS most, sum(len) AS whole FROM segs GROUP BY 1),
feats AS (SELECT abs(s_acctbal) / 10000 AS share, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal / 100 END AS slope FROM supplier)"""
_ON_LAND = "avg(CASE WHEN direction = '{d}' THEN ({n}(abs(end_x) <= 150 AND abs(end_y) <= 150))::INT END)"


@query(_report_sql(
    COAST, ("land_valid", "0", "NULL", "0"), ("coastline_valid", "0", "NULL", "0"), ("segment_ids_unique", "0", "NULL", "0"), ("segment_length_bounds", "SELECT count(*) FROM parts WHERE (least < 40 AND whole >= 40) OR most > 450", "NULL", "0"),
    ("segmented_length_conserved", "0", "NULL", "1"), ("segments_nonempty_positive", "SELECT count(*) FROM segs WHERE NOT len > 0", "NULL", "0"), ("orientation_ambiguous_share", "SELECT avg((status = 'ambiguous')::INT) FROM segs", "NULL", "0.02"),
    ("orientation_fallback_count", "SELECT count(*) FROM segs WHERE status = 'resolved_fallback'", "NULL", "NULL"), ("transects_valid", "0", "NULL", "0"), ("transect_origins_on_coast", "0", "NULL", "1e-6"),
    ("inland_endpoints_on_land", f"SELECT {_ON_LAND.format(d='inland', n='')} FROM transects", "0.8", "NULL"), ("offshore_endpoints_off_land", f"SELECT {_ON_LAND.format(d='offshore', n='NOT ')} FROM transects", "0.8", "NULL"),
    ("terrain_valid_sample_share", "SELECT avg(share) FROM feats", "0.7", "NULL"), ("slope_range", "SELECT 3 * count(*) FROM feats WHERE slope < -1e-6 OR slope > 90.000001", "NULL", "0"), ("relief_finite_or_missing", "0", "NULL", "0"),
))
def q67_coast_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-vertex lines as coast and as segments of it, suppliers as features."""
    two = space._oriented(spark, sf_dir)
    segments = two.withColumn("coastline_part_id", F.concat(F.lit("p"), F.col("vec_id") % 50)).withColumn("segment_length_m", G.length(F.col("line")))
    land = spark.range(1).select(F.array(F.array(*[G.point(x, y) for x, y in space.LAND])).alias("rings"))
    edges = spark.createDataFrame(G.ring_edges(space.LAND), "x1 double, y1 double, x2 double, y2 double")
    slope = F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal") / 100)
    features = table(spark, sf_dir, "supplier").select((F.abs("s_acctbal") / 10000).alias("terrain_valid_sample_share"), *[slope.alias(n) for n in ("slope_p50_deg", "slope_p90_deg", "slope_max_deg")], slope.alias("land_relief_25m_p50_m"))
    return tidy(quality.coast_checks(land, two, segments, coast.transects(two, 50.0, 100.0, 200.0), features, edges, 300.0, 40.0, 0.02, 0.3, cell=50.0))


@query(_report_sql(
    space.PROFILES + """, lens AS (SELECT vec_id, sqrt(pow((CAST(embedding[3] AS DOUBLE) - CAST(embedding[1] AS DOUBLE)) * 1000, 2) + pow((CAST(embedding[4] AS DOUBLE) - CAST(embedding[2] AS DOUBLE)) * 1000, 2)) AS len FROM embeddings),
    amb AS (SELECT CAST(s_suppkey AS VARCHAR) AS segment_id FROM supplier WHERE s_suppkey % 10 = 0), v AS (SELECT segment_id, count(*) FILTER (WHERE status <> 'no_valid_bathymetry') / count(*) AS share FROM g GROUP BY 1),
    reach AS (SELECT segment_id, greatest(""" + ", ".join(f"quantile_cont(c_{c}, 0.5)" for c in space.CONTOURS) + """) AS far FROM g GROUP BY 1)""",
    ("transect_ids_unique", "SELECT count(*) - count(DISTINCT vec_id // 3) FROM embeddings", "NULL", "0"), ("transect_lengths_match", "SELECT count(*) FROM lens WHERE NOT abs(len - 300) <= 0.013", "NULL", "0"),
    ("no_transects_for_ambiguous_orientation", "SELECT count(*) FROM embeddings WHERE CAST(label + 1 AS VARCHAR) IN (SELECT segment_id FROM amb)", "NULL", "0"),
    ("canonical_depth_nonnegative", "SELECT count(*) FROM samples WHERE z IS NOT NULL AND z / 1999.3 - 1 < 0", "NULL", "0"), ("nodata_not_converted_to_zero", "0", "NULL", "0"), ("shares_in_unit_interval", "0", "NULL", "0"), ("depth_percentiles_ordered", "0", "NULL", "0"),
    ("screening_classes_valid", "0", "NULL", "0"), ("contour_distances_within_transects", "SELECT count(*) FROM reach WHERE far > 300", "NULL", "0"), ("ambiguous_segments_have_no_morphology", "SELECT count(*) FROM amb WHERE segment_id IN (SELECT segment_id FROM g)", "NULL", "0"),
))
def q68_bathymetry_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as segments with line items as samples; two-vertex lines as transects, of which three share an id."""
    k = F.col("s_suppkey")
    segments = table(spark, sf_dir, "supplier").select(k.cast("string").alias("segment_id"), F.when(k % 10 == 0, "ambiguous").otherwise("resolved").alias("orientation_status"))
    of_label = (F.col("label") + 1).cast("string").alias("segment_id")
    transects = lines(spark, sf_dir, 2).select(F.floor(F.col("vec_id") / 3).alias("bathymetry_transect_id"), of_label, "line")
    rows = samples(spark, sf_dir).select((F.col("z") / 1999.3 - 1).alias("depth_m"), F.col("z").isNotNull().alias("sample_valid"))
    return tidy(quality.bathymetry_checks(segments, transects, rows, space._features(spark, sf_dir), space.DEPTHS, 300.0))


def _run_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """Suppliers as scenes, nations as zones, orders as observations, customers as seasonal and headline rows."""
    k, n, c = F.col("s_suppkey"), F.col("n_nationkey"), F.col("c_custkey")
    catalogue = table(spark, sf_dir, "supplier").select(
        (k % 3 > 0).alias("selected"), F.when(k % 3 > 0, "selected").otherwise("cloud_above_limit").alias("selection_reason"), (2000 + k % 4).alias("year"), (1 + k % 12).alias("month"),
        (F.abs("s_acctbal") / 100).alias("catalogue_cloud_cover_percent"), F.concat(F.lit("b"), k % 2).alias("processing_baseline"), F.when(k % 5 > 0, F.concat(F.lit("t"), k % 3)).alias("tile_id"),
    )
    zones = table(spark, sf_dir, "nation").select(F.concat(F.lit("seg_"), n).alias("segment_id"), F.when(n % 4 > 0, "valid").otherwise("ambiguous_orientation").alias("zone_status"))
    seen = observations(spark, sf_dir).withColumns({"invalid_reason": F.when(F.col("valid"), "valid").otherwise(F.concat(F.lit("reason_"), "month")), "valid_pixel_share": F.col("cloud_excluded_share"), "clarity_percentile": F.col("a")})
    seasonal = table(spark, sf_dir, "customer").select(*[(F.col("c_acctbal") / x).alias(name) for name, x in _SEASONAL.items()])
    clarity_ = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("seg_"), "c_nationkey").alias("segment_id"), F.when(c % 3 > 0, F.concat(F.lit("m"), c % 5)).alias("best_month"), F.col("c_mktsegment").alias("clarity_data_confidence"), F.col("c_mktsegment").alias("clarity_quality_flag"),
    )
    return catalogue, zones, seen, seasonal, clarity_


_SEASONAL = {"clarity_percentile_p50": 100, "clear_water_observation_share": 10000, "clarity_persistence": 9999, "clarity_variability_iqr": 7}
RUN = OBSERVATIONS + """, cat AS (SELECT s_suppkey % 3 > 0 AS selected, 2000 + s_suppkey % 4 AS year, 1 + s_suppkey % 12 AS month, abs(s_acctbal) / 100 AS cloud, 'b' || s_suppkey % 2 AS baseline, CASE WHEN s_suppkey % 5 > 0 THEN 't' || s_suppkey % 3 END AS tile FROM supplier),
seen AS (SELECT *, CASE WHEN valid THEN 'valid' ELSE 'reason_' || month END AS invalid_reason FROM obs), per_segment AS (SELECT count(DISTINCT scene_id) AS n FROM obs WHERE valid GROUP BY segment_id)"""


def _levels_sql(name: str, column: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, '{k}' AS key, CAST(quantile_cont({column}, {p}) AS DOUBLE) AS value FROM {source}" for k, p in (("minimum", 0.0), ("p10", 0.1), ("p50", 0.5), ("p90", 0.9), ("maximum", 1.0)))


def _by_sql(name: str, key: str, source: str) -> str:
    return f"SELECT '{name}' AS name, coalesce(CAST({key} AS VARCHAR), 'missing') AS key, CAST(count(*) AS DOUBLE) AS value FROM {source} GROUP BY 2"


_COUNTS = {
    "candidate_scenes": "count(*) FROM cat", "selected_scenes": "count(*) FROM cat WHERE selected", "rejected_scenes": "count(*) FROM cat WHERE NOT selected", "segment_zone_count": "count(*) FROM nation",
    "candidate_observations": "count(*) FROM obs", "valid_observations": "count(*) FROM obs WHERE valid", "invalid_observations": "count(*) FROM obs WHERE NOT valid", "bottom_texture_insufficient": "count(*) FROM customer",
}
SUMMARY = " UNION ALL ".join([
    *[f"SELECT '{n}' AS name, '' AS key, CAST({c.replace('count(*)', 'count(*) AS DOUBLE) AS value', 1)}" for n, c in _COUNTS.items()],
    _by_sql("rejection_reasons", "'cloud_above_limit'", "cat WHERE NOT selected"), _by_sql("selected_scene_counts_by_month_year", "year || '-' || month", "cat WHERE selected"), _levels_sql("selected_catalogue_cloud_cover_percent", "cloud", "cat WHERE selected"),
    _by_sql("processing_baselines", "baseline", "cat WHERE selected"), _by_sql("tiles", "tile", "cat WHERE selected"), _by_sql("zone_statuses", "CASE WHEN n_nationkey % 4 > 0 THEN 'valid' ELSE 'ambiguous_orientation' END", "nation"),
    _by_sql("invalid_reasons", "invalid_reason", "seen WHERE NOT valid"), "SELECT 'valid_scene_counts_by_month', CAST(month AS VARCHAR), CAST(count(DISTINCT scene_id) AS DOUBLE) FROM obs WHERE valid GROUP BY 2", _levels_sql("valid_scene_count_by_segment", "n", "per_segment"),
    _levels_sql("valid_pixel_share", "cloud_excluded_share", "obs"), _levels_sql("clarity_percentile", "a", "obs"), _levels_sql("mask_burden_cloud", "cloud_excluded_share", "obs"), _levels_sql("mask_burden_glint", "glint_excluded_share", "obs"),
    *[_levels_sql(name if name != "clarity_percentile_p50" else "seasonal_clarity_percentile_p50", f"c_acctbal / {x}", "customer") for name, x in _SEASONAL.items()],
    _by_sql("best_month_distribution", "CASE WHEN c_custkey % 3 > 0 THEN 'm' || c_custkey % 5 END", "customer"), _by_sql("confidence_classes", "c_mktsegment", "customer"), _by_sql("quality_classes", "c_mktsegment", "customer"),
])


@query(rounded(f"{RUN} --SELECT {SUMMARY}", "value"))
def q69_optical_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.optical_summary(*_run_tables(spark, sf_dir)))


@query(_report_sql(
    "WITH c AS (SELECT DISTINCT c_nationkey AS k FROM customer), n AS (SELECT n_nationkey AS k FROM nation)", ("selected_scenes", "SELECT count(*) FROM supplier WHERE s_suppkey % 3 > 0", "1", "NULL"), ("segment_zones", "SELECT count(*) FROM nation", "1", "NULL"),
    ("duplicate_clarity_segment_ids", "SELECT count(*) - count(DISTINCT c_nationkey) FROM customer", "NULL", "0"), ("clarity_segment_coverage_mismatch", "SELECT count(*) FROM c FULL JOIN n USING (k) WHERE c.k IS NULL OR n.k IS NULL", "NULL", "0"),
))
def q70_optical_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue, zones, _, _, clarity_ = _run_tables(spark, sf_dir)
    return tidy(quality.optical_checks(catalogue, zones, clarity_))


@query("SELECT n_nationkey, n_name, CAST(n_nationkey % 5 AS BIGINT) AS rest FROM nation")
def q71_same_keys_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return tidy(joins.same_keys(nations.select("n_nationkey", "n_name"), nations.select("n_nationkey", (F.col("n_nationkey") % 5).alias("rest")), ["n_nationkey"]))


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1")
def q72_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.first_by(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("""WITH r AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS k, count(*) OVER () AS n FROM customer), t AS (SELECT unnest(range(0, 7)) AS i)
SELECT DISTINCT c_custkey, c_name FROM r, t WHERE k = floor(i * (n - 1) / 6)""")
def q73_spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.spread_sample(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", 7)


@query(rounded("SELECT event_type, median(value) AS median, stddev_samp(value) AS std, count(value) AS count FROM events GROUP BY 1", "median", "std"))
def q74_median_std_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(quality.summarised(table(spark, sf_dir, "events"), ["event_type"], "value"))


@query("SELECT CASE WHEN CAST(o_orderdate AS DATE) > DATE '1996-06-30' THEN 'partial_current_year' ELSE 'historical_baseline' END AS analysis_period, count(*) AS count FROM orders GROUP BY 1")
def q75_analysis_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(filters.analysis_period(F.col("o_orderdate"), "1996-06-30").alias("analysis_period"))
    return rows.groupBy("analysis_period").agg(F.count(F.lit(1)).alias("count"))


@query("SELECT p_type AS class, count(*) AS count FROM part WHERE contains(upper(p_type), 'STEEL') OR contains(upper(p_type), 'TIN') GROUP BY 1")
def q76_class_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.class_review(table(spark, sf_dir, "part"), "p_type", ("STEEL", "TIN"))


@query(_report_sql(
    space.CROSS + ", j AS (SELECT count(*) AS n, max(len) AS len, count(*) - count(DISTINCT vec_id // 2) AS twice, count(*) FILTER (WHERE NOT (greatest(x1, x2) >= -100 AND least(x1, x2) <= 100 AND greatest(y1, y2) >= -50 AND least(y1, y2) <= 50)) AS off FROM n)",
    ("features", "SELECT n FROM j", "1", "NULL"), ("empty_geometries", "0", "NULL", "0"), ("invalid_coordinates", "0", "NULL", "0"), ("maximum_coordinate_jump", "SELECT len FROM j", "NULL", "200"), ("maximum_length", "SELECT len FROM j", "NULL", "100000"),
    ("outside_the_area", "SELECT off FROM j", "NULL", "0"), ("duplicate_ids", "SELECT twice FROM j", "NULL", "0"),
))
def q77_line_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir, 2).withColumn("half", F.floor(F.col("vec_id") / 2))
    return tidy(quality.line_contract(rows, "half", 200.0, 100000.0, (-100.0, -50.0, 100.0, 50.0)))


@query(rounded("SELECT s_suppkey, CASE WHEN s_suppkey % 11 <> 0 THEN s_acctbal * 0.0001 - 0.1 END AS reflectance FROM supplier", "reflectance"))
def q78_reflectance(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("s_suppkey") % 11 != 0, F.col("s_acctbal")).otherwise(-9999.0)
    return tidy(table(spark, sf_dir, "supplier").select("s_suppkey", S.reflectance(value, 0.0001, -0.1, -9999.0).alias("reflectance")))


@query(rounded(SEASONAL + """--SELECT SELECT segment_id, zone_type, period_id, clarity_percentile_p50, CASE WHEN valid_scene_count >= 8 THEN 'enough' ELSE 'few' END AS scenes FROM seasonal WHERE period_id IN ('june', 'july')""", "clarity_percentile_p50"))
def q79_two_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal features of two periods only, which are those of all periods."""
    rows = optical.seasonal_features(clarity.clarity(spark, sf_dir), {p: PERIODS[p] for p in ("june", "july")})
    return tidy(rows.select("segment_id", "zone_type", "period_id", "clarity_percentile_p50", F.when(F.col("valid_scene_count") >= 8, "enough").otherwise("few").alias("scenes")))


@query(rounded(SAMPLES + f"""--SELECT SELECT transect_id, CASE WHEN d IS NULL THEN 'no_valid_bathymetry' WHEN d <= 10 THEN 'exact_or_near_coast' WHEN d > 30 THEN 'large_coastal_gap' ELSE 'shifted_offshore' END AS bathymetry_origin_status, d AS first_valid_distance_m
FROM (SELECT transect_id, min(CASE WHEN z IS NOT NULL AND distance IN ({", ".join(str(d) for d in bathymetry.search_distances(20.0, 50.0))}) THEN distance END) AS d FROM samples GROUP BY 1)""", "first_valid_distance_m"))
def q80_depth_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first valid depth among the distances that are searched."""
    rows = samples(spark, sf_dir).withColumn("at", F.when(F.col("distance").isin(bathymetry.search_distances(20.0, 50.0)) & F.col("z").isNotNull(), F.col("distance")))
    first = rows.groupBy("transect_id").agg(F.min("at").alias("first_valid_distance_m"))
    return tidy(bathymetry.transect_status(first, 20.0, 30.0).select("transect_id", "bathymetry_origin_status", "first_valid_distance_m"))


TILES = """WITH tiles AS (SELECT 'Tile_' || s_suppkey AS path, CASE WHEN s_suppkey % 50 <> 0 THEN 'c' || s_nationkey % 2 END AS crs, 2 + s_suppkey % 3 * 1e-5 AS rx, 2.0 AS ry,
  CASE WHEN s_suppkey % 4 = 0 THEN ' M' ELSE 'm' END AS units, s_acctbal AS min_x, s_nationkey * 300 AS min_y FROM supplier),
near AS (SELECT * FROM tiles WHERE min_x <= 5000 AND min_x + 100 >= 0 AND min_y <= 5000 AND min_y + 100 >= 0)"""
_OFF = "SELECT greatest(max(rx) - first(rx ORDER BY lower(path), path), first(rx ORDER BY lower(path), path) - min(rx)) / (1e-6 + 1e-6 * first(rx ORDER BY lower(path), path)) FROM near"


@query(_report_sql(
    TILES, ("tiles_without_crs", "SELECT count(*) FROM tiles WHERE crs IS NULL", "NULL", "0"), ("tiles_without_resolution", "0", "NULL", "0"), ("tiles_in_box", "SELECT count(*) FROM near", "1", "NULL"),
    ("mixed_crs", "SELECT (count(DISTINCT crs) > 1)::INT FROM near", "NULL", "0"), ("resolution_difference", _OFF, "NULL", "1"), ("mixed_units", "0", "NULL", "0"),
))
def q81_tile_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as tiles."""
    k, x, y = F.col("s_suppkey"), F.col("s_acctbal"), F.col("s_nationkey") * 300
    tiles = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Tile_"), k).alias("path"), F.when(k % 50 != 0, F.concat(F.lit("c"), F.col("s_nationkey") % 2)).alias("crs"), (2 + k % 3 * F.lit(1e-5)).alias("resolution_x"), F.lit(2.0).alias("resolution_y"),
        F.when(k % 4 == 0, " M").otherwise("m").alias("units"), x.alias("min_x"), y.alias("min_y"), (x + 100).alias("max_x"), (y + 100).alias("max_y"),
    )
    return tidy(tile_checks(tiles, (0.0, 0.0, 5000.0, 5000.0)))


@query("""WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 9 > 0 THEN c_custkey % 7 > 0 END AS available, 1 + c_custkey % 12 AS month, CASE WHEN c_custkey % 10 > 0 THEN abs(c_acctbal) / 100 END AS cloud,
  c_nationkey % 5 / 4.0 AS coverage, c_custkey % 3 = 0 AS late FROM customer)
SELECT c_custkey, CASE WHEN available IS DISTINCT FROM true THEN 'missing_required_asset' WHEN month NOT BETWEEN 3 AND 11 THEN 'outside_configured_months' WHEN coalesce(cloud, 100) > 60 THEN 'catalogue_cloud_cover_above_limit'
  WHEN coverage <= 0 THEN 'no_aoi_overlap' WHEN late THEN 'partial_current_year_disabled' ELSE 'candidate' END AS selection_reason FROM s""")
def q82_scene_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as scenes, held against the five rules in their order."""
    k = F.col("c_custkey")
    period = F.when(k % 3 == 0, "partial_current_year").otherwise("historical_baseline")
    cloud = F.when(k % 10 > 0, F.abs("c_acctbal") / 100)
    rules = catalogue.candidate_reasons(F.when(k % 9 > 0, k % 7 > 0), 1 + k % 12, range(3, 12), cloud, 60.0, F.col("c_nationkey") % 5 / 4, period, partial_year=False)
    return table(spark, sf_dir, "customer").select("c_custkey", catalogue.first_reason(rules).alias("selection_reason"))


@query(rounded(GRID + """, size AS (SELECT ceil((max(row) + 1) / 1.5) AS n FROM grid), src AS (SELECT row, col, CASE WHEN value < 0 THEN -value * 10 END AS z, CASE WHEN label <> 3 THEN label END AS q FROM grid),
target AS (SELECT r AS row, c AS col, (c + 0.5) * 1.5 AS x, (r + 0.5 - n) * -1.5 AS y, n FROM size, range(0, CAST(n AS BIGINT)) a(r), range(0, 43) b(c)),
uv AS (SELECT *, x - 0.5 AS u, n * 1.5 - y - 0.5 AS v FROM target), k AS (SELECT uv.row, uv.col, CAST(floor(v) AS BIGINT) + a AS sr, CAST(floor(u) AS BIGINT) + b AS sc,
  (CASE a WHEN 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE b WHEN 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w FROM uv, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b)),
m AS (SELECT k.row, k.col, sum(w * z) / sum(CASE WHEN z IS NOT NULL THEN w END) AS z FROM k JOIN src ON sr = src.row AND sc = src.col GROUP BY ALL)
--SELECT SELECT t.row, t.col, x, y, CASE WHEN own.row IS NOT NULL THEN m.z END AS depth_mean_m, own.q AS quality_index FROM target t LEFT JOIN m USING (row, col)
LEFT JOIN src own ON own.row = CAST(floor(n * 1.5 - y) AS BIGINT) AND own.col = CAST(floor(x) AS BIGINT)""", "x", "y", "depth_mean_m"))
def q83_depth_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components as elevations, of which depths are the negative ones, and labels as quality, on a coarser grid; label 3 is no data."""
    source = grid(spark, sf_dir).withColumn("elevation", F.col("value") * 10)
    height = math.ceil((source.agg(F.max("row")).first()[0] + 1) / 1.5) * 1.5
    return tidy(bathymetry.prepared_depth(source, {"mean_depth": "elevation", "quality_index": "label"}, (0.0, 0.0, 64.0, height), 1.5, 0.0, height, 1.0, "negative_elevation", zero_is_valid=False, nodata=3))


_METRIC = "SELECT '{c}' AS category, '{f}' AS field, {u} AS unit, count(*) AS rows, count({v}) AS known, {lo} AS least, {hi} AS most FROM t"


@query(rounded("WITH t AS (SELECT CASE WHEN s_suppkey % 6 > 0 THEN s_acctbal / 100 END AS slope, s_acctbal AS depth, CASE WHEN s_suppkey % 4 > 0 THEN 'ok' END AS flag FROM supplier) --SELECT " + " UNION ALL ".join((
    _METRIC.format(c="terrain", f="slope_p50_deg", u="'°'", v="slope", lo="min(slope)", hi="max(slope)"), _METRIC.format(c="bathymetry", f="depth_100m_p50_m", u="'m'", v="depth", lo="min(depth)", hi="max(depth)"),
    _METRIC.format(c="quality", f="terrain_quality_flag", u="NULL", v="flag", lo="CAST(NULL AS DOUBLE)", hi="CAST(NULL AS DOUBLE)"),
)), "least", "most"))
def q84_metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as segments with three metrics and a field that is none."""
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        k, F.when(k % 6 > 0, F.col("s_acctbal") / 100).alias("slope_p50_deg"), F.col("s_acctbal").alias("depth_100m_p50_m"), F.when(k % 4 > 0, "ok").alias("terrain_quality_flag")
    )
    return tidy(metric_summary(rows))
