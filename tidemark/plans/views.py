"""The driver's tables in the shapes that the operators take, as DataFrames and as SQL.

Values are made missing by rule, as the tables themselves hold none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as longs, and doubles rounded to six decimals without a negative zero."""
    fixed = {c: F.col(c).cast("long") for c, kind in df.dtypes if kind in ("int", "smallint", "tinyint")}
    return df.withColumns(fixed | {c: F.round(c, 6) + F.lit(0.0) for c, kind in df.dtypes if kind in ("double", "float")})


def rounded(sql: str, *columns: str, types: str = "") -> str:
    """SQL whose named columns are rounded to six decimals."""
    changed = ", ".join(f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in columns)
    head, _, tail = sql.partition("--SELECT")
    return f"{head} SELECT * REPLACE ({changed}) FROM ({tail})" if tail else f"SELECT * REPLACE ({changed}) FROM ({sql})"


PERIODS = {"extended": (5, 6, 7, 8, 9), "summer_jja": (6, 7, 8), "may": (5,), "june": (6,), "july": (7,), "august": (8,), "september": (9,)}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations of a segment (nation) and zone (priority) in a scene (quarter), of two components."""
    key, when = F.col("o_orderkey"), F.col("o_orderdate")
    return (
        table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey", F.concat(F.lit("seg_"), F.col("c_nationkey")).alias("segment_id"), F.col("o_orderpriority").alias("zone_type"),
            F.concat(F.year(when), F.lit("Q"), F.quarter(when)).alias("scene_id"), F.year(when).cast("long").alias("year"), F.month(when).cast("long").alias("month"),
            F.when(key % 11 != 0, F.col("o_totalprice")).alias("a"), F.when(key % 13 != 0, F.col("c_acctbal")).alias("b"), (F.col("o_orderstatus") != "P").alias("valid"),
            F.when(key % 5 != 0, (key % 5) / F.lit(9.7)).alias("glint_excluded_share"), ((key % 7) / F.lit(9.7)).alias("cloud_excluded_share"),
        )
    )


OBSERVATIONS = """
WITH obs AS (
  SELECT o_orderkey, 'seg_' || c_nationkey AS segment_id, o_orderpriority AS zone_type, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS scene_id,
    CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS a, CASE WHEN o_orderkey % 13 <> 0 THEN c_acctbal END AS b, o_orderstatus <> 'P' AS valid,
    CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 5) / CAST(9.7 AS DOUBLE) END AS glint_excluded_share, (o_orderkey % 7) / CAST(9.7 AS DOUBLE) AS cloud_excluded_share
  FROM orders JOIN customer ON o_custkey = c_custkey
), counted AS (
  SELECT *, count(a) OVER w AS na, count(b) OVER w AS nb, min(a) OVER w AS amin, max(a) OVER w AS amax, min(b) OVER w AS bmin, max(b) OVER w AS bmax,
    rank() OVER (PARTITION BY scene_id, zone_type ORDER BY a ASC NULLS LAST) AS ra, count(*) OVER (PARTITION BY scene_id, zone_type, a) AS ta,
    rank() OVER (PARTITION BY scene_id, zone_type ORDER BY b DESC NULLS LAST) AS rb, count(*) OVER (PARTITION BY scene_id, zone_type, b) AS tb
  FROM obs WINDOW w AS (PARTITION BY scene_id, zone_type)
), ranked AS (
  SELECT *, CASE WHEN a IS NULL OR na < 5 THEN NULL WHEN amin = amax THEN 50.0 ELSE (ra + (ta - 1) / 2.0) / na * 100 END AS a_percentile,
    CASE WHEN b IS NULL OR nb < 5 THEN NULL WHEN bmin = bmax THEN 50.0 ELSE (rb + (tb - 1) / 2.0) / nb * 100 END AS b_percentile
  FROM counted
), clarity AS (
  SELECT *, CAST((a_percentile IS NOT NULL)::INT + (b_percentile IS NOT NULL)::INT AS BIGINT) AS n_components,
    CASE WHEN a_percentile IS NULL THEN b_percentile WHEN b_percentile IS NULL THEN a_percentile ELSE (a_percentile + b_percentile) / 2 END AS clarity_percentile
  FROM ranked
)"""

SEASONAL = (
    OBSERVATIONS
    + """, periods(period_id, pm) AS (VALUES """
    + ", ".join(f"('{p}', {m})" for p, months in PERIODS.items() for m in months)
    + """), rows_ AS (
  SELECT *, least(1.0, coalesce(glint_excluded_share, 0) + coalesce(cloud_excluded_share, 0)) AS burden, valid AND clarity_percentile IS NOT NULL AS ok,
    CASE WHEN valid THEN clarity_percentile END AS v FROM clarity JOIN periods ON month = pm
), main AS (
  SELECT segment_id, zone_type, period_id, count(*) AS candidate_observation_count, count(DISTINCT CASE WHEN ok THEN scene_id END) AS valid_scene_count,
    count(DISTINCT CASE WHEN ok THEN year END) AS valid_year_count, count(DISTINCT CASE WHEN ok THEN month END) AS valid_month_count,
    avg(ok::INT) AS valid_observation_share, quantile_cont(v, 0.1) AS clarity_percentile_p10, quantile_cont(v, 0.5) AS clarity_percentile_p50, quantile_cont(v, 0.9) AS clarity_percentile_p90,
    quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS clarity_variability_iqr, mad(v) AS clarity_variability_mad,
    avg(CASE WHEN ok THEN (v >= 75)::INT END) AS clear_water_observation_share, avg(CASE WHEN ok THEN (v <= 25)::INT END) AS turbid_water_observation_share,
    avg(burden) AS mean_mask_burden, avg(glint_excluded_share) AS glint_excluded_share, avg(cloud_excluded_share) AS cloud_excluded_share,
    quantile_cont(glint_excluded_share, 0.5) AS glint_exclusion_p50, quantile_cont(cloud_excluded_share, 0.5) AS cloud_exclusion_p50
  FROM rows_ GROUP BY ALL
), monthly AS (
  SELECT segment_id, zone_type, period_id, year, month, quantile_cont(v, 0.5) AS med FROM rows_ WHERE ok GROUP BY ALL
), persistence AS (
  SELECT segment_id, zone_type, period_id, avg((med >= 75)::INT) AS clarity_persistence FROM monthly GROUP BY ALL
), judged AS (
  SELECT main.*, clarity_persistence, list_filter([CASE WHEN valid_scene_count < 12 THEN 'too_few_valid_scenes' END, CASE WHEN valid_month_count < 3 THEN 'too_few_valid_months' END,
    CASE WHEN valid_year_count < 2 THEN 'single_year_only' END, CASE WHEN valid_observation_share < 0.25 THEN 'low_valid_observation_share' END,
    CASE WHEN round(mean_mask_burden, 9) > 0.6 THEN 'high_mask_burden' END], lambda x: x IS NOT NULL) AS reasons
  FROM main LEFT JOIN persistence USING (segment_id, zone_type, period_id)
), seasonal AS (
  SELECT * EXCLUDE (reasons), CASE WHEN valid_scene_count = 0 THEN 'insufficient' WHEN len(reasons) >= 2 THEN 'low' WHEN len(reasons) = 1 THEN 'medium'
      WHEN valid_scene_count >= 24 AND valid_year_count >= 4 AND valid_observation_share >= 0.6 THEN 'high' ELSE 'medium' END AS clarity_data_confidence,
    CASE WHEN valid_scene_count = 0 THEN 'insufficient' WHEN len(reasons) >= 1 THEN 'limited' ELSE 'usable' END AS clarity_quality_flag, array_to_string(reasons, ';') AS clarity_limitation_reasons
  FROM judged
)"""
)
SEASONAL_DOUBLES = (
    "valid_observation_share clarity_percentile_p10 clarity_percentile_p50 clarity_percentile_p90 clarity_variability_iqr clarity_variability_mad clear_water_observation_share "
    "turbid_water_observation_share mean_mask_burden glint_excluded_share cloud_excluded_share glint_exclusion_p50 cloud_exclusion_p50 clarity_persistence"
).split()


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples along transects, one per transect and distance; no data under return flag N."""
    known = F.col("l_returnflag") != "N"
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("segment_id"), F.concat_ws("_", F.col("l_suppkey"), F.col("l_linenumber")).alias("transect_id"), F.col("l_quantity").alias("distance"),
        F.when(known, F.col("l_extendedprice")).alias("z"), F.when(known, F.col("l_discount") * 900).alias("slope"), F.col("l_tax").alias("rough"), F.col("l_shipdate"),
    )
    return rows.groupBy("segment_id", "transect_id", "distance").agg(F.min("z").alias("z"), F.min("slope").alias("slope"), F.min("rough").alias("rough"))


SAMPLES = """
WITH samples AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS segment_id, l_suppkey || '_' || l_linenumber AS transect_id, l_quantity AS distance,
    min(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END) AS z, min(CASE WHEN l_returnflag <> 'N' THEN l_discount * 900 END) AS slope, min(l_tax) AS rough
  FROM lineitem GROUP BY ALL
)"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a grid: a vector a row, a component a column; no data under label 0."""
    cells = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), "label", F.posexplode("embedding").alias("col", "value"))
    return cells.select("row", F.col("col").cast("long").alias("col"), F.when(F.col("label") != 0, F.col("value").cast("double")).alias("value"), "label")


GRID = """
WITH grid AS (
  SELECT vec_id AS row, i - 1 AS col, CASE WHEN label <> 0 THEN CAST(embedding[i] AS DOUBLE) END AS value, CAST(label AS BIGINT) AS label
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i)
)"""


def lines(spark: SparkSession, sf_dir: str, vertices: int = 32) -> DataFrame:
    """Embeddings as lines: components 2i and 2i+1 of a vector are a vertex, in units of a thousandth."""
    e = F.col("embedding")
    points = F.transform(F.sequence(F.lit(0), F.lit(vertices - 1)), lambda i: F.struct((F.get(e, 2 * i).cast("double") * 1000).alias("x"), (F.get(e, 2 * i + 1).cast("double") * 1000).alias("y")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), points.alias("line"))


VERTICES = """
WITH vertices AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label, i AS k, CAST(embedding[2 * i + 1] AS DOUBLE) * 1000 AS x, CAST(embedding[2 * i + 2] AS DOUBLE) * 1000 AS y
  FROM embeddings, (SELECT unnest(range(0, 32)) AS i)
), pieces AS (
  SELECT *, lead(x) OVER w - x AS dx, lead(y) OVER w - y AS dy FROM vertices WINDOW w AS (PARTITION BY vec_id ORDER BY k)
), cum AS (
  SELECT *, sqrt(dx * dx + dy * dy) AS step, coalesce(sum(sqrt(dx * dx + dy * dy)) OVER (PARTITION BY vec_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM pieces
), total AS (SELECT vec_id, label, sum(step) AS len FROM cum GROUP BY ALL)"""
