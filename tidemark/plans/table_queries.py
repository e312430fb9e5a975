"""Queries of filters, joins, sets and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.stats import distribution, quantiles, value_counts
from ..operators import filters, joins, quality
from .registry import query
from .views import SAMPLES, rounded, samples, table, tidy


@query("SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#13', 'Brand#22') AND starts_with(p_type, 'S')")
def q11_attribute_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (filters.AttributeFilter("p_brand", ("Brand#1", "Brand#2", "Brand#13", "Brand#22")), filters.AttributeFilter("p_type", prefix="S"))
    return filters.attribute_filtered(table(spark, sf_dir, "part"), wanted).select("p_partkey", "p_brand", "p_type")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0 AND c_acctbal <= 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND NOT coalesce(c_nationkey % 3 = 0, false) AND contains(lower(c_name), '#0000')""")
def q12_viewer_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumn("odd_flag", F.col("c_nationkey") % 3 == 0)
    wanted = filters.Filters(one_of={"c_mktsegment": ("BUILDING", "MACHINERY")}, ranges={"c_acctbal": (0, 5000), "c_custkey": (None, None)}, flags={"odd_flag": False, "absent_flag": False}, search=("c_name", " #0000 "))
    return filters.filtered(rows, wanted).select("c_custkey", "c_name")


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("segment_id"), F.when(k % 7 == 0, "ambiguous").otherwise("resolved").alias("orientation_status"), F.when(k % 5 != 0, k % 4 == 0).alias("orientation_source_mismatch_flag"),
        F.when(k % 3 != 0, (k % 6) / F.lit(6.0)).alias("bathymetry_large_coastal_gap_share"), F.when(k % 9 != 0, F.col("c_acctbal")).alias("bathymetry_valid_transect_share"),
        F.when(k % 8 != 0, F.col("c_acctbal") - 1000).alias("terrain_valid_sample_share"), F.when(k % 10 == 0, "background_only").otherwise("regional_screening").alias("bathymetry_screening_class"), F.when(k % 2 == 0, (k % 20) / F.lit(20.0)).alias("global_fallback_source_share"),
    )


ATTRIBUTES = """
WITH attributes AS (
  SELECT c_custkey AS segment_id, CASE WHEN c_custkey % 7 = 0 THEN 'ambiguous' ELSE 'resolved' END AS orientation_status, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 4 = 0 END AS orientation_source_mismatch_flag,
    CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 6) / CAST(6 AS DOUBLE) END AS bathymetry_large_coastal_gap_share, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS bathymetry_valid_transect_share,
    CASE WHEN c_custkey % 8 <> 0 THEN c_acctbal - 1000 END AS terrain_valid_sample_share, CASE WHEN c_custkey % 10 = 0 THEN 'background_only' ELSE 'regional_screening' END AS bathymetry_screening_class,
    CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 20) / CAST(20 AS DOUBLE) END AS global_fallback_source_share
  FROM customer
)"""
FLAGS = ("ambiguous", "source_mismatch", "large_coastal_gap", "missing_bathymetry", "missing_terrain", "global_fallback")


@query(ATTRIBUTES + """ SELECT segment_id, orientation_status = 'ambiguous' AS ambiguous, coalesce(orientation_source_mismatch_flag, false) AS source_mismatch, coalesce(bathymetry_large_coastal_gap_share > 0, false) AS large_coastal_gap,
NOT coalesce(bathymetry_valid_transect_share > 0, false) AS missing_bathymetry, NOT coalesce(terrain_valid_sample_share > 0, false) AS missing_terrain,
coalesce(global_fallback_source_share >= 0.5, false) OR bathymetry_screening_class = 'background_only' AS global_fallback FROM attributes""")
def q13_flag_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.segment_flags(_attributes(spark, sf_dir)).select("segment_id", *FLAGS)


@query(ATTRIBUTES + """ SELECT segment_id FROM attributes WHERE coalesce(bathymetry_valid_transect_share > 0, false) AND NOT coalesce(terrain_valid_sample_share > 0, false)""")
def q14_availability_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = filters.Filters(availability={"bathymetry_valid_transect_share": "available", "terrain_valid_sample_share": "missing", "absent": "missing", "segment_id": "all"})
    return filters.filtered(_attributes(spark, sf_dir), wanted).select("segment_id")


@query(rounded("SELECT c_custkey, c_name, n_orders, spent FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_orders, sum(o_totalprice) AS spent FROM orders GROUP BY 1) o USING (c_custkey)", "spent"))
def q15_one_to_one_join_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spent"))
    return tidy(joins.one_to_one(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), spent, ["c_custkey"]))


@query("""SELECT 'with' AS side, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'without', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def q16_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    some = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    side = lambda how, name: customers.join(some, "c_custkey", how).select(F.lit(name).alias("side"), "c_custkey")
    return side("left_semi", "with").unionByName(side("left_anti", "without"))


@query("""WITH expected AS (SELECT n_nationkey, m AS segment FROM nation, (SELECT DISTINCT c_mktsegment AS m FROM customer)), actual AS (SELECT DISTINCT c_nationkey AS n_nationkey, c_mktsegment AS segment FROM customer WHERE c_acctbal > 9000 UNION SELECT 99, 'NONE')
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, segment, 'missing' AS side FROM (FROM expected EXCEPT FROM actual) UNION ALL SELECT CAST(n_nationkey AS BIGINT), segment, 'unexpected' FROM (FROM actual EXCEPT FROM expected)""")
def q17_expected_minus_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    roles = customers.select(F.col("c_mktsegment").alias("segment")).distinct()
    expected = table(spark, sf_dir, "nation").select("n_nationkey").withColumn("_x", F.lit(1)).join(roles.withColumn("_x", F.lit(1)), "_x").drop("_x")
    actual = customers.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment")).union(spark.range(1).select(F.lit(99), F.lit("NONE")))
    return tidy(joins.key_differences(expected, actual, ["n_nationkey", "segment"]))


@query("SELECT c_custkey, min(origin) AS origin FROM (SELECT c_custkey, '1 first' AS origin FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey, '2 second' FROM customer WHERE c_acctbal < 0) GROUP BY c_custkey")
def q18_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    some = lambda test, name: rows.where(test).select("c_custkey", F.lit(name).alias("origin"))
    return joins.union_once(some("c_mktsegment = 'BUILDING'", "1 first"), some("c_acctbal < 0", "2 second"), ["c_custkey"])


@query("""WITH a AS (SELECT p_partkey AS k FROM part WHERE p_size > 25), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity = 50)
SELECT 'both' AS what, count(*) AS count FROM (FROM a INTERSECT FROM b) UNION ALL SELECT 'not_allowed', count(*) FROM (FROM b EXCEPT FROM a)""")
def q19_intersect_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("k"))
    b = table(spark, sf_dir, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("k"))
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("what"), "count")
    return one(a.intersect(b), "both").union(one(b.subtract(a), "not_allowed"))


FIELDS = ("z", "slope", "rough")


@query(rounded(SAMPLES + ", long AS (SELECT 'z' AS field, z AS value FROM samples UNION ALL SELECT 'slope', slope FROM samples UNION ALL SELECT 'rough', rough FROM samples)--SELECT SELECT field, count(value) AS count, min(value) AS min, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.9) AS p90, max(value) AS max, avg(value) AS mean FROM long GROUP BY field", "min", "p10", "p50", "p90", "max", "mean"))
def q27_distribution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(distribution(samples(spark, sf_dir), FIELDS))


@query("SELECT o_orderstatus AS status, coalesce(CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END, 'missing') AS priority, count(*) AS count FROM orders GROUP BY ALL")
def q28_value_counts_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("priority"))
    return value_counts(rows, "status", "priority", missing="missing")


@query(ATTRIBUTES + """, both_ AS (SELECT bathymetry_valid_transect_share AS a, terrain_valid_sample_share AS b FROM attributes WHERE bathymetry_valid_transect_share IS NOT NULL AND terrain_valid_sample_share IS NOT NULL), m AS (SELECT median(a) AS ma, median(b) AS mb FROM both_)
SELECT CASE WHEN a >= ma THEN 'high' ELSE 'low' END AS bathymetry_valid_transect_share_level, CASE WHEN b >= mb THEN 'high' ELSE 'low' END AS terrain_valid_sample_share_level, count(*) AS count FROM both_, m GROUP BY ALL""")
def q29_cross_layer_quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quadrants(_attributes(spark, sf_dir), "bathymetry_valid_transect_share", "terrain_valid_sample_share")


@query(rounded(SAMPLES + "--SELECT SELECT segment_id, transect_id, distance, distance / sum(distance) OVER (PARTITION BY segment_id) AS length_share FROM samples", "distance", "length_share"))
def q30_group_total_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    totals = rows.groupBy("segment_id").agg(F.sum("distance").alias("_total"))
    return tidy(rows.join(totals, "segment_id").select("segment_id", "transect_id", "distance", (F.col("distance") / F.col("_total")).alias("length_share")))


@query(SAMPLES + " SELECT transect_id, distance, z FROM samples WHERE z IS NOT NULL ORDER BY z DESC, transect_id LIMIT 5")
def q31_top_k_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.largest(samples(spark, sf_dir), "z", "transect_id").select("transect_id", "distance", "z")


@query("SELECT CAST(year(o_orderdate) AS BIGINT) AS year, " + ", ".join(f"count(*) FILTER (WHERE month(o_orderdate) = {m}) AS m{m:02d}" for m in range(1, 13)) + " FROM orders GROUP BY 1")
def q32_pivot_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.format_string("m%02d", F.month("o_orderdate")).alias("month"))
    return tidy(rows.groupBy("year").pivot("month", [f"m{m:02d}" for m in range(1, 13)]).count().na.fill(0))


@query("SELECT c_custkey, CASE WHEN -c_acctbal > 0 THEN round(-c_acctbal, 6) + 0.0 END AS depth_m, CASE WHEN c_acctbal >= 0 THEN round(c_acctbal, 6) + 0.0 END AS height_m FROM customer")
def q40_depth_canonicalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("c_acctbal")
    return tidy(table(spark, sf_dir, "customer").select("c_custkey", S.canonical_depth(value, "negative_elevation", zero_is_valid=False).alias("depth_m"), S.canonical_depth(value).alias("height_m")))


@query("""WITH s AS (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS v, c_custkey FROM customer), b AS (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM s), p AS (SELECT c_custkey, least(1.0, greatest(0.0, (v - lo) / (hi - lo))) * 2 AS pos FROM s, b WHERE v IS NOT NULL)
SELECT c_custkey, CAST(CASE WHEN pos < 1 THEN round_even(0 * (1 - pos) + 100 * pos, 0) ELSE round_even(100 * (2 - pos) + 255 * (pos - 1), 0) END AS BIGINT) AS red, CAST(CASE WHEN pos < 1 THEN round_even(50 * (1 - pos) + 200 * pos, 0) ELSE round_even(200 * (2 - pos) + 40 * (pos - 1), 0) END AS BIGINT) AS green FROM p UNION ALL SELECT c_custkey, 150, 150 FROM s WHERE v IS NULL""")
def q48_color_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("v"))
    bounds = quantiles(rows, [], {"v": F.col("v")}, [("lo", "v", 0.05), ("hi", "v", 0.95)])
    colour = S.palette_colour(S.palette_position(F.col("v"), F.col("lo"), F.col("hi")), [(0, 50, 0), (100, 200, 50), (255, 40, 0)])
    rows = rows.crossJoin(F.broadcast(bounds)).withColumn("rgba", colour)
    return tidy(rows.select("c_custkey", F.get("rgba", F.lit(0)).alias("red"), F.get("rgba", F.lit(1)).alias("green")))


@query("SELECT c_custkey, c_acctbal AS regional_proxy__depth_100m_p50_m, c_nationkey AS terrain_valid, c_acctbal / 2 AS regional_proxy__distance_to_first_steep FROM customer")
def q49_csv_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("depth_100m_p50_m"), F.col("c_nationkey").alias("terrain_valid"), (F.col("c_acctbal") / 2).alias("distance_to_first_steep"), F.array(F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))).alias("geometry"))
    return filters.exported(filters.preferred_columns(rows, ("c_custkey", "depth_100m_p50_m", "absent", "terrain_valid", "distance_to_first_steep", "c_custkey", "geometry")))


REPORT = """
WITH s AS (SELECT CASE WHEN s_suppkey % 9 <> 0 THEN s_acctbal END AS v, CASE WHEN s_suppkey % 17 = 0 THEN 'ambiguous' WHEN s_suppkey % 4 = 0 THEN 'resolved_fallback' ELSE 'resolved' END AS st FROM supplier),
t AS (
  SELECT 'segments_nonempty_positive' AS "check", CAST(count(*) FILTER (WHERE NOT coalesce(v > 0, false)) AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS low, CAST(0 AS DOUBLE) AS high FROM s
  UNION ALL SELECT 'segment_length_bounds', count(*) FILTER (WHERE v > 6000), NULL, 0 FROM s
  UNION ALL SELECT 'short_segments', count(*) FILTER (WHERE v < 1000), NULL, NULL FROM s
  UNION ALL SELECT 'orientation_ambiguous_share', avg((st = 'ambiguous')::INT), NULL, 0.02 FROM s
  UNION ALL SELECT 'orientation_fallback_count', count(*) FILTER (WHERE st = 'resolved_fallback'), NULL, NULL FROM s
)
--SELECT SELECT "check", coalesce(value >= low, true) AND coalesce(value <= high, true) AS passed, value, low, high FROM t"""


@query(rounded(REPORT, "value", "low", "high"))
def q50_qa_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(F.when(k % 9 != 0, F.col("s_acctbal")).alias("segment_length_m"), F.when(k % 17 == 0, "ambiguous").when(k % 4 == 0, "resolved_fallback").otherwise("resolved").alias("orientation_status"))
    return tidy(quality.report(rows, quality.segment_checks(1000, 4000)))


@query("""WITH ids AS (SELECT DISTINCT c_name AS id FROM customer), parts AS (SELECT substr(sha256(id), 1, 3) AS range, sha256(string_agg(id, chr(10) ORDER BY id)) AS digest, count(*) AS n FROM ids GROUP BY 1)
SELECT (SELECT sha256(string_agg(id, chr(10) ORDER BY id)) FROM ids) AS checksum, sha256(string_agg(digest, chr(10) ORDER BY range)) AS ranged_checksum, CAST(sum(n) AS BIGINT) AS count FROM parts""")
def q51_id_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    whole = quality.id_set_sha256(customers, "c_name").drop("count")
    return whole.crossJoin(quality.ids_checksum(customers, "c_name").withColumnRenamed("checksum", "ranged_checksum"))


@query("""WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events)
SELECT event_id, k, array_to_string(list_filter([CASE WHEN k > 50 THEN 'high_k' END, CASE WHEN value > 20 THEN 'high_value' END, CASE WHEN k IS NULL THEN 'no_k' END], lambda x: x IS NOT NULL), ';') AS reasons FROM e""")
def q52_json_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), "value")
    reasons = F.array_compact(F.array(F.when(F.col("k") > 50, F.lit("high_k")), F.when(F.col("value") > 20, F.lit("high_value")), F.when(F.col("k").isNull(), F.lit("no_k"))))
    return rows.select("event_id", "k", F.array_join(reasons, ";").alias("reasons"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'Not available' ELSE printf('%.2f', c_acctbal) || ' m' END AS shown, CASE WHEN c_custkey % 4 = 0 THEN 'Not available' WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS positive, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS segment FROM customer""")
def q53_format_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", S.format_value(F.when(k % 10 != 0, F.col("c_acctbal")), unit="m").alias("shown"),
        S.format_value(F.when(k % 4 != 0, F.col("c_acctbal") > 0), "boolean").alias("positive"), S.format_value(F.col("c_mktsegment"), "category").alias("segment"),
    )


@query(ATTRIBUTES + " " + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) - count({f}) AS missing, count(*) AS total FROM attributes" for f in ("bathymetry_valid_transect_share", "terrain_valid_sample_share", "global_fallback_source_share")))
def q54_missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_counts(_attributes(spark, sf_dir), ("bathymetry_valid_transect_share", "absent", "terrain_valid_sample_share", "global_fallback_source_share"))


@query(ATTRIBUTES + " SELECT count(*) AS total, count(*) FILTER (WHERE bathymetry_valid_transect_share > 0) AS with_bathymetry, count(*) FILTER (WHERE terrain_valid_sample_share > 0) AS with_terrain, count(*) FILTER (WHERE orientation_source_mismatch_flag) AS mismatched FROM attributes")
def q56_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(_attributes(spark, sf_dir), {"with_bathymetry": "bathymetry_valid_transect_share", "with_terrain": "terrain_valid_sample_share"}, {"mismatched": "orientation_source_mismatch_flag"})
