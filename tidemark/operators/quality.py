"""Quality reports: one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.scalars import number_label
from ..functions.stats import finite, holds, medians, quantiles
from .bathymetry import CLASSES, Depths
from .coast import covered_points


class QualityError(ValueError):
    """A quality report holds failed checks."""


@dataclass(frozen=True)
class Check:
    """An aggregate value, and whether it passes: at least low and at most high; a check without bounds reports only."""

    name: str
    value: Column
    low: float | None = None
    high: float | None = None


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of a table in one aggregation: check, passed, value, low, high."""
    one = df.agg(*[c.value.cast("double").alias(f"v{i}") for i, c in enumerate(checks)])
    rows = F.explode(F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"v{i}").alias("value"), F.lit(c.low).cast("double").alias("low"), F.lit(c.high).cast("double").alias("high")) for i, c in enumerate(checks)])).alias("r")
    ok = holds(F.coalesce(F.col("value") >= F.col("low"), F.lit(True)) & F.coalesce(F.col("value") <= F.col("high"), F.lit(True))) & (F.col("value").isNotNull() | (F.col("low").isNull() & F.col("high").isNull()))
    return one.select(rows).select("r.*").select("check", ok.alias("passed"), "value", "low", "high")


def repeats(df: DataFrame, key: str) -> DataFrame:
    """One row: how many rows there are beyond the first of each key.  A count of counts; no set of keys is gathered."""
    return df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("repeated"))


def require_passed(report_: DataFrame) -> None:
    """Raises if a check failed; call after the outputs are written."""
    failed = [r["check"] for r in report_.where("not passed").limit(50).collect()]
    if failed:
        raise QualityError(", ".join(failed))


def segment_checks(minimum: float, target: float, maximum_ambiguous: float = 0.02) -> list[Check]:
    """Checks of a segment table."""
    ambiguous = F.avg((F.col("orientation_status") == "ambiguous").cast("double"))
    return [
        Check("segments_nonempty_positive", F.count_if(~holds(F.col("segment_length_m") > 0)), high=0),
        Check("segment_length_bounds", F.count_if(F.col("segment_length_m") > 1.5 * target), high=0),
        Check("short_segments", F.count_if(F.col("segment_length_m") < minimum)),
        Check("orientation_ambiguous_share", F.coalesce(ambiguous, F.lit(0.0)), high=maximum_ambiguous),
        Check("orientation_fallback_count", F.count_if(F.col("orientation_status") == "resolved_fallback")),
    ]


def _violations(test: Column) -> Column:
    """How many rows do not hold to a test; unknown does not."""
    return F.count_if(~holds(test))


def _from_line(p: Column, line: Column) -> Column:
    """The distance of a point from a line."""
    n = F.size(line)
    edges = F.zip_with(F.slice(line, F.lit(1), n - 1), F.slice(line, F.lit(2), n - 1), lambda a, b: G.edge_distance(p, a["x"], a["y"], b["x"], b["y"]))
    return F.array_min(edges)


def coast_checks(
    land: DataFrame, coast: DataFrame, segments: DataFrame, transects: DataFrame, features: DataFrame, edges: DataFrame,
    target: float, minimum: float, maximum_ambiguous: float, maximum_missing_terrain: float, cell: float = 1000.0,
) -> DataFrame:
    """The fifteen checks of land (rings), coast lines, segments, transects and terrain features; edges is the land's edge table.

    Values are numbers of violations, or what is bounded.  Land is valid if each ring has
    three vertices and an area; lengths are conserved if their difference is at most a
    hundredth and 1e-8 of them, whichever is more (the value is their quotient).
    """
    length = F.col("segment_length_m")
    rings = land.select(F.explode("rings").alias("ring"))
    parts = segments.groupBy("coastline_part_id").agg(F.min(length).alias("least"), F.max(length).alias("most"), F.sum(length).alias("whole"))
    sums = segments.agg(F.sum(length).alias("a")).crossJoin(coast.agg(F.sum(G.length(F.col("line"))).alias("b")))
    origins = transects.join(segments.select("segment_id", F.col("line").alias("_own")), "segment_id").select(_from_line(F.get("line", F.lit(0)), F.col("_own")).alias("off"))
    ends = transects.select("transect_id", "direction", F.element_at("line", -1).alias("p"))
    on_land = ends.join(covered_points(ends, "transect_id", edges, cell), "transect_id")
    share_of = lambda direction, test: F.avg(F.when(F.col("direction") == direction, test.cast("double")))
    slopes = [finite(F.col(c)) for c in ("slope_p50_deg", "slope_p90_deg", "slope_max_deg")]
    outside = reduce(lambda a, b: a + b, (F.sum(F.when(c.isNotNull(), ((c < -1e-6) | (c > 90.000001)).cast("int"))) for c in slopes))
    reliefs = [F.col(c) for c in features.columns if c.startswith("land_relief_")]
    infinite = reduce(lambda a, b: a | b, (holds(F.abs(c) == float("inf")) for c in reliefs), F.lit(False))
    outline = F.col("line")
    reports = [
        report(rings, [Check("land_valid", F.when(F.count(F.lit(1)) > 0, _violations((F.size("ring") > 2) & (G.area(F.col("ring")) > 0))), high=0)]),
        report(coast, [Check("coastline_valid", _violations((F.size(outline) > 1) & (G.length(outline) > 0)), high=0)]),
        report(repeats(segments, "segment_id"), [Check("segment_ids_unique", F.sum("repeated"), high=0)]),
        report(parts, [Check("segment_length_bounds", F.count_if(holds((F.col("least") < minimum - 1e-6) & (F.col("whole") >= minimum)) | holds(F.col("most") > 1.5 * target + 1e-6)), high=0)]),
        report(sums, [Check("segmented_length_conserved", F.max(F.abs(F.col("a") - F.col("b")) / F.greatest(F.lit(0.01), F.col("b") * 1e-8)), high=1)]),
        report(segments, [c for c in segment_checks(minimum, target, maximum_ambiguous) if c.name not in ("segment_length_bounds", "short_segments")]),
        report(transects, [Check("transects_valid", _violations((F.size(outline) > 1) & (G.length(outline) > 0)), high=0)]),
        report(origins, [Check("transect_origins_on_coast", F.max("off"), high=1e-6)]),
        report(on_land, [Check("inland_endpoints_on_land", share_of("inland", F.col("covered")), low=0.8), Check("offshore_endpoints_off_land", share_of("offshore", ~F.col("covered")), low=0.8)]),
        report(features, [
            Check("terrain_valid_sample_share", F.coalesce(F.avg("terrain_valid_sample_share"), F.lit(0.0)), low=1 - maximum_missing_terrain),
            Check("slope_range", outside, high=0), Check("relief_finite_or_missing", F.count_if(infinite), high=0),
        ]),
    ]
    return reduce(DataFrame.unionByName, reports)


def bathymetry_checks(segments: DataFrame, transects: DataFrame, samples: DataFrame, features: DataFrame, depths: Depths, length: float) -> DataFrame:
    """The ten checks of depth transects, samples (depth_m, sample_valid) and features; values are numbers of violations."""
    ambiguous = segments.where("orientation_status = 'ambiguous'").select("segment_id")
    of_ambiguous = features.join(ambiguous, "segment_id", "left_semi")
    z, valid = F.col("depth_m"), F.col("sample_valid")
    within = lambda columns, low, high: reduce(lambda a, b: a & b, (F.coalesce(F.col(c).between(low, high), F.lit(True)) for c in columns), F.lit(True))
    shares = [c for c in features.columns if c.endswith("_share")]
    contours = [c for c in features.columns if c.startswith("distance_to_") and c.endswith("_p50_m")]
    ordered = F.lit(True)
    for x in depths.targets:
        p10, p50, p90 = (F.col(f"depth_{number_label(x)}m_p{p}_m") for p in (10, 50, 90))
        ordered = ordered & F.coalesce((p10 <= p50) & (p50 <= p90), F.lit(True))
    none = (F.col("bathymetry_screening_class") == "insufficient") & (F.col("bathymetry_transect_count") == 0)
    off = F.abs(G.length(F.col("line")) - length) <= 0.01 + 1e-5 * length
    reports = [
        report(repeats(transects, "bathymetry_transect_id"), [Check("transect_ids_unique", F.sum("repeated"), high=0)]),
        report(transects, [Check("transect_lengths_match", _violations(off), high=0)]),
        report(transects.join(ambiguous, "segment_id", "left_semi"), [Check("no_transects_for_ambiguous_orientation", F.count(F.lit(1)), high=0)]),
        report(samples, [Check("canonical_depth_nonnegative", F.count_if(valid & ~holds(z >= 0)), high=0), Check("nodata_not_converted_to_zero", F.count_if(~valid & z.isNotNull()), high=0)]),
        report(features, [
            Check("shares_in_unit_interval", _violations(within(shares, 0, 1)), high=0), Check("depth_percentiles_ordered", _violations(ordered), high=0),
            Check("screening_classes_valid", _violations(F.col("bathymetry_screening_class").isin(*CLASSES)), high=0), Check("contour_distances_within_transects", _violations(within(contours, 0, length)), high=0),
        ]),
        report(of_ambiguous, [Check("ambiguous_segments_have_no_morphology", _violations(none), high=0)]),
    ]
    return reduce(DataFrame.unionByName, reports)


def optical_checks(catalogue: DataFrame, zones: DataFrame, clarity: DataFrame) -> DataFrame:
    """The four conditions of a clarity run: scenes, zones, and features of just the segments that have zones, once each."""
    ids = lambda df: df.select(F.col("segment_id").cast("string").alias("id")).where("id is not null").distinct()
    unlike = ids(clarity).withColumn("_a", F.lit(1)).join(ids(zones).withColumn("_b", F.lit(1)), "id", "full").where("_a is null or _b is null")
    reports = [
        report(catalogue, [Check("selected_scenes", F.count_if(holds(F.col("selected"))), low=1)]),
        report(zones, [Check("segment_zones", F.count(F.lit(1)), low=1)]),
        report(repeats(clarity, "segment_id"), [Check("duplicate_clarity_segment_ids", F.sum("repeated"), high=0)]),
        report(unlike, [Check("clarity_segment_coverage_mismatch", F.count(F.lit(1)), high=0)]),
    ]
    return reduce(DataFrame.unionByName, reports)


def optical_summary(catalogue: DataFrame, zones: DataFrame, observations: DataFrame, seasonal: DataFrame, clarity: DataFrame) -> DataFrame:
    """(name, key, value): what a clarity run took in and gave, as counts, counts by value (`missing` for none) and five quantiles (minimum, p10, p50, p90, maximum)."""
    selected, valid = catalogue.where("selected"), observations.where("valid")
    row = lambda name, key, value: F.struct(F.lit(name).alias("name"), key.cast("string").alias("key"), value.cast("double").alias("value"))

    def numbers(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
        one = df.agg(*[c.alias(n) for n, c in counts.items()])
        return one.select(F.inline(F.array(*[row(n, F.lit(""), F.col(n)) for n in counts])))

    def by(df: DataFrame, name: str, *columns: str) -> DataFrame:
        key = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("missing")) for c in columns])
        return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "key", F.col("n").cast("double").alias("value"))

    def levels(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
        wanted = {"minimum": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "maximum": 1.0}
        long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("v")) for n, c in names.items()])).alias("x")).select("x.*")
        at = quantiles(long, ["name"], {"v": F.col("v")}, [(k, "v", p) for k, p in wanted.items()])
        return at.select("name", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in wanted])).alias("x")).select("name", "x.*")

    scenes = lambda df, *keys: df.groupBy(*keys).agg(F.count_distinct("scene_id").alias("n"))
    monthly = scenes(valid, "month").select(F.lit("valid_scene_counts_by_month").alias("name"), F.col("month").cast("string").alias("key"), F.col("n").cast("double").alias("value"))
    burdens = [c for c in ("cloud", "shadow", "glint", "land", "whitewater") if f"{c}_excluded_share" in observations.columns]
    is_true = lambda c: F.count_if(holds(F.col(c)))
    tables = [
        numbers(catalogue, {"candidate_scenes": F.count(F.lit(1)), "selected_scenes": is_true("selected"), "rejected_scenes": F.count(F.lit(1)) - is_true("selected")}),
        by(catalogue.where("not selected"), "rejection_reasons", "selection_reason"), by(selected, "selected_scene_counts_by_month_year", "year", "month"),
        levels(selected, {"selected_catalogue_cloud_cover_percent": "catalogue_cloud_cover_percent"}), by(selected, "processing_baselines", "processing_baseline"), by(selected, "tiles", "tile_id"),
        numbers(zones, {"segment_zone_count": F.count(F.lit(1))}), by(zones, "zone_statuses", "zone_status"),
        numbers(observations, {"candidate_observations": F.count(F.lit(1)), "valid_observations": is_true("valid"), "invalid_observations": F.count(F.lit(1)) - is_true("valid")}),
        by(observations.where("not valid"), "invalid_reasons", "invalid_reason"), monthly, levels(scenes(valid, "segment_id"), {"valid_scene_count_by_segment": "n"}),
        levels(observations, {"valid_pixel_share": "valid_pixel_share", "clarity_percentile": "clarity_percentile"} | {f"mask_burden_{c}": f"{c}_excluded_share" for c in burdens}),
        levels(seasonal, {"seasonal_clarity_percentile_p50": "clarity_percentile_p50"} | {c: c for c in ("clear_water_observation_share", "clarity_persistence", "clarity_variability_iqr")}),
        by(clarity, "best_month_distribution", "best_month"), by(clarity, "confidence_classes", "clarity_data_confidence"), by(clarity, "quality_classes", "clarity_quality_flag"),
        by(seasonal, "bottom_texture_status", "bottom_texture_status") if "bottom_texture_status" in seasonal.columns else numbers(seasonal, {"bottom_texture_insufficient": F.count(F.lit(1))}),
    ]
    return reduce(DataFrame.unionByName, tables)


def line_contract(lines: DataFrame, key: str, maximum_jump: float, maximum_length: float, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Checks that a table of lines can be shown: features with ids of their own, two finite vertices each, no jump or length beyond a limit, within a box if there is one."""
    line, every = F.col("line"), F.lit(True)
    finite_ = F.forall("line", lambda p: finite(p["x"]).isNotNull() & finite(p["y"]).isNotNull())
    inside = every if box is None else (F.array_max(line["x"]) >= box[0]) & (F.array_min(line["x"]) <= box[2]) & (F.array_max(line["y"]) >= box[1]) & (F.array_min(line["y"]) <= box[3])
    checks = [
        Check("features", F.count(F.lit(1)), low=1), Check("empty_geometries", F.count_if(~holds(F.size(line) > 1)), high=0), Check("invalid_coordinates", F.count_if(~holds(finite_)), high=0),
        Check("maximum_coordinate_jump", F.max(F.array_max(G.steps(line))), high=maximum_jump), Check("maximum_length", F.max(G.length(line)), high=maximum_length), Check("outside_the_area", F.count_if(~holds(inside)), high=0),
    ]
    return report(lines, checks).unionByName(report(repeats(lines, key), [Check("duplicate_ids", F.sum("repeated"), high=0)]))


def missing_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per field that exists: field, missing, total."""
    there = [f for f in dict.fromkeys(fields) if f in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(f).isNull()).alias(f"m{i}") for i, f in enumerate(there)])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"m{i}").alias("missing")) for i, f in enumerate(there)])).alias("r")
    return one.select("total", rows).select("r.field", "r.missing", "total")


def quadrants(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of rows above (or at) and below the medians of two metrics, of rows that have both."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    centres = medians(both, {"_a": F.col(a), "_b": F.col(b)})
    level = lambda x, m: F.when(F.col(x) >= F.col(m), "high").otherwise("low")
    return both.crossJoin(F.broadcast(centres)).groupBy(level(a, "_a").alias(f"{a}_level"), level(b, "_b").alias(f"{b}_level")).agg(F.count(F.lit(1)).alias("count"))


def summary(df: DataFrame, positive: Mapping[str, str], true: Mapping[str, str] | None = None) -> DataFrame:
    """One row: total, and by name how often a field is above 0 (missing counts as 0) or true."""
    counts = [F.count_if(holds(F.col(c) > 0)).alias(n) for n, c in positive.items()] + [F.count_if(holds(F.col(c))).alias(n) for n, c in (true or {}).items()]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts)


def largest(df: DataFrame, field: str, key: str, n: int = 5) -> DataFrame:
    """The n rows of the largest known values of a field; ties go to the first key."""
    return df.where(F.col(field).isNotNull()).orderBy(F.col(field).desc(), key).limit(n)


def summarised(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per group: the median, the sample standard deviation and the number of a value."""
    at = quantiles(df, keys, {"v": F.col(value)}, [("median", "v", 0.5)])
    rest = df.groupBy(*keys).agg(F.stddev_samp(value).alias("std"), F.count(value).alias("count"))
    return rest.join(at, list(keys), "left")


def id_set_sha256(df: DataFrame, key: str) -> DataFrame:
    """SHA-256 of the sorted distinct ids, joined by line breaks, and how many there are.

    The digest is of one text with all ids, so this is for sets of ids that fit a row (2 GB);
    ids_checksum is for any number of them.
    """
    ids = df.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct()
    return ids.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("id")), "\n"), 256).alias("checksum"), F.count(F.lit(1)).alias("count"))


def ids_checksum(df: DataFrame, key: str) -> DataFrame:
    """A SHA-256 of SHA-256s of sorted distinct ids, and how many there are; not the digest that id_set_sha256 gives.

    Ids are hashed in ranges of a hash of their own, and the ranges' digests together, so
    that no task holds all ids.
    """
    ids = df.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct()
    parts = ids.groupBy(F.substring(F.sha2("id", 256), 1, 3).alias("range")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("id")), "\n"), 256).alias("digest"), F.count(F.lit(1)).alias("n"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range", "digest"))), lambda x: x["digest"]), "\n"), 256).alias("checksum"), F.sum("n").cast("long").alias("count"))


def empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "check string, passed boolean, value double, low double, high double")
