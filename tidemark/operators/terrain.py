"""Terrain along transects: sampling, origins, and features per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import number_label
from ..functions.stats import holds, share

NEARSHORE = 25.0


def first_valid(samples: DataFrame, keys: Sequence[str], distance: str, value: str, search: float, prefix: str = "origin") -> DataFrame:
    """Per transect: the nearest sample with a value within the search distance: {prefix}_distance, {prefix}_value and {prefix}_method."""
    usable = holds((F.col(distance) <= search) & F.col(value).isNotNull())
    found = samples.groupBy(*keys).agg(F.min(F.when(usable, F.struct(F.col(distance).alias("d"), F.col(value).alias("v")))).alias("_f"))
    d = F.col("_f.d")
    method = F.when(d.isNull(), "unavailable").when(d == 0, "exact").otherwise("shifted_inland")
    return found.select(*keys, d.alias(f"{prefix}_distance"), F.col("_f.v").alias(f"{prefix}_value"), method.alias(f"{prefix}_method"))


def with_origins(samples: DataFrame, distance: str = "sample_distance_m", value: str = "elevation_m", search: float = 20.0) -> DataFrame:
    """Adds terrain_origin_shift_m, terrain_origin_elevation_m and terrain_origin_method to the rows of each transect."""
    found = first_valid(samples, ["transect_id"], distance, value, search, "_o")
    named = found.select("transect_id", F.col("_o_distance").alias("terrain_origin_shift_m"), F.col("_o_value").alias("terrain_origin_elevation_m"), F.col("_o_method").alias("terrain_origin_method"))
    return samples.join(named, "transect_id", "left")


def terrain_features(segments: DataFrame, samples: DataFrame, relief_distances: Sequence[float] = (25, 50, 100), spacing: float = 5.0, steep: float = 35.0, minimum_share: float = 0.7) -> DataFrame:
    """One row per segment: elevations, relief, slopes, roughness, completeness and a quality flag.

    samples has segment_id, transect_id, sample_distance_m, elevation_m, slope_deg, roughness
    and the terrain_origin columns, and holds inland transects only.  Two aggregations:
    samples to transects, transects to segments; sample-level quantiles go with the first
    shuffle's rows.  A sample is at a distance if within half a spacing of it.
    """
    tolerance = spacing / 2 + 1e-6
    z, slope, d = F.col("elevation_m"), F.col("slope_deg"), F.col("sample_distance_m")
    near = lambda x: holds(F.abs(d - x) <= tolerance)
    steep_sample = z.isNotNull() & slope.isNotNull() & (slope >= steep)
    sloped = z.isNotNull() & slope.isNotNull()
    label = {x: number_label(x) for x in relief_distances}
    transects = samples.groupBy("segment_id", "transect_id").agg(
        F.first("terrain_origin_elevation_m", True).alias("_origin"), F.first("terrain_origin_shift_m", True).alias("_shift"), F.first("terrain_origin_method", True).alias("_method"),
        F.count_if(z.isNotNull()).alias("_valid"),
        F.min(F.when(steep_sample, d)).alias("_first_steep"),
        F.min_by(F.when(sloped, d), F.when(sloped, F.struct(-slope, d))).alias("_steepest"),
        F.max(F.when(sloped, steep_sample & (d <= NEARSHORE))).alias("_nearshore"),
        *[F.min_by(F.when(near(x) & z.isNotNull(), z), F.when(near(x) & z.isNotNull(), d)).alias(f"_z{label[x]}") for x in relief_distances],
    )
    origin = F.col("_origin")
    per_segment = transects.groupBy("segment_id").agg(
        F.percentile("_origin", 0.5).alias("elevation_coast_p50_m"),
        F.percentile("_shift", 0.5).alias("terrain_origin_shift_m"),
        *[F.percentile(F.col(f"_z{label[x]}") - origin, p).alias(f"land_relief_{label[x]}m_p{round(100 * p)}_m") for x in relief_distances for p in (0.5, 0.9)],
        F.percentile("_first_steep", 0.5).alias("distance_to_first_steep_sample_p50_m"),
        F.percentile("_steepest", 0.5).alias("distance_to_max_slope_p50_m"),
        F.avg(F.col("_nearshore").cast("double")).alias("steep_nearshore_transect_share"),
        F.count(F.lit(1)).alias("terrain_transect_count"),
        F.count_if(F.col("_valid") > 0).alias("terrain_valid_transect_count"),
        F.bool_and(F.col("_method") == "unavailable").alias("_none"),
        F.bool_and(F.col("_method") == "exact").alias("_exact"),
    )
    per_sample = samples.groupBy("segment_id").agg(
        *[F.percentile(F.when(near(x), z), 0.5).alias(f"elevation_{label[x]}m_p50_m") for x in relief_distances],
        F.percentile(slope, 0.5).alias("slope_p50_deg"), F.percentile(slope, 0.9).alias("slope_p90_deg"), F.max(slope).alias("slope_max_deg"),
        share(slope >= steep, slope.isNotNull()).alias("steep_sample_share"),
        F.percentile("roughness", 0.5).alias("roughness_p50"), F.percentile("roughness", 0.9).alias("roughness_p90"),
        F.count(F.lit(1)).alias("terrain_sample_count"), F.count_if(z.isNotNull()).alias("terrain_valid_sample_count"),
    )
    joined = segments.select("segment_id", "orientation_status").join(per_segment, "segment_id", "left").join(per_sample, "segment_id", "left")
    counts = ("terrain_transect_count", "terrain_valid_transect_count", "terrain_sample_count", "terrain_valid_sample_count")
    joined = joined.na.fill(0, list(counts))
    joined = joined.withColumns(
        {
            "terrain_valid_transect_share": F.coalesce(F.try_divide("terrain_valid_transect_count", "terrain_transect_count"), F.lit(0.0)),
            "terrain_valid_sample_share": F.coalesce(F.try_divide("terrain_valid_sample_count", "terrain_sample_count"), F.lit(0.0)),
        }
    )
    none = F.coalesce("_none", F.lit(True))
    valid = F.col("terrain_valid_sample_share")
    quality = (
        F.when(F.col("orientation_status") == "ambiguous", "orientation_unresolved").when(F.col("terrain_valid_sample_count") == 0, "outside_dem")
        .when(valid >= minimum_share, "good").when(valid >= minimum_share / 2, "partial").otherwise("insufficient")
    )
    return joined.withColumns(
        {
            "terrain_origin_elevation_m": F.col("elevation_coast_p50_m"),
            "terrain_origin_method": F.when(none, "unavailable").when(F.col("_exact"), "exact").otherwise("shifted_inland"),
            "terrain_origin_quality_flag": F.when(none, "no_valid_inland_origin").when(F.col("_exact"), "good").otherwise("shifted"),
            "terrain_quality_flag": quality,
        }
    ).drop("_none", "_exact", "orientation_status")


def sample_positions(length: Column, spacing: float) -> Column:
    """The distances 0, spacing, ... up to a length, as whole multiples, never summed up."""
    return F.transform(F.sequence(F.lit(0), F.floor((length + 1e-7) / spacing).cast("int")), lambda i: i * F.lit(float(spacing)))
