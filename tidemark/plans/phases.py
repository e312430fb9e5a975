"""The three additive phases: terrain, depth and clarity, each from tables to tables.

Each table that several later ones read is handed to a store first, which writes it and
returns what it reads back, so that no part of a phase is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import bathymetry, coast, optical, raster, terrain
from ..operators.joins import one_to_one

Store = Callable[[str, DataFrame], DataFrame]
Edges = Sequence[tuple[float, float, float, float]]


@dataclass(frozen=True)
class Region:
    """What the phases need to know of a region.  Grids have square cells, rows running down from the top."""

    name: str
    land: Edges
    target: float = 250.0
    minimum: float = 75.0
    test_distances: Sequence[float] = (10.0, 20.0, 40.0)
    vote_offsets: Sequence[float] = (0.0,)
    transect_spacing: float = 25.0
    inland: float = 100.0
    offshore: float = 200.0
    sample_spacing: float = 5.0
    relief: Sequence[float] = (25, 50, 100)
    steep: float = 35.0
    origin_search: float = 20.0
    minimum_share: float = 0.7
    depth_spacing: float = 100.0
    depth_length: float = 500.0
    depth_step: float = 25.0
    depth_search: float = 200.0
    depths: bathymetry.Depths = field(default_factory=lambda: bathymetry.Depths(targets=(100.0, 250.0, 500.0)))
    land_buffer: float = 0.0
    limits: optical.Limits = field(default_factory=optical.Limits)
    zones: Sequence[tuple[str, float, float]] = (("nearshore", 20, 100), ("coastal", 100, 300), ("context", 300, 750))
    periods: Mapping[str, Sequence[int]] = field(default_factory=lambda: {"extended": (5, 6, 7, 8, 9), "summer_jja": (6, 7, 8)})

    def __post_init__(self) -> None:
        if self.minimum > self.target:
            raise ValueError("the least segment is longer than the target")
        if not self.test_distances or min(self.test_distances) <= 0:
            raise ValueError("test distances have to be positive")


def folder_store(spark: SparkSession, folder: str) -> Store:
    """A store of Parquet tables in a folder that all executors share."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return keep


def positions_along(lines: DataFrame, key: str, length: float, spacing: float, name: str) -> DataFrame:
    """Points on each line at whole multiples of the spacing, up to its length."""
    rows = lines.select("*", F.explode(terrain.sample_positions(F.lit(float(length)), spacing)).alias(name))
    p = G.interpolate(F.col("line"), F.col(name))
    return rows.withColumn("_p", p).select(key, "segment_id", name, F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))


def terrain_phase(store: Store, parts: DataFrame, elevation: DataFrame, region: Region, left: float, top: float, resolution: float) -> dict[str, DataFrame]:
    """Coast parts and an elevation grid to segments, transects, samples and segment features."""
    cut = coast.segments(parts, region.name, region.target, region.minimum)
    segments = store("coast_segments", coast.oriented(cut, region.land, region.test_distances, region.vote_offsets))
    transects = store("transects", coast.transects(segments, region.transect_spacing, region.inland, region.offshore))
    points = positions_along(transects.where("direction = 'inland'"), "transect_id", region.inland, region.sample_spacing, "sample_distance_m")
    grids = raster.slope(elevation, resolution=resolution).join(raster.roughness(elevation, radius=raster.window_radius(15.0, resolution)), ["row", "col"]).join(elevation.withColumnRenamed("value", "elevation_m"), ["row", "col"])
    measured = grids.select("row", "col", F.struct("elevation_m", "slope_deg", "roughness").alias("value"))
    sampled = store("terrain_cells", raster.nearest(points, measured, left, top, resolution, "_v").select("segment_id", "transect_id", "sample_distance_m", "_v.*"))
    sampled = store("terrain_samples", terrain.with_origins(sampled, search=region.origin_search))
    features = store("terrain_features", terrain.terrain_features(segments, sampled, region.relief, region.sample_spacing, region.steep, region.minimum_share))
    return {"coast_segments": segments, "transects": transects, "terrain_samples": sampled, "segment_features": one_to_one(segments, features, ["segment_id"])}


def bathymetry_phase(store: Store, segments: DataFrame, depth: DataFrame, region: Region, left: float, top: float, resolution: float) -> dict[str, DataFrame]:
    """Oriented segments and a depth grid to depth samples and segment features.

    The first valid depth is searched for finely; samples lie no closer than the native resolution.
    """
    lines = store("bathymetry_transects", coast.seaward_transects(segments, region.depth_spacing, region.depth_length))
    regular = bathymetry.sample_distances(region.depth_step, region.depths.native, region.depth_length, region.depths.targets)
    search = bathymetry.search_distances(region.depths.native, region.depth_search)
    every = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(d in set(regular)).alias("sampled"), F.lit(d in set(search)).alias("searched")) for d in sorted({*regular, *search})])
    points = lines.select("segment_id", F.col("bathymetry_transect_id").alias("transect_id"), "line", F.explode(every).alias("_d"))
    points = points.withColumn("_p", G.interpolate(F.col("line"), F.col("_d.d"))).select("segment_id", "transect_id", F.col("_d.d").alias("distance_m"), "_d.sampled", "_d.searched", "_p.x", "_p.y")
    keyed = points.withColumn("_k", F.concat_ws("@", "transect_id", "distance_m"))
    sampled = store("bathymetry_samples", raster.bilinear(keyed, depth, "_k", left, top, resolution, "depth_m").drop("_k", "x", "y"))
    first = sampled.where("searched").groupBy("transect_id").agg(F.min(F.when(F.col("depth_m").isNotNull(), F.col("distance_m"))).alias("first_valid_distance_m"))
    profiles = bathymetry.depth_profile(sampled.where("sampled"), region.depths).drop("first_valid_distance_m").join(first, "transect_id", "left")
    features = store("bathymetry_features", bathymetry.bathymetry_features(segments, profiles, region.depths))
    return {"bathymetry_transects": lines, "bathymetry_samples": sampled.where("sampled").drop("sampled", "searched"), "bathymetry_features": features}


def optical_zones(segments: DataFrame, region: Region) -> tuple[DataFrame, DataFrame]:
    """All zones of all segments with zone_status, and the strips of those that are oriented."""
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("t"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for n, a, b in region.zones])).alias("z")
    clear = (F.col("orientation_status") != "ambiguous") & F.col("seaward_bearing_deg").isNotNull()
    zones = segments.select("segment_id", "orientation_status", clear.alias("_clear"), kinds).select(
        F.concat_ws("_", "segment_id", "z.t").alias("zone_id"), "segment_id", F.col("z.t").alias("zone_type"), F.col("z.a").alias("inner_distance_m"), F.col("z.b").alias("outer_distance_m"),
        "orientation_status", F.when(F.col("_clear"), "valid").otherwise("ambiguous_orientation").alias("zone_status"),
    )
    strips = coast.zone_strips(coast.seaward_transects(segments, region.depth_spacing, 1.0), region.zones, region.depth_spacing)
    return zones, strips


def clarity_phase(store: Store, segments: DataFrame, pixels: DataFrame, scenes: DataFrame, region: Region) -> dict[str, DataFrame]:
    """Oriented segments, band pixels (scene_id, row, col, x, y and bands) and scenes (scene_id, selected, year, month) to observations and features.

    A zone is the union of its strips less the land and what lies within its buffer.
    """
    zones, strips = optical_zones(segments, region)
    zones = store("optical_zones", zones)
    at = G.point(F.col("x"), F.col("y"))
    spots = pixels.select("x", "y").distinct().withColumn("spot", F.concat_ws("_", "x", "y")).withColumn("p", at)
    spots = spots.where(~G.let(F.col("p"), lambda p: G.covered_by(p, list(region.land), max(1e-9, region.land_buffer))))
    member = store("optical_zone_pixels", coast.zone_membership(spots, "spot", strips).select("spot", "zone_id"))
    textured = optical.texture_gradient(pixels)
    zoned = textured.withColumn("spot", F.concat_ws("_", "x", "y")).join(member, "spot")
    # The result holds each selected scene with each zone.
    spine = scenes.where("selected").select("scene_id", "year", "month").crossJoin(zones.select("zone_id", "segment_id", "zone_type", "zone_status"))
    observations = store("clarity_measures", optical.scene_observations(spine, zoned, limits=region.limits))
    observations = store("clarity_observations", optical.ranked_observations(observations, region.limits))
    seasonal = store("clarity_seasonal_features", optical.seasonal_features(observations, region.periods))
    return {
        "optical_zones": zones, "clarity_observations": observations, "clarity_scenes": optical.scene_features(scenes, observations),
        "clarity_seasonal_features": seasonal, "clarity_features": optical.headline(seasonal, segments),
    }
