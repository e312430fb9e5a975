"""Depth along transects: sampling and features per segment."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_depth, close, number_label, resolution_class
from ..functions.stats import finite, holds, share, smallest_mode
from .raster import cells, resampled, snapped

# Near and far distances of gradients, slopes of a trend, depths and distances of shares, and screening classes.
GRADIENTS = ((100.0, 500.0), (250.0, 1000.0))
TREND = 0.0025
RAPID_DEPTH, RAPID_DISTANCE = 20.0, 250.0
SHALLOWER = ((5.0, 250.0), (10.0, 500.0))
CLASSES = ("insufficient", "background_only", "regional_screening", "coastal_context", "local_morphology_candidate")
QUALITY_FIELDS = (("quality_index", "quality_index"), ("observation_count", "observation_count"), ("depth_std_m", "depth_std"))


# Layers of a prepared depth grid by the name that a source's variables are given under.
DEPTH_LAYERS = {"mean_depth": "depth_mean_m", "minimum_depth": "depth_min_m", "maximum_depth": "depth_max_m", "standard_deviation": "depth_std_m"}
OTHER_LAYERS = {name: name for name in ("observation_count", "interpolation_flag", "source_reference", "quality_index")}


@dataclass(frozen=True)
class Depths:
    """What depth features ask for: distances, depths, the source's native resolution and limits."""

    targets: Sequence[float] = (100.0, 250.0, 500.0, 1000.0)
    contours: Sequence[float] = (5.0, 10.0, 20.0)
    native: float = 50.0
    gap: float = 200.0
    minimum_share: float = 0.6
    minimum_ratio: float = 1.0
    ceiling: str = "regional_screening"
    platform_distance: float = 500.0
    platform_depth: float = 10.0
    platform_share: float = 0.6
    source: Mapping[str, str] = field(default_factory=dict)


def is_continuous(layer: str) -> bool:
    """Whether a layer is interpolated when it is resampled; categories, flags and counts are not."""
    return layer in DEPTH_LAYERS.values()


def prepared_layers(source: DataFrame, variables: Mapping[str, str], sign: str = "positive_down", zero_is_valid: bool = True, nodata: float | None = None) -> DataFrame:
    """A source grid (row, col, variables) with its layers by their own names, null where there is no data: depths canonical, deviations from 0 on.

    variables names the source's column of each layer that it has.
    """
    names = DEPTH_LAYERS | OTHER_LAYERS
    unknown = sorted(set(variables) - set(names))
    if unknown or "mean_depth" not in variables:
        raise ValueError(f"unknown variables {unknown}" if unknown else "a source of depths has a mean_depth")
    missing = sorted(set(variables.values()) - set(source.columns))
    if missing:
        raise ValueError(f"absent variables {missing}; there are {source.columns}")

    def layer(name: str, column: str) -> Column:
        if name == "standard_deviation":
            value = finite(F.col(column).cast("double"))
            return F.when(value >= 0, value)
        if name in DEPTH_LAYERS:
            return canonical_depth(F.col(column).cast("double"), sign, zero_is_valid)
        return F.col(column) if nodata is None else F.when(F.col(column) != nodata, F.col(column))

    return source.select("row", "col", *[layer(n, c).alias(names[n]) for n, c in variables.items()])


def prepared_depth(
    source: DataFrame, variables: Mapping[str, str], corridor: tuple[float, float, float, float], native: float, left: float = 0.0, top: float = 0.0, resolution: float = 1.0,
    sign: str = "positive_down", zero_is_valid: bool = True, nodata: float | None = None,
) -> DataFrame:
    """All layers of a source on the grid of its native resolution over a corridor: row, col, x, y and the layers.

    The corridor is widened to whole cells.  Both grids have the same coordinates; left, top
    and resolution are the source's.
    """
    layers = prepared_layers(source, variables, sign, zero_is_valid, nodata)
    names = [c for c in layers.columns if c not in ("row", "col")]
    target = cells(source.sparkSession, snapped(corridor, native), native)
    return resampled(target, layers, [c for c in names if is_continuous(c)], [c for c in names if not is_continuous(c)], left, top, resolution)


def sample_distances(spacing: float, native: float, maximum: float, targets: Sequence[float]) -> list[float]:
    """The distances to sample, in order and once each: regular ones, no finer than the native resolution, the targets and the end."""
    step = max(spacing, native)
    regular = [round(i * step, 6) for i in range(math.floor((maximum + 0.01) / step) + 1)]
    return sorted({*(d for d in regular if d < maximum + 0.01), *map(float, targets), float(maximum)})


def search_distances(native: float, maximum: float) -> list[float]:
    """Where the first valid sample is looked for: every 25 m, or half the native resolution if that is less."""
    step = min(25.0, native / 2)
    return [i * step for i in range(math.floor((maximum + 0.01) / step) + 1) if i * step < maximum + 0.01]


def transect_status(first: DataFrame, native: float, gap: float, distance: str = "first_valid_distance_m") -> DataFrame:
    """Adds bathymetry_origin_status from the distance of the first valid sample."""
    d = F.col(distance)
    status = F.when(d.isNull(), "no_valid_bathymetry").when(d <= native / 2, "exact_or_near_coast").when(d > gap, "large_coastal_gap").otherwise("shifted_offshore")
    return first.withColumn("bathymetry_origin_status", status)


def _needed(depths: Depths) -> list[float]:
    return sorted({*depths.targets, depths.platform_distance})


def depth_profile(samples: DataFrame, depths: Depths, keys: Sequence[str] = ("segment_id", "transect_id"), distance: str = "distance_m", depth: str = "depth_m") -> DataFrame:
    """Per transect: depth at each target (d_100, ...) and the distance of the first sample as deep as each contour (c_5, ...)."""
    d, z = F.col(distance), F.col(depth)
    return samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.min(F.when(z.isNotNull(), d)).alias("first_valid_distance_m"),
        *[F.max(F.when(close(d, x), z)).alias(f"d_{number_label(x)}") for x in _needed(depths)],
        *[F.min(F.when(holds(z >= c), d)).alias(f"c_{number_label(c)}") for c in sorted({*depths.contours, RAPID_DEPTH})],
    )


def _quantile_columns(value: str | Column, names: Mapping[float, str]) -> Column:
    """An array of percentiles, one hash table for all of them."""
    return F.percentile(value, F.array(*map(F.lit, names)))


def sample_features(samples: DataFrame, reference: str = "source_reference", depth: str = "depth_m") -> DataFrame:
    """Per segment, over valid samples: shares of interpolated and measured cells, source references, and quantiles of the quality fields that there are."""
    valid = samples.where(F.col(depth).isNotNull())
    flag = F.col("interpolation_flag")
    there = [(f, n) for f, n in QUALITY_FIELDS if f in samples.columns]
    grouped = valid.groupBy("segment_id").agg(
        share(flag == 1, flag.isNotNull()).alias("interpolated_cell_share"),
        F.lit(None).cast("double").alias("extrapolated_cell_share"),
        share(flag == 0, flag.isNotNull()).alias("measured_or_source_supported_cell_share"),
        F.lit(1.0).alias("unknown_source_share"),
        *[_quantile_columns(finite(F.col(f)), {0.1: "", 0.5: "", 0.9: ""}).alias(f"_{n}") for f, n in there],
    )
    levels = [F.get(f"_{n}", F.lit(i)).alias(f"{n}_p{p}") for _, n in there for i, p in enumerate((10, 50, 90))]
    grouped = grouped.select("*", *levels).drop(*[f"_{n}" for _, n in there])
    return grouped.join(dominant_reference(valid, ["segment_id"], reference), "segment_id", "left")


def bathymetry_features(segments: DataFrame, profiles: DataFrame, depths: Depths, samples: DataFrame | None = None) -> DataFrame:
    """One row per segment from depth_profile rows: target depths, gradients, trends, contours, platform, screening class and quality; with samples, sample_features too.

    Segments without transects have counts and shares of 0 and the class `insufficient`.  A
    gradient needs both distances among the targets, both depths, and its near distance to be
    resolved.
    """
    rows = transect_status(profiles, depths.native, depths.gap)
    gradient = {}
    for near, far in GRADIENTS:
        a, b = number_label(near), number_label(far)
        known = {near, far} <= set(depths.targets) and near / depths.native >= depths.minimum_ratio
        value = (F.col(f"d_{b}") - F.col(f"d_{a}")) / (far - near) if known else F.lit(None).cast("double")
        gradient[f"g_{a}_{b}"] = value
    rows = rows.withColumns(gradient)
    trend = F.col("g_100_500")
    count = F.count(F.lit(1))
    over_all = lambda p: F.count_if(holds(p)) / count
    at = lambda x: F.col(f"d_{number_label(x)}")
    levels: dict[str, tuple[str, dict[float, str]]] = {"_first": ("first_valid_distance_m", {0.5: "bathymetry_first_valid_distance_p50_m", 0.9: "bathymetry_first_valid_distance_p90_m"})}
    for x in depths.targets:
        n = number_label(x)
        levels[f"_d{n}"] = (f"d_{n}", {p: f"depth_{n}m_p{round(100 * p)}_m" for p in (0.1, 0.5, 0.9)})
    for name in gradient:
        levels[f"_{name}"] = (name, {p: f"gradient_{name[2:]}m_p{round(100 * p)}" for p in (0.5, 0.9)})
    for c in depths.contours:
        n = number_label(c)
        levels[f"_c{n}"] = (f"c_{n}", {0.5: f"distance_to_{n}m_depth_p50_m"})
    aggregates = [
        count.alias("bathymetry_transect_count"),
        F.count_if(F.col("bathymetry_origin_status") != "no_valid_bathymetry").alias("bathymetry_valid_transect_count"),
        over_all(F.col("bathymetry_origin_status") == "large_coastal_gap").alias("bathymetry_large_coastal_gap_share"),
        *[_quantile_columns(value, names).alias(key) for key, (value, names) in levels.items()],
        *[over_all(at(x).isNotNull()).alias(f"depth_{number_label(x)}m_valid_transect_share") for x in depths.targets],
        *[over_all(F.col(f"c_{number_label(c)}").isNotNull()).alias(f"reaches_{number_label(c)}m_depth_transect_share") for c in depths.contours],
        share(trend > TREND, trend.isNotNull()).alias("deepening_transect_share"),
        share(trend < -TREND, trend.isNotNull()).alias("shoaling_transect_share"),
        share(F.abs(trend) <= TREND, trend.isNotNull()).alias("flat_or_uncertain_transect_share"),
        over_all(F.col(f"c_{number_label(RAPID_DEPTH)}") <= RAPID_DISTANCE).alias("rapid_deepening_to_20m_share"),
        share(at(depths.platform_distance) < depths.platform_depth, at(depths.platform_distance).isNotNull()).alias("_platform"),
        over_all(at(depths.platform_distance).isNotNull()).alias("_platform_valid"),
    ]
    for deep, x in SHALLOWER:
        known = share(at(x) < deep, at(x).isNotNull()) if x in depths.targets else F.lit(None).cast("double")
        aggregates.append(known.alias(f"depth_below_{number_label(deep)}m_at_{number_label(x)}m_share"))
    grouped = rows.groupBy("segment_id").agg(*aggregates)
    shown = [F.get(key, F.lit(i)).alias(name) for key, (_, names) in levels.items() for i, name in enumerate(names.values())]
    grouped = grouped.select("*", *shown).drop(*levels)
    out = segments.select("segment_id").join(grouped, "segment_id", "left")
    shares = [c for c in out.columns if c.endswith("_transect_share") and not c.startswith(("deepening", "shoaling", "flat"))]
    out = out.na.fill(0, ["bathymetry_transect_count", "bathymetry_valid_transect_count"]).na.fill(0.0, [*shares, "bathymetry_large_coastal_gap_share", "rapid_deepening_to_20m_share"])
    valid = F.coalesce(F.try_divide("bathymetry_valid_transect_count", "bathymetry_transect_count"), F.lit(0.0))
    platform = holds(F.col("_platform") >= depths.platform_share) & holds(F.col("_platform_valid") >= depths.minimum_share)
    out = out.withColumns({"bathymetry_valid_transect_share": valid, "broad_shallow_platform_proxy": platform}).drop("_platform", "_platform_valid")
    extra = {}
    for x in depths.targets:
        n = number_label(x)
        resolution = F.lit(x / depths.native)
        extra |= {f"depth_{n}m_resolution_ratio": resolution, f"depth_{n}m_resolution_class": resolution_class(resolution, depths.minimum_ratio)}
    extra |= {f"distance_to_{number_label(c)}m_depth_uncertainty_m": F.lit(float(depths.native)) for c in depths.contours}
    extra |= {name: F.lit(value) for name, value in depths.source.items()} | {"bathymetry_native_resolution_m": F.lit(float(depths.native))}
    out = out.withColumns(extra | screening(F.col("bathymetry_valid_transect_share"), depths))
    if samples is None:
        return out
    constants = {"survey_source_share": 0.0, "composite_dtm_source_share": 0.0, "satellite_derived_source_share": 0.0}
    out = out.join(sample_features(samples), "segment_id", "left").na.fill(0, ["bathymetry_source_reference_count"])
    fixed = {n: F.lit(v) for n, v in constants.items()} | {"global_fallback_source_share": F.lit(None).cast("double"), "bathymetry_dominant_source_type": F.lit("unknown")}
    return out.withColumns(fixed)


def screening(valid_share: Column, depths: Depths) -> dict[str, Column]:
    """Screening class (regional_screening, lowered to the ceiling, never raised), why (JSON), and a quality flag."""
    base = CLASSES[min(CLASSES.index("regional_screening"), CLASSES.index(depths.ceiling))]
    poor = ~holds(valid_share >= depths.minimum_share)
    lowered = [f"source_assessment_ceiling={depths.ceiling}"] if base != "regional_screening" else []
    shown = F.concat(F.lit("valid_transect_share="), F.regexp_replace(F.format_number(valid_share, 3), ",", ""))
    reasons = lambda last: F.concat(F.array(F.lit(f"native_resolution_m={depths.native:g}"), shown, F.lit("regional_proxy_not_site_safety_evidence")), F.array(*map(F.lit, last)).cast("array<string>"))
    flag = F.when(valid_share < 0.9, "partial").otherwise("usable_with_resolution_limits")
    return {
        "bathymetry_screening_class": F.when(poor, "insufficient").otherwise(base),
        "bathymetry_screening_reasons": F.to_json(F.when(poor, reasons(["below_minimum_valid_transect_share"])).otherwise(reasons(lowered))),
        "bathymetry_quality_flag": F.when(poor | F.lit(base == "insufficient"), "insufficient").otherwise(flag),
    }


def dominant_reference(samples: DataFrame, keys: Sequence[str], reference: str) -> DataFrame:
    """Per segment: how many source references there are, and the most frequent (the smallest of several)."""
    counts = samples.groupBy(*keys).agg(F.count_distinct(reference).alias("bathymetry_source_reference_count"))
    return counts.join(smallest_mode(samples, keys, reference, "bathymetry_dominant_source_reference"), list(keys), "left")


def source_audit(samples: DataFrame, reference: str, kind: str, valid: str) -> DataFrame:
    """Rows and valid rows per source reference and type; rows without a reference do not count."""
    known = samples.where(F.col(reference).isNotNull())
    return known.groupBy(reference, kind).agg(F.count(F.lit(1)).alias("sample_count"), F.count_if(holds(F.col(valid))).alias("valid_sample_count"))
