"""The metrics that a table of segments may show, and reports of those it has."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import finite


@dataclass(frozen=True)
class Metric:
    """A field, what it belongs to, and its unit; without a unit, a class or a flag."""

    field: str
    category: str
    unit: str | None


# Fields of segment tables by category and unit.
_FIELDS = {
    ("terrain", "m"): "land_relief_25m_p50_m land_relief_50m_p50_m land_relief_100m_p50_m land_relief_50m_p90_m land_relief_100m_p90_m distance_to_first_steep_sample_p50_m roughness_p90",
    ("terrain", "°"): "slope_p50_deg slope_p90_deg slope_max_deg",
    ("terrain", "share"): "steep_sample_share steep_nearshore_transect_share terrain_valid_sample_share",
    ("bathymetry", "m"): "bathymetry_first_valid_distance_p50_m bathymetry_first_valid_distance_p90_m depth_100m_p50_m depth_250m_p50_m depth_500m_p50_m depth_1000m_p50_m "
    "distance_to_5m_depth_p50_m distance_to_10m_depth_p50_m distance_to_20m_depth_p50_m distance_to_30m_depth_p50_m",
    ("bathymetry", "ratio"): "gradient_100_500m_p50 gradient_250_1000m_p50",
    ("bathymetry", "share"): "bathymetry_valid_transect_share interpolated_cell_share extrapolated_cell_share global_fallback_source_share survey_source_share",
    ("optical", "percentile"): "clarity_percentile_p50 clarity_percentile_p90",
    ("optical", "percentile points"): "clarity_variability_iqr",
    ("optical", "scenes"): "valid_scene_count",
    ("optical", "share"): "clear_water_observation_share turbid_water_observation_share clarity_persistence valid_observation_share bottom_visibility_proxy_share apparent_bottom_texture_persistence",
    ("optical", None): "clarity_data_confidence clarity_quality_flag",
    ("quality", None): "orientation_status terrain_quality_flag bathymetry_quality_flag bathymetry_screening_class orientation_source_mismatch_flag",
}
METRICS = tuple(Metric(field, category, unit) for (category, unit), fields in _FIELDS.items() for field in fields.split())


def available_metrics(df: DataFrame, bathymetry: bool = True) -> list[Metric]:
    """The metrics whose fields a table has; without those of depth if they are not wanted."""
    return [m for m in METRICS if m.field in df.columns and (bathymetry or m.category != "bathymetry")]


def metrics_by_category(df: DataFrame, bathymetry: bool = True) -> dict[str, list[Metric]]:
    """The same by category, in title case; categories without any are left out."""
    out: dict[str, list[Metric]] = {}
    for metric in available_metrics(df, bathymetry):
        out.setdefault(metric.category.title(), []).append(metric)
    return out


def metric_summary(df: DataFrame, bathymetry: bool = True) -> DataFrame:
    """One row per metric that a table has: category, field, unit, rows, known (finite or not null), least and most (null for classes and flags).  One aggregation."""
    there = available_metrics(df, bathymetry)
    if not there:
        return df.sparkSession.createDataFrame([], "category string, field string, unit string, rows long, known long, least double, most double")
    value = {m: F.col(m.field) if m.unit is None else finite(F.col(m.field).cast("double")) for m in there}
    bound = lambda m, f: F.lit(None).cast("double") if m.unit is None else f(value[m])
    measured = [F.struct(F.count(value[m]).alias("known"), bound(m, F.min).alias("least"), bound(m, F.max).alias("most")).alias(f"m{i}") for i, m in enumerate(there)]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *measured)
    rows = [
        F.struct(F.lit(m.category).alias("category"), F.lit(m.field).alias("field"), F.lit(m.unit).cast("string").alias("unit"), F.col("rows"), F.col(f"m{i}.known"), F.col(f"m{i}.least"), F.col(f"m{i}.most"))
        for i, m in enumerate(there)
    ]
    return one.select(F.inline(F.array(*rows)))
