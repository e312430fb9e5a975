"""Optical clarity: pixel masks, observations by scene and zone, and seasonal features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalised_difference, ratio
from ..functions.lineage import kept
from ..functions.stats import finite, holds, percentile_ranks, share, spread, value_numbers
from .raster import gradients

# Scene classes, and thresholds of the pixel tests.
CLOUD, SHADOW, CIRRUS, LAND = (8, 9), (2, 3), (10,), (0, 1, 4, 5, 11)
WATER_OVER_NIR, WATER_OVER_SWIR = 1.05, 1.15
DARK_SUM = 0.045
WHITE_GREEN, WHITE_SPREAD, WHITE_NIR = 0.12, 0.035, 0.04
GLINT_NIR, GLINT_SWIR, GLINT_RATIO = 0.06, 0.025, 0.45
# The masks, in the order in which the largest of equal shares is told.
MASKS = ("spectral_water", "cloud", "shadow", "cirrus", "land", "dark_shadow", "whitewater", "glint_risk", "invalid_input")
# Components and their directions; aliases of an observation's columns.
COMPONENTS = (("blue_green_ratio", 1), ("ndti", -1), ("nir_reflectance", -1))
ALIASES = {
    "zone_class": "zone_type", "blue_green_ratio_p50": "blue_green_ratio", "ndti_p50": "ndti", "nir_reflectance_p50": "nir_reflectance",
    "visible_texture_score": "apparent_texture_strength", "blue_green_clarity_percentile": "blue_green_ratio_clarity_percentile",
    "inverse_ndti_percentile": "ndti_clarity_percentile", "inverse_nir_percentile": "nir_reflectance_clarity_percentile",
    "clarity_proxy_percentile": "clarity_percentile", "clarity_component_count": "valid_clarity_component_count",
    "apparent_bottom_texture_valid": "apparent_bottom_texture_candidate",
}


@dataclass(frozen=True)
class Limits:
    """When an observation counts: least valid pixels and their share, greatest shares of what is masked, and what clarity asks for."""

    minimum_pixels: int = 5
    minimum_share: float = 0.2
    cloud: float = 0.5
    shadow: float = 0.35
    glint: float = 0.35
    land: float = 0.5
    whitewater: float = 0.35
    risk: float = 0.1
    minimum_population: int = 5
    minimum_components: int = 1
    clear: float = 75.0
    texture: float = 75.0


def pixel_masks(blue: Column, green: Column, red: Column, nir: Column, swir: Column, scene_class: Column, vector_land: Column | None = None) -> dict[str, Column]:
    """The mask columns of a pixel by name; unknown values are in no mask but invalid_input, and valid_water is water in no other mask."""
    bands = (blue, green, red, nir, swir)
    water = holds((green > WATER_OVER_NIR * nir) & (green > WATER_OVER_SWIR * swir))
    # Of unknown bands nothing is widest: greatest and least would pass over them.
    widest = F.when(blue.isNotNull() & green.isNotNull() & red.isNotNull(), F.greatest(blue, green, red) - F.least(blue, green, red))
    land = holds(scene_class.isin(*LAND))
    masks = {
        "spectral_water": water,
        "cloud": holds(scene_class.isin(*CLOUD)),
        "shadow": holds(scene_class.isin(*SHADOW)),
        "cirrus": holds(scene_class.isin(*CIRRUS)),
        "land": land if vector_land is None else land | holds(vector_land),
        "dark_shadow": water & holds(blue + green + red < DARK_SUM),
        "whitewater": water & holds((green > WHITE_GREEN) & (widest < WHITE_SPREAD) & (nir > WHITE_NIR)),
        "glint_risk": holds((green > swir) & (nir > GLINT_NIR) & (swir > GLINT_SWIR) & (F.try_divide(nir, green + 1e-6) > GLINT_RATIO)),
        "invalid_input": reduce(lambda a, b: a | b, (finite(x).isNull() for x in bands)),
    }
    masks["valid_water"] = reduce(lambda a, b: a & ~b, (masks[m] for m in MASKS[1:]), masks["spectral_water"])
    return masks


def texture_gradient(cells: DataFrame, keys: Sequence[str] = ("scene_id",), value: str = "green") -> DataFrame:
    """cells (keys, row, col, value and more) with `texture`, the length of the value's gradient per cell: central differences, one-sided at the rim.

    A cell without a value, or next to one within the grid, has none.
    """
    grid = gradients(cells.withColumn(value, finite(F.col(value))), keys, value)
    length = F.hypot(F.col("across"), F.col("down")).alias("texture")
    return cells.join(grid.select(*keys, "row", "col", length), [*keys, "row", "col"], "left")


def mask_shares(pixels: DataFrame, keys: Sequence[str], minimum_pixels: int = 1) -> DataFrame:
    """Per zone: zone_pixel_count, valid_pixel_count, water_pixel_count, the share of each mask, the components' medians over valid pixels, and why the zone is (not) valid.

    pixels has the bands blue, green, red, nir, swir1 and scene_classification, and may have
    `vector_land` (whether the pixel lies on land) and `texture`, whose median is then
    apparent_texture_strength.  The dominant mask of an invalid zone is the first of the
    largest, in mask order.
    """
    bands = [F.col(c) for c in ("blue", "green", "red", "nir", "swir1", "scene_classification")]
    land = F.col("vector_land") if "vector_land" in pixels.columns else None
    masked = pixels.withColumns({f"_{n}": c for n, c in pixel_masks(*bands, land).items()})
    valid = F.col("_valid_water")
    median = lambda x: F.percentile(F.when(valid, finite(x)), 0.5)
    texture = [median(F.col("texture")).alias("apparent_texture_strength")] if "texture" in pixels.columns else []
    grouped = masked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("zone_pixel_count"),
        F.count_if(valid).alias("valid_pixel_count"),
        F.count_if("_spectral_water").alias("water_pixel_count"),
        *[F.coalesce(share(F.col(f"_{n}")), F.lit(0.0)).alias(f"{n}_share") for n in (*MASKS, "valid_water")],
        median(ratio(F.col("blue"), F.col("green"))).alias("blue_green_ratio"),
        median(normalised_difference(F.col("red"), F.col("green"))).alias("ndti"),
        median(F.col("nir")).alias("nir_reflectance"),
        *texture,
    )
    return grouped.withColumn("validity_reason", validity_reason(minimum_pixels))


def validity_reason(minimum_pixels: int) -> Column:
    """valid, empty_zone, or that there are too few valid pixels and which mask holds most of the zone; of mask_shares' columns."""
    largest = F.greatest(*[F.col(f"{n}_share") for n in MASKS])
    dominant = F.coalesce(*[F.when(F.col(f"{n}_share") == largest, n) for n in MASKS])
    few = F.concat(F.lit("insufficient_valid_pixels:"), dominant)
    return F.when(F.coalesce("zone_pixel_count", F.lit(0)) == 0, "empty_zone").when(F.col("valid_pixel_count") >= minimum_pixels, "valid").otherwise(few)


def scene_observations(spine: DataFrame, pixels: DataFrame, keys: Sequence[str] = ("scene_id", "zone_id"), limits: Limits = Limits()) -> DataFrame:
    """One row per row of spine (a scene and a zone of it, with zone_status): counts, shares, risks, medians, and whether the observation is valid and why not.

    A zone whose status is not `valid` is an invalid observation for that reason, and nothing
    is measured.  Else reasons come in a fixed order: too few valid pixels (or none at all),
    cloud with cirrus, shadow with dark shadow, glint, land, whitewater, and last too small a
    share of valid pixels; the first one is invalid_reason, all are in
    observation_invalid_reasons.
    """
    measured = mask_shares(pixels, keys, limits.minimum_pixels)
    rows = spine.join(measured, list(keys), "left")
    usable = F.col("zone_status") == "valid"
    of = lambda name: F.coalesce(F.col(f"{name}_share"), F.lit(0.0))
    cloud, shadow = of("cloud") + of("cirrus"), of("shadow") + of("dark_shadow")
    valid_share = F.coalesce(F.try_divide(F.col("valid_pixel_count"), F.col("zone_pixel_count")), F.lit(0.0))
    base = F.coalesce("validity_reason", F.lit("empty_zone"))
    gates = (
        ("cloud_contaminated", cloud > limits.cloud), ("shadow_contaminated", shadow > limits.shadow), ("glint_contaminated", of("glint_risk") > limits.glint),
        ("land_contaminated", of("land") > limits.land), ("whitewater_contaminated", of("whitewater") > limits.whitewater),
    )
    small = (base == "valid") & (valid_share < limits.minimum_share)
    gated = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in gates]))
    too_few = F.when(base != "valid", F.array(base)).otherwise(F.array().cast("array<string>"))
    last = F.when(small, F.array(F.lit("insufficient_valid_pixel_share"))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("_reasons", F.concat(too_few, gated, last))
    ok = usable & (F.size("_reasons") == 0)
    # Too small a share goes before the gates where both hold.
    first = F.when(small, "insufficient_valid_pixel_share").otherwise(F.get("_reasons", F.lit(0)))
    only = lambda c: F.when(usable, c)
    columns = {
        "valid": ok,
        "invalid_reason": F.when(~usable, F.col("zone_status")).when(ok, "valid").otherwise(first),
        "observation_status": F.when(ok, "valid").otherwise("invalid"),
        "observation_invalid_reasons": F.when(~usable, F.col("zone_status")).otherwise(F.array_join("_reasons", ";")),
        "valid_pixel_count": F.when(usable, F.coalesce("valid_pixel_count", F.lit(0))).otherwise(0).cast("long"),
        "zone_pixel_count": F.when(usable, F.coalesce("zone_pixel_count", F.lit(0))).otherwise(0).cast("long"),
        "water_pixel_count": only(F.coalesce("water_pixel_count", F.lit(0))),
        "valid_pixel_share": F.when(usable, valid_share).otherwise(0.0),
        "water_mask_method": F.when(usable, "vector-land exclusion plus green/NIR/SWIR spectral validation v1").otherwise("not_evaluated"),
        "glint_method": F.when(usable, "NIR/SWIR risk exclusion v1").otherwise("not_evaluated"),
        "water_mask_valid_share": only(of("spectral_water")),
        "land_mixed_pixel_share": only(of("land")),
        "cloud_excluded_share": only(cloud),
        "cloud_excluded_pixel_share": only(of("cloud")),
        "cloud_shadow_excluded_pixel_share": only(of("shadow")),
        "cirrus_excluded_pixel_share": only(of("cirrus")),
        "invalid_excluded_pixel_share": only(of("invalid_input")),
        "shadow_excluded_share": only(shadow),
        "dark_shadow_excluded_pixel_share": only(of("dark_shadow")),
        "dark_shadow_risk": usable & (of("dark_shadow") > limits.risk),
        "glint_excluded_share": only(of("glint_risk")),
        "scene_glint_risk": usable & (of("glint_risk") > limits.risk),
        "land_excluded_share": only(of("land")),
        "land_excluded_pixel_share": only(of("land")),
        "whitewater_excluded_share": only(of("whitewater")),
        "whitewater_excluded_pixel_share": only(of("whitewater")),
        "whitewater_risk": usable & (of("whitewater") > limits.risk),
        **{name: only(F.col(name)) for name, _ in COMPONENTS},
        "apparent_texture_strength": only(F.col("apparent_texture_strength")) if "texture" in pixels.columns else F.lit(None).cast("double"),
    }
    return rows.select(*spine.columns, *[c.alias(n) for n, c in columns.items() if n not in spine.columns])


def ranked_observations(observations: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """scene_observations with percentiles among their scene and zone type, texture percentile and candidates, and the aliases.

    Observations with fewer components than clarity asks for are not valid.
    """
    rows = regional_percentiles(observations, minimum_population=limits.minimum_population, suffix="_clarity_percentile")
    rows = percentile_ranks(rows, ("scene_id", "zone_type"), (("apparent_texture_strength", 1),), suffix="_rank")
    candidate = (
        F.col("valid") & holds(F.col("clarity_percentile") >= limits.clear) & holds(F.col("apparent_texture_percentile") >= limits.texture)
        & holds(F.col("glint_excluded_share") <= limits.glint) & holds(F.col("whitewater_excluded_share") <= limits.whitewater)
    )
    rows = rows.withColumnRenamed("apparent_texture_strength_rank", "apparent_texture_percentile").withColumn("apparent_bottom_texture_candidate", candidate)
    poor = F.col("valid_clarity_component_count") < limits.minimum_components
    limited = poor & (F.col("invalid_reason") == "valid")
    rows = rows.withColumn("_limited", limited).withColumns(
        {
            "valid": F.col("valid") & ~poor,
            "clarity_percentile": F.when(~poor, F.col("clarity_percentile")),
            "invalid_reason": F.when(F.col("_limited"), "insufficient_regional_components").otherwise(F.col("invalid_reason")),
            "observation_status": F.when(F.col("_limited"), "invalid").otherwise(F.col("observation_status")),
            "observation_invalid_reasons": F.when(F.col("_limited"), "insufficient_components").otherwise(F.col("observation_invalid_reasons")),
        }
    )
    return aliased(rows.drop("_limited"), ALIASES)


def aliased(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """df with columns of further names for columns that it has."""
    return df.withColumns({alias: F.col(source) for alias, source in aliases.items()})


def regional_percentiles(observations: DataFrame, scene: str = "scene_id", groups: Sequence[str] = ("zone_type",), components: Sequence[tuple[str, int]] = COMPONENTS, minimum_population: int = 5, suffix: str = "_percentile") -> DataFrame:
    """Adds each component's percentile among its scene and group, how many there are, and their mean as clarity_percentile.

    Groups below the minimum population get none, groups of equal values 50.  Rows that are
    marked invalid take part in the ranking.
    """
    ranked = percentile_ranks(observations, (scene, *groups), components, suffix, minimum_population, 50.0)
    names = [f"{c}{suffix}" for c, _ in components]
    known = F.array_compact(F.array(*names))
    mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known))
    return ranked.withColumn("valid_clarity_component_count", F.size(known).cast("long")).withColumn("clarity_percentile", mean)


def scene_features(scenes: DataFrame, observations: DataFrame) -> DataFrame:
    """scenes (scene_id, selected and more) with their valid observations, distinct valid segments, whether glint is a risk in any observation, and a quality flag."""
    grouped = observations.groupBy("scene_id").agg(
        F.count_if(holds(F.col("valid"))).alias("scene_valid_observation_count"),
        F.count_distinct(F.when(F.col("valid"), F.col("segment_id"))).alias("scene_valid_segment_count"),
        F.bool_or(holds(F.col("scene_glint_risk"))).alias("scene_glint_risk"),
    )
    rows = scenes.join(grouped, "scene_id", "left").na.fill(0, ["scene_valid_observation_count", "scene_valid_segment_count"]).na.fill(False, ["scene_glint_risk"])
    flag = F.when(~holds(F.col("selected")), "not_selected").when(F.col("scene_valid_observation_count") == 0, "insufficient").when(F.col("scene_glint_risk"), "glint_limited").otherwise("usable")
    return rows.withColumn("scene_quality_flag", flag)


def confidence(scenes: Column, months: Column, years: Column, valid_share: Column, burden: Column, minimum_scenes: int = 12, minimum_months: int = 3) -> Column:
    """A struct of clarity_data_confidence, clarity_quality_flag and clarity_limitation_reasons (joined by `;`)."""
    tests = (
        ("too_few_valid_scenes", scenes < minimum_scenes),
        ("too_few_valid_months", months < minimum_months),
        ("single_year_only", years < 2),
        ("low_valid_observation_share", valid_share < 0.25),
        ("high_mask_burden", F.round(burden, 9) > 0.6),  # a mean of tenths is not to depend on the order of its sum
    )
    reasons = F.array_compact(F.array(*[F.when(holds(t), F.lit(n)) for n, t in tests]))
    n = F.size(reasons)
    strong = (scenes >= 2 * minimum_scenes) & (years >= 4) & (valid_share >= 0.6)
    level = F.when(scenes == 0, "insufficient").when(n >= 2, "low").when(n == 1, "medium").when(holds(strong), "high").otherwise("medium")
    flag = F.when(scenes == 0, "insufficient").when(n >= 1, "limited").otherwise("usable")
    return F.struct(level.alias("clarity_data_confidence"), flag.alias("clarity_quality_flag"), F.array_join(reasons, ";").alias("clarity_limitation_reasons"))


def _by_period(observations: DataFrame, periods: Mapping[str, Sequence[int]], value: str) -> DataFrame:
    """A row per observation and period of its month, with _valid and the _value of valid ones."""
    of_month = F.array_compact(F.array(*[F.when(F.col("month").isin(*months), F.lit(p)) for p, months in periods.items()])) if periods else F.array().cast("array<string>")
    valid = holds(F.col("valid")) & F.col(value).isNotNull()
    return observations.withColumn("period_id", F.explode(of_month)).withColumns({"_valid": valid, "_value": F.when(valid, F.col(value))})


def _clear_months(counts: DataFrame, keys: Sequence[str], clear: float) -> DataFrame:
    """The share of months (of a year) whose median is clear, from values with their numbers; months without a value do not count."""
    monthly = counts.groupBy(*keys, "year", "month").agg(F.percentile("_v", 0.5, F.col("_n")).alias("_median"))
    return monthly.groupBy(*keys).agg(share(F.col("_median") >= clear, F.col("_median").isNotNull()).alias("clarity_persistence"))


def persistence(observations: DataFrame, periods: Mapping[str, Sequence[int]], clear: float = 75.0, value: str = "clarity_percentile") -> DataFrame:
    """The clarity_persistence of `seasonal_features` alone, for the same rows: one pass over the observations, without what the other features take."""
    keys = ["segment_id", "zone_type", "period_id"]
    rows = _by_period(observations, periods, value).select(*keys, "year", "month", finite(F.col("_value")).alias("_v"))
    # Months without a value stay, so that every segment, zone and period does.
    return _clear_months(rows.groupBy(*keys, "year", "month", "_v").agg(F.count(F.lit(1)).alias("_n")), keys, clear)


def seasonal_features(
    observations: DataFrame, periods: Mapping[str, Sequence[int]], clear: float = 75.0, turbid: float = 25.0,
    minimum_scenes: int = 12, minimum_months: int = 3, value: str = "clarity_percentile",
    bottom_scenes: int = 8, bottom_share: float = 0.5,
) -> DataFrame:
    """One row per segment, zone and period with observations: counts, quantiles, spread, shares, persistence, burden and confidence.

    A month may be in several periods.  Quantiles and shares are of valid observations with
    a value; the burden is of all.  Persistence is the share of months (of a year) whose
    median is clear.  The periods are a literal array, joined by exploding it.  Bottom
    texture is told where observations say if theirs is repeatable.  Observations are computed once and kept.
    """
    keys = ["segment_id", "zone_type", "period_id"]
    excluded = [c for c in observations.columns if c.endswith("_excluded_share")]
    burden = F.least(F.lit(1.0), reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0.0)) for c in excluded), F.lit(0.0)))
    textures = {"candidate": "apparent_bottom_texture_candidate", "repeatable": "apparent_bottom_texture_repeatable"}
    used = {"segment_id", "zone_type", "scene_id", "year", "month", "valid", value, *excluded, *textures.values()}
    rows = _by_period(kept(observations.select(*[c for c in observations.columns if c in used])), periods, value).withColumn("_burden", burden)
    v, among = F.col("_value"), F.col("_valid")
    # Years and months are few; scenes are counted by a shuffle of their own.
    few = lambda c: F.size(F.collect_set(F.when(among, F.col(c)))).cast("long")
    main = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("candidate_observation_count"),
        F.count_distinct(F.when(among, F.col("scene_id"))).alias("valid_scene_count"),
        few("year").alias("valid_year_count"),
        few("month").alias("valid_month_count"),
        share(among).alias("valid_observation_share"),
        share(v >= clear, among).alias("clear_water_observation_share"),
        share(v <= turbid, among).alias("turbid_water_observation_share"),
        F.avg("_burden").alias("mean_mask_burden"),
        *[F.avg(c).alias(c) for c in excluded],
        *[F.percentile(c, 0.5).alias(c.removesuffix("_excluded_share") + "_exclusion_p50") for c in excluded],
        *[share(F.col(c), among).alias(f"_{n}") for n, c in textures.items() if c in observations.columns],
    )
    # One table of values and their numbers gives the months' medians, the quantiles and the spread.
    counts = value_numbers(rows, [*keys, "year", "month"], v)
    renamed = {"clarity_percentile_iqr": "clarity_variability_iqr", "clarity_percentile_mad": "clarity_variability_mad"}
    shape = spread(counts, keys, "clarity_percentile", {"p10": 0.1, "p90": 0.9}).withColumnsRenamed(renamed)
    out = main.join(shape, keys, "left").join(_clear_months(counts, keys, clear), keys, "left")
    made = confidence(F.col("valid_scene_count"), F.col("valid_month_count"), F.col("valid_year_count"), F.col("valid_observation_share"), F.col("mean_mask_burden"), minimum_scenes, minimum_months)
    out = out.withColumn("_c", made).select("*", "_c.*").drop("_c")
    return _with_bottom_texture(out, bottom_scenes, bottom_share) if set(textures.values()) & set(observations.columns) else out


def _with_bottom_texture(rows: DataFrame, scenes: int, least: float) -> DataFrame:
    """Shares and status of apparent bottom texture, from the shares of candidates or repeatable ones."""
    null = F.lit(None).cast("double")
    if "_repeatable" not in rows.columns:
        columns = {"apparent_bottom_texture_scene_share": F.col("_candidate"), "bottom_visibility_proxy_share": null, "apparent_bottom_texture_persistence": null}
        return rows.withColumns(columns | {"bottom_texture_status": F.lit("insufficient_repeatability_not_verified")}).drop("_candidate")
    enough = F.col("valid_scene_count") >= scenes
    status = F.when(enough & holds(F.col("_repeatable") >= least), "repeatable").when(enough, "unstable").otherwise("insufficient")
    rows = rows.withColumns({"apparent_bottom_texture_scene_share": F.col("_repeatable"), "bottom_texture_status": status})
    shown = F.when(F.col("bottom_texture_status") == "repeatable", F.col("_repeatable"))
    return rows.withColumns({"bottom_visibility_proxy_share": shown, "apparent_bottom_texture_persistence": shown}).drop("_candidate", "_repeatable")


def best_months(seasonal: DataFrame, months: Sequence[str] = ("may", "june", "july", "august", "september")) -> DataFrame:
    """Per segment: the month of the highest median and that of the most valid scenes; ties go to the first by name.  Segments without any keep null."""
    usable = F.col("period_id").isin(*months) & F.col("clarity_percentile_p50").isNotNull()
    first = lambda order: F.min_by(F.when(usable, F.col("period_id")), F.when(usable, F.struct(order, F.col("period_id"))))
    return seasonal.groupBy("segment_id").agg(first(-F.col("clarity_percentile_p50")).alias("best_month"), first(-F.col("valid_scene_count")).alias("most_reliable_month"))


def headline(seasonal: DataFrame, segments: DataFrame, period: str = "extended", summer: str = "summer_jja", zone: str | None = None) -> DataFrame:
    """Every segment, with the features of one period (and zone), the summer median, the best months, and `insufficient` where there are none."""
    chosen = seasonal if zone is None else seasonal.where(F.col("zone_type") == zone)
    pick = lambda p, c, name: F.max(F.when(F.col("period_id") == p, F.col(c))).alias(name)
    main = chosen.groupBy("segment_id").agg(
        pick(period, "clarity_percentile_p50", "clarity_percentile_p50"),
        pick(period, "valid_scene_count", "valid_scene_count"),
        pick(period, "clarity_quality_flag", "clarity_quality_flag"),
        pick(summer, "clarity_percentile_p50", "clarity_summer_p50"),
    )
    joined = segments.select("segment_id").distinct().join(main, "segment_id", "left").join(best_months(seasonal), "segment_id", "left")
    return joined.withColumn("clarity_quality_flag", F.coalesce("clarity_quality_flag", F.lit("insufficient")))


def pair_repeatability(pixels: DataFrame, segment: str = "segment_id", scene: str = "scene_id", cell: Sequence[str] = ("row", "col"), value: str = "value", minimum: int = 9, least: float = 0.35) -> DataFrame:
    """Per segment: pairs of scenes with enough common pixels, the share correlated at `least` or more, and a status.

    Scenes meet by an equality join on the cell; pairs are sums, not rows, after it.
    """
    rows = pixels.where(F.col(value).isNotNull()).select(segment, *cell, F.col(scene).alias("_s"), F.col(value).cast("double").alias("_v"))
    other = rows.select(segment, *cell, F.col("_s").alias("_t"), F.col("_v").alias("_w"))
    pairs = rows.join(other, [segment, *cell]).where("_s < _t").groupBy(segment, "_s", "_t")
    found = pairs.agg(F.count(F.lit(1)).alias("n"), F.corr("_v", "_w").alias("r"), F.stddev_pop("_v").alias("sv"), F.stddev_pop("_w").alias("sw"))
    usable = found.where((F.col("n") >= minimum) & (F.col("sv") > 0) & (F.col("sw") > 0))
    out = usable.groupBy(segment).agg(F.count(F.lit(1)).alias("pair_count"), share(F.col("r") >= least).alias("texture_persistence"), F.percentile("r", 0.5).alias("correlation_p50"))
    status = F.when(F.col("texture_persistence") >= 0.5, "repeatable").otherwise("unstable")
    spine = pixels.select(segment).distinct()
    return spine.join(out, segment, "left").withColumns({"pair_count": F.coalesce("pair_count", F.lit(0)).cast("long"), "texture_status": F.when(F.col("pair_count").isNull(), "insufficient").otherwise(status)})


def attach_period(features: DataFrame, seasonal: DataFrame, period: str, zone: str) -> DataFrame:
    """features with the columns that a period's rows have too replaced by them (by segment); features without such rows get null."""
    chosen = seasonal.where((F.col("period_id") == period) & (F.col("zone_type") == zone)).drop("zone_type")
    kept = [c for c in features.columns if c == "segment_id" or c not in chosen.columns]
    return features.select(*kept).join(chosen, "segment_id", "left")
