"""Operators on small tables with known answers."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geometry as G
from tidemark.operators import bathymetry, catalogue, coast, filters, joins, optical, quality, raster, terrain
from tidemark.plans.phases import Region, bathymetry_phase, clarity_phase, folder_store, terrain_phase
from tidemark.sources import readers, writers


def line_table(spark, *lines):
    rows = [(f"part_{i}", [{"x": float(x), "y": float(y)} for x, y in line]) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "coastline_part_id string, line array<struct<x:double,y:double>>")


def breaks(spark, length, target=250.0, minimum=75.0):
    return spark.range(1).select(coast.segment_breaks(F.lit(float(length)), target, minimum).alias("b")).first()["b"]


@pytest.mark.parametrize(("length", "pieces", "size"), [(1000, 4, 250.0), (1050, 4, 262.5), (200, 1, 200.0), (1100, 5, None)])
def test_segment_breaks(spark, length, pieces, size):
    found = np.diff(breaks(spark, length))
    assert len(found) == pieces and abs(found.sum() - length) < 1e-9
    if size:
        assert np.allclose(found, size)


def test_segments_conserve_length_and_have_stable_ids(spark):
    parts = line_table(spark, [(0, 0), (100, 100), (250, 100), (400, 0)])
    got = coast.segments(parts, "isle", 100.0, 30.0)
    rows = got.orderBy("segment_id").collect()
    assert abs(sum(r["segment_length_m"] for r in rows) - parts.select(G.length(F.col("line"))).first()[0]) < 1e-9
    assert rows[0]["segment_id"] == "isle_v1_part_0_00001"
    assert [r["segment_id"] for r in coast.segments(parts, "isle", 100.0, 30.0).orderBy("segment_id").collect()] == [r["segment_id"] for r in rows]


def orient(spark, land, line=((0, 0), (100, 0)), **options):
    return coast.oriented(coast.segments(line_table(spark, line), "r"), G.ring_edges(land), **options).first()


def test_orientation(spark):
    above, below = [(-10, 0), (110, 0), (110, 50), (-10, 50)], [(-10, -50), (110, -50), (110, 0), (-10, 0)]
    assert orient(spark, above)["landward_bearing_deg"] == 0.0
    assert orient(spark, below)["landward_bearing_deg"] == 180.0
    both = orient(spark, [(-10, -50), (110, -50), (110, 50), (-10, 50)], distances=(10.0, 20.0))
    assert (both["orientation_status"], both["landward_bearing_deg"], both["orientation_attempts"]) == ("ambiguous", None, [10.0, 20.0])
    far = orient(spark, [(-10, 20), (110, 20), (110, 80), (-10, 80)], distances=(10.0, 40.0))
    assert far["orientation_status"] == "resolved_fallback"
    notch = [(-10, 0), (45, 0), (45, 50), (55, 50), (55, 0), (110, 0), (110, 60), (-10, 60)]
    votes = orient(spark, notch, distances=(10.0,), offsets=(-30.0, 0.0, 30.0))
    assert (votes["orientation_status"], votes["orientation_vote_count_landward"]) == ("resolved", 2)


def test_transects(spark):
    land = G.ring_edges([(-10, 0), (110, 0), (110, 50), (-10, 50)])
    segments = coast.oriented(coast.segments(line_table(spark, [(0, 0), (100, 0)]), "r"), land)
    rows = coast.transects(segments, 25.0, 100.0, 200.0).collect()
    assert len(rows) == 10
    assert {r["direction"]: round(r["line"][1]["y"], 9) for r in rows} == {"inland": 100.0, "offshore": -200.0}
    ambiguous = segments.withColumn("landward_bearing_deg", F.lit(None).cast("double"))
    empty = coast.transects(ambiguous)
    assert empty.count() == 0 and "transect_id" in empty.columns


def test_covered_points_equals_fixed_edges(spark):
    rng = np.random.default_rng(5)
    ring = [(0.0, 0.0), (10.0, 1.0), (12.0, 9.0), (5.0, 5.0), (1.0, 11.0)]
    points = spark.createDataFrame([(i, (float(x), float(y))) for i, (x, y) in enumerate([*rng.uniform(-2, 14, (300, 2)), (0, 0), (5, 0.5)])], "id int, p struct<x:double,y:double>")
    edges = spark.createDataFrame(G.ring_edges(ring), "x1 double, y1 double, x2 double, y2 double")
    a = {r["id"]: r["covered"] for r in coast.covered_points(points, "id", edges, 2.0).collect()}
    b = {r["id"]: r["c"] for r in points.select("id", G.covered_by(F.col("p"), G.ring_edges(ring)).alias("c")).collect()}
    assert a == b and a[300] and a[301]


def test_simplify_and_clean(spark):
    parts = line_table(spark, [(0, 0), (50, 0.1), (100, 0)], [(3, 3), (3, 3)])
    rows = coast.cleaned(parts, 1.0).collect()
    assert len(rows) == 1 and len(rows[0]["line"]) == 2


def cells(spark, array):
    return spark.createDataFrame([(r, c, None if np.isnan(v) else float(v)) for (r, c), v in np.ndenumerate(np.asarray(array, float))], "row long, col long, value double")


def as_array(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[name] is None else r[name]
    return out


def test_slope_equals_numpy(spark):
    a = np.random.default_rng(1).normal(size=(9, 12))
    a[4, 4] = np.nan
    gy, gx = np.gradient(a, 2.0)
    assert np.allclose(as_array(raster.slope(cells(spark, a), resolution=2.0), "slope_deg", a.shape), np.degrees(np.arctan(np.hypot(gx, gy))) + 0 * a, equal_nan=True)
    ramp = np.add.outer(np.zeros(20), np.arange(20.0))
    assert np.nanmedian(as_array(raster.slope(cells(spark, ramp)), "slope_deg", ramp.shape)) == pytest.approx(45)


def test_roughness_equals_numpy(spark):
    a = np.random.default_rng(2).normal(size=(8, 9))
    a[2, 3] = np.nan
    expected = np.array([[np.nan if np.isnan(a[r, c]) else np.nanstd(a[max(0, r - 1) : r + 2, max(0, c - 1) : c + 2]) for c in range(9)] for r in range(8)])
    assert np.allclose(as_array(raster.roughness(cells(spark, a)), "roughness", a.shape), expected, equal_nan=True)
    assert as_array(raster.roughness(cells(spark, np.ones((5, 5)))), "roughness", (5, 5)).max() == 0
    assert raster.window_radius(15, 5) == 1 and raster.window_radius(30, 5) == 3


def test_mosaic_and_sampling(spark):
    tiles = cells(spark, [[10.0, np.nan]]).withColumn("path", F.lit("a")).union(cells(spark, [[20.0, 20.0]]).withColumn("path", F.lit("b")))
    assert as_array(raster.mosaic(tiles), "value", (1, 2)).tolist() == [[10.0, 20.0]]
    grid = cells(spark, [[0.0, 10.0], [20.0, 30.0]])
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.5, 1.5), (3, 9.0, 9.0), (4, 0.2, 1.9)], "id int, x double, y double")
    got = {r["id"]: r["sample"] for r in raster.bilinear(points, grid, "id", 0.0, 2.0).collect()}
    assert got == {1: 15.0, 2: 0.0, 3: None, 4: None}
    assert {r["id"]: r["sample"] for r in raster.nearest(points, grid, 0.0, 2.0).collect()} == {1: 30.0, 2: 0.0, 3: None, 4: 0.0}


@pytest.mark.parametrize(("z", "expected"), [([7, 8, 9], ("exact", 0.0, 7.0)), ([None, None, 9, 10], ("shifted_inland", 2.0, 9.0)), ([None] * 6, ("unavailable", None, None)), ([None] * 5 + [3], ("unavailable", None, None))])
def test_origins(spark, z, expected):
    df = spark.createDataFrame([("t", float(i), None if v is None else float(v)) for i, v in enumerate(z)], "t string, d double, z double")
    r = terrain.first_valid(df, ["t"], "d", "z", 3.0).first()
    assert (r["origin_method"], r["origin_distance"], r["origin_value"]) == expected


def terrain_rows(spark, missing=()):
    rows = [("s", t, float(d), None if i in missing else float(d), None if i in missing else 45.0, 1.0) for i, (t, d) in enumerate((t, d) for t in ("t1", "t2") for d in (0, 25, 50))]
    df = spark.createDataFrame(rows, "segment_id string, transect_id string, sample_distance_m double, elevation_m double, slope_deg double, roughness double")
    segments = spark.createDataFrame([("s", "resolved"), ("none", "resolved"), ("amb", "ambiguous")], "segment_id string, orientation_status string")
    return {r["segment_id"]: r for r in terrain.terrain_features(segments, terrain.with_origins(df, search=30.0), (25, 50), 5.0, 35.0, 0.8).collect()}


def test_terrain_features(spark):
    rows = terrain_rows(spark)
    s = rows["s"]
    assert (s["land_relief_25m_p50_m"], s["land_relief_50m_p90_m"], s["steep_sample_share"], s["distance_to_first_steep_sample_p50_m"]) == (25.0, 50.0, 1.0, 0.0)
    assert s["terrain_quality_flag"] == "good" and rows["none"]["terrain_quality_flag"] == "outside_dem" and rows["amb"]["terrain_quality_flag"] == "orientation_unresolved"
    assert rows["none"]["terrain_sample_count"] == 0 and rows["none"]["slope_p50_deg"] is None


def test_missing_terrain_is_not_zero(spark):
    s = terrain_rows(spark, (1, 2))["s"]
    assert s["terrain_valid_sample_share"] == pytest.approx(4 / 6) and s["terrain_quality_flag"] == "partial" and s["land_relief_25m_p50_m"] is not None


def test_bathymetry_features(spark):
    rows = [("s", t, float(d), 5 + 0.05 * d) for t in ("t1", "t2") for d in (0, 100, 250, 500)]
    samples = spark.createDataFrame(rows, "segment_id string, transect_id string, distance_m double, depth_m double")
    segments = spark.createDataFrame([("s",), ("none",)], "segment_id string")
    depths = bathymetry.Depths(targets=(100, 250, 500), platform_depth=31)
    with_flags = samples.withColumns({"interpolation_flag": (F.col("distance_m") > 200).cast("int"), "source_reference": F.lit(3)})
    got = {r["segment_id"]: r for r in bathymetry.bathymetry_features(segments, bathymetry.depth_profile(samples, depths), depths, with_flags).collect()}
    assert got["s"]["broad_shallow_platform_proxy"] and got["s"]["interpolated_cell_share"] == 0.5 and got["s"]["gradient_250_1000m_p50"] is None
    assert got["s"]["depth_below_10m_at_500m_share"] == 0 and got["none"]["bathymetry_source_reference_count"] == 0
    assert bathymetry.sample_distances(25.0, 60.0, 200.0, (100,)) == [0.0, 60.0, 100.0, 120.0, 180.0, 200.0]
    assert bathymetry.search_distances(30.0, 45.0) == [0.0, 15.0, 30.0, 45.0]
    s = got["s"]
    assert s["gradient_100_500m_p50"] == pytest.approx(0.05) and s["distance_to_20m_depth_p50_m"] == 500 and s["bathymetry_valid_transect_share"] == 1 and s["deepening_transect_share"] == 1
    assert got["none"]["bathymetry_screening_class"] == "insufficient" and got["none"]["bathymetry_transect_count"] == 0 and got["none"]["depth_100m_valid_transect_share"] == 0


def test_pixel_masks(spark):
    rows = [
        ("cloud", 0.1, 0.2, 0.05, 0.05, 0.02, 9), ("shadow", 0.1, 0.2, 0.05, 0.05, 0.02, 3), ("land", 0.1, 0.2, 0.05, 0.05, 0.02, 4), ("glint_risk", 0.1, 0.2, 0.1, 0.15, 0.05, 6),
        ("whitewater", 0.2, 0.2, 0.2, 0.05, 0.02, 6), ("dark_shadow", 0.01, 0.015, 0.01, 0.005, 0.002, 6), ("valid_water", 0.1, 0.2, 0.05, 0.02, 0.01, 6), ("invalid_input", None, 0.2, None, 0.02, 0.01, 6),
    ]
    df = spark.createDataFrame(rows, "k string, blue double, green double, red double, nir double, swir double, scl int")
    masks = optical.pixel_masks(*[F.col(c) for c in ("blue", "green", "red", "nir", "swir", "scl")])
    for r in df.select("k", *[c.alias(n) for n, c in masks.items()]).collect():
        assert r[r["k"]], r
        assert r["valid_water"] == (r["k"] == "valid_water")
    on_land = optical.pixel_masks(*[F.col(c) for c in ("blue", "green", "red", "nir", "swir", "scl")], F.lit(True))
    assert df.where(on_land["valid_water"]).count() == 0 and df.where(on_land["land"]).count() == len(rows)


def test_observations_and_their_gates(spark):
    good, cloud, few = (0.1, 0.2, 0.05, 0.02, 0.01, 6), (0.1, 0.2, 0.05, 0.02, 0.01, 9), (0.2, 0.1, 0.05, 0.02, 0.2, 6)
    zones = {"a": [good] * 10, "b": [good] * 6 + [cloud] * 14, "c": [good] * 2 + [few] * 8, "d": [good] * 10, "f": [good] * 6 + [few] * 60}
    rows = [("s", z, *p) for z, pixels in zones.items() for p in pixels]
    pixels = spark.createDataFrame(rows, "scene_id string, zone_id string, blue double, green double, red double, nir double, swir1 double, scene_classification int")
    spine = spark.createDataFrame([("s", z, "nearshore", "empty_after_land_exclusion" if z == "d" else "valid") for z in "abcdef"], "scene_id string, zone_id string, zone_type string, zone_status string")
    got = {r["zone_id"]: r for r in optical.scene_observations(spine, pixels).collect()}
    reasons = {z: (r["valid"], r["invalid_reason"], r["observation_invalid_reasons"]) for z, r in got.items()}
    assert reasons == {
        "a": (True, "valid", ""),
        "b": (False, "cloud_contaminated", "cloud_contaminated"),
        "c": (False, "insufficient_valid_pixels:spectral_water", "insufficient_valid_pixels:spectral_water"),
        "d": (False, "empty_after_land_exclusion", "empty_after_land_exclusion"),
        "e": (False, "empty_zone", "empty_zone"),
        "f": (False, "insufficient_valid_pixel_share", "insufficient_valid_pixel_share"),
    }
    assert got["b"]["cloud_excluded_share"] == 0.7 and got["d"]["cloud_excluded_share"] is None and got["d"]["water_mask_method"] == "not_evaluated"


def test_texture_is_a_gradient(spark):
    image = np.random.default_rng(2).normal(size=(6, 7))
    image[2, 3] = np.nan
    down, across = np.gradient(image)
    df = spark.createDataFrame([("s", r, c, float(v)) for (r, c), v in np.ndenumerate(image)], "scene_id string, row int, col int, green double")
    got = {(r["row"], r["col"]): r["texture"] for r in optical.texture_gradient(df).collect()}
    for at, length in np.ndenumerate(np.hypot(down, across)):
        assert got[at] is None if np.isnan(length) else got[at] == pytest.approx(length)


def seasonal(spark, rows, **options):
    df = spark.createDataFrame(rows, "segment_id string, zone_type string, scene_id string, year long, month long, clarity_percentile double, valid boolean, glint_excluded_share double")
    return optical.seasonal_features(df, {"extended": (5, 6, 7, 8, 9), "june": (6,), "july": (7,)}, **options)


def test_persistence_is_that_of_all_features_and_ranks_are_taken_once(spark):
    """Also of segments and months without a valid observation."""
    pick = random.Random(8)
    rows = [(f"s{pick.randint(0, 5)}", "z", f"{y}Q{m}", y, m, pick.choice([True, True, False, None]), pick.choice([None, 10.0, 74.0, 75.0, 90.0])) for y in (2001, 2002) for m in range(4, 11) for _ in range(12)]
    rows += [("never", "z", "2001Q5", 2001, 5, False, 80.0), ("winter", "z", "2001Q1", 2001, 1, True, 80.0)]
    looked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            looked.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "segment_id string, zone_type string, scene_id string, year long, month long, valid boolean, clarity_percentile double").withColumn("glint_excluded_share", F.lit(0.1))
    df = df.mapInArrow(counted, df.schema)
    periods = {"extended": (5, 6, 7, 8, 9), "june": (6,)}
    pairs = lambda out: {tuple(r) for r in out.select("segment_id", "period_id", "clarity_persistence").collect()}
    whole = pairs(optical.seasonal_features(df, periods))
    assert looked.value == len(rows)
    assert pairs(optical.persistence(df, periods)) == whole and ("never", "extended", None) in whole
    assert looked.value == 2 * len(rows)


def test_seasonal_features(spark):
    rows = [("s", "nearshore", f"s{i}", 2020 + i % 3, 6 if i % 2 else 7, 90.0 if i % 2 else 10.0, True, None) for i in range(6)]
    got = {r["period_id"]: r for r in seasonal(spark, rows).collect()}
    e = got["extended"]
    assert (e["valid_scene_count"], e["valid_year_count"], e["clear_water_observation_share"], e["clarity_data_confidence"]) == (6, 3, 0.5, "low")
    best = optical.best_months(seasonal(spark, rows)).first()
    assert best["best_month"] == "june"


def test_persistence_is_of_months(spark):
    rows = [("s", "z", f"s{i}", 2020, 6, 90.0, True, 0.1) for i in range(4)] + [("s", "z", "s9", 2020, 7, 10.0, True, 0.1)]
    e = {r["period_id"]: r for r in seasonal(spark, rows).collect()}["extended"]
    assert (e["clear_water_observation_share"], e["clarity_persistence"], round(e["clarity_percentile_p10"], 9), e["clarity_variability_mad"]) == (0.8, 0.5, 42.0, 0.0)


def test_no_periods_is_an_empty_table(spark):
    df = spark.createDataFrame([], "segment_id string, zone_type string, scene_id string, year long, month long, clarity_percentile double, valid boolean, glint_excluded_share double")
    assert optical.seasonal_features(df, {}).count() == 0


def test_texture_repeatability(spark):
    base = np.random.default_rng(4).normal(size=(5, 5))
    rows = [(seg, scene, r, c, float(v)) for seg, images in {"same": (base, 2 * base + 1), "one": (base,)}.items() for scene, image in enumerate(images) for (r, c), v in np.ndenumerate(image)]
    got = {r["segment_id"]: r["texture_status"] for r in optical.pair_repeatability(spark.createDataFrame(rows, "segment_id string, scene_id int, row int, col int, value double")).collect()}
    assert got == {"same": "repeatable", "one": "insufficient"}


def test_scene_selection(spark):
    rows = [("old", "g", "05.09", 1), ("new", "g", "05.11", 1), ("bare", "h", "05.11", 0), ("late", "k", "05.11", 1)]
    df = spark.createDataFrame(rows, "id string, g string, v string, assets int")
    from tidemark.functions.scalars import version_key

    got = catalogue.select_scenes(df, [("missing_required_asset", F.col("assets") == 0)], "g", (version_key(F.col("v")).desc(), F.col("id")), (F.col("id"),), 1)
    assert {r["id"]: r["selection_reason"] for r in got.collect()} == {"old": "duplicate_lower_preference", "new": "maximum_items_limit", "bare": "missing_required_asset", "late": "candidate"}


def test_filters_with_missing_columns_and_values(spark):
    df = spark.createDataFrame([("A_x", 1.0, True), ("b", None, None), ("c", 3.0, False)], "id string, v double, f boolean")
    ids = lambda wanted: [r["id"] for r in filters.filtered(df, wanted).orderBy("id").collect()]
    assert ids(filters.Filters(ranges={"v": (None, None)})) == ["A_x", "b", "c"]
    assert ids(filters.Filters(ranges={"v": (1, None)})) == ["A_x", "c"]
    assert ids(filters.Filters(ranges={"absent": (1, None)})) == []
    assert ids(filters.Filters(flags={"f": False})) == ["b", "c"]
    assert ids(filters.Filters(flags={"absent": True})) == []
    assert ids(filters.Filters(availability={"v": "missing"})) == ["b"]
    assert ids(filters.Filters(search=("id", " a_ "))) == ["A_x"]
    with pytest.raises(ValueError):
        filters.AttributeFilter("id")
    with pytest.raises(ValueError, match="there are"):
        filters.attribute_filtered(df, [filters.AttributeFilter("nope", ("x",))])


def test_joins_hold_their_contracts(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(joins.ContractError):
        joins.one_to_one(a, b, ["k"])
    with pytest.raises(Exception, match="repeats"):
        joins.one_to_one_checked(a, b, ["k"]).collect()
    assert {tuple(r) for r in joins.key_differences(a, b, ["k"]).collect()} == {(2, "missing")}
    with pytest.raises(joins.ContractError):
        joins.same_keys(a, b.limit(1), ["k"])


def test_reports(spark):
    df = spark.createDataFrame([(1.0, "resolved"), (None, "ambiguous")], "segment_length_m double, orientation_status string")
    report = quality.report(df, quality.segment_checks(1, 10))
    assert {r["check"]: r["passed"] for r in report.collect()} == {"segments_nonempty_positive": False, "segment_length_bounds": True, "short_segments": True, "orientation_ambiguous_share": False, "orientation_fallback_count": True}
    with pytest.raises(quality.QualityError):
        quality.require_passed(report)


def test_zone_membership(spark):
    seaward = spark.createDataFrame([("s", [(0.0, 0.0)], 90.0)], "segment_id string, line array<struct<x:double,y:double>>, bearing_deg double")
    points = spark.createDataFrame([(1, (50.0, 10.0)), (2, (150.0, -40.0)), (3, (50.0, 60.0)), (4, (-50.0, 0.0))], "id int, p struct<x:double,y:double>")
    got = {(r["id"], r["zone_id"]) for r in coast.zone_membership(points, "id", coast.zone_strips(seaward), 30.0).collect()}
    assert got == {(1, "s_nearshore"), (2, "s_coastal")}


def shuffled_rows(spark):
    """How many rows the session has written to shuffles so far."""
    jvm = spark.sparkContext._jvm
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum({stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}.values())


def test_zone_membership_shuffles_no_results(spark, monkeypatch):
    monkeypatch.setattr(coast, "POINTS_PER_BLOCK", 64, raising=False)
    seaward = spark.createDataFrame([(f"s{i}", [(0.0, float(i % 7))], 90.0) for i in range(300)], "segment_id string, line array<struct<x:double,y:double>>, bearing_deg double")
    points = spark.createDataFrame([(i, (50.0 + i / 100, i / 100)) for i in range(400)], "id int, p struct<x:double,y:double>")
    before = shuffled_rows(spark)
    found = coast.zone_membership(points, "id", coast.zone_strips(seaward, (("z", 20, 100),)), 50.0).select("id", "zone_id").collect()
    assert len(found) == len(set(found)) == 300 * 400
    assert shuffled_rows(spark) - before < 300 * 400 / 4


def test_zone_membership_names_a_pair_once(spark):
    """Zones of several strips, keys of several points, and nulls."""
    line = "segment_id string, line array<struct<x:double,y:double>>, bearing_deg double"
    strips = coast.zone_strips(spark.createDataFrame([("s", [(0.0, float(y))], 90.0) for y in (0, 30, 60, 400)], line), (("z", 0, 100),))
    points = spark.createDataFrame([(1, (50.0, 20.0)), (2, (5.0, 5.0)), (2, (95.0, 60.0)), (2, (95.0, 60.0)), (None, (50.0, 20.0)), (3, None), (4, (50.0, 200.0))], "id int, p struct<x:double,y:double>")
    got = [(r["id"], r["zone_id"]) for r in coast.zone_membership(points, "id", strips, 30.0).collect()]
    assert sorted(got, key=str) == [(1, "s_z"), (2, "s_z"), (None, "s_z")]


def test_geojson_and_writers(spark, tmp_path):
    features = [
        {"type": "Feature", "id": "a", "properties": {"class": "high"}, "geometry": {"type": "MultiLineString", "coordinates": [[[10, 0], [50, 1]], [[50, 1], [90, 2]]]}},
        {"type": "Feature", "id": "b", "properties": {"class": "low"}, "geometry": {"type": "LineString", "coordinates": [[10, 0.5], [50, 0]]}},
        {"type": "Feature", "id": "c", "properties": {"class": "high"}, "geometry": {"type": "LineString", "coordinates": [[10, 400], [50, 400]]}},
        {"type": "Feature", "id": "d", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
    ]
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    table = readers.geojson(spark, str(tmp_path / "f.geojson"))
    got = readers.direct_coastline(table, [filters.AttributeFilter("class", ("high",))], (10, -10, 90, 20))
    assert sorted((r["part_key"], r["duplicate_suspect"]) for r in got.collect()) == [("a_0", True), ("a_1", False)]
    rings = readers.polygons_of(table)
    parts = coast.rings_to_parts(rings, "isle")
    assert [(r["coastline_part_id"], len(r["line"])) for r in parts.collect()] == [("isle_part_0001", 3)]
    writers.csv_export(got.select("part_key", F.lit(1.0).alias("depth_10m"), "line"), str(tmp_path / "csv"))
    assert readers.text_table(spark, str(tmp_path / "csv")).columns == ["part_key", "regional_proxy__depth_10m"]
    writers.sorted_parquet(got.select("part_key"), str(tmp_path / "p"))
    first = writers.manifest(spark.read.parquet(str(tmp_path / "p")), "part_key", stage=1)
    writers.assert_unchanged(first, writers.manifest(got, "part_key"))


def test_phases_on_a_rectangular_island(spark, tmp_path):
    ring = [(0.0, 0.0), (1000.0, 0.0), (1000.0, 500.0), (0.0, 500.0)]
    parts = line_table(spark, [*ring, ring[0]])
    region, store = Region("isle", G.ring_edges(ring), limits=optical.Limits(minimum_population=3)), folder_store(spark, str(tmp_path))
    y = 750 - 20 * (np.arange(50) + 0.5)
    elevation = cells(spark, np.repeat(y[:, None] + 300, 80, 1))
    out = terrain_phase(store, parts, elevation, region, -250.0, 750.0, 20.0)
    features = out["segment_features"].collect()
    assert len(features) == 12 and {r["terrain_quality_flag"] for r in features} == {"good"}
    depth = cells(spark, np.full((60, 90), 7.0))
    deep = bathymetry_phase(store, out["coast_segments"], depth, region, -700.0, 1000.0, 25.0)["bathymetry_features"].collect()
    assert len(deep) == 12 and max(r["bathymetry_valid_transect_share"] for r in deep) == 1.0
    rows = [(f"s{s}", y // 20, x // 40, float(x), float(-y), 0.1, 0.2, 0.05 + x / 1e5 + s / 1e3, 0.02, 0.01, 6) for s in range(2) for x in range(5, 1000, 40) for y in range(25, 100, 20)]
    pixels = spark.createDataFrame(rows, "scene_id string, row int, col int, x double, y double, blue double, green double, red double, nir double, swir1 double, scene_classification int")
    scenes = spark.createDataFrame([("s0", True, 2020, 6), ("s1", True, 2021, 7), ("s2", False, 2021, 8)], "scene_id string, selected boolean, year int, month int")
    clarity = clarity_phase(store, out["coast_segments"], pixels, scenes, region)
    assert clarity["clarity_features"].count() == 12
    observed = clarity["clarity_observations"]
    assert observed.count() == 2 * 12 * 3 and observed.where("valid and zone_type = 'nearshore'").count() == 8
    assert observed.where("invalid_reason = 'empty_zone'").count() > 0 and observed.where("valid and apparent_texture_strength is null").count() == 0
    assert {r["scene_quality_flag"] for r in clarity["clarity_scenes"].collect()} == {"usable", "not_selected"}
