"""Tile files, scene pages, preferred tables, prepared depth layers and the metric registry."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bathymetry, raster
from tidemark.plans import metrics
from tidemark.sources import scenes, tiles


def test_tile_files_takes_one_kind_of_source(spark, tmp_path):
    for name in ("b.parquet", "A.parquet", "c.txt"):
        (tmp_path / name).write_bytes(b"12345")
    names = lambda df: [r["path"].rsplit("/", 1)[1] for r in df.collect()]
    assert names(tiles.tile_files(spark, directory=str(tmp_path))) == ["A.parquet", "b.parquet"]
    assert names(tiles.tile_files(spark, pattern=f"{tmp_path}/*.txt")) == ["c.txt"]
    twice = [f"{tmp_path}/b.parquet", f"{tmp_path}/A.parquet", f"{tmp_path}/b.parquet"]
    assert names(tiles.tile_files(spark, paths=twice)) == ["A.parquet", "b.parquet"]
    assert tiles.tile_files(spark, path=f"{tmp_path}/b.parquet").first()["length"] == 5
    with pytest.raises(ValueError, match="exactly one"):
        tiles.tile_files(spark, path="a", directory="b")
    with pytest.raises(ValueError, match="exactly one"):
        tiles.tile_files(spark)
    with pytest.raises(FileNotFoundError):
        tiles.tile_files(spark, path=f"{tmp_path}/none.parquet")
    with pytest.raises(FileNotFoundError):
        tiles.tile_files(spark, directory=str(tmp_path), suffix="*.tif")


def test_tile_checks_name_what_does_not_fit(spark):
    schema = "path string, crs string, resolution_x double, resolution_y double, units string, min_x double, min_y double, max_x double, max_y double"
    good = [("a", "c1", 2.0, 2.0, "m", 0.0, 0.0, 1.0, 1.0), ("B", "c1", 2.0, 2.000001, " M", 1.0, 0.0, 2.0, 1.0)]
    far = ("z", "c9", 5.0, 5.0, "ft", 90.0, 90.0, 91.0, 91.0)
    failed = lambda rows, box=(0.0, 0.0, 2.0, 2.0): {r["check"] for r in tiles.tile_checks(spark.createDataFrame(rows, schema), box).where("not passed").collect()}
    assert failed([*good, far]) == set()
    assert failed([*good, far], (90.0, 90.0, 91.0, 91.0)) == set()
    assert failed([*good, far], (0.0, 0.0, 99.0, 99.0)) == {"mixed_crs", "resolution_difference", "mixed_units"}
    assert failed([*good, (None, " ", 0.0, 2.0, "m", 50.0, 50.0, 51.0, 51.0)]) == {"tiles_without_crs", "tiles_without_resolution"}
    assert "tiles_in_box" in failed([far])
    assert "tiles_in_box" in failed([])


def test_preferred_table_is_the_first_there(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/two")
    name, df = tiles.preferred_table(spark, {"one": f"{tmp_path}/one", "two": f"{tmp_path}/two"})
    assert name == "two" and df.count() == 3
    with pytest.raises(FileNotFoundError):
        tiles.preferred_table(spark, {"one": f"{tmp_path}/one"})


SEARCH = scenes.SceneSearch("https://example.org/api/", "c", (1.0, 2.0, 3.0, 4.5), "2020-05-01", "2020-09-30", (5, 6), 60.0, ("red",))


def _page(ids, after=None):
    items = [{"id": i, "collection": "c", "bbox": [0, 0, 1, 1], "properties": {"datetime": "2020-05-02T10:00:00Z", "grid:code": "T1", "processing:version": "02.04", "eo:cloud_cover": 5.5}, "assets": {"red": {"href": "x", "file:size": 7}}} for i in ids]
    return {"features": items, "links": [{"rel": "self", "href": "s"}] + ([{"rel": "next", "href": after}] if after else [])}


def test_scene_search_address_and_fingerprint():
    assert SEARCH.url == "https://example.org/api/search?collections=c&bbox=1.00000000%2C2.00000000%2C3.00000000%2C4.50000000&datetime=2020-05-01T00%3A00%3A00Z%2F2020-09-30T23%3A59%3A59Z&limit=100"
    other = scenes.SceneSearch(**{**SEARCH.__dict__, "maximum_cloud": 50.0})
    assert other.url == SEARCH.url and other.fingerprint != SEARCH.fingerprint


def test_pages_stop_at_loops_and_limits():
    known = {"a": _page(["1"], "b"), "b": _page(["2"], "a")}
    assert [len(p["features"]) for p in scenes.pages("a", known.__getitem__)] == [1, 1]
    with pytest.raises(scenes.TooManyItems):
        scenes.pages("a", known.__getitem__, maximum=1)
    with pytest.raises(ValueError, match="no list"):
        scenes.pages("a", lambda _: {"features": {}})


def test_scene_catalogue_is_fetched_once(spark, tmp_path):
    asked = []

    def getter(url):
        asked.append(url)
        return json.loads(json.dumps(_page(["1", "2"], "more") if url == SEARCH.url else _page(["3"])))

    found = scenes.scene_catalogue(spark, SEARCH, getter, str(tmp_path))
    assert [(r["scene_id"], r["tile"], r["version"], r["cloud"], r["month"]) for r in found.orderBy("scene_id").collect()] == [(i, "T1", "02.04", 5.5, 5) for i in "123"]
    assert asked == [SEARCH.url, "more"]
    assert scenes.scene_catalogue(spark, SEARCH, getter, str(tmp_path)).count() == 3 and len(asked) == 2
    assert scenes.scene_catalogue(spark, SEARCH, getter, str(tmp_path), refresh=True).count() == 3 and len(asked) == 4


def test_prepared_layers_by_kind(spark):
    source = spark.createDataFrame([(0, 0, -5.0, -1.0, 9), (0, 1, 0.0, 2.0, 255), (0, 2, float("nan"), float("inf"), None)], "row long, col long, z double, s double, flag int")
    rows = bathymetry.prepared_layers(source, {"mean_depth": "z", "standard_deviation": "s", "interpolation_flag": "flag"}, "negative_elevation", zero_is_valid=False, nodata=255)
    assert [tuple(r)[2:] for r in rows.orderBy("col").collect()] == [(5.0, None, 9), (None, 2.0, None), (None, None, None)]
    for wrong in ({"depth": "z"}, {"quality_index": "flag"}, {"mean_depth": "absent"}):
        with pytest.raises(ValueError):
            bathymetry.prepared_layers(source, wrong)


def test_resampled_equals_brute_force(spark):
    assert raster.snapped((-0.1, 0.0, 2.9, 3.0), 1.5) == (-1.5, 0.0, 3.0, 3.0)
    values = {(r, c): None if (r + c) % 4 == 0 else r * 10.0 + c for r in range(4) for c in range(4)}
    source = spark.createDataFrame([(r, c, v, r * 4 + c) for (r, c), v in values.items()], "row long, col long, v double, k int")
    target = raster.cells(spark, (-1.5, 0.0, 4.5, 4.5), 1.5)
    found = {(r["row"], r["col"]): (r["v"], r["k"]) for r in raster.resampled(target, source, ["v"], ["k"], 0.0, 4.0, 1.0).collect()}
    assert len(found) == 12
    for (row, col), (v, k) in found.items():
        x, y = -1.5 + (col + 0.5) * 1.5, 4.5 - (row + 0.5) * 1.5
        own = (int((4 - y) // 1), int(x // 1))
        expected = None
        if own in values:
            u, w = x - 0.5, 4 - y - 0.5
            near = [(r, c, (1 - abs(w - r)) * (1 - abs(u - c))) for r in range(4) for c in range(4) if abs(w - r) < 1 and abs(u - c) < 1]
            known = [(weight, values[r, c]) for r, c, weight in near if values[r, c] is not None]
            expected = sum(a * b for a, b in known) / sum(a for a, _ in known) if known else None
        assert k == (own[0] * 4 + own[1] if own in values else None)
        assert v == (pytest.approx(expected) if expected is not None else None)


def test_metrics_of_a_table(spark):
    assert len(metrics.METRICS) == len({m.field for m in metrics.METRICS}) == 47
    df = spark.createDataFrame([(1.0, 2.0, "x", "a"), (float("nan"), None, None, "b")], "slope_p90_deg double, depth_100m_p50_m double, orientation_status string, other string")
    assert {k: [m.field for m in v] for k, v in metrics.metrics_by_category(df).items()} == {"Terrain": ["slope_p90_deg"], "Bathymetry": ["depth_100m_p50_m"], "Quality": ["orientation_status"]}
    assert "Bathymetry" not in metrics.metrics_by_category(df, bathymetry=False)
    assert [(r["field"], r["known"], r["least"]) for r in metrics.metric_summary(df).collect()] == [("slope_p90_deg", 1, 1.0), ("depth_100m_p50_m", 1, 2.0), ("orientation_status", 1, None)]
    assert metrics.metric_summary(df.select(F.lit(1).alias("other"))).count() == 0
