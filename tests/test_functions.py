"""Statistics, scalars and geometry with known answers."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geometry as G
from tidemark.functions import scalars as S
from tidemark.functions import stats


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, column, row="select 1 as one"):
    return spark.sql(row).select(column.alias("v")).first()["v"]


def test_ranks_agree_with_pandas_with_ties_and_nulls(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"id": range(200), "g": rng.integers(0, 6, 200), "v": rng.integers(0, 12, 200).astype(float)})
    pdf.loc[pdf.index % 9 == 0, "v"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, g long, v double")
    found = stats.percentile_ranks(df, ["g"], [("v", 1)]).toPandas().set_index("id").sort_index()["v_percentile"]
    expected = pdf.groupby("g")["v"].rank(pct=True) * 100
    assert np.allclose(found.astype(float), expected, equal_nan=True)


def test_constant_groups_and_small_groups(spark):
    df = spark.createDataFrame([(1, 1.0)] * 5 + [(2, 1.0)] * 4 + [(3, None)] * 6, "g int, v double")
    got = {r["g"]: r["p"] for r in stats.percentile_ranks(df, ["g"], [("v", -1)], "_p", 5, 50.0).groupBy("g").agg(F.max("v_p").alias("p")).collect()}
    assert got == {1: 50.0, 2: None, 3: None}


def test_distribution_of_nothing_is_null(spark):
    row = stats.distribution(spark.createDataFrame([(float("nan"),), (float("inf"),)], "v double"), ["v"]).first()
    assert row["count"] == 0 and row["p50"] is None and row["mean"] is None


def test_smallest_mode_breaks_ties(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", None)], "k string, v string")
    assert values(stats.smallest_mode(df, ["k"], "v", "m"), "k", "m") == [("a", "x")]


def test_spread(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 4, 8)], "k int, v double")
    row = stats.spread(stats.value_numbers(df, ["k"], F.col("v")), ["k"], "v").first()
    assert (row["v_p50"], row["v_mad"]) == (3.0, 1.5)


def test_depths(spark):
    df = spark.createDataFrame([(-10.0,), (-0.0,), (2.0,), (float("nan"),)], "v double")
    assert [r[0] for r in df.select(S.canonical_depth(F.col("v"), "negative_elevation")).collect()] == [10.0, 0.0, None, None]
    assert [r[0] for r in df.select(S.canonical_depth(F.col("v"))).collect()] == [None, 0.0, 2.0, None]
    with pytest.raises(ValueError):
        S.canonical_depth(F.col("v"), "up")


def test_reflectance_and_ratio(spark):
    df = spark.createDataFrame([(0,), (1000,), (-9999,)], "v int")
    assert [None if r[0] is None else round(r[0], 9) for r in df.select(S.reflectance(F.col("v"), 0.0001, -0.1, -9999)).collect()] == [-0.1, 0.0, None]
    assert one(spark, S.ratio(F.lit(1.0), F.lit(0.0))) is None


def test_versions_order_by_number(spark):
    df = spark.createDataFrame([("05.11",), ("5.2",), ("x.1",), (None,)], "v string")
    assert [r[0] for r in df.select(S.version_key(F.col("v"))).collect()] == [[5, 11], [5, 2], [0], [0]]


@pytest.mark.parametrize(("ratio", "name"), [(0.9, "below_native_resolution"), (1.0, "marginally_resolved"), (2.0, "well_resolved"), (None, "unavailable")])
def test_resolution_classes(spark, ratio, name):
    assert one(spark, S.resolution_class(F.lit(ratio).cast("double"))) == name


def test_formatting(spark):
    assert one(spark, S.format_value(F.lit(12.345), unit="m")) == "12.35 m"
    assert one(spark, S.format_value(F.lit(None).cast("double"))) == "Not available"
    assert one(spark, S.format_value(F.lit("resolved_fallback"), "category")) == "Resolved Fallback"


def test_projections(spark):
    x, y = (one(spark, c) for c in S.transverse_mercator(F.lit(3.0), F.lit(0.0)))
    assert abs(x - 500000) < 1e-6 and abs(y) < 1e-6
    x, y = (one(spark, c) for c in S.transverse_mercator(F.lit(2.5), F.lit(39.7)))
    assert abs(x - 457136) < 5 and abs(y - 4394500) < 500  # a known island town, roughly
    x, _ = (one(spark, c) for c in S.web_mercator(F.lit(180.0), F.lit(0.0)))
    assert abs(x - math.pi * 6378137) < 1e-6


def test_lines(spark):
    df = spark.sql("select array(named_struct('x', 0D, 'y', 0D), named_struct('x', 100D, 'y', 0D), named_struct('x', 100D, 'y', 50D)) as line")
    assert df.select(G.length(F.col("line"))).first()[0] == 150.0
    p = df.select(G.interpolate(F.col("line"), F.lit(120.0)).alias("p")).first()["p"]
    assert (p["x"], p["y"]) == (100.0, 20.0)
    assert df.select(G.interpolate(F.col("line"), F.lit(999.0)).alias("p")).first()["p"]["y"] == 50.0
    part = df.select(G.between(F.col("line"), F.lit(50.0), F.lit(120.0)).alias("l")).first()["l"]
    assert [(v["x"], v["y"]) for v in part] == [(50.0, 0.0), (100.0, 0.0), (100.0, 20.0)]
    assert df.select(G.area(F.col("line"))).first()[0] == 2500.0
    assert df.select(G.local_bearing(F.col("line"), F.lit(50.0))).first()[0] == 90.0
    assert one(spark, G.angle_between(F.lit(350.0), F.lit(20.0))) == 30.0


def test_polygon_covers_its_boundary_but_not_its_hole(spark):
    edges = G.ring_edges([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]) + G.ring_edges([(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)])
    got = [one(spark, G.covered_by(G.point(x, y), edges)) for x, y in ((1, 1), (0, 5), (10, 10), (5, 5), (4, 5), (11, 5))]
    assert got == [True, True, True, False, True, False]


def test_colours(spark):
    palette = [(0, 0, 0), (100, 100, 100), (200, 0, 0)]
    assert one(spark, S.palette_colour(F.lit(0.25), palette)) == [50, 50, 50, 210]
    assert one(spark, S.palette_colour(F.lit(1.0), palette))[:3] == [200, 0, 0]
    assert one(spark, S.palette_position(F.lit(1.0), F.lit(2.0), F.lit(2.0))) == 0.5


@pytest.mark.parametrize("octave", [1, 4096])
def test_quantiles_equal_numpy(spark, monkeypatch, octave):
    monkeypatch.setattr(stats, "OCTAVE", octave)
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 400), "a": np.round(rng.normal(size=400), 1), "b": rng.normal(size=400)})
    pdf.loc[pdf.g == 3, "b"] = np.nan
    pdf.loc[pdf.index % 7 == 0, "a"] = np.nan
    pdf.loc[len(pdf)] = (0, np.inf, 1.0)
    rows = [(None if r.g == 2 else int(r.g), float(r.a), float(r.b)) for r in pdf.itertuples()]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    levels = (0.0, 0.1, 0.5, 0.75, 1.0)
    wanted = [(f"{f}{i}", f, p) for f in "ab" for i, p in enumerate(levels)]
    got = {r["g"]: r for r in stats.quantiles(df, ["g"], {"a": F.col("a"), "b": F.col("b")}, wanted).collect()}
    assert set(got) == {0, 1, None, 3}
    for g, part in pdf.groupby("g"):
        row = got[None if g == 2 else int(g)]
        for name, field, p in wanted:
            known = part[field][np.isfinite(part[field])]
            assert row[name] == (pytest.approx(np.quantile(known, p)) if len(known) else None)
    whole = stats.quantiles(df, [], {"a": F.col("a")}, [("m", "a", 0.5)]).first()["m"]
    assert whole == pytest.approx(np.median(pdf.a[np.isfinite(pdf.a)]))
    assert stats.medians(df.limit(0), {"a": F.col("a")}).first()["a"] is None
