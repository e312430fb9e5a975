"""Components against plain union, gaps of edges against fine points, and reviews of small tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geometry as G
from tidemark.operators import reviews

LINE = "line array<struct<x:double,y:double>>"


def line(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def united(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_random_links_a_long_chain_and_a_hub(spark):
    pick = random.Random(5)
    pairs = [(pick.randrange(300), pick.randrange(300)) for _ in range(170)]
    order = list(range(1000, 1200))
    pick.shuffle(order)
    pairs += list(zip(order, order[1:])) + [(5000, 5000 + i) for i in range(1, 400)] + [(7, 7), (9000, 9000)]
    found = reviews.components(spark.createDataFrame([*pairs, *pairs[:50]], "a long, b long")).collect()
    pairs_ = [p for p in pairs if p[0] != p[1]]
    wanted = united(pairs_, {i for p in pairs_ for i in p})
    assert len(found) == len(wanted) and {r.id: r.component for r in found} == wanted
    assert reviews.components(spark.createDataFrame([], "a long, b long")).isEmpty()


@pytest.mark.parametrize("spread", [6.0, 14.0])
def test_lines_by_ends_within_a_tolerance(spark, spread):
    pick = random.Random(11)
    rows = []
    for k in range(120):
        x, y = pick.uniform(-spread, spread), pick.uniform(-spread, spread)
        rows.append((f"l{k:03d}", line((x, y), (99, 99), (x + pick.uniform(-1, 1), y + pick.uniform(-1, 1)))))
    rows += [("ring", line((50, 50), (51, 50), (50, 50))), ("dot", line((50.3, 50))), ("none", None), ("bare", [])]
    ends = {k: [(p["x"], p["y"]) for p in (v[0], v[-1])] for k, v in rows if v}
    near = [(a, b) for a in ends for b in ends if a < b and any(math.hypot(p[0] - q[0], p[1] - q[1]) <= 0.4 for p in ends[a] for q in ends[b])]
    wanted = united(near, ends) | {"none": None, "bare": None}
    found = reviews.line_components(spark.createDataFrame(rows, "k string, " + LINE), "k", 0.4).collect()
    assert {r.k: r.component for r in found} == wanted and len(found) == len(rows)
    assert wanted["ring"] == wanted["dot"] == "dot"


def test_gaps_of_edges_against_fine_points(spark):
    pick = random.Random(2)
    pairs = [tuple(pick.choice([pick.uniform(-3, 3), float(pick.randrange(-2, 3))]) for _ in range(8)) for _ in range(150)]
    pairs += [(0.0, 0.0, 2.0, 2.0, 0.0, 2.0, 2.0, 0.0), (0.0, 0.0, 2.0, 0.0, 1.0, 0.0, 1.0, 5.0), (0.0, 0.0, 4.0, 0.0, 1.0, 0.0, 2.0, 0.0), (1.0, 1.0, 1.0, 1.0, 3.0, 1.0, 3.0, 1.0)]
    names = [f"e{i}" for i in range(8)]
    df = spark.createDataFrame(pairs, ", ".join(f"{n} double" for n in names))
    found = [r[0] for r in df.select(reviews.edge_gap([F.col(n) for n in names[:4]], [F.col(n) for n in names[4:]])).collect()]
    for got, (a, b, c, d, e, f, g, h) in zip(found, pairs, strict=True):
        fine = [(e + (g - e) * t / 400, f + (h - f) * t / 400) for t in range(401)]

        def off(x, y):
            length = (c - a) ** 2 + (d - b) ** 2
            t = max(0.0, min(1.0, ((x - a) * (c - a) + (y - b) * (d - b)) / length)) if length else 0.0
            return math.hypot(x - a - t * (c - a), y - b - t * (d - b))

        wanted = min(off(*p) for p in fine)
        assert got <= wanted + 1e-9 and got >= wanted - math.hypot(g - e, h - f) / 400


def test_reviews_of_tiles_ends_and_classes(spark):
    segments = spark.createDataFrame([("in", line((40, 40), (60, 60))), ("by", line((10, 98), (20, 97))), ("over", line((90, 50), (110, 50))), ("far", line((300, 300), (310, 300))), ("one", line((0, 0)))], "segment_id string, " + LINE)
    features = spark.createDataFrame([("by", 0.9, 20.0), ("over", None, 95.0), ("far", 0.1, -1.0)], "segment_id string, terrain_valid_sample_share double, slope_max_deg double")
    tiles = spark.createDataFrame([(0, 0, 100, 100), (0, 0, 100, 100)], "min_x int, min_y int, max_x int, max_y int")
    assert tuple(reviews.tile_edge_review(segments, features, tiles, 2.0, 30.0).first()) == (3.0, 2, 1, 1, True)
    assert tuple(reviews.tile_edge_review(segments, features, tiles.limit(0), 2.0).first()) == (3.0, 0, 0, 0, False)
    land = spark.createDataFrame([(0.0, 0.0, 10.0, 0.0), (10.0, 0.0, 10.0, 10.0), (10.0, 10.0, 0.0, 10.0), (0.0, 10.0, 0.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    transects = [("a", "inland", line((15, 5), (5, 5))), ("b", "inland", line((15, 5), (12, 5))), ("c", "inland", None), ("d", "offshore", line((5, 5), (10, 5))), ("e", "offshore", line((5, 5), (15, 5)))]
    assert tuple(reviews.endpoint_review(spark.createDataFrame(transects, "transect_id string, direction string, " + LINE), land, 4.0).first()) == (2, 1)
    audit = spark.createDataFrame([("Muelle viejo", True), ("Muelle viejo", False), ("Costa", True), ("Costa", True), (None, None)], "source_class string, selected_for_analysis boolean")
    found = {(r.source_class, r.selected): (r.n, r.suspicious) for r in reviews.source_class_review(audit).collect()}
    assert found == {("Muelle viejo", True): (1, True), ("Muelle viejo", False): (1, False), ("Costa", True): (2, False), ("missing", False): (1, False)}


def test_self_crossings_of_bow_ties_and_random_lines(spark):
    pick = random.Random(8)
    rows = [("bow", line((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))), ("square", line((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))), ("touch", line((0, 0), (4, 0), (2, 2), (2, 0), (2, -3))), ("short", line((0, 0))), ("none", None)]
    rows += [(f"r{i}", line(*[(pick.uniform(0, 9), pick.uniform(0, 9)) for _ in range(12)])) for i in range(20)]

    def cut(a, b, c, d):
        side = lambda p, q, r: (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])
        return side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0

    wanted = {k: sum(cut(*e, *f) for i, e in enumerate(zip(v, v[1:])) for f in list(zip(v, v[1:]))[i + 1 :]) if v is not None else 0 for k, v in rows}
    found = reviews.self_crossings(spark.createDataFrame(rows, "k string, " + LINE), "k", 1.5).collect()
    assert {r.k: r.crossings for r in found} == wanted and len(found) == len(rows) and wanted["bow"] == 1 and wanted["square"] == 0


def test_hausdorff_is_the_greatest_gap_of_a_vertex_either_way(spark):
    df = spark.createDataFrame([(line((0, 0), (10, 0)), line((0, 1), (5, 4), (10, 1))), (line((0, 0), (1, 0)), line((0, 0), (1, 0))), (line((3, 4)), line((0, 0))), ([], line((0, 0)))], "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>")
    found = [r[0] for r in df.select(G.hausdorff(F.col("a"), F.col("b"))).collect()]
    assert found == [4.0, 0.0, 5.0, None]


def test_lines_clipped_to_a_box_keep_their_parts_apart(spark):
    rows = [
        ("through", line((-5, 5), (15, 5))), ("twice", line((5, 5), (5, 15), (8, 15), (8, 5), (9, 5))), ("inside", line((1, 1), (2, 2), (3, 1))), ("beside", line((-5, -1), (15, -1))),
        ("along", line((2, 10), (8, 10))), ("corner", line((-1, 1), (1, -1))), ("touch", line((5, 10), (5, 20))), ("dot", line((5, 5))), ("still", line((5, 5), (5, 5), (6, 5))), ("none", None),
    ]
    found = {(r.k, r.part): [(p.x, p.y) for p in r.line] for r in reviews.clipped_lines(spark.createDataFrame(rows, "k string, " + LINE), "k", (0.0, 0.0, 10.0, 10.0)).collect()}
    assert found[("through", 0)] == [(0, 5), (10, 5)]
    assert found[("twice", 0)] == [(5, 5), (5, 10)] and found[("twice", 1)] == [(8, 10), (8, 5), (9, 5)]
    assert found[("inside", 0)] == [(1, 1), (2, 2), (3, 1)] and found[("along", 0)] == [(2, 10), (8, 10)]
    assert found[("still", 0)] == [(5, 5), (5, 5), (6, 5)]
    assert {k for k, _ in found} == {"through", "twice", "inside", "along", "still"}
