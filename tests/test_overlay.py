"""Zones less land against closed formulas and fine grids; outlines and merged lines against plain walks."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.operators import overlay, rings


def segment(spark, rows):
    return spark.createDataFrame([(i, [{"x": float(x), "y": float(y)} for x, y in line], b, st) for i, line, b, st in rows], "segment_id string, line array<struct<x:double,y:double>>, seaward_bearing_deg double, orientation_status string")


def polygons(spark, shapes):
    return spark.createDataFrame([([[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings_],) for rings_ in shapes], "rings array<array<struct<x:double,y:double>>>")


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def turned(points, degrees, at=(0, 0)):
    """Points turned to the right, as bearings grow."""
    s, c = math.sin(math.radians(degrees)), math.cos(math.radians(degrees))
    return [(at[0] + x * c + y * s, at[1] - x * s + y * c) for x, y in points]


SHAPES = [[box(-50, -60, 150, 10)], [box(20, 30, 40, 60), box(25, 35, 35, 50)], [box(95, 0, 99.8, 400)], [box(35, 55, 45, 90)], [[(60, 20), (80, 20), (70, 90)]]]


@pytest.mark.parametrize("angle", [0, 30, 123.4, 270])
def test_areas_parts_and_slivers_at_any_bearing(spark, angle):
    at = (400_000.0, 4_400_000.0)
    line = turned([(0, 0), (100 - 1e-7, 0)], angle, at)  # four steps, however it is rounded
    land = polygons(spark, [[turned(r, angle, at) for r in rings_] for rings_ in SHAPES])
    zones = overlay.zones_less_land(segment(spark, [("a", line, float(angle), "resolved")]), land, (("near", 5, 100), ("far", 500, 600)), 25.0, 40.0)
    near, far = (r.asDict() for r in zones.orderBy("inner_distance_m").collect())
    # 100 wide from 10 to 100, less a box with a hole, a bar that leaves 0.2 beside it, a box that meets the first in a corner piece, and a triangle.
    hole = 10 * 15
    wanted = 100 * 90 - (20 * 30 - hole) - 4.8 * 90 - (10 * 35 - 5 * 5) - 20 * 70 / 2
    assert near["zone_area_m2"] == pytest.approx(wanted, abs=1e-4)
    # The hole, and 18 beside the bar, which exceeds the least area of 12.5.
    assert sorted(near["part_areas_m2"]) == pytest.approx([18, hole, wanted - hole - 18], abs=1e-4)
    assert near["geometry_warnings"] == "disconnected_valid_parts:3"
    assert far["zone_area_m2"] == pytest.approx(100 * 100, abs=1e-4) and far["geometry_warnings"] == ""
    assert sum(abs(overlay.signed_area(np.array([(p["x"], p["y"]) for p in q]))) for q in near["pieces"]) == pytest.approx(wanted, abs=1e-4)


def test_the_least_area_counts_by_parts(spark):
    for width, parts, warning in ((0.2, 2, "disconnected_valid_parts:2"), (0.1, 1, "tiny_slivers_removed:1")):
        land = polygons(spark, [[box(50, 0, 100 - width, 400)]])
        (row,) = overlay.zones_less_land(segment(spark, [("a", [(0, 0), (100, 0)], 0.0, "resolved")]), land, (("z", 10, 100),), 25.0, 33.0).collect()
        assert len(row["part_areas_m2"]) == parts and row["geometry_warnings"] == warning
        assert row["zone_area_m2"] == pytest.approx(50 * 90 + (width * 90 if parts == 2 else 0), abs=1e-6)


def test_status_and_odd_segments(spark):
    rows = [("clear", [(0, 0), (10, 0)], 90.0, "resolved"), ("drowned", [(500, 0), (510, 0)], 90.0, "resolved"), ("unclear", [(0, 0), (10, 0)], 90.0, "ambiguous"), ("nowhere", [(0, 0), (10, 0)], None, "resolved"), ("nan", [(0, 0), (10, 0)], math.nan, "resolved"), ("short", [(0, 0)], 0.0, "resolved"), ("none", [], 0.0, None)]
    land = polygons(spark, [[box(0, -900, 5000, 900)], [], [[(1, 1), (2, 2)]], [box(300, -5, 700, 5)]]).union(spark.sql("SELECT CAST(NULL AS array<array<struct<x:double,y:double>>>)"))
    got = {r["segment_id"]: r for r in overlay.zones_less_land(segment(spark, rows), land, (("z", 2, 6),), 10.0, 50.0).collect()}
    assert {k: r["zone_status"] for k, r in got.items()} == {"clear": "empty_after_land_exclusion", "drowned": "empty_after_land_exclusion", **dict.fromkeys(("unclear", "nowhere", "nan", "short", "none"), "ambiguous_orientation")}
    assert {r["geometry_warnings"] for k, r in got.items() if k not in ("clear", "drowned")} == {"orientation_unresolved"}
    none = overlay.zones_less_land(segment(spark, rows), land.limit(0), (("z", 2, 6),), 10.0, 50.0).where("zone_status = 'valid'").collect()
    assert {(r["segment_id"], r["zone_area_m2"]) for r in none} == {("clear", 40.0), ("drowned", 40.0)}
    assert overlay.zones_less_land(segment(spark, rows).limit(0), land, (("z", 2, 6),), 10.0, 50.0).count() == 0


def test_random_land_against_a_fine_grid(spark):
    pick = random.Random(5)
    shapes = []
    for _ in range(25):
        x, y, n = pick.uniform(-20, 120), pick.uniform(0, 110), pick.randint(3, 9)
        angles = sorted(pick.uniform(0, 2 * math.pi) for _ in range(n))
        shapes.append([[(x + pick.uniform(4, 18) * math.cos(a), y + pick.uniform(4, 18) * math.sin(a)) for a in angles][:: pick.choice([1, -1])]])
    line = [(0, 0), (40, 10), (100, -5)]
    (row,) = overlay.zones_less_land(segment(spark, [("a", line, 10.0, "resolved")]), polygons(spark, shapes), (("z", 5, 90),), 30.0, 17.0).collect()
    step = 0.25
    xs, ys = np.meshgrid(np.arange(-60, 160, step) + step / 2, np.arange(-40, 140, step) + step / 2)
    s, c = math.sin(math.radians(10)), math.cos(math.radians(10))
    cut = np.cumsum([0, *(math.dist(a, b) for a, b in zip(line, line[1:]))])
    count = math.ceil(cut[-1] / 30)
    inside = np.zeros(xs.shape, bool)
    for i in range(count):
        d = (i + 0.5) * cut[-1] / count
        ox, oy = np.interp(d, cut, [p[0] for p in line]), np.interp(d, cut, [p[1] for p in line])
        along, aside = (xs - ox) * s + (ys - oy) * c, (xs - ox) * c - (ys - oy) * s
        inside |= (along >= 5) & (along <= 90) & (np.abs(aside) <= 15)
    dry = np.zeros(xs.shape, bool)
    for (ring,) in shapes:
        odd = np.zeros(xs.shape, bool)
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            with np.errstate(divide="ignore", invalid="ignore"):
                odd ^= ((y1 > ys) != (y2 > ys)) & (xs < (x2 - x1) * (ys - y1) / (y2 - y1) + x1)
        dry |= odd
    wanted = (inside & ~dry).sum() * step**2
    # Slivers below 18 are gone from the exact area.
    assert row["zone_area_m2"] == pytest.approx(wanted, rel=0.02)
    assert min(row["part_areas_m2"]) >= 18


def test_cells_hold_the_whole_polygon():
    pick = random.Random(2)
    for _ in range(20):
        angles = sorted(pick.uniform(0, 2 * math.pi) for _ in range(40))
        ring = np.array([(pick.uniform(5, 90) * math.cos(a) + 3, pick.uniform(5, 90) * math.sin(a)) for a in angles])
        cells = list(overlay.ring_cells(ring, 7.5))
        assert sum(overlay.signed_area(r) for *_, r in cells) == pytest.approx(overlay.signed_area(ring))
        for cx, cy, r in cells:
            assert (r >= np.array([cx, cy]) * 7.5 - 1e-9).all() and (r <= np.array([cx + 1, cy + 1]) * 7.5 + 1e-9).all()


def cells_of(spark, full):
    return polygons(spark, [[box(x, y, x + 1, y + 1)] for x, y in full])


def pieces(full, steps):
    left, n = set(full), 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            x, y = todo.pop()
            for dx, dy in steps:
                if (x + dx, y + dy) in left:
                    left.discard((x + dx, y + dy))
                    todo.append((x + dx, y + dy))
    return n


FOUR = [(1, 0), (-1, 0), (0, 1), (0, -1)]
EIGHT = [*FOUR, (1, 1), (1, -1), (-1, 1), (-1, -1)]


def test_outlines_of_random_cells(spark):
    pick = random.Random(9)
    full = [(x, y) for x in range(24) for y in range(24) if pick.random() < 0.6]
    got = rings.dissolved(cells_of(spark, full + full[:30])).collect()
    assert sum(r["area"] for r in got) == len(full)
    assert sum(r["area"] > 0 for r in got) == pieces(full, FOUR)
    empty = {(x, y) for x in range(-1, 25) for y in range(-1, 25)} - set(full)
    assert sum(r["area"] < 0 for r in got) == pieces(empty, EIGHT) - 1
    for r in got:
        points = [(p["x"], p["y"]) for p in r["line"]]
        assert all(math.dist(a, b) == 1 for a, b in zip(points, points[1:] + points[:1]))
        edges = list(zip(points, points[1:] + points[:1]))
        assert len(set(edges)) == len(edges)


def test_outline_of_polygons_of_any_turn_closed_or_with_holes(spark):
    outer, hole = box(0, 0, 10, 10), box(2, 2, 4, 4)
    for shapes, areas in (
        ([[outer, hole]], [-4, 100]), ([[outer[::-1], hole]], [-4, 100]), ([[[*outer, outer[0]], hole[::-1]]], [-4, 100]), ([[outer, hole], [hole]], [100]),
        ([[outer], [box(10, 0, 20, 10)]], [200]), ([[box(0, 0, 1, 1)], [box(1, 1, 2, 2)]], [1, 1]), ([[]], []), ([[[(0, 0), (1, 1)]]], []),
    ):
        assert sorted(r["area"] for r in rings.dissolved(polygons(spark, shapes)).collect()) == areas
    assert rings.dissolved(polygons(spark, [[outer]]).limit(0)).count() == 0


def plain_merge(lines):
    """Merged lines by walking, as sets of (least, greatest) of their point lists in both directions."""
    ends = defaultdict(list)
    for k, line in enumerate(lines):
        ends[line[0]].append((k, 0))
        ends[line[-1]].append((k, 1))
    left, out = set(range(len(lines))), []
    while left:
        k = min(left)
        left.discard(k)
        path = list(lines[k])
        for _ in range(2):
            while len(ends[path[-1]]) == 2 and path[0] != path[-1] or (len(ends[path[-1]]) == 2 and len(path) == len(lines[k]) and path[0] != path[-1]):
                nxt = [e for e in ends[path[-1]] if e[0] in left]
                if not nxt:
                    break
                j, side = nxt[0]
                left.discard(j)
                path += (lines[j] if side == 0 else lines[j][::-1])[1:]
            path.reverse()
        out.append(path)
    return out


def shape_of(path):
    if path[0] == path[-1]:
        return "closed", frozenset(frozenset(e) for e in zip(path, path[1:]))
    return "open", min(tuple(path), tuple(path[::-1]))


def test_merged_lines_against_a_walk(spark):
    pick = random.Random(4)
    lines = []
    for k in range(12):  # long chains in random pieces and directions
        points = [(float(100 * k), float(i)) for i in range(pick.randint(2, 90))]
        at = 0
        while at < len(points) - 1:
            to = min(len(points) - 1, at + pick.randint(1, 4))
            lines.append(points[at : to + 1][:: pick.choice([1, -1])])
            at = to
    lines += [[(0.0, 5000.0), (1.0, 5001.0)], [(1.0, 5001.0), (2.0, 5000.0)], [(1.0, 5001.0), (1.0, 5002.0)]]  # a branch
    circle = [(7000 + math.cos(a), math.sin(a)) for a in np.linspace(0, 6, 30).tolist()]
    lines += [[a, b][:: pick.choice([1, -1])] for a, b in zip(circle, circle[1:] + circle[:1])]
    lines += [[(9000.0, 0.0), (9001.0, 0.0), (9001.0, 1.0), (9000.0, 0.0)]]  # closed on its own
    pick.shuffle(lines)
    df = spark.createDataFrame([([{"x": x, "y": y} for x, y in line],) for line in lines] + [([],), ([{"x": 1.0, "y": 1.0}],)], "line array<struct<x:double,y:double>>").repartition(3)
    got = rings.merged_lines(df).collect()
    found = [shape_of([(p["x"], p["y"]) for p in r["line"]]) for r in got]
    assert sorted(found, key=repr) == sorted(map(shape_of, plain_merge(lines)), key=repr)
    assert sorted(n for r in got for n in r["line_ids"]) == sorted({n for r in got for n in r["line_ids"]})
    assert all(r["closed"] == (kind == "closed") for r, (kind, _) in zip(got, found, strict=True))


def test_zones_swept_together_are_as_each_alone(spark, monkeypatch):
    pick = np.random.default_rng(3)
    zones = [(pick.uniform(0, 20, (pick.integers(1, 4), 4)).round(1), pick.uniform(-5, 25, (pick.integers(0, 4), 3, 2)).round(1)) for _ in range(60)]
    rects = [np.stack([r[:, :2].min(1), r[:, :2].max(1) + 1, r[:, 2:].min(1), r[:, 2:].max(1) + 1], 1) for r, _ in zones]
    edges = [np.concatenate([t, np.roll(t, -1, 1)], 2).reshape(-1, 4) for t in (np.where((np.array([overlay.signed_area(r) for r in land]) > 0)[:, None, None], land, land[:, ::-1]) if len(land) else land for _, land in zones)]
    number = lambda lists: np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    alone = [overlay.difference(1, number([r]), r, number([e]), e) for r, e in zip(rects, edges, strict=True)]
    for pairs in (overlay.PAIRS, 7):
        monkeypatch.setattr(overlay, "PAIRS", pairs)
        zone, part, rows = overlay.difference(60, number(rects), np.concatenate(rects), number(edges), np.concatenate(edges))
        for k, (_, p, r) in enumerate(alone):
            assert np.array_equal(rows[zone == k], r)
            assert np.array_equal(np.unique(part[zone == k], return_inverse=True)[1], np.unique(p, return_inverse=True)[1])


def test_segments_of_one_id_have_a_row_each(spark):
    rows = [("a", [(0, 0), (10, 0)], 0.0, "resolved"), ("a", [(0, 0), (10, 0)], 0.0, "resolved")]
    got = overlay.zones_less_land(segment(spark, rows), polygons(spark, [[box(2, 0, 4, 100)]]), (("z", 2, 6),), 10.0, 50.0).collect()
    assert [r["zone_area_m2"] for r in got] == [32.0, 32.0]


def shuffled_rows(spark):
    """How many rows the session has written to shuffles so far."""
    jvm = spark.sparkContext._jvm
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum({stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}.values())


def test_chains_of_every_length_and_their_rounds(spark):
    pick = random.Random(2)
    ids = list(range(1, 6000))
    pick.shuffle(ids)
    links, wanted = [], {}
    for length, cycle in [(n, c) for n in range(1, 20) for c in (True, False)] + [(150, True), (3, False)] + [(4, True)] * 1200:
        chain = [ids.pop() for _ in range(length)]
        links += [(a, b) for a, b in zip(chain, [*chain[1:], chain[0] if cycle else None])]
        if cycle:
            k = chain.index(min(chain))
            chain = chain[k:] + chain[:k]
        wanted |= {i: (chain[0] if cycle else chain[-1], length - 1 - k) for k, i in enumerate(chain)}
    df = spark.createDataFrame(links, "id long, next long").repartition(3)
    before = shuffled_rows(spark)
    assert {r["id"]: (r["chain"], r["rest"]) for r in rings.chained(df).collect()} == wanted
    # Short chains take no part in the rounds of the longest one.
    assert shuffled_rows(spark) - before < 9 * len(links)
