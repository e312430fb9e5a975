"""Well-known binary in either byte order, and reads of boxes that skip files."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from tidemark.sources import located

P = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
SQUARE, HOLE = P((0, 0), (4, 0), (4, 4), (0, 0)), P((1, 1), (2, 1), (2, 2), (1, 1))
SHAPES = [
    ("point", [[P((1.5, -2))]]), ("line", [[P((0, 0), (1, 1e300))]]), ("polygon", [[SQUARE, HOLE]]), ("polygon", [[SQUARE]]), ("points", [[P((1, 2))], [P((3, 4))]]),
    ("lines", [[P((0, 0), (1, 1))], [P((5, 5), (6, 7), (8, 9))]]), ("polygons", [[SQUARE, HOLE], [SQUARE]]), ("line", []), ("polygon", []), ("point", []), ("lines", []),
]


@pytest.mark.parametrize("order", ["<", ">"])
def test_round_trip_of_all_kinds(order):
    for kind, parts in SHAPES:
        assert located.decoded(located.encoded(kind, parts, order)) == (kind, parts)


def test_bytes_are_the_published_ones():
    assert located.encoded("point", [[P((2, 4))]], ">").hex() == "000000000140000000000000004010000000000000"
    assert located.encoded("line", [[P((1, 2))]]) == b"\x01\x02\x00\x00\x00\x01\x00\x00\x00" + struct.pack("<2d", 1, 2)


@pytest.mark.parametrize("data", [b"", b"\x01", b"\x01\x02\x00\x00\x00\x02\x00\x00\x00" + bytes(16), b"\x01\x07\x00\x00\x00\x00\x00\x00\x00", b"\x05\x01\x00\x00\x00" + bytes(16), located.encoded("point", [[P((1, 1))]]) + b"x"])
def test_other_bytes_are_errors(data):
    with pytest.raises(ValueError, match="geometry"):
        located.decoded(data)


def test_columns(spark):
    rows = [(i, kind, parts) for i, (kind, parts) in enumerate(SHAPES)] + [(99, None, None)]
    df = spark.createDataFrame(rows, f"id long, kind string, parts {located.PARTS}")
    binary = df.select("id", located.to_wkb(F.col("kind"), F.col("parts")).alias("wkb"))
    back = {r["id"]: r["g"] for r in binary.select("id", located.from_wkb(F.col("wkb")).alias("g")).collect()}
    assert back.pop(99) is None
    for i, (kind, parts) in enumerate(SHAPES):
        assert (back[i]["kind"], [[[p.asDict() for p in ring] for ring in part] for part in back[i]["parts"]]) == (kind, parts)


def test_a_box_reads_few_files(spark, tmp_path):
    pick = random.Random(1)
    rows = [(i, [[P((x, y), (x + 1, y + 2))]]) for i, (x, y) in enumerate((pick.uniform(0, 1000), pick.uniform(0, 1000)) for _ in range(4000))] + [(-1, []), (-2, None)]
    path = str(tmp_path / "lines")
    located.write_located(spark.createDataFrame(rows, f"id long, parts {located.PARTS}"), path, 32)
    low, high = (100.0, 100.0), (180.0, 170.0)
    found = located.read_box(spark, path, low, high)
    wanted = {i for i, parts in rows if parts and parts[0][0][0]["x"] <= high[0] and parts[0][0][1]["x"] >= low[0] and parts[0][0][0]["y"] <= high[1] and parts[0][0][1]["y"] >= low[1]}
    assert {r["id"] for r in found.collect()} == wanted and wanted
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = located.read_box(spark, path, low, high)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(bbox.min_x,180.0)" in plan.split("PushedFilters")[1]
    bounds = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("bbox.min_x").alias("a"), F.max("bbox.max_x").alias("b"), F.min("bbox.min_y").alias("c"), F.max("bbox.max_y").alias("d"))
    assert bounds.count() == 32
    # Files whose bounds meet the box; the others' row groups are skipped by the filters above.
    assert bounds.where((F.col("a") <= high[0]) & (F.col("b") >= low[0]) & (F.col("c") <= high[1]) & (F.col("d") >= low[1])).count() <= 4


def test_nothing_to_write(spark, tmp_path):
    located.write_located(spark.createDataFrame([], f"id long, parts {located.PARTS}"), str(tmp_path / "none"), 4)
    assert located.read_box(spark, str(tmp_path / "none"), (0.0, 0.0), (1.0, 1.0)).count() == 0
