"""Geometry in Parquet: well-known binary, boxes of their own columns, and files in the order of a space-filling curve.

A geometry of any kind is (kind, parts), parts being polygons of rings of points: a point is
one ring of one point, a line one ring, a line of several parts one ring each in a polygon of its own.
Spark's writer has no place for the footer entry that names a file's geometry columns, so the
files are Parquet with well-known binary in them, and readers are told the column's name.
"""

from __future__ import annotations

import json
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G

# Codes of the kinds in well-known binary.
KINDS = {"point": 1, "line": 2, "polygon": 3, "points": 4, "lines": 5, "polygons": 6}
_NAMES = {code: name for name, code in KINDS.items()}
_SINGLE = {"points": "point", "lines": "line", "polygons": "polygon"}
PARTS = f"array<array<{G.LINE}>>"
GEOMETRY = f"struct<kind:string,parts:{PARTS}>"
_BOX = ("min_x", "min_y", "max_x", "max_y")


def _coordinates(points: list, order: str) -> bytes:
    return struct.pack(f"{order}{2 * len(points)}d", *[v for p in points for v in (p["x"], p["y"])])


def encoded(kind: str, parts: list, order: str = "<") -> bytes:
    """Well-known binary in the given byte order; an empty point has coordinates that are no numbers."""
    head = struct.pack(f"{order}BI", order == "<", KINDS[kind])
    if kind in _SINGLE:
        return head + struct.pack(f"{order}I", len(parts)) + b"".join(encoded(_SINGLE[kind], [p], order) for p in parts)
    rings = parts[0] if parts else []
    if kind == "point":
        return head + (_coordinates(rings[0][:1], order) if rings and rings[0] else struct.pack(f"{order}2d", float("nan"), float("nan")))
    body = b"".join(struct.pack(f"{order}I", len(r)) + _coordinates(r, order) for r in rings)
    return head + (struct.pack(f"{order}I", len(rings)) + body if kind == "polygon" else body or struct.pack(f"{order}I", 0))


def decoded(data: bytes) -> tuple[str, list]:
    """Kind and parts; an error if the bytes are of another kind, cut off or too long.  Kinds with more than two coordinates are not known."""
    kind, parts, end = _decoded(data, 0)
    if end != len(data):
        raise ValueError(f"{len(data) - end} bytes after a geometry")
    return kind, parts


def _decoded(data: bytes, at: int) -> tuple[str, list, int]:
    try:
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(f"{order}I", data, at + 1)
        if code not in _NAMES or data[at] > 1:
            raise ValueError(f"no known geometry: kind {code}")
        kind, at = _NAMES[code], at + 5

        def points(n: int) -> list[dict[str, float]]:
            nonlocal at
            flat = struct.unpack_from(f"{order}{2 * n}d", data, at)
            at += 16 * n
            return [{"x": x, "y": y} for x, y in zip(flat[::2], flat[1::2], strict=True)]

        def count() -> int:
            nonlocal at
            (n,) = struct.unpack_from(f"{order}I", data, at)
            at += 4
            return n

        if kind == "point":
            ring = points(1)
            return kind, [[ring]] if ring[0]["x"] == ring[0]["x"] else [], at
        if kind == "line":
            ring = points(count())
            return kind, [[ring]] if ring else [], at
        if kind == "polygon":
            rings = [points(count()) for _ in range(count())]
            return kind, [rings] if rings else [], at
        parts = []
        for _ in range(count()):
            inner, part, at = _decoded(data, at)
            if inner != _SINGLE[kind]:
                raise ValueError(f"{inner} within {kind}")
            parts += part or [[]]
        return kind, parts, at
    except (struct.error, IndexError):
        raise ValueError("a geometry is cut off") from None


def to_wkb(kind: Column, parts: Column) -> Column:
    """Well-known binary, little endian; null where either is."""

    # As text, since nested arrays of unequal lengths have no form in pandas.
    rows = F.when(kind.isNotNull() & parts.isNotNull(), F.to_json(F.struct(kind.alias("kind"), parts.alias("parts"))))

    @F.pandas_udf("binary")
    def from_text(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> bytes | None:
            if text is None:
                return None
            row = json.loads(text)
            return encoded(row["kind"], row["parts"])

        return texts.map(one)

    return from_text(rows)


def from_wkb(data: Column) -> Column:
    """(kind, parts) of well-known binary of either byte order; null for null."""

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        def one(value: bytes | None) -> str | None:
            if value is None:
                return None
            kind, parts = decoded(bytes(value))
            return json.dumps({"kind": kind, "parts": parts})

        return values.map(one)

    return F.from_json(decode(data), GEOMETRY)


def box(parts: Column) -> Column:
    """The bounds of a geometry as a struct; of nulls for one without points."""
    points = F.flatten(F.flatten(parts))
    return F.struct(*[f(points[axis]).alias(n) for n, f, axis in zip(_BOX, (F.array_min, F.array_min, F.array_max, F.array_max), "xyxy", strict=True)])


def curve_key(x: Column, y: Column, low: tuple[float, float], high: tuple[float, float], bits: int = 16) -> Column:
    """The place of a point along a Z-shaped curve through the square grid of 2^bits cells a side between low and high."""
    key = F.lit(0).cast("long")
    for value, a, b, shift in ((x, low[0], high[0], 0), (y, low[1], high[1], 1)):
        cell = F.floor((value - a) / ((b - a) or 1.0) * (1 << bits)).cast("long")
        cell = F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), cell))
        for i in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(cell, i).bitwiseAND(F.lit(1)), 2 * i + shift))
    return key


def write_located(rows: DataFrame, path: str, files: int, parts: str = "parts", box_column: str = "bbox") -> None:
    """Parquet in which near geometries lie in the same files and row groups, with their boxes as columns.

    Rows go to `files` ranges of the curve through the middles of their boxes, and lie in its order; geometries without points come first.
    """
    boxed = rows.withColumn(box_column, box(F.col(parts)))
    at = {n: F.col(f"{box_column}.{n}") for n in _BOX}
    low_x, low_y, high_x, high_y = boxed.agg(F.min(at["min_x"]), F.min(at["min_y"]), F.max(at["max_x"]), F.max(at["max_y"])).first()
    middle = [(at[f"min_{a}"] + at[f"max_{a}"]) / 2 for a in "xy"]
    key = F.lit(0) if low_x is None else curve_key(*middle, (low_x, low_y), (high_x, high_y))
    keyed = boxed.withColumn("_curve", key)
    keyed.repartitionByRange(files, "_curve").sortWithinPartitions("_curve").drop("_curve").write.parquet(path)


def read_box(spark: SparkSession, path: str, low: tuple[float, float], high: tuple[float, float], box_column: str = "bbox") -> DataFrame:
    """The rows whose box meets the given one; files and row groups without such rows are skipped by their bounds."""
    c = lambda n: F.col(f"{box_column}.{n}")
    return spark.read.parquet(path).where((c("min_x") <= high[0]) & (c("max_x") >= low[0]) & (c("min_y") <= high[1]) & (c("max_y") >= low[1]))
