"""Readers: vectors as GeoJSON, grids and tables as Parquet, catalogues as CSV or JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import point
from ..operators.filters import AttributeFilter, attribute_filtered

#: Coordinates are kept as text until the geometry's type says how deep they nest.
_FEATURES = "features array<struct<id:string,properties:string,geometry:struct<type:string,coordinates:string>>>"
_DEPTH = {"Point": 1, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}


def _points(array: Column) -> Column:
    return F.transform(array, lambda p: point(p[0], p[1]))


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: feature_id, properties (JSON), geometry_type and parts, an array of arrays of lines.

    A line is one part of one line, a polygon one part of its rings (the outer first), and
    the multi types have several parts.  Unknown geometry types and empty ones have none.
    """
    raw = spark.read.option("multiLine", True).schema(_FEATURES).json(path).select(F.explode("features").alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    depth = lambda n: F.from_json(text, "array<" * n + "double" + ">" * n)
    parts = (
        F.when(kind == "LineString", F.array(F.array(_points(depth(2)))))
        .when(kind == "MultiLineString", F.transform(depth(3), lambda line: F.array(_points(line))))
        .when(kind == "Polygon", F.array(F.transform(depth(3), _points)))
        .when(kind == "MultiPolygon", F.transform(depth(4), lambda polygon: F.transform(polygon, _points)))
    )
    return raw.select(F.col("f.id").alias("feature_id"), F.col("f.properties").alias("properties"), kind.alias("geometry_type"), F.coalesce(parts, F.array().cast("array<array<array<struct<x:double,y:double>>>>")).alias("parts"))


def with_properties(features: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Adds named properties as text columns."""
    return features.withColumns({f: F.get_json_object("properties", f"$.{f}") for f in fields})


def lines_of(features: DataFrame) -> DataFrame:
    """One row per part of a line feature, never joined together: part and line."""
    rows = features.where(F.col("geometry_type").isin("LineString", "MultiLineString")).select("*", F.posexplode("parts").alias("part", "_p"))
    return rows.withColumn("line", F.get("_p", F.lit(0))).drop("_p", "parts")


def polygons_of(features: DataFrame) -> DataFrame:
    """One row per polygon: polygon_id (feature and part) and rings, without the closing vertex."""
    rows = features.where(F.col("geometry_type").isin("Polygon", "MultiPolygon")).select("*", F.posexplode("parts").alias("part", "_p"))
    opened = F.transform("_p", lambda r: F.when((F.size(r) > 1) & (F.element_at(r, 1) == F.element_at(r, -1)), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r))
    return rows.select(F.concat_ws("_", "feature_id", "part").alias("polygon_id"), opened.alias("rings"))


def direct_coastline(features: DataFrame, filters: Sequence[AttributeFilter], box: tuple[float, float, float, float], suspect_distance: float = 1.0) -> DataFrame:
    """Line parts that pass the filters and touch the box, with duplicate_suspect: whether another feature that the filters reject starts within a distance of its start."""
    from ..operators.coast import within_distance

    fields = [f.field for f in filters]
    parts = lines_of(with_properties(features, fields)).withColumn("p", F.get("line", F.lit(0)))
    low, high = (lambda a: F.array_min(F.col("line")[a])), (lambda a: F.array_max(F.col("line")[a]))
    parts = parts.where((low("x") <= box[2]) & (high("x") >= box[0]) & (low("y") <= box[3]) & (high("y") >= box[1]))
    parts = parts.withColumn("part_key", F.concat_ws("_", "feature_id", "part"))
    chosen = attribute_filtered(parts, filters)
    others = parts.join(chosen.select("part_key"), "part_key", "left_anti").select(F.col("part_key").alias("other"), "p")
    near = within_distance(chosen, others, "part_key", "other", suspect_distance).select("part_key").distinct().withColumn("duplicate_suspect", F.lit(True))
    return chosen.join(near, "part_key", "left").withColumn("duplicate_suspect", F.coalesce("duplicate_suspect", F.lit(False))).drop("p")


def text_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns text, the empty string where a value is missing."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).na.fill("")


def source_warnings(sources: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Adds metadata_warnings: the fields that are empty or unknown."""
    poor = [F.when((F.trim(F.coalesce(f, F.lit(""))) == "") | F.contains(F.upper(f), F.lit("UNKNOWN")), F.lit(f)) for f in fields if f in sources.columns]
    return sources.withColumn("metadata_warnings", F.array_compact(F.array(*poor)))


def scene_items(spark: SparkSession, path: str, line_each: bool = False) -> DataFrame:
    """Scenes of item-collection JSON files, each one collection (or one on each line): scene_id, collection, datetime, year, month, tile, version, cloud, box and asset sizes by key."""
    schema = (
        "features array<struct<id:string,collection:string,bbox:array<double>,properties:struct<datetime:timestamp,`grid:code`:string,`processing:version`:string,`eo:cloud_cover`:double>,"
        "assets:map<string,struct<href:string,`file:size`:bigint>>>>"
    )
    f = spark.read.option("multiLine", not line_each).schema(schema).json(path).select(F.explode("features").alias("f"))
    when = F.col("f.properties.datetime")
    return f.select(
        F.col("f.id").alias("scene_id"), F.col("f.collection").alias("collection"), when.alias("datetime"), F.year(when).alias("year"), F.month(when).alias("month"),
        F.col("f.properties.`grid:code`").alias("tile"), F.col("f.properties.`processing:version`").alias("version"), F.col("f.properties.`eo:cloud_cover`").alias("cloud"), F.col("f.bbox").alias("bbox"), F.col("f.assets").alias("assets"),
    )


def boxes_overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Whether boxes (min x, min y, max x, max y) overlap."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def pruned_tiles(tiles: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Tiles (min_x, min_y, max_x, max_y) that overlap a box, so that only their cells are read."""
    return tiles.where(boxes_overlap([F.col(c) for c in ("min_x", "min_y", "max_x", "max_y")], [F.lit(float(v)) for v in box]))


def bands(tables: Mapping[str, DataFrame], keys: Sequence[str] = ("scene_id", "row", "col")) -> DataFrame:
    """Band tables (keys, value) side by side, a column per band, on the cells of the first."""
    (first, base), *rest = tables.items()
    out = base.select(*keys, F.col("value").alias(first))
    for name, df in rest:
        out = out.join(df.select(*keys, F.col("value").alias(name)), list(keys), "left")
    return out
