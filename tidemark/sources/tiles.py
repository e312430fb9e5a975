"""Grid tiles as files: which there are, which a box needs, and whether they fit together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Check, report
from .readers import pruned_tiles


def tile_files(spark: SparkSession, path: str | None = None, paths: Sequence[str] | None = None, directory: str | None = None, pattern: str | None = None, suffix: str = "*.parquet") -> DataFrame:
    """Path and length of each file, once each, in order of the path whatever its case; an error if a file is missing or none is found.

    Give one of path, paths, directory (its files that fit the suffix) and pattern.  Only names are read.
    """
    given = [x for x in (path, paths, directory, pattern) if x is not None]
    if len(given) != 1:
        raise ValueError("give exactly one of path, paths, directory and pattern")
    reader = spark.read.format("binaryFile")
    if directory is not None:
        reader = reader.option("pathGlobFilter", suffix)
    try:
        files = reader.load(list(paths) if paths is not None else given[0]).select("path", "length").distinct()
    except AnalysisException as e:
        raise FileNotFoundError(f"no such tiles: {given[0]}") from e
    if files.isEmpty():
        raise FileNotFoundError(f"no tiles: {given[0]}")
    return files.orderBy(F.lower("path"), "path")


def tile_checks(tiles: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Checks of tiles (path, crs, resolution_x, resolution_y, units, min_x, min_y, max_x, max_y), and of those that overlap a box.

    Resolutions may differ from that of the first tile by 1e-6 and a millionth; the value
    is the greatest difference in that unit.  Units are compared without regard to case and
    outer spaces.
    """
    sizes = ("resolution_x", "resolution_y")
    first = {c: F.min_by(c, F.struct(F.lower("path"), "path")) for c in sizes}
    off = [F.greatest(F.max(c) - first[c], first[c] - F.min(c)) / (1e-6 + 1e-6 * first[c]) for c in sizes]
    units = F.lower(F.trim("units"))
    mixed = lambda c: F.coalesce((F.min(c) != F.max(c)).cast("int"), F.lit(0))
    every = report(tiles, [
        Check("tiles_without_crs", F.count_if(F.coalesce(F.trim("crs"), F.lit("")) == ""), high=0),
        Check("tiles_without_resolution", F.count_if(~F.coalesce((F.col("resolution_x") > 0) & (F.col("resolution_y") > 0), F.lit(False))), high=0),
    ])
    chosen = report(pruned_tiles(tiles, box), [
        Check("tiles_in_box", F.count(F.lit(1)), low=1), Check("mixed_crs", mixed(F.col("crs")), high=0),
        Check("resolution_difference", F.greatest(*off), high=1), Check("mixed_units", mixed(units), high=0),
    ])
    return every.unionByName(chosen)


def preferred_table(spark: SparkSession, paths: Mapping[str, str]) -> tuple[str, DataFrame]:
    """The name and the table of the first path, in the order given, that can be read."""
    for name, path in paths.items():
        try:
            return name, spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of {list(paths.values())} exists")
