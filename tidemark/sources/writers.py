"""Writers: sorted and plain Parquet, CSV export, and run manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import exported
from ..operators.quality import ids_checksum


def sorted_parquet(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Parquet, ordered by the keys (the first column if none are given) within and across files."""
    df.orderBy(*(keys or df.columns[:1])).write.mode("overwrite").option("compression", "zstd").parquet(path)


def parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*(partition_by or [])).parquet(path)


def csv_export(df: DataFrame, path: str) -> None:
    """The table without geometry, proxies marked in their names, with a header."""
    exported(df).write.mode("overwrite").option("header", True).csv(path)


def map_records(df: DataFrame, line: str = "line", fields: list[str] | None = None) -> DataFrame:
    """One JSON record per line, as map layers take them: path and the fields."""
    return df.select(F.to_json(F.struct(*(fields or []), F.transform(line, lambda p: F.array(p["x"], p["y"])).alias("path"))).alias("record"))


def manifest(df: DataFrame, key: str, **facts: object) -> DataFrame:
    """One row: the number of ids, their checksum, and the facts as JSON with sorted keys."""
    return ids_checksum(df, key).withColumn("facts", F.lit(json.dumps(facts, sort_keys=True, default=str)))


def assert_unchanged(before: DataFrame, after: DataFrame) -> None:
    """An error if two manifests differ in ids."""
    a, b = before.first(), after.first()
    if (a["checksum"], a["count"]) != (b["checksum"], b["count"]):
        raise ValueError("the ids of a protected table changed")


def tables_by_name(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        sorted_parquet(df, f"{folder}/{name}.parquet")
