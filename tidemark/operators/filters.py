"""Filters that are safe with missing values and missing columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import holds


@dataclass(frozen=True)
class AttributeFilter:
    """A field that has one of some values, or begins with a prefix."""

    field: str
    values: tuple = ()
    prefix: str | None = None

    def __post_init__(self) -> None:
        if bool(self.values) == (self.prefix is not None):
            raise ValueError(f"filter on {self.field}: give either values or a prefix")

    def column(self) -> Column:
        of = F.col(self.field)
        return holds(of.isin(*self.values)) if self.values else holds(F.startswith(of.cast("string"), F.lit(self.prefix)))


def every(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def attribute_filtered(df: DataFrame, filters: Sequence[AttributeFilter]) -> DataFrame:
    """The rows that pass all filters; an error that names the columns there are if a field is unknown."""
    unknown = [f.field for f in filters if f.field not in df.columns]
    if unknown:
        raise ValueError(f"unknown fields {unknown}; there are {df.columns}")
    return df.where(every([f.column() for f in filters]))


def available(df: DataFrame, field: str) -> Column:
    """Whether a field is there and greater than 0; an absent column is nowhere available."""
    return holds(F.col(field).try_cast("double") > 0) if field in df.columns else F.lit(False)


def within(df: DataFrame, field: str, low: float | None = None, high: float | None = None) -> Column:
    """Whether a field lies within inclusive bounds.  No bound: all rows; an absent column: none; missing values pass no bound."""
    if low is None and high is None:
        return F.lit(True)
    if field not in df.columns:
        return F.lit(False)
    value = F.col(field).try_cast("double")
    return every([holds(test) for bound, test in ((low, value >= F.lit(low)), (high, value <= F.lit(high))) if bound is not None])


def flag_is(df: DataFrame, field: str, wanted: bool | None) -> Column:
    """Whether a flag, false where missing, is as wanted; with an absent column only `False` keeps rows."""
    if wanted is None:
        return F.lit(True)
    return holds(F.col(field)) == F.lit(wanted) if field in df.columns else F.lit(not wanted)


def contains_text(df: DataFrame, field: str, text: str | None) -> Column:
    """Whether a field contains a text, without regard to case and outer spaces; the text is no pattern."""
    wanted = (text or "").strip().lower()
    if not wanted:
        return F.lit(True)
    return holds(F.contains(F.lower(field), F.lit(wanted))) if field in df.columns else F.lit(False)


@dataclass(frozen=True)
class Filters:
    """Optional conditions of all kinds; those that are not given keep all rows."""

    one_of: Mapping[str, Sequence] | None = None
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None
    availability: Mapping[str, str] | None = None  # field: all, available or missing
    flags: Mapping[str, bool | None] | None = None
    search: tuple[str, str] | None = None  # field and text

    def column(self, df: DataFrame) -> Column:
        conditions = [holds(F.col(f).isin(*v)) if f in df.columns else F.lit(False) for f, v in (self.one_of or {}).items() if v]
        conditions += [within(df, f, *b) for f, b in (self.ranges or {}).items()]
        for field, wanted in (self.availability or {}).items():
            if wanted not in ("all", "available", "missing"):
                raise ValueError(f"availability of {field}: {wanted}")
            if wanted != "all":
                conditions.append(available(df, field) == F.lit(wanted == "available"))
        conditions += [flag_is(df, f, w) for f, w in (self.flags or {}).items()]
        if self.search:
            conditions.append(contains_text(df, *self.search))
        return every(conditions)


def filtered(df: DataFrame, filters: Filters) -> DataFrame:
    return df.where(filters.column(df))


def preferred_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in their order, once each."""
    return df.select(*dict.fromkeys(c for c in wanted if c in df.columns))


def without_geometry(df: DataFrame) -> DataFrame:
    """df without its point and line columns."""
    geometry = ("struct<x:double,y:double>", "array<struct<x:double,y:double>>", "array<array<struct<x:double,y:double>>>", "binary")
    return df.select(*[c for c, kind in df.dtypes if kind not in geometry])


def exported(df: DataFrame, prefixes: Sequence[str] = ("depth_", "gradient_", "distance_to_", "bathymetry_"), mark: str = "regional_proxy__") -> DataFrame:
    """The table as it is exported: no geometry, and proxies marked in their names."""
    plain = without_geometry(df)
    return plain.select(*[F.col(c).alias(mark + c if c.startswith(tuple(prefixes)) else c) for c in plain.columns])


def segment_flags(df: DataFrame) -> DataFrame:
    """Adds six flags: ambiguous, source_mismatch, large_coastal_gap, missing_bathymetry, missing_terrain and global_fallback."""
    has = lambda c: c in df.columns
    flags = {
        "ambiguous": holds(F.col("orientation_status") == "ambiguous") if has("orientation_status") else F.lit(False),
        "source_mismatch": holds(F.col("orientation_source_mismatch_flag")) if has("orientation_source_mismatch_flag") else F.lit(False),
        "large_coastal_gap": holds(F.col("bathymetry_large_coastal_gap_share") > 0) if has("bathymetry_large_coastal_gap_share") else F.lit(False),
        "missing_bathymetry": ~available(df, "bathymetry_valid_transect_share"),
        "missing_terrain": ~available(df, "terrain_valid_sample_share"),
    }
    fallback = [holds(F.col("global_fallback_source_share") >= 0.5)] if has("global_fallback_source_share") else []
    fallback += [holds(F.col("bathymetry_screening_class") == "background_only")] if has("bathymetry_screening_class") else []
    flags["global_fallback"] = reduce(lambda a, b: a | b, fallback, F.lit(False))
    return df.withColumns(flags)


# Parts of names of coast classes that are built, not natural, and want a look.
REVIEW_TOKENS = ("MUELLE", "ROMPEOLAS", "SLCONS", "VARADERO", "RIVER")


def class_review(df: DataFrame, field: str, tokens: Sequence[str] = REVIEW_TOKENS) -> DataFrame:
    """Rows per class that holds any of the tokens: class and count."""
    upper = F.upper(F.col(field).cast("string"))
    found = df.where(reduce(lambda a, b: a | b, (F.contains(upper, F.lit(t)) for t in tokens)))
    return found.groupBy(F.col(field).alias("class")).agg(F.count(F.lit(1)).alias("count"))


def analysis_period(when: Column, historical_end: str) -> Column:
    """partial_current_year after the end of the historical period, else historical_baseline; null for an unknown time."""
    return F.when(when.isNull(), None).when(when.cast("date") > F.lit(historical_end).cast("date"), "partial_current_year").otherwise("historical_baseline")
