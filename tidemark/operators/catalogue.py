"""Scene catalogue: candidate rules, preference among duplicates, and a cap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import holds

SELECTED, DUPLICATE, CAPPED = "candidate", "duplicate_lower_preference", "maximum_items_limit"


def first_reason(reasons: Sequence[tuple[str, Column]], otherwise: str = SELECTED) -> Column:
    """The name of the first rule that fails (its column holds), or `otherwise`."""
    return F.coalesce(*[F.when(holds(failed), F.lit(name)) for name, failed in reasons], F.lit(otherwise))


def candidate_reasons(available: Column, month: Column, months: Sequence[int], cloud: Column, maximum_cloud: float, coverage: Column, period: Column, partial_year: bool) -> list[tuple[str, Column]]:
    """The rules of a scene in their order, each with the column that holds where it fails.

    Unknown assets are missing, an unknown month is outside, an unknown cloud cover is 100 %
    and an unknown coverage none.
    """
    return [
        ("missing_required_asset", ~holds(available)),
        ("outside_configured_months", ~holds(month.isin(*months))),
        ("catalogue_cloud_cover_above_limit", F.coalesce(cloud, F.lit(100.0)) > maximum_cloud),
        ("no_aoi_overlap", ~holds(coverage > 0)),
        ("partial_current_year_disabled", holds(period == "partial_current_year") & F.lit(not partial_year)),
    ]


def select_scenes(scenes: DataFrame, reasons: Sequence[tuple[str, Column]], duplicate_group: str, preference: Sequence[Column], order: Sequence[Column], maximum: int | None = None) -> DataFrame:
    """Adds selection_reason and selected.

    Candidates (no rule fails) of one duplicate group keep the first by preference; of what
    is left, rows beyond the maximum in (ascending) order are capped.  preference and order
    have to be total.  The cap looks up the last row that fits, and compares the others with it, so
    that no task sorts all rows.
    """
    rated = scenes.withColumn("selection_reason", first_reason(reasons))
    candidate = F.col("selection_reason") == SELECTED
    place = F.row_number().over(Window.partitionBy(duplicate_group, candidate).orderBy(*preference))
    rated = rated.withColumn("selection_reason", F.when(candidate & (place > 1), DUPLICATE).otherwise(F.col("selection_reason")))
    if maximum is not None:
        keys = [F.col("selection_reason") == SELECTED, *order]
        last = rated.where(keys[0]).orderBy(*order).limit(maximum).select(F.max(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])).alias("_last"))
        mine = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
        beyond = holds(mine > F.col("_last")) | F.lit(maximum <= 0)
        rated = rated.crossJoin(F.broadcast(last)).withColumn("selection_reason", F.when((F.col("selection_reason") == SELECTED) & beyond, CAPPED).otherwise(F.col("selection_reason"))).drop("_last")
    return rated.withColumn("selected", F.col("selection_reason") == SELECTED)
