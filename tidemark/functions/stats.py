"""Statistics in which null is missing, and NaN and infinity are made null where data enter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Names = Sequence[str]
#: Ranges of values to a factor of two.
OCTAVE = 4096


def finite(value: Column) -> Column:
    """value as a double, or null where it is NaN or infinite."""
    value = value.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def holds(predicate: Column) -> Column:
    """predicate with unknown as false, as masks want it."""
    return F.coalesce(predicate, F.lit(False))


def share(predicate: Column, among: Column | None = None) -> Column:
    """The share of rows for which predicate holds, among those for which `among` does; null without any."""
    value = holds(predicate).cast("double")
    return F.avg(value if among is None else F.when(holds(among), value))


def quantile(value: Column, p: float, where: Column | None = None) -> Column:
    """The exact quantile with linear interpolation, of the finite values only."""
    return F.percentile(value if where is None else F.when(where, value), p)


def smallest_mode(df: DataFrame, keys: Names, value: str, name: str) -> DataFrame:
    """Per group, the most frequent non-null value; the smallest of several.  Counts first, so that no group is gathered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))


def _joined(left: DataFrame, right: DataFrame, keys: Names, how: str = "inner") -> DataFrame:
    """left join right on keys, of which nulls equal each other; a broadcast of one row if there are no keys."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    mine = [f"_right{i}" for i in range(len(keys))]
    renamed = right.withColumnsRenamed(dict(zip(keys, mine, strict=True)))
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, mine, strict=True)], how).drop(*mine)


def _range(value: Column) -> Column:
    """A whole number that grows with the value: OCTAVE of them to a factor of two, by sign."""
    size = F.floor(F.log2(F.abs(value)) * OCTAVE) + 2000 * OCTAVE
    return F.when(value == 0, F.lit(0)).when(value < 0, -size).otherwise(size).cast("long")


def placed(counts: DataFrame, keys: Names, value: str = "_v", n: str = "_n") -> DataFrame:
    """Adds to each distinct value of a group `_below`, how many values are less, `_total`, and `_distinct`, how many distinct ones there are.

    counts holds each (keys, value) once, with its number.  A group is cut into ranges of
    nearly equal values; sums by range give each range its start, and only within a range are
    values ordered.  So a task sees a range of a group and not all of it, exact as the result
    is; only values that all lie within a 4,096th of a factor of two share one range.
    """
    ranged = counts.withColumn("_range", _range(F.col(value).cast("double")))
    sums = ranged.groupBy(*keys, "_range").agg(F.sum(n).alias("_sum"), F.count(F.lit(1)).alias("_values"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *keys, "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
        F.sum("_sum").over(whole).alias("_total"), F.sum("_values").over(whole).alias("_distinct"),
    )
    inner = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_start") + F.coalesce(F.sum(n).over(inner), F.lit(0))
    return _joined(ranged, starts, [*keys, "_range"]).withColumn("_below", below).drop("_range", "_start")


def quantiles(df: DataFrame, keys: Names, values: Mapping[str, Column], wanted: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Per group, exact quantiles with linear interpolation: a column for each (name, name of a value, p).

    Nulls, NaN and infinity do not count.  Without keys there is one row; groups in which no
    value is known are not there.
    """
    long = F.explode(F.array(*[F.struct(F.lit(name).alias("_field"), finite(c).alias("_v")) for name, c in values.items()])).alias("_x")
    counts = df.select(*keys, long).select(*keys, "_x.*").where("_v is not null").groupBy(*keys, "_field", "_v").agg(F.count(F.lit(1)).alias("_n"))
    rows = placed(counts, [*keys, "_field"])

    def part(name: str, p: float) -> Column:
        """The value's share in the quantile: it counts as far as it is at the rank below or above."""
        at = (F.col("_total") - 1) * F.lit(float(p))
        low = F.floor(at)
        holds_ = lambda rank: ((F.col("_below") <= rank) & (rank < F.col("_below") + F.col("_n"))).cast("double")
        weight = holds_(low) * (low + 1 - at) + holds_(low + 1) * (at - low)
        return F.sum(F.when((F.col("_field") == name) & (weight > 0), F.col("_v") * weight))

    return rows.groupBy(*keys).agg(*[part(name, p).alias(out) for out, name, p in wanted])


def distribution(df: DataFrame, fields: Names, levels: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """One row per field: field, count, min, the quantiles (p10, ...), max, mean; all null but the count if there is no value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), finite(F.col(f)).alias("value")) for f in fields])).alias("x")).select("x.*")
    names = [f"p{round(100 * p):d}" for p in levels]
    at = quantiles(long, ["field"], {"value": F.col("value")}, [(n, "value", p) for n, p in zip(names, levels, strict=True)])
    rest = long.groupBy("field").agg(F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    return rest.join(at, "field", "left").select("field", "count", "min", *names, "max", "mean")


def medians(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """One row: the median of each value, by its name; null without any."""
    return quantiles(df, [], values, [(name, name, 0.5) for name in values])


def value_counts(df: DataFrame, *fields: str, missing: str | None = None) -> DataFrame:
    """Rows per value (or combination of values); nulls make groups of their own, under the label `missing` if one is given."""
    if missing is not None:
        df = df.withColumns({f: F.coalesce(F.col(f).cast("string"), F.lit(missing)) for f in fields})
    return df.groupBy(*fields).agg(F.count(F.lit(1)).alias("count"))


def spread(counts: DataFrame, keys: Names, prefix: str, extra: Mapping[str, float] | None = None, value: str = "_v", n: str = "_n") -> DataFrame:
    """Per group: {prefix}_p50, {prefix}_iqr and {prefix}_mad (the median distance from the median), and {prefix}_{name} for each name and level of extra.

    counts holds values with their numbers, so that a group's size does not matter, only that
    of its distinct values; groups that are too large for that are for `quantiles`.
    """
    levels = {"p25": 0.25, "p50": 0.5, "p75": 0.75} | dict(extra or {})
    at = counts.groupBy(*keys).agg(F.percentile(value, F.array(*map(F.lit, levels.values())), F.col(n)).alias("_q"))
    at = at.select(*keys, *[F.get("_q", F.lit(i)).alias(f"{prefix}_{name}") for i, name in enumerate(levels)])
    centred = _joined(counts, at.select(*keys, F.col(f"{prefix}_p50").alias("_centre")), keys)
    mad = centred.groupBy(*keys).agg(F.percentile(F.abs(F.col(value) - F.col("_centre")), 0.5, F.col(n)).alias(f"{prefix}_mad"))
    out = _joined(at.withColumn(f"{prefix}_iqr", F.col(f"{prefix}_p75") - F.col(f"{prefix}_p25")), mad, keys)
    return out.drop(*[f"{prefix}_{name}" for name in ("p25", "p75") if name not in (extra or {})])


def value_numbers(df: DataFrame, keys: Names, value: Column) -> DataFrame:
    """(keys, _v, _n): how often each known value occurs in each group."""
    return df.select(*keys, finite(value).alias("_v")).where("_v is not null").groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))


def percentile_ranks(df: DataFrame, keys: Names, fields: Sequence[tuple[str, int]], suffix: str = "_percentile", minimum: int = 0, constant: float | None = None) -> DataFrame:
    """Adds for each (field, direction) its average rank in its group, as a percentage of the group's values.

    Direction -1 ranks downwards.  Null values get no rank.  Groups of fewer than `minimum`
    values get none; if `constant` is given, groups of equal values get it.  Values are
    ranked among the distinct values of a group, range by range; what comes back is joined
    by value.
    """
    source = df
    for field, direction in fields:
        counts = source.where(F.col(field).isNotNull()).groupBy(*keys, F.col(field).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        rows = placed(counts, keys)
        total, n = F.col("_total"), F.col("_n")
        below = F.col("_below") if direction > 0 else total - F.col("_below") - n
        rank = (below + (n + 1) / 2) / total * 100
        if constant is not None:
            rank = F.when(F.col("_distinct") == 1, F.lit(float(constant))).otherwise(rank)
        ranks = rows.select(*keys, F.col("_v").alias(field), F.when(total >= minimum, rank).alias(field + suffix))
        df = _joined(df, ranks, [*keys, field], "left")
    return df
