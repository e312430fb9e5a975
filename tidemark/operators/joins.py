"""Joins with contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import placed


class ContractError(ValueError):
    """Tables do not fit each other as a join demands."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> DataFrame:
    """df; an error with a few examples if a key repeats."""
    examples = duplicate_keys(df, keys).limit(5).collect()
    if examples:
        raise ContractError(f"{name}: repeated {', '.join(keys)}: {[tuple(r)[:-1] for r in examples]}")
    return df


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """A join of tables that both hold each key once at most; checked first."""
    return require_unique(left, keys, "left").join(require_unique(right, keys, "right"), list(keys), how)


def one_to_one_checked(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The left join, in which a repeated key on either side raises as the rows are made: no job runs before."""
    counted = lambda df: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in df.columns if c not in keys])
    a, b = counted(left), counted(right).withColumnRenamed("_n", "_m")
    once = F.assert_true((F.col("_n") == 1) & (F.coalesce("_m", F.lit(1)) == 1), F.lit("a key repeats"))
    return a.join(b, list(keys), "left").where(once.isNull()).drop("_n", "_m")


def key_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of one side only, with a column `side`: missing (only in left, the expected) or unexpected."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    only = lambda x, y, side: x.join(y, list(keys), "left_anti").withColumn("side", F.lit(side))
    return only(a, b, "missing").unionByName(only(b, a, "unexpected"))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """left join right, one to one; an error if the sets of keys differ."""
    differing = key_differences(left, right, keys).limit(5).collect()
    if differing:
        raise ContractError(f"keys differ: {[tuple(r) for r in differing]}")
    return one_to_one(left, right, keys)


def union_once(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both, those of first where a key is in both.  Each table holds a key once."""
    return first.unionByName(second.join(first.select(*keys), list(keys), "left_anti"))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of each key, the first in an order: one aggregation, no window over a key's rows."""
    rest = [c for c in df.columns if c not in keys]
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return firsts.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(df.columns)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows in the order of a hash of the key: the same ones each time."""
    return df.orderBy(F.xxhash64(key), key).limit(n)


def spread_sample(df: DataFrame, order: str, n: int) -> DataFrame:
    """n rows at equal steps of an order, the first and the last among them, by ranks taken range by range; fewer if there are fewer.  order holds each value once."""
    ranks = placed(df.groupBy(F.col(order).alias("_v")).agg(F.count(F.lit(1)).alias("_n")), [])
    # The row of rank r is the k-th chosen if floor(k (rows - 1) / (n - 1)) = r.
    k = F.ceil(F.col("_below") * (n - 1) / F.greatest(F.lit(1), F.col("_total") - 1))
    chosen = ranks.where(F.floor(k * (F.col("_total") - 1) / max(1, n - 1)) == F.col("_below")).select(F.col("_v").alias(order))
    return df.join(chosen, order, "left_semi")
