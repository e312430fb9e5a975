"""Mixing sources to target weights by subset-sum budget fitting.

The share of each source is filled like connected vessels: its target is its weight's part
of the whole, but at most `repeats` times its size, and what it cannot take goes to the
others by weight.  A source repeats all its documents as often as they fit whole; for the
rest, documents are counted by exact length, lengths give proportional shares of most of
it, and a bounded-knapsack dynamic programme over the remaining counts fits what is left.  Which documents of a length are taken follows a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, fresh, row_keys, salted_left_join

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
SEED = 9
#: The documents of one length are dealt to hash ranges of about so many, so that no length is one task's work; there are MOST_RANGES at most.
PER_RANGE, MOST_RANGES = 50_000, 1 << 20
#: Words of a source's budget that are left to the dynamic programme.
LAST_WORDS = 1 << 16


def word_count(text: Column) -> Column:
    """The number of words `[^\\x20\\x09-\\x0D]+`; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights repeat over sources by code point, null last.

    A source is full at a level of target per weight of repeats * size / weight.  In order
    of that level, the sources before some point are full and the others share what the
    full ones leave; the window runs over the list of sources, not over rows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("full", F.col("source_size") * float(repeats)).withColumn("level", F.col("full") / F.col("weight"))
    order = Window.orderBy("level", F.col("source").isNull(), F.col("source").cast("binary"))
    before, after, everything = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    shared = weighed.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))).withColumn("share", F.col("left") / F.sum("weight").over(after))
    # Once a source is not full, no later one is: the first such source sets the level for all that follow.
    first = F.first(F.when(F.col("level") > F.col("share"), F.col("share")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return shared.select("source", "source_size", F.coalesce(F.col("weight") * first, F.col("full")).alias("target"))


def _fitted(lengths: np.ndarray, counts: np.ndarray, budget: int, times: int = 1) -> np.ndarray:
    """How many documents of each length to take, so that their lengths add up to budget or come as near below as they can.

    Of what the budget is above LAST_WORDS, each length has its proportional share; what
    rounding leaves of that is filled with one more of each length, the longest first.  For
    the last words, a dynamic programme over all sums up to them (bits of a whole number)
    takes from what is left, in a fixed random order of the lengths so that none is favoured;
    only sums that no document's first use reaches use documents up to `times` times.
    """
    total = int((lengths * counts).sum())
    if not total or (budget >= total and times == 1):
        return counts.copy()
    take = np.array([int(c) * max(0, budget - LAST_WORDS) // total for c in counts.tolist()], np.int64)
    rest = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if lengths[i] and take[i] < counts[i] and rest - lengths[i] >= LAST_WORDS:
            take[i] += 1
            rest -= int(lengths[i])
    # Sums of what is left, with each length's count split into powers of two.
    mask, reach, items = (1 << (rest + 1)) - 1, 1, []
    order = np.random.default_rng(len(lengths)).permutation(len(lengths)).tolist()
    for i, left in [(i, counts[i] - take[i]) for i in order] + [(i, counts[i] * (times - 1)) for i in order]:
        if reach == mask:
            break
        n, part = int(min(left, rest // lengths[i] if lengths[i] else 0)), 1
        while n > 0:
            part = min(part, n)
            items.append((i, part, reach))
            reach |= reach << part * int(lengths[i]) & mask
            n -= part
            part *= 2
    at = reach.bit_length() - 1
    for i, part, earlier in reversed(items):
        if not earlier >> at & 1:
            take[i] += part
            at -= part * int(lengths[i])
    return take


def _fit_group(pdf: pd.DataFrame, repeats: int) -> pd.DataFrame:
    """The length counts of one source to the number to take of each length."""
    pdf = pdf.sort_values("size").reset_index(drop=True)
    budget = int(round(pdf["target"].iloc[0] - pdf["whole"].iloc[0] * pdf["source_size"].iloc[0]))
    return pdf.assign(take=_fitted(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), max(0, budget), max(1, repeats - int(pdf["whole"].iloc[0]))))[["source", "size", "n", "take"]]


def mix_plan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (its size times how often the mix repeats it).

    A null text has no words; documents without words are taken 0 words.  Null sources form
    one source of their own.  Documents of equal length are told apart by a seeded hash of
    their id (where it is null, of their text), and rows of equal ids singly; a rerun takes
    the same ones.
    """
    return _plan(docs, id_column, text_column, source_column, weights, repeats, seed).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def _plan(docs: DataFrame, id_column: str, text_column: str, source_column: str, weights: tuple[float, ...], repeats: int, seed: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, times, and the carried columns, which also order rows of equal ids."""
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), word_count(F.col(text_column)).alias("size"),
        F.when(F.col(id_column).isNull(), F.xxhash64(text_column, F.lit(seed))).otherwise(F.xxhash64(id_column, F.lit(seed))).alias("hash"), *carried,
    )
    # The source as a key that equals itself when null.
    rows = checkpointed(rows.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    # At most twice as many ranges as the rows would fill if all were of one length, which any length may be.
    bits = max(6, min(MOST_RANGES, rows.count() // PER_RANGE).bit_length())
    range_of = F.shiftrightunsigned("hash", 64 - bits)
    ranges = checkpointed(rows.withColumn("range", range_of).groupBy("key", "source", "size", "range").agg(F.count(F.lit(1)).alias("n")))
    lengths = ranges.groupBy("key", "source", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, repeats)
    targets = checkpointed(
        targets.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        .withColumn("whole", F.least(F.lit(repeats).cast("long"), F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long")))
        .drop("source")
    )
    # One group per source: its distinct lengths, whose number is bounded by the longest document, not by rows.
    taken = lengths.drop("source").join(targets, "key").withColumnRenamed("key", "source").groupBy("source").applyInPandas(lambda pdf: _fit_group(pdf, repeats), "source string, size long, n long, take long").select(F.col("source").alias("key"), "size", F.expr("take div n").alias("every"), F.expr("take % n").alias("take"))
    # The first `take` documents of a length by hash: whole ranges up to some range, and a part of that one.
    in_order = Window.partitionBy("key", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    quota = ranges.join(taken, ["key", "size"]).withColumn("quota", F.greatest(F.lit(0), F.least(F.col("n"), F.col("take") - F.coalesce(F.sum("n").over(in_order), F.lit(0)))))
    partial = quota.where("quota > 0 or every > 0").select("key", "size", "range", "quota", "every")
    ranked = rows.withColumn("range", range_of).withColumn("place", F.row_number().over(Window.partitionBy("key", "size", "range").orderBy("hash", "doc_id", *carried)))
    chosen = ranked.join(partial, ["key", "size", "range"], "left").withColumn("extra", F.coalesce((F.col("place") <= F.col("quota")).cast("long") + F.col("every"), F.lit(0)))
    out = salted_left_join(chosen.select("key", "doc_id", "size", "extra", "hash", *carried), targets, ["key"], "hash", lengths.groupBy("key").agg(F.sum("n").alias("n")))
    return out.select("doc_id", "size", "source_size", "target", F.least(F.lit(repeats), F.col("whole") + F.col("extra")).alias("times"), *carried)


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """The documents that the mix takes, each row as often as it takes it, with the columns of docs.

    Copies belong to rows, whatever their ids; rows that are equal in all columns share theirs.
    """
    keys = row_keys(docs)
    keyed = docs.withColumns(keys)
    times, run, copy = (fresh(name, docs.columns) for name in ("_times", "_run", "_copy"))
    plan = _plan(keyed, id_column, text_column, source_column, weights, repeats, seed, tuple(keys)).where("size > 0 and times > 0")
    plan = plan.groupBy(*keys).agg(F.sum("times").alias(times))
    # Of equal rows one is joined and copied for all, in runs of bounded length.
    runs = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / 1024))
    joined = keyed.dropDuplicates([*keys]).join(plan, [*keys]).withColumn(run, F.explode(runs))
    copies = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.least(F.lit(1024), F.col(times) - 1024 * F.col(run)))))
    return copies.select(docs.columns)
