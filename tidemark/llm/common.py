"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

#: A key is hot if it holds over 1/MOST_HOT of all rows, and HOT_ROWS at least; so there are fewer than MOST_HOT hot keys.
MOST_HOT, HOT_ROWS = 512, 20_000
#: Tasks that the rows of a hot key are dealt to.
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster.  Where none is set, a temporary one if driver and executors are one process, else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def removed(spark: SparkSession, folder: str) -> None:
    """Removes a folder, on whatever file system its path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder, so that lost executors cost no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_mod(id_column: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; null where the id is null."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: object, modulus: int, remainder: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def row_keys(rows: DataFrame) -> dict[str, Column]:
    """128 bits of hash over all columns of a row, as two columns of new names: rows with equal keys are equal, and never null.

    Rows of equal or null ids are told apart by them, on every read and in any partition.
    Maps are equal if they have the same entries, in any order.
    """
    columns = rows.columns
    # A hash skips nulls, so which columns are null counts too.
    nulls = [F.col(f"`{c}`").isNull() for c in columns]
    names = [fresh(name, columns) for name in ("_row_a", "_row_b")]
    values = [_hashable(F.col(f"`{f.name}`"), f.dataType) for f in rows.schema]
    return {name: F.xxhash64(F.lit(seed), *values, *nulls) for seed, name in enumerate(names, 1)}


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, MapType) or isinstance(kind, StructType) and any(_holds_map(f.dataType) for f in kind)


def _hashable(value: Column, kind: DataType) -> Column:
    """A value with each map within it as the sorted array of its entries' texts, which can be hashed."""
    if not _holds_map(kind):
        return value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _hashable(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_hashable(value[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(kind)]))
    entry = lambda e: F.to_json(F.struct(e["key"].alias("k"), _hashable(e["value"], kind.valueType).alias("v")))
    return F.array_sort(F.transform(F.map_entries(value), entry))


def fresh(name: str, columns: Iterable[str]) -> str:
    """name, with underscores before it until no column is called so (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def salted_left_join(large: DataFrame, small: DataFrame, keys: list[str], salt_from: str, counts: DataFrame) -> DataFrame:
    """large left join small on keys, where counts holds the rows of large by key, as `n`, and small holds each key once.

    Rows of keys that are hot by these counts are dealt to SALTS tasks by a hash of salt_from,
    and small holds such a key once for each; all other keys are joined as they are.  The hot
    keys are fewer than MOST_HOT, so broadcasting them is safe.
    """
    rows, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    least = max(HOT_ROWS, rows // MOST_HOT)
    if most <= least:
        return large.join(small, keys, "left")
    hot = F.broadcast(counts.where(F.col("n") > least).select(*keys, F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_from), F.lit(SALTS))).otherwise(0).cast("int")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = large.join(hot, keys, "left").withColumn("_salt", salt).drop("_hot")
    right = small.join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [*keys, "_salt"], "left").drop("_salt")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of edges, component being the least node that links reach.

    Each round gives every node the least of its neighbours as its parent, follows parents
    twice, and replaces the ends of each edge by what they lead to; edges within one tree
    vanish.  All rounds are joins and aggregations of tables; nothing is collected.
    """
    edge = checkpointed(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())
    maps: list[DataFrame] = []
    while not edge.isEmpty():
        both = edge.union(edge.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).select("node", F.least("node", "up").alias("up"))
        parent = checkpointed(parent)
        parent = checkpointed(_one_up(_one_up(parent, parent), parent))
        maps.append(parent)
        moved = edge
        for end, other in (("a", "b"), ("b", "a")):
            root = parent.select(F.col("node").alias(end), F.col("up").alias("root"))
            degrees = edge.groupBy(end).agg(F.count(F.lit(1)).alias("n"))
            moved = salted_left_join(moved, root, [end], other, degrees).withColumn(f"root_{end}", F.col("root")).drop("root")
        ends = F.least("root_a", "root_b"), F.greatest("root_a", "root_b")
        edge = checkpointed(moved.select(ends[0].alias("a"), ends[1].alias("b")).where("a <> b").distinct())
    if not maps:
        return edge.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps[-1]
    for earlier in reversed(maps[:-1]):
        found = _one_up(earlier, found)
    return found.select("node", F.col("up").alias("component"))


def _one_up(pointers: DataFrame, parent: DataFrame) -> DataFrame:
    """(node, up): what `up` leads to in parent, where it leads on."""
    above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
    counts = pointers.groupBy("up").agg(F.count(F.lit(1)).alias("n"))
    return salted_left_join(pointers, above, ["up"], "node", counts).select("node", F.coalesce("top", "up").alias("up"))


def least_by_hash(rows: DataFrame, h: Column, most: int, n: int) -> DataFrame:
    """The `most` rows of least h, a 64-bit hash, of n rows; ties in any order.

    A bound on h that leaves few more rows comes first, as each task hands `most` rows on to be ordered otherwise.
    """
    share = (most + 8 * most**0.5 + 64) / max(n, 1)
    near = rows if share >= 1 else rows.where(h < F.lit(int(-(2**63) + share * 2**64)))
    return near.orderBy(h).limit(most)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column and the n + 1 offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def in_slices(offsets: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Row ranges of about size bytes each (one row at least)."""
    out, first = [], 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        out.append((first, last))
        first = last
    return out


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n + 1:
        n = max(n, 1 << 20)
        for key, base in (("up", _STEP), ("down", pow(_STEP, -1, 2**64))):
            factors = np.full(n + 1, base, np.uint64)
            factors[0] = 1
            _powers[key] = np.cumprod(factors, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def finish(h: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit values that loses nothing."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, byte_values: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[starts:ends], from running sums of byte value times a power of an odd step."""
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values[data] * up[: len(data)], out=sums[1:])
    return finish((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words `[^\\x20\\x09-\\x0D]+` of all rows."""
    word = ~_WHITE[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    before[rows] = False
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    after[offsets[1:][np.diff(offsets) > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word, lower-cased in A-Z, and its row number."""
    starts, ends, row = words_of(data, offsets)
    return run_hashes(data, starts, ends, _MIX[_LOWER]), row


def partition_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow, of which function maps one record batch to any number of record batches."""

    def each(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(each, schema)
