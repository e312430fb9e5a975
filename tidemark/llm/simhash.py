"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 22, 21 and 21 bits.  The perfect binary
Golay code [23, 12, 7] maps a segment (padded with zeros to 23 bits) to the indices of
all codewords within distance 4: one index if the segment lies within 2 of a codeword,
else six.  Two segments that differ in at most two bits share an index, because a word
between them lies within 3 of some codeword, which is within 4 of both.

Two fingerprints that differ in at most four bits share a key of one of these kinds:

* a segment without errors exists: that segment itself, and an index of whichever other
  segment has at most two errors (34 bits, six kinds);
* all segments have errors, so each has at most two: indices of the first and the second
  segment, and whichever third of the last segment has no error (31 bits, three kinds).

Keys are joined by a shuffle, candidates are verified by their Hamming distance, and
connected components of the links are found by joins.  A key that many fingerprints share
is split: they are dealt again by that key and one of five parts of the fingerprint, of
which two within four bits of each other share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, connected_components, finish, row_keys, salted_left_join

SHINGLE = 4
SEED = 42
MAX_BITS = 4
_GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one key that are compared at once, at most.
RUN = 1024
#: First bit and number of bits of five parts; two fingerprints within four bits agree in one of them.
_PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - 11)
    return word


def _golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the high and low part of a word; by syndrome, the codeword offsets and how many there are."""
    high = np.array([_remainder(i << 12) for i in range(1 << 11)], np.int64)
    low = np.array([_remainder(i) for i in range(1 << 12)], np.int64)
    leader = {0: 0}
    singles = [1 << i for i in range(23)]
    for i, x in enumerate(singles):
        leader[_remainder(x)] = x
        for j, y in enumerate(singles[:i]):
            leader[_remainder(x ^ y)] = x ^ y
            for z in singles[:j]:
                leader[_remainder(x ^ y ^ z)] = x ^ y ^ z
    # A codeword's index is its upper 12 bits.  The code is linear, so what lies near a word is what lies
    # near its coset leader, shifted by a codeword.
    offsets, counts = np.zeros((2048, 6), np.int64), np.ones(2048, np.int64)
    for syndrome, error in leader.items():
        offsets[syndrome] = error >> 11
        if error.bit_count() == 3:
            near = {(flipped ^ leader[_remainder(flipped)]) >> 11 for flipped in (error ^ x for x in singles)} - {0}
            offsets[syndrome, 1:] ^= np.array(sorted(near))
            counts[syndrome] = 6
    return high, low, offsets, counts


_HIGH, _LOW, _OFFSETS, _COUNTS = _golay_tables()


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each 23-bit word: six columns of codeword indices (those within distance 4), and how many of them count."""
    syndrome = _HIGH[words >> 12] ^ _LOW[words & 0xFFF]
    return (words >> 11)[:, None] ^ _OFFSETS[syndrome], _COUNTS[syndrome]


def fuzzy_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and 64-bit keys: fingerprints within MAX_BITS of each other share a key."""
    f = fingerprints.astype(np.uint64)
    parts = [((f >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in _SEGMENTS]
    golay = [golay_indices(p) for p in parts]
    rows, keys, kind = [], [], 0
    everything = np.arange(len(f))
    for exact in range(3):
        for other in (x for x in range(3) if x != exact):
            index, count = golay[other]
            for k in range(6):
                at = everything[count > k]
                rows.append(at)
                keys.append(kind << 56 | parts[exact][at] << 12 | index[at, k])
            kind += 1
    (first, n_first), (second, n_second) = golay[0], golay[1]
    for part in range(3):
        clean = parts[2] >> 7 * part & 0x7F
        for i in range(6):
            for j in range(6):
                at = everything[(n_first > i) & (n_second > j)]
                rows.append(at)
                keys.append(kind << 56 | first[at, i] << 19 | second[at, j] << 7 | clean[at])
        kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None) -> int:
    """The SimHash of a text as an unsigned 64-bit number; zero if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)], np.uint64)
    octets = h.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(h)).tolist())


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the carried columns, which are longs: the fingerprint of each row's whole text, as a signed long.  A null text has no word."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x) for x in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fps), *batch.columns[2:]], ["doc_id", "fp", *carried])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), *carried)
    return rows.mapInArrow(each, ", ".join(f"{x} long" for x in ("doc_id", "fp", *carried)))


def _forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of the fingerprints of one key; each is compared with those that no link has reached yet."""
    left, right = [], []
    while len(fps):
        frontier, fps = [fps[0]], fps[1:]
        while frontier and len(fps):
            x = frontier.pop()
            near = np.bitwise_count(fps ^ x) <= MAX_BITS
            if near.any():
                reached, fps = fps[near], fps[~near]
                left.append(np.full(len(reached), x))
                right.append(reached)
                frontier.extend(reached)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links_in_runs(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of equal keys (both sorted by key).  Runs of over 32 give a spanning forest only."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    lengths = np.diff(edge)
    left, right = [], []
    small = np.repeat(lengths <= 32, lengths)
    k = 1
    while k < 32 and k < len(keys):
        at = np.flatnonzero(small[:-k] & (keys[:-k] == keys[k:]))
        if not len(at):
            break
        at = at[np.bitwise_count(fps[at] ^ fps[at + k]) <= MAX_BITS]
        left.append(fps[at])
        right.append(fps[at + k])
        k += 1
    for n in np.flatnonzero(lengths > 32):
        a, b = _forest(fps[edge[n] : edge[n + 1]])
        left.append(a)
        right.append(b)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _finer(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint under five keys, of its key and one of its _PARTS each: those within MAX_BITS that share a key share one of these."""
    made = []
    for n, (at, bits) in enumerate(_PARTS):
        part = (fps >> np.uint64(at)) & np.uint64((1 << bits) - 1)
        made.append(finish(finish(keys.view(np.uint64)) + (part * np.uint64(len(_PARTS)) + np.uint64(n))).view(np.int64))
    return np.concatenate(made), np.tile(fps, len(_PARTS))


def _verified(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp), sorted by key, to links (a, b, no key) within each key; rows of keys with over `most` to (fp, nothing, finer key).

    A run may cross batches.  No more than `most` rows of a run are held, if most is given.
    """
    keys, fps, passed = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

    def batch_of(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
        columns = [x if x is None else np.ascontiguousarray(x).view(np.int64) for x in (a, b, key)]
        return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()) if x is None else pa.array(x) for x in columns], ["a", "b", "key"])

    def out(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
        length = np.diff(edge)
        long = np.zeros(len(k), bool) if most is None else np.repeat((length > most) | (k[edge[:-1]] == passed), length)
        a, b = _links_in_runs(k[~long], f[~long])
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
        yield batch_of(pairs[:, 0], pairs[:, 1], None)
        if long.any():
            key, fp = _finer(k[long], f[long])
            yield batch_of(fp, None, key)

    for batch in batches:
        k, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f.view(np.uint64)])
        if not len(keys):
            continue
        whole = int(np.searchsorted(keys, keys[-1], "left"))
        if most is not None and len(keys) - whole > most:
            # The last run is too long already: all of it goes on to finer keys, as will what follows of it.
            yield from out(keys, fps)
            passed, keys, fps = keys[-1], keys[:0], fps[:0]
        elif whole:
            yield from out(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
    if len(keys):
        yield from out(keys, fps)


def fingerprint_links(distinct: DataFrame, most: int = RUN) -> DataFrame:
    """(a, b): links of distinct fingerprints `fp`; all of them, but for keys of over 32 fingerprints, of which a spanning forest.

    Keys of over `most` fingerprints are not compared as they are: their fingerprints are
    dealt anew, under five finer keys each, so that a dense key is work for many tasks.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for first in range(0, len(fps), 4096):
                part = fps[first : first + 4096]
                rows, keys = fuzzy_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])

    def links(keys: DataFrame, at_most: int | None) -> DataFrame:
        in_order = keys.repartition("key").sortWithinPartitions("key")
        return in_order.mapInArrow(lambda b: _verified(b, at_most), "a long, b long, key long")

    first = checkpointed(links(distinct.select("fp").mapInArrow(keyed, "key long, fp long"), most).distinct())
    found = first.where("key is null").select("a", "b")
    dense = first.where("key is not null").select("key", F.col("a").alias("fp"))
    if dense.isEmpty():
        return found
    return found.union(links(_in_blocks(dense, most), None).select("a", "b")).distinct()


def _in_blocks(dense: DataFrame, most: int) -> DataFrame:
    """(key, fp), where the fingerprints of a key of over `most` fall into blocks of about that many, and each two blocks get a key.

    So no task holds such a key whole, each pair of its fingerprints meets, and each block
    pair gives a spanning forest of its own.
    """
    dense = checkpointed(dense.distinct())
    counts = checkpointed(dense.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most))
    if counts.isEmpty():
        return dense
    blocks = counts.select("key", F.ceil(F.col("n") / most).cast("int").alias("blocks"))
    sized = salted_left_join(dense, blocks, ["key"], "fp", dense.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    block = F.pmod(F.xxhash64("fp", F.lit(5)), F.col("blocks")).cast("int")
    split = sized.where("blocks is not null").withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.xxhash64("key", F.least("block", "with"), F.greatest("block", "with"))
    return sized.where("blocks is null").select("key", "fp").union(split.select(pair.alias("key"), "fp"))


def simhash_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the least doc_id that links reach).

    Equal texts, and any documents without a word, have equal fingerprints and so one
    component.  Groups are of rows: rows of one id fall into groups by their texts, and rows
    with a null id link like others, but name no component (component_id is null where no
    row of it has an id).  Repeated rows stay.  An empty table gives an empty result.
    """
    rows = checkpointed(fingerprints(docs, id_column, text_column))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")))
    components = connected_components(fingerprint_links(distinct))
    of = distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left").where("n > 1 or component is not null")
    of = checkpointed(of.select("fp", "least", F.coalesce("component", "fp").alias("component")))
    names = of.groupBy("component").agg(F.min("least").alias("name"), F.count(F.lit(1)).alias("n"))
    shared = salted_left_join(of, names.drop("n"), ["component"], "fp", names.select("component", "n")).select("fp", "name")
    return salted_left_join(rows, shared, ["fp"], "doc_id", distinct.select("fp", "n")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("name", "doc_id").alias("component_id"),
    )


def near_duplicates_removed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of docs but for near-duplicates: of each group the row of the least id stays, and a row of a null id only where no other is.

    Groups are of rows, not of ids: rows of a null id take part like others, rows of one id
    fall into groups by their texts, and of rows that are equal in all columns one stays.
    """
    keys = row_keys(docs)
    keyed = docs.withColumns(keys)
    rows = checkpointed(fingerprints(keyed, id_column, text_column, tuple(keys)))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *keys)).alias("least")
    distinct = checkpointed(rows.groupBy("fp").agg(least))
    components = connected_components(fingerprint_links(distinct))
    of = distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left")
    stay = of.groupBy(F.coalesce("component", "fp")).agg(F.min("least").alias("least")).select(*[F.col(f"least.{x}").alias(x) for x in keys])
    return keyed.dropDuplicates([*keys]).join(stay, [*keys], "left_semi").select(docs.columns)
