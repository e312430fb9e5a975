"""Embedding near-duplicates by product quantisation over inverted lists.

Unit vectors go to the list of their nearest coarse centroid, and within it to the sub-list
of the nearest of a second set of centroids to what the first leaves; the rest is coded by
the nearest of CODES centroids in each of SUBSPACES subspaces, and the length of what the
code misses is kept with it.  Lists grow in number with the vectors, to LISTS times
SUB_LISTS, so that a list stays at about PER_LIST members up to a thousand million vectors.

The probes are sufficient.  Of two vectors within the linking radius, whose lists differ,
one lies within half the radius of the boundary between the two; it looks into the other's
list, there into every sub-list whose boundary is within the radius.  Within one list the
same holds of sub-lists, with half the radius.  In each list, table look-ups give the
distance of the exact query to each coded member; the triangle inequality turns the kept
length into a bound that no link exceeds, and candidates are ranked again by exact cosine.
So no link is lost, whatever the index was fitted on.

Vectors are only compared under equal labels and lengths, so an inverted list holds one of
each.  Equal vectors of a label are one vector with a multiplicity.  Long lists are cut into
blocks, and each vector meets each block it has to meet once; what comes out of a block is
a number per vector and a spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, connected_components, least_by_hash, salted_left_join

COSINE = 0.98
#: Vectors and bytes of vectors that the index of one width is fitted on, at most.
SAMPLE, SAMPLE_BYTES = 32_768, 8 << 20
SUBSPACES, CODES = 8, 64
PER_LIST, LISTS, SUB_LISTS = 1024, 1024, 1024
BLOCK = 1024
QUERIES = 512
#: Counted vectors and links of a block that are held before they are handed on.
HELD = 1 << 18


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """k centroids of x by Lloyd's rounds; with fewer distinct rows, some repeat."""
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        of = _nearest(x, centres)
        n = np.bincount(of, minlength=k)
        sums = np.stack([np.bincount(of, x[:, j], k) for j in range(x.shape[1])], 1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    parts = [_squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


class Cells:
    """Centroids, and how far a point is from the boundary of its nearest one's cell with each other cell."""

    def __init__(self, centres: np.ndarray) -> None:
        self.centres = centres
        self.gaps = np.sqrt(np.maximum(_squares(centres, centres), 1e-18))

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row, and its distances to the boundaries with the others (0 with its own)."""
        square = _squares(x, self.centres)
        home = square.argmin(1)
        return home, (square - square.min(1, keepdims=True)) / (2 * self.gaps[home])


class Index:
    """Coarse centroids of two levels and codebooks, fitted on unit vectors of one width."""

    def __init__(self, sample: np.ndarray, lists: int, sub_lists: int = 1, cosine: float = COSINE, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        self.width = -(-sample.shape[1] // SUBSPACES)
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6
        x = self.padded(sample)
        self.coarse = Cells(_kmeans(x, lists, rng))
        left = x - self.coarse.centres[_nearest(x, self.coarse.centres)]
        self.fine = Cells(_kmeans(left, sub_lists, rng) if sub_lists > 1 else np.zeros((1, x.shape[1])))
        left = (left - self.fine.centres[_nearest(left, self.fine.centres)])[:16384]
        self.books = [_kmeans(left[:, s], CODES, rng) for s in self._parts()]

    def _parts(self) -> list[slice]:
        return [slice(i * self.width, (i + 1) * self.width) for i in range(SUBSPACES)]

    def padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, SUBSPACES * self.width - x.shape[1])))

    def centre(self, at: np.ndarray) -> np.ndarray:
        """The centroid of each list by its number."""
        return self.coarse.centres[at // len(self.fine.centres)] + self.fine.centres[at % len(self.fine.centres)]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Home list, lists to probe (home first), codes and the lengths that the codes miss."""
        x, n = self.padded(x), len(self.fine.centres)
        list_, distance = self.coarse(x)
        row, to = np.nonzero(distance <= self.radius / 2)
        own = to == list_[row]
        sub, within = self.fine(x[row] - self.coarse.centres[to])
        home = list_ * n
        home[row[own]] += sub[own]
        # A row's own list is among those that it reaches, as its distance to it is 0.
        which, fine = np.nonzero(within <= np.where(own, self.radius / 2, self.radius)[:, None])
        reached, by = (to[which] * n + fine).astype(np.int32), row[which]
        other = reached != home[by]
        reached, by = reached[other], by[other]
        edges = np.searchsorted(by, np.arange(len(x) + 1))
        probes = [np.concatenate([[h], reached[a:b]]).astype(np.int32) for h, a, b in zip(home, edges, edges[1:], strict=False)]
        left = x - self.centre(home)
        codes = np.stack([_nearest(left[:, s], book) for s, book in zip(self._parts(), self.books, strict=True)], 1).astype(np.uint8)
        coded = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1)
        return home, probes, codes, np.linalg.norm(left - coded, axis=1)

    def candidates(self, queries: np.ndarray, at: int, codes: np.ndarray, missed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of queries and of coded members of list `at` that may lie within the radius."""
        left = self.padded(queries) - self.centre(np.array([at]))
        distance = np.zeros((len(queries), len(codes)))
        for i, s in enumerate(self._parts()):
            distance += _squares(left[:, s], self.books[i])[:, codes[:, i]]
        return np.nonzero(distance <= np.square(self.radius + missed)[None])


def _vectors(column: pa.Array, width: int | None = None) -> np.ndarray:
    """An Arrow column of lists as rows of doubles; shorter ones end in zeros, by default up to the length of the first."""
    flat, length = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.value_lengths().to_numpy()
    width = width or int(length[0])
    if (length == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < length[:, None]] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; each row is scaled by its largest component first, so that no square overflows or vanishes."""
    x, y = (v / np.maximum(np.abs(v).max(1, keepdims=True), 1e-300) for v in (x, y))
    return np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (least id of the component, id) that join the same ids as the links a-b do."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right, label = ends[: len(a)], ends[len(a) :], np.arange(len(ids))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        for of in (left, right, label[left], label[right]):
            np.minimum.at(new, of, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(ids))
    return ids[label[keep]], ids[keep]


class _Block:
    """The members of one block of one list, as they arrive; then the queries that meet them."""

    def __init__(self, index: Index, at: int, cosine: float) -> None:
        self.index, self.at, self.cosine = index, at, cosine
        self.parts: list[tuple] = []
        self.open = True
        self._reset()

    def _reset(self) -> None:
        self.counts: dict[int, int] = {}
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def members(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, codes: np.ndarray, missed: np.ndarray, probes: list) -> None:
        self.parts.append((ids, copies, x, codes, missed, probes))

    def close_members(self) -> None:
        """Once all members are there, they meet each other."""
        if not self.open:
            return
        self.open = False
        if not self.parts:
            self.ids = np.zeros(0, np.int64)
            return
        columns = list(zip(*self.parts, strict=True))
        self.ids, self.copies, self.x, self.codes, self.missed = (np.concatenate(c) for c in columns[:5])
        self.probes, self.parts = [p for part in columns[5] for p in part], []
        for first in range(0, len(self.ids), QUERIES):
            part = slice(first, first + QUERIES)
            self._meet(self.ids[part], self.copies[part], self.x[part], None, first)

    def _meet(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, homes: np.ndarray | None, first: int = 0) -> None:
        if not len(self.ids):
            return
        i, j = self.index.candidates(_unit(x), self.at, self.codes, self.missed)
        if homes is None:  # members among themselves: each pair once
            i, j = i[i + first < j], j[i + first < j]
        close = _cosines(x[i], self.x[j]) >= self.cosine if len(i) else np.zeros(0, bool)
        i, j = i[close], j[close]
        if homes is not None and len(i):
            # Where both vectors probe the other's list, the lower list counts the pair.
            both = zip(homes[i].tolist(), j.tolist(), strict=True)
            once = np.array([h == self.at or self.at < h or h not in self.probes[m] for h, m in both], bool)
            i, j = i[once], j[once]
        if not len(i):
            return
        for of, add in ((ids[i], self.copies[j]), (self.ids[j], copies[i])):
            who, where = np.unique(of, return_inverse=True)
            for v, n in zip(who.tolist(), np.bincount(where, add).astype(np.int64).tolist(), strict=True):
                self.counts[v] = self.counts.get(v, 0) + n
        self.links.append(_spanning(ids[i], self.ids[j]))
        self.held = len(self.counts) + sum(len(a) for a, _ in self.links)

    def queries(self, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, homes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(ids), QUERIES):
            part = slice(first, first + QUERIES)
            self._meet(ids[part], copies[part], x[part], homes[part])
            if self.held > HELD:
                yield self.result()

    def result(self) -> pa.RecordBatch:
        """What was found since the last result: counts add up, and links are links."""
        none = np.zeros(0, np.int64)
        a, b = _spanning(*(np.concatenate([x[i] for x in self.links]) for i in range(2))) if self.links else (none, none)
        who, n = (np.array(list(x), np.int64) for x in (self.counts.keys(), self.counts.values()))
        self._reset()
        columns = [np.concatenate([a, who]), np.concatenate([b, who]), np.concatenate([np.zeros(len(a), np.int64), n])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n"])


_MEETING = ("g1", "g2", "list", "block", "role", "id", "copies", "x", "width", "home", "code", "missed", "probes")


def _compared(batches: Iterator[pa.RecordBatch], indexes: dict[int, Index], cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, list, block and role to links (a < b, n = 0) and numbers of links (a = b, n > 0)."""
    key, block = None, None
    for batch in batches:
        g1, g2, at, part, role, ids, copies = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        if not len(ids):
            continue
        new = np.zeros(len(ids), bool)
        new[0] = True
        for c in (g1, g2, at, part, role):
            new[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(new).tolist(), len(ids)]
        for a, b in zip(edges, edges[1:], strict=False):
            now = (g1[a], g2[a], at[a], part[a])
            rows = batch.slice(a, b - a)
            if now != key:
                if block:
                    block.close_members()
                    yield block.result()
                key, block = now, _Block(indexes[rows.column(8)[0].as_py()], int(at[a]), cosine)
            x = _vectors(rows.column(7))
            if role[a] == 0:
                codes = np.frombuffer(b"".join(rows.column(10).to_pylist()), np.uint8).reshape(-1, SUBSPACES)
                block.members(ids[a:b], copies[a:b], x, codes, rows.column(11).to_numpy(), rows.column(12).to_pylist())
            else:
                block.close_members()
                yield from block.queries(ids[a:b], copies[a:b], x, rows.column(9).to_numpy())
    if block:
        block.close_members()
        yield block.result()


def _usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return label.isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def _fitted(distinct: DataFrame, cosine: float, per_list: int, most: tuple[int, int]) -> dict[int, Index]:
    """An index for each width (the least power of two that a vector's length does not exceed), on a bounded sample of its vectors.

    There are at most 31 widths, as an array's length is an int.
    """
    found = {}
    for width, n in sorted(distinct.groupBy("width").count().toLocalIterator()):
        at_most = int(np.clip(SAMPLE_BYTES // (4 * width), 1, SAMPLE))
        chosen = least_by_hash(distinct.where(F.col("width") == width), F.xxhash64("x", F.lit(1)), at_most, n)
        sample = chosen.select(F.col("x").cast("array<double>")).toArrow().column(0).combine_chunks()
        lists = int(np.clip(n // per_list, 1, most[0]))
        sub_lists = int(np.clip(n // (per_list * lists), 1, most[1]))
        found[width] = Index(_unit(_vectors(sample, width)), lists, sub_lists, cosine)
    return found


def embedding_groups(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = COSINE,
    per_list: int = PER_LIST, most_lists: tuple[int, int] = (LISTS, SUB_LISTS),
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, as links of at least `cosine` under equal labels give them.

    Vectors without a label, or that are null, empty, zero or hold null or non-finite
    components, link with nothing.  Vectors of unequal lengths have no cosine and do not
    link.  Every row is a vector of its own, whatever its id: repeated rows link with each
    other, rows of one id with different vectors or labels have links and components of
    their own, and rows of a null id link and are counted like others, but name no component
    (component_id is null where no row of the component has an id) and are not kept.
    """
    columns = (F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"), F.col(label_column).cast("string").alias("label"))
    rows = vectors.select(*columns)
    rows = rows.withColumn("ok", _usable(F.col("x"), F.col("label")))
    # 128 bits of hash stand for label and vector in joins.
    for i, name in enumerate(("k1", "k2")):
        rows = rows.withColumn(name, F.when(F.col("ok"), F.xxhash64(F.lit(i), "label", "x")))
    plain = rows.select("vec_id", "k1", "k2")
    grouped = rows.where("ok").groupBy("label", "x", "k1", "k2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    width = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("x"))))
    group = [F.xxhash64(F.lit(i), "label", F.size("x")).alias(f"g{i}") for i in (1, 2)]
    distinct = checkpointed(grouped.select("k1", "k2", *group, "x", width.cast("int").alias("width"), "least", "copies", F.monotonically_increasing_id().alias("id")))
    indexes = _fitted(distinct, cosine, per_list, most_lists)
    if not indexes:
        return plain.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    shared = vectors.sparkSession.sparkContext.broadcast(indexes)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            widths = whole.column(5).to_numpy()
            for width_ in np.unique(widths).tolist():
                of = whole if (widths == width_).all() else whole.filter(pa.array(widths == width_))
                step = int(np.clip((4 << 20) // width_, 1, 2048))
                for first in range(0, of.num_rows, step):
                    batch = of.slice(first, step)
                    home, probes, codes, missed = shared.value[width_].assign(_unit(_vectors(batch.column(4), width_)))
                    extra = [pa.array(home, pa.int32()), pa.array(probes, pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(missed)]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "home", "probes", "code", "missed"])

    schema = "id long, copies long, g1 long, g2 long, x array<double>, width int, home int, probes array<int>, code binary, missed double"
    coded = checkpointed(distinct.select("id", "copies", "g1", "g2", "x", "width").mapInArrow(assigned, schema))
    found = checkpointed(_meetings(coded).mapInArrow(lambda b: _compared(b, shared.value, cosine), "a long, b long, n long"))

    components = connected_components(found.where("n = 0").select("a", "b").distinct())
    counts = found.where("n > 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    linked = distinct.select("id", "k1", "k2", "least", "copies").join(counts, "id", "left").join(components.withColumnRenamed("node", "id"), "id", "left")
    linked = linked.withColumn("component", F.coalesce("component", "id"))
    linked = checkpointed(linked.where("copies > 1 or links is not null"))
    names = linked.groupBy("component").agg(F.min("least").alias("name"), F.count(F.lit(1)).alias("n"))
    known = salted_left_join(linked, names.drop("n"), ["component"], "id", names.select("component", "n"))
    known = known.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "name")
    out = salted_left_join(plain, known, ["k1", "k2"], "vec_id", linked.select("k1", "k2", F.col("copies").alias("n")))
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("name"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _meetings(coded: DataFrame) -> DataFrame:
    """Members of blocks (role 0) and the vectors that have to meet them (role 1), in order."""
    here = ["g1", "g2", "home"]
    blocks = coded.groupBy(*here).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = coded.join(blocks, here).withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int"))
    of = lambda role, at, block: ["g1", "g2", at.alias("list"), block.alias("block"), F.lit(role).alias("role"), "id", "copies", "x", "width", "home"]
    as_members = members.select(*of(0, F.col("home"), F.col("block")), "code", "missed", "probes")
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("code", "binary"), ("missed", "double"), ("probes", "array<int>"))]
    # In its own list a vector meets the blocks after its own; in others that have members, every block.
    later = members.where("blocks > block + 1").withColumn("to", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)))
    others = F.explode(F.slice("probes", F.lit(2), F.greatest(F.lit(0), F.size("probes") - 1)))
    probing = coded.select("id", "copies", "g1", "g2", "x", "width", "home", others.alias("list"))
    there = probing.join(blocks.withColumnRenamed("home", "list"), ["g1", "g2", "list"]).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meeting = as_members.union(later.select(*of(1, F.col("home"), F.col("to")), *nothing)).union(there.select(*of(1, F.col("list"), F.col("to")), *nothing))
    where = ("g1", "g2", "list", "block")
    return meeting.select(*_MEETING).repartition(*where).sortWithinPartitions(*where, "role")
