"""Vector code compression: integer codebooks by rounds of assignment, found by partial-distance search.

A component x becomes the integer floor(256 x).  Each vector is cut into PARTS parts, and a
part is coded by the index of its nearest codebook entry.  The search starts from the entry
that is nearest in the leading dimension, measured whole; the other entries come in blocks,
their dimensions taken in descending variance over the codebook, and an entry is dropped as
soon as its integer distance so far strictly exceeds the best whole distance.  So entries at
the same distance stay, and the lowest index wins.

All arithmetic is on integers: 64 bits wide where no square can overflow, Python's otherwise.
A round sends one sum per task, part, entry and position; the driver holds codebooks, no vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, salted_left_join

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Entries that the search takes at once.
BLOCK = 16
#: Sums travel in digits of so many bits.
DIGIT = 40
#: Components of vectors that are coded at once.
AT_ONCE = 1 << 18
#: Labels up to which their sums are broadcast (24 bytes each); beyond, they are joined.
FEW_LABELS = 65_536
LONG = 2**63 - 1


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite doubles; Python integers where 64 bits might not do."""
    if not x.size or np.abs(x).max() < 2.0**40:
        return np.floor(x * SCALE).astype(np.int64)
    exact = np.frompyfunc(lambda v: math.floor(v * SCALE) if abs(v) < 2.0**52 else int(v) * SCALE, 1, 1)
    return exact(x)


def _comparable(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if no distance between them can overflow, else as Python's."""
    most = max((int(np.abs(v).max()) for v in (x, book) if v.size), default=0)
    kind = np.int64 if (2 * most) ** 2 * max(1, x.shape[1]) < 2**62 else object
    return x.astype(kind), book.astype(kind)


def descending_variance(book: np.ndarray) -> np.ndarray:
    """Dimensions of a codebook by descending variance over its entries, then by position."""
    n, values = len(book), book.astype(object)
    spread = [n * sum(v * v for v in column) - sum(column) ** 2 for column in values.T.tolist()]
    return np.array(sorted(range(len(spread)), key=lambda j: (-spread[j], j)), np.int64)


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row; ties go to the lower index."""
    if not x.shape[1] or not len(x):
        return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    x, book = _comparable(x, book)
    order = descending_variance(book)
    lead, leading = x[:, order[0]], book[:, order[0]]
    sorted_ = np.argsort(leading, kind="stable")
    above = np.minimum(np.searchsorted(leading[sorted_], lead), len(book) - 1)
    below = np.maximum(above - 1, 0)
    nearer = np.abs(lead - leading[sorted_[below]]) <= np.abs(lead - leading[sorted_[above]])
    at = sorted_[np.where(nearer, below, above)]
    best = np.square(x - book[at]).sum(1)
    for first in range(0, len(book), BLOCK):
        gap = np.square(lead[:, None] - leading[None, first : first + BLOCK])
        row, entry = np.nonzero(gap <= best[:, None])
        so_far, entry = gap[row, entry], entry + first
        for j in order[1:]:
            so_far = so_far + np.square(x[row, j] - book[entry, j])
            stays = (so_far <= best[row]).astype(bool)
            row, entry, so_far = row[stays], entry[stays], so_far[stays]
        before = best.copy()
        np.minimum.at(best, row, so_far)
        # Pairs are in order of rows and entries: of those at the new best, the first of a row has its lowest index.
        hit = (so_far == best[row]).astype(bool)
        who, where = np.unique(row[hit], return_index=True)
        found = entry[hit][where]
        at[who] = np.where((best[who] < before[who]).astype(bool), found, np.minimum(at[who], found))
    return at, best


class Codebooks:
    """One codebook for each part, of the same number of entries."""

    def __init__(self, books: list[np.ndarray]) -> None:
        self.books, self.width = books, books[0].shape[1]

    @staticmethod
    def start(rows: np.ndarray, parts: int) -> Codebooks:
        width = rows.shape[1] // parts
        return Codebooks([rows[:, i * width : (i + 1) * width] for i in range(parts)])

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances, a column for each part."""
        found = [nearest_entries(x[:, i * self.width : (i + 1) * self.width], book) for i, book in enumerate(self.books)]
        return np.stack([a for a, _ in found], 1), np.stack([d.astype(object) for _, d in found], 1)

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Entries replaced by the floor of their parts' means; unused ones stay."""
        books = [book.astype(object) for book in self.books]
        for (part, entry), (n, total) in sums.items():
            books[part][entry] = [t // n for t in total]
        return Codebooks([b.astype(np.int64) if not b.size or np.abs(b).max() < 2**62 else b for b in books])

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for book in self.books for v in book.ravel().tolist()).encode()).hexdigest()


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of lists as rows of doubles, ended by zeros up to width."""
    flat, length = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.value_lengths().to_numpy(zero_copy_only=False)
    if (length == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < length[:, None]] = flat
    return out


def _sliced(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, AT_ONCE // max(1, width))
    for batch in batches:
        for first in range(0, batch.num_rows, step):
            yield batch.slice(first, step)


def _digits(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, at = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        if rest % (1 << DIGIT):
            yield at, sign * (rest % (1 << DIGIT))
        rest, at = rest >> DIGIT, at + 1


class _Sums:
    """Numbers and component sums of the parts that one task assigns to each entry."""

    def __init__(self, books: Codebooks) -> None:
        self.n = np.zeros((len(books.books), len(books.books[0])), np.int64)
        self.totals = np.zeros((*self.n.shape, books.width), object)

    def add(self, x: np.ndarray, codes: np.ndarray) -> None:
        parts, entries, width = self.totals.shape
        for part in range(parts):
            of, values = codes[:, part], x[:, part * width : (part + 1) * width]
            self.n[part] += np.bincount(of, minlength=entries)
            total = np.zeros((entries, width), values.dtype)
            np.add.at(total, of, values)
            self.totals[part] += total.astype(object)

    def rows(self) -> Iterator[tuple[int, int, int, int, int]]:
        """(part, entry, position, digit, value); position -1 holds the number."""
        for part, entry in zip(*np.nonzero(self.n), strict=True):
            yield int(part), int(entry), -1, 0, int(self.n[part, entry])
            for position, value in enumerate(self.totals[part, entry].tolist()):
                for at, digit in _digits(value):
                    yield int(part), int(entry), position, at, digit


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("position", pa.int32()), ("digit", pa.int32()), ("value", pa.int64())])


def _one_round(x: DataFrame, books: Codebooks, width: int) -> Codebooks:
    shared = x.sparkSession.sparkContext.broadcast(books)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(shared.value)
        for batch in _sliced(batches, width):
            y = integers(_rows(batch.column(0), width))
            sums.add(y, shared.value.assign(y)[0])
        rows = list(sums.rows())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SUMS)], schema=_SUMS)

    keys = ["part", "entry", "position", "digit"]
    parts = x.select("x").mapInArrow(summed, "part int, entry int, position int, digit int, value long")
    totals: dict[tuple[int, int], list[int]] = {}
    numbers: dict[tuple[int, int], int] = {}
    # At most as many rows as the codebooks have components, times their digits.
    for r in parts.groupBy(*keys).agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        of, value = (r["part"], r["entry"]), int(r["value"])
        if r["position"] < 0:
            numbers[of] = value
        else:
            totals.setdefault(of, [0] * books.width)[r["position"]] += value << (DIGIT * r["digit"])
    return books.moved({of: (n, totals.get(of, [0] * books.width)) for of, n in numbers.items()})


def _kept(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def _first_rows(rows: DataFrame, most: int, width: int) -> np.ndarray:
    """The vectors of the `most` least ids, ties by components, null ids last.

    The ids alone are ordered first, so that no task gets that many vectors from each partition.
    """
    ids = [r[0] for r in rows.select("vec_id").where("vec_id is not null").orderBy("vec_id").limit(most).collect()]
    near = rows.where(F.col("vec_id") <= ids[-1]) if len(ids) == most else rows
    first = near.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(most).select("x").toArrow().column(0).combine_chunks()
    return integers(_rows(first, width))


def codebooks_of(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[Codebooks, int] | None:
    """The codebooks of a table (vec_id long, x array<double> of finite values) and the width that vectors are filled up to; None of an empty table."""
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts) * parts
    books = Codebooks.start(_first_rows(rows, entries, width), parts)
    for _ in range(rounds):
        books = _one_round(rows, books, width)
    return books, width


def vector_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are dropped.  Every other
    row is a vector of its own, whatever its id: repeated rows count as often as they occur;
    the first codebook takes the least ids, of equal ids the least vectors, null ids last.  With
    fewer vectors than entries the codebooks are that much shorter.  Vectors that are shorter
    than the longest, or of a length that the parts do not divide, end in zeros up to
    the next multiple; an empty vector is all zeros.  Null labels are one label.  Components
    of any size are exact; an error that exceeds a 64-bit integer is null, as is its label's.
    An empty table gives no rows.  Only the three named columns are read.
    """
    label = F.col(label_column)
    keys = [F.xxhash64(F.lit(i), label, label.isNull()).alias(f"l{i}") for i in (1, 2)]
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"), *keys).where(_kept(F.col("x")))
    found = codebooks_of(rows, parts, entries, rounds)
    if found is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books, width = found
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, width):
            codes, distances = shared.value.assign(integers(_rows(batch.column(1), width)))
            text = [bytes(c).hex() for c in codes.astype(np.uint8)]
            errors = [e if e <= LONG else None for e in map(int, distances.sum(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string()), pa.array(errors, pa.int64()), batch.column(2), batch.column(3)], ["vec_id", "code", "error", "l1", "l2"])

    out = checkpointed(rows.mapInArrow(coded, "vec_id long, code string, error long, l1 long, l2 long"))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = (F.count("error") == F.count(F.lit(1))) & (total <= F.lit(LONG).cast("decimal(38,0)"))
    labels = checkpointed(out.groupBy("l1", "l2").agg(F.when(fits, total).cast("long").alias("label_error"), F.count(F.lit(1)).alias("n")))
    if labels.count() <= FEW_LABELS:
        joined = out.join(F.broadcast(labels.drop("n")), ["l1", "l2"], "left")
    else:
        joined = salted_left_join(out, labels.drop("n"), ["l1", "l2"], "vec_id", labels.select("l1", "l2", "n"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same of `embeddings`, whose vectors are all of one length that parts divides."""
    steps = [
        "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS y FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"q AS (SELECT vec_id, label, y, unnest(range({parts})) AS part, len(y) // {parts} AS d FROM v)",
        "p AS (SELECT vec_id, label, part, y[part * d + 1 : (part + 1) * d] AS s FROM q)",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {entries})",
        "b0 AS (SELECT part, entry, s AS c FROM p JOIN f USING (vec_id))",
    ]
    distance = "list_sum(list_transform(range(1, len(p.s) + 1), lambda i: (p.s[i] - b.c[i]) * (p.s[i] - b.c[i])))"
    for k in range(rounds + 1):
        steps.append(f"d{k} AS (SELECT p.vec_id, p.part, b.entry, {distance} AS gap FROM p JOIN b{k} AS b USING (part))")
        steps.append(f"a{k} AS (SELECT vec_id, part, min(gap) AS gap, arg_min(entry, gap * {entries} + entry) AS entry FROM d{k} GROUP BY vec_id, part)")
        if k < rounds:
            steps.append(f"u{k} AS (SELECT p.part, a.entry, unnest(range(1, len(p.s) + 1)) AS i, unnest(p.s) AS v FROM p JOIN a{k} AS a USING (vec_id, part))")
            steps.append(f"m{k} AS (SELECT part, entry, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS m FROM u{k} GROUP BY part, entry, i)")
            steps.append(f"n{k} AS (SELECT part, entry, list(CAST(m AS BIGINT) ORDER BY i) AS c FROM m{k} GROUP BY part, entry)")
            steps.append(f"b{k + 1} AS (SELECT b.part, b.entry, coalesce(n.c, b.c) AS c FROM b{k} AS b LEFT JOIN n{k} AS n USING (part, entry))")
    last = rounds
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})")
    steps.append(f"r AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error FROM a{last} GROUP BY vec_id)")
    final = "SELECT r.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.codebooks_sha256 FROM r JOIN v USING (vec_id) CROSS JOIN h"
    return "WITH " + ",\n".join(steps) + "\n" + final
