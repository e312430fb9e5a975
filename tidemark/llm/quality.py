"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Words are runs of letters, of digits, or of one kind of other characters.  Each falls by
hash into one of BUCKETS vocabulary rows, so the model's size is fixed whatever the
corpus.  A row's index vector is sparse and random; its word vector is the sum of the
index vectors of all words within WINDOW places of it, over every document.  A document
is the mean of its words' unit vectors, of their squares, and of the products of neighbouring
words' vectors (which repetition raises), with the logarithm of its length.  A small network is trained on a bounded sample of labelled documents
(SAMPLE, in hash order), and a temperature is fitted on a part of that sample that the
training does not see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc_mod, in_slices, least_by_hash, run_hashes, text_bytes

BUCKETS, DIMENSIONS, NONZERO, WINDOW = 1 << 14, 32, 4, 2
FEATURES = 2 * DIMENSIONS + 4
#: Labelled documents that the network is fitted on, at most.
SAMPLE = 20_000
THRESHOLD = 0.7
SLICE = 1 << 20
BLOCKS = 32

_KIND = np.full(256, 1, np.uint8)
_KIND[:0x80] = 3
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 1
_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each vocabulary row, NONZERO dimensions and their signs."""
    rng = np.random.default_rng(11)
    return rng.integers(0, DIMENSIONS, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def _word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vocabulary row of each word, and the number of the text that it stands in."""
    kind = _KIND[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    full = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[full], ends[full]
    return (run_hashes(data, starts, ends, _VALUES) >> np.uint64(50)).astype(np.int64), np.searchsorted(offsets, starts, "right") - 1


def word_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The centred unit word vectors, BUCKETS x DIMENSIONS (2 MB), learned from every document.

    Each task adds up its documents in an array of fixed size, which it hands on in BLOCKS
    rows; the driver gets the sums, whose size does not depend on the corpus.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, sign = _index_vectors()
        total, seen = np.zeros(BUCKETS * DIMENSIONS), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in in_slices(offsets, SLICE):
                rows, text = _word_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                seen += np.bincount(rows, minlength=BUCKETS)
                for gap in range(1, WINDOW + 1):
                    same = text[gap:] == text[:-gap]
                    left, right = rows[:-gap][same], rows[gap:][same]
                    for word, near in ((left, right), (right, left)):
                        total += np.bincount((word[:, None] * DIMENSIONS + where[near]).ravel(), sign[near].ravel(), BUCKETS * DIMENSIONS)
        block = BUCKETS // BLOCKS
        width = np.int32 if max(np.abs(total).max(), seen.max()) < 2**31 else np.int64
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(BLOCKS), pa.int32()),
                pa.array([total.reshape(BLOCKS, -1)[i].astype(width).tobytes() for i in range(BLOCKS)], pa.binary()),
                pa.array([seen[i * block : (i + 1) * block].astype(width).tobytes() for i in range(BLOCKS)], pa.binary()),
                pa.array([np.dtype(width).itemsize] * BLOCKS, pa.int32()),
            ],
            ["block", "total", "seen", "bytes"],
        )

    def added(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums_: dict[int, list[np.ndarray]] = {}
        for batch in part:
            for block, total, seen, width in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                kind = np.int32 if width == 4 else np.int64
                new = [np.frombuffer(x, kind).astype(np.int64) for x in (total, seen)]
                sums_[block] = [x + y for x, y in zip(sums_[block], new, strict=True)] if block in sums_ else new
        blobs = [pa.array([x[i].tobytes() for x in sums_.values()], pa.binary()) for i in range(2)]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums_), pa.int32()), *blobs, pa.array([8] * len(sums_), pa.int32())], ["block", "total", "seen", "bytes"])

    schema = "block int, total binary, seen binary, bytes int"
    parts = docs.select(F.col(text_column).alias("text")).mapInArrow(sums, schema).withColumn("group", F.spark_partition_id() % 32)
    # In two steps, so that no task adds up what all the others hand on.
    halfway = parts.repartition("block", "group").mapInArrow(lambda x: added(x), schema)
    found = halfway.repartition("block").mapInArrow(added, schema).toPandas().sort_values("block")
    if not len(found):
        return np.zeros((BUCKETS, DIMENSIONS), np.float32)
    total = np.concatenate([np.frombuffer(x, np.int64) for x in found.total]).reshape(BUCKETS, DIMENSIONS).astype(float)
    seen = np.concatenate([np.frombuffer(x, np.int64) for x in found.seen])
    total /= np.maximum(seen, 1)[:, None]
    total -= (total * seen[:, None]).sum(0) / max(seen.sum(), 1)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Of each text: the means of its words' vectors, of their squares, and of the products of words one and two places apart; its words' log number; whether it has any."""
    data, offsets = text_bytes(texts)
    out = np.zeros((len(offsets) - 1, FEATURES))
    for a, b in in_slices(offsets, SLICE):
        rows, text = _word_rows(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        if not len(rows):
            continue
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        n = np.diff(np.append(first, len(rows)))[:, None]
        of, at = vectors[rows], text[first] + a
        out[at, :DIMENSIONS] = np.add.reduceat(of, first, dtype=np.float64) / n
        for gap in (1, 2):
            alike = np.zeros(len(rows))
            alike[gap:] = np.einsum("ij,ij->i", of[gap:], of[:-gap]) * (text[gap:] == text[:-gap])
            out[at, 2 * DIMENSIONS + gap - 1] = np.add.reduceat(alike, first) / n[:, 0]
        out[at, DIMENSIONS : 2 * DIMENSIONS] = np.add.reduceat(np.square(of, out=of), first, dtype=np.float64) / n
        out[at, -2], out[at, -1] = np.log1p(n[:, 0]), 1
    return out


class Network:
    """Two layers: inputs, scaled to unit variance, to tanh units, to one logit, divided by a temperature."""

    def __init__(self, hidden: int = 24, seed: int = 5) -> None:
        self.hidden, self.rng, self.temperature = hidden, np.random.default_rng(seed), 1.0

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 256, rate: float = 0.01, decay: float = 1e-4) -> Network:
        """Adam on the cross entropy of four fifths of the rows; the rest calibrates the temperature.  Few rows or one class: a constant."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        fold = np.arange(len(x)) % 5 == 4
        a, b = (x[~fold], y[~fold]), (x[fold], y[fold])
        rate0 = (y.sum() + 1) / (len(y) + 2)
        self.p = [self.rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], self.hidden)), np.zeros(self.hidden), np.zeros(self.hidden), np.array(np.log(rate0 / (1 - rate0)))]
        if len(set(y)) < 2:
            return self
        m, v, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(epochs):
            order = self.rng.permutation(len(a[0]))
            for i in range(0, len(order), batch):
                xs, ys = a[0][order[i : i + batch]], a[1][order[i : i + batch]]
                h = np.tanh(xs @ self.p[0] + self.p[1])
                d = (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3]))) - ys) / len(ys)
                dh = np.outer(d, self.p[2]) * (1 - h * h)
                grads, step = [xs.T @ dh + decay * self.p[0], dh.sum(0), h.T @ d + decay * self.p[2], d.sum()], step + 1
                for k, g in enumerate(grads):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        if len(b[1]):
            z = self._logit(b[0])
            loss = lambda t: np.logaddexp(0, -np.where(b[1] > 0, z, -z) / t).mean()
            self.temperature = min(np.geomspace(0.5, 8, 41), key=loss)
        return self

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale) / self.temperature, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", modulus: int = 4, remainder: int = 2) -> tuple[np.ndarray, Network]:
    """Word vectors from all texts, and a network from SAMPLE labelled documents whose crc32(id) mod modulus is not remainder.

    Labels that are null, or of documents that are missing, teach nothing; of an id with
    several labels the greatest counts, and of an id with several documents one (the least
    by a hash of its text).
    """
    vectors = word_vectors(docs, text_column)
    chosen = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("y"))
        .where("id is not null and y is not null")
        .where(crc_mod("id", modulus) != remainder)
        .groupBy("id").agg(F.max("y").alias("y"))
    )
    chosen = checkpointed(least_by_hash(chosen, F.xxhash64("id", F.lit(3)), SAMPLE, chosen.count()))
    small = docs.sparkSession.sparkContext.broadcast(vectors)

    @F.pandas_udf("array<double>")
    def pooled(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_pooled(pa.array(texts, pa.string()), small.value)))

    labelled = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "id")
    # Of rows of one id the least by hash counts, so that the driver gets no more rows than the sample has ids.
    one = F.min(F.struct(F.xxhash64("text").alias("h"), F.col("x"))).alias("first")
    rows = labelled.select("id", "y", "text", pooled("text").alias("x")).groupBy("id", "y").agg(one)
    rows = rows.select("id", "y", F.col("first.x").alias("x")).toPandas().sort_values("id", kind="stable")
    if not len(rows):
        return vectors, Network().fit(np.zeros((1, FEATURES)), np.ones(1))
    rows = rows.sample(frac=1, random_state=1)
    return vectors, Network().fit(np.stack(rows.x.to_list()), (rows.y.to_numpy() > 0).astype(float))


def with_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", score_column: str = "score") -> DataFrame:
    """docs with a column score_column: the calibrated probability that the text is of quality 1.

    Only the text is an input of a score.  Null and empty texts get the score of a text
    without words.  All rows stay, in place, with all their columns.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_column, text_column))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        vectors, network = model.value
        return pd.Series(network(_pooled(pa.array(texts, pa.string()), vectors)))

    return docs.withColumn(score_column, score(F.col(text_column)))


def quality_scores(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted.  A null id is in no fold and counts as not held out."""
    scored = with_quality(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), labels.withColumnRenamed(id_column, "doc_id"))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
