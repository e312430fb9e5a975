"""Language-model scores by deleted interpolation.

P(w | u, v) = L3(b) c(u, v, w) / c(u, v) + (1 - L3(b)) P(w | v), P(w | v) is mixed likewise
from pairs and P(w), and P(w) = (c(w) + 1/2) / (N + (V + 1) / 2); b is the bucket (power of
two) of the context's frequency.  Counts come from all training documents.  The weights are
learned by expectation-maximisation, order by order: one fold of the training documents is
deleted from the counts, and its own counts, by bucket and by the ratio of the two
estimates, are the held-out ones.

Documents are read in blocks.  A block's distinct words, pairs and triples go, as sorted
hashes with the block's counts, to buckets of the hash range; a bucket adds the counts of
all blocks and answers each block with the totals of what it asked for, in the block's own
order.  So each distinct n-gram of a block travels once, compressed, and nobody holds the
counts of the corpus.  Blocks and buckets grow with the root of the corpus, so that their
product, the number of parcels, grows with the corpus and not with its square.

Each parcel carries a checksum of its block's tokens in their order.  If a block that is
read again has another (as when the input changed between reads), an error is raised.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc_mod, finish, in_slices, text_bytes, word_hashes

FOLDS, HELD_OUT, DELETED = 5, 1, 2
ORDER = 3
#: Bytes of text of a block, and of the blocks' texts per bucket: the root of GROWTH times the corpus, within these bounds.
LEAST_BYTES, MOST_BYTES, GROWTH = 4 << 20, 128 << 20, 1 << 10
#: Blocks, or buckets, to a task.
PER_TASK = 8
SLICE = 1 << 19
CONTEXTS = 48
#: Steps of the ratio of the estimates to a factor of two, in the held-out counts.
RESOLUTION = 16
_END = np.uint64(0x5851F42D4C957F2D)
_LEFT, _RIGHT = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bits of a hash that n-grams of three words and more keep.
_LONG_GRAM = ~np.uint64((1 << 16) - 1)


def block_bytes(size: int) -> int:
    """The size of a block for a corpus of so many bytes."""
    return int(np.clip(np.sqrt(float(GROWTH) * size), LEAST_BYTES, MOST_BYTES))


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes())


def _unpacked(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.Table]]:
    """Rows (doc_id, text, held, fold) in blocks of about size bytes, each of the deleted fold (odd number) or of other documents (even)."""
    task, numbers = TaskContext.get().partitionId(), [0, 0]
    open_: list[list[pa.RecordBatch]] = [[], []]
    sizes = [0, 0]

    def close(fold: int) -> tuple[int, pa.Table]:
        block = (task << 24 | numbers[fold]) << 1 | fold
        rows = pa.Table.from_batches(open_[fold])
        numbers[fold], open_[fold], sizes[fold] = numbers[fold] + 1, [], 0
        return block, rows

    for batch in batches:
        for fold in (0, 1):
            part = batch.filter(pc.equal(batch.column(3), bool(fold)))
            _, offsets = text_bytes(part.column(1))
            for a, b in in_slices(offsets, SLICE):
                open_[fold].append(part.slice(a, b - a))
                sizes[fold] += int(offsets[b] - offsets[a])
                if sizes[fold] >= size:
                    yield close(fold)
    for fold in (0, 1):
        if open_[fold]:
            yield close(fold)


def _tokens(texts: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all tokens (each text's words, then its end), of each with the one before, with the two before, ..; and the texts' numbers of tokens."""
    data, offsets = text_bytes(texts)
    hashes, numbers = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in in_slices(offsets, SLICE):
        h, row = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        n = np.bincount(row, minlength=b - a)
        tokens = np.full(len(h) + b - a, _END)
        tokens[np.arange(len(h)) + row] = h
        hashes.append(tokens)
        numbers.append(n + 1)
    grams, numbers = [np.concatenate(hashes)], np.concatenate(numbers)
    for k in range(2, order + 1):
        # A text's first word follows the end of a text, and nothing before that.
        context = _moved(grams[-1], numbers, _END if k == 2 else _END + np.uint64(k))
        gram = finish(context * _LEFT + (grams[0] ^ (grams[0] >> np.uint64(29))) * _RIGHT)
        grams.append(gram & _LONG_GRAM if k > 2 else gram)
    return grams, numbers


def _moved(values: np.ndarray, numbers: np.ndarray, first: object) -> np.ndarray:
    """values, one token on (along the last axis); at the start of each text, first."""
    out = np.roll(values, 1, -1)
    if out.shape[-1]:
        out[..., np.cumsum(numbers) - numbers] = first
    return out


def _checksum(tokens: np.ndarray) -> int:
    """Of hashes in their order."""
    return int(finish(tokens + np.arange(len(tokens), dtype=np.uint64) * _LEFT).sum(dtype=np.uint64).view(np.int64))


_PARCEL = "bucket long, block long, checksum long, grams array<binary>, counts array<binary>"
_ANSWER = "bucket long, block long, checksum long, totals array<binary>, sums array<long>"
_ANSWER_ARROW = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("checksum", pa.int64()), ("totals", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64()))])


def _asked(batches: Iterator[pa.RecordBatch], size: int, shift: int, order: int) -> Iterator[pa.RecordBatch]:
    """Of each block and bucket: the sorted hashes of distinct n-grams by order, and the training counts of the block."""
    for block, rows in _blocks(batches, size):
        grams, numbers = _tokens(rows.column("text"), order)
        train = np.repeat(~rows.column("held").to_numpy(), numbers)
        parcels: dict[int, tuple[list, list]] = {}
        for k, values in enumerate(grams):
            distinct, inverse = np.unique(values, return_inverse=True)
            counts = np.bincount(inverse[train], minlength=len(distinct)).astype(np.uint32)
            bucket = distinct >> np.uint64(shift)
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(distinct) else [0]
            for a, b in zip(edges, edges[1:], strict=False):
                steps = distinct[a:b].copy()
                steps[1:] -= distinct[a : b - 1]
                parcel = parcels.setdefault(int(bucket[a]), ([None] * order, [None] * order))
                parcel[0][k], parcel[1][k] = _packed(steps), _packed(counts[a:b])
        n, check = len(parcels), _checksum(grams[0])
        columns = [pa.array(x, pa.int64()) for x in (list(parcels), [block] * n, [check] * n)]
        columns += [pa.array([p[i] for p in parcels.values()], pa.list_(pa.binary())) for i in range(2)]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "checksum", "grams", "counts"])


def _totals(inverse: np.ndarray, counts: np.ndarray, odd: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of 32-bit counts by number, all and those of the deleted fold, as 64-bit numbers: a corpus holds a token more often than a block can."""
    total = np.bincount(inverse, counts, size)
    fold = np.bincount(inverse, counts * odd.astype(np.float64), size)
    # Sums are exact as floats up to 2**53.
    return total.astype(np.uint64), fold.astype(np.uint64)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block and bucket, the totals of what it asked for (and of the deleted fold, if it is of it); of each bucket, its N and V, all and kept."""
    bucket, held = None, []

    def answer() -> pa.RecordBatch:
        blocks = np.array([x["block"] for x in held])
        order = len(held[0]["grams"])
        out: list[list] = [[None] * order for _ in held]
        sums = [0, 0, 0, 0]
        for k in range(order):
            some = [i for i, x in enumerate(held) if x["grams"][k] is not None]
            if not some:
                continue
            hashes = [np.cumsum(_unpacked(held[i]["grams"][k], np.uint64), dtype=np.uint64) for i in some]
            n = [_unpacked(held[i]["counts"][k], np.uint32) for i in some]
            lengths = np.fromiter(map(len, hashes), np.int64, len(hashes))
            distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            total, fold = _totals(inverse, np.concatenate(n), np.repeat(blocks[some] & 1, lengths), len(distinct))
            if not k:
                kept = total - fold
                sums = [int(total.sum()), int((total > 0).sum()), int(kept.sum()), int((kept > 0).sum())]
            for i, at in zip(some, np.split(inverse, np.cumsum(lengths)[:-1]), strict=True):
                out[i][k] = _packed(np.concatenate([total[at], fold[at]]) if blocks[i] & 1 else total[at])
        rows = [{"bucket": bucket, "block": x["block"], "checksum": x["checksum"], "totals": o, "sums": None} for x, o in zip(held, out, strict=True)]
        rows.append({"bucket": bucket, "block": -1, "checksum": None, "totals": None, "sums": sums})
        return pa.RecordBatch.from_pylist(rows, _ANSWER_ARROW)

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if held:
                    yield answer()
                bucket, held = row["bucket"], []
            held.append(row)
    if held:
        yield answer()


_DELIVERY = "block long, kind int, at long, documents binary, checksum long, totals array<binary>"


def _sent(rows: pa.Table) -> bytes:
    """Rows (doc_id, held, text) as compressed bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _received(parcels: pa.ChunkedArray) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in parcels.to_pylist()])


def _texts(batches: Iterator[pa.RecordBatch], size: int, deleted_only: bool) -> Iterator[pa.RecordBatch]:
    """The documents again, by block, in slices: (block, kind 1, at, documents, no answers)."""
    for block, rows in _blocks(batches, size):
        if deleted_only and not block & 1:
            continue
        rows = rows.select(["doc_id", "held", "text"]).combine_chunks()
        _, offsets = text_bytes(rows.column("text"))
        parcels = [_sent(rows.slice(a, b - a)) for a, b in in_slices(offsets, SLICE)]
        n = len(parcels)
        columns = [pa.array([block] * n, pa.int64()), pa.array([1] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array(parcels, pa.binary())]
        columns += [pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["block", "kind", "at", "documents", "checksum", "totals"])


class _Counts:
    """A block's documents with the counts of their tokens: by order, of each n-gram and of its context; of the deleted fold, also its own."""

    def __init__(self, block: int, rows: pa.Table, order: int) -> None:
        kind = rows.column("kind").to_numpy()
        docs, answers = _received(rows.filter(pa.array(kind == 1)).column("documents")), rows.filter(pa.array(kind == 0))
        grams, self.numbers = _tokens(docs.column("text"), order)
        self.ids, self.held = docs.column("doc_id").combine_chunks(), docs.column("held").combine_chunks()
        if set(answers.column("checksum").to_pylist()) - {_checksum(grams[0])}:
            raise RuntimeError("the documents changed between two reads; materialise them first")
        totals = answers.column("totals").to_pylist()
        self.counts: list[np.ndarray] = []
        folds = 1 + (block & 1)
        for k, values in enumerate(grams):
            distinct, inverse = np.unique(values, return_inverse=True)
            parts = [_unpacked(x[k], np.uint64).reshape(folds, -1) for x in totals if x[k] is not None]
            counts = np.concatenate([np.zeros((folds, 0), np.uint64), *parts], 1)
            if counts.shape[1] != len(distinct):
                raise RuntimeError("the documents changed between two reads; materialise them first")
            self.counts.append(counts[:, inverse].astype(np.float64))
        end = self.counts[0][:, np.flatnonzero(grams[0] == _END)[:1]]
        self.contexts = [_moved(c, self.numbers, end) for c in self.counts[:-1]]

    def estimates(self, weights: Sequence[np.ndarray], n: int, v: int, kept: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By order: the probability of each token by all orders up to it, its context's count and its relative frequency there.  kept: without the deleted fold."""
        less = (lambda c: c[0] - c[1]) if kept else (lambda c: c[0])
        p = (less(self.counts[0]) + 0.5) / (n + 0.5 * (v + 1))
        yield p, np.full(len(p), float(n)), p
        for k, (count, context) in enumerate(zip(self.counts[1:], self.contexts, strict=True)):
            seen = less(context)
            likely = less(count) / np.maximum(seen, 1)
            if k < len(weights):
                w = np.where(seen > 0, weights[k][_context(seen)], 0.0)
                p = w * likely + (1 - w) * p
            yield p, seen, likely


def _counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[_Counts]:
    """The blocks of rows sorted by block, kind and at."""
    open_, block = [], None
    for batch in batches:
        of = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a < b:
                if of[a] != block and open_:
                    yield _Counts(block, pa.Table.from_batches(open_), order)
                    open_ = []
                block = int(of[a])
                open_.append(batch.slice(a, b - a))
    if open_:
        yield _Counts(block, pa.Table.from_batches(open_), order)


def _context(before: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(before)[1], CONTEXTS - 1)


def mixture_weights(held_out_counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """By context bucket, the weight of the pair estimate that is likeliest for counts by (bucket, step of the ratio; step 0 is ratio 0)."""
    ratios = np.concatenate([[0.0], 2.0 ** ((np.arange(1, held_out_counts.shape[1]) - 64 * RESOLUTION) / RESOLUTION)])
    weights = np.where(held_out_counts.sum(1) > 0, 0.5, 0.0)
    for _ in range(rounds):
        share = weights[:, None] * ratios / np.maximum(weights[:, None] * ratios + 1 - weights[:, None], 1e-300)
        weights = np.clip((held_out_counts * share).sum(1) / np.maximum(held_out_counts.sum(1), 1), 0, 0.999) * (held_out_counts.sum(1) > 0)
    return weights


def interpolated_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score by n-grams of up to `order` words.

    A null text is empty: one token, its end.  A null id is never held out.  Repeated rows
    count and are scored as often as they occur.  docs must give the same rows in the same
    partitions each time it is read, as files do.  Triples and longer are told apart by 48
    bits of hash, so that in a corpus of 10^12 different ones about one in 300 shares its count.
    """
    fold = crc_mod(id_column, FOLDS)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"),
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held"), F.coalesce(fold == DELETED, F.lit(False)).alias("fold"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    part = block_bytes(size)
    shift = 64 - max(4, int(np.ceil(np.log2(max(1, size / part)))))
    # As the corpus grows, more tasks and not larger ones: each has a few blocks' worth of text.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, int(np.ceil(size / (PER_TASK * part))))
    asked = rows.mapInArrow(lambda b: _asked(b, part, shift, order), _PARCEL)
    ordered = asked.repartition(tasks, "bucket").sortWithinPartitions("bucket", "block")
    answered = checkpointed(ordered.mapInArrow(_answered, _ANSWER))
    n, v, n_kept, v_kept = answered.where("sums is not null").agg(*[F.coalesce(F.sum(F.get("sums", F.lit(i))), F.lit(0)) for i in range(4)]).first()
    answers = answered.where("sums is null").select("block", F.lit(0).alias("kind"), F.col("bucket").alias("at"), F.lit(None).cast("binary").alias("documents"), "checksum", "totals")

    def by_block(deleted_only: bool) -> DataFrame:
        texts = rows.mapInArrow(lambda b: _texts(b, part, deleted_only), _DELIVERY)
        both = texts.union(answers.where("block % 2 = 1") if deleted_only else answers)
        return both.repartition(tasks, "block").sortWithinPartitions("block", "kind", "at")

    weights: list[np.ndarray] = []

    def held_out_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _counted(batches, order):
            estimates = list(block.estimates(weights, n_kept, v_kept, kept=True))
            lower, (_, context, likely) = estimates[len(weights)][0], estimates[len(weights) + 1]
            seen = context > 0
            ratio = likely[seen] / lower[seen]
            step = np.zeros(len(ratio), np.int64)
            step[ratio > 0] = np.clip(np.rint(np.log2(ratio[ratio > 0]) * RESOLUTION) + 64 * RESOLUTION, 1, 128 * RESOLUTION - 1)
            cells, number = np.unique(_context(context[seen]) * 128 * RESOLUTION + step, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(number, pa.int64())], ["cell", "n"])

    if order > 2:
        deleted = checkpointed(by_block(True))
    for _ in range(order - 1):
        source = deleted if order > 2 else by_block(True)
        cells = source.mapInArrow(held_out_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros(CONTEXTS * 128 * RESOLUTION)
        table[cells["cell"].to_numpy(np.int64)] = cells["n"]
        weights.append(mixture_weights(table.reshape(CONTEXTS, -1)))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _counted(batches, order):
            estimates = list(block.estimates(weights, n, v))
            first = np.cumsum(block.numbers) - block.numbers
            total = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0)  # noqa: B023, E731
            known = total((block.counts[0][0] > 0).astype(np.int64))
            longs = [block.numbers, known, np.full(len(first), n)]
            doubles = [total(np.log10(estimates[i][0])) for i in (0, -1)]
            columns = [block.ids, block.held, *(pa.array(x, pa.int64()) for x in longs), *(pa.array(x, pa.float64()) for x in doubles)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return by_block(False).mapInArrow(scores, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
