"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document's whole multiples of the capacity are sequences of their own.  What is left is
cut at a half, a quarter and an eighth of the capacity where it reaches that far, and the
tail of under an eighth stays in one piece.  A piece of length n is of class
k = capacity // n, and each bin of class k takes exactly k pieces, so that it is full for
the cut pieces and at least k / (k + 1) full for tails (k >= 8).  Every task fills its own
bins, without a shuffle.  The pieces in bins that a task cannot fill at its end (a bounded
number) are strung together and cut at the capacity, so that a task pads one sequence.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
END_ID = 0
SMALLEST_CUT = 8  # a share of the capacity
TASK_BITS = 33
_BATCH_TOKENS = 1 << 21
LONG_RUN = 4096
# The pattern by which byte-level BPE splits a text, and its rules for white space.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
_SPACES, _SINGLE_SPACES = r"|\s+(?!\S)|\s+", r"|\s"

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ByteLevelTokenizer:
    """Ids as `tokenizers` gives them for a byte-level BPE file, without added special tokens, but several times as fast.

    The merges of such a file rank as its ids do, so tiktoken yields the same ids.  A text
    without two white-space characters in a row needs no look-ahead and takes a faster
    pattern; a text that spells a special token goes to `tokenizers` itself.  So does one
    with a run of LONG_RUN white-space characters, as a look-ahead steps back through the
    whole run and exhausts its stack at some hundred thousand of them.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        special = {x["content"] for x in model["added_tokens"]}
        ranks = {bytes(shown[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
        self.whole, self.single = (tiktoken.Encoding(name, pat_str=_SPLIT + spaces, mergeable_ranks=ranks, special_tokens={}) for name, spaces in (("whole", _SPACES), ("single", _SINGLE_SPACES)))
        self.exact, self.path = None, path
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.double, self.long_run = re.compile(r"\s\s"), re.compile(rf"\s{{{LONG_RUN}}}")
        self._load = Tokenizer.from_file

    def __call__(self, text: str) -> list[int]:
        double = self.double.search(text)
        if (self.special and self.special.search(text)) or (double and self.long_run.search(text)):
            self.exact = self.exact or self._load(self.path)
            return self.exact.encode(text, add_special_tokens=False).ids
        return (self.whole if double else self.single).encode_ordinary(text)


@lru_cache(2)
def tokenizer(path: str) -> ByteLevelTokenizer:
    """One tokenizer a worker and file."""
    return ByteLevelTokenizer(path)


class Bins:
    """The open bins of one task."""

    def __init__(self, task: int, capacity: int = CAPACITY) -> None:
        self.next, self.capacity = task << TASK_BITS, capacity
        self.open: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        start, total, cut = 0, len(ids), self.capacity
        while cut > self.capacity // SMALLEST_CUT or total - start >= cut:
            if total - start >= cut:
                self._place(doc, start, ids[start : start + cut], total)
                start += cut
            else:
                cut //= 2
        if start < total:
            self._place(doc, start, ids[start:], total)

    def _place(self, doc: int | None, start: int, ids: np.ndarray, total: int) -> None:
        k = self.capacity // len(ids)
        pieces = self.open.setdefault(k, [])
        pieces.append((doc, start, ids, total))
        if len(pieces) == k:
            self._close(self.open.pop(k))

    def finish(self) -> None:
        """Strings the pieces of unfilled bins together and cuts them at the capacity."""
        held, room = [], self.capacity
        for pieces in self.open.values():
            for doc, start, ids, total in pieces:
                while len(ids):
                    held.append((doc, start, ids[:room], total))
                    start, ids, room = start + len(ids[:room]), ids[room:], room - len(ids[:room])
                    if not room:
                        self._close(held)
                        held, room = [], self.capacity
        if held:
            self._close(held)
        self.open = {}

    def drain(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) or [[] for _ in range(7)]
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def packed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty and so a single end token.  Rows of null or repeated ids are rows
    like any other, and repeated rows are packed as often as they occur.  A text may be of
    any length and of any characters, such as millions of blanks.  sequence_id holds the task's number in its upper bits, so workers need not
    agree on anything; a task that runs again packs its rows the same way.
    """
    path = path or default_tokenizer()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins, tokens = tokenizer(path), Bins(TaskContext.get().partitionId()), 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "")
                ids.append(END_ID)
                bins.add(doc, np.array(ids, "<u4"))
                tokens += len(ids)
                if tokens > _BATCH_TOKENS:
                    yield bins.drain()
                    tokens = 0
        bins.finish()
        yield bins.drain()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(each, SCHEMA)
