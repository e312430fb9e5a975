"""Spelling variants: words one edit apart, found by a symmetric-delete join, and the commoner form that each leads to.

Every word emits a key for itself and for each of its distinct single deletions.  Words that
share a key are two edits apart at most; an equi-join on keys brings them together, and the
exact distance decides.  Two words one edit apart share exactly one key, so no pair comes
twice.  Keys are 64-bit hashes, all deletions of a word taken from running sums, so a word costs
its length and not its square; texts are joined to the pairs by the words' numbers.

A key is shared by a word and what one insertion makes of it: words of k letters number some
k times the alphabet there, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, finish, salted_left_join, text_bytes

RUN = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_LENGTH, LEAST_COUNT, TIMES, MODULUS = 7, 2, 10, 31
#: Letters whose keys are made at once (one word at least).
LETTERS = 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 2**64)


def words_of_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", modulus: int = MODULUS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts, each run with one code point left out where the checksum of id and run says so."""
    lowered = F.translate(F.col(text_column), _UPPER, _LOWER)
    # Shorter runs cannot become words.
    runs = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("of"), F.explode(F.regexp_extract_all(lowered, F.lit(f"({RUN}{{{least_length},}})"), 1)).alias("run"))
    h = F.crc32(F.concat("of", F.lit(":"), "run").cast("binary"))
    at = F.pmod(h, F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.pmod(h, F.lit(modulus)) == 0, cut).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def deletion_keys(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key for each word itself and for each of its distinct single deletions, and the number of the word.

    Words are code points between offsets.  Equal strings have equal keys, whatever they come from.
    """
    starts, ends = offsets[:-1], offsets[1:]
    length = ends - starts
    row = np.repeat(np.arange(len(starts)), length)
    place = np.arange(len(points)) - starts[row]
    power = np.ones(int(length.max(initial=0)) + 1, np.uint64)
    power[1:] = np.uint64(_STEP)
    power = np.cumprod(power, dtype=np.uint64)
    values = finish(points.astype(np.uint64) + np.uint64(1)) * power[place]
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    whole = finish((sums[ends] - sums[starts]) ^ finish(length.astype(np.uint64)))
    # Of a run of equal letters, leaving out any one gives the same string.
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(first)
    of = row[at]
    left, right = sums[at] - sums[starts[of]], (sums[ends[of]] - sums[at + 1]) * np.uint64(_BACK)
    without = finish((left + right) ^ finish((length[of] - 1).astype(np.uint64)))
    return np.concatenate([whole, without]), np.concatenate([np.arange(len(starts)), of])


def _code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return points, before[offsets]


def _emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        points, offsets = _code_points(batch.column(1))
        first = 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + LETTERS, "right")) - 1)
            keys, of = deletion_keys(points[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[first:last][of])], ["key", "id"])
            first = last


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each word of (id, word, n) with each word one edit away, in both directions; ids are distinct."""
    keys = words.select("id", "word").mapInArrow(_emitted, "key long, id long")
    pairs = keys.select("key", F.col("id").alias("a")).join(keys.select("key", F.col("id").alias("b")), "key").where("a < b").select("a", "b")
    for end in ("a", "b"):
        pairs = pairs.join(words.select(F.col("id").alias(end), F.col("word").alias(f"word_{end}"), F.col("n").alias(f"n_{end}")), end)
    near = pairs.where(F.levenshtein("word_a", "word_b", 1) == 1)
    both = F.array(*[F.struct(F.col(f"word_{x}").alias("word"), F.col(f"n_{x}").alias("n"), F.col(f"word_{y}").alias("other"), F.col(f"n_{y}").alias("other_n")) for x, y in ("ab", "ba")])
    return near.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where a word's forms lead in the end.

    A form is at least TIMES as common as its word, so chains end; each round doubles the
    steps taken, and the number of rounds is the logarithm of the longest chain.
    """
    pointers = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        above = pointers.select(F.col("word").alias("root"), F.col("root").alias("top"))
        counts = pointers.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
        moved = checkpointed(salted_left_join(pointers, above, ["root"], "word", counts))
        if moved.where("top is not null").isEmpty():
            return pointers
        pointers = moved.select("word", F.coalesce("top", "root").alias("root"))


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", modulus: int = MODULUS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words come from every row's whole text; a null text has none, and a null id counts as an
    empty one in the checksum.  Repeated rows count as often as they occur.  Words may be of any
    length.  Of near words of the same largest n the least in code-point order is the
    candidate for the form.  An empty table gives no rows.  Only the two named columns are read.
    """
    counted = words_of_documents(docs, id_column, text_column, modulus, least_length, least_count)
    words = checkpointed(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    # The least of (-n, word) is the commonest word, of equally common ones the least.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    best_of = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(best_of, "word", "left")
    common: Column = -F.col("best.less") >= times * F.col("n")
    judged = checkpointed(joined.select("word", F.when(common, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, -F.col("best.less")).alias("form_n")))
    rooted = judged.join(roots(judged.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Runs, checksums byte by byte, words; near words by equal rests at one place, or by a word equal to another's rest; chains by recursion.
SPELLING_SQL = """
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT DISTINCT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), slots AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT)) ORDER BY b) AS slot FROM range(256) AS t(b)
), bytes AS (
  SELECT doc_id, run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs
), sums AS (
  SELECT doc_id, run, k, xor(4294967295, list_reduce(list_transform(range(length(x) // 2), lambda i: CAST(('0x' || substr(x, 2 * i + 1, 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, slot[xor(c & 255, b) + 1]), 4294967295)) AS h FROM bytes CROSS JOIN slots
), results AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM sums
), words AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), rests AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM rests AS a JOIN rests AS b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
  UNION SELECT r.word, w.word FROM rests AS r JOIN words AS w ON w.word = r.rest
  UNION SELECT w.word, r.word FROM rests AS r JOIN words AS w ON w.word = r.rest
), ranked AS (
  SELECT x.word, x.other, o.n AS other_n, count(*) OVER (PARTITION BY x.word) AS n_near, row_number() OVER (PARTITION BY x.word ORDER BY o.n DESC, encode(x.other)) AS k
  FROM near AS x JOIN words AS o ON o.word = x.other
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form, CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
  FROM words AS w LEFT JOIN ranked AS r ON r.word = w.word AND r.k = 1
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain AS c JOIN formed AS f ON f.word = c.at WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.at AS root FROM chain AS c JOIN formed AS f ON f.word = c.at WHERE f.form IS NULL
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed AS f JOIN ends AS e USING (word)
"""
