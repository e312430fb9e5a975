"""Vector codes against a plain search over all entries in Python's integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import codes


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, sha) of (vec_id, vector, label) rows, the slow way."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    width = -(-max(len(r[1]) for r in kept) // parts)
    ints = [[math.floor(x * 256) if abs(x) < 2.0**52 else int(x) * 256 for x in r[1]] + [0] * (width * parts - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(ints[i], p) for i in order[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min((gap(cut(v, p), c), k) for k, c in enumerate(books[p]))
    for _ in range(rounds):
        of = [[near(v, p)[1] for p in range(parts)] for v in ints]
        for p in range(parts):
            groups = defaultdict(list)
            for v, code in zip(ints, of, strict=True):
                groups[code[p]].append(cut(v, p))
            for k, members in groups.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    last = [[near(v, p) for p in range(parts)] for v in ints]
    errors = [sum(d for d, _ in x) for x in last]
    of_label = defaultdict(int)
    for r, e in zip(kept, errors, strict=True):
        of_label[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    long = lambda e: e if e < 2**63 else None
    out = [(r[0], "".join(f"{k:02x}" for _, k in x), long(e), long(of_label[r[2]]), sha) for r, x, e in zip(kept, last, errors, strict=True)]
    return sorted(out, key=repr)


def found(spark, rows, partitions=3, **options):
    df = spark.createDataFrame([(*r, "clash", 7, 8) for r in rows], "vec_id long, embedding array<double>, label int, code string, l1 int, x int").repartition(partitions)
    return sorted(map(tuple, codes.vector_codes(df, **options).collect()), key=repr)


def test_equal_the_plain_search(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 32)) * 0.2
    rows = [(i, (centres[i % 30] + 0.02 * rng.normal(size=32)).tolist(), i % 3 or None) for i in range(400)]
    assert found(spark, rows) == plain(rows)


def test_ties_copies_and_odd_rows(spark):
    pick = random.Random(1)
    grid = lambda n: [pick.choice([-1, 0, 1]) / 128 for _ in range(n)]
    rows = [(pick.choice([None, 1, 2, *range(80)]), grid(32), pick.choice([0, 1, None])) for _ in range(300)]
    rows += rows[:40] + [(-1, None, 0), (-2, [None] + [0.0] * 31, 0), (-3, [math.nan] * 32, 1), (-4, [math.inf] * 32, 1), (500, [], 1), (501, [0.5], None), (502, grid(40), 1)]
    assert found(spark, rows) == plain(rows)


def test_components_of_any_size(spark):
    rows = [(i, [(-1) ** i * 1.5**i] * 16, i % 2) for i in range(40)] + [(100, [1e300] * 16, 0), (101, [-3e38] * 16, 1), (102, [2.0**55 + 8] * 16, 5)]
    assert found(spark, rows, entries=8) == plain(rows, entries=8)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = [(i, [i / 100] * 16, None) for i in range(n)]
    assert found(spark, rows) == plain(rows)


def test_many_labels_are_joined(spark, monkeypatch):
    monkeypatch.setattr(codes, "FEW_LABELS", 2)
    rows = [(i, [i / 50] * 16, i % 7 or None) for i in range(90)]
    assert found(spark, rows) == plain(rows)


def test_search_drops_nothing_that_could_win():
    rng = np.random.default_rng(8)
    for width, k in [(1, 1), (1, 64), (4, 64), (7, 33)]:
        x, book = rng.integers(-9, 9, (500, width)), rng.integers(-9, 9, (k, width))
        gaps = np.square(x[:, None] - book[None]).sum(2)
        at, best = codes.nearest_entries(x, book)
        assert (at == gaps.argmin(1)).all() and (best == gaps.min(1)).all()
