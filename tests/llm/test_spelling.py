"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from tidemark.llm import spelling


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    forms, nears = {}, {}
    for w, n in counts.items():
        around = sorted((-counts[v], v) for v in counts if near(w, v))
        nears[w] = len(around)
        forms[w] = around[0][1] if around and -around[0][0] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, nears[w], counts[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id long, text string, word string, n int, key int")
    return sorted(map(tuple, spelling.spelling_variants(df).collect()), key=repr)


def test_equal_to_all_pairs(spark):
    pick = random.Random(3)
    stems = ["".join(pick.choice("abÀÿé") for _ in range(pick.randint(6, 9))) for _ in range(25)]

    def word():
        w = pick.choice(stems)
        for _ in range(pick.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
            i = pick.randrange(len(w))
            w = w[:i] + pick.choice(["", "a", "bé", "X"]) + w[i + 1 :]
        return w

    rows = [(i % 90 or None, " ".join(word() + pick.choice(["", ",", "1", "\n", "×x", "Ā"]) for _ in range(pick.randint(0, 120)))) for i in range(100)]
    assert found(spark, rows) == plain(rows)


def test_chains_ties_and_repeated_rows(spark):
    words = {"aaaaaaaa": 2, "aaaaaaab": 25, "aaaaaabb": 300, "aaaaabbb": 3000, "ccccccc": 3, "cccccccd": 30, "ccccccce": 30, "cccccccÿ": 31, "ddddddd": 2, "dddddde": 19}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    # Ids for which no run of this text loses a letter.
    ids = [i for i in range(200) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in words)][:2]
    rows = [(ids[0], text), (ids[1], text), (ids[1], text)]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[0]: r[2] for r in got}["aaaaaaaa"] == "aaaaabbb"


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert sorted(map(tuple, spelling.spelling_variants(odd_documents).collect()), key=repr) == plain(rows)
    assert spelling.spelling_variants(no_documents).count() == 0


def test_very_long_words(spark):
    pick = random.Random(2)
    long = "".join(pick.choice("abcdefgh") for _ in range(60_000))
    text = f"{long} {long} {long[:-1]} {long[:-1]} {long[:500]}q{long[501:]} {long[:500]}q{long[501:]} {'z' * 90_000} {'z' * 90_000} {'z' * 89_999} {'z' * 89_999}"
    i = next(i for i in range(100) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in text.split()))
    got = spelling.spelling_variants(spark.createDataFrame([(i, text)], "doc_id long, text string")).collect()
    assert sorted((len(r["word"]), r["n"], r["n_near"]) for r in got) == [(59_999, 2, 1), (60_000, 2, 1), (60_000, 2, 2), (89_999, 2, 1), (90_000, 2, 1)]


def test_keys_are_those_of_the_strings():
    words = ["abc", "aab", "a", "zz", "ba", "ab"]
    points = np.array([ord(c) for w in words for c in w], np.uint32)
    keys, of = spelling.deletion_keys(points, np.concatenate([[0], np.cumsum([len(w) for w in words])]))
    by = {}
    for key, w in zip(keys.tolist(), of.tolist(), strict=True):
        by.setdefault(key, []).append(words[w])
    expected = {}
    for w in words:
        for s in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            expected.setdefault(s, []).append(w)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, expected.values()))
