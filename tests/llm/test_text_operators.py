"""Operators on documents against plain versions, on odd rows and on the smallest table."""

import collections
import math
import os
import re
import shutil
import textwrap
import threading
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from oracle import connection, rows_of
from tidemark.llm import licences, lm, mixing, packing, quality, queries, rules, sharding, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# SimHash


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(8)
    for f in rng.integers(0, 2**64, 400, dtype=np.uint64):
        g = f
        for b in rng.choice(64, 4, replace=False):
            g ^= np.uint64(1) << np.uint64(b)
        rows, keys = simhash.fuzzy_keys(np.array([f, g]))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_golay_indices_are_all_codewords_within_four():
    words = np.random.default_rng(1).integers(0, 1 << 23, 20)
    codewords = np.array([(m << 11) | simhash._remainder(m << 11) for m in range(4096)])
    index, count = simhash.golay_indices(words)
    for w, i, n in zip(words, index, count, strict=True):
        assert set(i[:n]) == set(np.flatnonzero(np.bitwise_count(codewords ^ w) <= 4))


@pytest.mark.parametrize("which", ["odd", "small"])
def test_simhash_equals_brute_force(spark, small, odd_documents, which):
    docs = odd_documents if which == "odd" else documents(spark, small)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(rows)
    prints = collections.defaultdict(set)
    for i, t in rows:
        prints[i].add(plain_fingerprint(t) if t is None or len(t) < 100_000 else simhash.fingerprint(t))
    for r in got:
        assert int(r["fingerprint"], 16) in prints[r["doc_id"]]
    known = sorted(i for i in prints if i is not None)
    links = [(a, b) for k, a in enumerate(known) for b in known[:k] if any((x ^ y).bit_count() <= 4 for x in prints[a] for y in prints[b])]
    expected = components(known, links)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == expected


def test_rows_of_null_and_repeated_ids_link_by_text(spark, monkeypatch):
    """Fingerprints stand in for texts: a row of a null id joins two others, and rows of one id stay apart."""
    chosen = {"a": 0, "b": 0b111, "c": 0b111111, "d": 1 << 40 | 0xFFFF << 44, "e": (1 << 63) - 1, "f": (1 << 63) - 2}
    as_rows = lambda docs, *_: docs.select("doc_id", F.element_at(F.create_map(*[F.lit(x) for p in chosen.items() for x in p]), F.col("text")).alias("fp"))
    monkeypatch.setattr(simhash, "fingerprints", as_rows)
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (1, "d"), (None, "e"), (None, "f")], "doc_id long, text string")
    got = sorted((r["fingerprint"], r["doc_id"], r["component_id"]) for r in simhash.simhash_groups(docs).collect() if r["doc_id"])
    assert got == sorted([("0" * 16, 1, 1), (f"{0b111111:016x}", 2, 1), (f"{chosen['d']:016x}", 1, 1)])
    assert [r["component_id"] for r in simhash.simhash_groups(docs).where("fingerprint like '7%'").collect()] == [None, None]


@pytest.mark.parametrize("most", [3, 40])
def test_dense_keys_are_split_without_losing_links(spark, most):
    rng = np.random.default_rng(6)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 10, 150), rng.integers(0, 1 << 62, 60), (1 << 50) + rng.integers(0, 1 << 14, 150)]))
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    found = [tuple(r) for r in simhash.fingerprint_links(df, most).collect()]
    links = [(int(x), int(y)) for i, x in enumerate(fps) for y in fps[:i] if int(x ^ y).bit_count() <= 4]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert components(fps.tolist(), found) == components(fps.tolist(), links)


def test_large_runs_give_a_spanning_forest():
    rng = np.random.default_rng(2)
    fps = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64))
    a, b = simhash._links_in_runs(np.zeros(len(fps), np.int64), fps)
    links = [(int(x), int(y)) for i, x in enumerate(fps) for y in fps[:i] if int(x ^ y).bit_count() <= 4]
    assert components(fps.tolist(), zip(a.tolist(), b.tolist(), strict=True)) == components(fps.tolist(), links)


def test_one_document_of_each_group_stays(odd_documents):
    kept = {r["doc_id"] for r in simhash.near_duplicates_removed(odd_documents).collect()}
    assert {1, 4} <= kept and not {2, 3, 5} & kept


# Packing


@pytest.mark.parametrize("which", ["odd", "small"])
def test_packing_round_trip(spark, small, odd_documents, which):
    from tokenizers import Tokenizer

    docs = odd_documents if which == "odd" else documents(spark, small)
    encoder = Tokenizer.from_file(packing.default_tokenizer())
    ids = collections.defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        ids[r["doc_id"]].append([*encoder.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    pieces = packing.packed(docs).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(ids)
    for doc, versions in ids.items():
        assert sum(p["length"] for p in by_doc[doc]) == sum(map(len, versions))
        for p in by_doc[doc]:
            fits = [v for v in versions if len(v) == p["doc_tokens"]]
            assert any(zlib.crc32(np.array(v[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for v in fits)
    for rows in by_sequence.values():
        at = 0
        for p in sorted(rows, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 1024
    total = sum(p["length"] for p in pieces)
    assert total / (1024 * len(by_sequence)) > 0.97


@pytest.mark.parametrize("run", [" " * 5_000_000, "\n" * 1_000_000, "\u00a0" * 1_000_000, " \t\n" * 300_000, "x" + " " * 4_095 + "y", "x" + " " * 4_096 + "y", "\u2003 " * 5_000])
def test_long_white_space_gives_equal_ids(run):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    text = f"before{run}after it"
    assert packing.tokenizer(path)(text) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_white_space_document_is_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (None, "a"), (None, "a")], "doc_id long, text string")
    rows = packing.packed(docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1_000_001
    assert sum(r["length"] for r in rows if r["doc_id"] is None) == 4


def test_classes_hold_a_fixed_count():
    bins = packing.Bins(0)
    for i in range(40):
        bins.add(i, np.arange(100, dtype="<u4"))
    bins.finish()
    counts = collections.Counter(r[5] for r in bins.out)
    assert sorted(counts.values(), reverse=True)[:4] == [10, 10, 10, 10]


# Language model


def plain_scores(rows, weights):
    mod = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 5
    order = len(weights) + 1
    counts, contexts = [collections.Counter() for _ in range(order)], [collections.Counter() for _ in range(order)]

    def grams(words):
        """By token and order: the token with the words before it; a text's first word follows an end."""
        return [[tuple(words[max(0, i - k) : i + 1]) if i >= k else ("\n", *words[: i + 1]) for k in range(order)] for i in range(len(words))]

    tokens = [(i, [*WORD.findall(lower(t or "")), "\n"]) for i, t in rows]
    for i, t in tokens:
        if mod(i) != 1:
            for token in grams(t):
                for k, gram in enumerate(token):
                    counts[k][len(gram) == k + 1, gram] += 1
                    contexts[k][len(gram) == k + 1, gram[:-1]] += 1
    n, v = sum(counts[0].values()), len(counts[0])
    out = []
    for i, t in tokens:
        base = score = 0.0
        known = 0
        for token in grams(t):
            p = (counts[0][True, token[0]] + 0.5) / (n + 0.5 * (v + 1))
            known += counts[0][True, token[0]] > 0
            base += math.log10(p)
            for k in range(1, order):
                key = len(token[k]) == k + 1
                seen = contexts[k][key, token[k][:-1]]
                w = weights[k - 1][min(math.frexp(seen)[1], lm.CONTEXTS - 1)] if seen else 0.0
                p = w * counts[k][key, token[k]] / max(1, seen) + (1 - w) * p
            score += math.log10(p)
        out.append((i, mod(i) == 1, len(t), known, n, base, score))
    return out


@pytest.mark.parametrize(("which", "order"), [("odd", 2), ("odd", 3), ("small", 2), ("small", 3), ("odd", 4)])
def test_scores_equal_brute_force(spark, small, odd_documents, which, order, monkeypatch):
    docs = odd_documents if which == "odd" else documents(spark, small)
    learned = []
    monkeypatch.setattr(lm, "LEAST_BYTES", 1 << 16)
    monkeypatch.setattr(lm, "mixture_weights", lambda counts, f=lm.mixture_weights: learned.append(f(counts)) or learned[-1])
    got = sorted(map(tuple, lm.interpolated_scores(docs, order=order).collect()), key=repr)
    assert len(learned) == order - 1
    expected = sorted(plain_scores([(r["doc_id"], r["text"]) for r in docs.collect()], learned), key=repr)
    assert len(got) == len(expected)
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_totals_pass_32_bits():
    """A bucket's answers to blocks that together hold a word and a pair over 2**32 times."""
    import pyarrow as pa

    hashes, counts = lm._packed(np.array([5, 4], np.uint64)), lm._packed(np.array([3_000_000_000, 7], np.uint32))
    rows = [{"bucket": 0, "block": b, "checksum": b, "grams": [hashes, hashes], "counts": [counts, counts]} for b in (0, 1, 2)]
    got = {r["block"]: r for batch in lm._answered(iter([pa.RecordBatch.from_pylist(rows)])) for r in batch.to_pylist()}
    assert got[-1]["sums"] == [9_000_000_021, 2, 6_000_000_014, 2]
    for k in range(2):
        assert lm._unpacked(got[0]["totals"][k], np.uint64).tolist() == [9_000_000_000, 21]
        assert lm._unpacked(got[1]["totals"][k], np.uint64).tolist() == [9_000_000_000, 21, 3_000_000_000, 7]


def test_a_changed_block_is_an_error():
    import pyarrow as pa

    checks = [lm._checksum(lm._tokens(pa.chunked_array([t], pa.string()), 2)[0][0]) for t in (["a b", "c"], ["a", "b c"], ["c", "a b"], ["a b", "c"])]
    assert checks[0] == checks[3] and len(set(checks)) == 3
    sent = lm._sent(pa.table({"doc_id": [1], "held": [False], "text": ["a b"]}))
    columns = [pa.array([0, 0]), pa.array([0, 1], pa.int32()), pa.array([0, 0]), pa.array([None, sent]), pa.array([checks[0], None]), pa.nulls(2, pa.list_(pa.binary()))]
    rows = pa.Table.from_arrays(columns, ["block", "kind", "at", "documents", "checksum", "totals"])
    with pytest.raises(RuntimeError, match="changed"):
        lm._Counts(0, rows, 1)


def test_parcels_grow_with_the_corpus():
    parcels = lambda size: (size / lm.block_bytes(size)) ** 2
    assert parcels(1 << 42) / parcels(1 << 38) <= 16.1
    assert lm.block_bytes(0) == lm.LEAST_BYTES and lm.block_bytes(100 << 40) == lm.MOST_BYTES


def test_weights_are_the_likeliest():
    counts = np.zeros((2, 128 * lm.RESOLUTION))
    counts[0, 0], counts[0, 64 * lm.RESOLUTION + 6 * lm.RESOLUTION] = 700, 300
    w = lm.mixture_weights(counts)[0]
    loss = lambda x: -(700 * math.log(1 - x) + 300 * math.log(x * 64 + 1 - x))
    assert loss(w) <= min(loss(x) for x in np.linspace(0.001, 0.999, 500)) + 1e-6


def test_interpolation_beats_the_base_on_held_out(spark, small):
    rows = lm.interpolated_scores(documents(spark, small)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


# Quality classifier


def test_classifier_is_right_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    rows = got.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col("quality")).cast("int").alias("right"), "score").agg(F.avg("right"), F.min("score"), F.max("score"), F.count("*")).first()
    assert rows[0] > 0.93 and rows[3] > 50 and 0 <= rows[1] <= rows[2] <= 1
    assert got.count() == docs.count()


def test_classifier_on_odd_rows_and_without_labels(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(4, 1), (4, 0), (100, 1), (101, 0), (102, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    got = quality.quality_scores(odd_documents, labels).collect()
    assert len(got) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in got)
    by = collections.defaultdict(set)
    for r in got:
        by[r["doc_id"]].add(round(r["score"], 12))
    assert by[1] == by[2] == by[3] and by[4] == by[5]
    assert quality.quality_scores(odd_documents, labels.limit(0)).count() == len(got)
    assert quality.quality_scores(no_documents, labels).count() == 0
    kept = quality.with_quality(odd_documents, labels, score_column="_q")
    assert kept.columns == [*odd_documents.columns, "_q"]


def test_repeated_ids_teach_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    text = lambda good: " ".join(rng.choice(["alpha", "beta", "gamma"] if good else ["x1", "#", "22"], 30))
    docs = [(i, text(i % 2)) for i in range(60)] + [(0, text(k % 2)) for k in range(500)]
    frame, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality.Network, "fit", lambda self, x, y, f=quality.Network.fit: seen.append(len(x)) or f(self, x, y))
    assert quality.quality_scores(frame, labels).count() == 560
    assert seen[0] <= 60


def test_temperature_does_not_change_the_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(float)
    net = quality.Network().fit(x, y)
    assert ((net(x) > 0.5) == y).mean() > 0.8 and 0.5 <= net.temperature <= 8


# Quality rules


def plain_rules(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(words) < 20 or 100 * len(covered) > 30 * len(words))


def plain_distances(text, lang):
    """Distances of characters, marks and common words; none where there is nothing to count."""
    text, words = text or "", WORD.findall(text or "")
    code = re.match("[A-Za-z]*", (lang or "").strip(" "))[0].lower()
    chars, marks, common = rules.reference_histograms()[code if code in rules.REFERENCE_CHARACTERS else ""]
    of = [len(re.findall(c, text)) for c in rules.CHARACTER_CLASSES]
    h = [*of, len(text) - sum(of)]
    if code not in rules.REFERENCE_CHARACTERS:
        h = [h[0] + h[-1], *h[1:-1], 0]
    bars, symbols = text.count("|"), len(re.findall("[#*$%&<>]", text))
    m = [of[4], bars, symbols, of[5] - bars - symbols]
    w = [sum(x.lower() == c for x in words) for c in rules.COMMON_WORDS]

    def far(counts, reference):
        if not sum(counts):
            return None
        total = 0.0
        for x, q in zip((c / sum(counts) for c in counts), reference, strict=True):
            mid = (x + q) / 2
            total += sum(v * math.log2(v / mid) for v in (x, q) if v) / 2
        return math.sqrt(max(0.0, total))

    return far(h, chars), far(m, marks), far([*w, len(words) - sum(w)], common), sum(m)


@pytest.mark.parametrize("which", ["odd", "small"])
def test_verdicts_equal_brute_force(spark, small, odd_documents, which):
    docs = odd_documents if which == "odd" else documents(spark, small)
    expected = collections.Counter()
    for r in docs.select("doc_id", "text", "lang").collect():
        *d, n_marks = plain_distances(r["text"], r["lang"])
        base = plain_rules(r["text"])
        limits = ((rules.MAX_CHARACTER_DISTANCE, len(r["text"] or ""), rules.MIN_CHARS), (rules.MAX_MARK_DISTANCE, n_marks, rules.MIN_MARKS), (rules.MAX_WORD_DISTANCE, base[0], rules.MIN_WORDS))
        far = any(x is not None and x > most and n >= least for x, (most, n, least) in zip(d, limits, strict=True))
        expected[r["doc_id"], not base[5] and not far, *(None if x is None else round(x, 9) for x in d)] += 1
    got = rules.quality_rules(docs).collect()
    names = ("char_distance", "mark_distance", "word_distance")
    assert collections.Counter((r["doc_id"], r["kept"], *(None if r[n] is None else round(r[n], 9) for n in names)) for r in got) == expected


@pytest.mark.parametrize("which", ["odd", "small"])
def test_rule_measures_equal_brute_force(spark, small, odd_documents, which):
    docs = odd_documents if which == "odd" else documents(spark, small)
    expected = sorted(((r["doc_id"], *plain_rules(r["text"])) for r in docs.collect()), key=repr)
    got = rules.quality_rules(docs).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == expected
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_distance_equals_numpy(spark):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.2, 0.7]
    got = spark.range(1).select(rules.distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q))).alias("d")).first()["d"]
    a, b = np.array(p), np.array(q)
    m = (a + b) / 2
    kl = lambda x: sum(v * math.log2(v / w) for v, w in zip(x, m, strict=True) if v)
    assert got == pytest.approx(math.sqrt((kl(a) + kl(b)) / 2))


def test_rules_keep_clean_documents_and_columns(spark, no_documents):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    kept = rules.good_documents(docs)
    assert kept.columns == docs.columns
    verdicts = rules.quality_rules(docs)
    clean = verdicts.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert clean.where("not kept").count() == 0
    junk = verdicts.join(labels.where("quality = 0"), "doc_id")
    assert junk.where("kept").count() < 0.1 * junk.count()
    assert kept.count() == verdicts.where("kept").count()
    assert rules.quality_rules(no_documents).count() == 0


def test_verdicts_depend_on_the_document_alone(spark):
    """A third of the rows in upper case or of symbols, or a table of a single document, moves no verdict or distance."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 400")
    names = ("doc_id", "kept", "char_distance", "word_distance")
    verdicts = lambda df: {tuple(r) for r in rules.quality_rules(df).select(*names).collect()}
    alone = verdicts(docs)
    half = docs.where("doc_id % 2 = 0")
    for i, text in enumerate(("upper(text)", "regexp_replace(text, '[a-z]', '#')")):
        junk = half.withColumn("doc_id", F.expr(f"doc_id + {(i + 1) * 1_000_000}")).withColumn("text", F.expr(text))
        both = verdicts(docs.unionAll(junk.select(docs.columns)))
        assert alone <= both
        far = [r for r in both - alone if len(r) and r[1]]
        assert len(far) <= 0.02 * half.count()
    one = docs.limit(1)
    assert verdicts(one) <= alone
    # A rare or null language has a verdict too, and letters of any script are letters to it.
    clean, words = docs.where("lang = 'en'").first()["text"], "это обычный текст о погоде и людях "
    rows = [(1, clean, None), (2, clean.upper(), None), (3, clean.upper(), "xx"), (4, words * 1 + " ".join(f"слово{'абвгдежзик'[i % 10] * (i % 9 + 1)}" for i in range(80)) + ".", "ru"), (5, clean, "EN-gb")]
    got = {r["doc_id"]: r for r in rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r["char_distance"] is not None for r in got.values())
    assert [got[i]["char_distance"] <= rules.MAX_CHARACTER_DISTANCE for i in range(1, 6)] == [True, False, False, True, True]


# Mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        targets = {s: 3.0 * sizes[s] if s in full else left * weights[s] / sum(weights[x] for x in open_) for s in names}
        over = {s for s in open_ if targets[s] > 3 * sizes[s]}
        if not over:
            return targets
        full |= over


@pytest.mark.parametrize("which", ["odd", "small"])
def test_mix(spark, small, odd_documents, which):
    docs = odd_documents if which == "odd" else documents(spark, small)
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    plan = mixing.mix_plan(docs)
    got = plan.collect()
    assert sorted((r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in rows if r["doc_id"] is not None) == sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None)
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in got)
    targets = plain_targets(sizes)
    assert sorted({(sizes[s], round(t, 6)) for s, t in targets.items()}) == sorted({(r["source_size"], round(r["target"], 6)) for r in got})
    taken = collections.Counter()
    for r in got:
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    if which == "small":
        assert all(abs(n - t) <= max(0.05 * t, 30) for (_, t), n in taken.items())
    assert sorted(map(tuple, plan.collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_knapsack_fits_the_budget():
    rng = np.random.default_rng(6)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 400, 60))
        counts = rng.integers(1, 9, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum()))
        take = mixing._fitted(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert 0 <= budget - (take * lengths).sum() <= max(3, 0.01 * budget)
    assert mixing._fitted(np.array([0, 5]), np.array([3, 2]), 7).tolist()[1] == 1


def test_mixed_documents_follow_the_plan(spark, small, no_documents):
    docs = documents(spark, small)
    plan = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_plan(docs).collect() if r["taken"]}
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and collections.Counter(r["doc_id"] for r in got.collect()) == plan
    assert mixing.mix_plan(no_documents).count() == 0


# Sharding


def test_compaction_round_trip(spark, small, odd_documents, tmp_path):
    for i, docs in enumerate((odd_documents, documents(spark, small).repartition(6))):
        store = sharding.ShardStore(spark, str(tmp_path / str(i)), small=1 << 14, target=1 << 17)
        got = sharding.compacted(docs, store.path, small=1 << 14, target=1 << 17)
        assert sorted((r["doc_id"], r["n_bytes"]) for r in got.collect() if r["doc_id"] is not None) == sorted((r["doc_id"], len((r["text"] or "").encode())) for r in docs.collect() if r["doc_id"] is not None)
        back = store.read()
        assert rows_of(back.select(sorted(back.columns))) == rows_of(docs.select(sorted(docs.columns)))
        live = store.manifest().collect()
        assert sum(r["n_docs"] for r in live) == docs.count()
        tiers = collections.Counter(r["tier"] for r in live if r["n_bytes"] < (1 << 16))
        assert all(n < sharding.MERGE for n in tiers.values())


def test_a_version_is_committed_once(spark, odd_documents, tmp_path, monkeypatch):
    store = sharding.ShardStore(spark, str(tmp_path / "s"))
    assert store.append(odd_documents.limit(5)) == 1
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(store.manifest(1), 0)
    # A rename that moves the folder into the one that is there, as some file systems do.
    monkeypatch.setattr(store, "_renamed", lambda staged, final: shutil.move(f"{store.path}/{staged}", f"{store.path}/{final}"))
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit(store.manifest(1), 0)
    assert store.version() == 1 and store.manifest(1).count() >= 1
    assert [n for n in os.listdir(tmp_path / "s" / "manifests") if n.startswith(".staged")] == []


def test_of_racing_writers_one_commits(spark, odd_documents, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"))
    store.append(odd_documents.limit(5))
    manifest, start, won = store.manifest(1), threading.Barrier(4), []

    def write():
        start.wait()
        try:
            won.append(store.commit(manifest, 1))
        except RuntimeError:
            won.append(None)

    writers = [threading.Thread(target=write) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(won, key=str) == [2, None, None, None] and store.manifest(2).count() == manifest.count()


def plain_compaction(sizes, new, small, target, ratio, merge):
    """The sizes of the shards after an arrival, where merged shards are one file each up to the target."""
    sizes = sorted([*sizes, *new])
    tier = lambda n: math.ceil(round(math.log(max(1, n / small), ratio), 9))
    while True:
        due = collections.Counter(tier(n) for n in sizes if n < target // 2)
        due = sorted(t for t, n in due.items() if n >= merge)
        if not due:
            return sizes
        merged = [n for n in sizes if n < target // 2 and tier(n) == due[0]]
        assert sum(merged) <= target
        sizes = sorted([n for n in sizes if not (n < target // 2 and tier(n) == due[0])] + [sum(merged)])


def test_tiers_equal_brute_force(spark, tmp_path):
    limits = {"small": 64, "target": 4096, "ratio": 4, "merge": 3}
    store = sharding.ShardStore(spark, str(tmp_path / "s"), **limits)
    pick, sizes = np.random.default_rng(5), []
    for k in range(9):
        n = int(pick.choice([10, 50, 64, 65, 200, 256, 700, 2100]))
        store.append(spark.createDataFrame([(k, "x" * n)], "doc_id long, text string").coalesce(1))
        store.compact()
        sizes = plain_compaction(sizes, [n], **limits)
        assert sorted(r["n_bytes"] for r in store.manifest().collect()) == sizes
    assert sorted(r["doc_id"] for r in store.read().collect()) == list(range(9))


def test_versions_columns_and_vacuum(spark, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "s"), merge=2)
    first = spark.createDataFrame([(1, "a", 7, "u", 1)], "doc_id long, text string, _bytes long, _shard string, _arrival int")
    store.append(first)
    store.append(spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string"))
    store.compact()
    assert sorted(map(tuple, store.read().select("doc_id", "text", "_bytes", "_shard", "_arrival").collect()), key=str) == [(1, "a", 7, "u", 1), (None, None, None, None, None), (None, None, None, None, None)]
    assert store.read(1).count() == 1 and store.version() == 3
    store.vacuum()
    assert store.read(2).count() == 3
    store.vacuum(versions=1, seconds=3600)
    assert store.read(1).count() == 1
    store.vacuum(versions=1, seconds=-5)
    assert store.read().count() == 3
    with pytest.raises(AnalysisException):
        store.read(1).count()
    assert {r["shard"] for r in store.manifest().collect()} == {f"data/{p.parent.name}/{p.name}" for p in (tmp_path / "s" / "data").glob("*/*.parquet")}
    got = sharding.compacted(first.union(first), str(tmp_path / "t")).collect()
    assert [(r["doc_id"], r["n_bytes"]) for r in got] == [(1, 1), (1, 1)]


def test_compaction_of_nothing(no_documents):
    assert sharding.compacted(no_documents).count() == 0


# Licences and the queries with SQL


# A published text of the MIT licence, wrapped as it mostly is.
MIT_TEXT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY."""
GPL_NOTICE = """/*
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 */"""
BSD_TEXT = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
#
#   1. Redistributions of source code must retain the above copyright notice,
#      this list of conditions and the following disclaimer.
#   (b) Redistributions in binary form must reproduce the above copyright
#      notice, this list of conditions and the following disclaimer in the
#      documentation and/or other materials provided with the distribution.
{}
# THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS\""""
ENDORSE = """#   3. Neither the name of the copyright holder nor the names of its
#      contributors may be used to endorse or promote products derived from
#      this software without specific prior written permission."""
LICENCE_TEXTS = [
    (MIT_TEXT, "MIT"), (MIT_TEXT.replace("\n", "\r\n"), "MIT"), (GPL_NOTICE, "GPL-2.0-or-later"), (BSD_TEXT.format("#"), "BSD-2-Clause"), (BSD_TEXT.format(ENDORSE), "BSD-3-Clause"),
    ("Released under the MIT License", "MIT"), ("Prose here\nReleased under the MIT License\nmore prose", "MIT"), ("This page is released under the MIT License.", "MIT"),
    ("This page is not released under the MIT License.", ""), ("It was licensed under duress.", ""), ("licensed under", ""), (None, ""), ("", ""),
    ("LICENSED  under the Apache License, Version 2.0.", "Apache-2.0"), ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"), ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"), ("Available under the terms of the Mozilla Public License 2.0", "MPL-2.0"),
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"), ("/* SPDX-License-Identifier: (GPL-2.0-or-later OR bsd-3-clause) */", "BSD-3-Clause;GPL-2.0-or-later"), ("# SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception", "Apache-2.0"),
    ("SPDX-License-Identifier: GPL-2.0+", "GPL-2.0-or-later"), ("SPDX-License-Identifier: none", ""), ("x" * 300_000 + "\n" + MIT_TEXT + " y" * 100_000, "MIT"),
    (MIT_TEXT + "\n\n" + BSD_TEXT.format(ENDORSE) + "\n\nLicensed under CC BY 4.0.", "BSD-3-Clause;CC-BY-4.0;MIT"), ("Released under the MIT License. Licensed under CC BY-NC 4.0.\nReleased under the MIT License", "CC-BY-NC-4.0;MIT"),
]


def test_licences_of_wrapped_texts(spark, no_documents):
    shapes = [("", ""), ("# ", ""), (" * ", ""), ("// ", ""), ("-- ", ""), ("    ", "")]
    rows = list(LICENCE_TEXTS)
    for licence, passage in licences.PASSAGES:
        for mark, _ in shapes:
            lines = [x for part in passage.split("\n") for x in textwrap.wrap(part, 60)]
            rows.append(("\n".join(mark + x for x in ["Copyright 2001", "", *lines, "", "The end"]), licence))
    df = spark.createDataFrame([(k // 2 if k % 7 else None, t, k, "x") for k, (t, _) in enumerate(rows)], "doc_id long, text string, n_sentences int, licences string")
    got = licences.licence_scan(df)
    assert sorted((r["doc_id"], r["licences"]) for r in got.collect() if r["doc_id"] is not None) == sorted((k // 2, licence) for k, (_, licence) in enumerate(rows) if k % 7)
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas())
    assert rows_of(got) == rows_of(con.sql(licences.licence_sql()).df())
    assert len({licence for licence, _ in licences.RULES} | set(licences.licence_names().values())) >= 40
    assert licences.licence_scan(no_documents).count() == 0


def test_a_rule_wants_its_order(spark):
    first, second = MIT_TEXT.split("\n\n")[2:4]
    df = spark.createDataFrame([(1, f"{second}\n\n{first}"), (2, f"{first}\n\nOther words.\n\n{second}"), (3, first)], "doc_id long, text string")
    assert {r["doc_id"]: (r["n_sentences"], r["licences"]) for r in licences.licence_scan(df).collect()} == {1: (2, ""), 2: (2, "MIT"), 3: (1, "")}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, small, name):
    assert rows_of(queries.QUERIES[name](spark, small)) == rows_of(connection(small).sql(queries.ORACLES[name]).df())


@pytest.mark.parametrize("operator", [simhash.simhash_groups, packing.packed, lm.interpolated_scores])
def test_operators_on_no_rows(no_documents, operator):
    assert operator(no_documents).count() == 0
