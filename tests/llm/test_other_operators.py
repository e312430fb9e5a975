"""Embeddings, URLs and the pipeline."""

import fnmatch
import math
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import pq, urlfilter


def brute(rows):
    """n_links and component by id, of (id, vector, label) rows with distinct ids."""
    usable = [(i, np.array(v, float) / max(map(abs, v)), l) for i, v, l in rows if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, *_ in rows}
    for k, (i, x, l) in enumerate(usable):
        for j, y, m in usable[:k]:
            if l == m and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    label = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, near in links.items():
            low = min([label[i], *(label[j] for j in near)])
            changed |= low != label[i]
            label[i] = low
    return {i: (len(links[i]), label[i], label[i] == i) for i in links}


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    rows, n = [], 0
    for label in (0, 1, None):
        centres = rng.normal(size=(40, 16))
        for c in centres:
            for _ in range(rng.integers(1, 6)):
                rows.append((n, (c + rng.normal(size=16) * rng.choice([0.02, 0.12, 1.0])).tolist(), label))
                n += 1
    copy = rows[3][1]
    rows += [(n + i, v, 0) for i, v in enumerate([copy, copy, [2 * x for x in copy], None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [-0.0] + [1.0] * 15, [0.0] + [1.0] * 15, [1.0, 2.0]])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, home string, copies int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pq.embedding_groups(df).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("lists", [(1, 1), (6, 1), (3, 4)])
def test_blocks_lists_and_sub_lists_lose_no_link(spark, monkeypatch, lists):
    monkeypatch.setattr(pq, "BLOCK", 16)
    monkeypatch.setattr(pq, "HELD", 8)
    rng = np.random.default_rng(4)
    for width in (24, 100):
        base = rng.normal(size=(60, width))
        x = np.concatenate([base, base + 0.05 * rng.normal(size=base.shape), base[:1] + 0.03 * rng.normal(size=(120, width))])
        rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        found = pq.embedding_groups(df, per_list=8, most_lists=lists).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == brute(rows)


def test_rows_of_any_length_and_id(spark):
    """Each row is a vector of its own: against brute force over rows, whose ids are null or repeated."""
    rng = np.random.default_rng(9)
    rows = []
    for width in (1, 2, 3, 5, 16):
        for c in rng.normal(size=(6, width)):
            rows += [((c + 0.02 * rng.normal(size=width)).tolist(), int(rng.integers(2))) for _ in range(4)]
    rows += [([1.0, 0.0], 0), ([1.0, 0.01], 0), ([1.0, 0.02], 0), ([1.0, 0.0], 0), ([1.0, 0.0], 1), ([1e-200, 1e-202], 0), ([1e200, 1e198], 0)]
    ids = [None if k % 5 == 0 else k // 3 for k in range(len(rows))]
    expected = brute([(k, *r) for k, r in enumerate(rows)])
    names = {}
    for k, (_, component, _) in expected.items():
        names.setdefault(component, []).extend([ids[k]] if ids[k] is not None else [])
    wanted = []
    for k, (n, component, _) in expected.items():
        name = min(names[component], default=None)
        wanted.append((ids[k], n, name, ids[k] is not None and ids[k] == name))
    df = spark.createDataFrame([(i, *r) for i, r in zip(ids, rows, strict=True)], "vec_id long, embedding array<double>, label int")
    assert Counter(map(tuple, pq.embedding_groups(df).collect())) == Counter(wanted)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pq.embedding_groups(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, [1.0], None), (None, None, 2)], "vec_id long, embedding array<float>, label int")
    assert {tuple(r) for r in pq.embedding_groups(unlabelled).collect()} == {(1, 0, 1, True), (None, 0, None, False)}


def test_automaton_equals_fnmatch():
    pick = random.Random(5)
    text = lambda n, s="ab": "".join(pick.choice(s) for _ in range(n))
    globs = [text(pick.randint(0, 9), "ab*?") for _ in range(60)]
    automaton = urlfilter.Automaton([urlfilter.Rule(g.encode(), "block", f"{k:03d}") for k, g in enumerate(globs)])
    assert automaton.words > 1
    names = [r.name for r in automaton.rules]
    texts = [text(pick.randint(0, 14)) for _ in range(300)]
    for t, m in zip(texts, automaton.first_match([t.encode() for t in texts]), strict=True):
        fits = [f"{k:03d}" for k, g in enumerate(globs) if fnmatch.fnmatchcase(t, g)]
        assert (names[m] if m >= 0 else None) == (min(fits) if fits else None)


def test_urls(spark):
    rows = [
        ("https://Example.NET/en/1", "example.net", "/en/1", "example.net/en/", "allow"), ("http://a.example.net/fr/", "a.example.net", "/fr/", "net/", "block"), ("http://net/", "net", "/", "net/", "block"),
        ("http://x.net", "x.net", "", None, "allow"), ("http://xnet/", "xnet", "/", None, "allow"), ("http://a.com/b.net/", "a.com", "/b.net/", None, "allow"), ("x/y", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("http://b.example.com/de/?q=/de/#x", "b.example.com", "/de/", "example.com/de/", "block"), ("http://q.org/fr/a?b", "q.org", "/fr/a", "org/fr/", "allow"), ("http://É.net/é", "É.net", "/é", "net/", "block"), ("http://q.net?x=/en/", "q.net", "", None, "allow"),
        ("http://" + "a" * 5000 + ".net/", "a" * 5000 + ".net", "/", "net/", "block"),
    ]
    df = spark.createDataFrame([(i, r[0], "x", "y") for i, r in enumerate(rows)], "page_id long, url string, host string, rule string")
    got = [tuple(r)[1:] for r in urlfilter.url_verdicts(df).orderBy("page_id").collect()]
    assert got == [r[1:] for r in rows]
    assert urlfilter.url_verdicts(df.limit(0)).count() == 0


def test_pipeline_stages_equal_their_operators(spark, small):
    import corpus_pipeline
    from tidemark.llm import mixing, quality, rules, simhash

    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "rules", "near_duplicates", "mixing", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, small)
        out[name] = spark.createDataFrame(made.toPandas(), made.schema)
        if name == "quality":
            assert ids(out[name]) == ids(quality.quality_scores(docs, labels).where("predicted = 1"))
        if name == "rules":
            assert ids(out[name]) == ids(rules.quality_rules(docs).where("kept"))
        if name == "near_duplicates":
            assert ids(out[name]) == ids(simhash.simhash_groups(docs).where("doc_id = component_id"))
        if name == "mixing":
            plan = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_plan(docs).where("size > 0").collect()}
            assert ids(out[name]) == sorted(i for i, n in plan.items() for _ in range(n))
        if name != "packing":
            assert out[name].columns == docs.columns
        before, docs = docs, out[name]
    tokens = docs.groupBy("doc_id").sum("length").count()
    assert tokens == before.select("doc_id").distinct().count()


def test_pipeline_runs_whole_and_leaves_its_result_only(spark, small, tmp_path, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "checkpoint_dir", lambda spark: str(tmp_path))
    assert corpus_pipeline.run(spark, small).count() > 0
    assert [p.name for p in tmp_path.glob("pipeline-*/*")] == ["4-packing"]


def test_columns_of_any_name_stay(spark):
    """Stages that drop or copy rows, on columns that are called as their own might be."""
    from tidemark.llm import mixing, simhash

    names = ["_times", "_run", "_copy", "_row_a", "_ROW_B", "fp", "key", "hash", "taken", "least", "component"]
    rows = [(i, f"w{i} and some more words {i * i}", "ab"[i % 2], *([i] * len(names))) for i in range(20)] + [(None, "the one without an id", None, *([7] * len(names)))] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` int" for n in names))
    for made in (mixing.mixed(docs), simhash.near_duplicates_removed(docs)):
        assert made.columns == docs.columns
        assert set(map(tuple, made.collect())) <= set(rows)
    assert simhash.near_duplicates_removed(docs).count() == 21


def test_pipeline_keeps_rows_of_null_and_repeated_ids(spark, small, tmp_path, monkeypatch):
    """run() over null ids, repeated rows and two texts under one id; the stages that drop or copy rows against brute force on what they read."""
    import collections

    import corpus_pipeline
    from pyspark.sql import functions as F
    from tidemark.llm import mixing, simhash

    docs = spark.read.parquet(f"{small}/documents.parquet")
    anew = lambda keep, new: docs.where(keep).withColumn("doc_id", F.expr(new)).select(docs.columns)
    # Unlabelled clones of many documents: a third loses its id, another gets the id of its neighbour; every fifth row twice.
    odd = anew("doc_id % 3 > 0", "if(doc_id % 3 = 1, null, if(doc_id % 3 = 2, doc_id + 1000 - doc_id % 2, doc_id))").unionAll(anew("doc_id % 3 = 0", "doc_id")).unionAll(anew("doc_id % 15 = 0", "doc_id"))
    odd.coalesce(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{small}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(corpus_pipeline, "checkpoint_dir", lambda spark: str(tmp_path))
    pieces = corpus_pipeline.run(spark, str(tmp_path), keep=True).select("doc_id").collect()
    (folder,) = tmp_path.glob("pipeline-*")
    rules, kept, mix = (list(map(tuple, spark.read.parquet(f"{folder}/{n}").collect())) for n in ("1-rules", "2-near_duplicates", "3-mixing"))
    at = {c: i for i, c in enumerate(docs.columns)}
    of = lambda row, c: row[at[c]]
    assert sum(of(r, "doc_id") is None for r in rules) > 20 and len(set(rules)) < len(rules)

    prints = [simhash.fingerprint(of(r, "text")) for r in rules]
    group = list(range(len(rules)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    key = lambda r: (of(r, "doc_id") is None, of(r, "doc_id") or 0)
    least = {g: min(key(r) for r, h in zip(rules, group, strict=True) if h == g) for g in group}
    where = {r: g for r, g in zip(rules, group, strict=True)}
    assert len(kept) == len(least) == len({where[r] for r in kept}) and all(key(r) == least[where[r]] for r in kept)
    assert any(of(r, "doc_id") is None for r in kept)

    plan = collections.Counter()
    for r in mixing.mix_plan(spark.read.parquet(f"{folder}/2-near_duplicates")).collect():
        plan[r["doc_id"]] += r["taken"] // r["size"]
    copies = collections.Counter(mix)
    assert set(copies) <= set(kept) and max(copies.values()) <= mixing.REPEATS
    assert collections.Counter(of(r, "doc_id") for r in mix) == +plan and plan[None] > 0
    assert {p["doc_id"] for p in pieces} == {of(r, "doc_id") for r in mix}


def test_mixed_copies_belong_to_rows(spark):
    from tidemark.llm import mixing

    rows = [(i if i % 4 else None, f"w{i} " * (i % 7 + 1), "ab"[i % 2]) for i in range(40)] + [(1, "x " * n, "a") for n in (3, 5, 9)] + [(2, "same words here", "b")] * 6
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = sum(r["taken"] for r in mixing.mix_plan(docs).collect())
    got = mixing.mixed(docs).collect()
    assert sum(len(r["text"].split()) for r in got) == taken
    assert any(r["doc_id"] is None for r in got)
