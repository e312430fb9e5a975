"""Cases that once went wrong: names of columns, repeats, types of columns, maps, long URLs, dense keys, holders of licences."""

import itertools
import random
import time

import numpy as np
import pytest

from tidemark.llm import licences, mixing, sharding, simhash, urlfilter


def test_every_stage_keeps_columns_of_its_own_names(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet").selectExpr("*", "doc_id AS _quality", "1.5D AS score", "'x' AS _times", "map('b', 1, 'a', doc_id) AS tags")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == docs.columns
        assert kept.count() > 0 and kept.where("_quality <> doc_id or score <> 1.5 or tags['a'] <> doc_id").isEmpty()


def test_maps_are_equal_whatever_their_order(spark):
    rows = spark.sql("""SELECT doc_id, 'one and the same text of several words' AS text, 'a' AS source, m, n FROM VALUES
        (1, map('a', 1, 'b', 2), array(map(1, 'x'))), (1, map('b', 2, 'a', 1), array(map(1, 'x'))), (1, map('b', 2), array(map(1, 'x'))), (1, NULL, NULL) AS t(doc_id, m, n)""")
    keys = mixing.row_keys(rows)
    found = rows.withColumns(keys).groupBy(*keys).count()
    assert sorted(r["count"] for r in found.collect()) == [1, 1, 2]
    assert simhash.near_duplicates_removed(rows).count() == 1
    assert mixing.mixed(rows).count() > 0


@pytest.mark.parametrize("repeats", [1, 2, 3, 5])
def test_the_fit_is_the_best_subset_sum(repeats):
    pick = random.Random(repeats)
    for _ in range(60):
        lengths = np.array(sorted(pick.sample(range(1, 30), pick.randint(1, 3))))
        counts = np.array([pick.randint(1, 3) for _ in lengths])
        budget = pick.randint(0, int((lengths * counts).sum() * repeats))
        take = mixing._fitted(lengths, counts, budget, repeats)
        sums = {sum(n * m for n, m in zip(c, lengths.tolist(), strict=True)) for c in itertools.product(*[range(n * repeats + 1) for n in counts.tolist()])}
        assert (take <= counts * repeats).all() and (take >= 0).all()
        assert int((take * lengths).sum()) == max(s for s in sums if s <= budget)


@pytest.mark.parametrize("repeats", [1, 2, 5])
def test_plans_reach_the_best_sum_within_their_repeats(spark, repeats):
    pick = random.Random(10 + repeats)
    rows = [(i, " ".join(["w"] * pick.choice([3, 7, 9, 21])), "abc"[i % 3]) for i in range(12)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), repeats=repeats).collect()
    by_source = {}
    for r in plan:
        assert r["taken"] % r["size"] == 0 and r["taken"] <= repeats * r["size"]
        by_source.setdefault((r["source_size"], round(r["target"], 9), rows[r["doc_id"]][2]), []).append((r["size"], r["taken"]))
    for (source_size, target, _), docs in by_source.items():
        # All documents as often as they fit whole, and of more the best sum.
        sums, whole = {0}, min(repeats, int(target // source_size))
        for size, _ in docs:
            sums = {s + k * size for s in sums for k in range(whole, repeats + 1)}
        assert sum(t for _, t in docs) == max(s for s in sums if s <= round(target))


def test_arrivals_of_other_types_are_refused(spark, tmp_path):
    store = sharding.ShardStore(spark, str(tmp_path / "store"))
    store.append(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert store.append(spark.createDataFrame([("b", 2.5)], "text string, score double")) == 2
    for other in ("doc_id string, text string", "doc_id int, text string", "doc_id long, text string, score float"):
        with pytest.raises(ValueError, match="column"):
            store.append(spark.createDataFrame([], other))
    with pytest.raises(ValueError, match="doc_id"):
        list(store.arrivals(spark.createDataFrame([("x", "y", 0)], "doc_id string, text string, k int"), "k"))
    assert store.version() == 2 and [f.name for f in store.schema()] == ["doc_id", "text", "score"]
    assert sorted(map(tuple, store.read().select("doc_id", "text", "score").collect()), key=repr) == [(1, "a", None), (None, "b", 2.5)]
    store.compact()
    assert store.read().count() == 2


def test_a_long_url_takes_seconds(spark):
    long = "https://" + "a." * 2_000_000 + "net/" + "x" * 6_000_000
    began = time.perf_counter()
    rows = [(1, long), (None, "http://q.org/fr/"), (2, ""), (2, ""), (2, None)]
    got = urlfilter.url_verdicts(spark.createDataFrame(rows, "page_id long, url string")).selectExpr("page_id", "length(host)", "length(path)", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 4_000_003, 6_000_001, "net/", "block"), (None, 5, 4, "org/fr/", "allow"), (2, 0, 0, None, "allow"), (2, 0, 0, None, "allow"), (2, 0, 0, None, "allow")], key=repr)
    assert time.perf_counter() - began < 30


def test_few_long_texts_match_like_many():
    pick = random.Random(7)
    text = lambda n: "".join(pick.choice("ab") for _ in range(n))
    globs = [text(pick.randint(1, 6)) + pick.choice(["*", "**", "?*b"]) + text(pick.randint(0, 3)) for _ in range(40)]
    automaton = urlfilter.Automaton([urlfilter.Rule(g.encode(), "block", f"{k:03d}") for k, g in enumerate(globs)])
    texts = [text(pick.randint(0, 60)).encode() for _ in range(500)]
    assert automaton.words > 1
    together = automaton.first_match(texts).tolist()
    assert together == [int(automaton.first_match([t])[0]) for t in texts]
    assert max(together) > 0


def test_dense_finer_keys_fall_into_blocks(spark):
    pick = np.random.default_rng(3)
    fps = {0}
    for _ in range(600):
        bits = pick.choice(20, pick.integers(2, 6), replace=False)
        fps.add(int(sum(1 << int(b) for b in bits)))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    keyed = df.selectExpr("CAST(fp % 2 AS LONG) AS key", "fp")
    blocks = simhash._in_blocks(keyed, 40)
    sizes = [r["count"] for r in blocks.groupBy("key").count().collect()]
    assert max(sizes) < 160
    pairs = blocks.alias("a").join(blocks.alias("b"), "key").where("a.fp < b.fp").selectExpr("a.fp AS a", "b.fp AS b").distinct()
    wanted = keyed.alias("a").join(keyed.alias("b"), "key").where("a.fp < b.fp").count()
    assert pairs.count() == wanted
    links = simhash.connected_components(simhash.fingerprint_links(df, 30)).count()
    brute = {f for f in fps if any(0 < (f ^ g).bit_count() <= 4 for g in fps)}
    assert links == len(brute)


HOLDERS = ["Google Inc.", "the copyright holder", "the University of California, Berkeley", "Foo Bar, Inc. and Co."]


@pytest.mark.parametrize("holder", HOLDERS)
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_clause_three_names_any_holder(spark, holder, mark):
    third = licences._NEITHER.replace("the copyright holder", holder)
    text = "\n".join(mark + line for line in (f"Copyright 2001 x\n\n{licences._BSD}3. " + third.replace(" nor ", "\nnor ")).split("\n"))
    author = f"{licences._BSD}3. {licences._AUTHOR}"
    rows = [(1, text), (2, licences._BSD), (3, author)]
    got = dict(licences.licence_scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "licences").collect())
    assert got == {1: "BSD-3-Clause", 2: "BSD-2-Clause", 3: "BSD-3-Clause"}
