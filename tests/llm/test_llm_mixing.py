"""Budgets and epochs of the mixture, and the pipeline."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from areapulse.llm import language, mixing

FOLDER = "/root/testdata/sf0.001"
F = mixing.F


def test_shares_respect_capacities():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 6)
        weights, capacities, budget = [rng.choice([0.0, 1, 2, 5.5]) for _ in range(n)], [rng.choice([0, 3, 40, 1000]) for _ in range(n)], rng.randint(0, 1500)
        given = mixing.share_out(budget, weights, capacities)
        able = sum(c for c, w in zip(capacities, weights, strict=True) if w)
        assert all(0 <= g <= c for g, c in zip(given, capacities, strict=True))
        assert sum(given) == min(budget, able)
        free = [(g, w) for g, w, c in zip(given, weights, capacities, strict=True) if w and g < c]
        for g, w in free:
            for g2, w2 in free:
                assert abs(g / w - g2 / w2) <= 1 / w + 1 / w2 + 1e-6


def test_shortage_goes_to_siblings_before_ancestors():
    leaves = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}
    given = mixing.budgets(leaves, {}, 400, 1)
    assert given == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}
    given = mixing.budgets({("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 1000}, {}, 400, 1)
    assert given == {("a", "x"): 10, ("a", "y"): 20, ("b", "z"): 370}
    assert sum(mixing.budgets(leaves, {}, 10**9, 2).values()) == 2 * sum(leaves.values())


def brute(rows, keys, budget, epochs):
    tokens = Counter()
    for r in rows:
        tokens[r.domain, r.lang, r.source] += r.n_tokens
    given, out = mixing.budgets(tokens, mixing.WEIGHTS, budget, epochs), Counter()
    for path, total in tokens.items():
        if total:
            full, rest = divmod(given[path], total)
            mine = [r for r in rows if (r.domain, r.lang, r.source) == path]
            groups = defaultdict(list)
            for r in mine:
                out.update((r.doc_id, e) for e in range(full))
                groups[keys[r.doc_id, full]].append(r)
            for key in sorted(groups):
                rest -= sum(r.n_tokens for r in groups[key])
                if rest < 0:
                    break
                out.update((r.doc_id, full) for r in groups[key])
    return out


@pytest.mark.parametrize(("share", "epochs", "bucket"), [(1.0, 4, 7), (0.3, 4, 20_000), (2.5, 3, 20), (9.0, 2, 20)])
def test_mixture_equals_brute_force(spark, share, epochs, bucket):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, "a b c", None, None, 1), (900, None, "en", "s1", 1), (901, "x y", "en", "nosource", 1), (901, "x y", "en", "nosource", 1)], documents.schema)
    sized = mixing.sized_leaves(documents.union(odd))
    rows = sized.collect()
    by_id = defaultdict(int)
    for r in rows:
        by_id[r.domain] += r.n_tokens
    budget = int(share * sum(r.n_tokens for r in rows))
    keyed = sized.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(epochs + 1))).alias("e")).withColumn("k", mixing._key(F.col("e"), mixing.SEED))
    keys = {(r.doc_id, r.e): r.k for r in keyed.collect()}
    plan = mixing.plan(sized, budget=budget, max_epochs=epochs, bucket_rows=bucket)
    got = mixing.mixed(sized.withColumn("rank", F.lit(1)), plan).collect()
    assert Counter((r.doc_id, r.epoch) for r in got) == brute(rows, keys, budget, epochs)


def test_words_and_domains(spark):
    texts = [None, "", " ", "a", " a  b\tc\n", "é x", "x y " * 1000]
    frame = spark.createDataFrame([(t, s) for t, s in zip(texts, ["src0", "src1", None, "", "x", "src12", "7"], strict=True)], "text string, source string")
    rows = frame.select("text", mixing.word_count().alias("n"), mixing.source_domain().alias("d")).collect()
    assert [r.n for r in rows] == [len((t or "").split()) for t in texts]
    assert [r.d for r in rows] == ["even", "odd", "other", "other", "other", "even", "odd"]


def test_empty_mixture(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    sized = mixing.sized_leaves(documents)
    assert mixing.mixed(sized, mixing.plan(sized)).count() == 0


def test_columns_of_any_name_go_along(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sized = mixing.sized_leaves(documents)
    names = {"epoch": F.lit("old"), "_domain": F.lit("mine"), "_epochs": F.lit(7), "_cutoff": F.lit(8), "_row": F.col("doc_id")}
    got = mixing.mixed(sized.withColumns(names), mixing.plan(sized))
    assert got.columns == [*sized.columns, "_domain", "_epochs", "_cutoff", "_row", "epoch"]
    want = mixing.mixed(sized, mixing.plan(sized))
    assert sorted(tuple(r) for r in got.select("doc_id", "epoch").collect()) == sorted(tuple(r) for r in want.select("doc_id", "epoch").collect())
    assert got.where("_domain <> 'mine' or _epochs <> 7 or _cutoff <> 8 or _row <> doc_id").count() == 0


def test_rows_of_one_id_are_kept_by_their_texts(spark):
    words = lambda n: " ".join(f"w{n}x{i}" for i in range(40))
    rows = [(1, words(1)), (2, words(1)), (2, words(2)), (3, words(2)), (3, words(3)), (3, words(3)), (None, words(1)), (None, words(4)), (None, words(4)), (None, words(5))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.simhash_dedup(spark, docs, FOLDER).collect()
    want = [(1, words(1)), (2, words(2)), (3, words(3)), (None, words(4)), (None, words(5))]
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)


def test_an_empty_table_passes_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(spark, stage(spark, docs, FOLDER), name)
        assert docs.count() == 0


def test_stages_take_effect(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(900, None, "en", "s1", 1), (901, "123", "en", "s1", 3), (None, "no id but words", "en", "s1", 9), (None, "no id but words", "en", "s1", 9), (902, "two rows of one id", "en", "s1", 9), (902, "two rows of one id", "en", "s1", 9)],
        documents.schema,
    )
    docs = documents.union(odd)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(spark, stage(spark, docs, FOLDER), name)
        kept.append(docs)
    named, first, clean, mixture, pieces = kept
    assert all(k.columns == documents.columns for k in kept[:4])
    assert named.where("doc_id in (900, 901)").count() == 0 and named.count() == documents.where("text rlike '[a-zA-Z]'").count() + 4
    assert named.where(F.col("lang") == language.UNKNOWN).count() == 0
    assert first.count() == first.select("doc_id").distinct().count() and first.where("doc_id = 902 or doc_id is null").count() == 2
    assert first.select("text").distinct().count() == first.count()
    assert clean.count() <= first.count() and clean.agg(F.sum("n_chars")).first()[0] < first.agg(F.sum("n_chars")).first()[0]
    assert mixture.select("doc_id").subtract(clean.select("doc_id")).count() == 0
    assert pieces.where("piece = 0").count() == mixture.count()
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
