"""Quality rules, language identification, language model, repeated passages: brute force, held-out quality, odd rows."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from areapulse.llm import chaining, language, recurrent, rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def odd_rows(spark):
    return spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t", "en", "s", 3), (None, "no id here", "en", "s", 9),
         (4, "123 !!", None, "s", 6), (5, "same words", "en", "s", 10), (5, "same words", "en", "s", 10), (6, "long " * 50_000, "en", None, 250_000)],
        DOCS,
    )


# quality rules


def plain_statistics(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated),
    )


def test_statistics(documents):
    rng = random.Random(3)
    texts = [None, "", " \n", "a\nb\na\n \n a", "é #ü | x", "x " * 9, *(" ".join(rng.choices("abc", k=rng.randint(7, 60))) for _ in range(200))]
    texts += [r.text for r in documents.collect()]
    for t in texts:
        assert rules.statistics_of(t)[:5] == plain_statistics(t), t


def test_rules_are_learned_and_read_alike(spark):
    rng = np.random.default_rng(1)
    data = {n: rng.random(3000) for n in rules.RATES}
    bad = (data["upper_share"] > 0.8) | ((data["symbols_per_word"] > 0.7) & (data["digit_share"] < 0.3))
    learned = rules.learn_rules(data, bad)
    found = np.zeros(3000, bool)
    for rule in learned:
        found |= rules.covers(rule, data)
    assert (found & ~bad).sum() <= 15 and (found & bad).sum() >= 0.9 * bad.sum()
    assert rules.learn_rules(data, np.zeros(3000, bool)) == [] and rules.learn_rules(data, np.ones(3000, bool)) == []
    names = sorted({c for pair in rules.RATES.values() for c in pair})
    counts = rng.integers(0, 30, (200, len(names)))
    frame = spark.createDataFrame(counts.tolist(), ", ".join(f"{n} long" for n in names))
    rated = frame.select(rules.decision(learned).alias("kept"), *[rules.rate(n).alias(n) for n in rules.RATES]).toPandas()
    held = np.zeros(200, bool)
    for rule in learned:
        held |= rules.covers(rule, {n: rated[n].to_numpy(float) for n in rules.RATES})
    assert (rated["kept"].to_numpy() == ~held).all()


def test_judged_documents(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = {r.doc_id: r for r in rules.judged(documents, labels).collect()}
    assert len(rows) == documents.count()
    known = [(r.quality, rows[r.doc_id]) for r in labels.collect() if not rows[r.doc_id].base_failed]
    assert all(r.kept for q, r in known if q == 1)
    odd = odd_rows(spark).withColumn("kept", rules.F.lit("clash"))
    got = sorted(((r.doc_id or -1, r.n_words, r.base_failed, r.kept) for r in rules.judged(odd, labels.where("doc_id < 0")).collect()), key=repr)
    assert got == sorted([(1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (-1, 3, True, False), (4, 2, True, False),
                          (5, 2, True, False), (5, 2, True, False), (6, 50_000, True, False)], key=repr)
    assert rules.judged(odd.where("doc_id < 0"), labels).count() == 0


# language identification


def plain_pieces(text, reference):
    at = pieces = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        at += size
        pieces += 1
    return pieces


def test_cross_parsing_equals_brute_force():
    rng = random.Random(2)
    references = tuple((n, "".join(rng.choices(a, k=300))) for n, a in (("x", "aabc "), ("y", "abbd.é")))
    dense, sparse = language.CrossParser(references), language.CrossParser(references, dense_cells=0)
    assert dense.steps[0].table is not None and sparse.steps[0].table is None
    plain = lambda points: "".join(map(chr, points))
    texts = [language.points_of("".join(rng.choices("abcdéz .", k=rng.randint(1, 120)))) for _ in range(150)]
    got = dense.pieces(texts)
    for row, (_, reference) in enumerate(references):
        reference = plain(language.points_of(reference))
        assert got[row].tolist() == [plain_pieces(plain(t), reference) for t in texts]
    alone = np.array([dense.pieces([t])[:, 0] for t in texts]).T
    assert np.array_equal(got, alone)
    assert np.array_equal(got, sparse.pieces(texts)) and np.array_equal(got[:, :5], sparse.pieces(texts[:5]))


def test_gaps_are_one_symbol():
    points = language.points_of("  A1 2b!")
    assert points.tolist() == [97, 32, 98]
    alphabet = language.Alphabet(points)
    assert alphabet.codes(points).tolist() == [2, 1, 3]
    assert language.points_of("1 2").tolist() == [] and alphabet.codes(language.points_of("z")).tolist() == [0]


def test_many_scripts_with_little_text_of_one(spark):
    rng = random.Random(4)
    scripts = {name: [chr(start + i) for i in range(40)] for name, start in (
        ("latin", 0x61), ("greek", 0x3B1), ("cyrillic", 0x430), ("armenian", 0x561), ("hiragana", 0x3042), ("han", 0x4E00))}
    scripts["latin"] = [c for c in map(chr, range(0x61, 0x250)) if c.isalpha() and c == c.lower()][:40]
    scripts["han"] = [chr(0x4E00 + 7 * i) for i in range(3000)]
    rows, number = [], 0
    for name, letters in scripts.items():
        for _ in range(8 if name == "greek" else 60):
            text = " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(60 if name != "greek" else 8))
            rows.append((number := number + 1, text, name))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.predictions(docs).join(docs, "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_kept_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "abc def", "x", 2.0, "y")], "doc_id long, text string, lang_pred string, score double, lang string")
    out = language.identify(docs, (("z", "abc def"),), ("doc_id", "lang_pred", "score", "lang"))
    assert out.columns == ["doc_id", "lang", "lang_pred", "score"] and [tuple(r) for r in out.collect()] == [(1, "y", "z", 1.0)]


def test_languages_of_held_out_documents(spark, documents):
    rows = language.predictions(documents).join(documents, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    odd = language.identify(odd_rows(spark).withColumn("score", language.F.lit("clash")), language.learn(documents)).collect()
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {1, 2, 3, 4} and all(0 <= r.score <= 1 for r in odd) and len(odd) == 8
    assert language.predictions(documents.where("doc_id < 0")).count() == 0
    untaught = language.predictions(documents.withColumn("lang", language.F.lit(None).cast("string")))
    assert untaught.where("lang_pred <> 'und' or score <> 0").count() == 0


# language model


def small_model():
    model = recurrent.GatedModel(np.array([50.0, 30, 20, 10, 8, 5, 40]), classes=4, state=4)
    rng = np.random.default_rng(0)
    for name, value in model.weights.items():
        model.weights[name] = value.astype(np.float64) + rng.normal(0, 0.3, value.shape)
    return model


def test_model_is_a_distribution_and_windows_do_not_matter():
    model, rng = small_model(), np.random.default_rng(1)
    for size in (1, 2):
        assert sum(10 ** model.log10_of([np.array(t)])[0] for t in itertools.product(range(7), repeat=size)) == pytest.approx(1, abs=1e-5)
    texts = [rng.integers(0, 7, n) for n in (9, 1, 4, 30)]
    assert np.allclose(model.log10_of(texts), [model.log10_of([t], window=2)[0] for t in texts])
    assert np.allclose(model.log10_of(texts, lanes=2), model.log10_of(texts))


def test_one_step_of_training_follows_the_gradient():
    """The first step of the optimiser moves every weight against the sign of its numeric gradient."""
    model, text = small_model(), np.array([1, 3, 6, 0, 2, 5])
    start = {k: v.copy() for k, v in model.weights.items()}
    model.fit([text], lanes=1, window=len(text), rate=1e-3)
    rng = np.random.default_rng(2)
    assert all(np.array_equal(model.weights[k], v) == (k not in model.LEARNT) for k, v in start.items())
    for name in model.LEARNT:
        value = start[name]
        for at in rng.choice(value.size, min(6, value.size), replace=False):
            def loss(shift, name=name, value=value, at=at):
                moved = small_model()
                moved.weights = {k: v.copy() for k, v in start.items()}
                moved.weights[name].flat[at] = value.flat[at] + shift
                return -moved.log10_of([text])[0]

            slope = (loss(1e-3) - loss(-1e-3)) / 2e-3
            if abs(slope) > 0.02:
                assert np.sign(model.weights[name].flat[at] - value.flat[at]) == -np.sign(slope), name


@pytest.mark.parametrize("head", [100_000, 60])
def test_scores(documents, head):
    rows = recurrent.scored(documents, head_words=head).collect()
    tokens = {r.doc_id: recurrent.tokens_of(r.text) for r in documents.collect()}
    counts = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        mine = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(w in counts for w in mine), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in mine))
    if head > 1000:
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def bigram_score(tokens, train):
    """Mean log10 per token of held-out texts under a plain bigram model, with one count of the smoothed unigram added to each word's followers."""
    ones, twos = Counter(), Counter()
    for t in train:
        ones.update(t)
        twos.update(zip([b""] + t[:-1], t, strict=True))
    before = Counter()
    for (a, _), n in twos.items():
        before[a] += n
    total, size, out, count = sum(ones.values()), len(ones) + 1, 0.0, 0
    for t in tokens:
        for a, b in zip([b""] + t[:-1], t, strict=True):
            one = (ones[b] + 1) / (total + size)
            out += math.log10((twos[a, b] + one) / (before[a] + 1))
            count += 1
    return out / count


def test_held_out_documents_are_told_better_than_by_bigrams(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = recurrent.scored(documents).collect()
    held = {r.doc_id for r in rows if r.held_out}
    tokens = {r.doc_id: recurrent.tokens_of(r.text) for r in documents.collect()}
    bigrams = bigram_score([tokens[i] for i in held], [t for i, t in tokens.items() if i not in held])
    assert sum(r.score for r in rows if r.held_out) / sum(r.n_tokens for r in rows if r.held_out) > bigrams


def test_all_training_documents_are_learnt_from(spark, documents):
    texts = documents.where("doc_id % 3 = 0").select("doc_id", "text")
    rows = [recurrent.tokens_of(r.text) for r in texts.collect()]
    counts = Counter(w for t in rows for w in t)
    words = [w for w, _ in counts.most_common(200)]
    model = recurrent.GatedModel(np.append([counts[w] for w in words], 1.0))
    seen = recurrent.train(texts.repartition(7), model, {w: i for i, w in enumerate(words)}, 200, sum(counts.values()))
    assert seen == sum(map(len, rows))
    assert np.isfinite(model.vector()).all()


def test_words_beyond_the_first_1500_have_outputs_of_their_own(spark, monkeypatch):
    texts = [" ".join(f"w{(31 * i + j) % 2400}" for j in range(80)) for i in range(120)]
    models = []
    monkeypatch.setattr(recurrent, "learn_from", lambda coded, model, *_: models.append((model, coded.count())) or 0.0)
    rows = recurrent.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    model, learnt = models[0]
    words = {w for r in rows if not r.held_out for w in recurrent.tokens_of(texts[r.doc_id])}
    assert len(words) > 2000 and len(model.class_of) == len(words) + 1 and len(model.starts) >= 40
    assert learnt == sum(not r.held_out for r in rows) and all(math.isfinite(r.score) for r in rows)


def test_steps_of_few_texts_are_looked_up_together(monkeypatch):
    model, rng, calls = small_model(), np.random.default_rng(5), []
    texts = [rng.integers(0, 7, n) for n in (3000, 40)]
    expected = [model.log10_of([t], window=1, lanes=4)[0] for t in texts]
    outputs = recurrent.GatedModel.outputs
    monkeypatch.setattr(recurrent.GatedModel, "outputs", lambda self, h, words, *more: calls.append(len(words)) or outputs(self, h, words, *more))
    assert np.allclose(model.log10_of(texts), expected)
    assert calls == [3040]


def test_averages_of_many_tasks(spark):
    vectors = np.random.default_rng(1).normal(0, 1, (70, 5))
    rows = spark.createDataFrame([(v.tobytes(), float(i)) for i, v in enumerate(vectors)], "weights binary, seen double").repartition(70)
    total, seen = recurrent.average(rows, 70)
    assert np.allclose(total, vectors.sum(axis=0)) and seen == sum(range(70))


def test_scores_of_odd_rows(spark):
    odd = odd_rows(spark).withColumn("token", recurrent.F.lit("clash")).withColumn("c", recurrent.F.lit(1))
    rows = recurrent.scored(odd).collect()
    assert len(rows) == 8 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows} == {1: 1, 2: 1, 3: 1, None: 4, 4: 3, 5: 3, 6: 50_001}
    assert recurrent.scored(odd.where("doc_id < 0")).count() == 0


# repeated passages


def random_words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def planted(spark):
    rng = random.Random(5)
    exact, fuzzy, rows = random_words(rng, 55), random_words(rng, 90), []
    for i in range(60):
        middle = []
        if i in (3, 17, 40, 41, 42):
            middle = list(exact)
        if i in (5, 9, 50):
            middle = list(fuzzy)
            for at in {9: range(4, 90, 15), 50: range(10, 90, 17)}.get(i, ()):
                middle[at] = f"new{at}"
        start = random_words(rng, rng.randint(30, 200))
        rows.append((i, " ".join(start + middle + random_words(rng, rng.randint(30, 200))), "en", "s", 1, len(start), len(middle)))
    rows += [(60, "junk " * 300, "en", "s", 1, 0, 0), (61, "junk " * 200, "en", "s", 1, 0, 0), (62, "up down " * 90, "en", "s", 1, 0, 0), (63, "up down " * 70, "en", "s", 1, 0, 0)]
    return spark.createDataFrame(rows, f"{DOCS}, at int, size int").repartition(3)


def test_planted_passages_and_nothing_else(spark):
    docs = planted(spark)
    where = {r.doc_id: (r.at, r.at + r.size) for r in docs.collect()}
    found = chaining.passages(docs).collect()
    exact = {(r.doc_id, r.ref_doc_id): r for r in found if r.doc_id in (17, 40, 41, 42)}
    assert {i for i, _ in exact} == {17, 40, 41, 42} and all(j < i and j in (3, 17, 40, 41) for i, j in exact)
    for (i, j), r in exact.items():
        assert (r.start_word, r.end_word, r.ref_start_word, r.ref_end_word, r.similarity) == (*where[i], *where[j], 1.0)
    for i in (9, 50):
        r = next(r for r in found if (r.doc_id, r.ref_doc_id) == (i, 5))
        assert r.start_word <= where[i][0] + 5 and r.end_word >= where[i][1] - 17 and 0.9 < r.similarity < 1
    assert {r.doc_id for r in found} == {17, 40, 41, 42, 9, 50, 61, 63}
    assert [(r.start_word, r.end_word) for r in found if r.doc_id in (61, 63)] in ([(0, 200), (0, 140)], [(0, 140), (0, 200)])


def test_every_exact_passage_of_fifty_words_has_a_seed():
    rng = random.Random(6)
    for _ in range(50):
        passage = random_words(rng, 50, 40)
        places = []
        for _ in range(2):
            start = random_words(rng, rng.randint(0, 20), 40)
            h, p = chaining.seeds_of(chaining.word_hashes(" ".join(start + passage + random_words(rng, 20, 40))))
            places.append({(int(x), int(q) - len(start)) for x, q in zip(h, p, strict=True)})
        assert len({s for s in places[0] & places[1] if 0 <= s[1] <= 45}) >= 2


def test_chain_is_the_best():
    rng = random.Random(8)
    for _ in range(60):
        pd, pe = [rng.randrange(30) for _ in range(7)], [rng.randrange(30) for _ in range(7)]

        def worth(order):
            steps = list(itertools.pairwise(order))
            if any(pd[a] >= pd[b] or pe[a] >= pe[b] for a, b in steps):
                return -1e9
            return 5 * len(order) - sum(0.1 * (pd[b] - pd[a] + pe[b] - pe[a]) for a, b in steps)

        best = max(worth(o) for n in range(1, 8) for o in itertools.permutations(range(7), n))
        assert worth(chaining.chain(pd, pe, 5)) == pytest.approx(best)


def test_edit_distance():
    rng = random.Random(3)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        assert chaining.edit_distance(np.array(a, int), np.array(b, int)) == plain(a, b)


def test_blocks_and_batches_of_seeds_link_everything(spark, monkeypatch):
    docs = planted(spark)
    whole = {(r.doc_id, r.start_word, r.end_word) for r in chaining.passages(docs).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {(r.doc_id, r.start_word, r.end_word) for r in chaining.passages(docs).collect()} == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_transposed_and_repeated_passages(spark):
    rng = random.Random(11)
    p, q, r, s = (random_words(rng, n, 10**6) for n in (80, 60, 80, 70))
    texts = [q + p + r, p + q + r, p + s + r, p + s + p + r]
    for e, d in [(0, 1), (2, 3)]:
        rows = spark.createDataFrame([(i, " ".join(texts[i])) for i in (e, d)], "doc_id long, text string")
        covered = {w for f in chaining.passages(rows).collect() for w in range(f.start_word, f.end_word)}
        assert covered == set(range(len(texts[d])))


@pytest.mark.parametrize(("size", "similarity", "least"), [(50, 0.84, 0.9), (60, 0.8, 0.8), (50, 0.9, 0.97)])
def test_fuzzy_passages_of_few_words_are_found(size, similarity, least):
    rng, found = random.Random(13), 0
    for _ in range(100):
        a, b = ([rng.randrange(10**9) for _ in range(40 + size + 40)] for _ in range(2))
        b[40 : 40 + size] = a[40 : 40 + size]
        for at in rng.sample(range(40, 40 + size), round(size * (1 - similarity))):
            b[at] = rng.randrange(10**9)
        a, b = np.array(a), np.array(b)
        (ha, pa_), (hb, pb) = (chaining.seeds_of(x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for x in (a, b))
        of_b = dict(zip(hb.tolist(), pb.tolist(), strict=True))
        links = np.array([(p, of_b[h]) for h, p in zip(ha.tolist(), pa_.tolist(), strict=True) if h in of_b], int).reshape(-1, 2)
        whole = [s for s in chaining.chained_stretches(a, b, links) if min(s[1] - s[0], s[3] - s[2]) >= 50]
        found += any(s[4] <= 0.2 * max(s[1] - s[0], s[3] - s[2]) + 1e-9 for s in whole)
    assert found >= least * 100


def test_passages_of_common_lines(spark):
    rng = random.Random(12)
    fresh = lambda n: random_words(rng, n, 10**6)
    line, other = fresh(30), fresh(30)
    rows = [fresh(60) + line + fresh(60), fresh(60) + other + fresh(60), fresh(60) + line[22:] + other[:8] + fresh(60)]
    rows += [fresh(60) + line + other + fresh(60)]
    rows += [fresh(60) + (line, other, line[22:] + other[:8])[n % 3] + fresh(60) for n in range(5)]
    rows += [fresh(60) + line + other + fresh(60)]
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string").coalesce(1)
    found = [(r.doc_id, r.start_word, r.end_word, r.ref_doc_id, r.ref_start_word) for r in chaining.passages(docs).collect()]
    assert found == [(9, 60, 120, 3, 60)]


def test_cleaned_documents(spark):
    docs = planted(spark).select("doc_id", "text", "lang", "source", "n_chars", chaining.F.lit(1).alias("d"))
    clean = {r.doc_id: r for r in chaining.cleaned(docs, chaining.passages(docs)).collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    assert set(before) - set(clean) == {61, 63}
    assert clean[1].text == before[1] and clean[3].text == before[3]
    assert len(clean[17].text.split()) == len(before[17].split()) - 55 and clean[17].n_chars == len(clean[17].text)
    assert chaining.without_passages(" a b\n c d ", [(1, 2), (1, 3)]) == " a d " and chaining.without_passages("a b", [(0, 9)]) == ""
    odd = odd_rows(spark)
    assert chaining.cleaned(odd, chaining.passages(odd)).count() == 8
    assert chaining.passages(odd.where("doc_id < 0")).count() == 0
