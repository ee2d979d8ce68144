"""Top-k search, SimHash and components against brute force."""

import math
import random

import numpy as np
import xxhash

from areapulse.llm import simhash, topk
from areapulse.llm.components import components


def brute_top(rows, k, divisor):
    out = {}
    kept = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for i, q in kept:
        if i % divisor == 0:
            scores = {(j, sum(a * b for a, b in zip(q, c, strict=False))) for j, c in kept if j != i}
            out[i] = [(n, j, s) for n, (j, s) in enumerate(sorted(scores, key=lambda x: (-x[1], x[0]))[:k], 1)]
    return out


def as_top(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 12).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]
    rows += [(2000, None), (2001, [float("nan")] * 12), (2002, [None] * 12), (2003, [float("inf")] + [0.0] * 11), (None, [0.1] * 12), (2050, [0.5, 0.5]), (2100, []), rows[50]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("q", topk.F.lit("clash"))
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    for blocks in ((64, 3), (4096, 1024)):
        got = as_top(topk.top_k(frame, candidate_block=blocks[0], query_block=blocks[1]))
        want = brute_top(rows, 5, 50)
        assert {k: v for k, v in want.items() if v} == got


def test_large_components_take_part(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.2, 3).tolist()) for i in range(120)] + [(130, [2.0**21, 1.0, 0.0]), (150, [-(2.0**21), 2.0**20, 0.5]), (151, [3.0e6, -3.0e6, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    ints = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    for blocks in ((16, 2), (4096, 1024)):
        got = as_top(topk.top_k(frame, candidate_block=blocks[0], query_block=blocks[1]))
        for i in (0, 50, 100, 150):
            scores = sorted(((-sum(a * b for a, b in zip(ints[i], v, strict=True)), j) for j, v in ints.items() if j != i))[:5]
            assert got[i] == [(n, j, -s) for n, (s, j) in enumerate(scores, 1)]


def test_top_k_of_few_or_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [-1.0]), (2, [0.5])], "vec_id long, embedding array<float>")
    assert as_top(topk.top_k(frame)) == {0: [(1, 2, 32768), (2, 1, -65536)]}
    assert topk.top_k(frame.where("vec_id < 0")).count() == 0
    assert topk.top_k(frame.where("vec_id = 0")).count() == 0


def test_lists_stop_early_and_keep_the_best():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-40, 40, (3000, 6))
    vectors[17] = [90, -90, 90, 90, -90, 90]
    lists = topk.SortedLists(vectors)
    query = np.array([50, -50, 50, 50, -50, 50])
    found = lists.survivors(query, 1, np.empty(0, int))
    assert 17 in found and len(found) <= topk.RESOLVED


def test_lists_are_read_for_many_queries_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.integers(-40, 40, (2000, 8)), rng.integers(-2, 3, (2000, 8))])
    queries, ids, own = rng.integers(-300, 300, (90, 8)), rng.permutation(9000)[:4000], [5, *rng.integers(0, 9000, 89).tolist()]
    lists, calls = topk.SortedLists(vectors), []
    upper = topk.SortedLists.upper
    monkeypatch.setattr(topk.SortedLists, "upper", lambda self, queries, depth: calls.append(len(queries)) or upper(self, queries, depth))
    for floors in (np.full(90, -np.inf), np.full(90, 1000.0)):
        calls.clear()
        got = lists.top(queries, 5, ids, own, floors)
        for query, mine, floor, found in zip(queries, own, floors, got, strict=True):
            scores = sorted(((-s, i) for i, s in zip(ids.tolist(), (vectors @ query).tolist(), strict=True) if i != mine))[:5]
            # what is below the floor may be left out
            assert [x for x in found if x[1] >= floor] == [(i, -s) for s, i in scores if -s >= floor]
        assert 0 < len(calls) <= 6 and calls[0] == 90


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    rng = random.Random(1)
    texts = ["", None, " \n\t", "one", "Two words", "ÄB é", "x\x0by\x0cz w", *(" ".join(rng.choices("abcdefgh", k=n)) for n in (3, 4, 255, 256, 700))]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    frame = spark.createDataFrame([("aé b c",), ("q w e",)], "t string")
    native = [r[0] & (2**64 - 1) for r in frame.select(simhash.F.xxhash64("t")).collect()]
    assert native == [simhash.fingerprint(t) for t in ("aé b c", "q w e")]


def near_values(rng, n):
    base = [rng.getrandbits(64) for _ in range(n)]
    out = list(base)
    for v in base[: n // 2]:
        for _ in range(3):
            v ^= 1 << rng.randrange(64)
            out.append(v)
    return sorted(set(out))


def test_index_finds_all_within_two_bits():
    rng = random.Random(7)
    values = np.array(near_values(rng, 300), np.uint64)
    ordered = values[np.argsort(simhash.gray_rank(values))]
    got = set()
    for q, n in simhash.GrayIndex(ordered).search(ordered):
        got |= set(zip(q.tolist(), n.tolist(), strict=True))
    assert got == {(i, j) for i in range(len(ordered)) for j in np.flatnonzero(np.bitwise_count(ordered[i] ^ ordered) <= 2).tolist()}
    gray = [i ^ (i >> 1) for i in range(64)]
    assert simhash.gray_rank(np.array(gray, np.uint64)).tolist() == list(range(64))


def union(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def test_links_over_many_groups(spark):
    rng = random.Random(9)
    values = [v - (1 << 64) if v >> 63 else v for v in near_values(rng, 150)]
    stored = simhash.stage(spark, spark.createDataFrame([(v,) for v in values], "fp long").repartition(3), "test_fps")
    roots = {r.node: r.root for r in components(simhash.links(spark, stored, group_rows=16)).collect()}
    bits = np.array(values, np.int64).view(np.uint64)
    pairs = [(values[i], values[j]) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(bits[i] ^ bits) <= 2).tolist() if i != j]
    assert roots == union(pairs)


def test_components(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000 + i, 999) for i in range(50)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)]
    links = [*chain, *star, *loose, (5, 5), chain[0]]
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {r.node: r.root for r in components(frame).collect()} == union([p for p in links if p[0] != p[1]])
    assert components(frame.where("a < 0")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    rows = [(3, "a b c d"), (1, "A b\nc d"), (None, "a b c d"), (None, "only here x"), (7, None), (8, ""), (9, "q"), (3, "a b c d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", simhash.F.lit(1))
    got = sorted(((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(frame).collect()), key=repr)
    assert got == sorted([(3, 1), (1, 1), (-1, 1), (-1, None), (7, 7), (8, 7), (9, 9), (3, 1)], key=repr)
    assert simhash.near_duplicates(frame.where("doc_id < 0")).count() == 0
