"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from areapulse.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), role.encode(), digest, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = sum(saved[c] for c in children[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (
            ms[0], len(node), members[node[:-1]][0] if node else -99, len(ms), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in ms if len(whole[c]) == len(node)).encode()).hexdigest(),
        )
        for node, ms in members.items()
    )


def made(frame, **options):
    out = prefixes.trie(frame, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-99 if x is None else x for x in r) for r in out.collect())


def conversations(seed, count=160):
    """Few different turns, so that prefixes of several blocks are shared, and some end inside others."""
    random.seed(seed)
    stock = [[(random.choice(["user", "assistant"]), random.choice(["a", "bé", "c" * 9])) for _ in range(20)] for _ in range(4)]
    rows = []
    for c in range(-7, count):
        if c % 17:
            line = list(random.choice(stock))[: random.choice([1, 3, 4, 5, 8, 9, 13, 20])]
            if random.random() < 0.4:
                line[random.randrange(len(line))] = ("user", random.choice("xy"))
            rows += [(c, n, *t) for n, t in enumerate(line)]
    return rows


def test_trie_equals_brute_force(spark):
    rows = conversations(3)
    rows += [(500, None, "user", "first"), (500, 0, None, None), (500, 1, "user", ""), (500, 1, "user", ""), (None, 0, "user", "x"), (501, 3, "", None)]
    rows += [(600, 1, "b", "same"), (600, 1, "a", "z"), (600, 1, "a", "y")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("clash"), "position": F.lit(7), "n1": F.lit(0)})
    want = brute(rows)
    assert made(frame.repartition(5)) == want
    assert made(frame, block=1) == want


def test_one_conversation_may_hold_most_rows(spark):
    random.seed(9)
    rows = [(5, n, "user", str(n)) for n in range(3000)] + [(c, n, "user", str(n)) for c in (6, 7, 8, 9, 11) for n in range(40)]
    random.shuffle(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert made(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ids_of_a_crowded_node_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE", 7)
    rows = [(c, 0, "user", "hello") for c in range(400)]
    assert made(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_turnless_and_empty(spark):
    # conversation 1 loses its own turns to an absent one
    assert zlib.crc32(b"1") % 9 > 1
    rows = [(1, 0, "user", "gone")]
    empty = hashlib.sha256(b"1").hexdigest()
    assert made(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == [(1, 0, -99, 1, 0, 1, 0, empty)]
    assert made(spark.createDataFrame([], SCHEMA)) == []
    assert made(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)) == []
    long = [(10, 0, "user", "é" * 300_000), (11, 0, "user", "é" * 300_000)]
    assert made(spark.createDataFrame(long, SCHEMA)) == brute(long)
