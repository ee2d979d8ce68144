"""Prefix trie of conversations by fixed-length blocks of turns.

A conversation is cut into blocks of ``BLOCK`` turns. Conversations are grouped by
the digests of their successive blocks first: equal blocks after equal prefixes are
one group, counted before anything else is done with them. Only where a prefix goes
on in more than one way are the turns inside its blocks told apart; elsewhere each
turn of a block has the members of the block.

A prefix is known by 128 bits, combined by exclusive or from hashes of its numbered
blocks, so that those of a very long conversation are running values over ranges of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from areapulse.functions.ordering import in_ranges, numbered, running
from areapulse.llm.common import give_back
from areapulse.session import stage

BLOCK = 4
#: Every conversation takes the first turns of the one whose id is its own without the remainder by FAMILY, fewer than MOST_SHARED.
FAMILY = 5
MOST_SHARED = 9
#: Member ids are joined in pieces of so many before a node's pieces are hashed in order.
PIECE = 4096
NODE = ["depth", "n1", "n2"]
PARENT = ["depth", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` from 0 on, ``digest`` of role and text, and the text's ``bytes``; rows without a conversation are left out.

    Turns are in order of their number, NULL first; equal numbers by role, then by
    digest. NULL roles and texts are empty.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), role.alias("_role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")
    )
    order = [F.col("_turn").asc_nulls_first(), F.col("_role").asc(), F.col("digest").asc()]
    return numbered(rows, ["conv_id"], order).select("conv_id", "position", "digest", "bytes")


def rebuilt(rows: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations as turns, and every conversation with its ``size``, which may be 0.

    Conversation c takes the first h turns of conversation c - c % ``family``, all
    if it has fewer and none if it is absent, where h is the CRC-32 of c in
    decimal modulo ``most_shared``; its own turns from the h-th on follow.
    """
    spark = rows.sparkSession
    sizes = stage(spark, rows.groupBy("conv_id").agg(F.count("*").alias("_own")), "conversation_sizes")
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).alias("_shared")
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("_base")
    bases = sizes.select(F.col("conv_id").alias("_base"), F.col("_own").alias("_base_size"))
    plan = sizes.select("conv_id", "_own", shared, base).join(bases, "_base", "left").select(
        "conv_id", "_shared", "_base", F.least("_shared", F.coalesce("_base_size", F.lit(0))).alias("_taken"),
        F.greatest(F.col("_own") - F.col("_shared"), F.lit(0)).alias("_kept"),
    )
    plan = stage(spark, plan, "conversation_plan")
    heads = rows.where((F.col("conv_id") % family == 0) & (F.col("position") < most_shared)).withColumnRenamed("conv_id", "_base")
    taken = plan.where("_taken > 0").join(heads, "_base").where(F.col("position") < F.col("_taken")).select("conv_id", "position", "digest", "bytes")
    own = rows.join(plan, "conv_id").where(F.col("position") >= F.col("_shared")).select(
        "conv_id", (F.col("position") - F.col("_shared") + F.col("_taken")).alias("position"), "digest", "bytes"
    )
    return taken.union(own), plan.select("conv_id", (F.col("_taken") + F.col("_kept")).alias("size"))


def hash_pair(*values: Column) -> list[Column]:
    return [F.xxhash64(F.lit(n), *values) for n in (1, 2)]


def blocks_of(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A stored row per conversation and block: its ``turns``, hashes ``c1``, ``c2`` of them, and the prefix before (``b1``, ``b2``) and with it (``a1``, ``a2``)."""
    turn = F.struct("position", "digest", "bytes")
    number = F.floor(F.col("position") / block).cast("long").alias("number")
    cut = rows.groupBy("conv_id", number).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    bare = F.transform("_turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes")))
    cut = cut.select("conv_id", "number", bare.alias("turns"))
    c1, c2 = hash_pair(F.col("number"), F.col("turns.digest"))
    order = [F.col("number").asc()]
    ranged = in_ranges(cut.withColumns({"c1": c1, "c2": c2}), ["conv_id"], order, "turn_blocks")
    chained = running(ranged, ["conv_id"], order, {"a1": ("bit_xor", "c1"), "a2": ("bit_xor", "c2")})
    before = {f"b{n}": F.col(f"a{n}").bitwiseXOR(F.col(f"c{n}")) for n in (1, 2)}
    return stage(rows.sparkSession, chained.withColumns(before), "prefix_blocks")


def inner(block: int) -> Column:
    """The nodes of a block, one a turn: depth, own and parent's hashes, bytes. The last of a full block is the prefix with it."""
    whole = F.size("turns") == block

    def key(upto: Column, n: int) -> Column:
        part = F.xxhash64(F.lit(n), "number", f"b{n}", upto, F.slice("turns.digest", F.lit(1), upto))
        return F.when(upto == 0, F.col(f"b{n}")).when(whole & (upto == block), F.col(f"a{n}")).otherwise(part)

    def node(turn: Column, at: Column) -> Column:
        return F.struct(
            (F.col("number") * block + at + 1).alias("depth"), key(at + 1, 1).alias("n1"), key(at + 1, 2).alias("n2"),
            key(at, 1).alias("p1"), key(at, 2).alias("p2"), turn["bytes"].alias("bytes"),
        )

    return F.transform("turns", node)


def nodes_of(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every node but the root, with ``n_convs`` members and the smallest as ``conv_id``."""
    group = ["number", "b1", "b2"]
    alike = blocks.groupBy(*group, "c1", "c2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("turns").alias("turns"), F.any_value("a1").alias("a1"), F.any_value("a2").alias("a2")
    )
    alike = stage(blocks.sparkSession, alike, "equal_blocks")
    ways = alike.groupBy(*group).agg((F.count("*") > 1).alias("_parted"))
    # a prefix that goes on in very many ways is a skewed key, whose rows the join may deal out
    every = alike.join(ways, group).select("_parted", "n_convs", "conv_id", F.inline(inner(block)))
    together = every.where("not _parted").drop("_parted")
    apart = every.where("_parted").groupBy(*NODE).agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.any_value(c).alias(c) for c in ("p1", "p2", "bytes")]
    )
    return together.unionByName(apart)


def end_digests(ends: DataFrame) -> DataFrame:
    """Node and ``ends_sha256`` of the ids in it, in ascending order and joined by commas.

    Ids are joined in parallel, in ranges of (node, id); the task of a node hashes
    whole pieces and keeps none.
    """
    spark = ends.sparkSession
    keys = [*NODE, "conv_id"]
    pieces_schema = "depth long, n1 long, n2 long, conv_id long, piece binary"

    def join_ids(batches) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(5)]
        held, ids = None, []

        def flush() -> None:
            for column, value in zip(out, [*held, ids[0], ",".join(map(str, ids)).encode()], strict=True):
                column.append(value)

        def take() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], names=[*NODE, "conv_id", "piece"]
            )
            for column in out:
                column.clear()
            return batch

        for batch in batches:
            for *node, conv_id in zip(*(batch.column(c).to_pylist() for c in keys), strict=True):
                if node != held or len(ids) == PIECE:
                    if ids:
                        flush()
                    held, ids = node, []
                ids.append(conv_id)
            yield take()
        if ids:
            flush()
        yield take()

    def digest(batches) -> Iterator[pa.RecordBatch]:
        held, state = None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*NODE, "ends_sha256"]
            )

        for batch in batches:
            done = []
            for *node, piece in zip(*(batch.column(c).to_pylist() for c in [*NODE, "piece"]), strict=True):
                if node == held:
                    state.update(b",")
                else:
                    if held is not None:
                        done.append((*held, state.hexdigest()))
                    held, state = node, hashlib.sha256()
                state.update(piece)
            yield batch_of(done)
        if held is not None:
            yield batch_of([(*held, state.hexdigest())])
        give_back()

    ranged = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = stage(spark, ranged.mapInArrow(join_ids, pieces_schema), "end_pieces")
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return dealt.mapInArrow(digest, "depth long, n1 long, n2 long, ends_sha256 string")


def trie(conversations: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node, with what its subtree saves.

    ``conv_id`` is the smallest member. A conversation owns the nodes whose
    smallest member it is; they are the lower end of its path, so the sums of
    subtrees need one row for each turn of owning conversations. ``saved_tokens``
    counts bytes of the last turn's text, times members but one. Rows that repeat
    a turn are turns of their own. Without conversations there are no rows, not
    even a root. Other columns are not read; texts only pass a hash.
    """
    spark = conversations.sparkSession
    rows, sizes = rebuilt(stage(spark, turns(conversations), "turns"), family, most_shared)
    sizes = stage(spark, sizes, "rebuilt_sizes")
    blocks = blocks_of(rows, block)
    top = sizes.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = top.select(*[zero.alias(c) for c in NODE], "n_convs", "conv_id", *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], zero.alias("bytes"))
    nodes = stage(spark, nodes_of(blocks, block).unionByName(root), "prefix_nodes")

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    owners = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("first"), F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    )
    # what an owner's nodes save from each one on downwards
    ranged = in_ranges(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")), ["conv_id"], [F.col("depth").desc()], "chains")
    own = running(ranged, ["conv_id"], [F.col("depth").desc()], {"saved": ("sum", "own")})

    # only the lowest node of an owner can be without children
    last = nodes.join(children, NODE, "left").where("n_children is null").select(*NODE, "conv_id")
    leaves = last.groupBy("conv_id").agg(F.count("*").alias("leaves"))
    above = owners.where("first > 0").join(leaves, "conv_id", "left").withColumn("leaves", F.coalesce("leaves", zero))
    path = blocks.join(above, "conv_id").where(F.col("number") * block < F.col("first") - 1)
    passed = path.select("first", "saved", "leaves", F.inline(inner(block))).where(F.col("depth") < F.col("first")).select(*NODE, "saved", "leaves")
    below = passed.union(above.select(*[zero.alias(c) for c in NODE], "saved", "leaves")).groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))

    size = F.col("size")
    whole = blocks.withColumn("_last", F.element_at(inner(block), -1)).select("conv_id", "_last.*").join(sizes.withColumnRenamed("size", "depth"), ["conv_id", "depth"])
    ends = whole.select(*NODE, "conv_id").union(sizes.where(size == 0).select(*[zero.alias(c) for c in NODE], "conv_id"))

    def facts(frame: DataFrame, **columns: str) -> DataFrame:
        names = ("conv_id", "p1", "p2", "n_convs", "saved_tokens", "n_children", "n_leaves", "ends_sha256")
        kinds = {"ends_sha256": "string"}
        return frame.select(*NODE, *[(F.expr(columns[n]) if n in columns else F.lit(None)).cast(kinds.get(n, "long")).alias(n) for n in names])

    parts = [
        facts(own, conv_id="conv_id", p1="p1", p2="p2", n_convs="n_convs", saved_tokens="saved"),
        facts(children, n_children="n_children"),
        facts(nodes.join(leaves, "conv_id"), n_leaves="leaves"),
        facts(below, saved_tokens="saved", n_leaves="leaves"),
        facts(end_digests(stage(spark, ends, "conversation_ends")), ends_sha256="ends_sha256"),
    ]
    known = reduce(DataFrame.union, parts).groupBy(*NODE).agg(
        *[F.max(c).alias(c) for c in ("conv_id", "p1", "p2", "n_convs", "n_children", "ends_sha256")], *[F.sum(c).alias(c) for c in ("saved_tokens", "n_leaves")]
    )
    known = stage(spark, known, "trie_nodes")
    # inside a chain the parent's smallest member is the node's own; only the first node of a chain hangs below another's
    tops = known.join(owners.select("conv_id", F.col("first").alias("depth")), ["conv_id", "depth"]).where("depth > 0").select(*NODE, "p1", "p2")
    parents = known.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    hung = tops.join(parents, PARENT).select(*NODE, "parent_conv_id")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return known.join(hung, NODE, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
