"""SimHash near-duplicates through a Gray-ordered hierarchical index.

Fingerprints are sorted by Gray rank, in which neighbours differ in few bits, and
cut into groups. Every group keeps the bits that all its members share as a
masked pattern; a group of groups keeps what its groups share. A search walks
down from the top and drops a node as soon as the differences to its pattern
exceed the limit, since a node's pattern contains those above it.

The top levels, over groups of groups, are small: at most ``MAX_GROUPS`` patterns
whatever the input, as groups grow with it. They travel to every task and decide
which fingerprints must be compared with which group; the groups meet in a join,
and each pair is searched in numpy through its own lower levels. A task hands on
only a spanning forest of the links it found, so thousands of near copies do not
become millions of links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from areapulse.llm.common import Emitter, lower_ascii, map_rows, rows_of
from areapulse.llm.components import components
from areapulse.session import stage

SHINGLE_WORDS = 3
MAX_DIFFERENCES = 2
SEED = 42
GROUP_ROWS = 1024
MAX_GROUPS = 65_536
FAN_OUT = 16
BITS = 64
_ROWS_AT_ONCE = 1 << 17


def fingerprint(text: str | None, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned SimHash of a whole text; 0 without words. Bit i is set if it is in over half of the shingles' hashes."""
    words = lower_ascii(text or "").split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(0, len(words) - width)
    starts, ends = starts[: last + 1].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _ROWS_AT_ONCE):
        part = zip(starts[at : at + _ROWS_AT_ONCE], ends[at : at + _ROWS_AT_ONCE], strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in part], dtype="<u8")
        counts += _bit_counts(hashes)
    bits = counts * 2 > len(starts)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the numbers have each bit: 8 numbers' bits are added side by side in 64-bit words."""
    counts = np.zeros(BITS, np.int64)
    lanes = np.uint64(0x0101010101010101)
    for shift in range(8):
        plane = (hashes >> np.uint64(shift)) & lanes
        sums = np.add.reduceat(plane, np.arange(0, len(plane), 255))
        counts[shift::8] += sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and signed 64-bit ``fp`` of every row, and its ``keep`` columns; repeated rows and NULL ids are kept, other columns not read."""

    def each(doc_id, text, *kept):
        value = fingerprint(text, width, seed)
        yield doc_id, value - (1 << 64) if value >> 63 else value, *kept

    schema = ", ".join(["doc_id long", "fp long", *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)])
    return map_rows(docs, ["doc_id", "text", *keep], schema, each)


def gray_rank(bits: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in the reflected Gray sequence."""
    rank = bits.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


def shared(patterns: np.ndarray, masks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pattern and mask that all nodes of each run have in common."""
    all_masks = np.bitwise_and.reduceat(masks, starts)
    ones = np.bitwise_and.reduceat(patterns, starts)
    zeros = np.bitwise_and.reduceat(~patterns, starts)
    mask = all_masks & (ones | zeros)
    return ones & mask, mask


class GrayIndex:
    """Levels of masked patterns over Gray-ordered leaves; ``search`` yields leaf matches within a number of differences."""

    def __init__(self, patterns: np.ndarray, masks: np.ndarray | None = None, fan_out: int = FAN_OUT):
        masks = np.full(len(patterns), ~np.uint64(0)) if masks is None else masks
        self.fan_out, self.levels = fan_out, [(patterns, masks)]
        while len(patterns) > fan_out:
            patterns, masks = shared(patterns, masks, np.arange(0, len(patterns), fan_out))
            self.levels.append((patterns, masks))

    def search(self, queries: np.ndarray, most: int = MAX_DIFFERENCES, at_once: int = 4096):
        """Yield (query number, leaf number) arrays; queries go down together, node by node."""
        step = np.arange(self.fan_out)
        for first in range(0, len(queries), at_once):
            part = queries[first : first + at_once]
            top = len(self.levels[-1][0])
            query = np.repeat(np.arange(len(part)), top)
            node = np.tile(np.arange(top), len(part))
            for level in range(len(self.levels) - 1, -1, -1):
                patterns, masks = self.levels[level]
                near = np.bitwise_count((part[query] ^ patterns[node]) & masks[node]) <= most
                query, node = query[near], node[near]
                if level:
                    query = np.repeat(query, self.fan_out)
                    node = (node[:, None] * self.fan_out + step).ravel()
                    real = node < len(self.levels[level - 1][0])
                    query, node = query[real], node[real]
            yield query + first, node


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links: every node with the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def _groups(spark: SparkSession, distinct: DataFrame, group_rows: int) -> DataFrame:
    """Gray-ordered fingerprints in groups: ``group_id``, shared ``pattern`` and ``mask``, members packed in ``fps``."""

    def rank(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            ranks = (gray_rank(fps) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"fp": batch.column("fp"), "gray": pa.array(ranks, pa.int64())})

    schema = "gray_part int, nth int, pattern long, mask long, fps binary"

    def cut(batches):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        out, part, nth = Emitter(to_arrow_schema(struct)), TaskContext.get().partitionId(), 0
        rest = np.empty(0, np.int64)

        def add(members):
            bits = members.view(np.uint64)
            pattern, mask = shared(bits, np.full(len(bits), ~np.uint64(0)), np.array([0]))
            out.add(part, nth, int(pattern.view(np.int64)[0]), int(mask.view(np.int64)[0]), members.tobytes(), weight=members.nbytes)

        for batch in batches:
            rest = np.concatenate([rest, batch.column("fp").to_numpy(zero_copy_only=False)])
            while len(rest) >= group_rows:
                add(rest[:group_rows])
                rest, nth = rest[group_rows:], nth + 1
                if out.full:
                    yield out.take()
        if len(rest):
            add(rest)
        yield out.take()

    struct = spark.createDataFrame([], schema).schema
    ranked = distinct.select("fp").mapInArrow(rank, "fp long, gray long")
    groups = ranked.repartitionByRange("gray").sortWithinPartitions("gray").select("fp").mapInArrow(cut, struct)
    return stage(spark, groups, "gray_groups")


def links(spark: SparkSession, distinct: DataFrame, most: int = MAX_DIFFERENCES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """A spanning forest of all links between distinct ``fp`` values, as columns ``a`` and ``b``.

    ``distinct`` must be a stored table. Only patterns of groups, at most
    ``MAX_GROUPS`` and a few more, reach the driver.
    """
    group_rows = max(group_rows, -(-distinct.count() // MAX_GROUPS))
    groups = _groups(spark, distinct, group_rows)
    top = sorted((r["gray_part"], r["nth"], r["pattern"], r["mask"]) for r in groups.select("gray_part", "nth", "pattern", "mask").collect())
    number = {(part, nth): i for i, (part, nth, _, _) in enumerate(top)}
    patterns, masks = (np.array([t[k] for t in top], np.int64).view(np.uint64) for k in (2, 3))
    upper = GrayIndex(patterns, masks) if top else None

    route_schema = spark.createDataFrame([], "target_part int, target_nth int, own boolean, queries binary").schema

    def route(batches):
        """Which later groups, and its own, each fingerprint of a group must be compared with."""
        from pyspark.sql.pandas.types import to_arrow_schema

        out = Emitter(to_arrow_schema(route_schema))
        for part, nth, fps in rows_of(batches, "gray_part", "nth", "fps"):
            members, own = np.frombuffer(fps, np.int64), number[part, nth]
            for query, node in upper.search(members.view(np.uint64), most, at_once=1024):
                later = node >= own
                query, node = query[later], node[later]
                order = np.argsort(node, kind="stable")
                query, node = query[order], node[order]
                cuts = np.flatnonzero(np.diff(node)) + 1
                for q, n in zip(np.split(query, cuts), np.split(node, cuts), strict=True):
                    if len(n):
                        sent = members[q].tobytes()
                        out.add(*top[n[0]][:2], int(n[0]) == own, sent, weight=len(sent))
                if out.full:
                    yield out.take()
        yield out.take()

    link_schema = spark.createDataFrame([], "a long, b long").schema

    def meet(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out, last, index, members = Emitter(to_arrow_schema(link_schema)), None, None, None
        for part, nth, own, queries, fps in rows_of(batches, "gray_part", "nth", "own", "queries", "fps"):
            if (part, nth) != last:
                last, members = (part, nth), np.frombuffer(fps, np.int64)
                index = GrayIndex(members.view(np.uint64))
            asked = np.frombuffer(queries, np.int64)
            for query, node in index.search(asked.view(np.uint64), most, at_once=256):
                a, b = asked[query], members[node]
                if own:
                    a, b = a[a < b], b[a < b]
                if len(a):
                    for x, y in zip(*(v.tolist() for v in forest(a, b)), strict=True):
                        out.add(x, y)
                if out.full:
                    yield out.take()
        yield out.take()

    routed = groups.select("gray_part", "nth", "fps").mapInArrow(route, route_schema)
    stored = stage(spark, routed, "gray_routes")
    paired = stored.join(groups, (F.col("target_part") == F.col("gray_part")) & (F.col("target_nth") == F.col("nth")))
    return paired.select("gray_part", "nth", "own", "queries", "fps").mapInArrow(meet, link_schema)


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE_WORDS, most: int = MAX_DIFFERENCES, seed: int = SEED, keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, signed ``fp`` and ``component_id`` (smallest ``doc_id`` reachable over links) of every row.

    ``component`` is a fingerprint that names the component; ``keep`` columns go
    along. Texts without words have fingerprint 0 and are linked like any others.
    A component that has only NULL ids has a NULL id. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stored = stage(spark, fingerprints(docs, width, seed, keep), "fingerprints")
    classes = stage(spark, stored.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp_classes")
    roots = components(links(spark, classes, most)).select(F.col("node").alias("fp"), "root")
    linked = classes.join(roots, "fp")
    smallest = linked.groupBy("root").agg(F.min("first").alias("_smallest"))
    of_class = linked.join(smallest, "root").select("fp", "_smallest", "root")
    named = stage(
        spark,
        classes.join(of_class, "fp", "left").select(
            "fp", F.coalesce("_smallest", "first").alias("component_id"), F.coalesce("root", "fp").alias("component")
        ),
        "fp_components",
    )
    return stored.join(named, "fp").select("doc_id", "fp", "component_id", "component", *keep)


def hexadecimal(fp: str):
    return F.lower(F.lpad(F.hex(fp), BITS // 4, "0"))
