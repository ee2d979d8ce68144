"""Best-fit-decreasing packing of token sequences into rows of fixed length.

Best fit decreasing looks at nothing but lengths, and there are no more lengths
than tokens in a sequence. The driver therefore gets one count per length, runs
the packing on whole groups of equal pieces and equal bins with a segment tree
over the remaining capacities, and hands back a plan of bin ranges. The pieces
themselves are ranked among pieces of their length by Spark and look their place
up in the plan. A length that holds a third of all pieces is ranked in blocks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from areapulse.llm.common import map_rows
from areapulse.llm.tokens import VOCABULARY, text_encoder
from areapulse.session import stage

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids binary"
DIGESTS = "doc_id long, piece int, start long, length long, ids_crc32 long"
BLOCK_ROWS = 16_384


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """The token pieces of every row: ids of the whole text and an end id, cut only where longer than ``capacity``.

    The first piece takes the odd length, so that all others are full. NULL and
    empty texts have the end id alone. Every row counts, repeated rows too; a
    NULL ``doc_id`` stays NULL. Other columns are not read.
    """
    return map_rows(docs, ["doc_id", "text"], PIECES, _cutter(capacity, end_id, vocabulary, bytes), weight=lambda row: len(row[4]))


def digests(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """The same pieces with the checksum of their ids, ``ids_crc32``, so that the ids do not leave the tasks that make them."""
    return map_rows(docs, ["doc_id", "text"], DIGESTS, _cutter(capacity, end_id, vocabulary, zlib.crc32))


def _cutter(capacity: int, end_id: int, vocabulary: str, last):
    """For ``map_rows``: the pieces of a text, with ``last`` of their ids."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(doc_id, text):
        ids = text_encoder(vocabulary).encode(text) + end
        total, start, number = len(ids) // 4, 0, 0
        stop = total if total <= capacity else total % capacity or capacity
        while start < total:
            yield doc_id, number, start, stop - start, last(ids[4 * start : 4 * stop])
            start, stop, number = stop, stop + capacity, number + 1

    return cut


class CapacityTree:
    """Counts of open bins by remaining capacity; finds the tightest that still fits in logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        node = remaining + self.size
        while node:
            self.tree[node] += bins
            node //= 2

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that an open bin has."""
        node = length + self.size
        if self.tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.size:
            node = 2 * node if self.tree[2 * node] else 2 * node + 1
        return node - self.size


@dataclass(frozen=True)
class Placement:
    """Pieces of one length, from a rank on, over a range of bins, ``each`` in a bin, from an offset on."""

    length: int
    first_rank: int
    each: int
    bins: int
    first_bin: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Placement]:
    """Best fit decreasing over counted lengths: what it does piece by piece, in whole groups.

    A piece goes to the tightest open bin. If that bin then still has room for
    the next piece of the same length, it is the tightest again, so a bin takes
    ``remaining // length`` of them in a row.
    """
    tree, open_bins = CapacityTree(capacity), defaultdict(list)
    plan, used = [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        rank, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining = capacity
                first, bins = used, -(-left // (capacity // length))
                used += bins
            else:
                first, bins = open_bins[remaining].pop()
                tree.add(remaining, -bins)
            each = remaining // length
            if left < each:
                each, take = left, 1
            else:
                take = min(bins, left // each)
            plan.append(Placement(length, rank, each, take, first, capacity - remaining))
            for room, start, n in ((remaining - each * length, first, take), (remaining, first + take, bins - take)):
                if n:
                    open_bins[room].append((start, n))
                    tree.add(room, n)
            rank += each * take
            left -= each * take
    return plan


def ranked(sized: DataFrame, order: list[str], block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``sized`` with the rank of each row among rows of its length, and the count of each length.

    ``sized`` must be a stored table. Rows of one length are dealt to blocks;
    the counts of blocks give each block's first rank.
    """
    spark = sized.sparkSession
    blocks = max(1, -(-sized.count() // block_rows))
    dealt = sized.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = dealt.groupBy("length", "_block").count()
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = stage(spark, counts.withColumn("_first", F.coalesce(F.sum("count").over(before), F.lit(0))), "pack_blocks")
    lengths = {r["length"]: r["n"] for r in first.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    within = Window.partitionBy("length", "_block").orderBy(*order)
    numbered = dealt.withColumn("_within", F.row_number().over(within) - 1)
    joined = numbered.join(first.select("length", "_block", "_first"), ["length", "_block"])
    return joined.withColumn("rank", F.col("_first") + F.col("_within")).drop("_block", "_first", "_within"), lengths


def pack(sized: DataFrame, order: list[str], capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``sized`` (a stored table with a long ``length``) with ``sequence_id`` and ``offset`` of each row.

    Sequences are filled without gaps and hold at most ``capacity``. Ties in
    ``order`` are equal rows, for which any assignment is the same. An empty
    table gives no rows.
    """
    rows, lengths = ranked(sized, order, block_rows)
    plan = defaultdict(list)
    for placement in best_fit(lengths, capacity):
        plan[placement.length].append(placement)
    firsts = {length: [p.first_rank for p in placed] for length, placed in plan.items()}
    schema = sized.sparkSession.createDataFrame([], rows.schema).withColumns(
        {"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}
    ).drop("rank").schema

    def place(batches):
        for batch in batches:
            names = batch.schema.names
            sequence, offset = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                p = plan[length][bisect_right(firsts[length], rank) - 1]
                nth = rank - p.first_rank
                sequence.append(p.first_bin + nth // p.each)
                offset.append(p.offset + nth % p.each * length)
            kept = {n: batch.column(n) for n in names if n != "rank"}
            yield pa.RecordBatch.from_pydict(
                {**kept, "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
            )

    return rows.mapInArrow(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed rows: one ``ids`` value per sequence, joined in order of offset; a sequence has at most its capacity of ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.expr("aggregate(_parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids")
    )


def packed(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 2, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every piece of ``docs`` with its digest and its place; ids are written out by ``sequences`` where wanted."""
    stored = stage(docs.sparkSession, digests(docs, capacity, end_id, vocabulary), "pieces")
    return pack(stored, ["doc_id", "piece", "start", "ids_crc32"], capacity)
