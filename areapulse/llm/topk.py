"""Exact top-k inner products by aggregation of sorted lists without random access.

Candidates are cut into blocks. A block has one list per vector component, sorted
by value. For a query each list is read from the end that gives the larger
products, all lists to the same depth, which grows until it suffices; queries are
taken together. What has been read of a candidate and what its unread components can give at least and at
most bound its score; once no candidate outside a small set can reach the k-th
best lower bound, the set's scores are resolved and ranked. The block of the
longest vectors comes first: its k-th best score is where the bound of all other
blocks starts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from areapulse.session import stage

SCALE = 256
K = 5
QUERY_DIVISOR = 50
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
#: Components beyond this may not be summed in 64 bits; the scores of their vectors are exact Python integers.
LARGEST = 1 << 20
#: Lists are read to this part of a block first, then twice as far each time; so few candidates are resolved without reading on.
STEPS = 16
RESOLVED = 256
#: Queries whose bounds are held at once.
QUERIES_AT_ONCE = 256


class SortedLists:
    """The lists of one block: for each component the candidates in ascending order of its value.

    All lists are read to the same depth for many queries at once. What was read of
    a component is at least, or at most, the value the list showed last there, so
    the values clipped at that one are what is known of all candidates, and two
    matrix products, with the positive and the negative factors, bound their scores.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors, (self.rows, self.size) = vectors, vectors.shape
        self.values = vectors.astype(np.float64)
        #: By place, component.
        self.up = np.sort(self.values, axis=0)
        self.largest = np.abs(self.up[[0, -1]]).max(axis=0) if self.rows else np.zeros(self.size)

    def upper(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """The most that every query's score with every candidate can be after reading to ``depth``: what is unread gives at most what its list showed last."""
        factors = queries.astype(np.float64)
        high = np.minimum(self.values, self.up[depth - 1]) @ np.minimum(factors, 0).T
        return (high + np.maximum(self.values, self.up[self.rows - depth]) @ np.maximum(factors, 0).T).T

    def lower(self, queries: np.ndarray, depth: int) -> np.ndarray:
        """The least it can be: what is unread gives at least what the list ends with."""
        factors = queries.astype(np.float64)
        low = np.where(self.values <= self.up[depth - 1], self.values, self.up[-1]) @ np.minimum(factors, 0).T
        return (low + np.where(self.values >= self.up[self.rows - depth], self.values, self.up[0]) @ np.maximum(factors, 0).T).T

    def survivors_of(self, queries: np.ndarray, k: int, own: list[np.ndarray], floors: np.ndarray) -> list[np.ndarray]:
        """Per query, the candidates that may be among the ``k`` best and reach its floor; its ``own`` ones are left out."""
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        left, depth = [], -(-self.rows // STEPS)
        for n, out in enumerate(own):
            if self.rows - len(out) <= k or not self.size:
                found[n] = np.setdiff1d(np.arange(self.rows), out)
            else:
                left.append(n)
        # sums of doubles may be off by far less than this
        rounding = 1e-12 * (np.abs(queries.astype(np.float64)) @ self.largest)
        while left:
            upper = self.upper(queries[left], depth)
            bars = floors[left].copy()
            if len(open_bars := np.flatnonzero(~np.isfinite(bars))):
                lower = self.lower(queries[left][open_bars], depth)
                for at, row in zip(open_bars.tolist(), lower, strict=True):
                    row[own[left[at]]] = -np.inf
                    bars[at] = np.partition(row, -k)[-k]
            again = []
            for n, row, bar in zip(left, upper, bars.tolist(), strict=True):
                row[own[n]] = -np.inf
                able = np.flatnonzero(row >= bar - rounding[n])
                if len(able) <= max(RESOLVED, k) or depth == self.rows:
                    found[n] = able
                else:
                    again.append(n)
            # reading further costs the same here however far it is
            left, depth = again, min(self.rows, 2 * depth)
        return found

    def survivors(self, query: np.ndarray, k: int, own: np.ndarray, floor: float = -np.inf) -> np.ndarray:
        return self.survivors_of(query[None, :], k, [own], np.array([floor]))[0]

    def top(self, queries: np.ndarray, k: int, ids: np.ndarray, own: list[int], floors: np.ndarray) -> list[list[tuple[int, int]]]:
        """Per query the ids and scores of the ``k`` best that reach its floor; its own id is left out."""
        out = []
        for first in range(0, len(queries), QUERIES_AT_ONCE):
            part = slice(first, first + QUERIES_AT_ONCE)
            skipped = [np.flatnonzero(ids == i) for i in own[part]]
            for query, found in zip(queries[part], self.survivors_of(queries[part], k, skipped, floors[part]), strict=True):
                scores = self.vectors[found] @ query
                order = np.lexsort((ids[found], -scores))[:k]
                out.append(list(zip(ids[found][order].tolist(), scores[order].tolist(), strict=True)))
        return out


def quantised(vectors: DataFrame, id_name: str = "vec_id", vector_name: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id`` and integer components ``q`` of the rows that take part.

    Left out: NULL ids, NULL vectors, and vectors with a component that is NULL,
    or not finite. A component that does not fit 64 bits is an error. Equal rows
    count once.
    """
    v = F.col(f"`{vector_name}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    beyond = F.raise_error(F.lit("a vector component does not fit 64 bits")).cast("long")
    ints = F.transform(
        F.when(~bad, v), lambda x: F.when(F.abs(x.cast("double") * scale) >= 2.0**63, beyond).otherwise(F.floor(x.cast("double") * scale))
    )
    return vectors.select(F.col(f"`{id_name}`").alias("vec_id"), ints.alias("q")).where("vec_id is not null and q is not null").distinct()


def top_k(
    vectors: DataFrame, k: int = K, query_divisor: int = QUERY_DIVISOR, id_name: str = "vec_id", vector_name: str = "embedding",
    candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` largest inner products of every query, ties to smaller ids.

    Queries are the rows whose id is divisible by ``query_divisor``; candidates
    are all rows with another id. Of equal vectors only the ``k + 1`` smallest
    ids can be in a result, so only these go on. Shorter vectors are filled up
    with zeros. Blocks of queries meet blocks of candidates, ``k`` rows per query
    leave each meeting. The block of the longest vectors meets all queries first,
    and the other blocks only look for what reaches its ``k``-th best score.
    """
    spark = vectors.sparkSession
    stored = stage(spark, quantised(vectors, id_name, vector_name), "quantised")
    nth = F.row_number().over(Window.partitionBy("q").orderBy("vec_id"))
    norm = F.aggregate("q", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    distinct = stored.withColumn("_nth", nth).where(F.col("_nth") <= k + 1).select("vec_id", "q", norm.alias("norm"))
    candidates = stage(spark, distinct, "candidates")
    queries = stage(spark, stored.where(F.col("vec_id") % query_divisor == 0), "queries")
    longest = stage(spark, candidates.orderBy(F.desc("norm"), "vec_id").limit(candidate_block).select("vec_id"), "longest")
    blocks = max(1, -(-candidates.count() // candidate_block))
    query_blocks = max(1, -(-queries.count() // query_block))
    # block 0 is full; what is left is dealt to the others
    mark = longest.select(F.col("vec_id").alias("_long")).distinct()
    others = F.lit(0) if blocks == 1 else 1 + F.pmod(F.xxhash64("vec_id"), F.lit(blocks - 1))
    dealt = candidates.join(mark, F.col("vec_id") == F.col("_long"), "left").select(
        F.when(F.col("_long").isNotNull(), F.lit(0)).otherwise(others).cast("long").alias("cb"), "vec_id", "q"
    )
    dealt = stage(spark, dealt, "dealt_candidates")
    asked = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))

    def every(rows: DataFrame, first: int, last: int) -> DataFrame:
        return rows.withColumn("cb", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))

    left = dealt.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    left = left.select("cb", "qb", "vec_id", "q")

    def meet(found: pa.Table, asked: pa.Table) -> pa.Table:
        rows = {"query_id": [], "vec_id": [], "score": []}
        if found.num_rows and asked.num_rows:
            size = max(int(pc.max(pc.list_value_length(t.column("q"))).as_py()) for t in (found, asked))
            vectors, queries = matrix(found, size), matrix(asked, size)
            ids, large = found.column("vec_id").to_numpy(), (abs(vectors) > LARGEST * SCALE).any(axis=1)
            lists = SortedLists(vectors[~large]) if not large.all() else None
            asked_ids = asked.column("vec_id").to_pylist()
            floors = np.array([-np.inf if f is None else f for f in asked.column("floor").to_pylist()])
            too_large = (abs(queries) > LARGEST * SCALE).any(axis=1)
            listed = np.flatnonzero(~too_large) if lists else np.empty(0, np.int64)
            tops = lists.top(queries[listed], k, ids[~large], [asked_ids[n] for n in listed], floors[listed]) if lists else []
            bests = dict(zip(listed.tolist(), tops, strict=True))
            for n, (query_id, query) in enumerate(zip(asked_ids, queries, strict=True)):
                best, exact = bests.get(n, []), np.ones(len(ids), bool) if too_large[n] else large
                exact = np.flatnonzero(exact & (ids != query_id))
                if len(exact):
                    scores = vectors[exact].astype(object) @ query.astype(object)
                    best = sorted([*best, *zip(ids[exact].tolist(), scores, strict=True)], key=lambda x: (-x[1], x[0]))[:k]
                for vec_id, score in best:
                    rows["query_id"].append(query_id)
                    rows["vec_id"].append(vec_id)
                    rows["score"].append(score)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in rows.items()})

    columns = "query_id long, vec_id long, score long"

    def together(found: DataFrame, queries: DataFrame) -> DataFrame:
        right = queries.select("cb", "qb", "vec_id", "q", "floor")
        return found.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInArrow(meet, columns)

    first = every(asked.withColumn("floor", F.lit(None).cast("double")), 0, 0)
    near = stage(spark, together(left.where("cb = 0"), first).distinct(), "first_scores")
    if blocks == 1:
        met = near
    else:
        # scores are whole, and below 2^53 where lists are used: the double is the score
        floors = near.groupBy(F.col("query_id").alias("_query")).agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
        rest = every(asked.join(floors, F.col("vec_id") == F.col("_query"), "left"), 1, blocks - 1)
        met = near.union(together(left.where("cb > 0"), rest).distinct())
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return met.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def matrix(rows: pa.Table, size: int) -> np.ndarray:
    out = np.zeros((rows.num_rows, size), np.int64)
    lengths = pc.list_value_length(rows.column("q")).to_numpy()
    out[np.arange(size) < lengths[:, None]] = pc.list_flatten(rows.column("q")).to_numpy()
    return out
