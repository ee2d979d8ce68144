"""Exact look-up of the most similar stored vectors above a threshold.

Stored vectors go to their nearest pivot and, by angle from it, to rings. By the
triangle inequality a ring can only hold a match if its range of angles comes
within the threshold angle of the query's own angle to that pivot; other rings
are skipped without losing a match. What remains is compared block by block as a
matrix product inside the tasks, which hand on at most ``k`` matches per query.
A ring's vectors are compared ``block_rows`` at a time. Rings and query sets beyond
a task's size are split, so no task grows with a hot group, and small rings share a
task, so that a query is sent to few. The pivots only steer the work: the result does not depend on them. In
many dimensions angles to a pivot are alike and few rings are skipped; the work
is then that of comparing every query with every stored vector of its key.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.session import stage

# Executors get the task functions below with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS = 16
RING = 0.2
BLOCK_ROWS = 4096
TOP_K = 5
#: Queries and stored vectors that a task compares, similarities that it computes at once, and matches it holds before it keeps the best.
TASK_ROWS = 16_384
PRODUCT = 1 << 20
HELD = 1 << 20
THRESHOLD = 0.92
SLACK = 1e-6


def _unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _pivot_angles(pivots: np.ndarray):
    @F.pandas_udf("array<double>")
    def angles(vectors: pd.Series) -> pd.Series:
        cosines = np.clip(_unit(vectors) @ pivots.T, -1.0, 1.0)
        return pd.Series(list(np.arccos(cosines)))

    return angles


def _best(queries: np.ndarray, order: np.ndarray, similarity: np.ndarray, k: int) -> np.ndarray:
    """Which matches are among the ``k`` best of their query: by similarity, then the smaller id."""
    by = np.lexsort((order, -similarity, queries))
    new = np.append(True, queries[by][1:] != queries[by][:-1])[: len(by)]
    place = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    return by[place < k]


def _match(k: int, threshold: float, pivots: np.ndarray | None = None, reach: float = 0.0, block_rows: int = BLOCK_ROWS):
    """For a cogroup of queries and stored vectors; with ``pivots``, stored rows have ``_cell``, ``_ring`` and ``_angle``.

    Stored vectors of a ring are taken ``block_rows`` at a time, and only the
    queries whose angle comes near theirs are compared with them, some at a time.
    """
    def tiles(stored: pd.DataFrame) -> list[np.ndarray]:
        if pivots is None:
            return np.array_split(np.arange(len(stored)), -(-len(stored) // block_rows))
        cell, ring, angle = (stored[c].to_numpy() for c in ("_cell", "_ring", "_angle"))
        order = np.lexsort((angle, ring, cell))
        cuts = np.flatnonzero((cell[order][1:] != cell[order][:-1]) | (ring[order][1:] != ring[order][:-1])) + 1
        return [rows[at:at + block_rows] for rows in np.split(order, cuts) for at in range(0, len(rows), block_rows)]

    def block(key, queries: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": "int64", "match_id": "int64", "similarity": "float64"}
        if not len(queries) or not len(stored):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in columns.items()})
        left, right, ids = _unit(queries["vector"]), _unit(stored["vector"]), stored["id"].to_numpy()
        # NULL ids come as NaN, and first among equals as in Spark
        order = np.where(pd.isna(ids), -np.inf, ids) if ids.dtype.kind == "f" else ids
        if pivots is not None:
            own, angles = np.arccos(np.clip(left @ pivots.T, -1.0, 1.0)), stored["_angle"].to_numpy()
            cells = stored["_cell"].to_numpy()
        found, held = [], 0

        def keep() -> list[np.ndarray]:
            rows, matches, similarity = (np.concatenate(x) for x in zip(*found, strict=True))
            best = _best(rows, order[matches], similarity, k)
            return [rows[best], matches[best], similarity[best]]

        for tile in tiles(stored):
            near = np.arange(len(left))
            if pivots is not None:
                low, high, at = np.fmin.reduce(angles[tile]), np.fmax.reduce(angles[tile]), own[:, cells[tile[0]]]
                near = np.flatnonzero(~((at < low - reach) | (at > high + reach)))
            step = max(1, PRODUCT // len(tile))
            for start in range(0, len(near), step):
                rows = near[start:start + step]
                similarity = left[rows] @ right[tile].T
                hits, matches = np.nonzero(similarity >= threshold)
                if len(hits):
                    found.append([rows[hits], tile[matches], similarity[hits, matches]])
                    held += len(hits)
                if held > HELD + 2 * k * len(left):
                    found = [keep()]
                    held = len(found[0][0])
        if not found:
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in columns.items()})
        rows, matches, similarity = keep()
        return pd.DataFrame({"query_id": queries["id"].to_numpy()[rows], "match_id": ids[matches], "similarity": similarity})

    return block


def _chunk(identifier: Column, chunks: Column) -> Column:
    return F.pmod(F.xxhash64(identifier), chunks)


def nearest_stored(
    queries: DataFrame,
    stored: DataFrame,
    keys: list[str],
    k: int = TOP_K,
    threshold: float = THRESHOLD,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
    ring_width: float = RING,
) -> DataFrame:
    """Top ``k`` stored vectors per query with cosine similarity of at least ``threshold``.

    Both frames have ``id`` (long), ``vector`` and the columns ``keys``, which must
    be equal for a match.
    """
    # A bounded number of pivots, picked by hash so that the choice is repeatable.
    picked = stored.orderBy(F.xxhash64("id"), "id").limit(pivots).select("vector").toPandas()
    if picked.empty:
        return queries.select(
            F.col("id").alias("query_id"), F.col("id").alias("match_id"),
            F.lit(0.0).alias("similarity"), F.lit(0).alias("place"),
        ).where(F.lit(False))
    units = _unit(picked["vector"])
    angles = _pivot_angles(units)
    reach = math.acos(max(-1.0, min(1.0, threshold))) + SLACK

    nearest = F.array_min("_angles")
    placed = stage(stored.sparkSession, stored.select("id", "vector", *keys, angles("vector").alias("_angles")).select(
        "id", "vector", *keys,
        (F.array_position("_angles", nearest) - 1).cast("int").alias("_cell"),
        F.floor(nearest / ring_width).cast("int").alias("_ring"),
        nearest.alias("_angle"),
    ), "placed_vectors")
    # Rings of a key lie one after another in bins of a task's size: at most pivots * pi / ring_width rows a key tell where.
    ring = [*keys, "_cell", "_ring"]
    ahead = Window.partitionBy(*keys).orderBy("_cell", "_ring").rowsBetween(Window.unboundedPreceding, -1)
    rings = stage(stored.sparkSession, placed.groupBy(*ring).agg(
        F.min("_angle").alias("_low"), F.max("_angle").alias("_high"), F.count(F.lit(1)).alias("_size"),
    ).withColumn("_ahead", F.coalesce(F.sum("_size").over(ahead), F.lit(0))), "rings")
    asked = queries.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / TASK_ROWS).alias("_parts"))
    task = [*keys, "_bin", "_part"]
    stored_rows = (
        placed.join(rings.join(asked, keys).drop("_low", "_high"), ring)
        .withColumn("_bin", F.floor((F.col("_ahead") + _chunk(F.col("id"), F.col("_size"))) / TASK_ROWS))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(*task, "id", "vector", "_cell", "_ring", "_angle")
    )
    ranges = rings.groupBy(*keys).agg(F.collect_list(F.struct(
        "_cell", "_low", "_high", F.floor(F.col("_ahead") / TASK_ROWS).alias("_first"),
        F.floor((F.col("_ahead") + F.col("_size") - 1) / TASK_ROWS).alias("_last"),
    )).alias("_rings"))
    near = F.filter("_rings", lambda r: F.get("_angles", r["_cell"]).between(r["_low"] - reach, r["_high"] + reach))
    bins = F.array_distinct(F.flatten(F.transform(near, lambda r: F.sequence(r["_first"], r["_last"]))))
    query_rows = (
        queries.select("id", "vector", *keys, angles("vector").alias("_angles"))
        .join(ranges.join(asked, keys), keys)
        .withColumn("_part", _chunk(F.col("id"), F.col("_parts")))
        .withColumn("_bin", F.explode(bins))
        # New column identities: both sides of the cogroup descend from the stored rows.
        .select(*[F.col(c).alias(c) for c in (*task, "id", "vector")])
    )
    matches = query_rows.groupBy(*task).cogroup(stored_rows.groupBy(*task)).applyInPandas(
        _match(k, threshold, units, reach, block_rows), "query_id long, match_id long, similarity double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "match_id")
    return matches.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
