"""A stored inverted index of request vectors, with exact look-ups.

Centroids are trained on a bounded sample; every vector lies in the list of its
nearest centroid, and lists are parts of a versioned table. A list can only hold a
match if, by the triangle inequality, the angles of its members to the centroid
come within the threshold's angle of the query's own angle to it. Lists are left
out by that bound alone, so a look-up is exact; how many vectors it compares
depends on how well they fall into groups, and is stated per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from areapulse.operators.vectors import BLOCK_ROWS, SLACK, THRESHOLD, TOP_K, _chunk, _match, _unit
from areapulse.session import stage
from areapulse.sources.versions import VersionedTables

LISTS = 100
SAMPLE_ROWS = 16_384
ROUNDS = 8
CENTROIDS = StructType().add("list", IntegerType()).add("centroid", ArrayType(DoubleType()))


def train(sample: np.ndarray, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids: far-apart members of the sample first, then the middle of what is nearest to each."""
    units = _unit(pd.Series(list(sample)))
    centroids, nearest = [units[0]], units @ units[0]
    while len(centroids) < min(lists, len(units)):
        centroids.append(units[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, units @ centroids[-1])
    found = np.stack(centroids)
    for _ in range(rounds):
        of = np.argmax(units @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, of, units)
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(sizes > 0, np.divide(sums, sizes, out=np.zeros_like(sums), where=sizes > 0), found)
    return found


class VectorIndex:
    """Vectors below one root, told apart by ``request_hash``; ``keys`` must be equal for a match.

    Rows have ``id`` (long), ``request_hash``, ``vector`` and the keys.
    """

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str]):
        self.spark, self.keys, self.tables = spark, list(keys), VersionedTables(spark, root)
        fields = ["id long", "request_hash string", "vector array<float>", *(f"{n} {t}" for n, t in keys.items()), "list int", "angle double"]
        self.schema = spark.createDataFrame([], ", ".join(fields)).schema

    def build(self, rows: DataFrame, lists: int = LISTS, sample_rows: int = SAMPLE_ROWS) -> None:
        """Train centroids on at most ``sample_rows`` rows, those of the smallest hashes, and store all rows anew."""
        sample = rows.orderBy(F.xxhash64("request_hash"), "request_hash").limit(sample_rows).select("vector").collect()
        if not sample:
            raise ValueError("an index needs vectors to be trained on")
        centroids = train(np.array([r["vector"] for r in sample], np.float64), lists)
        base = self.tables.version()
        stored = self.spark.createDataFrame([(n, c.tolist()) for n, c in enumerate(centroids)], CENTROIDS)
        written = {"centroids": self.tables.write("centroids", stored.withColumn("_all", F.lit(0)), "_all"), "vectors": self._write(self._listed(self._latest(rows), centroids))}
        self.tables.publish(base, {table: {**dict.fromkeys(base.parts.get(table, {})), **parts} for table, parts in written.items()})

    def add(self, rows: DataFrame) -> int:
        """Add rows, replacing those of equal ``request_hash``; only the lists they come into or leave are written. The number of lists."""
        base = self.tables.version()
        fresh = stage(self.spark, self._listed(self._latest(rows), self._centroids(base)), "listed_vectors")
        hashes = fresh.select("request_hash")
        left = self.tables.read("vectors", self.schema, base).select("request_hash", "list").join(hashes, "request_hash", "left_semi")
        touched = sorted({str(r["list"]) for r in left.select("list").union(fresh.select("list")).distinct().collect()}, key=int)
        kept = self.tables.read("vectors", self.schema, base, touched).join(hashes, "request_hash", "left_anti")
        written = self._write(kept.select(*self.schema.names).unionByName(fresh))
        self.tables.publish(base, {"vectors": {**dict.fromkeys(touched), **written}})
        return len(touched)

    def lookup(self, queries: DataFrame, k: int = TOP_K, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
        """The ``k`` most similar vectors of each query (``id``, ``vector``, keys) with a cosine of at least ``threshold``.

        Returns ``query_id``, ``match_id``, ``similarity``, ``place``, and ``compared``,
        the vectors that the query was compared with.
        """
        version = self.tables.version()
        probes = stage(self.spark, self.probes(queries, threshold), "probes")
        wanted = [str(r["list"]) for r in probes.select("list").distinct().collect()]
        stored = self.tables.read("vectors", self.schema, version, wanted)
        group = [*self.keys, "list"]
        sizes = probes.groupBy(*group).agg(F.ceil(F.count("*") / block_rows).alias("_parts")).join(
            stored.groupBy(*group).agg(F.count("*").alias("_size"), F.ceil(F.count("*") / block_rows).alias("_chunks")), group
        )
        sizes = stage(self.spark, sizes, "list_sizes")
        task = [*group, "_chunk", "_part"]
        right = (
            stored.join(sizes, group).withColumn("_chunk", _chunk(F.col("id"), F.col("_chunks")))
            .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(*task, "id", "vector")
        )
        met = probes.join(sizes, group)
        left = (
            met.withColumn("_part", _chunk(F.col("id"), F.col("_parts")))
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).select(*[F.col(c).alias(c) for c in (*task, "id", "vector")])
        )
        matches = left.groupBy(*task).cogroup(right.groupBy(*task)).applyInPandas(_match(k, threshold), "query_id long, match_id long, similarity double")
        best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "match_id")
        work = met.groupBy(F.col("id").alias("query_id")).agg(F.sum("_size").alias("compared"))
        return matches.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).join(work, "query_id")

    def probes(self, queries: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """Queries once for each list that may hold a match, with the least angle ``bound`` a member can have, in its order."""
        centroids = self._centroids()
        members = self.tables.read("vectors", self.schema).groupBy("list").agg(F.min("angle").alias("low"), F.max("angle").alias("high"))
        reach = math.acos(max(-1.0, min(1.0, threshold))) + SLACK

        @F.pandas_udf("array<double>")
        def angles(vectors: pd.Series) -> pd.Series:
            return pd.Series(list(np.arccos(np.clip(_unit(vectors) @ centroids.T, -1.0, 1.0))))

        # one row a list, of which there are a fixed number
        ranges = F.lit([]).cast("array<struct<list:int,low:double,high:double>>")
        held = [(r["list"], r["low"], r["high"]) for r in members.collect()]
        if held:
            ranges = F.array(*[F.struct(F.lit(n).alias("list"), F.lit(low).alias("low"), F.lit(high).alias("high")) for n, low, high in sorted(held)])
        own = queries.select("id", "vector", *self.keys, angles("vector").alias("_angles"))
        bound = F.transform(ranges, lambda r: F.struct(
            F.greatest(F.lit(0.0), F.get("_angles", r["list"]) - r["high"], r["low"] - F.get("_angles", r["list"])).alias("bound"), r["list"].alias("list")
        ))
        near = F.array_sort(F.filter(bound, lambda r: r["bound"] <= reach))
        return own.select("id", "vector", *self.keys, F.inline(near))

    def _latest(self, rows: DataFrame) -> DataFrame:
        """One row a hash: that of the largest id."""
        names = [n for n in self.schema.names if n not in ("request_hash", "list", "angle")]
        picked = rows.groupBy("request_hash").agg(F.max_by(F.struct(*names), "id").alias("_row"))
        return picked.select("request_hash", "_row.*")

    def _listed(self, rows: DataFrame, centroids: np.ndarray) -> DataFrame:
        @F.pandas_udf("struct<list int, angle double>")
        def nearest(vectors: pd.Series) -> pd.DataFrame:
            cosines = np.clip(_unit(vectors) @ centroids.T, -1.0, 1.0)
            return pd.DataFrame({"list": np.argmax(cosines, axis=1).astype(np.int32), "angle": np.arccos(cosines.max(axis=1))})

        return rows.withColumn("_near", nearest("vector")).select("*", "_near.*").select(*self.schema.names)

    def _centroids(self, version=None) -> np.ndarray:
        rows = self.tables.read("centroids", CENTROIDS, version).orderBy("list").collect()
        return np.array([r["centroid"] for r in rows], np.float64)

    def _write(self, rows: DataFrame) -> dict[str, str]:
        return self.tables.write("vectors", rows.withColumn("_list", F.col("list")).repartition("_list"), "_list")
