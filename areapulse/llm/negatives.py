"""Hard negatives by angular triangle filtering.

Every vector is stored with its norm and its angles to a few reference directions.
For two vectors at angles a and b to a reference, the angle between them lies
between ``|a - b|`` and ``a + b``, so their cosine lies within sin a sin b of
cos a cos b. The references' intervals are intersected, multiplied by the norms and
widened beyond any rounding; only candidates whose interval overlaps what is still
asked for (the k best positives so far, or a window of negatives) are scored, in
integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.llm.common import give_back
from areapulse.session import stage

SCALE = 256
ANCHOR_DIVISOR = 100
POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score that a negative's score must reach, and may not pass.
LOW_PERCENT = 30
HIGH_PERCENT = 90
#: Reference directions, and the rows they are fitted on; both only steer how much is filtered.
REFERENCES = 16
SAMPLE_ROWS = 2048
ROUNDS = 6
#: References whose intervals are intersected for a pair: the ones nearest to the anchor.
USED = 4
CANDIDATE_BLOCK = 4096
ANCHOR_BLOCK = 1024
ANCHORS_AT_ONCE = 16
#: Doubles hold integers up to here, and bounds are widened by this share of the product of the norms.
EXACT = 2.0**52
WIDER = 1e-6


def padded(vectors: list[list[int]], size: int | None = None) -> np.ndarray:
    """Integer rows filled up with zeros; Python integers where 64-bit ones might be too small."""
    size = max(map(len, vectors), default=0) if size is None else size
    large = any(v and max(map(abs, v)) >= 1 << 31 for v in vectors)
    out = np.zeros((len(vectors), size), object if large else np.int64)
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    return out


def norms_of(vectors: np.ndarray) -> np.ndarray:
    values = vectors.astype(np.float64)
    return np.sqrt((values * values).sum(axis=1))


def cosines(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Of the angles to every reference; a zero vector counts as at a right angle, its norm makes its bounds zero."""
    size = max(vectors.shape[1], references.shape[1])
    values = np.zeros((len(vectors), size))
    values[:, : vectors.shape[1]] = vectors.astype(np.float64) / np.where(norms == 0, 1.0, norms)[:, None]
    directions = np.zeros((len(references), size))
    directions[:, : references.shape[1]] = references
    return np.clip(values @ directions.T, -1.0, 1.0)


def fit_references(vectors: list[list[int]], count: int = REFERENCES, rounds: int = ROUNDS) -> np.ndarray:
    """Unit directions in the middle of groups of the sampled vectors; the sample's order decides all ties."""
    values = padded(vectors)
    norms = norms_of(values)
    units = values[norms > 0].astype(np.float64) / norms[norms > 0][:, None]
    if not len(units):
        return np.eye(1)
    centres = [0]
    nearest = units @ units[0]
    while len(centres) < min(count, len(units)):
        centres.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[centres[-1]])
    directions = units[centres]
    for _ in range(rounds):
        of = np.argmax(units @ directions.T, axis=1)
        sums = np.zeros_like(directions)
        np.add.at(sums, of, units)
        sizes = np.sqrt((sums * sums).sum(axis=1))
        directions = np.where((sizes > 1e-9)[:, None], sums / np.where(sizes > 1e-9, sizes, 1.0)[:, None], directions)
    return directions


class Block:
    """Candidates with their labels, norms and stored angles."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, norms: np.ndarray, angles: np.ndarray):
        self.ids, self.labels, self.vectors, self.norms = ids, labels, vectors, norms
        self.angles_cos, self.angles_sin = np.cos(angles) * norms[:, None], np.sin(angles) * norms[:, None]
        exact = vectors.dtype != object and len(norms) and float(norms.max()) < EXACT
        self.doubles = vectors.astype(np.float64) if exact else None

    def bounds(self, norms: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of every candidate (columns) with the given anchors (rows)."""
        used = np.argsort(angles, axis=1, kind="stable")[:, :USED]
        low = high = None
        for n in range(used.shape[1]):
            reference = used[:, n]
            at = angles[np.arange(len(angles)), reference]
            middle = self.angles_cos.T[reference] * (np.cos(at) * norms)[:, None]
            reach = self.angles_sin.T[reference] * (np.sin(at) * norms)[:, None]
            low = middle - reach if low is None else np.maximum(low, middle - reach)
            high = middle + reach if high is None else np.minimum(high, middle + reach)
        rounding = WIDER * norms[:, None] * self.norms[None, :] + 1.0
        return low - rounding, high + rounding

    def scores(self, which: np.ndarray, anchor: np.ndarray, norm: float) -> list[int]:
        """Exact integer inner products."""
        if self.doubles is not None and anchor.dtype != object and float(self.norms.max()) * norm < EXACT:
            return (self.doubles[which] @ anchor.astype(np.float64)).astype(np.int64).tolist()
        return [int(s) for s in self.vectors[which].astype(object) @ anchor.astype(object)]


def positives_of(block: Block, anchors: Block, angles: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, candidate, score) of the ``k`` best candidates of each anchor's label; others than the anchor's own row."""
    for begin in range(0, len(anchors.ids), ANCHORS_AT_ONCE):
        part = slice(begin, begin + ANCHORS_AT_ONCE)
        low, high = block.bounds(anchors.norms[part], angles[part])
        for row, at in enumerate(range(begin, begin + len(low))):
            able = np.flatnonzero((block.labels == anchors.labels[at]) & (block.ids != anchors.ids[at]))
            if len(able) > k:
                least = np.partition(low[row, able], -k)[-k]
                able = able[high[row, able] >= least]
            yield from _best(block, able, anchors, at, k)


def _best(block: Block, able: np.ndarray, anchors: Block, at: int, k: int) -> Iterator[tuple[int, int, int]]:
    scored = zip(block.scores(able, anchors.vectors[at], float(anchors.norms[at])), block.ids[able].tolist(), strict=True)
    for score, other in sorted(scored, key=lambda x: (-x[0], x[1]))[:k]:
        yield int(anchors.ids[at]), other, score


def negatives_of(
    block: Block, anchors: Block, angles: np.ndarray, asked: list[list[int]], k: int, low_percent: int, high_percent: int,
) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, positive score, candidate, score) of the ``k`` best candidates of other labels in each window of an anchor."""
    for begin in range(0, len(anchors.ids), ANCHORS_AT_ONCE):
        part = slice(begin, begin + ANCHORS_AT_ONCE)
        low, high = block.bounds(anchors.norms[part], angles[part])
        for row, at in enumerate(range(begin, begin + len(low))):
            other = np.flatnonzero((block.labels != anchors.labels[at]) & (block.ids != anchors.ids[at]))
            least, most = low[row, other], high[row, other]
            windows, wanted = [], np.zeros(len(other), bool)
            for positive in asked[at]:
                # whole scores from the one to the other lie in the window
                start, end = -(-low_percent * positive // 100), high_percent * positive // 100
                if start > end:
                    continue
                able = (most >= start) & (least <= end)
                sure = np.flatnonzero((least >= start) & (most <= end))
                if len(sure) > k:
                    able &= most >= np.partition(least[sure], -k)[-k]
                windows.append((positive, start, end))
                wanted |= able
            picked = other[wanted]
            if not len(picked):
                continue
            scored = sorted(zip(block.scores(picked, anchors.vectors[at], float(anchors.norms[at])), block.ids[picked].tolist(), strict=True), key=lambda x: (-x[0], x[1]))
            for positive, start, end in windows:
                inside = [x for x in scored if start <= x[0] <= end][:k]
                for score, vec_id in inside:
                    yield int(anchors.ids[at]), positive, vec_id, score


def quantised(vectors: DataFrame, label: Column, id_name: str = "vec_id", vector_name: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and integer components ``q`` of the rows that take part; one row an id, that of the smallest label and vector."""
    v = F.col(f"`{vector_name}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    beyond = F.raise_error(F.lit("a vector component does not fit 64 bits")).cast("long")
    whole = lambda x: F.when(F.abs(x.cast("double") * scale) >= 2.0**63, beyond).otherwise(F.floor(x.cast("double") * scale))
    rows = vectors.select(F.col(f"`{id_name}`").alias("vec_id"), label.cast("long").alias("label"), F.when(~bad, F.transform(v, whole)).alias("q"))
    kept = rows.where("vec_id is not null and label is not null and q is not null")
    return kept.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("_row")).select("vec_id", "_row.*")


def indexed(rows: DataFrame, candidate_block: int = CANDIDATE_BLOCK) -> tuple[DataFrame, int]:
    """The stored rows with ``norm``, ``angles`` to the references, and ``block``; and the number of blocks.

    References are fitted on at most ``SAMPLE_ROWS`` rows, those of the smallest
    hashes. A block holds rows nearest to one reference.
    """
    spark = rows.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("q").collect()
    references = fit_references([r["q"] for r in sample])
    schema = "vec_id long, label long, q array<long>, norm double, angles array<double>, cell int"

    def measure(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            values = padded(batch.column("q").to_pylist())
            norms = norms_of(values)
            cos = cosines(values, norms, references)
            angles = pa.array(list(np.arccos(cos)), pa.list_(pa.float64()))
            nearest = pa.array(np.argmax(cos, axis=1).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "q")), pa.array(norms), angles, nearest],
                names=["vec_id", "label", "q", "norm", "angles", "cell"],
            )
        give_back()

    measured = stage(spark, rows.select("vec_id", "label", "q").mapInArrow(measure, schema), "vector_angles")
    sizes = {r["cell"]: r["n"] for r in measured.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    parts = [max(1, -(-sizes.get(c, 0) // candidate_block)) for c in range(len(references))]
    at = F.col("cell") + 1
    first = F.element_at(F.array(*[F.lit(sum(parts[:c])).cast("long") for c in range(len(parts))]), at)
    count = F.element_at(F.array(*[F.lit(n).cast("long") for n in parts]), at)
    return measured.withColumn("block", first + F.pmod(F.xxhash64("vec_id"), count)).drop("cell"), sum(parts)


def _meet(rows: DataFrame, blocks: int, anchors: DataFrame, of: Callable, schema: str, anchor_block: int) -> DataFrame:
    """Every block of candidates with every block of anchors, a stated query set; ``of`` makes the rows of ``schema``."""
    parts = max(1, -(-anchors.count() // anchor_block))
    left = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = anchors.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    )

    def meet(found: pa.Table, asked: pa.Table) -> pa.Table:
        if not found.num_rows or not asked.num_rows:
            made = []
        else:
            size = max(max(map(len, t.column("q").to_pylist())) for t in (found, asked))
            made = list(of(_block(found, size), _block(asked, size), asked))
        names = [f.split()[0] for f in schema.split(", ")]
        return pa.table({n: pa.array([r[i] for r in made], pa.int64()) for i, n in enumerate(names)})

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(meet, schema)


def _block(rows: pa.Table, size: int) -> Block:
    ids, labels, norms = (rows.column(c).to_numpy() for c in ("vec_id", "label", "norm"))
    return Block(ids, labels, padded(rows.column("q").to_pylist(), size), norms, _angles(rows))


def _angles(rows: pa.Table) -> np.ndarray:
    return np.array(rows.column("angles").to_pylist(), np.float64)


def mined(
    vectors: DataFrame, label: Column, anchor_divisor: int = ANCHOR_DIVISOR, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT, id_name: str = "vec_id", vector_name: str = "embedding",
    candidate_block: int = CANDIDATE_BLOCK, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose id is divisible by ``anchor_divisor``. Positives
    are an anchor's ``positives`` best other rows of its label; for each, the
    ``negatives`` best rows of other labels whose score is ``low_percent`` to
    ``high_percent`` of the positive's. Scores are inner products of the integer
    components, ties go to smaller ids. Rows with a NULL id, label, vector or
    component, or one that is not finite, take no part; a component that does not
    fit 64 bits is an error, as is a score of the result. An id counts once, by its
    smallest label and vector. Shorter vectors are filled up with zeros. Of equal
    vectors of a label only so many of the smallest ids can be in a result, and
    only these are candidates. Anchors without positives, positives without
    negatives and empty tables give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    stored = stage(spark, quantised(vectors, label, id_name, vector_name), "labelled_vectors")
    rows, blocks = indexed(stored, candidate_block)
    nth = F.row_number().over(Window.partitionBy("q", "label").orderBy("vec_id"))
    most = max(positives + 1, negatives)
    candidates = stage(spark, rows.withColumn("_nth", nth).where(F.col("_nth") <= most).drop("_nth"), "distinct_vectors")
    anchors = rows.where(F.col("vec_id") % anchor_divisor == 0).drop("block")

    near = _meet(
        candidates, blocks, anchors, lambda block, own, asked: positives_of(block, own, _angles(asked), positives),
        "anchor_id long, positive_id long, positive_score long", anchor_block,
    )
    best = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = stage(spark, near.withColumn("_place", best).where(F.col("_place") <= positives).drop("_place"), "positives")

    windows = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score")).alias("asked"))
    far = _meet(
        candidates, blocks, anchors.join(windows, "vec_id"),
        lambda block, own, asked: negatives_of(block, own, _angles(asked), asked.column("asked").to_pylist(), negatives, low_percent, high_percent),
        "anchor_id long, positive_score long, negative_id long, negative_score long", anchor_block,
    )
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    kept = far.withColumn("rank", place).where(F.col("rank") <= negatives)
    return chosen.join(kept, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
