"""Mixing sources to target weights by hierarchical budgets.

Documents form a tree of domains, languages and sources. A token budget goes down
the tree in proportion to the weights of siblings; what a node cannot use, since
its documents repeated for all allowed epochs hold fewer tokens, goes to its
siblings first and to the siblings of its ancestors only after that. A leaf takes
whole epochs, and of one more epoch, in an order seeded by the epoch, the longest
prefix of documents that its budget holds.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from areapulse.llm.common import WORDS
from areapulse.session import stage

LEVELS = ("domain", "lang", "source")
MAX_EPOCHS = 4
SEED = 11
#: Leaves come to the driver, where the budget is dealt out; a table with more is refused.
MAX_LEAVES = 1_000_000
BUCKET_ROWS = 4_096
Path = tuple[str | None, ...]

#: Production weights; a node that is not named has weight 1 among its siblings.
WEIGHTS: dict[Path, float] = {
    ("even",): 0.6, ("odd",): 0.4,
    ("even", "en"): 0.4, ("even", "de"): 0.2, ("even", "fr"): 0.2, ("even", "es"): 0.2,
    ("odd", "en"): 0.25, ("odd", "de"): 0.25, ("odd", "fr"): 0.25, ("odd", "es"): 0.25,
    ("even", "en", "src0"): 4.0,
}


def word_count(text: str = "text") -> Column:
    """Words of a text as its tokens; none for NULL."""
    return F.coalesce(F.size(F.split(F.regexp_replace(F.col(text), f"{WORDS}", "x"), "x")) - 1, F.lit(0)).cast("long")


def source_domain(source: str = "source") -> Column:
    """The domain of a source: whether its number is even or odd; ``other`` without a number."""
    number = F.try_to_number(F.regexp_extract(F.col(source), r"(\d{1,9})$", 1), F.lit("999999999"))
    return F.when(number.isNull(), "other").when(number % 2 == 0, "even").otherwise("odd")


def share_out(budget: int, weights: list[float], capacities: list[int]) -> list[int]:
    """Whole tokens in proportion to the weights, none above its capacity; what full ones leave goes to the others in proportion."""
    budget = min(budget, sum(capacities))
    given = [0.0] * len(weights)
    free, left = {i for i, (w, c) in enumerate(zip(weights, capacities, strict=True)) if w > 0 and c > 0}, float(budget)
    while free and left > 1e-9:
        unit = left / math.fsum(weights[i] for i in free)
        full = [i for i in free if given[i] + unit * weights[i] >= capacities[i]]
        for i in full or list(free):
            take = capacities[i] - given[i] if full else unit * weights[i]
            given[i] += take
            left -= take
        free -= set(full)
        if not full:
            break
    whole = [min(math.floor(g + 1e-9), c) for g, c in zip(given, capacities, strict=True)]
    rest = min(budget, round(math.fsum(given))) - sum(whole)
    for i in sorted(range(len(given)), key=lambda i: (whole[i] - given[i], i)):
        if rest > 0 and whole[i] < capacities[i] and given[i] > 0:
            whole[i] += 1
            rest -= 1
    return whole


def budgets(leaves: Mapping[Path, int], weights: Mapping[Path, float], budget: int, max_epochs: int = MAX_EPOCHS) -> dict[Path, int]:
    """The tokens that each leaf gives, from the tokens that it has."""
    capacity: dict[Path, int] = defaultdict(int)
    children: dict[Path, set[Path]] = defaultdict(set)
    for path, tokens in leaves.items():
        for depth in range(len(path) + 1):
            capacity[path[:depth]] += tokens * max_epochs
            if depth:
                children[path[: depth - 1]].add(path[:depth])
    given = {(): min(budget, capacity[()])}
    order = [()]
    for node in order:
        below = sorted(children[node], key=repr)
        parts = share_out(given[node], [weights.get(c, 1.0) for c in below], [capacity[c] for c in below])
        given.update(zip(below, parts, strict=True))
        order += [c for c in below if len(c) < max(map(len, leaves))]
    return {path: given[path] for path in leaves}


def _key(epoch: Column | int, seed: int) -> Column:
    """A document's place in an epoch, as 63 bits."""
    epoch = epoch if isinstance(epoch, Column) else F.lit(epoch)
    return F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), epoch.cast("long"), F.lit(seed).cast("long")), 1)


def _same(a: DataFrame, b: DataFrame, levels: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for level in levels:
        out = out & a[level].eqNullSafe(b[f"_{level}"])
    return out


def plan(
    sized: DataFrame, weights: Mapping[Path, float] = WEIGHTS, budget: int | None = None, max_epochs: int = MAX_EPOCHS,
    seed: int = SEED, levels: tuple[str, ...] = LEVELS, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per leaf: ``_<level>`` columns, whole ``_epochs``, and ``_cutoff``, the largest key of the epoch after them (-1: none).

    ``sized`` is a stored table with ``doc_id``, the levels and ``n_tokens``. The
    budget defaults to the tokens of the table. A leaf's order is cut into
    buckets of keys, whose token sums tell in which bucket the budget ends; only
    that bucket is added up row by row. NULL level values are leaves of their own.
    """
    spark = sized.sparkSession
    leaves = sized.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")).limit(MAX_LEAVES + 1).collect()
    if len(leaves) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves")
    tokens = {tuple(r[level] for level in levels): r["tokens"] for r in leaves}
    given = budgets(tokens, weights, sum(tokens.values()) if budget is None else budget, max_epochs) if tokens else {}
    rows = [(*path, given[path] // tokens[path], given[path] % tokens[path]) for path in tokens if tokens[path] > 0]
    fields = ", ".join(f"_{f.name} {f.dataType.simpleString()}" for f in sized.select(*levels).schema)
    dealt = spark.createDataFrame(rows, f"{fields}, _epochs long, _rest long")

    # 2^bits buckets, so that a leaf of all rows still has buckets of about bucket_rows
    bits = max(0, math.ceil(math.log2(max(1, sum(r["rows"] for r in leaves)) / bucket_rows)))
    keyed = sized.join(dealt, _same(sized, dealt, levels)).where("_rest > 0").select(
        *[f"_{level}" for level in levels], "_rest", _key(F.col("_epochs"), seed).alias("_key"), "n_tokens"
    ).withColumn("_bucket", F.shiftright("_key", 63 - bits) if bits else F.lit(0).cast("long"))
    keyed = stage(spark, keyed, "mix_keys")
    leaf = [f"_{level}" for level in levels]
    whole = Window.partitionBy(*leaf).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = keyed.groupBy(*leaf, "_rest", "_bucket").agg(F.sum("n_tokens").alias("_sum")).withColumn("_upto", F.sum("_sum").over(whole))
    last = sums.where("_upto > _rest and _upto - _sum <= _rest").select(*leaf, "_bucket", (F.col("_upto") - F.col("_sum")).alias("_before"))
    last = last.withColumnsRenamed({c: f"_l{c}" for c in [*leaf, "_bucket"]})
    in_last = keyed.join(last, _same_columns(keyed, last, [*leaf, "_bucket"]))
    one = in_last.groupBy(*leaf, "_bucket", "_rest", "_before", "_key").agg(F.sum("n_tokens").alias("_sum"))
    within = Window.partitionBy(*leaf, "_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = one.withColumn("_upto", F.col("_before") + F.sum("_sum").over(within)).where("_upto <= _rest")
    cut = fits.groupBy(*leaf).agg(F.max("_key").alias("_cut_row"))
    # no row of the last bucket fits: everything before the bucket
    starts = last.select(*[F.col(f"_l{c}").alias(c) for c in leaf], (F.shiftleft(F.col("_l_bucket"), 63 - bits) - 1 if bits else F.lit(-1).cast("long")).alias("_cut_start"))
    ends = starts.withColumnsRenamed({c: f"_e{c}" for c in leaf})
    cut = cut.withColumnsRenamed({c: f"_c{c}" for c in leaf})
    out = dealt.join(ends, _same_columns(dealt, ends, leaf, "_e"), "left").join(cut, _same_columns(dealt, cut, leaf, "_c"), "left")
    return stage(
        spark, out.select(*leaf, "_epochs", F.coalesce("_cut_row", "_cut_start", F.lit(-1).cast("long")).alias("_cutoff")), "mix_plan"
    )


def _same_columns(a: DataFrame, b: DataFrame, names: list[str], prefix: str = "_l") -> Column:
    out = F.lit(True)
    for name in names:
        out = out & a[name].eqNullSafe(b[f"{prefix}{name}"])
    return out


def mixed(docs: DataFrame, leaf_plan: DataFrame, seed: int = SEED, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """``docs`` (with ``doc_id`` and the levels) once per epoch it is taken in, with its ``epoch`` from 0.

    Rows of one ``doc_id`` in one leaf are taken or left together, and so are ids
    whose keys tie. Leaves without tokens give no rows, nor does an empty table.
    Columns of any name go along, without a shuffle of their own; one named
    ``epoch`` is replaced.
    """
    names = [c for c in docs.columns if c != "epoch"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "doc_id", *[F.col(f"`{c}`") for c in levels])
    joined = rows.join(leaf_plan, _same(rows, leaf_plan, levels))
    taken = F.col("_epochs") + (_key(F.col("_epochs"), seed) <= F.col("_cutoff")).cast("long")
    epochs = F.when(taken > 0, F.sequence(F.lit(0).cast("long"), taken - 1)).otherwise(F.array().cast("array<long>"))
    return joined.select("_row", F.explode(epochs).alias("_epoch")).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in names], F.col("_epoch").cast("int").alias("epoch")
    )


def sized_leaves(docs: DataFrame) -> DataFrame:
    """The stored table of ids, levels and tokens that the plan is made from."""
    sized = docs.select("doc_id", source_domain().alias("domain"), "lang", "source", word_count().alias("n_tokens"))
    return stage(docs.sparkSession, sized, "mix_sizes")
