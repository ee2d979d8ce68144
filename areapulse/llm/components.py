"""Connected components of links by repeated contraction, with every step written to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from areapulse.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``links`` (a, b).

    Each round hooks every node onto its smallest neighbour, follows such hooks
    to their end by doubling, and contracts the links to the nodes reached. What
    is left shrinks with every round; nothing is collected. Hub nodes only take
    part in minima, which are combined before the shuffle, and in joins whose
    large side can be split. Links of a node with itself and repeated links are
    allowed; NULL nodes are left out.
    """
    spark = links.sparkSession
    left = stage(spark, links.where("a <> b").select("a", "b").distinct(), "links")
    hooks = None
    while left.limit(1).count():
        both = left.union(left.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
        hook = stage(spark, hook, "hooks")
        while True:
            above = hook.select(F.col("node").alias("root"), F.col("root").alias("_above"))
            jumped = hook.join(above, "root").select("node", F.col("_above").alias("root"), (F.col("_above") != F.col("root")).alias("_moved"))
            jumped = stage(spark, jumped, "hooks")
            hook = jumped.select("node", "root")
            if not jumped.where("_moved").limit(1).count():
                break
        to_a = hook.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
        to_b = hook.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
        contracted = left.join(to_a, "a").join(to_b, "b").where("_ra <> _rb")
        left = stage(spark, contracted.select(F.col("_ra").alias("a"), F.col("_rb").alias("b")).distinct(), "links")
        if hooks is None:
            hooks = hook
        else:
            later = hook.select(F.col("node").alias("root"), F.col("root").alias("_later"))
            hooks = stage(spark, hooks.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root")), "roots")
    if hooks is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return hooks
