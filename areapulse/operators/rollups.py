"""Monthly trends, year-on-year, shares and totals over the fact tables.

Facts are summed per key before names are attached, so that a join never moves
more rows than there are (key, date) pairs, and no side is broadcast by hand:
Spark does that itself where the measured size allows it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from areapulse.functions.numbers import change, ratio
from areapulse.schemas import MEASURES

LEVELS = ("norm", "sig", "sido")


def _sums(*columns: str) -> list:
    return [F.sum(c).alias(c) for c in columns]


def monthly(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("granularity") == "month")


def monthly_trend(activity: DataFrame) -> DataFrame:
    """Measures per key and month, over all sources."""
    return monthly(activity).groupBy("spatial_key", "date").agg(*_sums(*MEASURES))


def top_spatial(activity: DataFrame) -> DataFrame:
    """Foot traffic and sales per month and key."""
    return monthly(activity).groupBy("date", "spatial_key").agg(*_sums("foot_traffic", "sales"))


def year_on_year(activity: DataFrame) -> DataFrame:
    """Each month against the same calendar month one year earlier."""
    current = monthly(activity).groupBy("spatial_key", "date").agg(*_sums("foot_traffic", "sales"))
    previous = current.select(
        F.col("spatial_key").alias("_previous_key"),
        F.col("date").alias("_previous_date"),
        F.col("foot_traffic").alias("foot_traffic_prev_year"),
        F.col("sales").alias("sales_prev_year"),
    )
    same_month = (F.col("spatial_key") == F.col("_previous_key")) & (
        F.add_months("date", -12) == F.col("_previous_date")
    )
    return current.join(previous, same_month, "left").select(
        "spatial_key",
        "date",
        "foot_traffic",
        "foot_traffic_prev_year",
        change(F.col("foot_traffic"), F.col("foot_traffic_prev_year")).alias("foot_traffic_yoy"),
        "sales",
        "sales_prev_year",
        change(F.col("sales"), F.col("sales_prev_year")).alias("sales_yoy"),
    )


def group_totals(demographics: DataFrame) -> DataFrame:
    """Each value with the total of its (key, month, source).

    The window holds one row per sex and age group, so it stays small however
    many records a place has.
    """
    total = F.sum("value").over(Window.partitionBy("spatial_key", "date", "source"))
    return monthly(demographics).select("spatial_key", "date", "source", "sex", "age_group", "value", total.alias("total_value"))


def demographic_share(demographics: DataFrame) -> DataFrame:
    """Share of each sex and age group in its (key, month, source) total."""
    return group_totals(demographics).withColumn("share", ratio(F.col("value"), F.col("total_value"))).drop("total_value")


def named_by_dim(facts: DataFrame, dim: DataFrame, dedupe: bool = True) -> DataFrame:
    """Attach label and type, by key first and by equal label second.

    With ``dedupe`` one dimension row answers a label; without it every
    dimension row of that label repeats the fact, as a plain join would.
    """
    by_key = dim.select(
        "spatial_key", F.col("spatial_label").alias("_key_label"), F.col("spatial_type").alias("_key_type")
    )
    by_label = dim.where(F.col("spatial_label").isNotNull()).select(
        F.col("spatial_label").alias("_label"), F.col("spatial_type").alias("_label_type"), "spatial_key"
    )
    if dedupe:
        by_label = by_label.groupBy("_label").agg(F.min_by("_label_type", "spatial_key").alias("_label_type"))
    else:
        by_label = by_label.drop("spatial_key")
    return (
        facts.join(by_key, "spatial_key", "left")
        .join(by_label, F.col("spatial_key") == F.col("_label"), "left")
        .select(
            *facts.columns,
            F.coalesce("_key_label", "_label", "spatial_key").alias("spatial_label"),
            F.coalesce("_key_type", "_label_type").alias("spatial_type"),
        )
    )


def trend_norm(activity: DataFrame, dim: DataFrame, dedupe: bool = True) -> DataFrame:
    """Monthly trend per normalised label."""
    return (
        named_by_dim(monthly_trend(activity), dim, dedupe)
        .groupBy("spatial_label", "spatial_type", "date")
        .agg(*_sums(*MEASURES))
    )


def trend_emd(activity: DataFrame, dim: DataFrame, dedupe: bool = True) -> DataFrame:
    """Monthly trend of the smallest administrative units only."""
    return trend_norm(activity, dim, dedupe).where(F.col("spatial_type") == "emd")


def named_by_admin(facts: DataFrame, dim: DataFrame, admin_sig: DataFrame, level: str) -> DataFrame:
    """Attach the district or province name: by code, by label, else label or key."""
    name = f"{level}_name"
    labels = dim.select("spatial_key", F.col("spatial_label").alias("_label"), "code")
    by_code = admin_sig.select(F.col("sig_code").alias("_sig_code"), F.col(name).alias("_name_by_code"))
    by_name = admin_sig.groupBy(F.col("sig_name").alias("_sig_name")).agg(
        F.min_by(name, "sig_code").alias("_name_by_label")
    )
    return (
        facts.join(labels, "spatial_key", "left")
        .join(by_code, F.substring("code", 1, 5) == F.col("_sig_code"), "left")
        .join(by_name, F.col("_label") == F.col("_sig_name"), "left")
        .select(
            *facts.columns,
            F.coalesce("_name_by_code", "_name_by_label", "_label", "spatial_key").alias("spatial_label"),
        )
    )


def trend_admin(
    activity: DataFrame, dim: DataFrame, admin_sig: DataFrame, level: str, dedupe: bool = True
) -> DataFrame:
    """Monthly trend rolled up to districts (``sig``) or provinces (``sido``).

    ``dedupe=False`` gives the sums of a roll-up that pairs all source rows of a
    (key, month) with each other; see :func:`_repeated_names`.
    """
    if dedupe:
        named = named_by_admin(monthly_trend(activity), dim, admin_sig, level)
    else:
        named = _repeated_names(activity, dim, admin_sig, level)
    return (
        named.groupBy("spatial_label", F.lit(level).alias("spatial_type"), "date").agg(*_sums(*MEASURES))
    )


def _repeated_names(activity: DataFrame, dim: DataFrame, admin_sig: DataFrame, level: str) -> DataFrame:
    """Facts weighted by how often a (key, date) self join would repeat them.

    A row is repeated once per source row of its (key, date) and once more per
    district of the same name; the weight is counted, the pairs are not built.
    """
    name = f"{level}_name"
    labels = dim.select("spatial_key", F.col("spatial_label").alias("_label"), "code")
    per_key = (
        monthly(activity)
        .groupBy("spatial_key", "date")
        .agg(*_sums(*MEASURES), F.count(F.lit(1)).alias("_rows"))
        .join(labels, "spatial_key", "left")
    )
    by_code = admin_sig.select(F.col("sig_code").alias("_sig_code"), F.col(name).alias("_name_by_code"))
    by_name = admin_sig.groupBy(F.col("sig_name").alias("_sig_name"), F.col(name).alias("_name_by_label")).agg(
        F.count(F.lit(1)).alias("_matches")
    )
    weight = F.col("_rows") * F.coalesce("_matches", F.lit(1))
    return (
        per_key.join(by_code, F.substring("code", 1, 5) == F.col("_sig_code"), "left")
        .join(by_name, F.col("_label") == F.col("_sig_name"), "left")
        .select(
            "date",
            *[(F.col(m) * weight).alias(m) for m in MEASURES],
            F.coalesce("_name_by_code", "_name_by_label", "_label", "spatial_key").alias("spatial_label"),
        )
    )


def trend(gold, level: str, dedupe: bool | None = None) -> DataFrame:
    """Monthly trend at ``norm``, ``emd``, ``sig`` or ``sido``.

    Without ``dedupe`` the tables decide how names that fan out are treated.
    """
    if dedupe is None:
        dedupe = getattr(gold, "dedupe", True)
    if level in ("norm", "emd"):
        rolled = trend_norm(gold.activity, gold.dim, dedupe)
        return rolled.where(F.col("spatial_type") == "emd") if level == "emd" else rolled
    if level in ("sig", "sido"):
        return trend_admin(gold.activity, gold.dim, gold.admin_sig, level, dedupe)
    raise ValueError("level must be one of: norm, emd, sig, sido")


def level_names(dim: DataFrame, admin_sig: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """``spatial_key`` of every dimension row, and ``names``: its label and type at each level."""
    by_code = admin_sig.select(F.col("sig_code").alias("_sig_code"), *[F.col(f"{n}_name").alias(f"_{n}_by_code") for n in ("sig", "sido")])
    by_name = admin_sig.groupBy(F.col("sig_name").alias("_sig_name")).agg(
        *[F.min_by(f"{n}_name", "sig_code").alias(f"_{n}_by_label") for n in ("sig", "sido")]
    )
    rows = (
        dim.select("spatial_key", F.col("spatial_label").alias("_label"), F.col("spatial_type").alias("_type"), "code")
        .join(by_code, F.substring("code", 1, 5) == F.col("_sig_code"), "left")
        .join(by_name, F.col("_label") == F.col("_sig_name"), "left")
    )
    admin = {n: F.coalesce(f"_{n}_by_code", f"_{n}_by_label", "_label", "spatial_key") for n in ("sig", "sido")}
    return rows.select("spatial_key", F.array(*[
        F.struct(
            F.lit(level).alias("level"), (admin[level] if level in admin else F.col("_label")).alias("spatial_label"),
            (F.lit(level) if level in admin else F.col("_type")).alias("spatial_type"),
        )
        for level in levels
    ]).alias("names"))


def with_levels(facts: DataFrame, dim: DataFrame, admin_sig: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Facts once for each level, with ``level``, label and type; what the dimension does not name is named by its key.

    Names are found per dimension row and met by key in one join, whatever the
    number of levels; a key that is only a label of the dimension takes its type.
    """
    named = level_names(dim, admin_sig, levels)
    by_label = dim.where(F.col("spatial_label").isNotNull()).groupBy(F.col("spatial_label").alias("_as_label")).agg(
        F.min_by("spatial_type", "spatial_key").alias("_label_type")
    )
    unnamed = F.array(*[
        F.struct(
            F.lit(level).alias("level"), F.lit(None).cast("string").alias("spatial_label"),
            F.lit(level if level in ("sig", "sido") else None).cast("string").alias("spatial_type"),
        )
        for level in levels
    ])
    joined = facts.join(named, "spatial_key", "left").join(by_label, F.col("spatial_key") == F.col("_as_label"), "left")
    rows = joined.select(*facts.columns, "_label_type", F.inline(F.coalesce("names", unnamed)))
    out = rows.select(
        *facts.columns, "level", F.coalesce("spatial_label", "spatial_key").alias("spatial_label"),
        F.coalesce("spatial_type", "_label_type").alias("spatial_type"),
    )
    return out.where((F.col("level") != "emd") | (F.col("spatial_type") == "emd"))


def trend_levels(gold, levels: tuple[str, ...] = LEVELS, dedupe: bool | None = None) -> DataFrame:
    """Monthly trends of several levels, told apart by ``level``, from one pass over the facts.

    Where names fan out (``dedupe=False``), each level weights the facts by its
    own names and is rolled up by itself.
    """
    for level in levels:
        if level not in (*LEVELS, "emd"):
            raise ValueError("level must be one of: norm, emd, sig, sido")
    if not (getattr(gold, "dedupe", True) if dedupe is None else dedupe):
        parts = [trend(gold, level, False).withColumn("level", F.lit(level)) for level in levels]
        return reduce(DataFrame.unionByName, parts)
    sums = monthly_trend(gold.activity)
    return with_levels(sums, gold.dim, gold.admin_sig, levels).groupBy("level", "spatial_label", "spatial_type", "date").agg(*_sums(*MEASURES))
