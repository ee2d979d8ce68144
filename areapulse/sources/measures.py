"""The stored advanced measures, refreshed for what a change of the facts touches."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from areapulse.operators.candidates import advanced, advanced_input
from areapulse.operators.rollups import LEVELS, monthly, with_levels
from areapulse.session import stage
from areapulse.sources.versions import VersionedTables

LABEL = ["level", "spatial_label"]
ADVANCED = StructType()
for _name in LABEL:
    ADVANCED = ADVANCED.add(_name, "string")
for _name in ("corr_sales_foot_traffic", "sales_impact_slope", "sales_impact_score", "foot_traffic_impact_score"):
    ADVANCED = ADVANCED.add(_name, "double")
BUCKETS = 64


class MeasureStore:
    """Advanced measures by level and label below one root, in versions and in buckets of labels."""

    def __init__(self, spark: SparkSession, root: str, levels: tuple[str, ...] = LEVELS):
        self.spark, self.levels, self.tables = spark, levels, VersionedTables(spark, root)

    def read(self) -> DataFrame:
        """The measures of the newest version; a refresh does not disturb a reader that has begun."""
        return self.tables.read("advanced", ADVANCED)

    def touched(self, gold, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Levels and labels that keys of ``changed`` belong to, and all keys of these labels."""
        keys = monthly(gold.activity).select("spatial_key").union(changed.select("spatial_key")).distinct()
        named = stage(self.spark, with_levels(keys, gold.dim, gold.admin_sig, self.levels).select("spatial_key", *LABEL), "label_keys")
        labels = stage(self.spark, named.join(changed.select("spatial_key").distinct(), "spatial_key", "left_semi").select(*LABEL).distinct(), "touched_labels")
        return labels, named.join(labels, LABEL, "left_semi").select("spatial_key").distinct()

    def refresh(self, gold, changed: DataFrame | None = None) -> int:
        """Compute the measures of the labels that ``changed`` keys belong to anew, all by default; the number of buckets written.

        Facts of other labels are not added up, and buckets without a touched label
        are neither read nor written. Labels of which no facts are left go.
        """
        base = self.tables.version()
        if changed is None or not base.number:
            rows, buckets, old = advanced(advanced_input(gold, self.levels)), None, None
        else:
            labels, keys = self.touched(gold, changed)
            facts = replace(gold, activity=gold.activity.join(keys, "spatial_key", "left_semi"))
            rows = advanced(advanced_input(facts, self.levels)).join(labels, LABEL, "left_semi")
            buckets = [r["_bucket"] for r in labels.select(self._bucket().alias("_bucket")).distinct().collect()]
            old = self.tables.read("advanced", ADVANCED, base, buckets).join(labels, LABEL, "left_anti")
        rows = rows.select(*ADVANCED.names)
        rows = rows if old is None else rows.unionByName(old)
        written = self.tables.write("advanced", rows.withColumn("_bucket", self._bucket()).repartition("_bucket"), "_bucket")
        stale = base.parts.get("advanced", {}) if buckets is None else buckets
        self.tables.publish(base, {"advanced": {**dict.fromkeys(stale), **written}})
        return len(written)

    @staticmethod
    def _bucket():
        return F.pmod(F.xxhash64(*LABEL), F.lit(BUCKETS)).cast("string")
