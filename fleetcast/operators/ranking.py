"""Top-k and ordering operators (T1, T5) and required-set checks.

Top-k per group is a ``row_number`` window partitioned by the group, so it
never gathers more than one group in a task; a global top-k uses
``orderBy().limit()``, which Spark plans as a per-partition top-k merged on
the driver (k rows per partition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = ["tenant", "device_id"]
REQUIRED_RESOURCES = ["cpu", "mem", "disk"]


# T1 ------------------------------------------------------------------------
def top_features(importance: DataFrame, model_keys: Sequence[str], k: int = 10,
                 feature: str = "feature_name", score: str = "importance") -> DataFrame:
    """The ``k`` most important features per model (ties by name)."""
    w = Window.partitionBy(*model_keys).orderBy(F.col(score).desc(), F.col(feature))
    return importance.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


# T5 ------------------------------------------------------------------------
def active_tenants(registry: DataFrame, k: int = 5, preferred: str | None = None) -> DataFrame:
    """First ``k`` active tenants by registration time, the preferred one first."""
    pref = F.when(F.col("tenant") == F.lit(preferred), 0).otherwise(1) if preferred else F.lit(1)
    top = (registry.where(F.col("is_active")).select("tenant", "registered_at", pref.alias("_p"))
           .orderBy("_p", "registered_at", "tenant").limit(k))
    w = Window.orderBy("_p", "registered_at", "tenant")  # at most k rows
    return top.select("tenant", "registered_at", F.row_number().over(w).cast("long").alias("rank"))


# U3 ------------------------------------------------------------------------
def missing_resources(res: DataFrame) -> DataFrame:
    """Required resources not seen per entity (empty text when complete)."""
    seen = res.groupBy(*K).agg(F.collect_set("resource_type").alias("_seen"))
    miss = F.array_except(F.array(*[F.lit(r) for r in REQUIRED_RESOURCES]), F.col("_seen"))
    return seen.select(*K, F.array_join(miss, ",").alias("missing"))
