"""Configuration tables.

``configurations``: id, tenant, server_no (null = tenant-wide), config_type,
config_key, config_value (plain, CSV or JSON text), is_active, updated_at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Default roll-up method per resource.
DEFAULT_ROLLUP = [("cpu", "max"), ("mem", "last"), ("disk", "last")]
# The configuration types the setup check counts.
KNOWN_CONFIG_TYPES = ["time_alignment", "collection", "aggregation", "excluded", "model", "alert"]

CONFIG_KEY = ["tenant", "config_type", "config_key"]


# W9 ------------------------------------------------------------------------
def effective_config(cfg: DataFrame, defaults: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Newest active row (highest id) per (tenant, type, key); ``defaults`` fill absent keys.

    ``defaults`` are (config_type, config_key, value) constants: each tenant
    seen in the table gets them through a generator (no join with a
    constant table), and an anti join keeps the configured rows first.
    Default rows carry a null id.
    """
    act = cfg.where(F.col("is_active"))
    eff = act.groupBy(*CONFIG_KEY).agg(F.max_by("config_value", "id").alias("config_value"),
                                       F.max("id").alias("id"))
    if not defaults:
        return eff
    arr = F.array(*[F.struct(F.lit(t).alias("config_type"), F.lit(k).alias("config_key"),
                             F.lit(v).alias("config_value")) for t, k, v in defaults])
    dflt = cfg.select("tenant").distinct().select("tenant", F.inline(arr)) \
              .join(eff.select(*CONFIG_KEY), CONFIG_KEY, "left_anti")
    return eff.unionByName(dflt.withColumn("id", F.lit(None).cast("long")))


# X2 ------------------------------------------------------------------------
def decode_aggregation_config(cfg: DataFrame) -> DataFrame:
    """Aggregation rows: JSON object -> (method, reason); plain text -> method."""
    eff = effective_config(cfg).where(F.col("config_type") == "aggregation")
    is_json = F.startswith(F.col("config_value"), F.lit("{"))
    parsed = F.from_json(F.when(is_json, F.col("config_value")), "method string, reason string")
    method = F.when(is_json, F.coalesce(parsed.getField("method"), F.col("config_value"))).otherwise(F.col("config_value"))
    return eff.select("tenant", F.col("config_key").alias("resource_type"), method.alias("method"),
                      F.when(is_json, parsed.getField("reason")).alias("reason"))


# X3 ------------------------------------------------------------------------
UPSERT_KEY = ["tenant", "server_no", "config_type", "config_key"]


def upsert_config(cfg: DataFrame, changes: DataFrame) -> DataFrame:
    """New version of the table: a change replaces the row with the same key, else is added.

    The key compares a null ``server_no`` equal to another null (``<=>``
    semantics via ``coalesce`` to a sentinel in the window key).  The kept row
    keeps the old ``id`` when one exists.
    """
    old = cfg.withColumn("_src", F.lit(0))
    new = changes.select(*cfg.columns).withColumn("_src", F.lit(1))
    u = old.unionByName(new)
    w = Window.partitionBy("tenant", F.coalesce(F.col("server_no"), F.lit(-1)), "config_type", "config_key")
    ranked = (u.withColumn("_has", F.max("_src").over(w))
               .withColumn("_old_id", F.min(F.when(F.col("_src") == 0, F.col("id"))).over(w))
               .withColumn("_rn", F.row_number().over(w.orderBy(F.col("_src").desc(), F.col("id").desc()))))
    # keys without a change keep all their rows; a changed key keeps the change only
    out = ranked.where((F.col("_has") == 0) | (F.col("_rn") == 1))
    out = out.withColumn("id", F.when(F.col("_src") == 1, F.coalesce("_old_id", "id")).otherwise(F.col("id")))
    return out.select(*cfg.columns)


# A22 -----------------------------------------------------------------------
def config_gate(cfg: DataFrame, min_rows: int = 5) -> DataFrame:
    """Rows among the known configuration types; valid if at least ``min_rows``."""
    g = cfg.where(F.col("config_type").isin(KNOWN_CONFIG_TYPES)).agg(F.count(F.lit(1)).alias("n_rows"))
    return g.select("n_rows", (F.col("n_rows") >= min_rows).alias("config_ok"))
