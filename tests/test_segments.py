"""Scans in chunks of time give what one window over the whole key gives, and a hot key is spread over its chunks."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetcast.operators import features as FT
from fleetcast.operators import segments as SG
from fleetcast.operators import series as SE
from fleetcast.operators.clean import complete_rows

T0 = dt.datetime(2024, 1, 1)
HOUR_US = 3_600_000_000
K = ["tenant", "device_id"]


@pytest.fixture(scope="module")
def rows(spark):
    """A long key with gaps of several chunks, short ones, a null key; values with nulls at chunk borders."""
    rng = random.Random(3)
    out = []
    for device, n, step in (("long", 900, 7), ("short", 5, 1), (None, 60, 13), ("one", 1, 1)):
        for i in range(n):
            if device == "long" and 300 < i < 400:
                continue  # eleven hours without a row
            t = T0 + dt.timedelta(minutes=i * step)
            empty = rng.random() < 0.6 or (device == "long" and 100 < i < 180)
            out.append(("t", device, "s", t, None if empty else float(rng.randrange(50))))
    return spark.createDataFrame(out, "tenant string, device_id string, metric string, time timestamp, value double")


def table(df, *cols):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=key)


@pytest.mark.parametrize("chunk", [HOUR_US, 5 * HOUR_US, SG.DAY_US, 400 * SG.DAY_US])
def test_numbers_and_fills_over_chunks(rows, chunk):
    whole = Window.partitionBy(*K)
    expected = rows.select("*", (F.row_number().over(whole.orderBy("time")) - 1).alias("_i"), F.count(F.lit(1)).over(whole).alias("_n"))
    cols = [*K, "time", "_i", "_n"]
    assert table(SG.numbered(rows, K, "time", chunk), *cols) == table(expected, *cols)
    upto = whole.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    cols = [*K, "time", "value", "other"]
    two = rows.withColumn("other", F.when(F.minute("time") % 5 == 0, F.lit("x")))
    expected = two.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in ("value", "other")})
    assert table(SG.carried(two, K, "time", ["value", "other"], chunk), *cols) == table(expected, *cols)


@pytest.mark.parametrize("chunk", [HOUR_US, 3 * HOUR_US, SG.DAY_US])
def test_moving_frames_over_chunks(rows, chunk):
    """Frames that reach over a chunk's border see the rows before it."""
    full = rows.where("value is not null")
    names = [f"{s}_{w}" for w in (5, 60) for s in ("mean", "std", "max", "min")]
    expected = full.select(*K, "time", *SE.rolling_columns([*K, "metric"], [5, 60], ["mean", "std", "max", "min"], "time", "value"))
    got = SE.rolling_stats(full, ["metric"], [5, 60], chunk_us=chunk)
    rounded = [F.round(n, 9).alias(n) for n in names]
    assert table(got.select(*K, "time", *rounded), *K, "time", *names) == table(expected.select(*K, "time", *rounded), *K, "time", *names)
    with pytest.raises(ValueError):
        SE.rolling_stats(full, ["metric"], [120], chunk_us=HOUR_US)


@pytest.mark.parametrize("chunk", [HOUR_US, SG.DAY_US])
def test_features_over_chunks(spark, chunk):
    """P8, W1 and A11 inside chunks are the plain chain over the whole application."""
    rng = random.Random(5)
    app = [("t", "d", a, T0 + dt.timedelta(minutes=i), m, float(rng.randrange(90))) for a in ("a", "b") for i in range(0, 400)
           for m in ("x", "y") if not (a == "b" and m == "y" and i % 3 == 0)]
    df = spark.createDataFrame(app, "tenant string, device_id string, application string, time timestamp, metric_type string, value double")
    full = complete_rows(df, [*K, "application"], "metric_type")
    assert full.count() == 2 * 400 + 2 * 266
    wide = full.select("*", *SE.rolling_columns([*K, "application", "metric_type"], [5, 60], ["mean", "min"], "time", "value"))
    last = wide.groupBy("application", "metric_type", F.window("time", "5 minutes").start.alias("time")).agg(F.max_by("mean_60", "time").alias("v"))
    expected = table(last, "application", "metric_type", "time", F.round("v", 9))
    got = FT.rolling_features(df, [5, 60], ["mean", "min"], chunk_us=chunk).where(F.col("feature_name").endswith("_mean_60min"))
    assert table(got.withColumn("metric_type", F.split("feature_name", "_")[0]), "application", "metric_type", "time", F.round("value", 9)) == expected


def shares(df):
    """Rows of the hot key in each task of ``df``, without coalescing and with joins as large tables have them."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = df.where("device_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return sorted((r["count"] for r in found), reverse=True)


def test_a_hot_key_is_many_tasks(spark):
    """One application holds half of all rows over sixty days: no task of these operators has more than a third of it."""
    minute = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60)
    hot = spark.range(0, 86_400, 4).select(minute.alias("time"), F.lit("hot").alias("device_id"))
    rest = spark.range(0, 21_600).select(minute.alias("time"), F.concat(F.lit("d"), (F.col("id") % 40).cast("string")).alias("device_id"))
    df = hot.unionByName(rest).select(F.lit("t").alias("tenant"), "device_id", "time", F.lit("a").alias("application"),
                                      F.explode(F.array(F.lit("x"), F.lit("y"))).alias("metric_type"), F.minute("time").cast("double").alias("value"))
    one = df.where("metric_type = 'x'")
    for name, out in {"p8": complete_rows(df, [*K, "application"], "metric_type"), "w1": SE.rolling_stats(one, ["application"], [5]),
                      "w2": FT.rolling_features(df, [5], ["mean"]), "w5": SG.carried(one, K, "time", ["value"]),
                      "w11": SE.chrono_split(one, K, "time"), "w12": SE.ts_folds(one, K, "time", 2)}.items():
        found = shares(out)
        assert len(found) >= 4 and found[0] <= sum(found) / 3, (name, found)
