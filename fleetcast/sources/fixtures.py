"""Table loading and fixture views derived from the driver's ``events`` table.

``events`` spans thirty days; its times are compressed 180-fold into four
hours from 2024-01-01 00:00 so the minute-scale defaults meet realistic
density.  Two tagged points are derived from each event (one application
metric, one host resource metric), giving the ``points`` schema.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc

# Fixed values of the fixture derivation.
EPOCH_US = 1704067200000000  # 2024-01-01 00:00:00 UTC
COMPRESSION = 180
NOW = "2024-01-01 04:00:00"
# Deliveries of the streams: so many, of so many minutes of event time each.
ARRIVALS = 3
ARRIVAL_MINUTES = 80
TENANTS = 2
APPS = 3


# Which entities the events are dealt to.  'dense': two devices that saturate their minutes.  'wide': a device for
# every thirty users, so that minute rows grow with the data, and one hot device with a quarter of all points.
_VIEW: ContextVar[str] = ContextVar("fixture_view", default="dense")
HOT_EVERY, USERS_A_DEVICE, WIDE_TENANTS = 4, 30, 7


@contextmanager
def fixture_view(name: str) -> Iterator[None]:
    """Plans built inside see the events through this view."""
    token = _VIEW.set(name)
    try:
        yield
    finally:
        _VIEW.reset(token)


# plans by session; an entry goes with its session
_PLANS: WeakKeyDictionary[SparkSession, dict] = WeakKeyDictionary()


def memo_plan(fn):
    """Build a base view once per (session, directory, arguments).

    Only the logical plan over the files is kept, as a view would keep it:
    every action reads and computes anew.  The list of files is the one found
    first, so a directory whose files change needs a new session.
    """
    def wrapper(spark: SparkSession, sf_dir: str, *args, **kw):
        plans = _PLANS.setdefault(spark, {})
        key = (fn.__module__, fn.__qualname__, sf_dir, _VIEW.get(), args, tuple(sorted(kw.items())))
        if key not in plans:
            plans[key] = fn(spark, sf_dir, *args, **kw)
        return plans[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    wrapper.__wrapped__ = fn
    return wrapper


@memo_plan
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (parquet)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@memo_plan
def events(spark: SparkSession, sf_dir: str, compress: bool = True) -> DataFrame:
    ensure_utc(spark)
    return events_from(read_table(spark, sf_dir, "events"), compress)


def events_stream(spark: SparkSession, sf_dir: str, compress: bool = True) -> DataFrame:
    """The events table as a file stream (same derivation as the batch view)."""
    ensure_utc(spark)
    schema = read_table(spark, sf_dir, "events").schema
    # a glob on the one file: the file source lists it like a directory entry
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(
        os.path.join(sf_dir, "events.parque[t]"))
    return events_from(raw, compress)


def arrival() -> Column:
    """The delivery (0, 1, ...) an event comes with: its third of the range, every eleventh event one later."""
    third = F.floor((F.unix_micros("ts") - F.lit(EPOCH_US)) / F.lit(ARRIVAL_MINUTES * 60_000_000))
    third = F.least(F.greatest(third, F.lit(0)), F.lit(ARRIVALS - 1))
    return F.least(third + F.when(F.col("event_id") % 11 == 0, 1).otherwise(0), F.lit(ARRIVALS - 1)).cast("int")


def deliver(spark: SparkSession, sf_dir: str, repeats: bool = False):
    """(i, folder) -> write the i-th delivery of events there; with ``repeats``, those of every seventh minute come again with the next."""
    def write(i: int, folder: str) -> None:
        ensure_utc(spark)
        came = events(spark, sf_dir).withColumn("arrival", arrival())
        if repeats:
            again = F.when(F.minute("ts") % 7 == 0, F.array("arrival", F.least(F.col("arrival") + 1, F.lit(ARRIVALS - 1)))).otherwise(F.array("arrival"))
            came = came.withColumn("arrival", F.explode(again))
        came.where(F.col("arrival") == i).drop("arrival").write.mode("append").parquet(folder)
    return write


def delivered(spark: SparkSession, sf_dir: str):
    """folder -> stream of the points of the events delivered there."""
    schema = events(spark, sf_dir).schema
    return lambda folder: points_from(spark.readStream.schema(schema).parquet(folder))


def events_from(ev: DataFrame, compress: bool = True) -> DataFrame:
    ts = ev["ts"].cast("timestamp")
    if compress:
        ts = F.timestamp_micros(F.lit(EPOCH_US) + F.floor((F.unix_micros(ts) - F.lit(EPOCH_US)) / F.lit(COMPRESSION)).cast("long"))
    return ev.select("event_id", ts.alias("ts"), "user_id", "event_type", "value", "props")


@memo_plan
def fx_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tagged points per event, one scan (``inline`` of a 2-element array)."""
    return points_from(events(spark, sf_dir))


def fx_points_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points_from(events_stream(spark, sf_dir))


def _entity() -> tuple[Column, Column, Column]:
    """(tenant, device_id, application) of an event."""
    user = F.col("user_id")
    if _VIEW.get() == "wide":
        hot, no = user % HOT_EVERY == 0, F.floor(user / USERS_A_DEVICE)
        return (F.when(hot, "t-hot").otherwise(F.concat(F.lit("t-"), (no % WIDE_TENANTS).cast("string"))),
                F.when(hot, "dev-hot").otherwise(F.concat(F.lit("dev-"), no.cast("string"))), F.lit("app-0"))
    no = (user % TENANTS).cast("string")
    return F.concat(F.lit("t-"), no), F.concat(F.lit("dev-"), no), F.concat(F.lit("app-"), (F.floor(user / 2) % APPS).cast("string"))


def points_from(ev: DataFrame) -> DataFrame:
    tenant, device, application = _entity()
    res_no = F.col("event_id") % 3
    gw_res = F.when(res_no == 0, "cpu").when(res_no == 1, "mem").otherwise("disk")
    capped = F.least(F.col("value"), F.lit(100.0))
    app_row = F.struct(
        F.lit("service_resource_data").alias("location"),
        application.alias("gateway"),
        F.col("event_type").alias("measurement"),
        F.col("value").cast("double").alias("value"),
    )
    res_row = F.struct(
        F.lit("server_resource_data").alias("location"),
        gw_res.alias("gateway"),
        F.when(res_no == 0, "usage_idle").otherwise("used_percent").alias("measurement"),
        F.when(res_no == 0, F.lit(100.0) - capped).otherwise(capped).cast("double").alias("value"),
    )
    return ev.select(
        "ts",
        F.when(F.col("event_id") % 50 == 0, "other").otherwise("server_data").alias("origin"),
        tenant.alias("tenant"),
        device.alias("device_id"),
        F.inline(F.array(app_row, res_row)),
    ).select("ts", "origin", "tenant", "device_id", "location", "gateway", "measurement",
             F.lit("value").alias("field"), "value")
