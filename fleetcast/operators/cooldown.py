"""Alert cooldown (W13): an alert is sent unless one was *sent* in the last ``minutes`` for the same key.

Which alerts are sent depends on which were sent before them, so no window
function over alerts can tell.  Two forms give the same result:

- the fold: a key's distinct times, sorted, run through ``aggregate`` with the
  last sent time as state.  It needs the times of a key in one row.
- pointer jumping, for keys with more than ``fold_limit`` times: every time
  points at the first time at least ``minutes`` later, which is what would be
  sent next.  The sent ones are those on the path from the key's first time.  A
  round marks the targets of all marked times and doubles every pointer, so the
  path is marked in a logarithmic number of rounds of joins on (key, time).

Pointers need no range join: time is cut into bins of the cooldown's length, the
first time at least a cooldown after one in bin b lies in bin b + 1, or is the
first of a later bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MINUTE_US = 60_000_000
FOLD_LIMIT = 10_000


def alert_cooldown(alerts: DataFrame, minutes: int = 60, ts: str = "crossing_time",
                   keys: Sequence[str] = ("tenant", "device_id", "resource_type"), fold_limit: int = FOLD_LIMIT) -> DataFrame:
    """``alerts`` with ``suppressed``: true where an alert of the key was sent less than ``minutes`` before.

    Alerts of one key and instant share the verdict.  Null keys are keys; an
    alert without a time is never suppressed and suppresses nothing.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    key = [F.col(k).alias(n) for k, n in zip(keys, names)]
    times = alerts.where(F.col(ts).isNotNull()).select(*key, F.unix_micros(ts).alias("_us")).distinct()
    span = minutes * MINUTE_US
    counts = times.groupBy(*names).agg(F.count("*").alias("_n"))
    hot = counts.where(F.col("_n") > fold_limit).select(*names)
    if hot.isEmpty():
        sent = _sent_by_fold(times, names, span)
    else:
        of = _null_safe(names, names)
        t = times.alias("l").join(hot.alias("r"), of, "left_semi")
        rest = times.alias("l").join(hot.alias("r"), of, "left_anti")
        sent = _sent_by_fold(rest, names, span).unionByName(sent_by_jumps(t, names, span))
    marks = sent.select(*[F.col(n).alias(f"_s{n}") for n in names], F.col("_us").alias("_sent_us"))
    on = F.unix_micros(F.col(ts)) == F.col("_sent_us")
    for k, n in zip(keys, names):
        on = on & F.col(k).eqNullSafe(F.col(f"_s{n}"))
    return (alerts.join(marks, on, "left").withColumn("suppressed", F.col(ts).isNotNull() & F.col("_sent_us").isNull())
            .select(*alerts.columns, "suppressed"))


def _null_safe(left: Sequence[str], right: Sequence[str]):
    on = F.lit(True)
    for a, b in zip(left, right):
        on = on & F.col(f"l.{a}").eqNullSafe(F.col(f"r.{b}"))
    return on


def _sent_by_fold(times: DataFrame, keys: Sequence[str], span: int) -> DataFrame:
    """(keys, _us) of the sent times: one fold over each key's sorted times."""
    per = times.groupBy(*keys).agg(F.sort_array(F.collect_list("_us")).alias("_all"))
    none = F.struct(F.lit(None).cast("long").alias("last"), F.array().cast("array<long>").alias("sent"))
    send = lambda acc, t: F.struct(t.alias("last"), F.concat(acc["sent"], F.array(t)).alias("sent"))
    step = lambda acc, t: F.when(acc["last"].isNull() | (t - acc["last"] >= span), send(acc, t)).otherwise(acc)
    return per.select(*keys, F.explode(F.aggregate("_all", none, step, lambda acc: acc["sent"])).alias("_us"))


def next_sent(times: DataFrame, keys: Sequence[str], span: int) -> DataFrame:
    """(keys, _us, _to): the first time at least ``span`` after each; times without one are left out."""
    t = times.withColumn("_bin", F.floor(F.col("_us") / span))
    none = F.lit(None).cast("long")
    # an alert at its time, a question one span later: going down in time, the last alert met answers it
    found = t.select(*keys, "_bin", F.col("_us").alias("_at"), F.col("_us").alias("_hit"), none.alias("_ask"))
    asked = t.select(*keys, (F.col("_bin") + 1).alias("_bin"), (F.col("_us") + span).alias("_at"), none.alias("_hit"), F.col("_us").alias("_ask"))
    w = Window.partitionBy(*keys, "_bin").orderBy(F.desc("_at"), F.col("_ask").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    near = (found.unionByName(asked).withColumn("_to", F.last("_hit", ignorenulls=True).over(w))
            .where(F.col("_ask").isNotNull()).select(*keys, "_bin", F.col("_ask").alias("_us"), "_to"))
    # the first time of the next bin that has any: a row for each bin and question
    first = t.groupBy(*keys, "_bin").agg(F.min("_us").alias("_first"))
    bins = first.select(*keys, "_bin", "_first", F.lit(False).alias("_q")).unionByName(
        first.select(*keys, (F.col("_bin") + 1).alias("_bin"), none.alias("_first"), F.lit(True).alias("_q")))
    w = Window.partitionBy(*keys).orderBy(F.desc("_bin"), F.desc("_q")).rowsBetween(Window.unboundedPreceding, 0)
    later = (bins.withColumn("_later", F.last("_first", ignorenulls=True).over(w)).where("_q")
             .select(*[F.col(k).alias(f"_b{k}") for k in keys], F.col("_bin").alias("_b"), "_later"))
    on = F.col("_bin") == F.col("_b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b{k}"))
    return (near.join(later, on, "left").select(*keys, "_us", F.coalesce("_to", "_later").alias("_to")).where(F.col("_to").isNotNull()))


def sent_by_jumps(times: DataFrame, keys: Sequence[str], span: int) -> DataFrame:
    """(keys, _us) of the sent times, by doubling pointers; no key is gathered."""
    ensure_checkpoint_dir(times.sparkSession)
    at = [F.col(k).alias(f"_j{k}") for k in keys]

    def same(jump_time: str):
        on = F.col(jump_time) == F.col("_from")
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"_j{k}"))
        return on

    marked = times.groupBy(*keys).agg(F.min("_us").alias("_us"))
    step = next_sent(times, keys, span)
    # only first times and targets can be on a path
    nodes = marked.unionByName(step.select(*keys, F.col("_to").alias("_us")).distinct())
    step = step.alias("l").join(nodes.alias("r"), _null_safe([*keys, "_us"], [*keys, "_us"]), "left_semi").checkpoint()
    while True:
        jump = step.select(*at, F.col("_us").alias("_from"), F.col("_to").alias("_target"))
        more = marked.join(jump, same("_us")).select(*keys, F.col("_target").alias("_us")).checkpoint()
        if more.isEmpty():
            return marked
        # the first 2^k times of a path and the next 2^k have none in common
        marked = marked.unionByName(more).checkpoint()
        step = step.join(jump, same("_to")).select(*keys, "_us", F.col("_target").alias("_to")).checkpoint()
