"""Sent-based cooldown against a plain loop, by fold and by pointer jumping."""

import datetime as dt
import random

import pytest

from fleetcast.operators.cooldown import alert_cooldown

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "tenant string, device_id string, resource_type string, crossing_time timestamp, id int, suppressed_before boolean"


def plain(rows, minutes=60):
    """id -> suppressed, walking each key's times in order."""
    keys = {}
    for *key, t, i, _ in rows:
        keys.setdefault(tuple(key), []).append((t, i))
    out = {}
    for alerts in keys.values():
        last = None
        for t, i in sorted((a for a in alerts if a[0] is not None), key=lambda a: a[0]):
            free = last is None or t == last or (t - last) >= dt.timedelta(minutes=minutes)
            out[i] = not free
            last = t if free else last
        out |= {i: False for t, i in alerts if t is None}
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = alert_cooldown(df, **kw)
    assert out.columns == [*df.columns, "suppressed"]
    return {r["id"]: r["suppressed"] for r in out.collect()}


def rows_at(key, minutes, start=0):
    return [(*key, None if m is None else T0 + dt.timedelta(minutes=m), start + i, True) for i, m in enumerate(minutes)]


@pytest.mark.parametrize("fold_limit", [10_000, 0])
def test_previous_sent_decides(spark, fold_limit):
    """0, 50, 100 minutes: 0 and 100 are sent; the alert before the third was not sent."""
    key = ("t", "d", "cpu")
    assert got(spark, rows_at(key, [0, 50, 100]), fold_limit=fold_limit) == {0: False, 1: True, 2: False}
    # exactly an hour is free again, a microsecond less is not; 59.99.. from the sent one, not from the suppressed one
    assert got(spark, rows_at(key, [0, 30, 60, 90, 119.999999, 120]), fold_limit=fold_limit) == {0: False, 1: True, 2: False, 3: True, 4: True, 5: False}


@pytest.mark.parametrize("fold_limit", [10_000, 0, 40])
def test_many_keys_are_a_plain_loop(spark, fold_limit):
    """Dense and sparse keys, ties, null keys, alerts without a time; with a limit of 40 both forms run."""
    rng = random.Random(7)
    rows = []
    for k, (n, spread) in enumerate([(1, 10), (30, 3000), (200, 2000), (300, 90_000), (60, 61), (25, 1_000_000)]):
        key = ("t", None if k == 2 else f"d{k}", "cpu" if k % 2 else None)
        times = [rng.choice([rng.randrange(spread), rng.random() * spread]) for _ in range(n)]
        rows += rows_at(key, [*times, times[0], None], 1000 * k)
    assert got(spark, rows, fold_limit=fold_limit) == plain(rows)


@pytest.mark.parametrize("fold_limit", [10_000, 0])
def test_other_keys_and_spans(spark, fold_limit):
    rows = rows_at(("t", "d", "cpu"), range(0, 100, 7)) + rows_at(("t", "d", "mem"), range(0, 100, 9), 50)
    by_device = plain([("t", "d", "", t, i, s) for _, _, _, t, i, s in rows], 20)
    assert got(spark, rows, minutes=20, keys=["tenant", "device_id"], fold_limit=fold_limit) == by_device
    assert got(spark, [], fold_limit=fold_limit) == {}
