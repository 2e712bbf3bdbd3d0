"""Registered queries once more over the 'wide' view of the events: devices in proportion to the data, one of them hot.

The twins are those of the dense queries with the derivation of the points
exchanged.
"""

from __future__ import annotations

from ..sources.fixtures import HOT_EVERY, USERS_A_DEVICE, WIDE_TENANTS, fixture_view
from .oracle import CTES
from .registry import ORACLE, QUERIES

NAMES = ["s2_app_metrics", "s3_resource_metrics", "p8_complete_rows", "w1_rolling_stats", "w4_interpolate_app", "a5_impact_scores", "a6_impact_stats",
         "u4_feature_table", "m1_app_training_set", "m1_hourly_training_set", "m2_system_training_set", "m3_raw_training_set", "m4_impact_encoding"]

_DENSE = CTES["fx_points"][0].strip()
_HOT, _NO = f"user_id % {HOT_EVERY} = 0", f"user_id // {USERS_A_DEVICE}"
_EXCHANGED = {
    "concat('t-', CAST(user_id % 2 AS VARCHAR))": f"CASE WHEN {_HOT} THEN 't-hot' ELSE concat('t-', CAST({_NO} % {WIDE_TENANTS} AS VARCHAR)) END",
    "concat('dev-', CAST(user_id % 2 AS VARCHAR))": f"CASE WHEN {_HOT} THEN 'dev-hot' ELSE concat('dev-', CAST({_NO} AS VARCHAR)) END",
    "concat('app-', CAST((user_id // 2) % 3 AS VARCHAR))": "'app-0'"}
_WIDE = _DENSE
for _a, _b in _EXCHANGED.items():
    _WIDE = _WIDE.replace(_a, _b)


def _register(name: str) -> None:
    dense = QUERIES[name]

    def run(spark, sf_dir):
        with fixture_view("wide"):
            return dense(spark, sf_dir)
    run.__name__ = f"{name}_wide"
    run.__doc__ = f"{dense.__doc__} Devices in proportion to the data, one hot."
    QUERIES[run.__name__] = run
    ORACLE[run.__name__] = ORACLE[name].replace(_DENSE, _WIDE)


for _name in NAMES:
    _register(_name)
