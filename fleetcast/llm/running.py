"""Running sums inside groups of any size, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch


def running(rows: DataFrame, group: list[str], order: list[str], sums: dict[str, Column], scratch: Scratch, label: str) -> DataFrame:
    """``rows`` and, per name of ``sums``, the sum of that column over the earlier rows of the same group.

    One range sort over (group, order) cuts a large group into parts, which are
    written: the parts are then the same for every later step.  Sums of the
    parts before (a row for each group and part) and sums inside a part add up.
    Rows that tie in ``order`` stay in one part, so ``order`` ends in a column
    that tells rows apart.  The columns ``part`` and ``part_*`` must be free.
    """
    keys = [*group, *order]
    t = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    t = scratch.save(t, label)
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, "part").orderBy(*order).rowsBetween(*earlier)
    parts = Window.partitionBy(*group).orderBy("part").rowsBetween(*earlier)  # as many rows as there are parts
    zero = lambda c: F.coalesce(c, F.lit(0))
    per = t.groupBy(*group, "part").agg(*[F.sum(c).alias(f"part_{n}") for n, c in sums.items()])
    per = per.select(*group, "part", *[zero(F.sum(f"part_{n}").over(parts)).alias(f"part_{n}") for n in sums])
    t = t.withColumns({n: zero(F.sum(c).over(inside)) for n, c in sums.items()})
    return (t.join(per, [*group, "part"]).withColumns({n: F.col(n) + F.col(f"part_{n}") for n in sums})
            .drop("part", *[f"part_{n}" for n in sums]))
