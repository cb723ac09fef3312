"""Places of rows in a sorted order, without one task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept

_IN_PARTITION = (1 << 33) - 1


def placed(df: DataFrame, groups: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``idx`` (place in its group, from 0, in ascending ``order``) and ``n`` (rows of the group).

    Rows are sorted by range over ``groups`` and ``order``, so a group of any size
    spreads over many tasks. Rows that are equal in all of these are told apart by
    their place in the input, so copies do not pile up either. Only the counts of
    (task, group) are summed along the order: as many rows as there are tasks and
    groups. Null group values form a group, and null order values come first.
    """
    spread = df.withColumn("__copy", F.monotonically_increasing_id())
    keys = [F.asc_nulls_first(c) for c in (*groups, *order, "__copy")]
    rows = kept(
        spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__copy")
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftrightunsigned("__at", 33)), label)
    parts = rows.groupBy("__part", *groups).agg(F.count("*").alias("c"), F.min("__at").alias("first"))
    group = Window.partitionBy(*groups)
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("__part").alias("p"), *(F.col(g).alias(f"__{g}") for g in groups),
        (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first").bitwiseAND(_IN_PARTITION)).alias("shift"),
        F.sum("c").over(group).alias("n"))
    same = F.col("__part") == F.col("p")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return rows.join(starts, same).select(
        *df.columns, (F.col("__at").bitwiseAND(_IN_PARTITION) + F.col("shift")).alias("idx"), "n")
