"""Dense numbers of rows, in all or within keys, that no single task has to give.

Two passes: rows are dealt by ranges, sorted and written with their place in their part; then each part's or run's count gives the
numbers that the next begin with. What is numbered in one place is a row per part and key, not the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annomerge.sources.shared import materialise


def dense_order(rows: DataFrame, order: list[str], keys: list[str] = (), name: str = "ordinal") -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... in the given order, within each value of ``keys`` if there are any; a NULL is a value. Rows that tie
    are numbered in any order, once: the numbers are written before they are used."""
    keys = list(keys)
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = materialise(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "places")
    runs = placed.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialise(runs.select("_part", *keys, (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift")), "runs")
    same = F.col("a._part") == F.col("b._part")
    for k in keys:
        same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return placed.alias("a").join(starts.alias("b"), same).select(*[F.col(f"a.{c}") for c in rows.columns], (F.col("_at") + F.col("_shift")).alias(name))
