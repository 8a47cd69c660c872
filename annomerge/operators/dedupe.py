"""First wins, last wins, and rows by order. Where one row is kept, aggregates that reduce each key before the shuffle (by sorting,
since rows are text), not windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annomerge.sources.shared import materialise


def one_per_key(rows: DataFrame, keys: list[str], ord_col: str, pick) -> DataFrame:
    others = [c for c in rows.columns if c not in keys]
    kept = rows.groupBy(*keys).agg(pick(F.struct(*others), F.col(ord_col)).alias("_row"))
    return kept.select(*keys, *[F.col("_row")[c].alias(c) for c in others]).select(*rows.columns)


def dedupe_first(rows: DataFrame, keys: list[str], ord_col: str) -> DataFrame:
    return one_per_key(rows, keys, ord_col, F.min_by)


def dedupe_last(rows: DataFrame, keys: list[str], ord_col: str) -> DataFrame:
    return one_per_key(rows, keys, ord_col, F.max_by)


def last_known(rows: DataFrame, keys: list[str], ord_col: str, value: str) -> DataFrame:
    """Per key, the last value that is not NULL."""
    return rows.groupBy(*keys).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(ord_col))).alias(value))


def first_seen_last_value(rows: DataFrame, keys: list[str], place: str, ord_col: str, value: str) -> DataFrame:
    """Per key, of the place seen first, its value seen last.

    Places can be as many as rows, so no row is grouped by its place: the first order of each key finds its place, and the rows there
    tell the value. Orders and numbers reduce by hashing, before any shuffle; the rows are read three times and not sorted. What is
    found is written, so that Spark knows how little it is and broadcasts it."""
    same = lambda left, right, names: reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in names])
    named = [F.col(c).alias(f"_{c}") for c in keys]
    first = materialise(rows.groupBy(*keys).agg(F.min(ord_col).alias("_first")).select(*named, "_first"), "first")
    there = rows.join(first, same(rows, first, keys) & (F.col(ord_col) == F.col("_first")))
    at = materialise(there.groupBy(*[f"_{c}" for c in keys]).agg(F.min(place).alias(f"_{place}")), "place")
    seen = rows.join(at, same(rows, at, [*keys, place])).groupBy(*keys, place).agg(F.max_by(value, ord_col).alias(value))
    return first.join(seen, same(seen, first, keys), "left").select(*[F.col(f"_{c}").alias(c) for c in keys], place, value)


def top_rows(rows: DataFrame, group: str, order: list, n: int = 50) -> DataFrame:
    """The first n rows of each group and ``n_more``, how many follow. The rank alone is a window, which Spark limits before
    the shuffle; groups are counted by partial sums."""
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")
    counts = rows.groupBy(F.col(group).alias("_group")).agg(F.greatest(F.count("*") - n, F.lit(0)).alias("n_more"))
    return ranked.join(counts, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def first_of(rows: DataFrame, keys: list[str], ord_col: str, n: int) -> DataFrame:
    """The first n rows of each key, by a rank that Spark limits before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(ord_col))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def sample_rows(rows: DataFrame, ord_col: str, n: int) -> DataFrame:
    return rows.orderBy(ord_col).limit(n)
