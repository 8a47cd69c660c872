"""Keyed merges of tables and of many sources at once.

Sources must hold a key once (see dedupe). A row with a NULL in its key merges with nothing and is passed through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that rows with a NULL in their key are dealt to.
SPREAD = 64


def whole_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def spread(rows: DataFrame, keys: list[str]) -> Column:
    """0 for rows with a whole key. Others match nothing, but would all be hashed to one task: they get a number of their own."""
    return F.when(whole_key(keys), 0).otherwise(F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)).cast("int") + 1)


def all_columns(sources: list[DataFrame]) -> list[str]:
    return list(dict.fromkeys(c for rows in sources for c in rows.columns))


def merge(target: DataFrame, source: DataFrame, keys: list[str], keep: list[str] = (), insert_only: list[str] = (), copartitioned: bool = False) -> DataFrame:
    """Rows of target, updated and extended by source.

    Columns of the source overwrite, even with NULL, but for those in ``keep``, where a NULL leaves what is stored, and
    those in ``insert_only``, which an existing row never changes. Columns that the source lacks stay. One full outer join,
    which reads each side once. ``copartitioned``: join by the keys alone, so that a target bucketed by them is not shuffled;
    rows with a NULL in their key then meet in one task.
    """
    joined_on = list(keys)
    if not copartitioned:
        target, source = target.withColumn("_spread", spread(target, keys)), source.withColumn("_spread", spread(source, keys))
        joined_on.append("_spread")
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.withColumn("_s", F.lit(True)).alias("s")
    joined = t.join(s, joined_on, "full_outer")

    def value(c: str) -> Column:
        old = F.col(f"t.{c}") if c in target.columns else None
        new = F.col(f"s.{c}") if c in source.columns else None
        if old is None or new is None:
            return new if old is None else old
        if c in insert_only:
            return F.when(F.col("_t"), old).otherwise(new)
        return F.coalesce(new, old) if c in keep else F.when(F.col("_s"), new).otherwise(old)

    names = [c for c in all_columns([target, source]) if c != "_spread"]
    return joined.select(*[F.col(c) if c in keys else value(c).alias(c) for c in names])


def merge_all(sources: list[DataFrame], keys: list[str], keep: list[str] = (), insert_only: list[str] = ()) -> DataFrame:
    """What merging the sources one after the other gives, by one shuffle on the key and one reduction, whatever their number.

    Rows are tagged with their source's place and stacked. A column's value is that of the last source with the key that has
    the column, NULL or not; in ``keep`` the last that is not NULL; in ``insert_only`` the first. Each source is read once. Rows
    of which a part of the key is NULL are their own groups, and come back as often as they were there."""
    if len(sources) == 1:
        return sources[0]
    names = all_columns(sources)
    types = {c: t for rows in reversed(sources) for c, t in rows.dtypes}
    having = {c: [i for i, rows in enumerate(sources) if c in rows.columns] for c in names}
    tagged = [rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(types[c]).alias(c) for c in names], F.lit(i).alias("_place")) for i, rows in enumerate(sources)]
    stacked = reduce(lambda a, b: a.unionByName(b), tagged)
    alone = F.when(~whole_key(keys), F.struct("_place", *names))
    dealt = stacked.withColumn("_alone", alone).repartition(*keys, "_alone")

    def value(c: str) -> Column:
        at = F.col("_place") if len(having[c]) == len(sources) else F.when(F.col("_place").isin(having[c]), F.col("_place"))
        if c in keep:
            return F.max_by(c, F.when(F.col(c).isNotNull(), at))
        return (F.min_by if c in insert_only else F.max_by)(F.struct(c), at)[c]

    others = [c for c in names if c not in keys]
    merged = dealt.groupBy(*keys, "_alone").agg(*[value(c).alias(c) for c in others], F.count("*").alias("_times"))
    times = F.when(F.col("_alone").isNull(), 1).otherwise(F.col("_times").cast("int"))
    return merged.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).select(*names)


def merge_overwrite(target: DataFrame, source: DataFrame, keys: list[str] = ("gene", "hgvs_p")) -> DataFrame:
    return merge(target, source, list(keys))


def merge_coalesce(target: DataFrame, source: DataFrame, keep: list[str], keys: list[str] = ("gene", "hgvs_p")) -> DataFrame:
    return merge(target, source, list(keys), keep=keep)


def merge_lof(target: DataFrame, source: DataFrame) -> DataFrame:
    """On (gene, hgvs_c); rows without a type are refused by leaving them out."""
    return merge(target, source.where("lof_type IS NOT NULL"), ["gene", "hgvs_c"])


def merge_genes(target: DataFrame, source: DataFrame) -> DataFrame:
    return merge(target, source, ["symbol"])


def merge_penetrance(target: DataFrame, source: DataFrame) -> DataFrame:
    return merge(target, source, ["variant_type", "variant_id"], insert_only=["gene", "hgvs_p"])


def build_features(sources: list[DataFrame], keys: list[str] = ("gene", "hgvs_p"), keep: list[str] = ()) -> DataFrame:
    """All sources, in order, into one table; each holds a key once, and is read and shuffled once."""
    return merge_all(sources, list(keys), keep)
