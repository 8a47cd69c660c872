"""Data checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.sources.shared import materialise

COORDINATES = ["chromosome", "position", "ref", "alt", "genome_build"]
RULES = {"variants_missense": [["gene", "hgvs_p"], COORDINATES], "variants_lof": [["gene", "hgvs_c"], COORDINATES], "penetrance_estimates": [["variant_type", "variant_id"]], "genes": [["symbol"]]}
REQUIRED = {"variants_missense": ["gene"], "variants_lof": ["gene", "lof_type"], "penetrance_estimates": ["variant_type", "variant_id", "gene"], "genes": ["symbol"]}
VARIANT_TYPES = ("missense", "lof")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once, with their number; a key with a NULL part never conflicts."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return rows.where(whole).groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def broken_rules(rows: DataFrame, table: str) -> Column:
    """The names of the table's rules that a row breaks by itself."""
    rules = [(F.col(c).isNull(), f"{c} is null") for c in REQUIRED[table]]
    if "variant_type" in rows.columns:
        rules.append((~F.col("variant_type").isin(*VARIANT_TYPES), "variant_type not allowed"))
    return F.array_compact(F.array(*[F.when(rule, name) for rule, name in rules]))


def constraint_violations(rows: DataFrame, table: str) -> DataFrame:
    """Rows that break a rule of the table, once for each rule, under ``violation``."""
    return rows.withColumn("violation", F.explode(broken_rules(rows, table)))


def repeated_keys(rows: DataFrame, table: str) -> DataFrame:
    """``duplicate_keys`` of all uniqueness rules of the table at once: rule (its columns), key (their values as text), n_rows and the
    first row's ``ord``. The rows are read and shuffled once for all rules."""
    return keyed(rows, table, "ord").groupBy("rule", "key").agg(F.count("*").alias("n_rows"), F.min("ord").alias("first_ord")).where("n_rows > 1")


def keyed(rows: DataFrame, table: str, ord_col: str) -> DataFrame:
    """A row for every uniqueness rule whose columns are all given: rule, key, ord."""
    rules = [keys for keys in RULES[table] if set(keys) <= set(rows.columns)]
    each = [F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), F.struct(F.lit(", ".join(keys)).alias("rule"), F.array(*[F.col(k).cast("string") for k in keys]).alias("key"))) for keys in rules]
    return rows.select(F.col(ord_col).alias("ord"), F.explode(F.array_compact(F.array(*each))).alias("k")).select("ord", "k.*")


def split_checked(rows: DataFrame, table: str, ord_col: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(accepted, set aside), the latter with ``violations``, an array of the rules that each row breaks.

    A row that breaks a rule by itself is set aside and stands in no other's way. Of the rest, a row is set aside if one with a
    smaller ``ord_col``, which must tell rows apart, has the same key under any uniqueness rule; keys with a NULL never conflict.
    Keys are counted by partial sums, for all rules in one shuffle, and rows are joined only with the keys that repeat, so a key
    that very many rows share is split by Spark. The judged rows are written once and both parts read them.
    """
    own = rows.withColumn("_broken", broken_rules(rows, table))
    sound = own.where(F.size("_broken") == 0)
    repeats = repeated_keys(sound.withColumn("ord", F.col(ord_col)) if ord_col != "ord" else sound, table)
    late = keyed(sound, table, ord_col).join(repeats.select("rule", "key", "first_ord"), ["rule", "key"]).where("ord > first_ord")
    reasons = late.groupBy(F.col("ord").alias("_late")).agg(F.sort_array(F.collect_set(F.concat(F.lit("repeated "), F.col("rule")))).alias("_repeats"))
    judged = materialise(own.join(reasons, F.col(ord_col) == F.col("_late"), "left").withColumn("violations", F.concat("_broken", F.coalesce("_repeats", F.array().cast("array<string>")))).drop("_broken", "_late", "_repeats"), "checked")
    return judged.where(F.size("violations") == 0).drop("violations"), judged.where(F.size("violations") > 0)
