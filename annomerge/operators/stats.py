"""Counts and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: The columns that a gene's coverage counts beside its rows; counts of parts can be added.
COVERAGE = {"with_clinvar": "clinvar_id", "with_alphamissense": "alphamissense_score", "with_gnomad": "gnomad_af", "with_revel": "revel_score"}


def coverage_by_gene(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gene").agg(F.count("*").alias("total"), *[F.count(c).alias(n) for n, c in COVERAGE.items()]).orderBy(F.desc("total"), "gene")


def lof_counts_by_gene(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gene").agg(F.count("*").alias("total")).orderBy("gene")


def load_counts(genes: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows per requested gene, zero included, and one row with a NULL gene for all."""
    counts = genes.select("gene").distinct().join(rows.groupBy("gene").agg(F.count("*").alias("n")), "gene", "left").select("gene", F.coalesce("n", F.lit(0)).alias("n_rows"))
    return counts.unionByName(counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")).select(F.lit(None).cast("string").alias("gene"), "n_rows"))


def protein_change_counts(rows: DataFrame) -> DataFrame:
    has = F.coalesce(F.col("hgvs_p") != "", F.lit(False))
    return rows.agg(F.count("*").alias("total"), F.count_if(has).alias("loaded"), F.count_if(~has).alias("skipped"))


def source_coverage(rows: DataFrame, col: str) -> DataFrame:
    return rows.agg(F.count("*").alias("total"), F.count(col).alias("matched"), F.try_divide(F.count(col) * 100.0, F.count("*")).alias("percent"))


def verify_gene_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gene").agg(F.count("*").alias("total"), F.count_if(F.col("clinvar_id") != 0).alias("with_clinvar"), F.count("gnomad_af").alias("with_frequency"))
