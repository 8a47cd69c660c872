"""Loss-of-function variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.functions.scalars import classify_lof_type, predict_nmd_escape, truncation_position
from annomerge.operators.joins import attach_gene_constraint


def annotate_lof(rows: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """Rows with a loss-of-function type, with confidence, flags, truncation and decay escape, and the gene's constraint
    if genes are given."""
    out = rows.withColumn("lof_type", classify_lof_type(F.col("hgvs_p"), F.col("consequence"))).where(F.col("lof_type").isNotNull())
    out = out.withColumn("loftee_confidence", F.nullif("lof", F.lit(""))).withColumn("loftee_flags", F.filter(F.split("lof_flags", ","), lambda x: x != ""))
    out = out.withColumn("truncation_position", truncation_position(F.col("aa_position"), F.col("protein_length")))
    out = out.withColumn("nmd_escape", predict_nmd_escape(F.col("truncation_position"), F.col("last_exon"))).drop("lof", "lof_flags")
    return attach_gene_constraint(out, genes) if genes is not None else out


def route_variants(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missense, lof): every row with a protein change is in the first, every row with a type in the second."""
    return rows.where(F.col("hgvs_p") != ""), rows.where(F.col("lof_type").isNotNull())


def routed(rows: DataFrame) -> DataFrame:
    """The rows of both routes by one pass: ``variant_type`` is where a row goes, and one with two routes comes twice."""
    routes = F.array_compact(F.array(F.when(F.col("hgvs_p") != "", "missense"), F.when(F.col("lof_type").isNotNull(), "lof")))
    return rows.withColumn("variant_type", F.explode(routes))
