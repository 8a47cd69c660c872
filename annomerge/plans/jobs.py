"""Whole jobs: sources to parsed tables, to one feature table, to reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.functions import scalars as x
from annomerge.operators import dedupe, filters, joins, merge, quality, stats
from annomerge.sources import stored


def parse_clinvar(rows: DataFrame, keep: tuple = ("ord",)) -> DataFrame:
    """Fields of summary rows, one output row per input row."""
    n = F.col("name")
    return rows.select(
        *keep, F.col("gene_symbol").alias("gene"), "type", "assembly", x.parse_protein_change(n).alias("hgvs_p"), x.parse_hgvs_c(n).alias("hgvs_c"),
        x.na_to_null(F.col("chromosome"), empty=False).alias("chromosome"), x.safe_long(x.na_to_null(F.col("pos_vcf"))).alias("position"),
        x.na_to_null(F.col("ref_vcf")).alias("ref"), x.na_to_null(F.col("alt_vcf")).alias("alt"), x.safe_long(x.na_to_null(F.col("variation_id"))).alias("clinvar_id"),
        F.col("clinical_sig").alias("clinvar_significance"), F.col("review_status").alias("clinvar_review_status"), x.review_stars(F.col("review_status")).alias("clinvar_stars"),
        x.parse_review_date(F.col("last_evaluated")).alias("clinvar_last_evaluated"),
    )


def load_clinvar(rows: DataFrame, genes: DataFrame | None = None, assembly: str = "GRCh38", include_all_types: bool = False, ord_col: str = "ord") -> DataFrame:
    """Filtered before the first row of each key is taken, for all genes in one pass."""
    parsed = filters.filter_clinvar(parse_clinvar(rows, (ord_col,)), assembly, include_all_types)
    own = filters.filter_gene_set(parsed, genes) if genes is not None else parsed
    return dedupe.dedupe_first(own, ["gene", "hgvs_p"], ord_col).drop("type", "assembly")


def parse_alphamissense(rows: DataFrame, keep: tuple = ("ord", "uniprot_id")) -> DataFrame:
    """Substitutions with their score; a row without score and class scores 0, another bad score is NULL."""
    ref, pos, alt = x.parse_substitution(F.col("protein_variant"))
    s = rows.where(pos.isNotNull())
    score = F.when(F.col("am_pathogenicity").isNull() & F.col("am_class").isNull(), F.lit(0.0)).otherwise(x.safe_double(F.col("am_pathogenicity")))
    return s.select(*keep, ref.alias("aaref"), pos.alias("aa_position"), alt.alias("aaalt"), x.hgvs_p_from_aa(ref, pos, alt).alias("hgvs_p"), score.alias("alphamissense_score"), F.coalesce("am_class", F.lit("unknown")).alias("alphamissense_class"))


def load_alphamissense(rows: DataFrame, dim: DataFrame, ord_col: str = "ord", keep: tuple = ()) -> DataFrame:
    """``keep``: further columns, such as the amino acids that ``substitution_scores`` needs."""
    own = joins.alphamissense_for_genes(parse_alphamissense(rows, (ord_col, "uniprot_id")), dim)
    return dedupe.dedupe_last(own.select("gene", "hgvs_p", "alphamissense_score", "alphamissense_class", *keep, ord_col), ["gene", "hgvs_p"], ord_col)


def parse_revel(rows: DataFrame, keep: tuple = ("ord",)) -> DataFrame:
    """Rows with a score."""
    return rows.select(*keep, x.normalize_chromosome(F.col("chr")).alias("chromosome"), "hg19_pos", "grch38_pos", "ref", "alt", "aaref", "aaalt", x.safe_double(F.col("REVEL")).alias("revel_score"), "Ensembl_transcriptid").where("revel_score IS NOT NULL")


def load_gnomad(flat: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Of flattened variants those with a protein change, the last of each key."""
    own = filters.require_protein_change(flat).select(F.col("symbol").alias("gene"), "hgvs_p", "hgvs_c", "gnomad_af", "gnomad_homozygotes", ord_col)
    return dedupe.dedupe_last(own, ["gene", "hgvs_p"], ord_col)


def scored_clinvar(clinvar: DataFrame, revel: DataFrame, cadd: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Clinical rows with revel_score of their coordinates and with cadd_raw, cadd_phred and the coordinates of the first row
    there. revel: rows as read; every row of clinvar must have an ``ord_col`` of its own."""
    own = joins.revel_by_coordinates(clinvar, revel, ord_col=ord_col).withColumn("position", F.col("position").cast("long"))
    return joins.annotate_cadd(own, cadd, ord_col, ord_col)


def substitution_scores(alphamissense: DataFrame, revel: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Scores of AlphaMissense rows with revel_score of their amino acids. revel: parsed rows."""
    return joins.revel_by_substitution(alphamissense, revel, ord_col=ord_col).select("gene", "hgvs_p", "alphamissense_score", "alphamissense_class", "revel_score")


def feature_table(alphamissense: DataFrame, gnomad: DataFrame, clinvar: DataFrame | None = None, revel: DataFrame | None = None, ord_col: str = "ord") -> DataFrame:
    """All sources, one row per (gene, hgvs_p); later ones win on shared columns. ``revel``, parsed rows, gives the AlphaMissense
    rows, which then need aaref and aaalt, the score of their amino acids. That score is merged last and leaves a stored one where
    it is NULL: it is carried along under another name, since no source need be read twice for it."""
    if revel is not None:
        alphamissense = joins.revel_by_substitution(alphamissense, revel, ord_col=ord_col).withColumnRenamed("revel_score", "_by_substitution")
    sources = [d.drop(ord_col, "aaref", "aaalt") for d in (alphamissense, gnomad, clinvar) if d is not None]
    table = merge.build_features(sources)
    if revel is None:
        return table
    stored = F.col("revel_score") if "revel_score" in table.columns else F.lit(None).cast("double")
    return table.withColumn("revel_score", F.coalesce("_by_substitution", stored)).drop("_by_substitution")


def build(spark: SparkSession, path: str, genes: DataFrame, sources: str, loaded: dict[str, DataFrame], loaded_at: datetime, state: str | None = None) -> DataFrame:
    """Load the named sources, or ``all``, of some genes into the stored missense table, merged in the order of
    ``filters.ALL_SOURCES``, by one rewrite of the genes' folders; ``state``: where their coverage is kept. Returns the genes that
    were loaded. A name that stands for no source, or for one that is not in ``loaded``, is passed over."""
    wanted = [s for s in filters.ALL_SOURCES if s in filters.source_list(sources) and s in loaded]
    if not wanted:
        return genes.select("gene").limit(0)
    table = merge.build_features([filters.filter_gene_set(loaded[s], genes) for s in wanted])
    done = stored.upsert(spark, path, "variants_missense", table, loaded_at)
    if state:
        stored.refresh_coverage(spark, path, "variants_missense", state, done)
    return done


def load_checked(spark: SparkSession, path: str, table: str, rows: DataFrame, aside: str, loaded_at: datetime, ord_col: str = "ord") -> DataFrame:
    """Load the rows that break no rule of the stored table, and write the others, with their reasons, to ``aside``. A uniqueness rule
    is held among the rows loaded and, since a stored key is updated, by the key of the table. Returns the genes loaded."""
    accepted, refused = quality.split_checked(rows, table, ord_col)
    refused.write.mode("overwrite").parquet(aside)
    return stored.upsert(spark, path, table, accepted.drop(ord_col), loaded_at)


def coverage(features: DataFrame) -> DataFrame:
    return stats.coverage_by_gene(features)
