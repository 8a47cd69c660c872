"""Row filters, lookups and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sources that ``all`` stands for.
ALL_SOURCES = ("alphamissense", "gnomad", "clinvar")


def normalize_genes(rows: DataFrame, col: str, out: str = "gene") -> DataFrame:
    """One trimmed upper-case row per comma-separated gene, each once; blanks are left out."""
    each = rows.select(F.explode(F.split(col, ",")).alias("_g"))
    return each.select(F.upper(F.trim("_g")).alias(out)).where(F.col(out) != "").distinct()


def normalize_sources(text: Column) -> Column:
    """array of trimmed lower-case names; ``all`` is every source."""
    names = F.transform(F.split(text, ","), lambda x: F.lower(F.trim(x)))
    return F.when(F.array_contains(names, "all"), F.array(*[F.lit(s) for s in ALL_SOURCES])).otherwise(names)


def source_list(text: str) -> list[str]:
    """``normalize_sources`` for a job's own argument."""
    names = [s.strip().lower() for s in text.split(",")]
    return list(ALL_SOURCES) if "all" in names else names


def filter_gene_set(rows: DataFrame, genes: DataFrame, col: str = "gene", gene_col: str = "gene") -> DataFrame:
    wanted = genes.select(F.col(gene_col).alias(col)).distinct()
    return rows.join(wanted, col, "left_semi")


def filter_clinvar(rows: DataFrame, assembly: str = "GRCh38", include_all_types: bool = False) -> DataFrame:
    """Rows of the assembly, single nucleotide variants unless told otherwise, with a protein change in ``hgvs_p``."""
    kept = rows.where((F.col("assembly") == assembly) & F.col("hgvs_p").isNotNull())
    return kept if include_all_types else kept.where(F.col("type") == "single nucleotide variant")


def require_protein_change(rows: DataFrame, col: str = "hgvs_p") -> DataFrame:
    return rows.where(F.col(col) != "")


def require_coordinates(rows: DataFrame, chrom: str = "chromosome", pos: str = "position") -> DataFrame:
    return rows.where(F.col(chrom).isNotNull() & F.col(pos).isNotNull())


def variants_for_gene(rows: DataFrame, gene: str, order: str = "hgvs_p") -> DataFrame:
    return rows.where(F.col("gene") == gene.upper()).orderBy(order)


def lookup_variants(keys: DataFrame, features: DataFrame, on: list[str]) -> DataFrame:
    return keys.join(features, on, "left")


def find_substitution(rows: DataFrame, position: int, alt: str) -> DataFrame:
    return rows.where((F.col("position") == position) & (F.col("alt_aa") == alt))


def has_annotation(rows: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        rows = rows.where(F.col(c).isNotNull())
    return rows


def sort_features(rows: DataFrame, order: str = "hgvs_p") -> DataFrame:
    """Within each gene, without one total order: partitions hold whole genes' ranges, sorted."""
    return rows.repartitionByRange("gene", order).sortWithinPartitions("gene", order)


def all_variants(missense: DataFrame, lof: DataFrame) -> DataFrame:
    return missense.withColumn("variant_type", F.lit("missense")).unionByName(lof.withColumn("variant_type", F.lit("lof")), allowMissingColumns=True)


def variants_by_type(missense: DataFrame, lof: DataFrame, gene: str) -> dict[str, DataFrame]:
    return {"missense": variants_for_gene(missense, gene), "lof": variants_for_gene(lof, gene, "position")}


def display_rows(rows: DataFrame) -> DataFrame:
    from annomerge.functions.scalars import shown

    cut = lambda c: F.coalesce(F.substring(c, 1, 19), F.lit("N/A"))
    return rows.select("gene", cut("hgvs_p").alias("hgvs_p"), shown(F.col("alphamissense_score"), 3).alias("alphamissense"), shown(F.col("gnomad_af"), 2, exponent=True).alias("af"), cut("clinvar_significance").alias("clinvar"))
