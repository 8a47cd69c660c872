"""Joins that attach scores and annotations. Which side is broadcast is left to Spark, which knows the sizes of files and, at
run time, of shuffled sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.functions.scalars import build_position, normalize_chromosome, safe_double, variant_id
from annomerge.operators.dedupe import dedupe_first, first_of
from annomerge.operators.filters import require_coordinates
from annomerge.sources.shared import materialise

def alphamissense_for_genes(scores: DataFrame, dim: DataFrame) -> DataFrame:
    """Substitutions of the genes' proteins; dim: gene, uniprot_id, written first, so that Spark knows how few they are and does not
    shuffle the scores by protein."""
    return scores.join(materialise(dim, "dim"), "uniprot_id")


def unmapped_genes(genes: DataFrame, dim: DataFrame) -> DataFrame:
    return genes.join(dim, "gene", "left_anti")


def revel_for_genes(scores: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Rows of each gene with one of its transcripts, and the matches in the gene's order; transcripts: gene, transcript_ids, each
    gene once. A row meets a gene by every shared transcript and stays with the first that it lists, so it comes once per
    gene, repeated rows as often as they are there, and nothing is brought together again."""
    wanted = transcripts.select("gene", F.col("transcript_ids").alias("_wanted"), F.explode(F.array_distinct("transcript_ids")).alias("_id"))
    listed = scores.withColumn("_listed", F.array_distinct(F.split("Ensembl_transcriptid", ";")))
    met = listed.withColumn("_id", F.explode("_listed")).join(wanted, "_id")
    first = F.element_at(F.filter("_listed", lambda t: F.array_contains("_wanted", t)), 1)
    matched = F.filter("_wanted", lambda t: F.array_contains("_listed", t))
    return met.where(first == F.col("_id")).select("gene", *scores.columns, matched.alias("matched_transcripts"))


def revel_by_coordinates(variants: DataFrame, scores: DataFrame, build: str = "GRCh38", ord_col: str = "ord") -> DataFrame:
    """Adds revel_score from the first score row of the same coordinates: its score, even if that is none. Scores are cut to the
    coordinates asked for before the first of each is taken. The variants are written first, so that Spark knows how few they are and
    need not shuffle all scores."""
    keys = ["chromosome", "position", "ref", "alt"]
    asked = materialise(variants.withColumn("chromosome", normalize_chromosome(F.col("chromosome"))).withColumn("position", F.col("position").cast("string")), "asked")
    rows = scores.select(F.col("chr").alias("chromosome"), build_position(F.lit(build), F.col("grch38_pos"), F.col("hg19_pos")).alias("position"), "ref", "alt", "REVEL", ord_col)
    own = rows.join(asked.select(*keys).dropna().distinct(), keys, "left_semi")
    first = dedupe_first(own, keys, ord_col).select(*keys, safe_double(F.col("REVEL")).alias("revel_score"))
    return asked.join(first, keys, "left")


def annotate_cadd(variants: DataFrame, scores: DataFrame, key: str, ord_col: str = "ord") -> DataFrame:
    """Per variant the first score row at its place; a NULL or empty allele matches any. The row's coordinates replace
    the variant's where there is one. Scores are cut to the places asked for and to the first row of each pair of alleles there, by
    hashing, before they are joined: a variant meets a few rows, however many its place has."""
    variants = materialise(variants, "variants")
    left = variants.select(F.col(key).alias("_key"), normalize_chromosome(F.col("chromosome")).alias("_chrom"), F.col("position").cast("long").alias("_pos"), F.nullif("ref", F.lit("")).alias("_ref"), F.nullif("alt", F.lit("")).alias("_alt"))
    meets = (F.col("_chrom") == F.col("Chrom")) & (F.col("_pos") == F.col("Pos")) & (F.col("_ref").isNull() | (F.col("_ref") == F.col("Ref"))) & (F.col("_alt").isNull() | (F.col("_alt") == F.col("Alt")))
    score = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    rows = scores.select("Chrom", "Pos", "Ref", "Alt", score("RawScore"), score("PHRED"), ord_col)
    places = left.select(F.col("_chrom").alias("Chrom"), F.col("_pos").alias("Pos")).distinct()
    alleles = rows.join(places, ["Chrom", "Pos"], "left_semi").groupBy("Chrom", "Pos", "Ref", "Alt")
    rows = alleles.agg(*[F.min_by(c, ord_col).alias(c) for c in ("RawScore", "PHRED")], F.min(ord_col).alias(ord_col))
    first = left.join(rows, meets).groupBy("_key").agg(F.min_by(F.struct("Chrom", "Pos", "Ref", "Alt", "RawScore", "PHRED"), ord_col).alias("_hit"))
    out = variants.join(first, variants[key] == first["_key"], "left")
    names = {"chromosome": "Chrom", "position": "Pos", "ref": "Ref", "alt": "Alt"}
    kept = [F.when(F.col("_hit").isNotNull(), F.col("_hit")[names[c]]).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in variants.columns]
    return out.select(*kept, F.col("_hit")["RawScore"].alias("cadd_raw"), F.col("_hit")["PHRED"].alias("cadd_phred"))


def cadd_for_gene_variants(variants: DataFrame, genes: DataFrame, scores: DataFrame, key: str, ord_col: str = "ord") -> DataFrame:
    own = require_coordinates(variants.join(genes.select("gene").distinct(), "gene", "left_semi"))
    places = own.select(normalize_chromosome(F.col("chromosome")).alias("Chrom"), F.col("position").cast("long").alias("Pos")).distinct()
    return annotate_cadd(own, scores.join(places, ["Chrom", "Pos"], "left_semi"), key, ord_col)


def revel_by_substitution(scores: DataFrame, revel: DataFrame, keys: list[str] = ("aaref", "aaalt"), ord_col: str = "ord") -> DataFrame:
    """Adds the value seen last of the position seen first for the row's amino acids; position is not compared. The reduced
    scores are written once, so that the join knows their size."""
    from annomerge.operators.dedupe import first_seen_last_value

    reduced = materialise(first_seen_last_value(revel, list(keys), "grch38_pos", ord_col, "revel_score").select(*keys, "revel_score"), "revel")
    return scores.join(reduced, list(keys), "left")


def nearby_variants(queries: DataFrame, variants: DataFrame, key: str, reach: int = 5, most: int = 10, ord_col: str = "ord") -> DataFrame:
    """Per query the first rows of its gene within ``reach`` positions. Positions are dealt to ranges one wider than the
    reach, so a query meets three ranges and the join is by key.

    The first rows near a place are among the first ``most`` of each position near it, so no other row is joined, and each place is
    answered once, however many queries ask for it. The ranges asked for are written first, so that Spark knows how few they are."""
    width = reach + 1
    range_of = lambda c: F.floor(F.col(c) / width)
    asked = queries.select(F.col(key), "gene", F.col("position").alias("query_position"))
    places = asked.select("gene", "query_position").distinct().withColumn("_range", F.explode(F.sequence(range_of("query_position") - 1, range_of("query_position") + 1)))
    near = materialise(places, "places")
    own = variants.withColumn("_range", range_of("position")).join(near.select("gene", "_range").distinct(), ["gene", "_range"], "left_semi")
    first = first_of(own, ["gene", "position"], ord_col, most)
    met = near.join(first, ["gene", "_range"]).where(F.abs(F.col("position") - F.col("query_position")) <= reach).drop("_range")
    answers = first_of(met, ["gene", "query_position"], ord_col, most)
    each = asked.join(answers, ["gene", "query_position"]).select("gene", key, "query_position", *[c for c in variants.columns if c != "gene"])
    return first_of(each, [key], ord_col, most)


def gnomad_by_variant_id(variants: DataFrame, gnomad: DataFrame) -> DataFrame:
    """gnomad: variant_id and what to attach, each id once."""
    return variants.withColumn("variant_id", variant_id(F.col("chromosome"), F.col("position"), F.col("ref"), F.col("alt"))).join(gnomad, "variant_id", "left")


def attach_gene_constraint(lof: DataFrame, genes: DataFrame) -> DataFrame:
    dim = genes.select(F.col("symbol").alias("gene"), F.col("pli").alias("gene_pli"), F.col("loeuf").alias("gene_loeuf"))
    return lof.join(dim, "gene", "left")


def attach_penetrance(variants: DataFrame, estimates: DataFrame) -> DataFrame:
    return variants.join(estimates, ["variant_type", "variant_id"], "left")


def orphan_penetrance(estimates: DataFrame, variants: DataFrame) -> DataFrame:
    return estimates.join(variants, ["variant_type", "variant_id"], "left_anti")
