"""Readers with explicit schemas. Values stay text where they are parsed later; what is missing is NULL.

A plain gzip file is one task, however large: convert it to Parquet once, or repartition behind the reader. One of blocks is
read in ranges of ``split_bytes`` where that is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.functions.nested import zip_header_rows
from annomerge.functions.scalars import hgvs_p_from_aa, parse_substitution, safe_double
from annomerge.operators.dedupe import dedupe_last
from annomerge.sources import blocks, schemas


def with_row_order(rows: DataFrame, name: str = "ord") -> DataFrame:
    """An order by file, place in the file and row. Take it right behind the reader, before any shuffle."""
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    return rows.select("*", place.alias(name))


def read_alphamissense(spark: SparkSession, path: str, coordinates: bool = False, order: bool = False, split_bytes: int | None = None) -> DataFrame:
    """Tab-separated scores; lines that begin with # are skipped. ``coordinates``: the layout whose header is one."""
    if split_bytes:
        kind = schemas.ALPHAMISSENSE_HG38 if coordinates else schemas.ALPHAMISSENSE
        rows = blocks.read_fields(spark, path, kind, "\t", split_bytes, comment="#", header=not coordinates, quote="")
        return rows if order else rows.drop("ord")
    reader = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").option("enforceSchema", True)
    rows = reader.schema(schemas.ALPHAMISSENSE_HG38).csv(path) if coordinates else reader.option("header", True).schema(schemas.ALPHAMISSENSE).csv(path)
    return with_row_order(rows) if order else rows


def read_clinvar(spark: SparkSession, path: str, order: bool = False, split_bytes: int | None = None) -> DataFrame:
    """The used columns, by position, of a summary with one header line and no quoting."""
    if split_bytes:
        return blocks.read_fields(spark, path, schemas.CLINVAR, "\t", split_bytes, header=True, quote="").select(*schemas.SUMMARY_COLUMNS.values(), *["ord"] * order)
    rows = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("enforceSchema", True).schema(schemas.CLINVAR).csv(path)
    return (with_row_order(rows) if order else rows).select(*schemas.SUMMARY_COLUMNS.values(), *["ord"] * order)


def read_revel(spark: SparkSession, path: str, order: bool = False) -> DataFrame:
    rows = spark.read.option("header", True).schema(schemas.REVEL).csv(path)
    return with_row_order(rows) if order else rows


def read_gnomad(spark: SparkSession, path: str, order: bool = False) -> DataFrame:
    """Saved payloads, one JSON document a line."""
    rows = spark.read.schema(schemas.GNOMAD).json(path)
    return with_row_order(rows) if order else rows


def read_cadd(spark: SparkSession, path: str, order: bool = False, split_bytes: int | None = None) -> DataFrame:
    """Bulk files with the header ``#Chrom``; ``order`` is what the first match at a place is chosen by."""
    if split_bytes:
        rows = blocks.read_fields(spark, path, schemas.CADD, "\t", split_bytes, comment="#")
        return rows if order else rows.drop("ord")
    rows = spark.read.option("sep", "\t").option("comment", "#").schema(schemas.CADD).csv(path)
    return with_row_order(rows) if order else rows


def cadd_from_payload(rows: DataFrame, col: str) -> DataFrame:
    """Rows of ``[[header], [row], ...]`` texts; a missing score is 0."""
    table = F.from_json(F.col(col), "array<array<string>>")
    m = rows.select(F.posexplode(zip_header_rows(table)).alias("place", "m"))
    score = lambda c: F.coalesce(F.try_element_at("m", F.lit(c)), F.lit("0")).try_cast("double").alias(c)
    text = lambda c: F.try_element_at("m", F.lit(c)).alias(c)
    return m.select("place", text("Chrom"), F.try_element_at("m", F.lit("Pos")).try_cast("long").alias("Pos"), text("Ref"), text("Alt"), score("RawScore"), score("PHRED"))


def scored_variants(rows: DataFrame, ord_col: str) -> DataFrame:
    """Rows of ``variant`` (like M1A) with scores, by HGVS; of equal ones the last."""
    ref, position, alt = parse_substitution(F.col("variant"))
    own = rows.where(position.isNotNull())
    keyed = own.select(hgvs_p_from_aa(ref, position, alt).alias("hgvs_p"), ref.alias("aaref"), alt.alias("aaalt"), safe_double(F.col("am_pathogenicity")).alias("alphamissense_score"), F.col("am_class").alias("alphamissense_class"), ord_col)
    return dedupe_last(keyed, ["hgvs_p"], ord_col)


def read_scored_variants(spark: SparkSession, path: str) -> DataFrame:
    return scored_variants(with_row_order(spark.read.option("header", True).schema(schemas.SCORED).csv(path)), "ord").drop("ord")


def read_features(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A stored table; a filter on its gene prunes folders."""
    return spark.read.schema(schemas.TABLES[table]).parquet(path) if table else spark.read.parquet(path)


def gene_dims(spark: SparkSession, proteins: dict | None = None, transcripts: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(gene, uniprot_id) and (gene, transcript_ids), the built-in ones unless others are given."""
    p, t = proteins or schemas.GENE_PROTEINS, transcripts or schemas.GENE_TRANSCRIPTS
    return spark.createDataFrame(list(p.items()), "gene string, uniprot_id string"), spark.createDataFrame(list(t.items()), "gene string, transcript_ids array<string>")
