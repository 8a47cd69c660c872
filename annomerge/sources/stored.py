"""Stored variant tables: Parquet in a folder per gene, of a fixed schema, that loads of some genes update in place.

A load rewrites the folders of its own genes and no others: Spark prunes the stored side to them at run time, writes the new rows
aside and moves whole folders when its job commits, so a load that fails before leaves the table as it was. A load that is
repeated, with its time, changes nothing more (but that rows without a key are inserted again, as they never match).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from annomerge.operators.merge import merge
from annomerge.operators.stats import COVERAGE
from annomerge.sources import schemas
from annomerge.sources.shared import materialise
from annomerge.sources.writers import ROWS_PER_FILE

KEYS = {"variants_missense": ["gene", "hgvs_p"], "variants_lof": ["gene", "hgvs_c"]}
#: What a new row has in columns that its source lacks.
DEFAULTS = {"genome_build": "GRCh38"}


def read_stored(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The table, or no rows where nothing is stored yet."""
    kind = _parse_datatype_string(schemas.TABLES[table])
    try:
        return spark.read.schema(kind).parquet(path).select(*kind.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kind)


def of_genes(stored: DataFrame, genes: DataFrame) -> DataFrame:
    """Rows of the genes; folders of others are not read."""
    return stored.join(genes.where("gene > ''").select("gene"), "gene", "left_semi")


def merge_stamped(target: DataFrame, source: DataFrame, keys: list[str], loaded_at: datetime, keep: list[str] = (), insert_only: list[str] = ()) -> DataFrame:
    """A merge that tells times: rows of the source get ``updated_at``, new ones ``created_at`` too, which old ones keep."""
    at = F.lit(loaded_at).cast("timestamp")
    return merge(target, source.withColumns({"created_at": at, "updated_at": at}), keys, keep, [*insert_only, "created_at"])


def conform(rows: DataFrame, table: str) -> DataFrame:
    """All columns of the table, in its order and types."""
    kind = _parse_datatype_string(schemas.TABLES[table])
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind])


def replace_genes(rows: DataFrame, path: str) -> None:
    """Rows become the folders of their genes; other folders stay. A huge gene is many tasks and files."""
    writer = rows.hint("rebalance", "gene").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("gene").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def upsert(spark: SparkSession, path: str, table: str, source: DataFrame, loaded_at: datetime, keep: list[str] = (), insert_only: list[str] = ()) -> DataFrame:
    """Merge a source, which holds a key once and any of the table's columns, into the stored table; returns its genes.

    Rows without a gene, which the table requires, are left out, as are rows of variants_lof without a type. The source is
    evaluated once, to a written table: its genes choose what is read of the stored one. A column that the table lacks is an error.
    """
    if unknown := set(source.columns) - set(_parse_datatype_string(schemas.TABLES[table]).names):
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    known = source.where("gene IS NOT NULL" + " AND lof_type IS NOT NULL" * (table == "variants_lof"))
    staged = materialise(known, "load")
    genes = materialise(staged.select("gene").distinct(), "genes")
    new = {c: v for c, v in DEFAULTS.items() if c not in staged.columns}
    merged = merge_stamped(of_genes(read_stored(spark, path, table), genes), staged.withColumns({c: F.lit(v) for c, v in new.items()}), KEYS[table], loaded_at, keep, [*insert_only, *new])
    replace_genes(conform(merged, table), path)
    return genes


def refresh_coverage(spark: SparkSession, path: str, table: str, state: str, genes: DataFrame) -> None:
    """Count the rows of these genes anew; the counts of others stay as they are stored."""
    counted = of_genes(read_stored(spark, path, table), genes).groupBy("gene").agg(F.count("*").alias("total"), *[F.count(c).alias(n) for n, c in COVERAGE.items()])
    replace_genes(counted, state)


def coverage_report(spark: SparkSession, state: str) -> DataFrame:
    """The stored counts, largest gene first. No variant is read."""
    kind = ", ".join(["gene string", "total long", *[f"{n} long" for n in COVERAGE]])
    return spark.read.schema(kind).parquet(state).groupBy("gene").agg(*[F.sum(c).alias(c) for c in ("total", *COVERAGE)]).orderBy(F.desc("total"), "gene")
