"""Writers. Each writes to a path of its own; none reads what it overwrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.operators.lof import routed

#: The most rows in one file of a gene, so that a huge gene is many files.
ROWS_PER_FILE = 2_000_000


def write_gene_cache(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """All genes in one pass, a folder each."""
    writer = rows.write.mode("overwrite").partitionBy("gene").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.option("sep", "\t").option("header", True).csv(path) if fmt == "tsv" else writer.parquet(path)


def export_csv(rows: DataFrame, path: str, gene: str | None = None, order: str = "hgvs_p") -> bool:
    """Rows, of one gene or all, sorted, as CSV with a header; nothing is written, and False returned, if there are none."""
    own = rows.where(F.col("gene") == gene.upper()) if gene else rows
    if own.isEmpty():
        return False
    flat = own.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in own.dtypes])
    flat.orderBy(*["gene"] * (gene is None), order).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return True


def export_json(rows: DataFrame, path: str) -> None:
    """JSON lines with NULLs kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_features(rows: DataFrame, path: str) -> None:
    """Parquet by gene. Rows are rebalanced by gene: Spark splits what a huge gene would put in one task and joins small ones."""
    rows.hint("rebalance", "gene").write.mode("overwrite").partitionBy("gene").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def write_tsv(rows: DataFrame, path: str) -> None:
    flat = rows.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c).cast("int").alias(c) if t == "boolean" else F.col(c) for c, t in rows.dtypes])
    flat.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_routes(rows: DataFrame, path: str) -> None:
    """One job, and one scan of the rows, for both outputs: a folder per ``variant_type`` of ``lof.routed``."""
    routed(rows).write.mode("overwrite").partitionBy("variant_type").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
