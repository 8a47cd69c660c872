"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task makes of those dealt to it. A sort holds some hundred bytes of each.
ROWS_PER_TASK = 500_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local session gets a temporary folder; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="annomerge-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def deal(rows: DataFrame, keys: list[str], each: int = 1, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows of a small file that become ``each`` times as many, dealt to as many tasks as give about ``per_task`` of those each. A file
    is read in splits of bytes, which know nothing of what becomes of a row; rows are told from the file's footer."""
    n = -(-rows.count() * each // per_task)
    return rows.repartition(n, *keys) if n > 1 else rows


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, a lost executor costs nothing, and the size is known."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
