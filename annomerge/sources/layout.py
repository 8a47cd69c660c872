"""Layouts of large stored tables that later reads and joins need not shuffle or scan whole.

By coordinates: a folder per chromosome and window of positions, sorted by position inside. Readers that ask for some places
get the folders of those from Spark's run-time pruning, whatever the number of rows beside them. By key: buckets, so that
look-ups and merges by that key shuffle the other side alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.functions.scalars import normalize_chromosome
from annomerge.sources.shared import materialise
from annomerge.sources.writers import ROWS_PER_FILE

#: Positions in a window. A score file of all substitutions has three million rows in one.
WINDOW = 1_000_000
PARTS = ("part_chrom", "part_window")
#: Above so many folders that have fewer rows than this on average, windows are widened: folders cost time to write and list.
FOLDERS, ROWS_PER_FOLDER = 1024, 1_000_000


def window_of(chrom: Column, pos: Column, width: int) -> list[Column]:
    """The folder of a place: -1 for a position that is no number."""
    return [F.coalesce(normalize_chromosome(chrom), F.lit("")).alias(PARTS[0]), F.coalesce(F.floor(pos.try_cast("bigint") / width), F.lit(-1)).alias(PARTS[1])]


def fitting_width(rows: DataFrame, chrom: str, pos: str, width: int) -> int:
    """``width``, doubled until there are at most ``FOLDERS`` windows, or ``ROWS_PER_FOLDER`` rows in one on average."""
    found = materialise(rows.select(*window_of(F.col(chrom), F.col(pos), width)).groupBy(*PARTS).agg(F.count("*").alias("_n")), "windows")
    n_rows, folders, last = found.agg(F.sum("_n"), F.count("*"), F.max(PARTS[1])).first()
    factor = 1
    while folders > FOLDERS and n_rows < folders * ROWS_PER_FOLDER and factor <= last:
        factor *= max(2, 1 << (folders // FOLDERS).bit_length() - 1)
        folders = found.select(PARTS[0], F.floor(F.col(PARTS[1]) / factor)).distinct().count()
    return width * factor


def write_by_coordinates(rows: DataFrame, path: str, chrom: str, pos: str, width: int = WINDOW) -> None:
    """Rows are dealt by ranges of places, so that a dense window is several tasks and each task writes few folders. The width in
    the end, which may be more, is stored with the position's column, where readers find it."""
    width = fitting_width(rows, chrom, pos, width)
    noted = rows.withColumn(pos, F.col(pos).alias(pos, metadata={"window": width}))
    dealt = noted.select("*", *window_of(F.col(chrom), F.col(pos), width), F.col(pos).try_cast("bigint").alias("_pos"))
    ordered = dealt.repartitionByRange(*PARTS, "_pos").sortWithinPartitions(*PARTS, "_pos").drop("_pos")
    ordered.write.mode("overwrite").partitionBy(*PARTS).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def read_at_places(spark: SparkSession, path: str, asked: DataFrame, chrom: str, pos: str, width: int = WINDOW) -> DataFrame:
    """All rows of the windows that ``asked`` has places in; exact joins may follow. ``width``: of a table that notes none. The windows are written first, so that Spark
    knows how few they are: it then broadcasts them and prunes folders by them."""
    kind = stored_schema(spark, path)
    width = next((f.metadata["window"] for f in kind if "window" in f.metadata), width)
    windows = materialise(asked.select(*window_of(F.col(chrom), F.col(pos), width)).where(F.col(PARTS[1]) >= 0).distinct(), "windows")
    stored = spark.read.option("mergeSchema", "false").schema(kind).parquet(path)
    return stored.join(windows.where(F.col(PARTS[1]) >= 0), list(PARTS), "left_semi").drop(*PARTS)


def stored_schema(spark: SparkSession, path: str):
    """The stored columns, with folder names as text and number: their types are not guessed from values such as 1 or X."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    own = [f for f in spark.read.parquet(path).schema if f.name not in PARTS]
    return StructType([*own, StructField(PARTS[0], StringType()), StructField(PARTS[1], LongType())])


def write_bucketed(rows: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    """A catalog table of one file per bucket, sorted by the keys."""
    rows.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
