"""Arrays, structs and header rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.functions.scalars import homozygotes, preferred
from annomerge.operators.ordinals import dense_order


def match_transcripts(wanted: Column, listed: Column) -> Column:
    """Wanted transcripts that the ;-separated list holds, in the wanted order; NULL if none."""
    both = F.array_intersect(wanted, F.split(listed, ";"))
    return F.when(F.size(both) > 0, both)


def flatten_gnomad(payloads: DataFrame, ord_col: str | None = None) -> DataFrame:
    """One row per variant of ``data.gene.variants``, with its place there; genes without variants give none. ``ord_col``, the
    order of the payloads, gives ``ord``, that of the variants."""
    kept = [F.col(ord_col).alias("payload")] if ord_col else []
    rows = payloads.select(F.col("data.gene.symbol").alias("symbol"), *kept, F.posexplode("data.gene.variants").alias("place", "v"))
    return rows.select(
        "symbol", "place", *[F.struct("payload", "place").alias("ord")] * len(kept), F.col("v.variant_id").alias("variant_id"), F.col("v.hgvsc").alias("hgvs_c"), F.col("v.hgvsp").alias("hgvs_p"), F.col("v.consequence").alias("consequence"),
        preferred(F.col("v.exome.af"), F.col("v.genome.af")).alias("gnomad_af"),
        preferred(F.col("v.exome.an"), F.col("v.genome.an")).alias("gnomad_an"),
        homozygotes(F.col("v.exome.homozygote_count"), F.col("v.genome.homozygote_count")).alias("gnomad_homozygotes"),
    )


def zip_header_rows(table: Column) -> Column:
    """array<map> of the rows of an array of arrays whose first is the header; empty with fewer than two."""
    rows = F.slice(table, F.lit(2), F.greatest(F.size(table) - 1, F.lit(0)))
    return F.transform(F.filter(rows, lambda r: F.size(r) == F.size(table[0])), lambda r: F.map_from_arrays(table[0], r))


def positions_by_substitution(rows: DataFrame, keys: list[str], ord_col: str, fields: list[str], chunk: int = 10_000) -> DataFrame:
    """Per key, the rows' ``fields`` in row order, in arrays of at most ``chunk``: ``chunk`` numbers a key's arrays from 0. A key's
    rows are numbered by ``dense_order``, so that none of them must meet in one task."""
    numbered = dense_order(rows.select(*keys, ord_col, *fields), [ord_col], keys, "_number")
    listed = F.sort_array(F.collect_list(F.struct("_number", *fields)))
    grouped = numbered.groupBy(*keys, F.floor(F.col("_number") / chunk).alias("chunk"))
    return grouped.agg(F.transform(listed, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("positions"))
