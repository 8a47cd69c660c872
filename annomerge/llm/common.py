"""Bounded samples, hashes and Arrow plumbing that the corpus operators have in common."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.sources.shared import fresh_path, materialise  # noqa: F401

#: ASCII white space; everything else belongs to a word.
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 4; fold 2 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def share_of(key: Column, salt: int) -> Column:
    """A repeatable number in [0, 1) from a key: rows below p make a sample of share p."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)


def bounded_sample(rows: DataFrame, group: str, key: str, per_group: int, most: int | None = None, least: int = 20, salt: int = 17) -> DataFrame:
    """About ``per_group`` rows of each value of ``group``, chosen by a hash of ``key``; about ``most`` over all if that is
    given and there are many values, yet ``least`` of each; never more than twice that. All rows of a rare value.

    One count per group, then a filter: no sort, and no group meets in one task. Rows with a null group are left out.
    """
    sizes = materialise(rows.groupBy(F.col(group).alias("_value")).agg(F.count("*").alias("_n")).where("_value IS NOT NULL"), "groups")
    groups = max(1, sizes.count())
    each = per_group if most is None else max(min(per_group, least), min(per_group, most // groups))
    kept = rows.join(sizes, F.col(group) == F.col("_value")).where(share_of(F.col(key), salt) < F.lit(float(each)) / F.col("_n"))
    return kept.drop("_value", "_n").limit(2 * each * groups)


def numbered(docs: DataFrame, *columns: str) -> tuple:
    """The rows with columns c0, c1, ..., so that no name of an operator's own can meet one, and the new names of ``columns``."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), *[f"c{docs.columns.index(c)}" for c in columns]


def renamed(rows: DataFrame, columns: list[str], *new: str) -> DataFrame:
    """Back from ``numbered``: those of ``columns`` that rows still have, under their names, and the columns ``new``; an old
    column with the name of a new one gives way to it."""
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns) if f"c{i}" in rows.columns and c not in new]
    return rows.select(*own, *new)


def slices(batch: pa.RecordBatch, at: int, rows: int = 4096, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and about ``size`` bytes in column ``at``."""
    lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    first = held = 0
    for i, n in enumerate(lengths):
        if i > first and (held + n > size or i - first == rows):
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def map_texts(df: DataFrame, text_col: str, make: Callable[[], Callable[..., dict[str, list]]], fields: str, keep_text: bool = False, also: tuple = ()) -> DataFrame:
    """Columns computed from whole texts, beside the rows' own columns.

    ``make()`` runs once a task; what it returns takes a list of texts, and one of each column of ``also``, and gives a list
    for each of ``fields`` (a DDL string of new columns, which must not clash with the others: callers prefix theirs). The
    text itself goes back to Spark only if asked for.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    new = _parse_datatype_string(fields)
    own = [f for f in df.schema if keep_text or f.name != text_col]
    if clash := {f.name for f in own} & {f.name for f in new}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    kind = StructType([StructField(f.name, f.dataType) for f in own] + list(new))
    arrow = to_arrow_schema(new)
    names, at = [f.name for f in own], df.columns.index(text_col)
    places, more = [df.columns.index(n) for n in names], [df.columns.index(n) for n in also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for whole in batches:
            for batch in slices(whole, at):
                got = score(batch.column(at).to_pylist(), *[batch.column(i).to_pylist() for i in more])
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in places] + [pa.array(got[f.name], f.type) for f in arrow], [*names, *arrow.names])

    return df.mapInArrow(run, kind)


@functools.cache
def letter_table():
    """Whether a code point is a letter, for all code points; made once a worker."""
    import numpy as np

    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letter_codes(text: str, letters):
    """Lower-cased code points with every run of other characters as one space, one space at either end; None without letters."""
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    spread = np.full(len(codes) + 2, 32, np.uint32)
    spread[1:-1] = np.where(letters[codes], codes, 32)
    gap = spread == 32
    kept = spread[np.concatenate(([True], ~(gap[1:] & gap[:-1])))]
    return kept if len(kept) > 1 else None


@functools.cache
def word_table():
    """Whether a code point belongs to a word: letters, digits and the underscore."""
    import numpy as np

    return np.fromiter((chr(i).isalnum() or i == 95 for i in range(0x110000)), bool, 0x110000)


def mix(h):
    """A bijection of 64-bit numbers that spreads every bit; h is a uint64 array."""
    import numpy as np

    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(text: str | None, words):
    """64-bit hashes of the lower-cased words of a text, in order; equal on every machine."""
    import numpy as np

    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = words[codes]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, lengths = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = lengths - starts
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), 0x2545F4914F6CDD1D, np.uint64))
    return mix(np.add.reduceat((codes[inside].astype(np.uint64) + np.uint64(1)) * power[place], first))


def window_hashes(hashes, n: int):
    """Hashes of all windows of n words."""
    import numpy as np

    k = len(hashes) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:k].copy()
    for i in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[i : i + k]
    return mix(out)


def components(edges: DataFrame, name: str = "components", most: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v longs), root being the smallest node that it is connected to.

    Alternating large and small stars: each round only takes minima of neighbours and joins them back, and ends in a
    written table. Nodes without an edge are not in the result.
    """
    now = materialise(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = None
    for _ in range(most):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a plain table of minima on this side lets Spark split the neighbours of a hub on the other
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), name)
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = materialise(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), name)
        found = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if found == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = found
    raise RuntimeError(f"components did not settle in {most} rounds")
