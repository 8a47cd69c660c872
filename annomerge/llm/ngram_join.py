"""Similarity join of documents on five-word shingles by chosen paths.

Sets become signatures of min-hash tokens. A path chooses coordinates of the signature; documents that agree on the
chosen token stay together. A bucket of many documents is split again on further sampled tokens; one of few is compared
by brute force on the exact shingle sets. Several runs with coordinates of their own reach the target recall.

Scale: texts with equal shingle sets are one representative. A bucket is compared in blocks against blocks, bounded in
documents and in shingles, so no task holds more than two blocks. A pair that meets in several buckets is counted in the
smallest of their common ones alone, so links are counted without ever listing pairs. Signatures decide first which
documents of a bucket are in such a pair, and only those bring their shingles. Per bucket come back one row
for each linked document, with its number of links and a root, and connected components of those give the classes.

Defined cases: null texts and texts without words link to nothing and are classes of their own; texts of fewer than five
words have one shingle, all their words; repeated rows are copies of one another; rows with a null id are told with
null class and no links; of rows with one id and different texts, one stands for the id; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import components, materialise, mix, numbered, renamed, slices, window_hashes, word_hashes, word_table

SHINGLE = 5
COORDINATES = 64


def shingles(text: str | None, words):
    """Sorted distinct 64-bit shingles; a short text has one, of all its words."""
    import numpy as np

    hashes = word_hashes(text, words)
    return np.unique(window_hashes(hashes, min(SHINGLE, len(hashes)))) if len(hashes) else hashes


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, set_hash (128 bits of the shingle set, null for an empty one), n (its size), signature (min-hash tokens) and
    brief, 16 bits of each token."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = word_table()
        seeds = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for whole in batches:
            for batch in slices(whole, 1):
                hashes, sizes, rows, brief = [], [], [], []
                for text in batch.column(1).to_pylist():
                    own = shingles(text, words)
                    sizes.append(len(own))
                    if not len(own):
                        hashes.append(None)
                        rows.append(None)
                        brief.append(None)
                        continue
                    hashes.append(xxhash.xxh3_128_hexdigest(own.tobytes()))
                    low = np.full(COORDINATES, np.iinfo(np.uint64).max)
                    for first in range(0, len(own), 4096):
                        part = own[first : first + 4096, None] * seeds
                        low = np.minimum(low, (part ^ (part >> np.uint64(32))).min(0))
                    rows.append(low.view(np.int64).tolist())
                    brief.append(low.astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.string()), pa.array(sizes, pa.int64()), pa.array(rows, pa.list_(pa.int64())), pa.array(brief, pa.binary())], ["doc", "set_hash", "n", "signature", "brief"])

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc long, set_hash string, n long, signature array<long>, brief binary")


def root_buckets(runs: int, first: int) -> Column:
    """Buckets of the first splits: each run's own coordinates."""
    roots = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(c).alias("c")) for r in range(runs) for c in range(r * first, (r + 1) * first)])
    return F.transform(roots, lambda x: F.xxhash64(x["run"], x["c"], F.get("signature", x["c"])))


def chosen_buckets(heads: DataFrame, marks: DataFrame, branch: float, limit: int, depth: int) -> DataFrame:
    """(bucket, doc, size, total) of all buckets with at least two documents that are not split further; total is the number
    of their shingles.

    heads: doc, n and its root buckets; marks: doc and signature, looked up only for documents of wide buckets. A bucket of
    more than ``limit`` documents splits on the coordinates that a hash of its own puts first, ``branch`` rounded up, up to
    ``depth`` times. None picks fewer: a bucket that picked none would be lost with all its documents.
    """
    now = heads.select("doc", "n", F.explode("roots").alias("bucket"))
    done = signed = None
    for level in range(depth + 1):
        now = materialise(now, "paths")
        sizes = now.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("n").alias("total"), F.expr("bit_xor(xxhash64(doc, 1))").alias("f1"), F.expr("bit_xor(xxhash64(doc, 2))").alias("f2")).where("size > 1")
        sizes = materialise(sizes, "sizes")  # a plain table, so that Spark can split a hot bucket in the joins with it
        ends = sizes if level == depth else sizes.where(F.col("size") <= limit)
        # buckets of the same documents would be compared alike: one of them is enough
        ends = ends.groupBy("f1", "f2", "size", "total").agg(F.min("bucket").alias("bucket")).select("bucket", "size", "total")
        leaves = now.join(ends, "bucket").select("bucket", "doc", "size", "total")
        done = leaves if done is None else done.unionByName(leaves)
        if level == depth:
            break
        wide = now.join(sizes.where(F.col("size") > limit).select("bucket"), "bucket")
        if wide.isEmpty():
            break
        if signed is None:
            signed = materialise(marks.join(wide.select("doc").distinct(), "doc").groupBy("doc").agg(F.first("signature").alias("signature")), "signed")
        order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda c: F.struct(F.xxhash64("bucket", c).alias("h"), c.alias("c"))))
        picked = F.slice(order, 1, min(COORDINATES, math.ceil(branch)))["c"]
        now = wide.join(signed, "doc").select("doc", "n", F.explode(F.transform(picked, lambda c: F.xxhash64("bucket", c, F.get("signature", c)))).alias("bucket"))
    return done


def in_blocks(leaves: DataFrame, block: int, shingles_held: int) -> DataFrame:
    """(bucket, b1, b2, side, doc): a bucket is cut in blocks of about ``block`` documents, fewer where they are long, by a
    hash, and each pair of blocks is a task's work; side tells which of the two a document is in."""
    n = F.ceil(F.greatest(F.col("size") / block, F.col("total") / shingles_held)).cast("int")
    rows = leaves.withColumn("n", n).withColumn("b", F.pmod(F.xxhash64("doc", "bucket"), F.col("n")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return rows.select("bucket", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"), F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "doc")


def bit_rows(owner, columns, m: int):
    """Rows of bits, one per document, with bit columns[k] set in row owner[k]; as 64-bit words."""
    import numpy as np

    width = int(columns.max()) // 64 + 1 if len(columns) else 1
    held = np.zeros((m, 64 * width), bool)
    held[owner, columns] = True
    return np.packbits(held, axis=1).view(np.uint64)


def common_bits(bits, i, j):
    """How many bits rows i and j share, pair by pair."""
    import numpy as np

    step = max(1, (4 << 20) // bits.shape[1])
    return np.concatenate([np.bitwise_count(bits[i[k : k + step]] & bits[j[k : k + step]]).sum(1, dtype=np.int64) for k in range(0, len(i), step)] or [np.zeros(0, np.int64)])


def met_before(bucket: int, buckets: list[list[int]], i, j):
    """Which pairs share a bucket smaller than this one, where they are counted."""
    import numpy as np

    sizes = [len(b) for b in buckets]
    owner, flat = np.repeat(np.arange(len(buckets)), sizes), np.fromiter((x for b in buckets for x in b), np.int64, sum(sizes))
    owner, flat = owner[flat < bucket], flat[flat < bucket]
    names, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    twice = (times > 1)[column]
    before = np.zeros(len(i), bool)
    column, owner = rank[column[twice]], owner[twice]
    for first in range(0, int((times > 1).sum()), 4096):
        here = (column >= first) & (column < first + 4096)
        before |= common_bits(bit_rows(owner[here], column[here] - first, len(buckets)), i, j) > 0
    return before


def agreeing(brief: list[bytes], side: list[int], one_block: bool, least: int):
    """Pairs (i, j) of signatures that agree on at least ``least`` tokens: all of one block, or those between two."""
    import numpy as np

    rows, of = np.frombuffer(b"".join(brief), np.uint16).reshape(len(brief), COORDINATES), np.array(side)
    first, second = (np.arange(len(brief)),) * 2 if one_block else (np.flatnonzero(of == 0), np.flatnonzero(of != 0))
    agree = np.zeros((len(first), len(second)), np.uint8)
    for c in range(COORDINATES):
        agree += rows[first, None, c] == rows[None, second, c]
    close = agree >= least
    i, j = np.nonzero(np.triu(close, 1) if one_block else close)
    return first[i], second[j]


def screen(bucket: int, b1: int, b2: int, rows: list[tuple], least: int) -> list[tuple]:
    """The documents, of rows (side, doc, buckets, brief), in a pair that agrees and is counted in this bucket."""
    import numpy as np

    i, j = agreeing([r[3] for r in rows], [r[0] for r in rows], b1 == b2, least)
    own = ~met_before(bucket, [r[2] for r in rows], i, j)
    return [(bucket, b1, b2, rows[k][0], rows[k][1]) for k in np.unique(np.concatenate((i[own], j[own]))).tolist()]


def shared_shingles(sets: list, i, j):
    """Size of the intersection, pair by pair: shingles that all hold are counted once, those of one document not at all,
    the rest as bits."""
    import numpy as np

    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    some = (times > 1) & (times < m)
    rank = np.cumsum(some) - 1
    mid = some[column]
    column, owner = rank[column[mid]], owner[mid]
    shared = np.full(len(i), int((times == m).sum()), np.int64)
    for first in range(0, int(some.sum()), 16_384):
        here = (column >= first) & (column < first + 16_384)
        shared += common_bits(bit_rows(owner[here], column[here] - first, m), i, j)
    return shared


def count_links(bucket: int, b1: int, b2: int, rows: list[tuple], threshold: float, least: int) -> list[tuple[int, int, int]]:
    """(doc, links, root) of each linked document, by exact comparison of the pairs that agree; rows: (side, doc, copies,
    buckets, brief, shingles)."""
    import numpy as np

    m = len(rows)
    i, j = agreeing([r[4] for r in rows], [r[0] for r in rows], b1 == b2, least)
    sets = [np.frombuffer(r[5], "<u8") for r in rows]
    sizes = np.array([len(s) for s in sets])
    shared = shared_shingles(sets, i, j)
    near = shared >= threshold * (sizes[i] + sizes[j] - shared) - 1e-9
    i, j = i[near], j[near]
    own = ~met_before(bucket, [r[3] for r in rows], i, j)
    copies, links = np.array([r[2] for r in rows]), np.zeros(m, np.int64)
    np.add.at(links, i[own], copies[j[own]])
    np.add.at(links, j[own], copies[i[own]])
    root = np.arange(m)  # rows come by id, so the smallest index is the smallest id
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    return [(rows[k][1], int(links[k]), rows[root[k]][1]) for k in np.unique(np.concatenate((i, j))).tolist()]


def by_task(tasks: DataFrame, columns: list[str], work, schema: str) -> DataFrame:
    """Rows that ``work(bucket, b1, b2, rows)`` gives for each task's rows of ``columns``, side and doc first. A task's rows
    are held at once: two blocks at most. A row that repeats a document is left out."""
    names = ["bucket", "b1", "b2"]
    fields = [x.strip().split()[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(len(fields))], fields)
        for batch in batches:
            for bucket, b1, b2, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, b1, b2) != key:
                    if len(rows) > 1:
                        out += work(*key, rows)
                    key, rows = (bucket, b1, b2), []
                if not rows or rows[-1][1] != row[1]:
                    rows.append(tuple(row))
            if out:
                yield pack()
                out = []
        if len(rows) > 1:
            out += work(*key, rows)
        if out:
            yield pack()

    return tasks.repartition(*names).sortWithinPartitions(*names, "doc").select(*names, *columns).mapInArrow(run, schema)


def shingle_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, shingles): the sorted set as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table()
        for whole in batches:
            for batch in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t, words).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["doc", "shingles"])

    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc long, shingles binary")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, runs: int = 3, first: int = 3, branch: float = 1.6, limit: int = 2048, depth: int = 3, slack: float = 0.2, block: int = 512, shingles_held: int = 1 << 20) -> DataFrame:
    """One row per row of docs: doc_id; rep_id, the smallest id with the same shingle set; class_id, the smallest id that
    links lead to; n_links, the number of other documents whose similarity is at least the threshold.

    Pairs whose signatures agree on ``slack`` less than the threshold are not compared exactly: with 64 tokens, that
    loses fewer than one in ten thousand pairs at the threshold. With ``slack`` equal to the threshold every pair of a
    bucket is compared. Buckets above ``limit`` documents are split; all are compared in blocks of about ``block``
    documents and ``shingles_held`` shingles."""
    marks = materialise(signatures(docs, id_col, text_col), "signatures")
    groups = marks.where("doc IS NOT NULL AND set_hash IS NOT NULL").groupBy("set_hash").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    groups = materialise(groups, "sets")
    own = marks.select("doc", "set_hash", "n", root_buckets(runs, first).alias("roots"), "brief").join(groups.select("set_hash", F.col("rep").alias("doc"), "copies"), ["set_hash", "doc"])
    heads = materialise(own.groupBy("doc").agg(F.first("roots").alias("roots"), F.first("brief").alias("brief"), F.first("copies").alias("copies"), F.first("n").alias("n")), "heads")
    leaves = materialise(chosen_buckets(heads, marks, branch, limit, depth), "leaves")
    members = leaves.groupBy("doc").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    members = materialise(members.join(heads.drop("roots", "n"), "doc"), "members")
    least = int((threshold - slack) * COORDINATES)
    blocks = in_blocks(leaves, block, shingles_held)
    near = by_task(blocks.join(members, "doc"), ["side", "doc", "buckets", "brief"], lambda *task: screen(*task, least), "bucket long, b1 long, b2 long, side long, doc long")
    near = materialise(near, "near")
    asked = near.select("doc").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    sets = shingle_sets(texts.join(asked, "doc", "left_semi"), "doc", "text")
    compared = by_task(near.join(members.join(sets, "doc"), "doc"), ["side", "doc", "copies", "buckets", "brief", "shingles"], lambda *task: count_links(*task, threshold, least), "doc long, links long, root long")
    found = materialise(compared, "links")
    links = found.groupBy("doc").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("doc").alias("u"), F.col("root").alias("v")), "classes")
    known = groups.join(links, groups["rep"] == links["doc"], "left").drop("doc").join(classes, F.col("rep") == F.col("node"), "left")
    known = known.select("set_hash", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("root"))
    rows = marks.select("doc", "set_hash").join(known, "set_hash", "left")
    none = F.col("doc").isNull()
    return rows.select(F.col("doc").alias("doc_id"), F.when(~none, F.coalesce("rep", "doc")).alias("rep_id"), F.when(~none, F.coalesce("root", "doc")).alias("class_id"), F.when(none, 0).otherwise(F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row of each class, that with the smallest id; rows with a null id or without words stay.

    Where an id stands more than once, rows are told apart by numbers of their own, so that a row goes only if its own text
    has a copy that stays."""
    rows, own_id, text = numbered(docs, id_col, text_col)
    if rows.where(F.col(own_id).isNotNull()).groupBy(own_id).count().where("count > 1").isEmpty():
        told = materialise(similar(rows, own_id, text, threshold), "kept")
        drop = told.where("doc_id IS NOT NULL AND doc_id != class_id").select(F.col("doc_id").alias("dropped")).distinct()
        # a merge join at every size: the list grows with the documents and is not for broadcasting
        return renamed(rows.join(drop.hint("merge"), F.col(own_id).cast("long") == F.col("dropped"), "left_anti"), docs.columns)
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    known = rows.where(F.col(own_id).isNotNull())
    told = similar(known.select("row", text), "row", text, threshold).select(F.col("doc_id").alias("row"), "class_id")
    ranked = told.join(known.select("row", F.col(own_id).cast("long").alias("id")), "row")
    first = materialise(ranked.groupBy("class_id").agg(F.min(F.struct("id", "row"))["row"].alias("kept")), "kept")
    stay = known.join(first.hint("merge"), F.col("row") == F.col("kept"), "left_semi")
    return renamed(stay.unionByName(rows.where(F.col(own_id).isNull())), docs.columns)
