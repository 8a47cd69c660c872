"""Passages that repeat across documents, by sparse suffix arrays.

Only suffixes that start at minimisers are kept: of every run of ``span`` successive k-grams the one of least hash, so the
same passage keeps the same suffixes wherever it stands. Suffixes whose first words stand in different texts are sorted
with their words; each is compared with its neighbour, word by word, and the matches are extended to the left in the
order of the words before. Stretches whose every window of the least length stands in another document are the spans.

Why nothing is missed: with least length 50, k = 8 and runs of 33 k-grams, the run that starts with a window of 50 words
lies inside it, so the suffix kept for that run is the same wherever the window stands, starts at most 32 words in and
has at least 18 words inside; 18 is the length of the prefix. Each window is told by that suffix alone. Hashes of first
words only choose what is sorted; words decide, except for words of more than 40 characters, which stand for their
128-bit digests.

Scale: documents of equal words are one until the end, and suffixes in equal surroundings are one while they are
compared, both by partial minima. Joins by hot keys have a written table on the other side, so they can be split. A
task sorts at most ``limit`` different contexts of one prefix; where there are more, their windows are compared by
partial minima over 128-bit digests, which gives the same rows.

Defined cases: null, empty and short texts have no spans; texts of equal words are spans from end to end if long enough;
what repeats inside one document alone does not count; rows with a null id are left out; repeated rows of one id and
text count once; different texts of one id are told together; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annomerge.llm.common import materialise, slices, window_hashes, word_hashes, word_table

GRAM = 8
WORD = re.compile(r"\w+")


def anchors(hashes, span: int):
    """For each run of ``span`` k-grams, by its start, the place of its least one, the first of equal ones. The kept
    suffixes of a text are those at any of these places."""
    import numpy as np

    grams = window_hashes(hashes, GRAM)
    if len(grams) < span:
        return np.zeros(0, np.int64)
    found = []
    for first in range(0, len(grams) - span + 1, 65_536):
        part = grams[first : first + 65_536 + span - 1]
        found.append(np.lib.stride_tricks.sliding_window_view(part, span).argmin(1) + np.arange(first, first + len(part) - span + 1))
    return np.concatenate(found)


def kept_suffixes(docs: DataFrame, id_col: str, text_col: str, length: int, span: int, prefix: int) -> DataFrame:
    """doc, words_hash (of the whole word sequence), n_words, and the hash of the first words at each minimiser."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        words = word_table()
        for whole in batches:
            for batch in slices(whole, 1):
                keys, sizes, starts, heads = [], [], [], []
                for text in batch.column(1).to_pylist():
                    own = word_hashes(text, words)
                    keys.append(xxhash.xxh3_128_hexdigest(own.tobytes()))
                    sizes.append(len(own))
                    at = np.unique(anchors(own, span)) if len(own) >= length else np.zeros(0, np.int64)
                    at = at[at + prefix <= len(own)]
                    starts.append(at.tolist())
                    heads.append(window_hashes(own, prefix)[at].view(np.int64).tolist() if len(at) else [])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys), pa.array(sizes, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(heads, pa.list_(pa.int64()))], ["doc", "words_hash", "n_words", "starts", "heads"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc IS NOT NULL")
    return rows.mapInArrow(run, "doc long, words_hash string, n_words long, starts array<int>, heads array<long>")


def contexts_at(texts: DataFrame, length: int, span: int) -> DataFrame:
    """A row for each matched suffix of (doc, text, places, heads): the words from its place on, and those before it, last
    one first, as far as the windows reach whose own kept suffix it is; and 128 bits of both. A word longer than 40
    characters is told by its digest."""
    names = ["doc", "place", "head", "k1", "k2", "right", "left"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        table = word_table()
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        packed = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names)
        for whole in batches:
            for batch in slices(whole, 1, rows=256, size=1 << 20):
                out = []
                for doc, text, places, heads in zip(*(c.to_pylist() for c in batch.columns)):
                    own = word_hashes(text, table)
                    if len(own) < length:
                        continue
                    nearest = anchors(own, span)[: len(own) - length + 1]
                    firsts, lasts = np.searchsorted(nearest, places), np.searchsorted(nearest, places, "right")
                    words = [w if len(w) <= 40 else "#" + xxhash.xxh3_128_hexdigest(w.encode("utf-8", "surrogatepass")) for w in WORD.findall(text.lower())]
                    for place, head, first, behind in zip(places, heads, firsts.tolist(), lasts.tolist()):
                        if first < behind:
                            right, left = " ".join(words[place : behind - 1 + length]), " ".join(words[first:place][::-1])
                            key = xxhash.xxh3_128_intdigest(f"{right}|{left}".encode("utf-8", "surrogatepass"))
                            out.append((doc, place, head, signed(key >> 64), signed(key & (1 << 64) - 1), right, left))
                            if len(out) == 10_000:
                                yield packed(out)
                                out = []
                if out:
                    yield packed(out)

    return texts.select("doc", "text", "places", "heads").mapInArrow(run, "doc long, place int, head long, k1 long, k2 long, right string, left string")


def word_matrix(rows: list[str], width: int):
    """Numbers of the words of each row, equal for equal words, -1 behind the last; and how many words each row has."""
    import numpy as np

    sizes = np.array([r.count(" ") + 1 if r else 0 for r in rows], np.int64)
    words = pa.array([w for r in rows if r for w in r.split(" ")], pa.string())
    out = np.full((len(rows), width), -1, np.int32)
    owner = np.repeat(np.arange(len(rows)), sizes)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = words.dictionary_encode().indices.to_numpy()
    return out, sizes


def common_with_last(matrix, order, heads):
    """For each row, in the given order, how many first words it shares with the row before; -1 where another head begins."""
    import numpy as np

    sorted_ = matrix[order]
    same = (sorted_[1:] == sorted_[:-1]) & (sorted_[1:] >= 0)
    shared = np.concatenate(([-1], np.where(same.all(1), matrix.shape[1], same.argmin(1)))) if matrix.shape[1] else np.zeros(len(order), np.int64)
    shared[np.concatenate(([True], heads[order][1:] != heads[order][:-1]))] = -1
    return shared


def shared_windows(heads, right: list[str], left: list[str], low, high, length: int, span: int):
    """(row, from, to, low): the windows that begin ``from`` to ``to`` words before a suffix and stand in different texts.

    Rows come sorted by head and right context: suffixes in order, each compared with its neighbour. Those whose right
    contexts share r words are a run of neighbours; those whose left contexts share l words are one in the order of these.
    A window that begins l words before its suffix is the rows that are in one run of r = length - l and one of l.
    """
    import numpy as np

    m = len(heads)
    ahead, n_right = word_matrix(right, length)
    back, n_left = word_matrix(left, span - 1)
    order = np.array(sorted(range(m), key=lambda k: (heads[k], left[k])), np.int64)
    of_right, of_left = common_with_last(ahead, np.arange(m), heads), common_with_last(back, order, heads)
    mask, found = np.zeros((m, span), bool), np.zeros((m, span), np.int64)
    run_left = np.empty(m, np.int64)
    for before in range(span):
        rows = np.flatnonzero((n_left >= before) & (n_right >= length - before))
        if not len(rows):
            continue
        run_left[order] = np.cumsum(of_left < before)
        both = run_left[rows] * (m + 1) + np.cumsum(of_right < length - before)[rows]
        by = np.argsort(both, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(both[by]) != 0)))
        least, most = np.minimum.reduceat(low[rows][by], starts), np.maximum.reduceat(high[rows][by], starts)
        sizes = np.diff(np.append(starts, len(rows)))
        mask[rows[by], before] = np.repeat(least < most, sizes)
        found[rows[by], before] = np.repeat(least, sizes)
    new = mask.copy()
    new[:, 1:] &= ~mask[:, :-1] | (found[:, 1:] != found[:, :-1])
    last = mask.copy()
    last[:, :-1] &= ~mask[:, 1:] | new[:, 1:]
    row, begin = np.nonzero(new)
    return row, begin, np.nonzero(last)[1], found[row, begin]


def compare_neighbours(rows: DataFrame, length: int, span: int, at_once: int = 8192) -> DataFrame:
    """(k1, k2, from, to, low) of distinct contexts, whole groups of equal heads at a time."""
    schema, names = "k1 long, k2 long, from int, to int, low long", ["k1", "k2", "from", "to", "low"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def done(t: pa.Table) -> pa.RecordBatch:
            head, k1, k2, low, high = (t.column(c).to_numpy() for c in ("head", "k1", "k2", "low", "high"))
            row, begin, end, least = shared_windows(head, t.column("right").to_pylist(), t.column("left").to_pylist(), low, high, length, span)
            return pa.RecordBatch.from_arrays([pa.array(x.astype(kind)) for x, kind in ((k1[row], np.int64), (k2[row], np.int64), (begin, np.int32), (end, np.int32), (least, np.int64))], names)

        held: list[pa.RecordBatch] = []
        for whole in batches:
            for batch in (whole.slice(k, at_once) for k in range(0, whole.num_rows, at_once)):
                held.append(batch)
                if sum(b.num_rows for b in held) >= at_once:
                    table = pa.Table.from_batches(held)
                    head = table.column("head").to_numpy()
                    cut = int(np.searchsorted(head, head[-1]))  # the last group may go on
                    if cut:
                        yield done(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    return rows.select("head", "right", "left", "k1", "k2", "low", "high").mapInArrow(run, schema)


def windows_of(rows: DataFrame, length: int) -> DataFrame:
    """(k1, k2, before, w1, w2, low, high): the windows of distinct contexts, told by 128 bits of their words."""
    names = ["k1", "k2", "before", "w1", "w2", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for whole in batches:
            for batch in (whole.slice(k, 2048) for k in range(0, whole.num_rows, 2048)):
                out = []
                for right, left, k1, k2, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                    back, ahead = left.split(" ")[::-1] if left else [], right.split(" ")
                    words = back + ahead
                    for first in range(len(words) - length + 1):
                        key = xxhash.xxh3_128_intdigest(" ".join(words[first : first + length]).encode("utf-8", "surrogatepass"))
                        out.append((k1, k2, len(back) - first, signed(key >> 64), signed(key & (1 << 64) - 1), low, high))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names)

    return rows.select("right", "left", "k1", "k2", "low", "high").mapInArrow(run, "k1 long, k2 long, before int, w1 long, w2 long, low long, high long")


def repeats(docs: DataFrame, id_col: str, text_col: str, length: int, limit: int = 512) -> tuple[DataFrame, DataFrame]:
    """(doc, n_words, first_doc) of texts that have an exact copy in another document, first_doc being the smallest id with
    those words; and (doc, first, last, low) of successive windows, from the one that begins at word ``first`` to that at
    ``last``, that stand in different texts, low being the smallest id that holds them, where texts of equal words are
    asked for their smallest id alone."""
    span = length - GRAM - 9
    if span < 1:
        raise ValueError(f"length must be at least {GRAM + 10}")
    prefix = length - span + 1
    marks = materialise(kept_suffixes(docs, id_col, text_col, length, span, prefix), "suffixes")
    # right sides of joins are written tables, so that Spark can split a hot key on the left
    groups = materialise(marks.where(F.col("n_words") >= length).groupBy("words_hash").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc")), "texts")
    whole = marks.join(groups.where("first_doc < last_doc"), "words_hash").select("doc", "n_words", "first_doc").distinct()
    alone = marks.join(groups.select("words_hash", F.col("first_doc").alias("doc")), ["words_hash", "doc"])
    suffixes = alone.select("doc", F.explode(F.arrays_zip("starts", "heads")).alias("s")).select("doc", F.col("s.starts").alias("place"), F.col("s.heads").alias("head"))
    matched = materialise(suffixes.groupBy("head").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("head"), "heads")
    places = suffixes.join(matched, "head").groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("place", "head"))).alias("p"))
    places = places.select("doc", F.col("p.place").alias("places"), F.col("p.head").alias("heads"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).join(places, "doc")
    contexts = materialise(contexts_at(texts, length, span), "contexts")
    distinct = materialise(contexts.groupBy("k1", "k2").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), *[F.first(c).alias(c) for c in ("head", "right", "left")]), "distinct")
    wide = materialise(distinct.groupBy("head").count().where(F.col("count") > limit).select("head"), "wide")
    found = compare_neighbours(distinct.join(wide, "head", "left_anti").repartition("head").sortWithinPartitions("head", "right"), length, span)
    if not wide.isEmpty():
        # a head with more contexts than a task should sort: its windows are compared by partial minima instead
        windows = materialise(windows_of(distinct.join(wide, "head"), length), "windows")
        shared = materialise(windows.groupBy("w1", "w2").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most").select("w1", "w2", "least"), "shared")
        found = found.unionByName(windows.join(shared, ["w1", "w2"]).select("k1", "k2", F.col("before").alias("from"), F.col("before").alias("to"), F.col("least").alias("low")))
    found = materialise(found, "found")
    return whole, contexts.select("doc", "place", "k1", "k2").join(found, ["k1", "k2"]).select("doc", (F.col("place") - F.col("to")).cast("long").alias("first"), (F.col("place") - F.col("from")).cast("long").alias("last"), "low")


def joined(hits: DataFrame, length: int) -> DataFrame:
    """(doc, start_word, n_words, first_doc): windows that overlap or adjoin as one span."""
    order = Window.partitionBy("doc").orderBy("first", "last")
    # a window that begins where no other covers the word before it begins a span
    hits = hits.withColumn("begins", F.when(F.col("first") > F.lag("last").over(order) + length, 1).otherwise(0))
    hits = hits.withColumn("number", F.sum("begins").over(order))
    spans = hits.groupBy("doc", "number").agg(F.min("first").alias("start_word"), (F.max("last") + length - F.min("first")).alias("n_words"), F.min("low").alias("first_doc"))
    return spans.drop("number")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, limit: int = 512) -> DataFrame:
    """doc_id, start_word, n_words, first_doc: maximal stretches of words all of whose windows of ``length`` words stand in
    another document too; first_doc is the smallest id that holds one of them."""
    whole, hits = repeats(docs, id_col, text_col, length, limit)
    spans = materialise(joined(hits, length), "spans")
    # copies of a text with a passage of an earlier document have it from there
    earlier = materialise(spans.groupBy(F.col("doc").alias("first_doc")).agg(F.min("first_doc").alias("earlier")), "earlier")
    copies = whole.join(earlier, "first_doc", "left").select("doc", F.lit(0).cast("long").alias("start_word"), "n_words", F.least("first_doc", "earlier").alias("first_doc"))
    return spans.join(whole.select("doc").distinct(), "doc", "left_anti").unionByName(copies).withColumnRenamed("doc", "doc_id")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """The documents' words outside windows that an earlier document holds: (doc_id, spans to cut), for rewriting texts.

    Told window by window: what a document is the first to hold stays there, even next to what it repeats."""
    whole, hits = repeats(docs, id_col, text_col, length)
    copies = whole.where("first_doc < doc").select("doc", F.lit(0).cast("long").alias("start_word"), "n_words")
    spans = joined(hits.where("low < doc"), length).select("doc", "start_word", "n_words").unionByName(copies)
    return spans.groupBy(F.col("doc").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("start_word", "n_words"))).alias("cut"))
