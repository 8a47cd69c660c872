"""Benchmark decontamination: windows of documents within a small edit distance of a benchmark item, in words.

The CGK random walk turns a window into a string three times as long, so that few edits become few differing places;
bit sampling then hashes a few places of it, and windows that share a hash with an item are compared with it by exact
edit distance, over the best stretch in and near the window. Several walks, each with several samples, reach the target recall. Windows have the size of the item.
A lossless test decides where windows are cut at all: within ``share`` edits of an item of L words, some run of the
item's words survives, whose length pigeonholing gives; places without such a run cannot match.

A benchmark of at most ``block_bytes`` is held by every task, and the documents are read once. A larger one is never held
whole: tasks and driver hold a bit table of fixed size, which tells the runs and samples that some item has. Documents are
read once too; windows that pass the table meet items by a join on their samples, and pairs are aligned where they meet. Words
are 64-bit hashes there. A table too small for its benchmark lets more windows through, and loses none.

Defined cases: null and empty texts and items match nothing; a document shorter than an item is compared as it is;
repeated rows get equal results; of several windows that match one item in a document, the one of least distance
and then the first is told, inside the document; an item with a null id is told with a null id; empty tables give no
matches; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import map_texts, materialise, mix, numbered, renamed, window_hashes, word_hashes, word_table

WORDS = re.compile(r"\w+")
HITS = "array<struct<item_id:bigint,start_word:bigint,n_words:bigint,distance:bigint>>"


def survives(length: int, share: float) -> int:
    """Words that some unedited run must have: L words with d edits leave a run of at least (L - d) / (d + 1)."""
    d = int(share * length)
    return max(1, min(4, -(-(length - d) // (d + 1))))


def starts(p: int, n: int, length: int, d: int, n_words: int) -> Iterable[int]:
    """Where windows of ``length`` words begin around a run of n words at p. Starts are half the allowed edits apart: a window
    between two is a few edits from either, which walks and alignment allow for."""
    low, high, step = max(0, p + n - length - d), max(0, min(p + d, n_words - length)), max(1, d // 2)
    return (*range(-(-low // step) * step, high + 1, step), high)


def widened(ids, start: int, length: int, d: int, pad: int):
    """The window with d places on either side; ``pad`` stands where the text has no word."""
    import numpy as np

    wide = np.full(length + 2 * d, pad, ids.dtype)
    row = ids[max(0, start - d) : start + length + d]
    at = max(0, d - start)
    wide[at : at + len(row)] = row
    return wide


def walk_keys(padded, numbers, steps, picks, mults):
    """Hash of each sample of one walk over each row; the last column stands behind the end. A coin is the top bit of a word's
    number times that of the walk's step."""
    import numpy as np

    rows, length = padded.shape[0], padded.shape[1] - 1
    at, each = np.zeros(rows, np.int64), np.arange(rows)
    out = np.empty((3 * length, rows), np.uint64)
    for t in range(3 * length):
        out[t] = padded[each, at]
        at = np.minimum(at + (numbers[each, at] * steps[t] >> np.uint64(63)).astype(np.int64), length)
    got = np.zeros((rows, len(picks)), np.uint64)
    for k in range(picks.shape[1]):
        got = (got + out[picks[:, k]].T + np.uint64(1)) * mults[k]
        got ^= got >> np.uint64(29)
    return got


class Index:
    """Items by length, their walks' samples, and the runs that a place must share with one to be looked at."""

    def __init__(self, items: list[tuple[int, str]], share: float = 0.2, walks: int = 8, samples: int = 8, places: int = 4, seed: int = 3):
        import numpy as np

        self.share, self.walks, self.samples = share, walks, samples
        cut = [(i, WORDS.findall((t or "").lower())) for i, t in items]
        cut = [(i, w) for i, w in cut if w]
        self.vocabulary = {w: n + 1 for n, w in enumerate(dict.fromkeys(w for _, ws in cut for w in ws))}
        size = len(self.vocabulary) + 2  # 0: any other word; the last: behind the end
        self.pad = size - 1
        longest = max((len(w) for _, w in cut), default=0)
        rng = np.random.default_rng(seed)
        self.numbers = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.steps = rng.integers(1, 1 << 62, (walks, 3 * longest), np.int64).astype(np.uint64) << np.uint64(1) | np.uint64(1)
        self.mults = rng.integers(1, 1 << 62, places, np.int64).astype(np.uint64) | np.uint64(1)
        self.by_length: dict[int, tuple] = {}
        self.runs: dict[int, dict[tuple, set[int]]] = {}
        for length in sorted({len(w) for _, w in cut}):
            own = [(i, [self.vocabulary[x] for x in w]) for i, w in cut if len(w) == length]
            words = np.array([w for _, w in own], np.int64)
            picks = np.sort(rng.integers(0, 3 * length, (walks, samples, places)), axis=-1)
            tables = []
            for r in range(walks):
                keys = self.keys(words, r, picks[r])
                tables.append([{} for _ in range(samples)])
                for row in range(len(own)):
                    for s in range(samples):
                        tables[r][s].setdefault(int(keys[row, s]), []).append(row)
            self.by_length[length] = ([i for i, _ in own], words, picks, tables)
            n = survives(length, share)
            for _, w in own:
                for k in range(length - n + 1):
                    self.runs.setdefault(n, {}).setdefault(tuple(w[k : k + n]), set()).add(length)
        self.slots = {}
        for n, runs in self.runs.items():
            self.slots[n] = np.zeros(1 << 20, bool)
            self.slots[n][self.slot(np.array(list(runs), np.int64).T)] = True

    def keys(self, words, walk: int, picks):
        """Hash of each sample of the walk over each row."""
        import numpy as np

        padded = np.concatenate([words, np.full((len(words), 1), self.pad)], axis=1)
        return walk_keys(padded, self.numbers[padded], self.steps[walk], picks, self.mults)

    @staticmethod
    def slot(columns):
        """Place in a table of 2 ** 20 of the run whose words the columns hold in order."""
        import numpy as np

        key = columns[0].astype(np.uint64)
        for c in columns[1:]:
            key = key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64)
        return ((key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)

    def windows(self, ids) -> list[tuple[int, int]]:
        """(length, start) of windows that share a surviving run with an item of their length."""
        found: set[tuple[int, int]] = set()
        n_words = len(ids)
        for n, runs in self.runs.items():
            m = n_words - n + 1
            if m <= 0:
                continue
            for p in self.slots[n][self.slot([ids[k : k + m] for k in range(n)])].nonzero()[0].tolist():
                for length in runs.get(tuple(ids[p : p + n].tolist()), ()):
                    found.update((length, s) for s in starts(p, n, length, int(self.share * length), n_words))
        return sorted(found)

    def match(self, texts: list, at_once: int = 20_000) -> list[list[dict]]:
        """The hits of each text. At most about ``at_once`` windows are held, however long the texts are."""
        import numpy as np

        out: list[dict] = [{} for _ in texts]
        cut: dict[int, list] = {}
        held, get = 0, self.vocabulary.get
        for i, text in enumerate(texts):
            ids = np.array([get(w, 0) for w in WORDS.findall((text or "").lower())], np.int32)
            for length, start in self.windows(ids):
                cut.setdefault(length, []).append((i, start, widened(ids, start, length, int(self.share * length), self.pad)))
                held += 1
                if held == at_once:
                    self.compare(cut, out)
                    cut, held = {}, 0
        self.compare(cut, out)
        return [sorted(kept.values(), key=lambda h: (h["item_id"] is None, h["item_id"])) for kept in out]

    def compare(self, cut: dict[int, list], out: list[dict]) -> None:
        """Windows that share a sample with an item, by exact alignment; out keeps the best hit of each item in a text."""
        import numpy as np

        for length, held in cut.items():
            names, items, picks, tables = self.by_length[length]
            d = int(self.share * length)
            words = np.stack([w for *_, w in held])
            pairs: set[tuple[int, int]] = set()
            for r in range(self.walks):
                keys = self.keys(words[:, d : d + length], r, picks[r])
                for s in range(self.samples):
                    table = tables[r][s]
                    pairs.update((row, item) for row, key in enumerate(keys[:, s].tolist()) for item in table.get(key, ()))
            todo = np.array(sorted(pairs), np.int64).reshape(-1, 2)
            for first in range(0, len(todo), 10_000):
                part = todo[first : first + 10_000]
                distance, start, end = best_alignments(words[part[:, 0]], items[part[:, 1]], self.pad)
                for (row, item), far, s, e in zip(part.tolist(), distance.tolist(), start.tolist(), end.tolist()):
                    if far <= d:
                        hit = {"item_id": names[item], "start_word": held[row][1] - d + s, "n_words": e - s, "distance": far}
                        old = out[held[row][0]].get(hit["item_id"])
                        if old is None or (hit["distance"], hit["start_word"]) < (old["distance"], old["start_word"]):
                            out[held[row][0]][hit["item_id"]] = hit


class Signer:
    """Runs and samples of items and windows as hashes, alike in every task, and the bit table of those that items have.

    Every hash sets two bits of ``2 ** power``, told apart by a salt: a run's is its number of words, that of a run with the
    length of its item is the length plus 8, that of a sample 5.
    """

    def __init__(self, share: float = 0.2, power: int = 28, walks: int = 8, samples: int = 8, places: int = 4, seed: int = 3):
        self.share, self.power, self.walks, self.samples, self.places, self.seed = share, power, walks, samples, places, seed
        self.made: dict[int, tuple] = {}

    def words(self, text: str | None):
        """Hashes of the words; 0 stands for no word."""
        return word_hashes(text, word_table())

    def keys(self, words):
        """All samples of rows of equal length; equal numbers only for the same sample of the same walk and length."""
        import numpy as np

        length = words.shape[1]
        if length not in self.made:
            rng = np.random.default_rng((self.seed, length))
            odd = lambda *shape: rng.integers(1, 1 << 62, shape, np.int64).astype(np.uint64) << np.uint64(1) | np.uint64(1)
            self.made[length] = odd(self.walks, 3 * length), odd(self.places), np.sort(rng.integers(0, 3 * length, (self.walks, self.samples, self.places)), axis=-1), odd(self.walks * self.samples)
        steps, mults, picks, tell = self.made[length]
        padded = np.concatenate([words, np.zeros((len(words), 1), np.uint64)], axis=1)
        numbers = mix(padded + np.uint64(0x9E3779B97F4A7C15))
        return mix(np.concatenate([walk_keys(padded, numbers, steps[r], picks[r], mults) for r in range(self.walks)], axis=1) ^ tell)

    def bits(self, hashes, salt: int):
        """The two bits of each hash."""
        import numpy as np

        h = mix(hashes ^ mix(np.full(1, salt, np.uint64)))
        low = np.uint64((1 << self.power) - 1)
        return (h & low).astype(np.int64), (h >> np.uint64(32) & low).astype(np.int64)

    def sign(self, texts: list) -> dict[str, list]:
        """Words, samples and bits of items."""
        import numpy as np

        out: dict[str, list] = {"words": [], "keys": [], "bits": []}
        for text in texts:
            words = self.words(text)
            keys = self.keys(words[None])[0] if len(words) else words
            runs = window_hashes(words, survives(len(words), self.share))
            bits = np.unique(np.concatenate([*self.bits(keys, 5), *self.bits(runs, survives(len(words), self.share)), *self.bits(runs, len(words) + 8)]))
            for name, got in (("words", words), ("keys", keys), ("bits", bits)):
                out[name].append(got.view(np.int64))
        return out

    def cutter(self, table, lengths: list[int], at_once: int = 4096) -> Callable[[list], dict[str, list]]:
        """A function that gives the windows of texts which, by the table, share a run and a sample with an item of their length."""
        import numpy as np

        by_run: dict[int, list[int]] = {}
        for length in lengths:
            by_run.setdefault(survives(length, self.share), []).append(length)

        def has(hashes, salt: int):
            first, second = self.bits(hashes, salt)
            return ((table[first >> 6] >> (first & 63)) & (table[second >> 6] >> (second & 63)) & 1).astype(bool)

        def cut(text: str | None) -> list[dict]:
            words, found, out = self.words(text), {}, []
            for n, own in by_run.items():
                runs = window_hashes(words, n)
                at = np.flatnonzero(has(runs, n))
                for length in own if len(at) else ():
                    near: set[int] = set()
                    for p in at[has(runs[at], length + 8)].tolist():
                        near.update(starts(p, n, length, int(self.share * length), len(words)))
                    found[length] = sorted(near)
            for length, begins in found.items():
                d = int(self.share * length)
                for k in range(0, len(begins), at_once):
                    part = begins[k : k + at_once]
                    wide = np.stack([widened(words, s, length, d, 0) for s in part])
                    keys = self.keys(wide[:, d : d + length])
                    good = has(keys, 5)
                    for row in np.flatnonzero(good.any(1)).tolist():
                        out.append({"length": length, "start": part[row], "words": wide[row].view(np.int64), "keys": keys[row][good[row]].view(np.int64)})
            return out

        return lambda texts: {"cut": [cut(text) for text in texts]}


def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distance and place of the item of each row in its window; columns: key, item, length, start, share, words, item_words."""
    import numpy as np

    for batch in batches:
        lengths, share = batch.column("length").to_numpy(), batch.column("share").to_numpy()
        words, items, begins = batch.column("words"), batch.column("item_words"), batch.column("start").to_numpy()
        got = np.zeros((3, len(lengths)), np.int64)
        for length in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == length)
            d = int(share[0] * length)
            most = max(1, (4 << 20) // (length + 2 * d))
            for first in range(0, len(own), most):
                rows = own[first : first + most]
                a, b = (c.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1) for c in (words, items))
                distance, s, e = best_alignments(a, b, 0)
                got[:, rows] = distance, begins[rows] - d + s, e - s
        near = np.flatnonzero(got[0] <= (share * lengths).astype(np.int64))
        kept = batch.select(["key", "item"]).take(pa.array(near))
        yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(x[near]) for x in got]], ["key", "item", "distance", "start_word", "n_words"])


def best_alignments(a, b, pad: int = -1):
    """Least edit distance of each row of b to any stretch of the same row of a, with the stretch's start and end;
    of equal ones the first start, then the first end. To take ``pad``, which stands where a document has no word, for a
    word costs twice as much, so the best stretch never holds it."""
    import numpy as np

    n, length = a.shape
    unit = np.int64(1 << 20)  # a cell is distance * unit + start
    step = np.arange(length + 1) * unit
    row = np.broadcast_to(np.arange(length + 1, dtype=np.int64), (n, length + 1))
    outside = unit * (a == pad)
    for j in range(b.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = (j + 1) * unit
        new[:, 1:] = np.minimum(row[:, 1:] + unit, row[:, :-1] + unit * (a != b[:, j : j + 1]) + outside)
        row = np.minimum.accumulate(new - step, axis=1) + step
    end = row.argmin(1)
    cell = row[np.arange(n), end]
    return cell // unit, cell % unit, end


def text_key(text: Column) -> Column:
    """Two numbers that texts are told apart by where results are joined back to them."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.reverse(text), F.lit(1)).alias("b"), F.octet_length(text).alias("n"))


def routed(texts: DataFrame, text: str, items: DataFrame, share: float, power: int) -> DataFrame:
    """(key, leaks) of the texts that hold an item; texts: ``text`` and its ``key``, items: i and t. Copies of a text, of a window
    or of an item's text count as one until the end."""
    import numpy as np

    spark, signer = texts.sparkSession, Signer(share, power)
    items = items.withColumn("item", text_key(F.col("t")))
    signed = map_texts(items.groupBy("item").agg(F.first("t").alias("t")), "t", lambda: signer.sign, "words array<bigint>, keys array<bigint>, bits array<bigint>")
    signed = materialise(signed.where(F.size("words") > 0), "leaks")
    held = signed.select(F.explode("bits").alias("b")).groupBy(F.expr("b div 64").alias("slot")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("b")).toArrow()
    filled = np.zeros((1 << power) // 64, np.int64)  # at most as many rows came
    filled[held.column("slot").to_numpy()] = held.column("b").to_numpy()
    table = spark.sparkContext.broadcast(filled)
    lengths = sorted(r[0] for r in signed.select(F.size("words")).distinct().collect())
    cut = map_texts(texts, text, lambda: signer.cutter(table.value, lengths), "cut array<struct<length:int,start:bigint,words:array<bigint>,keys:array<bigint>>>")
    place = ["key", "length", "start"]
    cut = cut.select("key", F.inline("cut")).groupBy(place).agg(F.first(F.struct("words", "keys")).alias("w"))
    windows = materialise(cut.select(*place, "w.*"), "leaks")
    pairs = windows.select(*place, F.explode("keys").alias("k")).join(signed.select("item", F.explode("keys").alias("k")), "k").select(*place, "item").distinct()
    pairs = pairs.join(windows.drop("keys"), place).join(signed.select("item", F.col("words").alias("item_words")), "item")
    key = "struct<a:bigint,b:bigint,n:int>"
    hits = pairs.select("key", "item", "length", "start", F.lit(share).alias("share"), "words", "item_words").mapInArrow(align, f"key {key}, item {key}, distance bigint, start_word bigint, n_words bigint")
    best = lambda rows, *by: rows.groupBy(*by).agg(F.min(F.struct("distance", "start_word", "n_words")).alias("h")).select(*by, "h.*")
    told = best(best(hits, "key", "item").join(items.select("item", F.col("i").alias("item_id")).distinct(), "item"), "key", "item_id")
    ordered = F.sort_array(F.collect_list(F.struct(F.isnull("item_id"), F.struct("item_id", "start_word", "n_words", "distance").alias("hit"))))  # a null id comes last
    return materialise(told.groupBy("key").agg(ordered["hit"].cast(HITS).alias("leaks")), "leaks")


def mark_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", share: float = 0.2, block_bytes: int = 8 << 20, keep_text: bool = True, power: int = 28) -> DataFrame:
    """Rows with ``leaks``, in place of a column of that name: all items that the text holds, with start word, words and
    distance. ``block_bytes``: how much benchmark a task may hold; of a larger one it holds a table of ``2 ** power`` bits."""
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("t IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    rows, text = numbered(docs, text_col)
    if size > block_bytes:
        key = text_key(F.col(text))
        out = rows.withColumn("key", key).join(routed(rows.select(text, key.alias("key")), text, items, share, power), "key", "left")
        out = out.withColumn("leaks", F.coalesce("leaks", F.array().cast(HITS)))
        return renamed(out if keep_text else out.drop(text), docs.columns, "leaks")
    own = [tuple(r) for r in items.orderBy("i", "t").collect()]

    def make():
        index = Index(own, share)
        return lambda texts: {"leaks": index.match(texts)}

    return renamed(map_texts(rows, text, make, f"leaks {HITS}", keep_text), docs.columns, "leaks")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: float = 0.2, item_col: str = "item_id", item_text: str = "text", block_bytes: int = 8 << 20, power: int = 28) -> DataFrame:
    """The rows without any item of the benchmark, with their own columns."""
    rows, text = numbered(docs, text_col)
    return renamed(mark_leaks(rows, benchmark, text, item_col, item_text, share, block_bytes, power=power).where(F.size("leaks") == 0), docs.columns)
