"""Quality rules: statistics of whole texts, a base rule, and an isolation forest over the rule statistics.

The forest is fitted on a bounded sample of rows; its threshold is calibrated on all labelled rows, as the one that
parts good from bad best among those that reject at most ``max_false_reject`` of the rows labelled good.

Defined cases: a null or empty text has no words and fails the base rule; repeated rows get equal verdicts; without
labels the forest is fitted on a sample of all rows and rejects nothing; an empty table gives no rows; further
columns are kept, but for those named like a result, which give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from annomerge.llm.common import bounded_sample, map_texts, materialise, numbered, renamed, share_of

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
MARKS = b"!?"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
TAILS = bytes(range(0x80, 0xC0))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")
WINDOW = 5
PRIOR = 30
HALF = 0.1
BASE_RULE = "q_n_words < 10 OR 100 * q_n_repeat_words > 20 * q_n_words"


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of five words that occur at least twice in the text. Windows are compared exactly."""
    import numpy as np

    n = len(words)
    if n <= WINDOW:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    size = len(seen)
    if size == n:
        return 0
    if size < 5400:  # size ** 5 fits 63 bits
        key = ids[: n - 4].copy()
        for k in range(1, WINDOW):
            key *= size
            key += ids[k : n - 4 + k]
    else:
        pairs, two = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
        fours, four = np.unique(two[:-2] * len(pairs) + two[2:], return_inverse=True)
        key = four[: n - 4] * size + ids[4:]
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return 0
    place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    edges = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice[place] == key)
    edges[starts] += 1
    np.subtract.at(edges, starts + WINDOW, 1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    less = lambda chars: len(data) - len(data.translate(None, chars))
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
    chars = len(data) - less(TAILS) - less(SPACES)
    return (len(words), chars, less(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), less(UPPER), less(MARKS), len(lines))


def rule_features(counts):
    """Rates that do not grow with a text's length, one row per text. Each starts from what plain prose of ``PRIOR``
    words has, so a few words are not odd for being few. Rates of symbols and marks, which prose hardly has, are told as
    x / (x + HALF): the few texts full of them would else widen the range that splits are drawn from, and texts with some
    would stay beside those with none. Both together are a rate of their own, so that trees split on them more often."""
    import numpy as np

    c = np.asarray(counts, float).reshape(-1, len(COUNTS))
    words, chars, lines = c[:, 0] + PRIOR, c[:, 1] + 6 * PRIOR, c[:, 7] + 3
    symbols, marks, either = (x / (x + HALF) for x in (c[:, 2] / words, c[:, 6] / words, (c[:, 2] + c[:, 6]) / words))
    return np.stack([chars / words, symbols, c[:, 3] / lines, c[:, 4] / words, c[:, 5] / chars, marks, either], axis=1)


class IsolationForest:
    """Trees of random splits over samples of ``size`` rows. score: 2 ** -(mean path / expected path), high when odd."""

    def __init__(self, rows, trees: int = 100, size: int = 1024, seed: int = 7):
        import numpy as np

        rng = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        width = 1 << (self.depth + 1)
        self.feature = np.zeros((trees, width), np.int16)
        self.split = np.full((trees, width), np.inf)
        self.path = np.zeros((trees, width))
        for t in range(trees):
            self.grow(t, 1, rows[rng.choice(len(rows), self.size, replace=False)], 0, rng)

    @staticmethod
    def expected(n) -> float:
        import math

        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def grow(self, tree: int, node: int, rows, depth: int, rng) -> None:
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (0, 0)
        open_ = (high > low).nonzero()[0] if len(rows) > 1 else []
        if depth == self.depth or not len(open_):
            self.path[tree, node] = depth + self.expected(len(rows))
            return
        f = int(rng.choice(open_))
        at = rng.uniform(low[f], high[f])
        self.feature[tree, node], self.split[tree, node] = f, at
        left = rows[:, f] < at
        self.grow(tree, 2 * node, rows[left], depth + 1, rng)
        self.grow(tree, 2 * node + 1, rows[~left], depth + 1, rng)

    def score(self, rows):
        import numpy as np

        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for t in range(len(self.split)):
            node = np.ones(len(rows), np.int64)
            for _ in range(self.depth):
                split = self.split[t, node]
                step = 2 * node + (rows[each, self.feature[t, node]] >= split)
                node = np.where(np.isinf(split), node, step)
            total += self.path[t, node]
        return np.exp2(-total / len(self.split) / max(self.expected(self.size), 1e-9))


def counted(docs: DataFrame, text_col: str, keep_text: bool = False) -> DataFrame:
    """COUNTS as columns ``q_*``."""

    def make():
        def run(texts: list) -> dict:
            counts = [count_text(x) for x in texts]
            return {f"q_{name}": [c[i] for c in counts] for i, name in enumerate(COUNTS)}

        return run

    return map_texts(docs, text_col, make, ", ".join(f"q_{name} long" for name in COUNTS), keep_text)


def scored(counts: DataFrame, forest: IsolationForest) -> DataFrame:
    """Rows of counts with ``q_score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            rows = np.stack([batch.column(batch.schema.get_field_index(f"q_{name}")).to_numpy() for name in COUNTS], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(rule_features(rows)))], [*batch.schema.names, "q_score"])

    return counts.mapInArrow(run, StructType([*counts.schema, StructField("q_score", DoubleType())]))


def marked(labels: DataFrame, id_col: str) -> DataFrame:
    return labels.where("quality IN (0, 1)").groupBy(F.col(id_col).alias("q_id")).agg(F.min("quality").alias("q_label"))


def fit_forest(counts: DataFrame, labels: DataFrame | None, id_col: str, label_id: str = "doc_id", good: int = 3000, bad: int = 160, trees: int = 100) -> IsolationForest | None:
    """Fit on about ``good`` rows labelled 1 and ``bad`` rows labelled 0 (the share of anomalies that the forest expects), at
    most twice that, or on ``good`` rows of all where there are no labels. None for an empty table."""
    rows = counts.select(F.col(id_col).alias("q_id"), *[f"q_{name}" for name in COUNTS])
    some = []
    if labels is not None:
        marks = marked(labels, label_id)
        picked = bounded_sample(marks.where("q_label = 1"), "q_label", "q_id", good).unionByName(bounded_sample(marks.where("q_label = 0"), "q_label", "q_id", bad))
        some = rows.join(F.broadcast(picked.select("q_id")), "q_id", "left_semi").limit(2 * (good + bad)).collect()
    if not some:
        some = rows.where(share_of(F.col("q_id"), 17) < min(1.0, good / max(1, rows.count()))).limit(2 * good).collect()
    some = sorted([r[f"q_{name}"] for name in COUNTS] for r in some)
    return IsolationForest(rule_features(some), trees) if some else None


def calibrate(counts: DataFrame, labels: DataFrame | None, forest: IsolationForest, id_col: str, label_id: str = "doc_id", max_false_reject: float = 0.002) -> float:
    """The threshold, in steps of 1/2000, that parts labelled rows best (share of the bad above it less that of the good),
    of those above which at most ``max_false_reject`` of the good lie; the lowest of those where no row is labelled bad."""
    if labels is None:
        return 1.0
    rows = counts.select(F.col(id_col).alias("q_id"), *[f"q_{name}" for name in COUNTS]).where(f"NOT ({BASE_RULE})")
    scores = scored(rows.join(marked(labels, label_id), "q_id"), forest)
    steps = {(r[0], r[1]): r[2] for r in scores.groupBy("q_label", F.ceil(F.col("q_score") * 2000).alias("step")).count().collect()}
    good, bad = (sum(n for (label, _), n in steps.items() if label == x) for x in (1, 0))
    found, most, above = 1.0, 0.0, {0: 0, 1: 0}
    for step in range(2000, 0, -1):
        # above the threshold step / 2000 lie the rows of higher steps
        if above[1] > max_false_reject * good:
            break
        gain = above[0] / bad - above[1] / max(1, good) if bad else 0.0
        if good and (gain > most or not bad):
            found, most = step / 2000, gain
        for label in above:
            above[label] += steps.get((label, step), 0)
    return found


def judge(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, max_false_reject: float = 0.002, label_id: str = "doc_id") -> DataFrame:
    """Rows with ``q_*`` counts, ``q_score``, ``q_base_failed`` and ``q_kept``, in place of columns of those names. Counts are
    made and written once, beside the text if that is asked for; the forest and its threshold read the counts alone."""
    rows, own_id, text = numbered(docs, id_col, text_col)
    counts = materialise(counted(rows, text, keep_text), "counts")
    forest = fit_forest(counts, labels, own_id, label_id) or IsolationForest(rule_features([[0] * len(COUNTS)]), 1)
    threshold = calibrate(counts, labels, forest, own_id, label_id, max_false_reject)
    out = scored(counts, forest).withColumn("q_base_failed", F.expr(BASE_RULE)).withColumn("q_kept", ~F.col("q_base_failed") & (F.col("q_score") <= threshold))
    return renamed(out, docs.columns, *[f"q_{name}" for name in (*COUNTS, "score", "base_failed", "kept")])


def keep_good(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> DataFrame:
    """The rows that pass, with their own columns."""
    rows, own_id, text = numbered(docs, id_col, text_col)
    return renamed(judge(rows, labels, own_id, text, label_id=label_id).where("q_kept"), docs.columns)
