"""Toxicity scores: embeddings of words' character n-grams, averaged over the text, into a linear softmax.

Embeddings and softmax are trained together in numpy, so a misspelling never seen shares most of its n-grams with the words
that were. Every n-gram has a random embedding of its own, which training moves; how far is held back by a decay that inner
validation chooses, so that n-grams which only single texts explain keep theirs. In the average an n-gram counts by the logarithm
of its occurrences, and the average is taken in units of its standard error, so that a few words count in a long text. Since
average and logits are linear, a trained model is one number per n-gram.

Defined cases: a null or empty text, or one without letters, scores the share of toxic rows in training; rows
without a label are scored and not learned from; without any labelled rows every score is 0; a null id in labels is not
learned from; input columns named like the result give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import bounded_sample, fold, letter_codes, letter_table, map_texts, numbered, renamed

BITS = 19
LENGTHS = (3, 4, 5, 6)
#: The spread of the random embeddings that training begins with.
SCALE = 0.3


def grams(codes):
    """Buckets of all n-grams inside words, each word with a space at either end."""
    import numpy as np

    a = codes.astype(np.uint64)
    inside = codes != 32
    key, out, whole = a, [], None
    for n in range(2, LENGTHS[-1] + 1):
        if len(a) < n:
            break
        key = key[:-1] * np.uint64(1_000_003) + a[n - 1 :]
        if n >= LENGTHS[0]:
            middle = inside[n - 2 : len(a) - 1]  # the last but one
            whole = middle if whole is None else whole[:-1] & middle
            mixed = (key[whole] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def averaging(counts):
    """What each n-gram weighs in its text's average, times the root of the sum: an average in units of its standard error."""
    import numpy as np

    weight = np.log1p(counts)
    return weight / np.sqrt(weight.sum())


class Model:
    """weights: the difference of the two logits that each n-gram adds; bias: what is added once. embed, axis: the embeddings that
    training moved, in units of the n-grams' spread, and the softmax's difference, before and after, to look at; they are not needed
    to score and do not leave the driver."""

    def __init__(self, weights, bias: float, prior: float, embed=None, axis=None):
        self.weights, self.bias, self.prior, self.embed, self.axis = weights, bias, prior, embed, axis

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "prior": self.prior, "embed": None, "axis": None}

    def scorer(self):
        """The score of letter codes."""
        import math

        import numpy as np

        table = self.weights

        def score(codes) -> float:
            found = grams(codes) if codes is not None else ()
            if not len(found):
                return self.prior
            ids, counts = np.unique(found, return_counts=True)
            z = float(averaging(counts) @ table[ids]) + self.bias
            return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

        return score


class Bags:
    """Texts as bags of n-grams, as a sparse matrix of centred columns, each divided by its spread over the texts: ids and weights
    of every text's n-grams, and its label."""

    def __init__(self, ids: list, values: list, labels: list[int]):
        """The lists are emptied, so that nothing is held twice."""
        import numpy as np

        size, n = 1 << BITS, len(labels)
        self.label = np.array(labels, np.float64)
        self.owner = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in ids])
        self.column = np.concatenate(ids)
        ids.clear()
        self.value = np.concatenate(values)
        values.clear()
        self.texts, mean, squares = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
        for part in self.parts():
            column, value = self.column[part], self.value[part]
            self.texts += np.bincount(column, minlength=size)
            mean += np.bincount(column, weights=value, minlength=size) / n
            squares += np.bincount(column, weights=value * value, minlength=size) / n
        self.spread = np.sqrt(np.maximum(squares - mean**2, 1e-14))
        self.mean = mean / self.spread
        self.value /= self.spread.astype(np.float32)[self.column]

    def cut(self, columns):
        """The same with the given columns alone, numbered anew."""
        import numpy as np

        out, rank = object.__new__(Bags), np.full(len(self.texts), -1, np.int32)
        rank[columns] = np.arange(len(columns))
        found = rank[self.column]
        kept = found >= 0
        out.label, out.column, out.owner, out.value = self.label, found[kept], self.owner[kept], self.value[kept]
        out.texts, out.mean, out.spread = self.texts[columns], self.mean[columns], self.spread[columns]
        return out

    def parts(self) -> Iterator[slice]:
        """Of the entries, so that no long array of products is held."""
        return (slice(k, k + (1 << 21)) for k in range(0, len(self.value), 1 << 21))

    def summed(self, at, of, weights, size: int):
        """Sums of value * weights[of] by ``at``."""
        import numpy as np

        out = np.zeros(size)
        for part in self.parts():
            out += np.bincount(at[part], weights=self.value[part] * weights[of[part]], minlength=size)
        return out

    def times(self, weights):
        return self.summed(self.owner, self.column, weights, len(self.label)) - self.mean @ weights

    def gradient(self, slope):
        return self.summed(self.column, self.owner, slope, len(self.texts)) - self.mean * slope.sum()


def slopes(logits, bags: Bags, used):
    """The loss's slope in each text's logit, for the texts in use."""
    import numpy as np

    return np.where(used, 1 / (1 + np.exp(-np.clip(logits, -40, 40))) - bags.label, 0.0) / used.sum()


def descend(bags: Bags, used, moved, own, axis, bias: float, decay: float, steps: int, rng):
    """Steps of proximal descent with momentum on what embeddings have ``moved`` from their own vectors, with the softmax at the
    same time. A step shrinks each move by the decay, to none if it is shorter. The softmax keeps its length, which embeddings
    make up for, and turns."""
    import numpy as np

    u = rng.normal(0, 1, len(moved))
    for _ in range(6):  # the steepest curvature, by power iteration
        v = bags.gradient(np.where(used, bags.times(u), 0.0)) * 0.25 / used.sum()
        curve, u = np.linalg.norm(v) / np.linalg.norm(u), v / max(np.linalg.norm(v), 1e-12)
    rate, ahead, speed = 1 / max(curve, 1e-9), moved, 1.0
    for _ in range(steps):
        slope = slopes(bags.times((own + ahead) @ axis) + bias, bags, used)
        up = bags.gradient(slope)
        after = ahead - rate * up[:, None] * axis
        size = np.linalg.norm(after, axis=1, keepdims=True)
        new = after * np.maximum(0, 1 - rate * decay / np.maximum(size, 1e-12))
        axis = axis - (own + ahead).T @ up
        axis /= np.linalg.norm(axis)
        bias -= 4 * slope.sum()
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        ahead, moved, speed = new + (speed - 1) / faster * (new - moved), new, faster
    return moved, axis, bias


def fit_path(bags: Bags, used, shares: tuple, dim: int, steps: int, seed: int) -> Iterator[tuple]:
    """(moves, own vectors, softmax before and after, bias) for each share of the least decay at which no embedding moves. At
    each decay descent goes over the n-grams whose gradient the last solution leaves large enough to move them; after it all
    are looked at again, and those left out that should move are taken in."""
    import numpy as np

    rng, size = np.random.default_rng(seed), len(bags.texts)
    own = (rng.normal(0, SCALE, (size, dim)) * bags.spread[:, None]).astype(np.float32)
    axis = rng.normal(0, 1, dim)
    axis /= np.linalg.norm(axis)
    first, base = axis, bags.label[used].mean()
    moved, bias = np.zeros((size, dim), np.float32), float(np.log(base / (1 - base)))
    up = bags.gradient(slopes(np.full(len(bags.label), bias), bags, used))
    most = last = float(np.abs(up[bags.texts > 1]).max(initial=1e-12))
    for share in shares:
        decay = share * most
        active = ((np.abs(up) >= 2 * decay - last) | moved.any(axis=1)) & (bags.texts > 0)
        for _ in range(3):
            columns = np.flatnonzero(active)
            moved[columns], axis, bias = descend(bags.cut(columns), used, moved[columns], own[columns], axis, bias, decay, steps, rng)
            up = bags.gradient(slopes(bags.times((own + moved) @ axis) + bias, bags, used))
            late = (np.abs(up) > 1.02 * decay) & ~active & (bags.texts > 0)
            if not late.any():
                break
            active |= late
        last = decay
        yield moved, own, first, axis, bias


def train(texts: list[str], toxic: list[int], prior: float, dim: int = 8, steps: int = 20, shares: tuple = tuple(0.7**k for k in range(1, 13)), seed: int = 5) -> Model | None:
    """The decay is the one with the least loss on a fifth of the texts that the first fit leaves out; the last fit has all. The
    bias is then moved from the sample's share of toxic texts to ``prior``."""
    import numpy as np

    letters, rng = letter_table(), np.random.default_rng(seed)
    columns, values, labels = [], [], []
    for text, label in zip(texts, toxic):
        codes = letter_codes(text or "", letters)
        found = grams(codes) if codes is not None else ()
        if len(found):
            ids, counts = np.unique(found.astype(np.int32), return_counts=True)
            columns.append(ids)
            values.append(averaging(counts).astype(np.float32))
            labels.append(int(label))
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), -40.0, prior) if labels else None
    bags = Bags(columns, values, labels)
    n, y, left_out = len(bags.label), bags.label, np.zeros(len(bags.label), bool)
    for label in (0, 1):
        rows = rng.permutation(np.flatnonzero(y == label))
        left_out[rows[: len(rows) // 5]] = True
    best = len(shares) // 2
    if 0 < y[left_out].sum() < left_out.sum():
        losses: list[float] = []
        for moved, own, _, axis, bias in fit_path(bags, ~left_out, shares, dim, steps, seed):
            losses.append(np.logaddexp(0, np.where(y == 1, -1, 1) * (bags.times((own + moved) @ axis) + bias))[left_out].mean())
            best = int(np.argmin(losses))
            if len(losses) > best + 3:
                break
    for moved, own, first, axis, bias in fit_path(bags, np.ones(n, bool), shares[: best + 1], dim, steps, seed):
        pass
    odds = lambda p: np.log(p / (1 - p))
    shift = odds(min(max(prior, 1e-4), 1 - 1e-4)) - odds(y.mean())
    weights = np.where(bags.texts > 0, (own + moved) @ axis, 0.0)  # what training never met says nothing
    return Model((weights / bags.spread).astype(np.float32), float(bias - bags.mean @ weights + shift), prior, own + moved, (first, axis))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = 2500, longest: int = 32 << 10) -> Model | None:
    """Learn from about ``per_label`` whole texts of each label, at most twice that, none of the held-out fold and none of more
    than ``longest`` bytes. The prior counts all labelled rows."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 2)).groupBy(F.col(id_col).alias("t_id")).agg(F.max(F.col(label_col).cast("int")).alias("t_label"))
    counts = {r[0]: r[1] for r in marks.groupBy("t_label").count().collect()}
    if not counts:
        return None
    picked = bounded_sample(marks, "t_label", "t_id", per_label)
    rows = docs.select(F.col(id_col).alias("t_id"), F.col(text_col).cast("string").alias("t_text")).where(F.octet_length("t_text") <= longest)
    some = rows.join(F.broadcast(picked), "t_id").limit(4 * per_label).collect()
    some.sort(key=lambda r: (r["t_id"], r["t_text"]))
    return train([r["t_text"] for r in some], [r["t_label"] for r in some], counts.get(1, 0) / sum(counts.values()))


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Adds ``t_score``, in place of a column of that name; only the text is looked at."""

    def make():
        letters, score = letter_table(), model.scorer() if model else lambda codes: 0.0
        return lambda texts: {"t_score": [score(letter_codes(t or "", letters)) for t in texts]}

    rows, text = numbered(docs, text_col)
    return renamed(map_texts(rows, text, make, "t_score double", keep_text), docs.columns, "t_score")
