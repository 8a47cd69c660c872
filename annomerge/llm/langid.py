"""Language identification with error-correcting output codes.

Each language has a codeword; a linear classifier over hashed character n-grams predicts each bit. Decoding is
loss-weighted: a class costs the exponential loss of its bits' margins, each bit weighted by how well it does on
that class in training, and the cheapest class wins. A small lead over the second flags ambiguity.

Defined cases: a null text, or one without letters, is ``und`` with score 0; rows with a null language are not
learned from; an empty table, or one without labelled rows, gives ``und``; repeated rows count as often as they stand; a null id is not held out;
input columns named like a result give way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import bounded_sample, fold, letter_codes, letter_table, map_texts, materialise, numbered, renamed

BUCKETS = 1 << 13


def gram_counts(codes):
    """Counts of hashed 1-, 2- and 3-grams of letters, words bounded by spaces; square roots of their shares."""
    import numpy as np

    a = codes.astype(np.uint64)
    hashed = []
    key = a
    for n in (1, 2, 3):
        if n > 1:
            key = key[:-1] * np.uint64(1_000_003) + a[n - 1 :]
        mixed = (key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        hashed.append((mixed >> np.uint64(51)).astype(np.int64))
    counts = np.bincount(np.concatenate(hashed), minlength=BUCKETS).astype(np.float32)
    return np.sqrt(counts / counts.sum())


def codewords(k: int, seed: int = 11):
    """k codewords of +1 and -1: all non-trivial splits up to six classes, else the best of random draws."""
    import numpy as np

    if k <= 6:
        columns = [[1 if c == 0 or not (b >> (c - 1)) & 1 else -1 for c in range(k)] for b in range(1, 1 << (k - 1))]
        return np.array(columns, np.float32).T.reshape(k, -1)
    rng, bits = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(k)))
    draws = [rng.choice([-1.0, 1.0], (k, bits)) for _ in range(100)]
    return max(draws, key=lambda m: bits - np.max(m @ m.T - 2 * bits * np.eye(k))).astype(np.float32)


class Model:
    def __init__(self, langs: list[str], codes, weights, bias, trust):
        self.langs, self.codes, self.weights, self.bias, self.trust = langs, codes, weights, bias, trust

    def decode(self, x):
        """(class, probability-like score, lead) for feature rows."""
        import numpy as np

        margins = np.clip(x @ self.weights + self.bias, -6, 6)
        cost = np.einsum("cb,ncb->nc", self.trust, np.exp(-margins[:, None, :] * self.codes[None]))
        share = np.exp(-(cost - cost.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, 1)
        return share.argmax(1), order[:, -1], order[:, -1] - (order[:, -2] if share.shape[1] > 1 else 0)


def train(texts: list[str], langs: list[str], steps: int = 150) -> Model | None:
    import numpy as np

    letters = letter_table()
    pairs = [(c, lang) for t, lang in zip(texts, langs) if t and (c := letter_codes(t, letters)) is not None]
    if not pairs:
        return None
    names = sorted({lang for _, lang in pairs})
    x = np.stack([gram_counts(c) for c, _ in pairs])
    y = np.array([names.index(lang) for _, lang in pairs])
    codes = codewords(len(names))
    target = codes[y]
    share = 1 / np.maximum(1, np.bincount(y, minlength=len(names)))[y][:, None] / len(names)
    w, b = np.zeros((x.shape[1], codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        slope = -target / (1 + np.exp(np.clip(target * (x @ w + b), -30, 30))) * share
        vw, vb = 0.9 * vw - 4 * (x.T @ slope + 1e-5 * w), 0.9 * vb - 4 * slope.sum(0)
        w, b = (w + vw).astype(np.float32), (b + vb).astype(np.float32)
    right = (target * (x @ w + b)) > 0
    trust = np.stack([right[y == c].mean(0) + 1e-3 for c in range(len(names))]) if codes.shape[1] else np.zeros((len(names), 0))
    trust = trust / np.maximum(trust.sum(1, keepdims=True), 1e-9)
    return Model(names, codes, w, b, trust.astype(np.float32))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 400, most: int = 6000, longest: int = 32 << 10) -> Model | None:
    """Learn from about ``per_lang`` whole texts of each language, none of the held-out fold and none of more than ``longest``
    bytes; with many languages from about ``most`` over all, yet 20 of each. A language that has only longer ones gives its
    shortest, so every language that has a row is learned."""
    rows = docs.select(F.col(id_col).alias("l_id"), F.col(text_col).cast("string").alias("l_text"), F.col(lang_col).cast("string").alias("l_lang"))
    rows = rows.where((F.coalesce(fold(F.col("l_id")), F.lit(0)) != 2) & F.col("l_text").isNotNull()).withColumn("l_size", F.octet_length("l_text"))
    only_long = materialise(rows.groupBy("l_lang").agg(F.min("l_size").alias("l_least")).where(F.col("l_least") > longest), "long-languages")
    some = bounded_sample(rows.where(F.col("l_size") <= longest), "l_lang", "l_id", per_lang, most).collect()
    if not only_long.isEmpty():
        some += rows.where(F.col("l_size") > longest).join(only_long, "l_lang", "left_semi").groupBy("l_lang").agg(F.min_by("l_text", F.struct("l_size", "l_id", "l_text")).alias("l_text")).collect()
    some.sort(key=lambda r: (r["l_lang"], r["l_text"]))
    return train([r["l_text"] for r in some], [r["l_lang"] for r in some])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", ambiguous_below: float = 0.2, keep_text: bool = False) -> DataFrame:
    """Adds ``l_pred``, ``l_score`` and ``l_ambiguous``, in place of columns of those names; only the text is looked at."""

    def make():
        import numpy as np

        letters = letter_table()

        def run(texts: list) -> dict:
            found = [("und", 0.0, True)] * len(texts)
            held: list = []

            def flush() -> None:
                if held:
                    best, score, lead = model.decode(np.stack([x for _, x in held]))
                    for (i, _), c, s, gap in zip(held, best.tolist(), score.tolist(), lead.tolist()):
                        found[i] = (model.langs[c], s, gap < ambiguous_below)
                    held.clear()

            for i, text in enumerate(texts if model else []):
                if text and (codes := letter_codes(text, letters)) is not None:
                    held.append((i, gram_counts(codes)))
                if len(held) == 64:
                    flush()
            flush()
            return {name: [f[k] for f in found] for k, name in enumerate(("l_pred", "l_score", "l_ambiguous"))}

        return run

    rows, text = numbered(docs, text_col)
    return renamed(map_texts(rows, text, make, "l_pred string, l_score double, l_ambiguous boolean", keep_text), docs.columns, "l_pred", "l_score", "l_ambiguous")
