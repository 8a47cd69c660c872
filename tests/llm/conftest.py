import random

import pytest
from pyspark.sql import functions as F

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ne", "pu", "ra") for b in ("ba", "do", "fi", "go", "ju") for c in ("", "n", "s", "th")]

#: Names of result columns, and of columns inside operators.
RESULTS = ("leaks", "pii_found", "lic_n_words", "lic_base", "lic_found", "lic_score", "l_pred", "l_score", "l_ambiguous", "t_score", "q_n_words", "q_score", "q_base_failed", "q_kept", "fim_n", "fim_output", "fim_pieces", "sec_spans")
CLASHES = (*RESULTS, "lic_text", "lic_words", "lic_line", "lic_hits", "pii_made", "leaks_0", "key", "all", "dropped", "dropped_id", "member", "row", "kept", "id", "doc", "set_hash", "signature", "brief", "bucket", "size", "n", "t_id", "l_id", "q_id", "q_label", "_value", "_n", "c0", "c1", "page_id", "payload", "digest", "refers_to", "piece", "start", "length", "sequence_id", "offset", "place", "places", "head", "a_id", "a_part", "a_mask", "part", "filter_order", "step")


@pytest.fixture(scope="session")
def prose():
    """A function that makes repeatable prose of n words."""
    def make(n: int, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd(spark, prose):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with the names that operators give
    to results and to what they need inside."""
    base = prose(300, 1)
    rows = [
        (1, base, "en", "a", 5, "x"), (1, base, "en", "a", 5, "x"), (2, base, "en", "a", 5, None), (3, None, "en", "a", None, "x"), (4, "", None, None, 0, "x"),
        (5, prose(30_000, 2), "de", "a", 5, "x"), (None, base, "en", "a", 5, "x"), (None, None, None, None, None, None), (6, "...\n\n !!", "en", "b", 5, "x"), (7, "one two", "en", "b", 5, "x"),
        (8, base + " " + prose(5, 3), "en", "a", 5, "x"), (9, prose(40, 4), "fr", "c", 1, "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    return docs.select("*", *[F.lit("mine").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (9, 1, 1), (5, 1, 0), (7, 0, 0), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
