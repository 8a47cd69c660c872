"""The corpus pipeline: five stages, each over all rows that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
``run`` writes every stage's rows to the shared folder and reads them back, so a lost executor repeats one stage at most.

Defined cases, beside those of the operators: a null or empty text fails the quality rules and ends there; a row with a null
id passes the near-duplicate stage; of rows with one id each goes or stays by its own text; equal rows become one; a null
n_chars stays null; an empty table gives an empty result of the same columns; without labels nothing but the base rule
rejects; without benchmark rows nothing leaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.llm import decontam, ngram_join, packing, pii, quality
from annomerge.llm.common import materialise, table
from annomerge.llm.queries import KEY, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rule and the isolation forest."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents that links of similarity 0.8 or more connect: the smallest id."""
    return ngram_join.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item within a fifth of its words in edits."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with pseudonyms in the text; n_chars follows where it was known."""
    done = pii.pseudonymise(docs, KEY).drop("pii_found")
    return done.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and place."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

#: No stage but PII's could be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name.lower()))
    return STAGES[-1][1](spark, docs, sf_dir)
