"""The registered queries of the corpus operators, with production parameters, and the SQL that some can be told by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomerge.llm.common import fold, fresh_path, table


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


#: The key that the registered queries use; a deployment passes its own.
KEY = "example key, not for production"


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import pii

    done = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    return done.select("doc_id", "text", F.size("pii_found").cast("long").alias("n_found"), F.array_join(F.array_sort(F.array_distinct(F.transform("pii_found", lambda x: x["kind"]))), ",").alias("kinds"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import suffix_dedup

    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import decontam

    marked = decontam.mark_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep_text=False)
    return marked.where(F.size("leaks") > 0).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import ngram_join

    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op5_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import langid

    docs = table(spark, sf_dir, "documents")
    scored = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return scored.select("doc_id", (F.coalesce(fold(F.col("doc_id")), F.lit(0)) == 2).alias("held_out"), F.col("l_pred").alias("lang_pred"), F.col("l_score").alias("score"), F.col("l_ambiguous").alias("ambiguous"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import quality

    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), keep_text=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return judged.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names])


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import licenses

    return licenses.digest(licenses.detect(table(spark, sf_dir, "documents").select("doc_id", "text")))


def quality_rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7 that SQL can tell."""
    return op7_quality_rules(spark, sf_dir).drop("kept", "score")


def license_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that SQL can tell."""
    return op8_license_scan(spark, sf_dir).drop("labels", "score")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm.warc import read_warc, write_warc

    uri = fresh_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), uri).agg(F.sum("n_records")).collect()
    return read_warc(spark, uri, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (F.coalesce(fold(F.col("doc_id")), F.lit(0)) == 2).alias("held_out"), F.col("t_score").alias("score"), F.when(F.col("t_score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import fill_in_middle

    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), with_output=False)
    names = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return made.select("doc_id", *[F.col(f"fim_{n}").alias(n) for n in names])


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import credentials

    return credentials.digest(credentials.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annomerge.llm import filter_audit

    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUALITY_BASE_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT *, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM t
), words AS (
  SELECT row, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM t
), windows AS (
  SELECT row, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS five FROM words WINDOW o AS (PARTITION BY row ORDER BY i)
), twice AS (
  SELECT row, i FROM windows WHERE five IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row, five) > 1
), covered AS (
  SELECT row, count(DISTINCT i + j) AS n FROM twice, range(5) r(j) GROUP BY row
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM lines LEFT JOIN covered USING (row)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
"""

LICENSE_BASE_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7f])+') AS w FROM documents
), words AS (
  SELECT row, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS start FROM t
), near AS (
  SELECT row, start, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS three, lead(x, 3) OVER o AS fourth FROM words WINDOW o AS (PARTITION BY row ORDER BY start)
), found AS (
  SELECT row, start, CASE WHEN three = 'under the mit' AND fourth = 'license' THEN 'mit' WHEN three = 'apache license version' AND fourth = '2' THEN 'apache-2' WHEN three = 'cc by nc' THEN 'cc-by-nc' END AS label FROM near
), told AS (
  SELECT row, count(*) AS n, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM found WHERE label IS NOT NULL GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word, coalesce(labels, '') AS base_labels FROM t LEFT JOIN told USING (row)
"""

OP9_SQL = """
WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens, sha256('42:' || doc_id) AS h FROM documents
), n AS (
  SELECT *, len(tokens) AS n, [('0x' || h[k * 8 + 1 : k * 8 + 8])::BIGINT for k in range(4)] AS hs FROM t
), c AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 50 THEN 'plain' WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n
), p AS (
  SELECT doc_id, n, form, text, array_to_string(tokens[1 : a], '') AS prefix, array_to_string(tokens[a + 1 : b], '') AS middle, array_to_string(tokens[b + 1 :], '') AS suffix FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT doc_id, part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM words
), cells AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, bits[k] AS bit, CAST(coalesce(list_sum(bits[1 : k - 1]), 0) AS INTEGER) AS before FROM orders, range(1, 6) r(k)
), told AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""


def queries() -> dict:
    return {"op1_pii_pseudonyms": op1_pii_pseudonyms, "op2_suffix_dedup": op2_suffix_dedup, "op3_decontamination": op3_decontamination, "op4_ngram_join": op4_ngram_join, "op5_language_codes": op5_language_codes, "op7_quality_rules": op7_quality_rules, "op8_license_scan": op8_license_scan, "op10_toxicity": op10_toxicity, "op6_best_fit_packing": op6_best_fit_packing, "op9_warc": op9_warc, "op11_fill_in_middle": op11_fill_in_middle, "op12_secret_scan": op12_secret_scan, "op13_filter_audit": op13_filter_audit, "quality_rules_base": quality_rules_base, "license_scan_base": license_scan_base}


def oracle_sql() -> dict[str, str]:
    return {"op9_warc": OP9_SQL, "op11_fill_in_middle": OP11_SQL, "op13_filter_audit": OP13_SQL, "quality_rules_base": QUALITY_BASE_SQL, "license_scan_base": LICENSE_BASE_SQL}
