"""License detection with ordered signature rules, in column expressions only.

Rules are the hand-written regular expressions of ``license_rules``, over lower-cased words. A cheap test for keywords'
words on the whole text comes first; only a text that passes is cut into its words, and rules run only where their own
keyword stands as whole words. Detections that lie inside a larger one, or equal one of a rule of higher priority, are
suppressed.

Defined cases: a null text is empty; a text without a detection has null first and last words, empty labels and score
0; repeated rows get equal results; an empty table gives no rows; other columns are kept, but for those named like a
result, which give way to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import numbered, renamed
from annomerge.llm.license_rules import rules

#: Fixed by the contract: phrases whose places are counted, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Runs of letters and digits; every character beyond ASCII counts as one.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MARK = "\x01"


def groups() -> list[tuple[str, list[tuple[int, str, str]]]]:
    """(keyword, its rules as (priority, label, pattern)), rules in order. A label that another of its keyword refines, as gpl-3 does
    gpl, is searched for by itself, so that a general phrase does not eat the beginning of a specific one."""
    out: dict[tuple[str, bool], list] = {}
    known = rules()
    for priority, label, keyword, pattern in known:
        general = any(k == keyword and other.startswith(f"{label}-") for _, other, k, _ in known)
        out.setdefault((keyword, general), []).append((priority, label, pattern))
    return [(keyword, own) for (keyword, _), own in out.items()]


def gate() -> str:
    """One pattern over raw text that holds where a keyword or a base phrase may stand: the longest word of each, by first letter."""
    words = sorted({max(k.split(), key=len) for k, _ in groups()} | {"mit", "apache", "cc"})
    letters = dict.fromkeys(w[0] for w in words)
    return "(?i)(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(w[1:] for w in words if w[0] == c)})" for c in letters) + ")(?![a-z0-9])"


def lowered(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def places(words: Column, phrase: str) -> Column:
    """Word numbers at which the phrase's words stand one after another."""
    parts = phrase.split()
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0))), lambda i: F.get(words, i) == parts[0])
    return F.filter(starts, lambda i: F.array(*[F.get(words, i + k) for k in range(len(parts))]) == F.array(*[F.lit(p) for p in parts]))


def labelled_places(words: Column, phrase: str, label: str) -> Column:
    found = F.when(F.contains("lic_line", F.lit(f" {phrase} ")), places(words, phrase)).otherwise(F.array().cast("array<int>"))
    return F.transform(found, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("start")))


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of docs, without the text, and, in place of columns of those names: lic_n_words; lic_base (label, start); lic_found
    (priority, label, first, last word) after suppression; lic_score: the share of found places that a grant's frame or a
    base phrase backs."""
    rows, text_name = numbered(docs, text_col)
    text = F.coalesce(F.col(text_name).cast("string"), F.lit(""))
    others = [c for c in rows.columns if c != text_name]
    rows = rows.select(*others, F.regexp_count(text, F.lit(WORD)).cast("long").alias("lic_n_words"), F.when(text.rlike(gate()), lowered(text)).alias("lic_text"))
    rows = rows.withColumn("lic_words", F.when(F.col("lic_text").isNotNull(), F.regexp_extract_all("lic_text", F.lit(WORD), F.lit(0))))
    words = F.col("lic_words")
    rows = rows.withColumn("lic_line", F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    base = F.flatten(F.array(*[labelled_places(words, p, label) for p, label in BASE]))
    rows = rows.withColumn("lic_base", F.when(words.isNotNull(), base)).withColumn("lic_hits", F.when(words.isNotNull(), all_places()))
    outer, found = suppressed("lic_hits")
    rows = rows.withColumn("lic_outer", outer).withColumn("lic_found", found)
    framed = F.filter("lic_found", lambda h: h["last"] - h["first"] >= 3)
    score = (F.size(framed) + F.size("lic_base")) / (F.size("lic_found") + F.size("lic_base"))
    scored = F.when(words.isNotNull() & (F.size("lic_found") + F.size("lic_base") > 0), score).otherwise(F.lit(0.0))
    return renamed(rows.select(*others, "lic_n_words", "lic_base", "lic_found", scored.alias("lic_score")), docs.columns, "lic_n_words", "lic_base", "lic_found", "lic_score")


def groups_found() -> str:
    """SQL of the array of (group, what its rules match, the line with a mark before each match) where a keyword stands; of
    rules that match at one place the first. Patterns are literals, which are compiled once a task."""
    made = []
    for number, (keyword, own) in enumerate(groups()):
        pattern = "( (?:" + "|".join(p for *_, p in own) + "))(?= )"
        made.append(f"CASE WHEN contains(lic_line, ' {keyword} ') THEN named_struct('group', {number}, 'hits', regexp_extract_all(lic_line, '{pattern}', 0), 'marked', regexp_replace(lic_line, '{pattern}', '{MARK}$1')) END")
    return f"array({', '.join(made)})"


def rule_of(group: str, hit: str) -> str:
    """SQL of (priority, label) of the first rule of the group that is the whole match."""
    made = []
    for number, (_, own) in enumerate(groups()):
        rules_ = " ".join(f"WHEN {hit} RLIKE '^ (?:{pattern})$' THEN named_struct('priority', {priority}, 'label', '{label}')" for priority, label, pattern in own)
        made.append(f"WHEN {group} = {number} THEN CASE {rules_} END")
    return f"CASE {' '.join(made)} END"


def all_places() -> Column:
    """Matches as (first word, its negated last, priority, label). Every word has a space before it, so the pieces between
    spaces number the words."""
    starts = f"filter(sequence(0, size(x.pieces) - 1), i -> endswith(x.pieces[i], '{MARK}'))"
    pieces = "transform(filter(" + groups_found() + ", x -> size(x.hits) > 0), x -> named_struct('group', x.group, 'hits', x.hits, 'pieces', split(x.marked, ' ', -1)))"
    one = f"named_struct('first', CAST(at AS BIGINT), 'end', -CAST(at + length(hit) - length(replace(hit, ' ', '')) - 1 AS BIGINT), 'rule', {rule_of('x.group', 'hit')})"
    return F.expr(f"flatten(transform({pieces}, x -> zip_with({starts}, x.hits, (at, hit) -> {one})))")


def suppressed(hits: str) -> tuple[Column, Column]:
    """Hits that no other holds, and that no neighbour refines which they share words with. By first word, longest first, then
    by priority, one that ends no later than any before it lies inside an earlier one; those left begin and end in one order."""
    none = F.array().cast("array<struct<priority:int,label:string,first:bigint,last:bigint>>")

    def step(seen: Column, h: Column) -> Column:
        own = F.struct(h["rule"]["priority"].alias("priority"), h["rule"]["label"].alias("label"), h["first"].alias("first"), (-h["end"]).alias("last"))
        return F.when(-h["end"] <= seen["top"], seen).otherwise(F.struct((-h["end"]).alias("top"), F.concat(seen["kept"], F.array(own)).alias("kept")))

    def refined(h: Column, other: Column) -> Column:
        shares = (other["first"] <= h["last"]) & (other["last"] >= h["first"])
        return F.coalesce(shares & F.startswith(other["label"], F.concat(h["label"], F.lit("-"))), F.lit(False))

    def stays(h: Column, i: Column) -> Column:
        return ~reduce(lambda a, b: a | b, [refined(h, F.get("lic_outer", i + k)) for k in (-2, -1, 1, 2)])

    return F.aggregate(F.array_sort(hits), F.struct(F.lit(-1).cast("long").alias("top"), none.alias("kept")), step)["kept"], F.filter("lic_outer", stays)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score from ``detect``."""
    starts = F.transform("lic_base", lambda b: b["start"])
    base = F.transform("lic_base", lambda b: b["label"])
    names = F.concat(base, F.transform("lic_found", lambda h: h["label"]))
    joined = lambda a: F.coalesce(F.array_join(F.array_sort(F.array_distinct(a)), ","), F.lit(""))
    return found.select(F.col(id_col), F.col("lic_n_words").alias("n_words"), F.when(F.col("lic_base").isNull(), 0).otherwise(F.size("lic_base")).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(names).alias("labels"), F.col("lic_score").alias("score"))
