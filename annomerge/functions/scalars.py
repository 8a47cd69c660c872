"""Column functions that parse and normalise variant fields. Nothing raises under ANSI mode: what fails is NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Review status to stars.
STARS = {
    "practice guideline": 4,
    "reviewed by expert panel": 3,
    "criteria provided, multiple submitters, no conflicts": 2,
    "criteria provided, conflicting classifications": 1,
    "criteria provided, single submitter": 1,
    "no assertion for the individual variant": 0,
    "no assertion criteria provided": 0,
    "no classification for the single variant": 0,
    "no classifications from unflagged records": 0,
    "no classification provided": 0,
}
# Amino acids, one letter to three.
AMINO_ACIDS = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe",
    "G": "Gly", "H": "His", "I": "Ile", "K": "Lys", "L": "Leu",
    "M": "Met", "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg",
    "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr",
}


def lookup(mapping: dict, key: Column) -> Column:
    """A small constant map as an expression; NULL for unknown keys."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]), key)


def found(name: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))


# What counts as a substitution, a stop and a coding change in a variant's name.
SUBSTITUTED = r"\(p\.([A-Za-z]{3}\d+[A-Za-z]{3})\)"
STOPPED = r"\(p\.([A-Za-z]{3}\d+(?:Ter|\*))\)"
CODING = r":c\.([^\s(]+)"


def parse_protein_change(name: Column) -> Column:
    """``p.`` and the first substitution in parentheses, else the first stop, whose star becomes Ter."""
    change = F.coalesce(found(name, SUBSTITUTED), F.replace(found(name, STOPPED), F.lit("*"), F.lit("Ter")))
    return F.concat(F.lit("p."), change)


def parse_hgvs_c(name: Column) -> Column:
    return F.concat(F.lit("c."), found(name, CODING))


def parse_review_date(text: Column) -> Column:
    """``Jun 01, 2020`` to a date, in any case and spacing."""
    return F.try_to_date(F.regexp_replace(text, r"\s+", " "), "MMM d, yyyy")


def review_stars(status: Column) -> Column:
    return F.coalesce(lookup(STARS, F.lower(status)), F.lit(0))


#: What follows the first underscore, or all, as a character, a whole number and a character.
SUBSTITUTION = r"^(?:[^_]*_)?+(.)(\d+)(.)$"


def parse_substitution(variant: Column) -> tuple[Column, Column, Column]:
    """(reference, position, alternate): position is NULL unless a whole number stands between two characters."""
    part = lambda k: F.regexp_extract(variant, SUBSTITUTION, k)
    return part(1), part(2).try_cast("int"), part(3)


def hgvs_p_from_aa(ref: Column, position: Column, alt: Column) -> Column:
    long = lambda aa: F.coalesce(lookup(AMINO_ACIDS, aa), aa)
    return F.concat(F.lit("p."), long(ref), position.cast("string"), long(alt))


def one_letter(aa: Column) -> Column:
    """The inverse map; other text passes unchanged."""
    return F.coalesce(lookup({v: k for k, v in AMINO_ACIDS.items()}, aa), aa)


def normalize_chromosome(c: Column) -> Column:
    return F.replace(c, F.lit("chr"), F.lit(""))


def na_to_null(text: Column, empty: bool = True) -> Column:
    out = F.nullif(text, F.lit("na"))
    return F.nullif(out, F.lit("")) if empty else out


def safe_long(text: Column) -> Column:
    return text.try_cast("bigint")


def safe_double(text: Column) -> Column:
    """Suffixes such as 0.5f, which a cast accepts, are no numbers."""
    return F.when(~text.rlike(r"[dDfF]\s*$"), text.try_cast("double"))


def variant_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    dash = F.lit("-")
    return F.concat(normalize_chromosome(chrom), dash, pos.cast("string"), dash, ref, dash, alt)


def preferred(first: Column, second: Column, zero_is_missing: bool = True) -> Column:
    """The first unless it is NULL or, by default, 0; then the second."""
    return F.when(first != 0, first).otherwise(second) if zero_is_missing else F.coalesce(first, second)


def homozygotes(first: Column, second: Column) -> Column:
    return F.coalesce(first, F.lit(0)) + F.coalesce(second, F.lit(0))


def classify_lof_type(hgvs_p: Column, consequence: Column) -> Column:
    p, c = F.coalesce(hgvs_p, F.lit("")), F.coalesce(consequence, F.lit(""))
    shift = F.contains(p, F.lit("fs"))
    out = F.when(F.contains(p, F.lit("Ter")) & ~shift, "nonsense").when(shift, "frameshift")
    for word, kind in (("splice_donor", "splice_donor"), ("splice_acceptor", "splice_acceptor"), ("stop_gained", "nonsense"), ("frameshift", "frameshift")):
        out = out.when(F.contains(c, F.lit(word)), kind)
    return out


def truncation_position(position: Column, length: Column) -> Column:
    return F.when(length <= 0, F.lit(0.0)).otherwise(position / F.when(length > 0, length))


def predict_nmd_escape(truncation: Column, last_exon: Column) -> Column:
    return F.when(F.coalesce(last_exon, F.lit(False)), True).otherwise(truncation > 0.90)


def shown(number: Column, digits: int, exponent: bool = False) -> Column:
    """The number with ``digits`` decimals, plain or with an exponent of two digits and its sign; N/A for none and for 0. The
    binary value is rounded, to even, as ``printf`` does; Spark's format_string would round its decimal text, and its
    format_number drops half of the last place, which is told apart here."""
    text = F.call_function("format_number", number, F.lit("0." + "0" * digits + "E00" * exponent))
    if exponent:
        text = F.regexp_replace(F.regexp_replace(text, "E(?=[0-9])", "e+"), "E-", "e-")
    else:
        exact = Decimal(5).scaleb(-digits - 1)
        half = float(exact)
        up = F.abs(number) >= half if Decimal(half) > exact else F.abs(number) > half
        sign = F.when(number < 0, "-").otherwise("")
        small = F.concat(sign, F.when(up, f"{10.0**-digits:.{digits}f}").otherwise(f"{0:.{digits}f}"))
        text = F.when(F.abs(number) < 10.0**-digits, small).otherwise(text)
    return F.when(number != 0, text).otherwise("N/A")


def build_position(build: Column, grch38: Column, hg19: Column) -> Column:
    return F.when(build == "GRCh38", grch38).otherwise(hg19)
