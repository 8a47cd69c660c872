"""Edge cases of the column functions, with literal expectations."""

import datetime

import pytest
from pyspark.sql import functions as F

from annomerge.functions import scalars as x


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("name,want", [
    ("NM_000238.4(KCNH2):c.1682C>T (p.Ala561Val)", "p.Ala561Val"), ("a (p.Arg534Ter)", "p.Arg534Ter"), ("a (p.Arg534*)", "p.Arg534Ter"),
    ("a (p.Gly24fs)", None), ("a (p.Ala1=)", None), ("none", None), (None, None),
])
def test_parse_protein_change(spark, name, want):
    assert one(spark, x.parse_protein_change(F.col("n")), n=name) == want


def test_parse_hgvs_c(spark):
    assert one(spark, x.parse_hgvs_c(F.col("n")), n="NM_000238.4(KCNH2):c.1682C>T (p.Ala561Val)") == "c.1682C>T"
    assert one(spark, x.parse_hgvs_c(F.col("n")), n="none") is None


@pytest.mark.parametrize("text", ["Jun 01, 2020", "jun 1, 2020", "Jun  1, 2020"])
def test_review_date(spark, text):
    assert one(spark, x.parse_review_date(F.col("n")), n=text) == datetime.date(2020, 6, 1)


@pytest.mark.parametrize("text", ["-", "", None, "Feb 30, 2020", "June 01, 2020", "2020-06-01"])
def test_no_review_date(spark, text):
    assert one(spark, x.parse_review_date(F.col("n")), n=text) is None


def test_stars(spark):
    assert [one(spark, x.review_stars(F.col("n")), n=n) for n in ("Practice Guideline", "reviewed by expert panel", "other", None)] == [4, 3, 0, 0]


@pytest.mark.parametrize("text,want", [("OR4F5_A61T", ("A", 61, "T")), ("A61T", ("A", 61, "T")), ("A1", None), ("A_B_A61T", None), ("AxT", None), ("_1T", None), (None, None)])
def test_substitution(spark, text, want):
    ref, pos, alt = x.parse_substitution(F.col("v"))
    got = spark.createDataFrame([(text,)], "v string").select(ref, pos, alt).first()
    assert (tuple(got) if got[1] is not None else None) == want


def test_hgvs_p(spark):
    assert one(spark, x.hgvs_p_from_aa(F.col("r"), F.col("p"), F.col("a")), r="M", p=1, a="A") == "p.Met1Ala"
    assert one(spark, x.hgvs_p_from_aa(F.col("r"), F.col("p"), F.col("a")), r="X", p=5, a="A") == "p.X5Ala"
    assert one(spark, x.one_letter(F.col("r")), r="Met") == "M"


def test_preferred(spark):
    rows = spark.createDataFrame([(0.0, 0.2), (0.0, None), (None, 0.0), (0.1, 0.2)], "e double, g double")
    assert [r[0] for r in rows.select(x.preferred(F.col("e"), F.col("g"))).collect()] == [0.2, None, 0.0, 0.1]
    assert [r[0] for r in rows.select(x.preferred(F.col("e"), F.col("g"), zero_is_missing=False)).collect()] == [0.0, 0.0, 0.0, 0.1]


def test_lof(spark):
    rows = spark.createDataFrame([("p.Arg534Ter", None), ("p.Gly24fsTer5", None), (None, "splice_donor_variant"), (None, "stop_gained"), ("p.Ala1Val", "missense_variant"), ("p.Ter12Leu", None)], "p string, c string")
    assert [r[0] for r in rows.select(x.classify_lof_type(F.col("p"), F.col("c"))).collect()] == ["nonsense", "frameshift", "splice_donor", "nonsense", None, "nonsense"]
    rows = spark.createDataFrame([(534, 1159), (5, 0)], "p long, n long")
    assert [r[0] for r in rows.select(x.truncation_position(F.col("p"), F.col("n"))).collect()] == [534 / 1159, 0.0]
    rows = spark.createDataFrame([(0.9, False), (0.91, False), (0.1, True), (None, None)], "t double, l boolean")
    assert [r[0] for r in rows.select(x.predict_nmd_escape(F.col("t"), F.col("l"))).collect()] == [False, True, True, None]


def test_numbers_and_ids(spark):
    assert one(spark, x.safe_double(F.col("n")), n="0.5f") is None
    assert one(spark, x.safe_double(F.col("n")), n="0.5") == 0.5
    assert one(spark, x.variant_id(F.col("c"), F.col("p"), F.col("r"), F.col("a")), c="chr1", p=5, r="A", a="C") == "1-5-A-C"
    assert one(spark, x.variant_id(F.col("c"), F.col("p"), F.col("r"), F.col("a")), c="chr1", p=5, r=None, a="C") is None
    assert [one(spark, x.shown(F.col("n"), 2, exponent=True), n=n) for n in (0.0, 1.234e-5, 12345.0, 1.5)] == ["N/A", "1.23e-05", "1.23e+04", "1.50e+00"]
    assert [one(spark, x.shown(F.col("n"), 3), n=n) for n in (0.2345, 1234.5, -0.0625, 0.9996)] == ["0.234", "1234.500", "-0.062", "1.000"]


def test_shown_numbers_round_as_printf(spark):
    numbers = [s * k / 10_000 for k in range(1, 20_001) for s in (1, -1)] + [k / 1000 + 0.0005 for k in range(50)]
    got = spark.createDataFrame([(n,) for n in numbers], "n double").select("n", x.shown(F.col("n"), 3).alias("three"), x.shown(F.col("n"), 2).alias("two")).collect()
    assert [(r.n, r.three, r.two) for r in got if (r.three, r.two) != (f"{r.n:.3f}", f"{r.n:.2f}")] == []
