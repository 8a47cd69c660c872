"""Stored tables: times, untouched folders, failed loads, and coverage that is kept beside them."""

import datetime
import pathlib

import pytest
from pyspark.sql import functions as F

from annomerge.operators import stats
from annomerge.plans import jobs
from annomerge.sources import stored
from tests import plans

FIRST, SECOND = (datetime.datetime(2024, m, 1, tzinfo=datetime.timezone.utc) for m in (1, 2))
KIND = "gene string, hgvs_p string, gnomad_af double"


def told(spark, path):
    rows = stored.read_stored(spark, path, "variants_missense")
    each = rows.select("gene", "hgvs_p", "hgvs_c", "gnomad_af", "clinvar_id", F.month("created_at"), F.month("updated_at"), "genome_build").collect()
    return sorted(map(tuple, each), key=str)


def files(path, gene):
    return {(f.name, f.stat().st_mtime_ns) for f in pathlib.Path(path, f"gene={gene}").iterdir()}


def test_a_second_load_touches_its_own_genes_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored.read_stored(spark, path, "variants_missense").count() == 0
    stored.upsert(spark, path, "variants_missense", spark.createDataFrame([("A", "p.1", 0.1), ("A", "p.2", 0.2), ("B", "p.1", 0.3), (None, "p.9", 0.4)], KIND), FIRST)
    before = files(path, "B")
    done = stored.upsert(spark, path, "variants_missense", spark.createDataFrame([("A", "p.1", None, 7), ("A", "p.3", "c.3", 8), ("C", None, "c.9", 9)], "gene string, hgvs_p string, hgvs_c string, clinvar_id long"), SECOND)
    assert sorted(r.gene for r in done.collect()) == ["A", "C"] and files(path, "B") == before
    want = [("A", "p.1", None, 0.1, 7, 1, 2, "GRCh38"), ("A", "p.2", None, 0.2, None, 1, 1, "GRCh38"), ("A", "p.3", "c.3", None, 8, 2, 2, "GRCh38"), ("B", "p.1", None, 0.3, None, 1, 1, "GRCh38"), ("C", None, "c.9", None, 9, 2, 2, "GRCh38")]
    assert told(spark, path) == want
    again = spark.createDataFrame([("A", "p.1", None, 7), ("A", "p.3", "c.3", 8)], "gene string, hgvs_p string, hgvs_c string, clinvar_id long")
    stored.upsert(spark, path, "variants_missense", again, SECOND)
    assert told(spark, path) == want
    stored.upsert(spark, path, "variants_missense", again.limit(0), SECOND)
    assert told(spark, path) == want


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.upsert(spark, path, "variants_missense", spark.createDataFrame([("A", "p.1", 0.1), ("B", "p.1", 0.3)], KIND), FIRST)
    want, kept = told(spark, path), {g: files(path, g) for g in "AB"}
    late = stored.read_stored(spark, path, "variants_missense").withColumn("gnomad_af", F.when(F.col("gene") == "B", F.raise_error(F.lit("broken")).cast("double")).otherwise(1.0))
    with pytest.raises(Exception, match="broken"):  # while folders are written
        stored.replace_genes(late, path)
    with pytest.raises(ValueError, match="no columns"):
        stored.upsert(spark, path, "variants_missense", spark.createDataFrame([("A", 1)], "gene string, other int"), FIRST)
    assert told(spark, path) == want and {g: files(path, g) for g in "AB"} == kept


def test_loads_read_the_folders_of_their_genes(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.upsert(spark, path, "variants_missense", spark.range(2000).select(F.concat(F.lit("G"), (F.col("id") % 50).cast("string")).alias("gene"), F.col("id").cast("string").alias("hgvs_p")), FIRST)
    genes = spark.createDataFrame([("G7",), ("G8",), ("none",)], "gene string")
    genes.write.parquet(str(tmp_path / "g"))
    rows = stored.of_genes(stored.read_stored(spark, path, "variants_missense"), spark.read.parquet(str(tmp_path / "g")))
    assert len(rows.collect()) == 80 and plans.scan_metric(rows, "numPartitions", "hgvs_p") == 2


def test_types_of_lof_are_required(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.upsert(spark, path, "variants_lof", spark.createDataFrame([("A", "c.1", "nonsense", ["x"]), ("A", "c.2", None, None)], "gene string, hgvs_c string, lof_type string, loftee_flags array<string>"), FIRST)
    assert [(r.hgvs_c, r.loftee_flags) for r in stored.read_stored(spark, path, "variants_lof").collect()] == [("c.1", ["x"])]


def test_coverage_is_counted_for_loaded_genes_alone(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    genes = spark.createDataFrame([("A",), ("B",)], "gene string")
    loaded = {"gnomad": spark.createDataFrame([("A", "p.1", 0.1), ("B", "p.1", None), ("C", "p.1", 0.5)], KIND), "clinvar": spark.createDataFrame([("B", "p.2", 5)], "gene string, hgvs_p string, clinvar_id long")}
    jobs.build(spark, path, genes, "ALL", loaded, FIRST, state)
    before = files(state, "A")
    jobs.build(spark, path, genes.where("gene = 'B'"), " clinvar ,nothing", {"clinvar": loaded["clinvar"].withColumn("hgvs_p", F.lit("p.3"))}, SECOND, state)
    assert jobs.build(spark, path, genes, "nothing", loaded, SECOND, state).count() == 0
    assert files(state, "A") == before
    report = [tuple(r) for r in stored.coverage_report(spark, state).collect()]
    assert report == [("B", 3, 2, 0, 0, 0), ("A", 1, 0, 0, 1, 0)]
    assert report == [tuple(r) for r in stats.coverage_by_gene(stored.read_stored(spark, path, "variants_missense")).collect()]


def test_refused_rows_are_set_aside(spark, tmp_path):
    path, aside = str(tmp_path / "t"), str(tmp_path / "aside")
    df = spark.createDataFrame([(1, "A", "p.1", 7), (2, "A", "p.1", 8), (3, None, "p.1", 9), (4, "B", None, 1)], "ord int, gene string, hgvs_p string, clinvar_id long")
    jobs.load_checked(spark, path, "variants_missense", df, aside, FIRST)
    assert [(r[0], r[1], r[4]) for r in told(spark, path)] == [("A", "p.1", 7), ("B", None, 1)]
    assert sorted((r.ord, r.violations) for r in spark.read.parquet(aside).collect()) == [(2, ["repeated gene, hgvs_p"]), (3, ["gene is null"])]
