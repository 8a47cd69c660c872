"""Edge cases of the operators and files, with literal expectations."""

import collections
import gzip

from pyspark.sql import functions as F

from annomerge.functions import nested
from annomerge.operators import dedupe, filters, joins, lof, merge, quality, stats
from annomerge.operators.ordinals import dense_order
from annomerge.plans import jobs
from annomerge.sources import layout, readers, writers
from tests import plans


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), (None, 3, "z")], "k string, ord int, v string")
    assert rows(dedupe.dedupe_first(df, ["k"], "ord"), "ord") == [("a", 1, None), (None, 3, "z")]
    assert rows(dedupe.dedupe_last(df, ["k"], "ord"), "ord") == [("a", 2, "y"), (None, 3, "z")]
    assert dedupe.dedupe_first(df.limit(0), ["k"], "ord").count() == 0


def test_first_seen_last_value(spark):
    df = spark.createDataFrame([("A", "C", "1", 1, 0.1), ("A", "C", "2", 2, 0.2), ("A", "C", "1", 3, 0.3)], "aaref string, aaalt string, pos string, ord int, s double")
    assert rows(dedupe.first_seen_last_value(df, ["aaref", "aaalt"], "pos", "ord", "s"), "s") == [("A", "C", "1", 0.3)]


def test_merges(spark):
    t = spark.createDataFrame([("G", "p.1", "c1", 0.5), (None, "p.2", "c2", 0.1)], "gene string, hgvs_p string, hgvs_c string, revel_score double")
    s = spark.createDataFrame([("G", "p.1", None, None), (None, "p.2", "c3", 0.2), ("G", "p.9", "c9", 0.9)], "gene string, hgvs_p string, hgvs_c string, revel_score double")
    assert ("G", "p.1", None, None) in rows(merge.merge_overwrite(t, s), "hgvs_p", "hgvs_c")
    assert ("G", "p.1", None, 0.5) in rows(merge.merge_coalesce(t, s, ["revel_score"]), "hgvs_p", "hgvs_c")
    assert merge.merge_overwrite(t, s).count() == 4
    assert ("G", "p.1", "c1", 0.5) in [(r.gene, r.hgvs_p, r.hgvs_c, r.revel_score) for r in merge.merge_overwrite(t, s.select("gene", "hgvs_p")).collect()]
    once = merge.merge_overwrite(t.where("gene IS NOT NULL"), s.where("gene IS NOT NULL"))
    assert rows(merge.merge_overwrite(once, s.where("gene IS NOT NULL")), "hgvs_p") == rows(once, "hgvs_p")


def test_merging_all_at_once_equals_one_after_the_other(spark):
    import random

    rng = random.Random(6)

    def a_source(columns, n):
        keyed = {(rng.choice("AB"), f"p.{rng.randrange(12)}") for _ in range(n)}
        each = [(*k, *[rng.choice([None, "x", "y", str(rng.randrange(99))]) for _ in columns]) for k in sorted(keyed)]
        lost = [(rng.choice(["A", None]), None, *["z" for _ in columns])] * 2
        return spark.createDataFrame(each + lost, ", ".join(f"{c} string" for c in ("gene", "hgvs_p", *columns)))

    keys = ["gene", "hgvs_p"]
    for shapes in (("ab", "bc", "abd"), ("a", "a", "a", "ac"), ("ab", "c"), ("a",)):
        sources = [a_source(columns, 14) for columns in shapes]
        for rules in ({}, {"keep": ["a"]}, {"keep": ["b", "c"]}):
            want = sources[0]
            for s in sources[1:]:
                want = merge.merge(want, s, keys, **rules)
            got = merge.merge_all(sources, keys, **rules)
            assert got.columns == want.columns
            assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.collect()))
    two = [a_source("ab", 14), a_source("ab", 14)]
    got = merge.merge_all(two, keys, insert_only=["a"]), merge.merge(*two, keys, insert_only=["a"])
    assert collections.Counter(map(tuple, got[0].collect())) == collections.Counter(map(tuple, got[1].collect()))


def test_merges_read_each_source_once(spark, tmp_path):
    for k, c in enumerate("abc"):
        spark.createDataFrame([("G", "p.1", "x")], f"gene string, hgvs_p string, {c} string").write.parquet(str(tmp_path / c))
    sources = [spark.read.parquet(str(tmp_path / c)) for c in "abc"]
    plan = plans.text(merge.merge_all(sources, ["gene", "hgvs_p"]))
    assert plan.count("FileScan") == 3 and plan.count("Exchange") == 1
    plan = plans.text(merge.merge(sources[0], sources[1], ["gene", "hgvs_p"]))
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 2


def test_revel_by_coordinates_first_row_decides(spark):
    v = spark.createDataFrame([("chr1", 5, "A", "C")], "chromosome string, position long, ref string, alt string")
    r = spark.createDataFrame([("1", "9", "5", "A", "C", ".", 1), ("1", "9", "5", "A", "C", "0.7", 2)], "chr string, hg19_pos string, grch38_pos string, ref string, alt string, REVEL string, ord int")
    assert joins.revel_by_coordinates(v, r).first()["revel_score"] is None


def test_cadd_wildcards(spark):
    v = spark.createDataFrame([(1, "1", 5, None, ""), (2, "1", 6, None, None)], "id int, chromosome string, position long, ref string, alt string")
    c = spark.createDataFrame([(1, "1", 5, "A", "C", 1.0, 10.0), (2, "1", 5, "A", "G", 2.0, 20.0)], "ord int, Chrom string, Pos long, Ref string, Alt string, RawScore double, PHRED double")
    assert rows(joins.annotate_cadd(v, c, "id"), "id") == [(1, "1", 5, "A", "C", 1.0, 10.0), (2, "1", 6, None, None, None, None)]


def test_nearby(spark):
    q = spark.createDataFrame([(1, "G", 628)], "id int, gene string, position int")
    v = spark.range(600, 700).select(F.lit("G").alias("gene"), F.col("id").cast("int").alias("position"), F.col("id").alias("ord"))
    assert [r["position"] for r in joins.nearby_variants(q, v.withColumnRenamed("id", "x"), "id").orderBy("position").collect()] == list(range(623, 633))


def test_nearby_joins_first_rows_of_each_position_alone(spark):
    q = spark.range(300).select("id", F.lit("G").alias("gene"), (F.col("id") % 2 + 8).cast("int").alias("position"))
    v = spark.range(40_000).select(F.lit("G").alias("gene"), (F.col("id") % 20).cast("int").alias("position"), (40_000 - F.col("id")).alias("ord"))
    near = joins.nearby_variants(q, v, "id", reach=2, most=3)
    got = sorted((r["id"], r["position"], r["ord"]) for r in near.collect())
    assert got == sorted((i, p, 40_000 - (39_980 + p)) for i in range(300) for p in range(8 + i % 2, 11 + i % 2))
    joined = [n for n in plans.nodes(near._jdf.queryExecution().executedPlan()) if "Join" in n.getClass().getSimpleName() and "LeftSemi" not in n.toString().split("\n")[0]]
    assert joined and max(n.metrics().get("numOutputRows").get().value() for n in joined) <= 2 * 18 * 3 + 300 * 3


def test_nearby_of_an_id_asked_twice_and_without_place(spark):
    q = spark.createDataFrame([(1, "G", 5), (1, "G", 50), (2, None, 5), (3, "G", None)], "id int, gene string, position int")
    v = spark.createDataFrame([("G", 4, 9), ("G", 6, 1), ("G", 51, 5), ("G", None, 0), (None, 5, 0)], "gene string, position int, ord int")
    got = joins.nearby_variants(q, v, "id", most=2).orderBy("ord").collect()
    assert [(r["id"], r["query_position"], r["position"], r["ord"]) for r in got] == [(1, 5, 6, 1), (1, 50, 51, 5)]


def test_rows_that_become_many_are_dealt_to_tasks(spark, sf_dir, tmp_path):
    from annomerge.plans.adapters import adapter
    from annomerge.sources.shared import deal

    assert deal(spark.range(1000), ["id"], 25, per_task=1000).rdd.getNumPartitions() == 25
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.parquet(str(tmp_path / "nation.parquet"))
    part = spark.read.parquet(f"{sf_dir}/part.parquet").limit(1).drop("p_partkey").crossJoin(spark.range(60_000).withColumnRenamed("id", "p_partkey"))
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    counts = [r["count"] for r in adapter(spark, str(tmp_path), "am_like").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 1_500_000 and max(counts) < 600_000


def test_rows_of_few_stored_bytes_are_dealt_to_tasks(spark, sf_dir, tmp_path):
    from annomerge.plans.adapters import adapter

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").limit(1).drop("o_orderkey").crossJoin(spark.range(1_200_000).withColumnRenamed("id", "o_orderkey"))
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    counts = [r["count"] for r in adapter(spark, str(tmp_path), "clinvar_like").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 1_200_000 and max(counts) < 600_000


def test_gnomad_payloads_are_made_of_bounded_numbers_of_rows(spark, sf_dir, tmp_path):
    from annomerge.plans import registry

    events = spark.read.parquet(f"{sf_dir}/events.parquet").limit(1).drop("event_id").crossJoin(spark.range(1_200_000).withColumnRenamed("id", "event_id"))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = registry.payloads(spark, str(tmp_path)).withColumn("n", F.size("data.gene.variants"))
        counts = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.sum("n").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert sum(counts) == 1_200_000 and max(counts) < 400_000
    plan = plans.text(registry.payloads(spark, str(tmp_path)))
    assert plan.rindex("ObjectHashAggregate") < plan.index("Exchange ")


def test_first_seen_last_value_sorts_no_rows(spark):
    data = [("A", None, None, 1, 0.1), ("A", None, "2", 2, 0.2), ("A", None, None, 3, 0.3), ("B", "C", "7", 4, 0.4), ("B", "C", "7", 9, None), ("B", "C", "8", 5, 0.5), ("D", "E", "9", None, 0.6)]
    df = spark.createDataFrame(data, "aaref string, aaalt string, pos string, ord int, s double")
    got = dedupe.first_seen_last_value(df, ["aaref", "aaalt"], "pos", "ord", "s")
    assert rows(got, "aaref") == [("A", None, None, 0.3), ("B", "C", "7", None), ("D", "E", None, None)]
    assert "SortAggregate" not in plans.text(got) and "HashAggregate" in plans.text(got)


def test_revel_by_coordinates_knows_how_few_variants_ask(spark):
    few = spark.range(10_000_000).where("id = 5").selectExpr("'chr1' AS chromosome", "id AS position", "'A' AS ref", "'C' AS alt")
    scores = spark.range(10_000_000).selectExpr("'1' AS chr", "'9' AS hg19_pos", "cast(id AS string) AS grch38_pos", "'A' AS ref", "'C' AS alt", "'0.7' AS REVEL", "id AS ord")
    got = joins.revel_by_coordinates(few, scores)
    assert [r["revel_score"] for r in got.collect()] == [0.7]
    shuffles = [n for n in plans.nodes(got._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert sum(n.metrics().get("shuffleRecordsWritten").get().value() for n in shuffles) < 1000


def test_cadd_joins_first_rows_of_each_pair_of_alleles_alone(spark):
    v = spark.range(1).selectExpr("id", "'1' AS chromosome", "5L AS position", "'A' AS ref", "'' AS alt")
    c = spark.range(1000).selectExpr("id AS ord", "'1' AS Chrom", "id % 2 + 5 AS Pos", "'A' AS Ref", "substr('CG', cast(id % 4 / 2 AS int) + 1, 1) AS Alt", "cast(id AS double) AS RawScore", "1.0D AS PHRED")
    got = joins.annotate_cadd(v, c, "id")
    assert [tuple(r) for r in got.collect()] == [(0, "1", 5, "A", "C", 0.0, 1.0)]
    inner = [n for n in plans.nodes(got._jdf.queryExecution().executedPlan()) if "Join" in n.getClass().getSimpleName() and "Inner" in n.simpleStringWithNodeId()]
    assert [n.metrics().get("numOutputRows").get().value() for n in inner] == [2]


def test_counts_and_checks(spark):
    genes = spark.createDataFrame([("A",), ("B",)], "gene string")
    data = spark.createDataFrame([("A", "p.1"), ("A", None)], "gene string, hgvs_p string")
    assert rows(stats.load_counts(genes, data), "gene") == [(None, 2), ("A", 2), ("B", 0)]
    assert stats.source_coverage(data.limit(0), "hgvs_p").first()["percent"] is None
    c = spark.createDataFrame([("1", 5), ("1", 5), ("1", None), ("1", None)], "chromosome string, position long")
    assert rows(quality.duplicate_keys(c, ["chromosome", "position"]), "position") == [("1", 5, 2)]


def test_match_transcripts(spark):
    df = spark.createDataFrame([("A;B;C",), ("D",)], "t string").select(nested.match_transcripts(F.array(F.lit("B"), F.lit("A")), F.col("t")).alias("m"))
    assert [r["m"] for r in df.collect()] == [["B", "A"], None]


def test_alphamissense_file(spark, tmp_path):
    text = "# notes\n# more\nuniprot_id\tprotein_variant\tam_pathogenicity\tam_class\nP1\tM1A\tbad\tambiguous\nP1\tM2A\nP1\tA1\t0.5\tx\n"
    with gzip.open(tmp_path / "am.tsv.gz", "wt") as f:
        f.write(text)
    got = jobs.parse_alphamissense(readers.read_alphamissense(spark, str(tmp_path / "am.tsv.gz"), order=True))
    assert [(r.hgvs_p, r.alphamissense_score, r.alphamissense_class) for r in got.orderBy("ord").collect()] == [("p.Met1Ala", None, "ambiguous"), ("p.Met2Ala", 0.0, "unknown")]


def test_alphamissense_coordinates_file(spark, tmp_path):
    (tmp_path / "hg38.tsv").write_text("# notes\n#CHROM\tPOS\tREF\tALT\tgenome\tuniprot_id\ttranscript_id\tprotein_variant\tam_pathogenicity\tam_class\nchr1\t5\tA\tC\thg38\tP1\tT\tV2L\t0.2\tlikely_benign\n")
    assert readers.read_alphamissense(spark, str(tmp_path / "hg38.tsv"), coordinates=True).first()["protein_variant"] == "V2L"


def test_cadd_payload(spark):
    df = spark.createDataFrame([('[["Chrom","Pos","Ref","Alt","PHRED"],["1","5","A","C","7.5"]]',), ('[["Chrom"]]',), ("[]",), (None,)], "p string")
    assert [(r.Chrom, r.Pos, r.RawScore, r.PHRED) for r in readers.cadd_from_payload(df, "p").collect()] == [("1", 5, 0.0, 7.5)]


def test_revel_for_genes(spark):
    """Rows of equal, NULL and repeated ord stay apart, by a broadcast and by a shuffle of transcripts alike."""
    scores = spark.createDataFrame([(1, 0.1, "T1;T2;T1"), (1, 0.1, "T1;T2;T1"), (1, 0.2, "T2"), (2, 0.2, "T3"), (None, 0.3, None), (None, 0.4, "T9;T2"), (None, 0.4, "T9;T2")], "ord int, revel_score double, Ensembl_transcriptid string")
    wanted = spark.createDataFrame([("A", ["T2", "T1"]), ("B", ["T2", "T9", None]), ("C", None), ("D", [])], "gene string, transcript_ids array<string>")
    want = [("A", 1, 0.1, ("T2", "T1"))] * 2 + [("A", 1, 0.2, ("T2",))] + [("A", None, 0.4, ("T2",))] * 2 + [("B", 1, 0.1, ("T2",))] * 2 + [("B", 1, 0.2, ("T2",))] + [("B", None, 0.4, ("T2", "T9"))] * 2
    for hint in ("broadcast", "merge"):
        got = joins.revel_for_genes(scores, wanted.hint(hint)).collect()
        assert sorted(((r.gene, r.ord, r.revel_score, tuple(r.matched_transcripts)) for r in got), key=str) == sorted(want, key=str)


def test_layout_by_coordinates_reads_asked_windows(spark, tmp_path):
    scores = spark.range(200_000).select((F.col("id") % 4 + 1).cast("string").alias("chr"), F.lit("0").alias("hg19_pos"), F.col("id").cast("string").alias("grch38_pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.format_number(F.col("id") / 200_000, 3).alias("REVEL"), F.col("id").alias("ord"))
    scores = scores.unionByName(scores.limit(1).withColumns({"grch38_pos": F.lit("."), "chr": F.lit("X")}))
    layout.write_by_coordinates(scores, str(tmp_path / "l"), "chr", "grch38_pos", width=1000)
    spark.range(100).select(F.concat(F.lit("chr"), (F.col("id") % 2 + 1).cast("string")).alias("chromosome"), (F.col("id") * 17 + 60_000).alias("position"), F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.col("id").alias("ord")).write.parquet(str(tmp_path / "v"))
    asked = spark.read.parquet(str(tmp_path / "v"))
    near = layout.read_at_places(spark, str(tmp_path / "l"), asked, "chromosome", "position", width=1000)
    rows_read = len(near.collect())
    assert plans.scan_metric(near, "numPartitions", "REVEL") == 4 and rows_read == 1000
    got = joins.revel_by_coordinates(asked, near), joins.revel_by_coordinates(asked, scores)
    assert rows(got[0], "ord") == rows(got[1], "ord") and got[0].where("revel_score IS NOT NULL").count() > 20
    whole = spark.read.parquet(str(tmp_path / "l"))
    assert whole.count() == 200_001 and set(whole.schema.names) == {*scores.columns, *layout.PARTS}


def test_layout_of_many_small_windows_is_widened(spark, tmp_path):
    scores = spark.range(30_000).select((F.col("id") % 2 + 1).cast("string").alias("chr"), F.col("id").cast("string").alias("pos"))
    scores = scores.unionByName(spark.createDataFrame([("1", "."), ("2", "-7")], "chr string, pos string"))
    path = str(tmp_path / "l")
    layout.write_by_coordinates(scores, path, "chr", "pos", width=10)
    folders = spark.read.parquet(path).select(*layout.PARTS).distinct().count()
    assert 100 < folders <= layout.FOLDERS + 2
    asked = spark.createDataFrame([("chr1", 20), ("2", 29_999), ("2", 5)], "chromosome string, position long")
    near = layout.read_at_places(spark, path, asked, "chromosome", "position", width=10)
    found = {(r["chr"], r["pos"]) for r in near.collect()}
    assert {("1", "20"), ("2", "29999"), ("2", "5")} <= found and len(found) < 3000
    assert spark.read.parquet(path).count() == 30_002


def test_buckets_are_not_shuffled(spark, tmp_path):
    stored = spark.range(500).select(F.lit("G").alias("gene"), F.col("id").cast("string").alias("hgvs_p"), F.lit(1).alias("a"))
    layout.write_bucketed(stored, "buckets_of_test", str(tmp_path / "b"), ["gene", "hgvs_p"], 8)
    spark.range(400, 600).select(F.lit("G").alias("gene"), F.col("id").cast("string").alias("hgvs_p"), F.lit(2).alias("a")).write.parquet(str(tmp_path / "s"))
    kept, source = spark.table("buckets_of_test"), spark.read.parquet(str(tmp_path / "s"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = merge.merge(kept, source, ["gene", "hgvs_p"], copartitioned=True)
        asked = filters.lookup_variants(source.drop("a"), kept, ["gene", "hgvs_p"])
        assert plans.text(merged).count("Exchange") == 1 and plans.text(asked).count("Exchange") == 1
        assert merged.groupBy("a").count().orderBy("a").collect() == [(1, 400), (2, 200)] and asked.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE buckets_of_test")


def test_dense_order(spark):
    import random

    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), k, rng.randrange(9)) for k in range(3000)] + [("hot", k, 0) for k in range(5000, 9000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, ord int, v int").repartition(7)
    assert [r.n for r in dense_order(df, ["ord"], name="n").orderBy("ord").collect()] == list(range(7000))
    got = collections.defaultdict(list)
    for r in dense_order(df, ["ord"], ["k"]).orderBy("ord").collect():
        got[r.k].append(r.ordinal)
    assert all(v == list(range(len(v))) for v in got.values()) and len(got["hot"]) == 4000
    assert dense_order(df.limit(0), ["ord"], ["k"]).count() == 0
    lists = nested.positions_by_substitution(df, ["k"], "ord", ["v"], chunk=64).collect()
    assert max(len(r.positions) for r in lists) == 64
    for k in ("hot", None):
        want = [v for _, _, v in sorted((x for x in data if x[0] == k), key=lambda x: x[1])]
        assert [p.v for r in sorted((r for r in lists if r.k == k), key=lambda r: r.chunk) for p in r.positions] == want


def test_rows_set_aside_on_write(spark):
    data = [(1, "G", "p.1", "1", 5, "A", "C", "38"), (2, "G", "p.1", "1", 6, "A", "C", "38"), (3, "G", "p.2", "1", 5, "A", "C", "38"), (4, None, "p.9", "1", 9, "A", "C", "38"), (5, "G", "p.9", "1", 9, "A", "C", "38"), (6, "G", None, None, 9, "A", "C", "38"), (7, "G", None, None, 9, "A", "C", "38"), (8, "G", "p.1", "1", 5, "A", "C", "38")]
    df = spark.createDataFrame(data, "ord int, gene string, hgvs_p string, chromosome string, position long, ref string, alt string, genome_build string")
    accepted, aside = quality.split_checked(df, "variants_missense")
    place = "repeated chromosome, position, ref, alt, genome_build"
    assert [r.ord for r in accepted.orderBy("ord").collect()] == [1, 5, 6, 7]
    assert [(r.ord, r.violations) for r in aside.orderBy("ord").collect()] == [(2, ["repeated gene, hgvs_p"]), (3, [place]), (4, ["gene is null"]), (8, [place, "repeated gene, hgvs_p"])]
    assert accepted.count() + aside.count() == df.count()
    accepted, aside = quality.split_checked(spark.createDataFrame([(1, "x", 1, "G"), (2, "lof", 1, "G"), (3, "lof", 1, None), (4, "lof", 1, "G")], "n int, variant_type string, variant_id int, gene string"), "penetrance_estimates", "n")
    assert [(r.n, r.violations) for r in aside.orderBy("n").collect()] == [(1, ["variant_type not allowed"]), (3, ["gene is null"]), (4, ["repeated variant_type, variant_id"])] and accepted.count() == 1
    assert plans.text(quality.repeated_keys(df, "variants_missense")).count("Exchange") == 1
    assert [x.count() for x in quality.split_checked(df.limit(0), "variants_missense")] == [0, 0]


def test_routes_are_one_scan(spark, tmp_path):
    spark.createDataFrame([("p.1", None, 1), ("p.2", "nonsense", 2), (None, "frameshift", 3), ("", None, 4)], "hgvs_p string, lof_type string, ord int").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    assert plans.text(lof.routed(df)).count("FileScan") == 1
    writers.write_routes(df, str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("variant_type", "ord"), "variant_type", "ord") == [("lof", 2), ("lof", 3), ("missense", 1), ("missense", 2)]


def test_top_rows_count_the_rest(spark):
    df = spark.createDataFrame([("G", k) for k in range(7)] + [(None, 1), ("H", 1)], "gene string, k int")
    assert rows(dedupe.top_rows(df, "gene", ["k"], 2), "gene", "k") == [(None, 1, 0), ("G", 0, 5), ("G", 1, 5), ("H", 1, 0)]


def test_gnomad_payloads_keep_row_order(spark, tmp_path):
    variant = '{"variant_id": "%s", "hgvsc": null, "hgvsp": "%s", "consequence": "x", "exome": {"ac": 1, "an": 2, "af": %s, "homozygote_count": 0}, "genome": null}'
    body = lambda *v: '{"data": {"gene": {"gene_id": "E", "symbol": "G", "variants": [' + ", ".join(variant % x for x in v) + "]}}}"
    (tmp_path / "g.json").write_text(body(("1-1-A-C", "p.1", 0.1), ("1-2-A-C", "p.1", 0.2)) + "\n" + body(("1-0-A-C", "p.1", 0.3), ("1-0-A-G", "p.2", 0.4)) + "\n" + '{"data": {"gene": null}}\n')
    flat = nested.flatten_gnomad(readers.read_gnomad(spark, str(tmp_path / "g.json"), order=True), "ord")
    assert rows(jobs.load_gnomad(flat).select("hgvs_p", "gnomad_af"), "hgvs_p") == [("p.1", 0.3), ("p.2", 0.4)]


def test_cadd_file_first_row_of_a_place(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED\n1\t5\tA\tG\t2.0\t20.0\n1\t5\tA\tC\t1.0\t10.0\n")
    v = spark.createDataFrame([(1, "chr1", 5, None, None), (2, "1", 5, "A", "C")], "id int, chromosome string, position long, ref string, alt string")
    got = joins.annotate_cadd(v, readers.read_cadd(spark, str(tmp_path / "c.tsv"), order=True), "id")
    assert rows(got.select("id", "alt", "cadd_phred"), "id") == [(1, "G", 20.0), (2, "C", 10.0)]


def test_features_of_all_sources(spark):
    am = spark.createDataFrame([("G", "p.Met1Ala", 0.5, "x", "M", "A", 1), ("G", "p.Met2Cys", 0.6, "x", "M", "C", 2)], "gene string, hgvs_p string, alphamissense_score double, alphamissense_class string, aaref string, aaalt string, ord int")
    gnomad = spark.createDataFrame([("G", "p.Met1Ala", "c.1", 0.1, 0, 1)], "gene string, hgvs_p string, hgvs_c string, gnomad_af double, gnomad_homozygotes long, ord int")
    clinvar = spark.createDataFrame([(1, "G", "p.Met1Ala", "c.2", "chr1", 5, "A", "C"), (2, "G", "p.Met2Cys", "c.3", "1", 6, None, None)], "ord int, gene string, hgvs_p string, hgvs_c string, chromosome string, position long, ref string, alt string")
    revel = spark.createDataFrame([(1, "1", "4", "5", "A", "C", "M", "A", "0.7", "T"), (2, "1", "5", "6", "A", "G", "Q", "R", "0.8", "T")], "ord int, chr string, hg19_pos string, grch38_pos string, ref string, alt string, aaref string, aaalt string, REVEL string, Ensembl_transcriptid string")
    cadd = spark.createDataFrame([(1, "1", 6, "A", "G", 3.0, 30.0)], "ord int, Chrom string, Pos long, Ref string, Alt string, RawScore double, PHRED double")
    scored = jobs.scored_clinvar(clinvar, revel.replace("0.7", "0.4", "REVEL"), cadd)
    got = jobs.feature_table(am, gnomad, scored, jobs.parse_revel(revel))
    assert rows(got.select("hgvs_p", "hgvs_c", "gnomad_af", "revel_score", "cadd_phred", "alt"), "hgvs_p") == [("p.Met1Ala", "c.2", 0.1, 0.7, None, "C"), ("p.Met2Cys", "c.3", None, None, 30.0, "G")]
    kept = jobs.feature_table(am, gnomad, scored, jobs.parse_revel(revel).where("aaref = 'none'"))
    assert rows(kept.select("hgvs_p", "revel_score"), "hgvs_p") == [("p.Met1Ala", 0.4), ("p.Met2Cys", None)]
    subs = jobs.substitution_scores(am, jobs.parse_revel(revel))
    step = merge.merge_coalesce(jobs.feature_table(am, gnomad, scored), subs, ["revel_score"])
    assert rows(step.select(*sorted(step.columns)), "hgvs_p") == rows(got.select(*sorted(got.columns)), "hgvs_p")


def test_no_shared_folder_on_a_cluster():
    import pytest

    from annomerge.sources.shared import shared_dir

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "spark://host:7077"}.get(key, default))

    with pytest.raises(RuntimeError):
        shared_dir(Session)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("G", 'p."1', ""), ("G", "p.0", None)], "gene string, hgvs_p string, v string")
    assert writers.export_csv(df, str(tmp_path / "csv"), "g")
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part*")))
    assert text == 'gene,hgvs_p,v\nG,"p.""1",\nG,p.0,\n'
    assert not writers.export_csv(df, str(tmp_path / "none"), "H") and not (tmp_path / "none").exists()
    writers.export_json(df, str(tmp_path / "json"))
    assert '"v":null' in "".join(p.read_text() for p in (tmp_path / "json").glob("part*"))
    writers.write_tsv(df.withColumn("a", F.array(F.lit("x"), F.lit("y"))).withColumn("b", F.lit(True)), str(tmp_path / "tsv"))
    assert "x,y\t1" in "".join(p.read_text() for p in (tmp_path / "tsv").glob("part*"))


def test_partition_number_does_not_matter(spark, sf_dir):
    from annomerge.plans.adapters import adapter

    df = adapter(spark, sf_dir, "clinvar_like")
    assert rows(jobs.load_clinvar(df.repartition(1)), "gene", "hgvs_p") == rows(jobs.load_clinvar(df.repartition(7)), "gene", "hgvs_p")
