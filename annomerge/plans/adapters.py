"""Projections of the star-schema tables that stand in for the source files. The text runs on Spark and in the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annomerge.sources.shared import deal

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

CLINVAR_LIKE = """
SELECT o_orderkey AS ord,
 CASE WHEN o_orderkey % 13 = 0 THEN 'Deletion' ELSE 'single nucleotide variant' END AS type,
 'NM_' || cast(o_custkey AS string) || '.1(G):c.' || cast(o_orderkey % 900 + 1 AS string) || 'A>G (p.Ala'
   || cast(o_custkey % 60 + 1 AS string)
   || CASE WHEN o_orderkey % 7 = 0 THEN '*' WHEN o_orderkey % 11 = 0 THEN 'fs' ELSE 'Val' END || ')' AS name,
 'Brand#' || cast(o_custkey % 25 + 1 AS string) AS gene_symbol,
 o_orderpriority AS clinical_sig,
 CASE WHEN o_orderkey % 17 = 0 THEN '-' ELSE
   substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(o_orderdate) AS int) * 3 - 2, 3) || ' '
   || lpad(cast(day(o_orderdate) AS string), 2, '0') || ', ' || cast(year(o_orderdate) AS string) END AS last_evaluated,
 CASE WHEN o_orderkey % 5 = 0 THEN 'GRCh37' ELSE 'GRCh38' END AS assembly,
 CASE WHEN o_orderkey % 19 = 0 THEN 'na' ELSE cast(o_custkey % 22 + 1 AS string) END AS chromosome,
 CASE o_orderstatus WHEN 'F' THEN 'Reviewed by expert panel' WHEN 'O' THEN 'criteria provided, single submitter'
   ELSE 'something else' END AS review_status,
 cast(o_orderkey AS string) AS variation_id,
 CASE WHEN o_orderkey % 23 = 0 THEN 'na' ELSE cast(o_custkey % 60 + 1 AS string) END AS pos_vcf,
 substr('ACGT', cast(o_orderkey % 4 AS int) + 1, 1) AS ref_vcf, substr('CGTA', cast(o_orderkey % 4 AS int) + 1, 1) AS alt_vcf
FROM orders
"""

AM_LIKE = """
SELECT p_partkey * 25 + n_nationkey AS ord, p_brand AS uniprot_id,
 CASE WHEN p_partkey % 3 = 0 THEN 'G_' ELSE '' END || substr('ACDEFGHIKLMNPQRSTVWY', cast(p_partkey % 20 AS int) + 1, 1)
   || cast(p_partkey % 60 + 1 AS string) || substr('ACDEFGHIKLMNPQRSTVWY', n_nationkey % 20 + 1, 1) AS protein_variant,
 CASE WHEN (p_partkey * 25 + n_nationkey) % 29 = 0 THEN '.' ELSE
   '0.' || lpad(cast(((p_partkey * 25 + n_nationkey) * 7919) % 10000 AS string), 4, '0') END AS am_pathogenicity,
 CASE p_size % 3 WHEN 0 THEN 'likely_benign' WHEN 1 THEN 'ambiguous' ELSE 'likely_pathogenic' END AS am_class
FROM part CROSS JOIN nation
"""

REVEL_LIKE = """
SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS ord,
 cast(l_suppkey % 22 + 1 AS string) AS chr, cast(l_partkey + 1000 AS string) AS hg19_pos,
 CASE WHEN l_partkey % 31 = 0 THEN '.' ELSE cast(l_partkey AS string) END AS grch38_pos,
 substr('ACGT', cast(l_orderkey % 4 AS int) + 1, 1) AS ref, substr('CGTA', cast(l_orderkey % 4 AS int) + 1, 1) AS alt,
 substr('ACDEFGHIKLMNPQRSTVWY', cast(l_partkey % 20 AS int) + 1, 1) AS aaref, substr('ACDEFGHIKLMNPQRSTVWY', cast(l_suppkey % 20 AS int) + 1, 1) AS aaalt,
 CASE WHEN l_linenumber = 7 THEN '.' ELSE '0.' || lpad(cast((l_orderkey * 37 + l_partkey) % 1000 AS string), 3, '0') END AS REVEL,
 'ENST' || cast(l_partkey % 50 AS string) || ';ENST' || cast(l_suppkey % 50 AS string) AS Ensembl_transcriptid
FROM lineitem
"""

GNOMAD_LIKE = """
SELECT event_id AS ord, 'Brand#' || cast(user_id % 25 + 1 AS string) AS symbol,
 cast(user_id % 22 + 1 AS string) || '-' || cast(event_id AS string) || '-A-C' AS variant_id,
 CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'c.' || cast(event_id % 900 + 1 AS string) || 'A>C' END AS hgvsc,
 CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 37 = 0 THEN '' ELSE 'p.Ala' || cast(user_id % 60 + 1 AS string) || 'Val' END AS hgvsp,
 event_type AS consequence,
 CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 4 = 0 THEN cast(0 AS double) ELSE value / 1000 END AS exome_af,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 1000 END AS exome_an,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 4 END AS exome_hom,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE value / 2000 END AS genome_af,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 500 END AS genome_an,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 3 END AS genome_hom
FROM events
"""

CADD_LIKE = """
SELECT p_partkey AS ord, cast(p_partkey % 22 + 1 AS string) AS Chrom, p_partkey % 60 + 1 AS Pos,
 substr('ACGT', cast(p_partkey % 4 AS int) + 1, 1) AS Ref, substr('CGTA', cast(p_partkey % 4 AS int) + 1, 1) AS Alt,
 p_retailprice / 1000 AS RawScore, cast(p_size AS double) AS PHRED
FROM part
"""

LOF_LIKE = """
SELECT o_orderkey AS ord, 'Brand#' || cast(o_custkey % 25 + 1 AS string) AS gene, 'c.' || cast(o_orderkey % 900 + 1 AS string) || 'A>G' AS hgvs_c,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'p.Ala' || cast(o_custkey % 60 + 1 AS string)
   || CASE WHEN o_orderkey % 7 = 0 THEN 'Ter' WHEN o_orderkey % 11 = 0 THEN 'fsTer5' ELSE 'Val' END END AS hgvs_p,
 CASE o_orderkey % 5 WHEN 0 THEN 'splice_donor_variant' WHEN 1 THEN 'splice_acceptor_variant' WHEN 2 THEN 'stop_gained' WHEN 3 THEN 'missense_variant' END AS consequence,
 CASE o_orderkey % 4 WHEN 0 THEN 'HC' WHEN 1 THEN 'LC' WHEN 2 THEN '' END AS lof, CASE WHEN o_orderkey % 6 = 0 THEN 'A,B' ELSE '' END AS lof_flags,
 cast(o_custkey % 60 + 1 AS bigint) AS aa_position, cast(o_custkey % 3 * 40 AS bigint) AS protein_length,
 CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey % 9 = 0 END AS last_exon, cast(o_orderkey % 500 AS bigint) AS position
FROM orders
"""

GENES_LIKE = """
SELECT p_brand AS symbol, min(p_retailprice) / 2000 AS pli, max(p_retailprice) / 1000 AS loeuf FROM part GROUP BY p_brand
"""

PENETRANCE_LIKE = """
SELECT CASE s_suppkey % 3 WHEN 0 THEN 'lof' WHEN 1 THEN 'missense' ELSE 'other' END AS variant_type, cast(s_suppkey % 70 AS bigint) AS variant_id, cast(s_suppkey AS bigint) AS ord,
 'Brand#' || cast(s_suppkey % 25 + 1 AS string) AS gene, 'p.Ala' || cast(s_suppkey % 60 + 1 AS string) || 'Val' AS hgvs_p, s_acctbal / 10000 AS penetrance_mean
FROM supplier
"""

ADAPTERS = {"clinvar_like": CLINVAR_LIKE, "am_like": AM_LIKE, "revel_like": REVEL_LIKE, "gnomad_like": GNOMAD_LIKE, "cadd_like": CADD_LIKE, "lof_like": LOF_LIKE, "genes_like": GENES_LIKE, "penetrance_like": PENETRANCE_LIKE}

#: Tables of which a stand-in makes several rows of each, or rows much larger than those stored, with their key and that number.
DEALT = {("am_like", "part"): ("p_partkey", 25), ("clinvar_like", "orders"): ("o_orderkey", 1)}


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in as a DataFrame; its plan holds the files, not the views that name them meanwhile."""
    text = ADAPTERS[name]
    for table in TABLES:
        if f"FROM {table}" in text or f"JOIN {table}" in text:
            rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            if (name, table) in DEALT:
                key, each = DEALT[name, table]
                rows = deal(rows, [key], each)
            rows.createOrReplaceTempView(table)
    return spark.sql(text)


def ctes(*names: str) -> str:
    """The stand-ins as common table expressions."""
    return ", ".join(f"{n} AS ({ADAPTERS[n].strip()})" for n in names)
