"""Registered queries of the annotation operators over the stand-in tables, each beside the SQL that tells its result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annomerge.functions import nested
from annomerge.functions import scalars as x
from annomerge.operators import dedupe, filters, joins, lof, merge, quality, stats
from annomerge.operators.ordinals import dense_order
from annomerge.plans import jobs
from annomerge.plans.adapters import adapter, ctes
from annomerge.sources.shared import ROWS_PER_TASK, deal, fresh_path, materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: Views that oracles share, with the stand-ins that they need.
AA, LONG = (f"'{''.join(part)}'" for part in (x.AMINO_ACIDS.keys(), x.AMINO_ACIDS.values()))


def three(c: str) -> str:
    return f"CASE WHEN instr({AA}, {c}) > 0 THEN substr({LONG}, CAST(instr({AA}, {c}) * 3 - 2 AS INT), 3) ELSE {c} END"


CHANGE = f"coalesce(nullif(regexp_extract(name, '{x.SUBSTITUTED}', 1), ''), replace(nullif(regexp_extract(name, '{x.STOPPED}', 1), ''), '*', 'Ter'))"
PARSED = rf"""parsed AS (SELECT ord, gene_symbol AS gene, type, assembly, 'p.' || {CHANGE} AS hgvs_p,
  'c.' || nullif(regexp_extract(name, '{x.CODING}', 1), '') AS hgvs_c, nullif(chromosome, 'na') AS chromosome,
  TRY_CAST(nullif(nullif(pos_vcf, 'na'), '') AS BIGINT) AS position, nullif(nullif(ref_vcf, 'na'), '') AS ref, nullif(nullif(alt_vcf, 'na'), '') AS alt,
  TRY_CAST(variation_id AS BIGINT) AS clinvar_id, clinical_sig AS clinvar_significance, review_status AS clinvar_review_status,
  CAST(CASE lower(review_status) WHEN 'practice guideline' THEN 4 WHEN 'reviewed by expert panel' THEN 3 WHEN 'criteria provided, multiple submitters, no conflicts' THEN 2
    WHEN 'criteria provided, conflicting classifications' THEN 1 WHEN 'criteria provided, single submitter' THEN 1 ELSE 0 END AS INT) AS clinvar_stars,
  CAST(try_strptime(last_evaluated, '%b %d, %Y') AS DATE) AS clinvar_last_evaluated FROM clinvar_like)"""
CLINVAR = f"""{PARSED}, clinvar AS (SELECT * EXCLUDE (type, assembly) FROM parsed WHERE assembly = 'GRCh38' AND type = 'single nucleotide variant' AND hgvs_p IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY gene, hgvs_p ORDER BY ord) = 1)"""
AM = rf"""am_cut AS (SELECT *, CASE WHEN instr(protein_variant, '_') > 0 THEN substr(protein_variant, instr(protein_variant, '_') + 1) ELSE protein_variant END AS v FROM am_like),
  am_parsed AS (SELECT ord, uniprot_id, substr(v, 1, 1) AS aaref, TRY_CAST(nullif(regexp_extract(v, '^.(\d+).$', 1), '') AS INT) AS aa_position, substr(v, length(v), 1) AS aaalt,
  CASE WHEN am_pathogenicity IS NULL AND am_class IS NULL THEN 0.0::DOUBLE ELSE TRY_CAST(am_pathogenicity AS DOUBLE) END AS alphamissense_score, coalesce(am_class, 'unknown') AS alphamissense_class FROM am_cut),
  am_all AS (SELECT ord, uniprot_id, aaref, aa_position, aaalt, 'p.' || {three("aaref")} || CAST(aa_position AS VARCHAR) || {three("aaalt")} AS hgvs_p, alphamissense_score, alphamissense_class FROM am_parsed WHERE aa_position IS NOT NULL),
  am_dim AS (SELECT DISTINCT symbol AS gene, symbol AS uniprot_id FROM genes_like),
  am AS (SELECT gene, hgvs_p, alphamissense_score, alphamissense_class, aaref, aaalt, ord FROM am_all JOIN am_dim USING (uniprot_id) QUALIFY row_number() OVER (PARTITION BY gene, hgvs_p ORDER BY ord DESC) = 1)"""
GNOMAD = """g_flat AS (SELECT ord, CAST(ord // 1000 AS BIGINT) AS part, CAST(row_number() OVER (PARTITION BY symbol, ord // 1000 ORDER BY ord) - 1 AS INT) AS place, symbol, variant_id, hgvsc AS hgvs_c, hgvsp AS hgvs_p, consequence, CASE WHEN exome_af <> 0 THEN exome_af ELSE genome_af END AS gnomad_af,
  CAST(CASE WHEN exome_an <> 0 THEN exome_an ELSE genome_an END AS BIGINT) AS gnomad_an, CAST(coalesce(exome_hom, 0) + coalesce(genome_hom, 0) AS BIGINT) AS gnomad_homozygotes FROM gnomad_like),
  gnomad AS (SELECT symbol AS gene, hgvs_p, hgvs_c, gnomad_af, gnomad_homozygotes, ord FROM g_flat WHERE hgvs_p <> '' QUALIFY row_number() OVER (PARTITION BY symbol, hgvs_p ORDER BY ord DESC) = 1)"""
REVEL = """revel AS (SELECT ord, replace(chr, 'chr', '') AS chromosome, hg19_pos, grch38_pos, ref, alt, aaref, aaalt, TRY_CAST(REVEL AS DOUBLE) AS revel_score, Ensembl_transcriptid FROM revel_like WHERE TRY_CAST(REVEL AS DOUBLE) IS NOT NULL)"""
FIRST_LAST = """d3 AS (SELECT aaref, aaalt, grch38_pos, revel_score FROM (SELECT *, min(ord) OVER (PARTITION BY aaref, aaalt, grch38_pos) AS f, max(ord) OVER (PARTITION BY aaref, aaalt, grch38_pos) AS l FROM revel)
  WHERE ord = l QUALIFY row_number() OVER (PARTITION BY aaref, aaalt ORDER BY f) = 1)"""
SCORED = """revel_first AS (SELECT chr, grch38_pos, ref, alt, TRY_CAST(REVEL AS DOUBLE) AS revel_score FROM revel_like QUALIFY row_number() OVER (PARTITION BY chr, grch38_pos, ref, alt ORDER BY ord) = 1),
  cadd_hit AS (SELECT a.ord AS id, c.Chrom, c.Pos, c.Ref AS cref, c.Alt AS calt, c.RawScore, c.PHRED FROM clinvar a JOIN cadd_like c ON a.chromosome = c.Chrom AND a.position = c.Pos AND (coalesce(a.ref, '') = '' OR a.ref = c.Ref) AND (coalesce(a.alt, '') = '' OR a.alt = c.Alt)
  QUALIFY row_number() OVER (PARTITION BY a.ord ORDER BY c.ord) = 1),
  scored AS (SELECT c.* REPLACE (coalesce(h.Chrom, c.chromosome) AS chromosome, coalesce(h.Pos, c.position) AS position, CASE WHEN h.id IS NOT NULL THEN h.cref ELSE c.ref END AS ref, CASE WHEN h.id IS NOT NULL THEN h.calt ELSE c.alt END AS alt),
  r.revel_score, h.RawScore AS cadd_raw, h.PHRED AS cadd_phred FROM clinvar c LEFT JOIN revel_first r ON c.chromosome = r.chr AND CAST(c.position AS VARCHAR) = r.grch38_pos AND c.ref = r.ref AND c.alt = r.alt LEFT JOIN cadd_hit h ON c.ord = h.id),
  subs AS (SELECT am.gene, am.hgvs_p, am.alphamissense_score, am.alphamissense_class, d3.revel_score FROM am LEFT JOIN d3 USING (aaref, aaalt))"""
FEATURES = f"""{AM}, {GNOMAD}, {CLINVAR}, {REVEL}, {FIRST_LAST}, {SCORED}, two AS (SELECT coalesce(a.gene, g.gene) AS gene, coalesce(a.hgvs_p, g.hgvs_p) AS hgvs_p, alphamissense_score, alphamissense_class, hgvs_c, gnomad_af, gnomad_homozygotes
  FROM am a FULL JOIN gnomad g ON a.gene = g.gene AND a.hgvs_p = g.hgvs_p),
  three AS (SELECT coalesce(t.gene, c.gene) AS gene, coalesce(t.hgvs_p, c.hgvs_p) AS hgvs_p, alphamissense_score, alphamissense_class, CASE WHEN c.gene IS NOT NULL THEN c.hgvs_c ELSE t.hgvs_c END AS hgvs_c,
  gnomad_af, gnomad_homozygotes, chromosome, position, ref, alt, clinvar_id, clinvar_significance, clinvar_review_status, clinvar_stars, clinvar_last_evaluated, revel_score, cadd_raw, cadd_phred
  FROM two t FULL JOIN scored c ON t.gene = c.gene AND t.hgvs_p = c.hgvs_p),
  features AS (SELECT t.* REPLACE (coalesce(u.revel_score, t.revel_score) AS revel_score) FROM three t LEFT JOIN subs u ON t.gene = u.gene AND t.hgvs_p = u.hgvs_p)"""
LOF = """lof_typed AS (SELECT *, CASE WHEN coalesce(hgvs_p, '') LIKE '%fs%' THEN 'frameshift' WHEN coalesce(hgvs_p, '') LIKE '%Ter%' THEN 'nonsense' WHEN consequence LIKE '%splice_donor%' THEN 'splice_donor'
  WHEN consequence LIKE '%splice_acceptor%' THEN 'splice_acceptor' WHEN consequence LIKE '%stop_gained%' THEN 'nonsense' WHEN consequence LIKE '%frameshift%' THEN 'frameshift' END AS lof_type,
  CASE WHEN protein_length <= 0 THEN 0.0::DOUBLE ELSE aa_position::DOUBLE / protein_length::DOUBLE END AS truncation FROM lof_like)"""
IN = {PARSED: ("clinvar_like",), CLINVAR: ("clinvar_like",), AM: ("am_like", "genes_like"), GNOMAD: ("gnomad_like",), FEATURES: ("clinvar_like", "am_like", "genes_like", "gnomad_like", "revel_like", "cadd_like"), REVEL: ("revel_like",), LOF: ("lof_like",)}


def query(name: str, select: str, *views: str, tables: tuple = ()):
    """Register the function under its name, with ``select`` over the views as its oracle."""
    def keep(f):
        needed = dict.fromkeys([t for v in views for t in IN.get(v, ())] + list(tables))
        parts = [p for p in [ctes(*needed) if needed else "", *views] if p]
        QUERIES[name] = f
        SQL[name] = (f"WITH {', '.join(parts)}" if parts else "") + (select if select.startswith(",") else f" {select}")
        return f

    return keep


def parsed(s, d):
    return jobs.parse_clinvar(adapter(s, d, "clinvar_like"))


def clinvar(s, d):
    return jobs.load_clinvar(adapter(s, d, "clinvar_like"))


def dim(s, d):
    return adapter(s, d, "genes_like").select(F.col("symbol").alias("gene"), F.col("symbol").alias("uniprot_id"))


def am_all(s, d):
    return jobs.parse_alphamissense(adapter(s, d, "am_like"))


def am(s, d):
    return jobs.load_alphamissense(adapter(s, d, "am_like"), dim(s, d), keep=("aaref", "aaalt"))


def payloads(s, d):
    """The nested form: a payload for each gene and thousand of rows, variants in row order, and the order of payloads. Rows are dealt
    to tasks by their thousand, so a task makes whole payloads of a bounded number of rows and nothing is shuffled again. It holds
    each row twice, in a partial payload and in a whole one."""
    g = deal(adapter(s, d, "gnomad_like").withColumn("part", F.floor(F.col("ord") / 1000)), ["part"], per_task=ROWS_PER_TASK // 2)
    side = lambda p: F.when(F.coalesce(f"{p}_af", f"{p}_an", f"{p}_hom").isNotNull(), F.struct(F.lit(None).cast("long").alias("ac"), F.col(f"{p}_an").cast("long").alias("an"), F.col(f"{p}_af").alias("af"), F.col(f"{p}_hom").cast("long").alias("homozygote_count")))
    v = F.struct("variant_id", "hgvsc", "hgvsp", "consequence", side("exome").alias("exome"), side("genome").alias("genome"))
    groups = g.groupBy("symbol", "part").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", v.alias("v")))), lambda x: x["v"]).alias("variants"))
    return groups.select("part", F.struct(F.struct(F.lit("ENSG").alias("gene_id"), "symbol", "variants").alias("gene")).alias("data"))


def gnomad_flat(s, d):
    return nested.flatten_gnomad(payloads(s, d), "part")


def gnomad(s, d):
    return jobs.load_gnomad(gnomad_flat(s, d))


def features(s, d):
    return jobs.feature_table(am(s, d), gnomad(s, d), scored(s, d), revel(s, d))


def scored(s, d):
    return jobs.scored_clinvar(clinvar(s, d), adapter(s, d, "revel_like"), adapter(s, d, "cadd_like"))


def substitutions(s, d):
    return jobs.substitution_scores(am(s, d), revel(s, d))


def revel(s, d):
    return jobs.parse_revel(adapter(s, d, "revel_like"))


def lof_rows(s, d):
    return adapter(s, d, "lof_like")


# Parsing, filters, deduplication

COLUMNS = "ord, gene, type, assembly, hgvs_p, hgvs_c, chromosome, position, ref, alt, clinvar_id, clinvar_significance, clinvar_review_status, clinvar_stars, clinvar_last_evaluated"
query("parse_clinvar", f"SELECT {COLUMNS} FROM parsed", PARSED)(parsed)
query("filter_clinvar", f"SELECT {COLUMNS} FROM parsed WHERE assembly = 'GRCh37' AND hgvs_p IS NOT NULL", PARSED)(lambda s, d: filters.filter_clinvar(parsed(s, d), "GRCh37", include_all_types=True))
query("dedupe_first", "SELECT * FROM clinvar", CLINVAR)(clinvar)
query("load_clinvar", "SELECT ord, gene, hgvs_p, clinvar_id, clinvar_stars, clinvar_last_evaluated FROM clinvar WHERE gene IN (SELECT DISTINCT symbol FROM genes_like WHERE symbol < 'Brand#2')", CLINVAR, tables=("genes_like",))(lambda s, d: jobs.load_clinvar(adapter(s, d, "clinvar_like"), adapter(s, d, "genes_like").where("symbol < 'Brand#2'").select(F.col("symbol").alias("gene"))).select("ord", "gene", "hgvs_p", "clinvar_id", "clinvar_stars", "clinvar_last_evaluated"))
query("review_stars", "SELECT clinvar_stars, count(*) AS n_rows FROM parsed GROUP BY clinvar_stars", PARSED)(lambda s, d: parsed(s, d).groupBy("clinvar_stars").agg(F.count("*").alias("n_rows")))
query("normalize_genes", "SELECT DISTINCT upper(trim(g)) AS gene FROM (SELECT unnest(string_split(replace(c_mktsegment, 'E', ', e'), ',')) AS g FROM customer) WHERE trim(g) <> ''")(lambda s, d: filters.normalize_genes(s.read.parquet(f"{d}/customer.parquet").select(F.replace("c_mktsegment", F.lit("E"), F.lit(", e")).alias("genes")), "genes"))
query("filter_gene_set", "SELECT ord, gene, hgvs_p FROM parsed WHERE gene IN (SELECT symbol FROM genes_like WHERE symbol >= 'Brand#2')", PARSED, tables=("genes_like",))(lambda s, d: filters.filter_gene_set(parsed(s, d), adapter(s, d, "genes_like").where("symbol >= 'Brand#2'"), gene_col="symbol").select("ord", "gene", "hgvs_p"))
query("parse_alphamissense", "SELECT * FROM am_all", AM)(am_all)
query("drop_bad_scores", "SELECT ord, chromosome, aaref, aaalt, revel_score FROM revel", REVEL)(lambda s, d: revel(s, d).select("ord", "chromosome", "aaref", "aaalt", "revel_score"))
query("alphamissense_for_genes", "SELECT * FROM am_all JOIN am_dim USING (uniprot_id)", AM)(lambda s, d: joins.alphamissense_for_genes(am_all(s, d), dim(s, d)))
query("unmapped_genes", "SELECT DISTINCT symbol AS gene FROM gnomad_like WHERE symbol NOT IN (SELECT symbol FROM genes_like WHERE symbol < 'Brand#3')", tables=("gnomad_like", "genes_like"))(lambda s, d: joins.unmapped_genes(adapter(s, d, "gnomad_like").select(F.col("symbol").alias("gene")).distinct(), dim(s, d).where("gene < 'Brand#3'")))
query("dedupe_last", "SELECT * FROM am", AM)(am)
query("last_known", "SELECT symbol AS gene, exome_af FROM gnomad_like WHERE exome_af IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ord DESC) = 1", tables=("gnomad_like",))(lambda s, d: dedupe.last_known(adapter(s, d, "gnomad_like").withColumnRenamed("symbol", "gene"), ["gene"], "ord", "exome_af"))

# Nested payloads and frequencies

query("flatten_gnomad", "SELECT symbol, variant_id, hgvs_c, hgvs_p, consequence, gnomad_af, gnomad_an, gnomad_homozygotes, part, place FROM g_flat", GNOMAD)(lambda s, d: gnomad_flat(s, d).withColumn("part", F.col("ord.payload")).drop("ord"))
query("preferred_af", "SELECT ord, gnomad_af, coalesce(exome_af, genome_af) AS plain_af FROM g_flat JOIN gnomad_like USING (ord)", GNOMAD)(lambda s, d: adapter(s, d, "gnomad_like").select("ord", x.preferred(F.col("exome_af"), F.col("genome_af")).alias("gnomad_af"), x.preferred(F.col("exome_af"), F.col("genome_af"), zero_is_missing=False).alias("plain_af")))
query("homozygotes", "SELECT ord, gnomad_homozygotes FROM g_flat", GNOMAD)(lambda s, d: adapter(s, d, "gnomad_like").select("ord", x.homozygotes(F.col("exome_hom"), F.col("genome_hom")).cast("long").alias("gnomad_homozygotes")))
query("require_protein_change", "SELECT variant_id, symbol, hgvs_p FROM g_flat WHERE hgvs_p <> ''", GNOMAD)(lambda s, d: filters.require_protein_change(gnomad_flat(s, d)).select("variant_id", "symbol", "hgvs_p"))
query("protein_change_counts", "SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE hgvs_p <> '') AS BIGINT) AS loaded, CAST(count(*) FILTER (WHERE coalesce(hgvs_p, '') = '') AS BIGINT) AS skipped FROM g_flat", GNOMAD)(lambda s, d: stats.protein_change_counts(gnomad_flat(s, d)))


@query("gnomad_by_variant_id", "SELECT e.event_id, 'asked' AS side, CAST(e.user_id % 22 + 1 AS VARCHAR) || '-' || CAST(e.event_id AS VARCHAR) || '-A-' || CASE WHEN value > 50 THEN 'C' ELSE 'G' END AS variant_id, g.gnomad_af FROM events e LEFT JOIN g_flat g ON g.variant_id = CAST(e.user_id % 22 + 1 AS VARCHAR) || '-' || CAST(e.event_id AS VARCHAR) || '-A-' || CASE WHEN value > 50 THEN 'C' ELSE 'G' END", GNOMAD)
def _(s, d):
    asked = s.read.parquet(f"{d}/events.parquet").select("event_id", F.lit("asked").alias("side"), F.concat(F.lit("chr"), (F.col("user_id") % 22 + 1).cast("string")).alias("chromosome"), F.col("event_id").alias("position"), F.lit("A").alias("ref"), F.when(F.col("value") > 50, "C").otherwise("G").alias("alt"))
    return joins.gnomad_by_variant_id(asked, gnomad_flat(s, d).select("variant_id", "gnomad_af")).select("event_id", "side", "variant_id", "gnomad_af")


# Merges

SMALL = "gene, hgvs_p, hgvs_c, gnomad_af, clinvar_id"
query("build_features", "SELECT * FROM features", FEATURES)(features)
query("merge_overwrite", """SELECT coalesce(c.gene, g.gene) AS gene, coalesce(c.hgvs_p, g.hgvs_p) AS hgvs_p, CASE WHEN g.gene IS NOT NULL THEN g.hgvs_c ELSE c.hgvs_c END AS hgvs_c, clinvar_id, gnomad_af
  FROM clinvar c FULL JOIN gnomad g ON c.gene = g.gene AND c.hgvs_p = g.hgvs_p""", CLINVAR, GNOMAD)(lambda s, d: merge.merge_overwrite(clinvar(s, d).select("gene", "hgvs_p", "hgvs_c", "clinvar_id"), gnomad(s, d).select("gene", "hgvs_p", "hgvs_c", "gnomad_af")))
query("merge_coalesce", """SELECT coalesce(c.gene, u.gene) AS gene, coalesce(c.hgvs_p, u.hgvs_p) AS hgvs_p, coalesce(u.revel_score, c.revel_score) AS revel_score, c.clinvar_id, u.alphamissense_score
  FROM scored c FULL JOIN subs u ON c.gene = u.gene AND c.hgvs_p = u.hgvs_p""", FEATURES)(lambda s, d: merge.merge_coalesce(scored(s, d).select("gene", "hgvs_p", "revel_score", "clinvar_id"), substitutions(s, d).select("gene", "hgvs_p", "revel_score", "alphamissense_score"), ["revel_score"]))
query("scored_clinvar", "SELECT ord, chromosome, position, ref, alt, revel_score, cadd_raw, cadd_phred FROM scored", FEATURES)(lambda s, d: scored(s, d).select("ord", "chromosome", "position", "ref", "alt", "revel_score", "cadd_raw", "cadd_phred"))

LOF_TARGET = """lof_t AS (SELECT gene, hgvs_c, lof_type, truncation, hgvs_p FROM lof_typed WHERE ord % 2 = 0 AND lof_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gene, hgvs_c ORDER BY ord) = 1),
  lof_s AS (SELECT gene, hgvs_c, lof_type, consequence FROM lof_typed WHERE ord % 2 = 1 AND lof_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gene, hgvs_c ORDER BY ord DESC) = 1)"""


def lof_typed(s, d):
    rows = lof_rows(s, d)
    return rows.withColumn("lof_type", x.classify_lof_type(F.col("hgvs_p"), F.col("consequence"))).withColumn("truncation", x.truncation_position(F.col("aa_position"), F.col("protein_length")))


@query("merge_lof", "SELECT coalesce(t.gene, s.gene) AS gene, coalesce(t.hgvs_c, s.hgvs_c) AS hgvs_c, CASE WHEN s.gene IS NOT NULL THEN s.lof_type ELSE t.lof_type END AS lof_type, truncation, hgvs_p, consequence FROM lof_t t FULL JOIN lof_s s ON t.gene = s.gene AND t.hgvs_c = s.hgvs_c", LOF, LOF_TARGET)
def _(s, d):
    rows = lof_typed(s, d).where("lof_type IS NOT NULL")
    target = dedupe.dedupe_first(rows.where("ord % 2 = 0").select("gene", "hgvs_c", "lof_type", "truncation", "hgvs_p", "ord"), ["gene", "hgvs_c"], "ord").drop("ord")
    source = dedupe.dedupe_last(rows.where("ord % 2 = 1").select("gene", "hgvs_c", "lof_type", "consequence", "ord"), ["gene", "hgvs_c"], "ord").drop("ord")
    return merge.merge_lof(target, source)


@query("merge_genes", "SELECT coalesce(a.symbol, b.symbol) AS symbol, CASE WHEN b.symbol IS NOT NULL THEN b.pli ELSE a.pli END AS pli, a.loeuf, b.n_rows FROM (SELECT * FROM genes_like WHERE symbol < 'Brand#3') a FULL JOIN (SELECT symbol, max(genome_af) AS pli, CAST(count(*) AS BIGINT) AS n_rows FROM gnomad_like WHERE symbol > 'Brand#2' GROUP BY symbol) b ON a.symbol = b.symbol", tables=("genes_like", "gnomad_like"))
def _(s, d):
    source = adapter(s, d, "gnomad_like").where("symbol > 'Brand#2'").groupBy("symbol").agg(F.max("genome_af").alias("pli"), F.count("*").alias("n_rows"))
    return merge.merge_genes(adapter(s, d, "genes_like").where("symbol < 'Brand#3'"), source)


PEN = """pen_t AS (SELECT variant_type, variant_id, gene, hgvs_p, penetrance_mean FROM penetrance_like WHERE penetrance_mean < 0.5 QUALIFY row_number() OVER (PARTITION BY variant_type, variant_id ORDER BY ord) = 1),
  pen_s AS (SELECT variant_type, variant_id, gene, hgvs_p, penetrance_mean FROM penetrance_like WHERE penetrance_mean >= 0.25 QUALIFY row_number() OVER (PARTITION BY variant_type, variant_id ORDER BY ord DESC) = 1),
  pen AS (SELECT coalesce(t.variant_type, s.variant_type) AS variant_type, coalesce(t.variant_id, s.variant_id) AS variant_id, CASE WHEN t.variant_id IS NOT NULL THEN t.gene ELSE s.gene END AS gene,
  CASE WHEN t.variant_id IS NOT NULL THEN t.hgvs_p ELSE s.hgvs_p END AS hgvs_p, CASE WHEN s.variant_id IS NOT NULL THEN s.penetrance_mean ELSE t.penetrance_mean END AS penetrance_mean
  FROM pen_t t FULL JOIN pen_s s ON t.variant_type = s.variant_type AND t.variant_id = s.variant_id)"""
IN[PEN] = ("penetrance_like",)


def penetrance(s, d):
    rows = adapter(s, d, "penetrance_like")
    keys = ["variant_type", "variant_id"]
    return merge.merge_penetrance(dedupe.dedupe_first(rows.where("penetrance_mean < 0.5"), keys, "ord").drop("ord"), dedupe.dedupe_last(rows.where("penetrance_mean >= 0.25"), keys, "ord").drop("ord"))


query("merge_penetrance", "SELECT * FROM pen", PEN)(penetrance)

# Scores by transcript, coordinates and substitution

TRANSCRIPTS = """wanted AS (SELECT 'Brand#' || CAST(n_nationkey + 1 AS VARCHAR) AS gene, 'ENST' || CAST((n_nationkey * 2 + 1) % 50 AS VARCHAR) AS t1, 'ENST' || CAST(n_nationkey AS VARCHAR) AS t2 FROM nation)"""


def transcripts(s, d):
    n = s.read.parquet(f"{d}/nation.parquet")
    k = F.col("n_nationkey")
    name = lambda c: F.concat(F.lit("ENST"), c.cast("string"))
    return n.select(F.concat(F.lit("Brand#"), (k + 1).cast("string")).alias("gene"), F.array(name((k * 2 + 1) % 50), name(k)).alias("transcript_ids"))


@query("revel_for_genes", """SELECT gene, ord, revel_score, CASE WHEN h1 AND h2 AND t1 <> t2 THEN t1 || ';' || t2 WHEN h1 THEN t1 ELSE t2 END AS matched FROM (SELECT gene, ord, revel_score, t1, t2,
  list_contains(string_split(Ensembl_transcriptid, ';'), t1) AS h1, list_contains(string_split(Ensembl_transcriptid, ';'), t2) AS h2 FROM revel, wanted) WHERE h1 OR h2""", REVEL, TRANSCRIPTS)
def _(s, d):
    return joins.revel_for_genes(revel(s, d), transcripts(s, d)).select("gene", "ord", "revel_score", F.array_join(F.array_distinct("matched_transcripts"), ";").alias("matched"))


@query("match_transcripts", "SELECT ord, CASE WHEN h1 AND h2 THEN 'ENST7;ENST3' WHEN h1 THEN 'ENST7' ELSE 'ENST3' END AS matched FROM (SELECT ord, list_contains(string_split(Ensembl_transcriptid, ';'), 'ENST7') AS h1, list_contains(string_split(Ensembl_transcriptid, ';'), 'ENST3') AS h2 FROM revel) WHERE h1 OR h2", REVEL)
def _(s, d):
    hit = nested.match_transcripts(F.array(F.lit("ENST7"), F.lit("ENST3")), F.col("Ensembl_transcriptid"))
    return revel(s, d).select("ord", F.array_join(hit, ";").alias("matched")).where("matched IS NOT NULL")


for build, position in (("GRCh38", "grch38_pos"), ("GRCh37", "hg19_pos")):
    @query(f"revel_by_coordinates_{build.lower()}", f"""SELECT c.ord, c.chromosome, CAST(c.position AS VARCHAR) AS position, r.revel_score FROM clinvar c LEFT JOIN (SELECT chr, {position} AS pos, ref, alt, TRY_CAST(REVEL AS DOUBLE) AS revel_score FROM revel_like
      QUALIFY row_number() OVER (PARTITION BY chr, {position}, ref, alt ORDER BY ord) = 1) r ON c.chromosome = r.chr AND CAST(c.position AS VARCHAR) = r.pos AND c.ref = r.ref AND c.alt = r.alt""", CLINVAR, tables=("revel_like",))
    def _(s, d, build=build):
        return joins.revel_by_coordinates(clinvar(s, d), adapter(s, d, "revel_like"), build).select("ord", "chromosome", "position", "revel_score")


query("first_seen_last_value", "SELECT * FROM d3", REVEL, FIRST_LAST)(lambda s, d: dedupe.first_seen_last_value(revel(s, d), ["aaref", "aaalt"], "grch38_pos", "ord", "revel_score"))
query("revel_by_substitution", "SELECT a.ord, a.uniprot_id, a.hgvs_p, d3.revel_score FROM am_all a LEFT JOIN d3 USING (aaref, aaalt)", AM, REVEL, FIRST_LAST)(lambda s, d: joins.revel_by_substitution(am_all(s, d), revel(s, d)).select("ord", "uniprot_id", "hgvs_p", "revel_score"))
POSITIONS = """SELECT aaref, aaalt, chromosome, chunk, string_agg(grch38_pos || ':' || ref || ':' || alt, ';' ORDER BY ord) AS positions FROM (SELECT *, (row_number() OVER (PARTITION BY aaref, aaalt, chromosome ORDER BY ord) - 1) // 5 AS chunk FROM revel) GROUP BY aaref, aaalt, chromosome, chunk"""
query("positions_by_substitution", POSITIONS, REVEL)(lambda s, d: nested.positions_by_substitution(revel(s, d), ["aaref", "aaalt", "chromosome"], "ord", ["grch38_pos", "ref", "alt"], chunk=5).select("aaref", "aaalt", "chromosome", "chunk", F.array_join(F.transform("positions", lambda p: F.concat_ws(":", p["grch38_pos"], p["ref"], p["alt"])), ";").alias("positions")))
query("dense_order", "SELECT ord, gene, row_number() OVER (ORDER BY gene, ord) - 1 AS ordinal, row_number() OVER (PARTITION BY assembly, chromosome ORDER BY ord) - 1 AS in_chromosome FROM parsed", PARSED)(lambda s, d: dense_order(dense_order(parsed(s, d).select("ord", "gene", "assembly", "chromosome"), ["gene", "ord"]), ["ord"], ["assembly", "chromosome"], "in_chromosome").drop("assembly", "chromosome"))
query("source_coverage", "SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(cadd_phred) AS BIGINT) AS matched, count(cadd_phred) * 100.0::DOUBLE / count(*) AS percent FROM scored", FEATURES)(lambda s, d: stats.source_coverage(scored(s, d), "cadd_phred"))

CADD_KEYS = """asked AS (SELECT ord AS id, gene, chromosome, position, CASE WHEN ord % 3 = 0 THEN NULL WHEN ord % 3 = 1 THEN '' ELSE ref END AS ref, CASE WHEN ord % 2 = 0 THEN NULL ELSE alt END AS alt FROM clinvar)"""
CADD_HIT = """hit AS (SELECT a.id, c.Chrom, c.Pos, c.Ref AS cref, c.Alt AS calt, c.RawScore, c.PHRED FROM asked a JOIN cadd_like c ON a.chromosome = c.Chrom AND a.position = c.Pos AND (coalesce(a.ref, '') = '' OR a.ref = c.Ref) AND (coalesce(a.alt, '') = '' OR a.alt = c.Alt)
  QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY c.ord) = 1)"""


def cadd_asked(s, d):
    return clinvar(s, d).select(F.col("ord").alias("id"), "gene", "chromosome", "position", F.expr("CASE WHEN ord % 3 = 0 THEN NULL WHEN ord % 3 = 1 THEN '' ELSE ref END AS ref"), F.expr("CASE WHEN ord % 2 = 0 THEN NULL ELSE alt END AS alt"))


OUT = "a.id, a.gene, coalesce(h.Chrom, a.chromosome) AS chromosome, coalesce(h.Pos, a.position) AS position, CASE WHEN h.id IS NOT NULL THEN h.cref ELSE a.ref END AS ref, CASE WHEN h.id IS NOT NULL THEN h.calt ELSE a.alt END AS alt, h.RawScore AS cadd_raw, h.PHRED AS cadd_phred"
query("annotate_cadd", f"SELECT {OUT} FROM asked a LEFT JOIN hit h ON a.id = h.id", CLINVAR, CADD_KEYS, CADD_HIT, tables=("cadd_like",))(lambda s, d: joins.annotate_cadd(cadd_asked(s, d), adapter(s, d, "cadd_like"), "id"))
query("cadd_for_gene_variants", f"SELECT {OUT} FROM asked a LEFT JOIN hit h ON a.id = h.id WHERE a.gene < 'Brand#2' AND a.chromosome IS NOT NULL AND a.position IS NOT NULL", CLINVAR, CADD_KEYS, CADD_HIT, tables=("cadd_like",))(lambda s, d: joins.cadd_for_gene_variants(cadd_asked(s, d), adapter(s, d, "genes_like").where("symbol < 'Brand#2'").select(F.col("symbol").alias("gene")), adapter(s, d, "cadd_like"), "id"))
query("require_coordinates", "SELECT ord, chromosome, position FROM clinvar WHERE chromosome IS NOT NULL AND position IS NOT NULL", CLINVAR)(lambda s, d: filters.require_coordinates(clinvar(s, d)).select("ord", "chromosome", "position"))


@query("zip_header_rows", "SELECT Chrom AS chromosome, CAST(Pos AS BIGINT) AS Pos, Ref, Alt, PHRED, 0.0::DOUBLE AS RawScore FROM cadd_like", tables=("cadd_like",))
def _(s, d):
    from annomerge.sources.readers import cadd_from_payload

    rows = adapter(s, d, "cadd_like").select(F.array("Chrom", F.col("Pos").cast("string"), "Ref", "Alt", F.col("PHRED").cast("string")).alias("r"), F.floor(F.col("ord") / 50).alias("part"))
    head = F.array(*[F.lit(c) for c in ("Chrom", "Pos", "Ref", "Alt", "PHRED")])
    texts = rows.groupBy("part").agg(F.to_json(F.concat(F.array(head), F.collect_list("r"))).alias("payload"))
    return cadd_from_payload(texts, "payload").select(F.col("Chrom").alias("chromosome"), "Pos", "Ref", "Alt", "PHRED", "RawScore")


# Reports and lookups over the feature table

RANK = "row_number() OVER (PARTITION BY gene ORDER BY hgvs_p)"


def placed(rows, order: str | None = None):
    """Rows with their place in their gene, by the order that they stand in or that a reader noted."""
    out = rows if order else rows.withColumn("_stands", F.monotonically_increasing_id())
    return out.withColumn("place", F.row_number().over(Window.partitionBy("gene").orderBy(order or "_stands")).cast("long"))


query("coverage_by_gene", "SELECT gene, CAST(count(*) AS BIGINT) AS total, CAST(count(clinvar_id) AS BIGINT) AS with_clinvar, CAST(count(alphamissense_score) AS BIGINT) AS with_alphamissense, CAST(count(gnomad_af) AS BIGINT) AS with_gnomad, CAST(count(revel_score) AS BIGINT) AS with_revel FROM features GROUP BY gene", FEATURES)(lambda s, d: stats.coverage_by_gene(features(s, d)))
query("verify_gene_totals", "SELECT gene, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE clinvar_id <> 0) AS BIGINT) AS with_clinvar, CAST(count(gnomad_af) AS BIGINT) AS with_frequency FROM features GROUP BY gene", FEATURES)(lambda s, d: stats.verify_gene_totals(features(s, d)))
query("load_counts", """, wanted_genes AS (SELECT DISTINCT 'Brand#' || CAST(n_nationkey + 11 AS VARCHAR) AS gene FROM nation), per AS (SELECT w.gene, CAST(count(c.gene) AS BIGINT) AS n_rows FROM wanted_genes w LEFT JOIN clinvar c ON w.gene = c.gene GROUP BY w.gene)
  SELECT gene, n_rows FROM per UNION ALL SELECT NULL, CAST(sum(n_rows) AS BIGINT) FROM per""", CLINVAR)(lambda s, d: stats.load_counts(s.read.parquet(f"{d}/nation.parquet").select(F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 11).cast("string")).alias("gene")), clinvar(s, d)))
query("variants_for_gene", f"SELECT upper(gene) AS gene, hgvs_p, hgvs_c, gnomad_af, clinvar_id, CAST({RANK} AS BIGINT) AS place FROM features WHERE upper(gene) = 'BRAND#7'", FEATURES)(lambda s, d: placed(filters.variants_for_gene(features(s, d).withColumn("gene", F.upper("gene")), "Brand#7")).select(*SMALL.split(", "), "place"))
query("lookup_variants", "SELECT k.gene, k.hgvs_p, f.gnomad_af, f.clinvar_id FROM (SELECT DISTINCT gene, hgvs_p FROM lof_like WHERE hgvs_p IS NOT NULL) k LEFT JOIN features f ON k.gene = f.gene AND k.hgvs_p = f.hgvs_p", FEATURES, tables=("lof_like",))(lambda s, d: filters.lookup_variants(lof_rows(s, d).where("hgvs_p IS NOT NULL").select("gene", "hgvs_p").distinct(), features(s, d), ["gene", "hgvs_p"]).select("gene", "hgvs_p", "gnomad_af", "clinvar_id"))
query("find_substitution", "SELECT ord, uniprot_id, hgvs_p FROM am_all WHERE aa_position = 21 AND aaalt = 'V'", AM)(lambda s, d: filters.find_substitution(am_all(s, d).withColumnsRenamed({"aa_position": "position", "aaalt": "alt_aa"}), 21, "V").select("ord", "uniprot_id", "hgvs_p"))
query("has_annotation", f"SELECT {SMALL} FROM features WHERE gnomad_af IS NOT NULL AND clinvar_id IS NOT NULL", FEATURES)(lambda s, d: filters.has_annotation(features(s, d), "gnomad_af", "clinvar_id").select(*SMALL.split(", ")))
query("sort_features", f"SELECT {SMALL}, CAST({RANK} AS BIGINT) AS place FROM features", FEATURES)(lambda s, d: placed(filters.sort_features(features(s, d))).select(*SMALL.split(", "), "place"))
query("top_rows_report", f"SELECT {SMALL}, CAST(greatest(count(*) OVER (PARTITION BY gene) - 50, 0) AS BIGINT) AS n_more FROM features QUALIFY row_number() OVER (PARTITION BY gene ORDER BY hgvs_p) <= 50", FEATURES)(lambda s, d: dedupe.top_rows(features(s, d), "gene", ["hgvs_p"]).select(*SMALL.split(", "), F.col("n_more").cast("long").alias("n_more")))
query("sample_rows", "SELECT part, symbol, place, hgvs_p FROM g_flat WHERE hgvs_p <> '' ORDER BY part, symbol, place LIMIT 15", GNOMAD)(lambda s, d: dedupe.sample_rows(filters.require_protein_change(gnomad_flat(s, d)).select(F.struct("ord.payload", "symbol", "place").alias("o"), "hgvs_p"), "o", 15).select(F.col("o.payload").alias("part"), "o.symbol", "o.place", "hgvs_p"))
query("display_row", """SELECT gene, coalesce(substr(hgvs_p, 1, 19), 'N/A') AS hgvs_p, CASE WHEN alphamissense_score <> 0 THEN printf('%.3f', alphamissense_score) ELSE 'N/A' END AS alphamissense,
  CASE WHEN gnomad_af <> 0 THEN printf('%.2e', gnomad_af) ELSE 'N/A' END AS af, coalesce(substr(clinvar_significance, 1, 19), 'N/A') AS clinvar FROM features""", FEATURES)(lambda s, d: filters.display_rows(features(s, d)))


@query("nearby_variants", """, q AS (SELECT s_suppkey AS id, 'Brand#' || CAST(s_suppkey % 25 + 1 AS VARCHAR) AS gene, CAST(s_suppkey % 60 + 1 AS INT) AS p FROM supplier), v AS (SELECT uniprot_id AS gene, aa_position AS position, hgvs_p, ord FROM am_all)
  SELECT q.id, v.gene, v.position, v.hgvs_p, v.ord FROM q JOIN v ON q.gene = v.gene AND abs(v.position - q.p) <= 5 QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY v.ord) <= 10""", AM)
def _(s, d):
    k = F.col("s_suppkey")
    asked = s.read.parquet(f"{d}/supplier.parquet").select(k.alias("id"), F.concat(F.lit("Brand#"), (k % 25 + 1).cast("string")).alias("gene"), (k % 60 + 1).cast("int").alias("position"))
    rows = am_all(s, d).select(F.col("uniprot_id").alias("gene"), F.col("aa_position").alias("position"), "hgvs_p", "ord")
    return joins.nearby_variants(asked, rows, "id").select("id", "gene", "position", "hgvs_p", "ord")


# Loss of function

ANNOTATED = """annotated AS (SELECT ord, gene, hgvs_c, hgvs_p, lof_type, nullif(lof, '') AS loftee_confidence, lof_flags, truncation, CASE WHEN coalesce(last_exon, false) THEN true ELSE truncation > 0.90 END AS nmd_escape, position FROM lof_typed WHERE lof_type IS NOT NULL)"""


def annotated(s, d):
    return lof.annotate_lof(lof_rows(s, d)).withColumnRenamed("truncation_position", "truncation")


query("classify_lof_type", "SELECT ord, lof_type FROM lof_typed", LOF)(lambda s, d: lof_typed(s, d).select("ord", "lof_type"))
query("truncation_position", "SELECT ord, truncation FROM lof_typed", LOF)(lambda s, d: lof_typed(s, d).select("ord", "truncation"))
query("predict_nmd_escape", "SELECT ord, nmd_escape FROM annotated", LOF, ANNOTATED)(lambda s, d: annotated(s, d).select("ord", "nmd_escape"))
query("annotate_lof", "SELECT ord, gene, hgvs_c, lof_type, loftee_confidence, lof_flags AS loftee_flags, truncation, nmd_escape FROM annotated", LOF, ANNOTATED)(lambda s, d: annotated(s, d).select("ord", "gene", "hgvs_c", "lof_type", "loftee_confidence", F.array_join("loftee_flags", ",").alias("loftee_flags"), "truncation", "nmd_escape"))
query("route_variants", "SELECT 'missense' AS routed, ord FROM lof_typed WHERE hgvs_p <> '' UNION ALL SELECT 'lof', ord FROM lof_typed WHERE lof_type IS NOT NULL", LOF)(lambda s, d: (lambda m, n: m.select(F.lit("missense").alias("routed"), "ord").unionByName(n.select(F.lit("lof").alias("routed"), "ord")))(*lof.route_variants(lof_typed(s, d))))
query("attach_gene_constraint", "SELECT a.ord, a.gene, g.pli AS gene_pli, g.loeuf AS gene_loeuf FROM annotated a LEFT JOIN genes_like g ON a.gene = g.symbol", LOF, ANNOTATED, tables=("genes_like",))(lambda s, d: lof.annotate_lof(lof_rows(s, d), adapter(s, d, "genes_like")).select("ord", "gene", "gene_pli", "gene_loeuf"))
query("lof_counts_by_gene", "SELECT gene, CAST(count(*) AS BIGINT) AS total FROM annotated GROUP BY gene", LOF, ANNOTATED)(lambda s, d: stats.lof_counts_by_gene(annotated(s, d)))
query("all_variants", "SELECT gene, hgvs_p, hgvs_c, clinvar_id, CAST(NULL AS VARCHAR) AS lof_type, 'missense' AS variant_type FROM clinvar UNION ALL SELECT gene, hgvs_p, hgvs_c, NULL, lof_type, 'lof' FROM annotated", CLINVAR, LOF, ANNOTATED)(lambda s, d: filters.all_variants(clinvar(s, d).select("gene", "hgvs_p", "hgvs_c", "clinvar_id"), annotated(s, d).select("gene", "hgvs_p", "hgvs_c", "lof_type")))
query("variants_by_type", "SELECT variant_type, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT 'missense' AS variant_type FROM clinvar WHERE upper(gene) = 'BRAND#3' UNION ALL SELECT 'lof' FROM annotated WHERE upper(gene) = 'BRAND#3') GROUP BY variant_type", CLINVAR, LOF, ANNOTATED)(lambda s, d: (lambda b: filters.all_variants(b["missense"], b["lof"]).groupBy("variant_type").agg(F.count("*").alias("n_rows")))(filters.variants_by_type(clinvar(s, d).withColumn("gene", F.upper("gene")), annotated(s, d).withColumn("gene", F.upper("gene")), "brand#3")))
query("attach_penetrance", "SELECT v.variant_type, v.variant_id, v.ord, p.penetrance_mean FROM (SELECT 'lof' AS variant_type, ord % 70 AS variant_id, ord FROM annotated) v LEFT JOIN pen p USING (variant_type, variant_id)", LOF, ANNOTATED, PEN)(lambda s, d: joins.attach_penetrance(annotated(s, d).select(F.lit("lof").alias("variant_type"), (F.col("ord") % 70).alias("variant_id"), "ord"), penetrance(s, d)).select("variant_type", "variant_id", "ord", "penetrance_mean"))
query("orphan_penetrance", "SELECT variant_type, variant_id, penetrance_mean FROM pen WHERE (variant_type, variant_id) NOT IN (SELECT 'lof', ord % 70 FROM annotated)", LOF, ANNOTATED, PEN)(lambda s, d: joins.orphan_penetrance(penetrance(s, d), annotated(s, d).select(F.lit("lof").alias("variant_type"), (F.col("ord") % 70).alias("variant_id"))).select("variant_type", "variant_id", "penetrance_mean"))

# Checks

ASIDE = """judged AS (SELECT p.*, CASE WHEN gene IS NULL THEN 'gene is null' END AS broken FROM parsed p),
  clashes AS (SELECT ord, CASE WHEN hgvs_p IS NOT NULL AND ord > min(ord) OVER (PARTITION BY gene, hgvs_p) THEN 'repeated gene, hgvs_p' END AS by_change,
  CASE WHEN chromosome IS NOT NULL AND position IS NOT NULL AND ref IS NOT NULL AND alt IS NOT NULL AND ord > min(ord) OVER (PARTITION BY chromosome, position, ref, alt, assembly) THEN 'repeated chromosome, position, ref, alt, genome_build' END AS by_place FROM judged WHERE broken IS NULL),
  told AS (SELECT j.ord, concat_ws(';', broken, by_place, by_change) AS violations FROM judged j LEFT JOIN clashes c USING (ord))"""


def checked_rows(s, d):
    return parsed(s, d).withColumn("gene", F.when(F.col("ord") % 10 != 0, F.col("gene"))).withColumnRenamed("assembly", "genome_build").select("ord", "gene", "hgvs_p", "chromosome", "position", "ref", "alt", "genome_build")


@query("split_checked", "SELECT ord, violations FROM told", PARSED.replace("SELECT ord, gene_symbol AS gene", "SELECT ord, CASE WHEN ord % 10 <> 0 THEN gene_symbol END AS gene"), ASIDE, tables=("clinvar_like",))
def _(s, d):
    accepted, aside = quality.split_checked(checked_rows(s, d), "variants_missense")
    return accepted.select("ord", F.lit("").alias("violations")).unionByName(aside.select("ord", F.array_join("violations", ";").alias("violations")))


query("repeated_keys", """SELECT rule, key, CAST(n_rows AS BIGINT) AS n_rows, first_ord FROM (SELECT 'gene, hgvs_p' AS rule, gene || '|' || hgvs_p AS key, count(*) AS n_rows, min(ord) AS first_ord FROM parsed WHERE gene IS NOT NULL AND hgvs_p IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'chromosome, position, ref, alt, genome_build', chromosome || '|' || position || '|' || ref || '|' || alt || '|' || assembly, count(*), min(ord) FROM parsed WHERE chromosome || position || ref || alt || assembly IS NOT NULL GROUP BY ALL) WHERE n_rows > 1""", PARSED)(lambda s, d: quality.repeated_keys(parsed(s, d).withColumnRenamed("assembly", "genome_build"), "variants_missense").withColumn("key", F.array_join("key", "|")))

query("duplicate_keys", "SELECT gene, hgvs_p, CAST(count(*) AS BIGINT) AS n_rows FROM parsed WHERE gene IS NOT NULL AND hgvs_p IS NOT NULL GROUP BY gene, hgvs_p HAVING count(*) > 1", PARSED)(lambda s, d: quality.duplicate_keys(parsed(s, d), ["gene", "hgvs_p"]))
query("duplicate_coordinates", "SELECT chromosome, position, ref, alt, CAST(count(*) AS BIGINT) AS n_rows FROM clinvar WHERE chromosome IS NOT NULL AND position IS NOT NULL AND ref IS NOT NULL AND alt IS NOT NULL GROUP BY ALL HAVING count(*) > 1", CLINVAR)(lambda s, d: quality.duplicate_keys(clinvar(s, d).withColumn("genome_build", F.lit("GRCh38")), quality.COORDINATES).drop("genome_build"))
query("constraint_violations", "SELECT variant_type, variant_id, ord, 'variant_type not allowed' AS violation FROM penetrance_like WHERE variant_type NOT IN ('missense', 'lof')", tables=("penetrance_like",))(lambda s, d: quality.constraint_violations(adapter(s, d, "penetrance_like"), "penetrance_estimates").select("variant_type", "variant_id", "ord", "violation"))

# Sources and sinks, written and read back in the folder that the cluster shares


@query("read_alphamissense", "SELECT uniprot_id, protein_variant, am_pathogenicity, am_class FROM am_like", tables=("am_like",))
def _(s, d):
    from annomerge.sources.readers import read_alphamissense

    path = fresh_path(s, "am")
    adapter(s, d, "am_like").drop("ord").write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return read_alphamissense(s, path)


def block_file(s, rows, head, name):
    """Rows of text columns as block-gzip files in row order; the folder."""
    from annomerge.sources.blocks import write_blocks

    path = fresh_path(s, name)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns if c != "ord"]
    write_blocks(rows.orderBy("ord").select(F.concat_ws("\t", *fields).alias("line")), path, head=head).agg(F.sum("n_lines")).collect()
    return path


@query("read_alphamissense_blocks", "SELECT gene, hgvs_p, alphamissense_score, alphamissense_class FROM am", AM)
def _(s, d):
    from annomerge.sources.readers import read_alphamissense

    path = block_file(s, adapter(s, d, "am_like"), ("# notes", "uniprot_id\tprotein_variant\tam_pathogenicity\tam_class"), "am-blocks")
    return jobs.load_alphamissense(read_alphamissense(s, path, order=True, split_bytes=32 << 10), dim(s, d)).drop("ord")


@query("read_clinvar_blocks", f"SELECT {COLUMNS.replace('ord, ', '').replace('type, assembly, ', '')} FROM clinvar", CLINVAR)
def _(s, d):
    from annomerge.sources.readers import read_clinvar
    from annomerge.sources.schemas import SUMMARY_COLUMNS

    rows = adapter(s, d, "clinvar_like")
    cells = [F.col(SUMMARY_COLUMNS[i]) if SUMMARY_COLUMNS.get(i) in rows.columns else F.lit("x") for i in range(34)]
    path = block_file(s, rows.select("ord", *[c.alias(f"h{i}") for i, c in enumerate(cells)]), ("#" + "\t".join(f"h{i}" for i in range(34)),), "summary-blocks")
    return jobs.load_clinvar(read_clinvar(s, path, order=True, split_bytes=32 << 10)).drop("ord")


@query("read_cadd_blocks", "SELECT a.ord, h.RawScore AS cadd_raw, h.PHRED AS cadd_phred FROM clinvar a LEFT JOIN cadd_hit h ON a.ord = h.id", FEATURES)
def _(s, d):
    from annomerge.sources.readers import read_cadd

    path = block_file(s, adapter(s, d, "cadd_like"), ("## notes", "#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED"), "cadd-blocks")
    return joins.annotate_cadd(clinvar(s, d), read_cadd(s, path, order=True, split_bytes=4 << 10), "ord").select("ord", "cadd_raw", "cadd_phred")


@query("read_clinvar", "SELECT type, name, gene_symbol, clinical_sig, last_evaluated, assembly, chromosome, review_status, variation_id, pos_vcf, ref_vcf, alt_vcf FROM clinvar_like", tables=("clinvar_like",))
def _(s, d):
    from annomerge.sources.readers import read_clinvar
    from annomerge.sources.schemas import SUMMARY_COLUMNS

    path, rows = fresh_path(s, "summary"), adapter(s, d, "clinvar_like")
    named = lambda i: SUMMARY_COLUMNS.get(i) if SUMMARY_COLUMNS.get(i) in rows.columns else None
    rows.select(*[(F.col(named(i)) if named(i) else F.lit("x")).alias(f"h{i}") for i in range(34)]).write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return read_clinvar(s, path).drop("allele_id", "start")


@query("read_revel", "SELECT chr, hg19_pos, grch38_pos, ref, alt, aaref, aaalt, REVEL, Ensembl_transcriptid FROM revel_like", tables=("revel_like",))
def _(s, d):
    from annomerge.sources.readers import read_revel

    path = fresh_path(s, "revel")
    adapter(s, d, "revel_like").drop("ord").write.option("header", True).csv(path)
    return read_revel(s, path)


@query("read_gnomad", "SELECT symbol, variant_id, hgvsc AS hgvs_c, hgvsp AS hgvs_p, genome_af FROM gnomad_like", tables=("gnomad_like",))
def _(s, d):
    from annomerge.sources.readers import read_gnomad

    path = fresh_path(s, "gnomad")
    payloads(s, d).select("data").write.json(path)
    v = read_gnomad(s, path).select(F.col("data.gene.symbol").alias("symbol"), F.explode("data.gene.variants").alias("v"))
    return v.select("symbol", "v.variant_id", F.col("v.hgvsc").alias("hgvs_c"), F.col("v.hgvsp").alias("hgvs_p"), F.col("v.genome.af").alias("genome_af"))


@query("read_cadd", "SELECT Chrom, CAST(Pos AS BIGINT) AS Pos, Ref, Alt, RawScore, PHRED FROM cadd_like", tables=("cadd_like",))
def _(s, d):
    from annomerge.sources.readers import read_cadd

    path = fresh_path(s, "cadd")
    rows = adapter(s, d, "cadd_like").select(F.concat_ws("\t", "Chrom", "Pos", "Ref", "Alt", "RawScore", "PHRED").alias("line"))
    rows.unionByName(rows.limit(1).select(F.lit("#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED").alias("line"))).write.text(path)
    return read_cadd(s, path)


@query("revel_by_coordinates_pruned", """SELECT c.ord, c.chromosome, CAST(c.position AS VARCHAR) AS position, r.revel_score FROM clinvar c LEFT JOIN (SELECT chr, grch38_pos AS pos, ref, alt, TRY_CAST(REVEL AS DOUBLE) AS revel_score FROM revel_like
  QUALIFY row_number() OVER (PARTITION BY chr, grch38_pos, ref, alt ORDER BY ord) = 1) r ON c.chromosome = r.chr AND CAST(c.position AS VARCHAR) = r.pos AND c.ref = r.ref AND c.alt = r.alt""", CLINVAR, tables=("revel_like",))
def _(s, d):
    from annomerge.sources.layout import read_at_places, write_by_coordinates

    path, asked = fresh_path(s, "revel-places"), materialise(clinvar(s, d), "asked")
    write_by_coordinates(adapter(s, d, "revel_like"), path, "chr", "grch38_pos", width=2000)
    return joins.revel_by_coordinates(asked, read_at_places(s, path, asked, "chromosome", "position", width=2000)).select("ord", "chromosome", "position", "revel_score")


@query("annotate_cadd_pruned", f"SELECT {OUT} FROM asked a LEFT JOIN hit h ON a.id = h.id", CLINVAR, CADD_KEYS, CADD_HIT, tables=("cadd_like",))
def _(s, d):
    from annomerge.sources.layout import read_at_places, write_by_coordinates

    path, asked = fresh_path(s, "cadd-places"), materialise(cadd_asked(s, d), "asked")
    write_by_coordinates(adapter(s, d, "cadd_like"), path, "Chrom", "Pos", width=20)
    return joins.annotate_cadd(asked, read_at_places(s, path, asked, "chromosome", "position", width=20), "id")


@query("gnomad_by_variant_id_pruned", "SELECT e.event_id, CAST(e.user_id % 22 + 1 AS VARCHAR) || '-' || CAST(e.event_id AS VARCHAR) || '-A-' || CASE WHEN value > 50 THEN 'C' ELSE 'G' END AS variant_id, g.gnomad_af FROM events e LEFT JOIN g_flat g ON g.variant_id = CAST(e.user_id % 22 + 1 AS VARCHAR) || '-' || CAST(e.event_id AS VARCHAR) || '-A-' || CASE WHEN value > 50 THEN 'C' ELSE 'G' END WHERE e.user_id % 22 = 4", GNOMAD)
def _(s, d):
    from annomerge.sources.layout import read_at_places, write_by_coordinates

    path, part = fresh_path(s, "gnomad-places"), lambda k: F.split_part("variant_id", F.lit("-"), F.lit(k))
    write_by_coordinates(gnomad_flat(s, d).select("variant_id", "gnomad_af", part(1).alias("chrom"), part(2).alias("pos")), path, "chrom", "pos", width=20_000)
    asked = s.read.parquet(f"{d}/events.parquet").where("user_id % 22 = 4").select("event_id", F.lit("chr5").alias("chromosome"), F.col("event_id").alias("position"), F.lit("A").alias("ref"), F.when(F.col("value") > 50, "C").otherwise("G").alias("alt"))
    return joins.gnomad_by_variant_id(asked, read_at_places(s, path, asked, "chromosome", "position", width=20_000).select("variant_id", "gnomad_af")).select("event_id", "variant_id", "gnomad_af")


@query("lookup_variants_bucketed", "SELECT k.gene, k.hgvs_p, c.clinvar_id, c.clinvar_stars FROM (SELECT DISTINCT gene, hgvs_p FROM lof_like WHERE hgvs_p IS NOT NULL) k LEFT JOIN clinvar c ON k.gene = c.gene AND k.hgvs_p = c.hgvs_p", CLINVAR, tables=("lof_like",))
def _(s, d):
    keys = lof_rows(s, d).where("hgvs_p IS NOT NULL").select("gene", "hgvs_p").distinct()
    return filters.lookup_variants(keys, bucketed(s, clinvar(s, d), ["gene", "hgvs_p"]), ["gene", "hgvs_p"]).select("gene", "hgvs_p", "clinvar_id", "clinvar_stars")


def bucketed(s, rows, keys):
    from annomerge.sources.layout import write_bucketed

    path = fresh_path(s, "buckets")
    name = "annomerge_" + path.rpartition("-")[2]
    write_bucketed(rows, name, path, keys, 8)
    return s.table(name)


@query("merge_bucketed", """SELECT coalesce(c.gene, g.gene) AS gene, coalesce(c.hgvs_p, g.hgvs_p) AS hgvs_p, CASE WHEN g.gene IS NOT NULL THEN g.hgvs_c ELSE c.hgvs_c END AS hgvs_c, clinvar_id, gnomad_af
  FROM clinvar c FULL JOIN gnomad g ON c.gene = g.gene AND c.hgvs_p = g.hgvs_p""", CLINVAR, GNOMAD)
def _(s, d):
    stored = bucketed(s, clinvar(s, d).select("gene", "hgvs_p", "hgvs_c", "clinvar_id"), ["gene", "hgvs_p"])
    return merge.merge(stored, gnomad(s, d).select("gene", "hgvs_p", "hgvs_c", "gnomad_af"), ["gene", "hgvs_p"], copartitioned=True)


@query("attach_penetrance_bucketed", "SELECT v.variant_type, v.variant_id, v.ord, p.penetrance_mean FROM (SELECT 'lof' AS variant_type, ord % 70 AS variant_id, ord FROM annotated) v LEFT JOIN pen p USING (variant_type, variant_id)", LOF, ANNOTATED, PEN)
def _(s, d):
    variants = annotated(s, d).select(F.lit("lof").alias("variant_type"), (F.col("ord") % 70).alias("variant_id"), "ord")
    return joins.attach_penetrance(variants, bucketed(s, penetrance(s, d), ["variant_type", "variant_id"])).select("variant_type", "variant_id", "ord", "penetrance_mean")


@query("write_routes", "SELECT 'missense' AS variant_type, ord, lof_type FROM lof_typed WHERE hgvs_p <> '' UNION ALL SELECT 'lof', ord, lof_type FROM lof_typed WHERE lof_type IS NOT NULL", LOF)
def _(s, d):
    from annomerge.sources.writers import write_routes

    path = fresh_path(s, "routes")
    write_routes(lof_typed(s, d), path)
    return s.read.parquet(path).select("variant_type", "ord", "lof_type")


@query("annotate_cadd_from_files", f"SELECT a.ord, h.RawScore AS cadd_raw, h.PHRED AS cadd_phred FROM clinvar a LEFT JOIN cadd_hit h ON a.ord = h.id", FEATURES)
def _(s, d):
    from annomerge.sources.readers import read_cadd

    path = fresh_path(s, "cadd-sorted")
    adapter(s, d, "cadd_like").orderBy("ord").select(F.concat_ws("\t", "Chrom", "Pos", "Ref", "Alt", "RawScore", "PHRED").alias("line")).write.text(path)
    return joins.annotate_cadd(clinvar(s, d), read_cadd(s, path, order=True), "ord").select("ord", "cadd_raw", "cadd_phred")


@query("read_scored_variants", f"""SELECT 'p.' || {three("aaref")} || CAST(aa_position AS VARCHAR) || {three("aaalt")} AS hgvs_p, aaref, aaalt, alphamissense_score, alphamissense_class FROM am_parsed WHERE aa_position IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY aaref, aa_position, aaalt ORDER BY ord DESC) = 1""", AM)
def _(s, d):
    from annomerge.sources.readers import read_scored_variants

    path = fresh_path(s, "scored")
    adapter(s, d, "am_like").orderBy("ord").select(F.col("protein_variant").alias("variant"), "am_pathogenicity", "am_class").write.option("header", True).csv(path)
    return read_scored_variants(s, path)


@query("read_features", f"SELECT {SMALL} FROM features WHERE gene = 'Brand#5'", FEATURES)
def _(s, d):
    from annomerge.sources.readers import read_features
    from annomerge.sources.writers import write_features

    path = fresh_path(s, "features")
    write_features(features(s, d), path)
    return read_features(s, path).where("gene = 'Brand#5'").select(*SMALL.split(", "))


@query("read_features_typed", """SELECT 'variants_missense' AS stored, gene, hgvs_p AS key, CAST(clinvar_id AS VARCHAR) AS value FROM clinvar UNION ALL SELECT 'variants_lof', gene, hgvs_c, lof_type FROM lof_once
  UNION ALL SELECT 'genes', symbol, symbol, CAST(symbol IS NOT NULL AS VARCHAR) FROM genes_like UNION ALL SELECT 'penetrance_estimates', gene, variant_type, CAST(variant_id AS VARCHAR) FROM pen""", CLINVAR, LOF, ANNOTATED, "lof_once AS (SELECT gene, hgvs_c, lof_type FROM annotated QUALIFY row_number() OVER (PARTITION BY gene, hgvs_c ORDER BY ord) = 1)", PEN, tables=("genes_like",))
def _(s, d):
    from annomerge.sources.readers import read_features
    from annomerge.sources.stored import conform

    first = dedupe.dedupe_first(annotated(s, d).select("gene", "hgvs_c", "lof_type", "ord"), ["gene", "hgvs_c"], "ord")
    tables = {"variants_missense": (clinvar(s, d), "hgvs_p", "clinvar_id"), "variants_lof": (first, "hgvs_c", "lof_type"), "genes": (adapter(s, d, "genes_like"), "symbol", None), "penetrance_estimates": (penetrance(s, d), "variant_type", "variant_id")}
    out = []
    for name, (rows, key, value) in tables.items():
        path = fresh_path(s, name)
        conform(rows.drop("ord"), name).write.parquet(path)
        read = read_features(s, path, name)
        out.append(read.select(F.lit(name).alias("stored"), F.col("symbol" if name == "genes" else "gene").alias("gene"), F.col(key).alias("key"), (F.col(value) if value else F.col("pli").isNotNull()).cast("string").alias("value")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("gene_dims", """SELECT g.symbol AS gene, 'P' || g.symbol AS uniprot_id, t1 || ';' || t2 AS transcripts FROM genes_like g LEFT JOIN wanted w ON g.symbol = w.gene""", TRANSCRIPTS, tables=("genes_like",))
def _(s, d):
    from annomerge.sources.readers import gene_dims

    named = {r["symbol"]: f"P{r['symbol']}" for r in adapter(s, d, "genes_like").select("symbol").collect()}
    proteins, listed = gene_dims(s, named, {r["gene"]: r["transcript_ids"] for r in transcripts(s, d).collect()})
    return proteins.join(listed, "gene", "left").select("gene", "uniprot_id", F.array_join("transcript_ids", ";").alias("transcripts"))


@query("write_features", f"SELECT {SMALL} FROM features", FEATURES)
def _(s, d):
    from annomerge.sources.readers import read_features
    from annomerge.sources.writers import write_features

    path = fresh_path(s, "features")
    write_features(features(s, d), path)
    return read_features(s, path).select(*SMALL.split(", "))


LOADS = ("2024-01-01", "2024-02-01", "2024-03-01")


def loaded_table(s, d, state=None):
    """The path of a stored table after three loads of different genes and sources."""
    from annomerge.sources.stored import upsert

    path, times = fresh_path(s, "stored"), [datetime.fromisoformat(t).replace(tzinfo=timezone.utc) for t in LOADS]
    genes = am(s, d).select("gene").distinct()
    loaded = {"alphamissense": am(s, d).drop("ord", "aaref", "aaalt"), "gnomad": gnomad(s, d).drop("ord"), "clinvar": clinvar(s, d).drop("ord")}
    jobs.build(s, path, genes, "alphamissense", loaded, times[0], state)
    jobs.build(s, path, genes.where("gene < 'Brand#3'"), "gnomad, ClinVar", loaded, times[1], state)
    jobs.build(s, path, genes.where("gene = 'Brand#25'"), "all", {"gnomad": loaded["gnomad"]}, times[2], state)
    upsert(s, path, "variants_lof", annotated(s, d).limit(0).select("gene", "hgvs_c", "lof_type"), times[2])
    return path


STORED = f"""second AS (SELECT coalesce(g.gene, c.gene) AS gene, coalesce(g.hgvs_p, c.hgvs_p) AS hgvs_p, CASE WHEN c.gene IS NOT NULL THEN c.hgvs_c ELSE g.hgvs_c END AS hgvs_c, g.gnomad_af, c.clinvar_id, c.position
  FROM gnomad g FULL JOIN clinvar c ON g.gene = c.gene AND g.hgvs_p = c.hgvs_p WHERE coalesce(g.gene, c.gene) < 'Brand#3' AND coalesce(g.gene, c.gene) IN (SELECT gene FROM am)),
  twice AS (SELECT coalesce(a.gene, s.gene) AS gene, coalesce(a.hgvs_p, s.hgvs_p) AS hgvs_p, s.hgvs_c, a.alphamissense_score, s.gnomad_af, s.clinvar_id, s.position,
  CASE WHEN a.gene IS NOT NULL THEN '{LOADS[0]}' ELSE '{LOADS[1]}' END AS created, CASE WHEN s.gene IS NOT NULL THEN '{LOADS[1]}' ELSE '{LOADS[0]}' END AS updated FROM am a FULL JOIN second s ON a.gene = s.gene AND a.hgvs_p = s.hgvs_p),
  third AS (SELECT * FROM gnomad WHERE gene = 'Brand#25'),
  stored AS (SELECT coalesce(t.gene, g.gene) AS gene, coalesce(t.hgvs_p, g.hgvs_p) AS hgvs_p, CASE WHEN g.gene IS NOT NULL THEN g.hgvs_c ELSE t.hgvs_c END AS hgvs_c, t.alphamissense_score, CASE WHEN g.gene IS NOT NULL THEN g.gnomad_af ELSE t.gnomad_af END AS gnomad_af,
  t.clinvar_id, t.position, 'GRCh38' AS genome_build, epoch(CAST(coalesce(t.created, '{LOADS[2]}') AS TIMESTAMP))::BIGINT AS created_at, epoch(CAST(CASE WHEN g.gene IS NOT NULL THEN '{LOADS[2]}' ELSE t.updated END AS TIMESTAMP))::BIGINT AS updated_at
  FROM twice t FULL JOIN third g ON t.gene = g.gene AND t.hgvs_p = g.hgvs_p)"""


@query("upsert_features", "SELECT gene, hgvs_p, hgvs_c, alphamissense_score, gnomad_af, clinvar_id, position, genome_build, created_at, updated_at FROM stored", AM, GNOMAD, CLINVAR, STORED)
def _(s, d):
    from annomerge.sources.stored import read_stored

    rows = read_stored(s, loaded_table(s, d), "variants_missense")
    return rows.select("gene", "hgvs_p", "hgvs_c", "alphamissense_score", "gnomad_af", "clinvar_id", "position", "genome_build", F.unix_timestamp("created_at").alias("created_at"), F.unix_timestamp("updated_at").alias("updated_at"))


@query("coverage_from_state", "SELECT gene, CAST(count(*) AS BIGINT) AS total, CAST(count(clinvar_id) AS BIGINT) AS with_clinvar, CAST(count(alphamissense_score) AS BIGINT) AS with_alphamissense, CAST(count(gnomad_af) AS BIGINT) AS with_gnomad, CAST(0 AS BIGINT) AS with_revel FROM stored GROUP BY gene", AM, GNOMAD, CLINVAR, STORED)
def _(s, d):
    from annomerge.sources.stored import coverage_report

    state = fresh_path(s, "coverage")
    loaded_table(s, d, state)
    return coverage_report(s, state)


query("normalize_sources", "SELECT c_custkey, CASE WHEN lower(c_mktsegment) LIKE '%build%' THEN 'alphamissense;gnomad;clinvar' ELSE lower(trim(c_mktsegment)) || ';' || lower(trim(substr(c_name, 1, 9))) END AS sources FROM customer")(lambda s, d: s.read.parquet(f"{d}/customer.parquet").select("c_custkey", F.array_join(filters.normalize_sources(F.concat(F.lit(" "), F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("x, ALL")), F.lit(" , "), F.substring("c_name", 1, 9))), ";").alias("sources")))


@query("write_gene_cache", "SELECT gene, hgvs_p, alphamissense_class FROM am", AM)
def _(s, d):
    from annomerge.sources.writers import write_gene_cache

    path = fresh_path(s, "cache")
    write_gene_cache(am(s, d).drop("ord", "aaref", "aaalt"), path, "tsv")
    return s.read.option("sep", "\t").option("header", True).csv(path).select("gene", "hgvs_p", "alphamissense_class")


@query("export_csv", f"SELECT gene, hgvs_p, hgvs_c, CAST(clinvar_id AS VARCHAR) AS clinvar_id, CAST({RANK} AS BIGINT) AS place FROM clinvar", CLINVAR)
def _(s, d):
    from annomerge.sources.readers import with_row_order
    from annomerge.sources.writers import export_csv

    path = fresh_path(s, "csv")
    export_csv(clinvar(s, d).drop("ord"), path)
    return placed(with_row_order(s.read.option("header", True).option("escape", '"').csv(path)), "ord").select("gene", "hgvs_p", "hgvs_c", "clinvar_id", "place")


@query("write_tsv", "SELECT CAST(ord AS VARCHAR) AS ord, gene, lof_type, lof_flags AS loftee_flags, CAST(CAST(nmd_escape AS INT) AS VARCHAR) AS nmd_escape FROM annotated", LOF, ANNOTATED)
def _(s, d):
    from annomerge.sources.writers import write_tsv

    path = fresh_path(s, "tsv")
    write_tsv(annotated(s, d).select("ord", "gene", "lof_type", "loftee_flags", "nmd_escape"), path)
    read = s.read.option("sep", "\t").option("header", True).csv(path)
    return read.select("ord", "gene", "lof_type", F.coalesce("loftee_flags", F.lit("")).alias("loftee_flags"), "nmd_escape")


@query("export_json", f"SELECT {SMALL} FROM features", FEATURES)
def _(s, d):
    from annomerge.sources.writers import export_json

    path = fresh_path(s, "json")
    export_json(features(s, d).select(*SMALL.split(", ")), path)
    return s.read.schema("gene string, hgvs_p string, hgvs_c string, gnomad_af double, clinvar_id long").json(path)
