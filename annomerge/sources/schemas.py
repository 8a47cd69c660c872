"""Schemas of the source files and of the feature tables."""

from __future__ import annotations

# Positions, from 0, of the columns that are used of the 34 of a clinical summary file.
SUMMARY_COLUMNS = {0: "allele_id", 1: "type", 2: "name", 4: "gene_symbol", 6: "clinical_sig", 8: "last_evaluated", 16: "assembly", 18: "chromosome", 19: "start", 24: "review_status", 30: "variation_id", 31: "pos_vcf", 32: "ref_vcf", 33: "alt_vcf"}
CLINVAR = ", ".join(f"{SUMMARY_COLUMNS.get(i, f'c{i}')} string" for i in range(34))
ALPHAMISSENSE = "uniprot_id string, protein_variant string, am_pathogenicity string, am_class string"
#: The layout with coordinates, whose own header line begins with the comment sign.
ALPHAMISSENSE_HG38 = "CHROM string, POS string, REF string, ALT string, genome string, uniprot_id string, transcript_id string, protein_variant string, am_pathogenicity string, am_class string"
SCORED = "variant string, am_pathogenicity string, am_class string"
REVEL = "chr string, hg19_pos string, grch38_pos string, ref string, alt string, aaref string, aaalt string, REVEL string, Ensembl_transcriptid string"
CADD = "Chrom string, Pos long, Ref string, Alt string, RawScore double, PHRED double"
SIDE = "struct<ac:long,an:long,af:double,homozygote_count:long>"
GNOMAD = f"data struct<gene:struct<gene_id:string,symbol:string,variants:array<struct<variant_id:string,hgvsc:string,hgvsp:string,consequence:string,exome:{SIDE},genome:{SIDE}>>>>"

IDENTITY = "gene string, hgvs_p string, hgvs_c string, chromosome string, position long, ref string, alt string, genome_build string, transcript_id string"
ANNOTATION = "clinvar_id long, clinvar_significance string, clinvar_review_status string, clinvar_stars int, clinvar_last_evaluated date, gnomad_af double, gnomad_af_popmax double, gnomad_homozygotes long, gnomad_version string, created_at timestamp, updated_at timestamp"
TABLES = {
    "variants_missense": f"{IDENTITY}, alphamissense_score double, alphamissense_class string, revel_score double, cadd_phred double, cadd_raw double, domain string, alphafold_plddt double, {ANNOTATION}",
    "variants_lof": f"{IDENTITY}, lof_type string, loftee_confidence string, loftee_flags array<string>, nmd_escape boolean, truncation_position double, last_exon boolean, gene_pli double, gene_loeuf double, {ANNOTATION}",
    "genes": "symbol string, pli double, loeuf double, loeuf_lower double, loeuf_upper double, ensembl_id string, ncbi_id string, canonical_transcript string, created_at timestamp, updated_at timestamp",
    "penetrance_estimates": "variant_type string, variant_id long, gene string, hgvs_p string, penetrance_mean double, penetrance_median double, ci_lower double, ci_upper double, model_version string, n_cases long, n_carriers long, estimated_at timestamp",
}

# Gene to protein accession.
GENE_PROTEINS = {
    "KCNH2": "Q12809",
    "KCNQ1": "P51787",
    "SCN5A": "Q14524",
    "RYR2": "Q92736",
    "CACNA1C": "Q13936",
    "KCNJ2": "P63252",
    "KCNE1": "P15382",
    "KCNE2": "Q9Y6J6",
}
# Gene to transcripts, in order of preference.
GENE_TRANSCRIPTS = {
    "KCNH2": ["ENST00000262186", "ENST00000392968", "ENST00000330883"],
    "KCNQ1": ["ENST00000155840", "ENST00000621062"],
    "SCN5A": ["ENST00000333535", "ENST00000413689"],
    "RYR2": ["ENST00000366574"],
}
