"""Schemas of the tables that are read."""
from __future__ import annotations

SAMPLES = "method string, condition string, replicate string, fastqFile string, fastqFile2 string"
GFF = "seq string, source string, feature string, start bigint, stop bigint, score string, strand string, phase string, attributes string"
TOTALS = "library string, chrom string, n bigint"
MEAN_LENGTHS = "library string, chrom string, mean_len double"
BED6 = "chrom string, start bigint, stop bigint, name string, score string, strand string"
BEDGRAPH = "chrom string, start bigint, stop bigint, value double"
ALIGNMENTS = "read_id string, flag int, chrom string, start0 bigint, end0 bigint, stop0 bigint, mapq int, read_length bigint, nh int, strand string"
PREDICTIONS_A = "ORF_locus string, strand string, length int, start_codon string, ribo_count double, ribo_rpkm double, ribo_coverage double, SD_score double, SD_pos double, prob double, ORF_type string, Reference string, Distance_from_aTIS double"
PREDICTIONS_B = "filename string, filename_counts string, label boolean, in_gene string, strand string, coverage double, coverage_elo double, rpk double, rpk_elo double, start_site bigint, start_codon string, stop_site bigint, stop_codon string, locus string, prot_seq string, nuc_seq string, pred double, pred_rank bigint, SS boolean, dist int, SS_pred_rank bigint"
DE_XTAIL = "id string, mRNA_log2FC double, RPF_log2FC double, log2FC_TE_v1 double, pvalue_v1 double, log2FC_TE_v2 double, pvalue_v2 double, log2FC_TE_final double, pvalue_final double, `pvalue.adjust` double"
DE_RIBOREX = "id string, baseMean double, log2FoldChange double, lfcSE double, stat double, pvalue double, padj double"
DE_DELTATE = "Identifier string, baseMean double, log2FoldChange double, lfcSE double, pvalue double, padj double"
DE_DELTATE_TE = DE_RIBOREX.replace("id ", "Identifier ", 1)
COUNTS = "id string, chrom string, start bigint, stop bigint, strand string, length bigint"
