"""Fixed values of the domain: contigs, methods, annotation names and priorities, feature names."""

# --- fixed values -------------------------------------------------------------------------------------------------
CONTIGS = [f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY"]
CONTROLS = ["chrM", "lambda", "pUC19"]
METHODS = ["BS", "EM", "PS", "RR"]
LABELS = ["D5", "D6", "F7", "M8", "BC", "BL"]

#: Raw annotation track to short name.
TRACKS = {
    "hg38_cpg_islands": "cpg_island",
    "hg38_cpg_shores": "cpg_shore",
    "hg38_cpg_shelves": "cpg_shelve",
    "hg38_cpg_inter": "cpg_inter",
    "hg38_genes_promoters": "promoter",
    "hg38_enhancers_fantom": "enhancer",
    "hg38_lncrna_gencode": "lncrna",
    "hg38_genes_1to5kb": "TTS_1to5kb",
    "hg38_genes_5UTRs": "5UTR",
    "hg38_genes_3UTRs": "3UTR",
    "hg38_genes_firstexons": "1st_exon",
    "hg38_genes_intronexonboundaries": "intron_exon_bound",
    "hg38_genes_exonintronboundaries": "exon_intron_bound",
    "hg38_genes_introns": "intron",
    "hg38_genes_cds": "cds",
    "hg38_genes_exons": "exon",
    "hg38_genes_intergenic": "intergenic",
}
#: Highest priority first; the last is the default.
CPG = ["cpg_island", "cpg_shore", "cpg_shelve", "cpg_inter"]
LOCATIONS = ["TTS_1to5kb", "5UTR", "3UTR", "1st_exon", "intron", "intron_exon_bound", "exon_intron_bound", "cds", "exon", "intergenic"]

#: 0-based offset of each neighbour of the cytosine in the 11-base context.
BASES = {"b5": 0, "b4": 1, "b3": 2, "b2": 3, "b1": 4, "a1": 6, "a2": 7, "a3": 8, "a4": 9, "a5": 10}

#: Statistics of a sample that models use.
BETA_STATS = [
    "depth10_count", "beta_q5", "beta_q6", "beta_q7", "beta_q8", "beta_q9", "beta_q10", "beta_q11", "beta_q12", "beta_q13",
    "beta_q82", "beta_q85", "beta_q86", "beta_q87", "beta_q88", "beta_q89", "beta_q90", "beta_min", "beta_max", "beta_entropy",
]
DEPTH_STATS = [
    "depth5_count", "depth_std", "depth_max", "depth_cv", "depth_skew", "depth_kurtosis",
    "depth_peak_num", "depth_peak1", "depth_peak2", "depth_peak3", "depth_peak4", "depth_peak5",
]
#: The counts among them: rows of the column, whose files hold rows from that depth on.
COUNTS = ["depth10_count", "depth5_count"]
# ------------------------------------------------------------------------------------------------------------------
