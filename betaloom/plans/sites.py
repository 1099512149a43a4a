"""Queries of scans, site sets, sequence features, overlaps and annotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions import sequence as sq
from betaloom.functions.values import beta_bin, clip_beta
from betaloom.operators.annotate import annotate, sequence_features, short_name, summarise_overlaps, with_complexity
from betaloom.operators.checks import not_null
from betaloom.operators.intervals import flank, overlap_join, tile_lookup
from betaloom.plans.fixtures import FEATURES, SEQS, SITES, view
from betaloom.sources.scans import pick_files
from betaloom.sources.tables import table
from betaloom.vocab import BASES, CONTIGS, CPG, LOCATIONS, TRACKS

TILE = 128


def r(x: Column, name: str) -> Column:
    """Rounded for comparison, NaN as null."""
    return F.round(F.when(~F.isnan(x), x), 9).alias(name)


def sites_pileup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "formatted_bedgraph").filter(F.col("chrom").isin(CONTIGS) & F.col("depth").between(1, 1000))
    return rows.groupBy("chrom", "start").agg(F.sum("m").alias("m"), F.sum("u").alias("u"), F.sum("depth").alias("depth"), F.count(F.lit(1)).alias("n_rows"))


def _site_set(rows: DataFrame, least: int) -> DataFrame:
    return rows.filter(F.col("chrom").isin(CONTIGS) & (F.col("depth") >= least)).select("chrom", "start", "stop")


def site_filter_distinct(spark: SparkSession, d: str) -> DataFrame:
    return _site_set(table(spark, d, "formatted_bedgraph"), 5).distinct()


def site_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    parts = [_site_set(table(spark, d, t), 3) for t in ("formatted_bedgraph", "low_depth", "calibrated_high_depth")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def file_whitelist(spark: SparkSession, d: str) -> DataFrame:
    return pick_files(table(spark, d, "formatted_bedgraph"), whitelist=["_D5_", "_M8_"]).groupBy("fname").agg(F.count(F.lit(1)).alias("n"))


def file_blacklist(spark: SparkSession, d: str) -> DataFrame:
    return pick_files(table(spark, d, "formatted_bedgraph"), blacklist=["RR", "PS2"], exact_label="D6").groupBy("fname").agg(F.count(F.lit(1)).alias("n"))


def flank_expand(spark: SparkSession, d: str) -> DataFrame:
    return flank(table(spark, d, "annotation"), 70, 70).select("site_id", "chrom", "start", "stop")


def seq_slices(spark: SparkSession, d: str) -> DataFrame:
    s = F.upper("seq")
    return view(spark, d, SEQS).select("chrom", "start", sq.window(s, 70, 5, 5).alias("seq_5"), sq.base_at(s, 70).alias("centre"), F.substring(sq.complexity_window(s, 70, 30), 1, 62).alias("inner"))


def base_counts(spark: SparkSession, d: str) -> DataFrame:
    s = F.upper("seq")
    return view(spark, d, SEQS).select("chrom", "start", *[sq.count_base(s, b).alias(f"n_{b.lower()}") for b in "ACGT"], F.regexp_count(s, F.lit("(GC|CG)")).alias("n_pairs"))


def gc_features(spark: SparkSession, d: str) -> DataFrame:
    q, n = sq.with_base_counts(view(spark, d, SEQS).withColumn("seq", F.upper("seq")), F.col("seq"))
    s = F.col("seq")
    return q.select("chrom", "start", r(sq.gc_content(s, counts=n), "gc_70"), r(sq.gc_skew(s, n), "gc_skew_70"), r(sq.cpg_gc_ratio(s, n), "cpg_gc_ratio_70"))


def strand_context(spark: SparkSession, d: str) -> DataFrame:
    s = F.upper("seq")
    return view(spark, d, SEQS).groupBy(sq.strand(s, 70).alias("strand"), sq.context_type(s, 70).alias("ctx_type")).agg(F.count(F.lit(1)).alias("n"))


def shannon_entropy(spark: SparkSession, d: str) -> DataFrame:
    q, n = sq.with_base_counts(view(spark, d, SEQS).withColumn("seq", F.upper("seq")), F.col("seq"))
    return q.select("chrom", "start", r(sq.shannon_entropy(F.col("seq"), n), "entropy"))


def bwt_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Over the 141-base flanks."""
    return with_complexity(view(spark, d, SEQS), sq.complexity_window(F.upper("seq"), 70, 70), "bwt_ratio").select("chrom", "start", "bwt_ratio")


def reverse_complement(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotation").select("site_id", sq.plus_oriented(F.upper("seq_5")).alias("seq"))


#: Columns without which a site is of no use to a model.
NEEDED = ["site_id", "chrom", "start", "stop", "strand", "ctx_type", "seq_5", "gc_70", "gc_skew_70", "shannonentropy_70"]


def complete_sites(spark: SparkSession, d: str) -> DataFrame:
    """Sites with a value, or NaN, in all columns that are needed."""
    return not_null(table(spark, d, "annotation").select(NEEDED)).select("site_id")


def base_split(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "annotation").select("site_id", *[c.alias(k) for k, c in sq.neighbours(F.upper("seq_5")).items()])


def beta_bins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "calibrated_high_depth").groupBy(beta_bin(F.col("predicted_beta")).alias("beta_bin")).agg(F.count(F.lit(1)).alias("n"))


def clipped_beta(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "low_depth").filter(~F.isnan("beta") | F.col("beta").isNull()).select("row_id", clip_beta(F.col("beta")).alias("beta"))


def clipped_beta_whole(spark: SparkSession, d: str) -> DataFrame:
    """clipped_beta with the rows whose beta is NaN, as null."""
    return table(spark, d, "low_depth").select("row_id", clip_beta(F.nanvl("beta", F.lit(None).cast("double"))).alias("beta"))


def genome_tile_lookup(spark: SparkSession, d: str) -> DataFrame:
    """11-base contexts from genome tiles; tiles of the touched stretches are derived from their numbers."""
    at = flank(table(spark, d, "annotation").filter("start >= 5"), 5, 5).select("chrom", "start", "stop")
    no = at.select("chrom", F.explode(F.sequence(F.floor(F.col("start") / TILE), F.floor((F.col("stop") - 1) / TILE))).alias("tile_no")).distinct()
    parts = [F.translate(F.md5(F.concat_ws(":", "chrom", F.col("tile_no").cast("string"), F.lit(str(k)))), "0123456789abcdef", "ACGTACGTACGTACGT") for k in range(4)]
    return tile_lookup(at, no.withColumn("tile_seq", F.concat(*parts)), TILE)


def _pairs(spark: SparkSession, d: str, stranded: bool) -> DataFrame:
    return overlap_join(view(spark, d, SITES), view(spark, d, FEATURES), stranded)


def overlaps(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d, False).select("chrom", "start", "f_start", "f_stop", F.col("f_track").alias("track"), F.col("f_gene_symbol").alias("gene_symbol"))


def overlaps_stranded(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d, True).select("chrom", "start", "f_start", "f_stop", F.col("f_track").alias("track"), F.col("f_gene_symbol").alias("gene_symbol"))


def _summary(spark: SparkSession, d: str) -> DataFrame:
    return summarise_overlaps(_pairs(spark, d, False).select("chrom", "start", "stop", F.col("f_gene_symbol").alias("gene_symbol"), short_name(F.col("f_track")).alias("anno")))


def overlap_summary(spark: SparkSession, d: str) -> DataFrame:
    return _summary(spark, d)


def annotate_sites(spark: SparkSession, d: str) -> DataFrame:
    seqs = view(spark, d, SEQS)
    full = annotate(seqs.select("chrom", "start", "stop").distinct(), sequence_features(seqs), _summary(spark, d))
    return full.select("chrom", "start", "stop", "strand", "ctx_type", "seq_5", r(F.col("gc_70"), "gc_70"), r(F.col("gc_skew_70"), "gc_skew_70"), r(F.col("shannonentropy_70"), "shannonentropy_70"), "gene_symbols", "promoter", "enhancer", "lncrna", "cpg", "location")


def annotate_sites_whole(spark: SparkSession, d: str) -> DataFrame:
    """annotate_sites with the columns that its SQL has not: cpg_gc_ratio_70 and bwt_ratio_70."""
    seqs = view(spark, d, SEQS)
    full = annotate(seqs.select("chrom", "start", "stop").distinct(), sequence_features(seqs), _summary(spark, d))
    return full.select(*[r(F.col(c), c) if t == "double" else F.col(c) for c, t in full.dtypes])


def context_betas(spark: SparkSession, d: str) -> DataFrame:
    """Per method and context: rows, mean raw and mean clipped beta, depth >= 10; the flagship query."""
    rows = table(spark, d, "formatted_bedgraph").filter(F.col("chrom").isin(CONTIGS) & (F.col("depth") >= 10) & F.col("beta").isNotNull() & ~F.isnan("beta"))
    sites = table(spark, d, "annotation").select("chrom", "start", "stop", "ctx_type")
    j = rows.join(sites, ["chrom", "start", "stop"]).groupBy(F.substring("fname", 1, 2).alias("method"), "ctx_type")
    return j.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("beta"), 6).alias("mean_beta"), F.round(F.avg(clip_beta(F.col("beta"))), 6).alias("mean_clipped"))


QUERIES = {
    f.__name__: f
    for f in (
        sites_pileup, site_filter_distinct, site_union_distinct, file_whitelist, file_blacklist, flank_expand, seq_slices, base_counts, gc_features, strand_context, shannon_entropy, bwt_ratio,
        reverse_complement, complete_sites, base_split, beta_bins, clipped_beta, clipped_beta_whole, genome_tile_lookup, overlaps, overlaps_stranded, overlap_summary, annotate_sites, annotate_sites_whole, context_betas,
    )
}

_IN = "(" + ", ".join(f"'{c}'" for c in CONTIGS) + ")"
_N = {b: f"(length(seq) - length(replace(seq, '{b}', '')))" for b in "ACGT"}
_GC = f"({_N['G']} + {_N['C']})"
_B = lambda i: f"substr(seq, {71 + i}, 1)"
_STRAND = f"case {_B(0)} when 'C' then '+' when 'G' then '-' else '.' end"
_CTX = f"""case when {_B(0)} = 'C' then case when {_B(1)} = 'G' then 'CpG' when {_B(2)} = 'G' then 'CHG' else 'CHH' end
 when {_B(0)} = 'G' then case when {_B(-1)} = 'C' then 'CpG' when {_B(-2)} = 'C' then 'CHG' else 'CHH' end else '?' end"""
_ENT = " + ".join(f"case when {n} > 0 then -({n} / length(seq)) * log2({n} / length(seq)) else 0.0 end" for n in _N.values())
_SKEW, _RATIO = f"({_N['G']} - {_N['C']}) / nullif({_GC}, 0)", f"len(regexp_extract_all(seq, '(GC|CG)')) / nullif({_GC}, 0)"
ORIENTED = "case when substr(upper(seq_5), 6, 1) = 'C' then upper(seq_5) else translate(reverse(upper(seq_5)), 'ACGT', 'TGCA') end"
_OVER = f"with s as ({SITES}), f as ({FEATURES}) select s.chrom, s.start, f.start as f_start, f.stop as f_stop, track, gene_symbol from s join f on s.chrom = f.chrom and s.start < f.stop and f.start < s.stop"
_SHORT = "case track " + " ".join(f"when '{k}' then '{v}'" for k, v in TRACKS.items()) + " end"
_RANK = lambda names: "case " + _SHORT + " " + " ".join(f"when '{x}' then {i}" for i, x in enumerate(names)) + f" else {len(names) - 1} end"
_NAME = lambda names: "case min(" + _RANK(names) + ") " + " ".join(f"when {i} then '{x}'" for i, x in enumerate(names)) + " end"
_SUMMARY = f"""select chrom, start, start + 1 as stop, string_agg(distinct gene_symbol, ',' order by gene_symbol) as gene_symbols, bool_or({_SHORT} = 'promoter') as promoter,
 bool_or({_SHORT} = 'enhancer') as enhancer, bool_or({_SHORT} = 'lncrna') as lncrna, {_NAME(CPG)} as cpg, {_NAME(LOCATIONS)} as location from ({_OVER}) o group by chrom, start"""
_BINS = "case when predicted_beta is null then null " + " ".join(f"when predicted_beta <= {b + 5} then '{b}-{b + 5}'" for b in range(0, 95, 5)) + " else '95-100' end"
_TILES = " || ".join(f"translate(md5(concat_ws(':', chrom, {{t}}, '{k}')), '0123456789abcdef', 'ACGTACGTACGTACGT')" for k in range(4))
_ANNOTATED = f"""q.chrom, q.start, q.stop, {_STRAND} as strand, {_CTX} as ctx_type, substr(seq, 66, 11) as seq_5, round({_GC} / 142.0, 9) as gc_70, round({_SKEW}, 9) as gc_skew_70, round({_ENT}, 9) as shannonentropy_70,
 gene_symbols, promoter, enhancer, lncrna, cpg, location"""
# the last column of the sorted suffixes, and how often neighbours in it differ
_BWT = f"""s as (select chrom, start, seq || '$' as t from ({SEQS}) s0),
o as (select chrom, start, [x.c for x in list_sort([{{'s': substr(t, i, 200), 'c': substr(t, case when i = 1 then len(t) else i - 1 end, 1)}} for i in range(1, len(t) + 1)])] as l from s),
bwt as (select chrom, start, (1 + len([1 for i in range(1, len(l)) if l[i] <> l[i + 1]])) / len(l) as bwt_ratio from o)"""

SQL = {
    "sites_pileup": f"select chrom, start, cast(sum(m) as bigint) as m, cast(sum(u) as bigint) as u, cast(sum(depth) as bigint) as depth, count(*) as n_rows from formatted_bedgraph where chrom in {_IN} and depth between 1 and 1000 group by all",
    "site_filter_distinct": f"select distinct chrom, start, stop from formatted_bedgraph where chrom in {_IN} and depth >= 5",
    "site_union_distinct": " union ".join(f"select chrom, start, stop from {t} where chrom in {_IN} and depth >= 3" for t in ("formatted_bedgraph", "low_depth", "calibrated_high_depth")),
    "file_whitelist": "select fname, count(*) as n from formatted_bedgraph where contains(fname, '_D5_') or contains(fname, '_M8_') group by 1",
    "file_blacklist": "select fname, count(*) as n from formatted_bedgraph where split_part(fname, '_', 2) = 'D6' and not contains(fname, 'RR') and not contains(fname, 'PS2') group by 1",
    "flank_expand": "select site_id, chrom, greatest(start - 70, 0) as start, stop + 70 as stop from annotation",
    "seq_slices": f"select chrom, start, substr(seq, 66, 11) as seq_5, substr(seq, 71, 1) as centre, substr(seq, 41, 62) as \"inner\" from ({SEQS}) q",
    "base_counts": "select chrom, start, " + ", ".join(f"{n} as n_{b.lower()}" for b, n in _N.items()) + f", len(regexp_extract_all(seq, '(GC|CG)')) as n_pairs from ({SEQS}) q",
    "gc_features": f"select chrom, start, round({_GC} / 142.0, 9) as gc_70, round({_SKEW}, 9) as gc_skew_70, round({_RATIO}, 9) as cpg_gc_ratio_70 from ({SEQS}) q",
    "strand_context": f"select {_STRAND} as strand, {_CTX} as ctx_type, count(*) as n from ({SEQS}) q group by all",
    "shannon_entropy": f"select chrom, start, round({_ENT}, 9) as entropy from ({SEQS}) q",
    "reverse_complement": f"select site_id, {ORIENTED} as seq from annotation",
    "complete_sites": "select site_id from annotation where " + " and ".join(f"{c} is not null" for c in NEEDED),
    "base_split": "select site_id, " + ", ".join(f"substr({ORIENTED}, {i + 1}, 1) as {k}" for k, i in BASES.items()) + " from annotation",
    "beta_bins": f"select {_BINS} as beta_bin, count(*) as n from calibrated_high_depth group by 1",
    "clipped_beta": "select row_id, case when beta < 0 then 0.0e0 when beta > 100 then 100.0e0 else beta end as beta from low_depth where beta is null or not isnan(beta)",
    "clipped_beta_whole": "select row_id, case when isnan(beta) then null when beta < 0 then 0.0e0 when beta > 100 then 100.0e0 else beta end as beta from low_depth",
    "genome_tile_lookup": f"""with a as (select distinct chrom, start - 5 as start, stop + 5 as stop from annotation where start >= 5), t as (select *, start // {TILE} as t0 from a)
select chrom, start, stop, substr({_TILES.format(t="t0")} || {_TILES.format(t="t0 + 1")}, cast(start - t0 * {TILE} + 1 as bigint), cast(stop - start as bigint)) as seq from t""",
    "overlaps": _OVER,
    "overlaps_stranded": _OVER + " and (f.strand = '*' or f.strand = s.strand)",
    "overlap_summary": _SUMMARY,
    "annotate_sites": f"with q as (select distinct * from ({SEQS}) q0), m as ({_SUMMARY}) select {_ANNOTATED} from q left join m on q.chrom = m.chrom and q.start = m.start and q.stop = m.stop",
    "annotate_sites_whole": f"with q as (select distinct * from ({SEQS}) q0), m as ({_SUMMARY}), {_BWT} select {_ANNOTATED}, round({_RATIO}, 9) as cpg_gc_ratio_70, round(bwt_ratio, 9) as bwt_ratio_70 from q left join m on q.chrom = m.chrom and q.start = m.start and q.stop = m.stop join bwt on q.chrom = bwt.chrom and q.start = bwt.start",
    "bwt_ratio": f"with {_BWT} select * from bwt",
    "context_betas": f"""select substr(fname, 1, 2) as method, ctx_type, count(*) as n, round(avg(beta), 6) as mean_beta, round(avg(case when beta < 0 then 0 when beta > 100 then 100 else beta end), 6) as mean_clipped
from formatted_bedgraph b join annotation a using (chrom, start, stop) where chrom in {_IN} and depth >= 10 and not isnan(beta) group by all""",
}
