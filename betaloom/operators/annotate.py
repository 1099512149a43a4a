"""Summaries of overlapping annotation, and the annotated union of a site set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions import sequence as sq
from betaloom.vocab import CPG, LOCATIONS, TRACKS

SITE = ["chrom", "start", "stop"]


def short_name(track: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in TRACKS.items() for x in kv])
    return F.coalesce(F.try_element_at(names, track), track)


def _best(name: Column, order: list[str]) -> Column:
    """Highest-priority name of a group; the last where none is present. A minimum of ranks, partial-aggregated."""
    rank = F.lit(len(order) - 1)
    for i, x in enumerate(order):
        rank = F.when(name == x, F.lit(i)).otherwise(rank)
    return F.element_at(F.array(*[F.lit(x) for x in order]), F.min(rank) + 1)


def summarise_overlaps(overlaps: DataFrame) -> DataFrame:
    """overlaps: chrom, start, stop, gene_symbol, anno (short names). One row a site: genes, flags, cpg and location."""
    a = F.col("anno")
    has = lambda x: F.coalesce(F.max(a == x), F.lit(False))
    return overlaps.groupBy(*SITE).agg(
        F.array_join(F.array_sort(F.collect_set("gene_symbol")), ",").alias("gene_symbols"),
        has("promoter").alias("promoter"),
        has("enhancer").alias("enhancer"),
        has("lncrna").alias("lncrna"),
        _best(a, CPG).alias("cpg"),
        _best(a, LOCATIONS).alias("location"),
    )


def with_complexity(df: DataFrame, seq: Column, name: str, measure: Callable[[Column], Column] = sq.bwt_ratio) -> DataFrame:
    """df with the measure of each row's sequence; a distinct sequence is measured once and joined back."""
    d = df.withColumn("_seq", seq)
    once = d.select("_seq").filter("_seq is not null").distinct().withColumn(name, measure(F.col("_seq")))
    return d.join(once, "_seq", "left").drop("_seq")


def sequence_features(seqs: DataFrame, seq: str = "seq", complexity: Callable[[Column], Column] = sq.bwt_ratio) -> DataFrame:
    """seqs: chrom, start, stop and a 141-base flank. Context, composition and complexity of each site.

    Bases are counted once for all measures: the flank has no base outside the complexity window. `complexity` takes the
    place of the BWT ratio where a caller has a measure of their own.
    """
    c = sq.FLANK
    d, n = sq.with_base_counts(seqs.select(*SITE, F.upper(F.col(seq)).alias("_flank")), F.col("_flank"), "_n_")
    s = F.col("_flank")
    return with_complexity(d, sq.complexity_window(s, c, 70), "bwt_ratio_70", complexity).select(
        *SITE,
        sq.strand(s, c).alias("strand"),
        sq.context_type(s, c).alias("ctx_type"),
        sq.window(s, c, 5, 5).alias("seq_5"),
        sq.gc_content(s, counts=n).alias("gc_70"),
        sq.gc_skew(s, n).alias("gc_skew_70"),
        sq.cpg_gc_ratio(s, n).alias("cpg_gc_ratio_70"),
        sq.shannon_entropy(sq.complexity_window(s, c, 70), n).alias("shannonentropy_70"),
        "bwt_ratio_70",
    )


def _raise_unless(ok: Column, what: str) -> Column:
    """A filter that keeps every row, and ends the job at the first where `ok` does not hold."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"{what}: {SITE} not unique")).cast("boolean"))


def _one_a_site(df: DataFrame, what: str) -> DataFrame:
    """Distinct rows of df, of which a site may have one. One shuffle on the site serves this and the join that follows."""
    rest = [c for c in df.columns if c not in SITE]
    if not rest:
        return df.distinct()
    d = df.groupBy(*SITE).agg(F.collect_set(F.struct(*rest)).alias("_rows")).filter(_raise_unless(F.size("_rows") == 1, what))
    return d.select(*SITE, F.col("_rows")[0].alias("_row")).select(*SITE, "_row.*")


def annotate(sites: DataFrame, features: DataFrame, summary: DataFrame, validate: bool = True) -> DataFrame:
    """Left joins of a site set with its sequence features and overlap summary, one to one.

    Where validate is set, repeated sites, and sites with several differing rows in features or summary, end the job that
    reads the result: the check is part of the join's own pass, so that nothing is read or shuffled twice for it.
    """
    if not validate:
        return sites.join(features.distinct(), SITE, "left").join(summary.distinct(), SITE, "left")
    once = F.count(F.lit(1)).over(W.partitionBy(*SITE))
    s = sites.withColumn("_n", once).filter(_raise_unless(F.col("_n") == 1, "sites")).drop("_n")
    return s.join(_one_a_site(features, "sequence features"), SITE, "left").join(_one_a_site(summary, "overlap summary"), SITE, "left")
