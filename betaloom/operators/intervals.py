"""Range overlap and sequence lookup by binned equi-joins.

Features are laid over bins of fixed width, sites fall into one bin each, and the range condition is checked inside the
bin; features longer than LONG_BINS bins use bins 64 times as wide, so that no feature is spread over many rows. Such
features are few: they are counted, and broadcast up to a bound, so that sites are shuffled once. A
contig that holds a third of all sites is cut by its bins.

Defined results: intervals are half-open; a null contig, start or stop overlaps nothing; repeated sites and features give
one row per pair; `*` or null strand matches either strand in the stranded variant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.shared import sized

BIN, LONG_BINS, COARSE = 16_384, 64, 64


def flank(df: DataFrame, before: int, after: int) -> DataFrame:
    """1-based-free expansion of half-open intervals; starts do not go below 0."""
    return df.withColumn("start", F.greatest(F.col("start") - before, F.lit(0))).withColumn("stop", F.col("stop") + after)


def _tier(sites: DataFrame, features: DataFrame, width: int, cond: Column, carry: list[str]) -> DataFrame:
    f = features.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("f_start") / width), F.floor((F.col("f_stop") - 1) / width))))
    s = sites.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))))
    # a pair that shares several bins counts in the first of them
    first = F.col("_bin") == F.floor(F.greatest(F.col("start"), F.col("f_start")) / width)
    return s.join(f, (s["chrom"] == f["f_chrom"]) & (s["_bin"] == f["_bin"])).drop(f["_bin"]).filter(cond & first).select(*sites.columns, *carry)


def overlap_join(sites: DataFrame, features: DataFrame, stranded: bool = False, width: int = BIN) -> DataFrame:
    """sites (chrom, start, stop[, strand], ...) with each feature (chrom, start, stop[, strand], ...) they overlap; feature columns get the prefix f_."""
    f = features.select(*[F.col(c).alias(f"f_{c}") for c in features.columns]).filter("f_start < f_stop")
    s = sites.filter("start < stop")
    carry = f.columns
    cond = (F.col("start") < F.col("f_stop")) & (F.col("f_start") < F.col("stop"))
    if stranded:
        free = lambda c: F.coalesce(F.col(c), F.lit("*")) == "*"
        cond = cond & (free("strand") | free("f_strand") | (F.col("strand") == F.col("f_strand")))
    long = F.col("f_stop") - F.col("f_start") > width * LONG_BINS
    return _tier(s, f.filter(~long), width, cond, carry).unionByName(_tier(s, sized(f.filter(long)), width * COARSE, cond, carry))


def tile_lookup(sites: DataFrame, tiles: DataFrame, tile: int, out: str = "seq") -> DataFrame:
    """The sequence of each distinct (chrom, start, stop), from tiles (chrom, tile_no, tile_seq) of equal width; upper case.

    An interval takes the tiles it touches by an equi-join on (chrom, tile_no) and puts them together in order. Intervals
    that touch no tile are absent; where the contig ends the sequence is shorter.
    """
    d = sites.select("chrom", "start", "stop").distinct().withColumn("tile_no", F.explode(F.sequence(F.floor(F.col("start") / tile), F.floor((F.col("stop") - 1) / tile))))
    j = d.join(tiles.select("chrom", F.col("tile_no").cast("long").alias("tile_no"), "tile_seq"), ["chrom", "tile_no"])
    lo = F.greatest(F.col("start") - F.col("tile_no") * tile, F.lit(0)).cast("int")
    hi = F.least(F.col("stop") - F.col("tile_no") * tile, F.lit(tile)).cast("int")
    part = j.withColumn("part", F.upper(F.substring("tile_seq", lo + 1, hi - lo)))
    got = part.groupBy("chrom", "start", "stop").agg(F.array_sort(F.collect_list(F.struct("tile_no", "part"))).alias("p"))
    return got.select("chrom", "start", "stop", F.array_join(F.transform("p", lambda x: x["part"]), "").alias(out))
