"""Scans: many files as one, files picked by name, headless text tables, genome tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions.values import contains_any, label
from betaloom.shared import blocked_cumsum

BED = "chrom string, start long, stop long"
FLANK_TABLE = BED + ", retrieved_seq string, bwt_ratio double, shannonentropy double"
TRACKS_TABLE = BED + ", strand string, track string, gene_symbol string"
OVERLAP_TABLE = BED + ", gene_symbol string, anno string"


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One scan over any number of files or folders, with the file's name stem as `fname` where the rows do not name their sample."""
    rows = spark.read.parquet(*paths)
    return rows if "fname" in rows.columns else rows.withColumn("fname", F.element_at(F.split("_metadata.file_name", r"\."), 1))


def pick_files(df: DataFrame, whitelist: Sequence[str] = (), blacklist: Sequence[str] = (), exact_label: str | None = None) -> DataFrame:
    """Rows of files whose name holds any of the whitelist and none of the blacklist; exact_label is the second token."""
    cond = F.lit(True)
    if whitelist:
        cond = cond & contains_any(F.col("fname"), list(whitelist))
    if blacklist:
        cond = cond & ~contains_any(F.col("fname"), list(blacklist))
    if exact_label is not None:
        cond = cond & (label(F.col("fname")) == exact_label)
    return df.filter(cond)


def read_tsv(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("header", header).csv(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """0-based half-open regions with 1-based start, as interval libraries take them."""
    return read_tsv(spark, path, BED).withColumn("start", F.col("start") + 1)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """Intervals of annotation tracks: a Parquet table, or text with a header and the columns of TRACKS_TABLE."""
    if path.rstrip("/").endswith((".tsv", ".txt", ".tsv.gz", ".txt.gz")):
        return read_tsv(spark, path, TRACKS_TABLE, header=True)
    return spark.read.parquet(path)


def read_fasta(spark: SparkSession, path: str, block: int = 1 << 20) -> DataFrame:
    """(chrom, offset, seq) of one FASTA file, a row a line of sequence.

    Each line comes with its place in the file, so that the file is read in splits. A line's contig is the last header before
    it, in its own block of bytes or carried over from earlier ones (a row a block); its offset adds up the lengths of lines before.
    """
    io = "org.apache.hadoop.io."
    lines = spark.sparkContext.newAPIHadoopFile(path, "org.apache.hadoop.mapreduce.lib.input.TextInputFormat", f"{io}LongWritable", f"{io}Text")
    d = spark.createDataFrame(lines, "at long, line string").withColumn("blk", F.floor(F.col("at") / block)).withColumn("line", F.trim("line"))
    d = d.withColumn("name", F.when(F.col("line").startswith(">"), F.regexp_extract("line", r"^>\s*(\S*)", 1)))
    here = d.withColumn("_own", F.last("name", ignorenulls=True).over(W.partitionBy("blk").orderBy("at")))
    ends = d.groupBy("blk").agg(F.max(F.when(F.col("name").isNotNull(), F.struct("at", "name"))).alias("e"))
    carried = ends.select("blk", F.last("e.name", ignorenulls=True).over(W.orderBy("blk").rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    seq = here.join(carried, "blk").select(F.coalesce("_own", "_before").alias("chrom"), "at", "blk", F.col("line").alias("seq"), F.length("line").alias("len")).filter("chrom is not null and len > 0 and not startswith(seq, '>')")
    return blocked_cumsum(seq, ["chrom"], "at", "len", F.col("blk"), "upto").select("chrom", (F.col("upto") - F.col("len")).alias("offset"), "seq")


def fasta_tiles(lines: DataFrame, tile: int) -> DataFrame:
    """(chrom, tile_no, tile_seq) of equal-width tiles from rows (chrom, offset, seq) of sequence pieces of any width."""
    d = lines.withColumn("t", F.explode(F.sequence(F.floor(F.col("offset") / tile), F.floor((F.col("offset") + F.length("seq") - 1) / tile))))
    lo = F.greatest(F.col("t") * tile, F.col("offset"))
    hi = F.least((F.col("t") + 1) * tile, F.col("offset") + F.length("seq"))
    part = F.expr("substring(seq, cast(lo - offset as int) + 1, cast(hi - lo as int))")
    d = d.withColumn("lo", lo).withColumn("hi", hi).withColumn("part", part)
    return d.groupBy("chrom", F.col("t").alias("tile_no")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("lo", "part"))), lambda x: x["part"]), "").alias("tile_seq"))
