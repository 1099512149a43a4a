"""Problem 4: sites of gold_eval that also lie in gold_train."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.overlap import coded, contig, pairs
from betaloom.sources.tables import table


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    side = lambda name, carry: coded(table(spark, d, name).withColumn("_contig", contig(F.col("chrom"))), "rec_id", ["label", "_contig"], "start", "beta_pyro", carry)
    return pairs(side("gold_train", []), side("gold_eval", ["split", "assay_source"]), 2, ["split", "assay_source"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select(F.least("rec_t", "rec_o").alias("rec_id_a"), F.greatest("rec_t", "rec_o").alias("rec_id_b"))


def p4_by_split(spark: SparkSession, d: str) -> DataFrame:
    """Pairs, evaluation records and training records concerned, per split and source."""
    return _pairs(spark, d).groupBy("split", "assay_source").agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("rec_o").alias("n_eval"), F.countDistinct("rec_t").alias("n_train"))


QUERIES = {f.__name__: f for f in (p4_found, p4_by_split)}

_PAIRS = """with t as (select *, concat('chr', upper(regexp_replace(lower(trim(chrom)), '^chr', ''))) as c from gold_train),
e as (select *, concat('chr', upper(regexp_replace(lower(trim(chrom)), '^chr', ''))) as c from gold_eval),
p as (select t.rec_id as rt, e.rec_id as ro, e.split, e.assay_source from t join e on t.label = e.label and t.c = e.c and abs(t.start - e.start) <= 2
 and ((t.beta_pyro is null and e.beta_pyro is null) or abs(t.beta_pyro - e.beta_pyro) <= 0.500000001
 or (t.beta_pyro <= 1 and abs(100 * t.beta_pyro - e.beta_pyro) <= 0.500000001) or (e.beta_pyro <= 1 and abs(t.beta_pyro - 100 * e.beta_pyro) <= 0.500000001)
 or (t.beta_pyro <= 1 and e.beta_pyro <= 1 and abs(100 * t.beta_pyro - 100 * e.beta_pyro) <= 0.500000001)))
"""
SQL = {
    "p4_found": _PAIRS + "select least(rt, ro) as rec_id_a, greatest(rt, ro) as rec_id_b from p",
    "p4_by_split": _PAIRS + "select split, assay_source, count(*) as n_pairs, count(distinct ro) as n_eval, count(distinct rt) as n_train from p group by all",
}
