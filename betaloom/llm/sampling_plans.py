"""Problem 3: draws of sites in given shares per beta bin, from sampling plans and calibrated samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.sampling import draw
from betaloom.shared import cut_lineage, sized
from betaloom.sources.tables import table

SITE = ["chrom", "start"]


def beta_bin(x: Column) -> Column:
    """5-wide right-closed bin of a beta, 0 in the first; null, NaN and values off 0..100 have none."""
    i = F.greatest(F.ceil(x / 5) - 1, F.lit(0)).cast("int")
    return F.when(~F.isnan(x) & x.between(0, 100), F.concat((i * 5).cast("string"), F.lit("-"), (i * 5 + 5).cast("string")))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "draw_targets").withColumn("category", F.trim("beta_bin"))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Distinct sites of each draw and bin. Rows meet the draws of their pool before anything is shuffled."""
    t = _targets(spark, d).select("draw_id", "category", "pool", "pool_key", "occ_min")
    plans = table(spark, d, "sampling_plan").select(F.col("plan_id").alias("pool_key"), F.trim("beta_bin").alias("category"), "occurrence", *SITE)
    a = plans.join(sized(t.filter("pool = 'sampling_plan'")), ["pool_key", "category"]).filter(F.col("occ_min").isNull() | (F.col("occurrence") >= F.col("occ_min")))
    cal = table(spark, d, "calibrated_high_depth").select(F.col("fname").alias("pool_key"), beta_bin(F.col("predicted_beta")).alias("category"), *SITE)
    b = cal.join(sized(t.filter("pool = 'calibrated_high_depth'")), ["pool_key", "category"])
    cols = ["draw_id", "category", *SITE]
    return a.select(cols).unionByName(b.select(cols)).distinct()


def _draw(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return draw(_candidates(spark, d), _targets(spark, d).select("draw_id", "category", "target_share", "draw_size", "min_rows"), SITE)


def _drawn(spark: SparkSession, d: str) -> DataFrame:
    """The report of each draw and bin, with the rows counted on the drawn sample."""
    sample, report = _draw(spark, d)
    drawn = sample.groupBy("draw_id", "category").agg(F.count(F.lit(1)).alias("drawn"))
    return report.join(drawn, ["draw_id", "category"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Bins of which the drawn sample, repairs included, holds fewer rows than needed."""
    return _drawn(spark, d).filter("drawn < need").select("draw_id", F.col("category").alias("beta_bin"))


def p3_sample(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d)[0].withColumnRenamed("category", "beta_bin")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Per draw and bin: target and share reached, need, candidates and rows taken, counted on the drawn sample; the size that
    was asked for and the rows drawn over all bins, which floors above their shares may take beyond it (overrun)."""
    each = cut_lineage(_drawn(spark, d))
    total = each.groupBy("draw_id").agg(F.sum("drawn").alias("draw_rows"))
    r = each.join(sized(total), "draw_id")
    reached = F.round(F.when(F.col("draw_rows") > 0, F.col("drawn") / F.col("draw_rows")), 9)
    over = F.greatest(F.col("draw_rows") - F.coalesce("draw_size", F.lit(0)), F.lit(0))
    return r.select("draw_id", F.col("category").alias("beta_bin"), "draw_size", "draw_rows", over.alias("overrun"), "target_share", reached.alias("share_reached"), "need", "available", "drawn", "short")


def p3_available(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d)[1].select("draw_id", F.col("category").alias("beta_bin"), "need", "available")


QUERIES = {f.__name__: f for f in (p3_found, p3_sample, p3_report, p3_available)}

_AVAILABLE = """with pool as (
select draw_id, trim(t.beta_bin) as bin, chrom, start from draw_targets t join sampling_plan s on t.pool = 'sampling_plan' and s.plan_id = t.pool_key and trim(s.beta_bin) = trim(t.beta_bin) and (t.occ_min is null or s.occurrence >= t.occ_min)
union select draw_id, trim(t.beta_bin), chrom, start from draw_targets t join (select fname, chrom, start, greatest(cast(ceil(predicted_beta / 5) as int) - 1, 0) as i from calibrated_high_depth where not isnan(predicted_beta) and predicted_beta between 0 and 100) c
 on t.pool = 'calibrated_high_depth' and c.fname = t.pool_key and concat(i * 5, '-', i * 5 + 5) = trim(t.beta_bin)),
n as (select draw_id, bin, count(*) as n from pool group by all),
a as (select t.draw_id, trim(t.beta_bin) as beta_bin, greatest(coalesce(min_rows, 0), coalesce(cast(round(target_share * draw_size) as bigint), 0)) as need, coalesce(n, 0) as available from draw_targets t left join n on n.draw_id = t.draw_id and n.bin = trim(t.beta_bin))
"""
_SAMPLE = _AVAILABLE.replace("greatest(coalesce(min_rows", "draw_size, target_share, greatest(coalesce(min_rows") + """, p as (select *, case when available > 0 then least(1.0e0, coalesce(target_share * draw_size, 0) / available) else 0.0e0 end as pi, ('0x' || substr(md5(concat_ws('|', '28', draw_id)), 1, 12))::bigint / pow(2.0e0, 48) as u from a),
b as (select *, coalesce(sum(pi * available) over (partition by draw_id order by beta_bin rows between unbounded preceding and 1 preceding), 0.0e0) as base from p),
t as (select *, floor(base + u + 1e-9) as f, floor(base + pi * available + u + 1e-9) - floor(base + u + 1e-9) as taken from b),
r as (select pool.*, row_number() over (partition by draw_id, bin order by ('0x' || substr(md5(concat_ws('|', '28', draw_id, chrom, start)), 1, 15))::bigint) as r from pool),
h as (select r.draw_id, t.beta_bin, chrom, start, pi, r, greatest(least(need, available) - taken, 0) as repair, f, floor(base + r * pi + u + 1e-9) as upto, floor(base + (r - 1) * pi + u + 1e-9) as prior from r join t on r.draw_id = t.draw_id and r.bin = t.beta_bin),
s as (select draw_id, beta_bin, chrom, start, pi, not (upto > prior) as repaired from h where upto > prior or r - (upto - f) <= repair)
"""
SQL = {
    "p3_sample": _SAMPLE + "select * from s",
    "p3_report": _SAMPLE
    + """, c as (select draw_id, beta_bin, count(*) as drawn from s group by all), w as (select draw_id, count(*) as draw_rows from s group by 1)
select a.draw_id, a.beta_bin, draw_size, coalesce(draw_rows, 0) as draw_rows, greatest(coalesce(draw_rows, 0) - coalesce(draw_size, 0), 0) as overrun, target_share, round(coalesce(drawn, 0) / draw_rows, 9) as share_reached, need, available, coalesce(drawn, 0) as drawn, need > available as short
from a left join c on a.draw_id = c.draw_id and a.beta_bin = c.beta_bin left join w on a.draw_id = w.draw_id""",
    "p3_found": _AVAILABLE + "select draw_id, beta_bin from a where need > available",
    "p3_available": _AVAILABLE + "select draw_id, beta_bin, need, available from a",
}
