"""Problem 1: percentiles of beta and depth per sample, against those stated in sample_metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.sketch import exact, merge, partial_counts, percentiles
from betaloom.shared import cut_lineage
from betaloom.sources.tables import table

ALPHA = 0.01
FIELDS = {"beta": (0.0, 100.0), "depth": (1.0, 1000.0)}
BETA_GAP = 3.0


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return partial_counts(table(spark, d, "formatted_bedgraph"), ["fname", "load_id"], FIELDS, ALPHA)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Bounds of the sketch settle most samples; the rest are looked up exactly in the buckets the sketch points at."""
    p = percentiles(merge(_parts(spark, d), ["fname"]), ["fname"], {"beta": [0.05], "depth": [0.1, 0.9]}, ALPHA)
    stated = table(spark, d, "sample_metadata").select("fname", F.when(~F.isnan("beta_q5"), F.col("beta_q5")).alias("beta_q5"), F.when(~F.isnan("depth_peak1") & (F.col("depth_peak1") >= 0), F.col("depth_peak1")).alias("depth_peak1")).filter("fname is not null and (beta_q5 is not null or depth_peak1 is not null)")
    p = p.join(stated, "fname")
    x, low, high = F.col("depth_peak1"), F.col("low"), F.col("high")
    far = F.greatest(F.abs(F.col("beta_q5") - low), F.abs(F.col("beta_q5") - high))
    apart = F.greatest(low - F.col("beta_q5"), F.col("beta_q5") - high)
    verdict = (
        F.when(F.col("field") == "beta", F.when(F.col("beta_q5").isNull() | (far <= BETA_GAP), False).when(apart > BETA_GAP, True))
        .when(F.col("q") < 0.5, F.when(x.isNull() | (x >= high), False).when(x < low, True))
        .otherwise(F.when(x.isNull() | (x <= low), False).when(x > high, True))
    )
    p = cut_lineage(p.withColumn("outside", verdict))
    sure = p.filter("outside is not null").select("fname", "field", "outside")
    rest = p.filter("outside is null")
    if not rest.isEmpty():
        v = exact(table(spark, d, "formatted_bedgraph"), ["fname"], FIELDS, rest, ALPHA).join(rest.select("fname", "field", "q", "beta_q5", "depth_peak1"), ["fname", "field", "q"])
        out = F.when(F.col("field") == "beta", F.abs(F.col("beta_q5") - F.col("value")) > BETA_GAP).when(F.col("q") < 0.5, x < F.col("value")).otherwise(x > F.col("value"))
        sure = sure.unionByName(v.select("fname", "field", out.alias("outside")))
    named = F.when(F.col("field") == "beta", "beta_q5").otherwise("depth_peak1")
    return sure.filter("outside").select("fname", named.alias("field")).distinct()


def p1_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Per sample: percentile estimates with the bounds that hold the true value."""
    q = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    p = percentiles(merge(_parts(spark, d), ["fname"]), ["fname"], {"beta": q, "depth": q}, ALPHA)
    return p.select("fname", "field", "q", "n", "estimate", "low", "high")


def p1_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Whether the bounds of each percentile hold its exact value, which is looked up in the buckets the sketch names."""
    q = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    p = cut_lineage(percentiles(merge(_parts(spark, d), ["fname"]), ["fname"], {"beta": q, "depth": q}, ALPHA))
    v = exact(table(spark, d, "formatted_bedgraph"), ["fname"], FIELDS, p, ALPHA)
    return p.join(v, ["fname", "field", "q"], "left").select("fname", "field", "q", "n", F.col("value").between(F.col("low"), F.col("high")).alias("within"))


def p1_exact_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Per sample: the exact percentiles that the sketch locates."""
    p = percentiles(merge(_parts(spark, d), ["fname"]), ["fname"], {"beta": [0.05, 0.5], "depth": [0.1, 0.9]}, ALPHA)
    return exact(table(spark, d, "formatted_bedgraph"), ["fname"], FIELDS, p, ALPHA).select("fname", "field", "q", F.round("value", 6).alias("value"))


def p1_partial_counts(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d)


QUERIES = {f.__name__: f for f in (p1_found, p1_percentiles, p1_bounds, p1_exact_percentiles, p1_partial_counts)}

_OK = """b as (select fname, beta as x from formatted_bedgraph where not isnan(beta) and beta between 0 and 100),
z as (select fname, depth as x from formatted_bedgraph where depth between 1 and 1000)"""
_BUCKET = "case when x = 0 then 0 else cast(ceil(ln(x) / ln(1.01e0 / 0.99e0)) as int) + 200000 end"
SQL = {
    "p1_found": f"""with {_OK}, p as (select fname, quantile_cont(x, 0.05) as q5 from b group by 1), r as (select fname, quantile_cont(x, 0.1) as lo, quantile_cont(x, 0.9) as hi from z group by 1)
select s.fname, 'beta_q5' as field from sample_metadata s join p using (fname) where not isnan(beta_q5) and abs(beta_q5 - q5) > 3.0
union all select s.fname, 'depth_peak1' from sample_metadata s join r using (fname) where not isnan(depth_peak1) and depth_peak1 >= 0 and not (depth_peak1 between lo and hi)""",
    "p1_bounds": f"""with {_OK} select fname, field, unnest([0.01e0, 0.05e0, 0.25e0, 0.5e0, 0.75e0, 0.95e0, 0.99e0]) as q, n, true as within
from (select fname, 'beta' as field, count(*) as n from b group by 1 union all select fname, 'depth', count(*) from z group by 1) c""",
    "p1_exact_percentiles": f"""with {_OK}, v as (
select fname, 'beta' as field, unnest([0.05e0, 0.5e0]) as q, unnest(quantile_cont(x, [0.05, 0.5])) as value from b group by fname
union all select fname, 'depth', unnest([0.1e0, 0.9e0]), unnest(quantile_cont(x, [0.1, 0.9])) from z group by fname)
select fname, field, q, round(cast(value as double), 6) as value from v""",
    "p1_partial_counts": f"""select fname, load_id, field, {_BUCKET} as bucket, count(*) as n from (
select fname, load_id, 'beta' as field, beta as x from formatted_bedgraph where not isnan(beta) and beta between 0 and 100
union all select fname, load_id, 'depth', depth from formatted_bedgraph where depth between 1 and 1000) t group by all""",
}
