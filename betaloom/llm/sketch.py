"""Percentiles of large numeric columns from counts in signed logarithmic buckets.

A value x > 0 falls into bucket i with g**(i-1) < x <= g**i, g = (1 + alpha) / (1 - alpha); negative values mirror this and
zero has a bucket of its own. Bucket counts of partitions, loads or days are combined by adding them up, and any
percentile read from the sum has a relative error of at most alpha, whatever the data.

Defined results: null, NaN, infinite and out-of-range values (where a range is given) are not counted; null keys form
groups of their own; a group without counted values has no percentiles; repeated rows count each; an empty table gives
no rows. Only named columns are read, so that extra columns cannot clash; keys may have any name but those of the result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.shared import cut_lineage, sized

#: The least shift of bucket numbers, and the greatest size of a finite double's logarithm.
SHIFT, LOG_MOST = 200_000, 746.0
#: Cells into which a bucket is cut where its values have to be ordered.
CELLS = 4096


def growth(alpha: float) -> float:
    return (1 + alpha) / (1 - alpha)


def shift(alpha: float) -> int:
    """Keeps the bucket numbers of all finite doubles positive, so that sign and number make one ordered key."""
    if not 1e-6 <= alpha < 1:
        raise ValueError("alpha must be at least 1e-6 and below 1")
    return max(SHIFT, math.ceil(LOG_MOST / math.log(growth(alpha))) + 2)


def bucket(x: Column, alpha: float) -> Column:
    """Ordered bucket key: negative buckets, 0, positive buckets, in the order of the values they hold."""
    size = F.ceil(F.ln(F.abs(x)) / math.log(growth(alpha))).cast("int") + shift(alpha)
    return F.when(x == 0, 0).when(x > 0, size).otherwise(-size)


def lower(key: Column, alpha: float) -> Column:
    """Least value of a bucket; a hair wider than its nominal bound, for rounding in the logarithm."""
    g, s = math.log(growth(alpha)), shift(alpha)
    return F.when(key == 0, 0.0).when(key > 0, F.exp((key - s - 1) * g) * (1 - 1e-9)).otherwise(-F.exp((-key - s) * g) * (1 + 1e-9))


def upper(key: Column, alpha: float) -> Column:
    g, s = math.log(growth(alpha)), shift(alpha)
    return F.when(key == 0, 0.0).when(key > 0, F.exp((key - s) * g) * (1 + 1e-9)).otherwise(-F.exp((-key - s - 1) * g) * (1 - 1e-9))


def middle(key: Column, alpha: float) -> Column:
    """The value within alpha of every value of the bucket."""
    g = growth(alpha)
    return F.when(key == 0, 0.0).otherwise(F.signum(key.cast("double")) * 2 * F.exp((F.abs(key) - shift(alpha)) * math.log(g)) / (g + 1))


def _long(df: DataFrame, keys: Sequence[str], fields: Mapping[str, tuple[float, float] | None]) -> DataFrame:
    parts = []
    for c, span in fields.items():
        x = F.col(c).cast("double")
        ok = ~F.isnan(x) & (F.abs(x) < math.inf) if span is None else ~F.isnan(x) & x.between(*span)
        parts.append(F.struct(F.lit(c).alias("field"), F.when(ok, x).alias("value")))
    return df.select(*keys, F.explode(F.array(*parts)).alias("p")).filter("p.value is not null").select(*keys, "p.field", "p.value")


def partial_counts(df: DataFrame, keys: Sequence[str], fields: Mapping[str, tuple[float, float] | None], alpha: float) -> DataFrame:
    """(keys, field, bucket, n): one partial result per key, e.g. per sample and load. Counts are combined map-side."""
    return _long(df, keys, fields).groupBy(*keys, "field", bucket(F.col("value"), alpha).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up partial results into coarser keys."""
    return parts.groupBy(*keys, "field", "bucket").agg(F.sum("n").alias("n"))


def percentiles(counts: DataFrame, keys: Sequence[str], points: Mapping[str, Sequence[float]], alpha: float) -> DataFrame:
    """(keys, field, q, n, estimate, low, high): percentile with linear interpolation, and bounds that hold it.

    Also the buckets of the two order statistics and their offsets inside the bucket (k_bucket, k_offset, j_bucket, j_offset)
    and the weight of the second (frac), with which an exact percentile can be looked up. One window partition holds
    the buckets of one key and field, of which there are at most some thousands whatever the number of rows.
    """
    w = W.partitionBy(*keys, "field").orderBy("bucket")
    run = counts.withColumn("_upto", F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_total", F.sum("n").over(W.partitionBy(*keys, "field")))
    qs = F.array().cast("array<double>")
    for f, q in points.items():
        qs = F.when(F.col("field") == f, F.array(*[F.lit(float(x)) for x in q])).otherwise(qs)
    h = (F.col("_total") - 1) * F.col("_q")
    d = run.select("*", F.explode(qs).alias("_q")).withColumn("_k", F.floor(h)).withColumn("_j", F.least(F.floor(h) + 1, F.col("_total") - 1)).withColumn("_frac", h - F.floor(h))
    before = F.col("_upto") - F.col("n")
    has = lambda r: (F.col(r) >= before) & (F.col(r) < F.col("_upto"))
    d = d.filter(has("_k") | has("_j"))
    pick = lambda r, x: F.max(F.when(has(r), x))
    out = d.groupBy(*keys, "field", F.col("_q").alias("q")).agg(
        F.max("_total").alias("n"),
        F.max("_frac").alias("frac"),
        pick("_k", F.col("bucket")).alias("k_bucket"),
        pick("_k", F.col("_k") - before).alias("k_offset"),
        pick("_j", F.col("bucket")).alias("j_bucket"),
        pick("_j", F.col("_j") - before).alias("j_offset"),
    )
    mix = lambda f: f(F.col("k_bucket"), alpha) * (1 - F.col("frac")) + f(F.col("j_bucket"), alpha) * F.col("frac")
    return out.withColumn("estimate", mix(middle)).withColumn("low", mix(lower)).withColumn("high", mix(upper))


def exact(df: DataFrame, keys: Sequence[str], fields: Mapping[str, tuple[float, float] | None], wanted: DataFrame, alpha: float) -> DataFrame:
    """(keys, field, q, value): exact percentiles for rows of `percentiles`, from only the rows in the buckets they name.

    wanted must be small enough to have been counted by the caller (see sized()); rows are joined to its buckets before
    anything is shuffled, and equal values are counted before they are ordered. A bucket is cut into cells, whose counts
    tell the cell that holds an order statistic, so that only the values of that cell are ordered in one task.
    """
    ends = F.array(*[F.struct(F.lit(w).alias("which"), F.col(f"{w}_bucket").alias("bucket"), F.col(f"{w}_offset").alias("offset")) for w in "kj"])
    need = cut_lineage(wanted.select(F.struct(*keys).alias("_key"), "field", "q", "frac", F.explode(ends).alias("x")).select("_key", "field", "q", "frac", "x.*"))
    rows = _long(df, keys, fields).select(F.struct(*keys).alias("_key"), "field", "value", bucket(F.col("value"), alpha).alias("bucket"))
    on = ["_key", "field", "bucket"]
    values = rows.join(sized(need.select(*on).distinct()), on).groupBy(*on, "value").agg(F.count(F.lit(1)).alias("n"))
    lo, hi = lower(F.col("bucket"), alpha), upper(F.col("bucket"), alpha)
    cell = F.when(hi > lo, F.floor((F.col("value") - lo) / F.when(hi > lo, hi - lo) * CELLS)).otherwise(0)
    values = cut_lineage(values.withColumn("cell", F.greatest(F.least(cell, F.lit(CELLS - 1)), F.lit(0)).cast("int")))
    inside = lambda by, order: W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    holds = (F.col("offset") < F.col("upto")) & (F.col("offset") >= F.col("upto") - F.col("n"))
    cells = values.groupBy(*on, "cell").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(inside(on, "cell")))
    at = cut_lineage(cells.join(sized(need), on).filter(holds).withColumn("offset", F.col("offset") - F.col("upto") + F.col("n")).drop("n", "upto"))
    on.append("cell")
    hit = values.join(sized(at.select(*on).distinct()), on).withColumn("upto", F.sum("n").over(inside(on, "value"))).join(sized(at), on).filter(holds)
    both = hit.groupBy("_key", "field", "q", "frac").agg(F.max(F.when(F.col("which") == "k", F.col("value"))).alias("a"), F.max(F.when(F.col("which") == "j", F.col("value"))).alias("b"))
    return both.select(*[F.col("_key")[k].alias(k) for k in keys], "field", "q", (F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")).alias("value"))
