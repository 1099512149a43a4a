"""Draws whose share of each category matches target proportions: systematic unequal-probability sampling.

Each candidate has an inclusion probability, its category's target over the category's size (at most 1). Candidates are
laid out by category, in random order inside each; probabilities are summed up along this line across partitions, and
from one random start per draw every candidate whose stretch crosses a whole number is taken. So each category gets its
target rounded up or down, and the draw its size. Categories left below their need (a floor above the share, or a target
rounded down) are then repaired from the candidates next in random order, so that a need is missed only where there are
too few candidates.

Since a probability is the same throughout a category, the sum before a candidate is that of the earlier categories
plus its rank times the probability; ranks come from blocked_rank, so that a category that holds a third of all rows is
not sorted in one task.

Defined results: candidates are distinct by their key columns; a null in a key column is a value like others; a
candidate without category or draw belongs to no draw; a target without share or size asks for its floor alone; a
category without candidates gives no rows and is reported as short; a draw without targets draws nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.shared import blocked_rank, cut_lineage, sized


def need() -> Column:
    """Rows a target asks for: the greater of its floor and its rounded share."""
    return F.greatest(F.coalesce(F.col("min_rows"), F.lit(0)), F.coalesce(F.round(F.col("target_share") * F.col("draw_size")).cast("long"), F.lit(0)))


def _digits(*parts: Column | str, digits: int) -> Column:
    """A whole number from the first hexadecimal digits of the md5 of the parts, an order that every engine shares."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])), 1, digits), 16, 10).cast("long")


def available(candidates: DataFrame, targets: DataFrame) -> DataFrame:
    """targets with `n`, the number of candidates (draw_id, category, key columns; already distinct) of each."""
    n = candidates.groupBy("draw_id", "category").agg(F.count(F.lit(1)).alias("n"))
    return targets.join(n, ["draw_id", "category"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _plan(avail: DataFrame, seed: int) -> DataFrame:
    """Per (draw, category): probability, sum of those before it, random start, floor, and how many the draw falls short of it.

    The probability follows the share alone; what rounding down or a floor above the share leaves missing is repaired.
    """
    draw = W.partitionBy("draw_id")
    share = F.coalesce(F.col("target_share") * F.col("draw_size"), F.lit(0.0))
    d = avail.withColumn("floor", F.least(need(), F.col("n")))
    d = d.withColumn("pi", F.when(F.col("n") > 0, F.least(F.lit(1.0), share / F.col("n"))).otherwise(0.0))
    before = draw.orderBy("category").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("base", F.coalesce(F.sum(F.col("pi") * F.col("n")).over(before), F.lit(0.0)))
    d = d.withColumn("start", _digits(F.lit(str(seed)), "draw_id", digits=12) / F.lit(2.0**48))
    d = d.withColumn("from", F.floor(F.col("base") + F.col("start") + 1e-9))
    d = d.withColumn("taken", F.floor(F.col("base") + F.col("pi") * F.col("n") + F.col("start") + 1e-9) - F.col("from"))
    return d.withColumn("repair", F.greatest(F.col("floor") - F.col("taken"), F.lit(0)))


def draw(candidates: DataFrame, targets: DataFrame, key_cols: Sequence[str], seed: int = 28) -> tuple[DataFrame, DataFrame]:
    """(sample, report). candidates: draw_id, category and key_cols, distinct. targets: draw_id, category, target_share, draw_size, min_rows.

    sample has the candidates taken, with `pi` and `repaired`; report has every target with its share, its need, the candidates
    there are, the rows taken and whether its need can be met. Floors above their shares add to the size of a draw.
    """
    candidates = cut_lineage(candidates)  # counted, then ranked
    plan = cut_lineage(_plan(available(candidates, targets), seed))
    c = candidates.withColumn("_h", _digits(F.lit(str(seed)), "draw_id", *key_cols, digits=15))
    r = blocked_rank(c, ["draw_id", "category"], "_h", list(key_cols), "_r", span=(0.0, 2.0**60))
    d = r.join(sized(plan.select("draw_id", "category", F.col("pi").alias("_pi"), F.col("base").alias("_base"), F.col("start").alias("_start"), F.col("from").alias("_from"), F.col("repair").alias("_repair"))), ["draw_id", "category"])
    upto = F.floor(F.col("_base") + F.col("_r") * F.col("_pi") + F.col("_start") + 1e-9)
    prior = F.floor(F.col("_base") + (F.col("_r") - 1) * F.col("_pi") + F.col("_start") + 1e-9)
    d = d.withColumn("_hit", upto > prior).withColumn("_miss_no", F.col("_r") - (upto - F.col("_from")))
    sample = d.filter(F.col("_hit") | (F.col("_miss_no") <= F.col("_repair"))).select("draw_id", "category", *key_cols, F.col("_pi").alias("pi"), (~F.col("_hit")).alias("repaired"))
    report = plan.select("draw_id", "category", "draw_size", "target_share", need().alias("need"), F.col("n").alias("available"), (F.col("taken") + F.col("repair")).alias("taken"), (need() > F.col("n")).alias("short"))
    return sample, report
