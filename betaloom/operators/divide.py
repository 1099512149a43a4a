"""Division of annotated rows into control, low-depth and high-depth strata, and the merge of what comes back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions.values import clip_beta
from betaloom.operators.checks import assert_unique
from betaloom.vocab import CONTROLS

SITE = ["chrom", "start", "stop"]


def latest(rows: DataFrame, keys: Sequence[str], load: str) -> DataFrame:
    """One row per key: that of the greatest load, where rows were delivered again."""
    w = W.partitionBy(*keys).orderBy(F.col(load).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rows.columns if c not in (*keys, load)])
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_features(rows: DataFrame, annotation: DataFrame, metadata: DataFrame | None = None, validate: bool = False) -> DataFrame:
    """rows with site features (their strand left out), sample statistics, and beta clipped and renamed predicted_beta."""
    if validate:
        assert_unique(annotation, SITE, "annotation")
    d = rows.join(annotation.drop("strand"), SITE, "left")
    if metadata is not None:
        d = d.join(metadata, "fname", "left")
    return d.withColumn("beta", clip_beta(F.col("beta"))).withColumnRenamed("beta", "predicted_beta")


def divide(df: DataFrame, cutoff: int = 10, controls: Sequence[str] = CONTROLS) -> dict[str, DataFrame]:
    """control, low and high: three filters of one plan. A null contig is in none, a null depth in neither of the last two.

    Control and low rows keep their own beta as actual_beta; the model gives it to high rows.
    """
    if cutoff < 1:
        raise ValueError("cutoff must be at least 1")
    own = lambda d: d.withColumn("actual_beta", F.col("predicted_beta"))
    is_control = F.col("chrom").isin(list(controls))
    return {
        "control": own(df.filter(is_control)),
        "low": own(df.filter(~is_control & (F.col("depth") < cutoff))),
        "high": df.filter(~is_control & (F.col("depth") >= cutoff)),
    }


def merge(control: DataFrame, calibrated: DataFrame, imputed: DataFrame, origin: DataFrame, keys: Sequence[str] = SITE) -> DataFrame:
    """Rows of the three strata with the origin's counts and beta beside the calibrated one, both clipped.

    Each stratum: keys and actual_beta. origin: keys, u, m, depth, beta. Sort last, where an order is wanted.
    """
    cols = [*keys, "actual_beta"]
    d = control.select(cols).unionByName(calibrated.select(cols)).unionByName(imputed.select(cols))
    d = d.join(origin.select(*keys, "u", "m", "depth", F.col("beta").alias("predicted_beta")), list(keys), "left")
    return d.select(*keys, "u", "m", "depth", clip_beta(F.col("predicted_beta")).alias("predicted_beta"), clip_beta(F.col("actual_beta")).alias("actual_beta"))
