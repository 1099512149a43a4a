"""Stratified samples, splits and folds by a hash order that both engines share, and the training set they select.

The order is that of the md5 of a key and a seed; ranks are taken in blocks of its leading bits, so that neither a
stratum nor the whole table is sorted in one task. Equal keys order arbitrarily among themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.functions.values import contains_any, null_sum
from betaloom.shared import blocked_rank, sized
from betaloom.vocab import LABELS


def hash_rank(df: DataFrame, strata: Sequence[str], key: Column, seed: str, out: str = "rn") -> DataFrame:
    """1-based rank within strata by md5(key, seed)."""
    d = df.withColumn("_md5", F.md5(F.concat(key.cast("string"), F.lit(seed))))
    d = d.withColumn("_h", F.conv(F.substring("_md5", 1, 15), 16, 10).cast("long"))
    return blocked_rank(d, strata, "_h", ["_md5"], out, span=(0.0, 2.0**60)).drop("_md5", "_h")


def stratified(df: DataFrame, strata: Sequence[str], key: Column, most: int, seed: str) -> DataFrame:
    """Up to `most` rows of each stratum, a null being a stratum like others."""
    return hash_rank(df, strata, key, seed, "_rn").filter(F.col("_rn") <= most).drop("_rn")


def _ranked(df: DataFrame, by: Sequence[str], key: Column, seed: str) -> DataFrame:
    """df with `_rn`, its rank in hash order within `by`, and `_n`, the rows there."""
    r = hash_rank(df, by, key, seed, "_rn")
    if not by:
        return r.withColumn("_n", F.lit(df.count()))
    sizes = df.groupBy(F.struct(*by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    return r.withColumn("_by", F.struct(*by)).join(sized(sizes), "_by").drop("_by")


def split(df: DataFrame, key: Column, share: float, seed: str, by: Sequence[str] = ()) -> DataFrame:
    """`part` head for the first round(n * share) rows in hash order (ties to even), tail for the rest, within each group of `by`."""
    r = _ranked(df, by, key, seed)
    return r.withColumn("part", F.when(F.col("_rn") <= F.bround(F.col("_n") * share), "head").otherwise("tail")).drop("_rn", "_n")


def folds(df: DataFrame, key: Column, k: int, seed: str, by: Sequence[str] = ()) -> DataFrame:
    """`fold` 0..k-1 of n div k rows each in hash order, within each group of `by`; rows beyond k equal folds are left out; fewer than k rows give none."""
    size = F.floor(F.col("_n") / k)
    r = _ranked(df, by, key, seed).filter(F.col("_rn") <= size * k)
    return r.withColumn("fold", F.floor((F.col("_rn") - 1) / size).cast("int")).drop("_rn", "_n")


def fold_selection(folded: DataFrame, validate: Sequence[int]) -> DataFrame:
    """`role` validate for the named folds, train for the others."""
    return folded.withColumn("role", F.when(F.col("fold").isin(list(validate)), "validate").otherwise("train"))


def validates(fname: Column, combination: str, labels: Sequence[str] = LABELS) -> Column:
    """Whether a fold's file is for validation: one digit names that fold of every label, a digit for each label one fold of each.

    Files of gold sites (`train` in their name) always are.
    """
    digits = set("01234")
    if len(combination) == 1 and combination in digits:
        names = [f"_{combination}"]
    elif len(combination) == len(labels) and set(combination) <= digits:
        names = [f"{x}_{c}" for x, c in zip(labels, combination, strict=True)]
    else:
        raise ValueError(f"folds {combination!r}: one digit of 0 to 4, or {len(labels)} of them")
    return contains_any(fname, ["train", *names])


def presence_plan(truth: DataFrame, measured: DataFrame, keys: Sequence[str], labs: Sequence[str]) -> DataFrame:
    """truth with one flag per lab that covers the site, and occurrence, their number; sites no lab covers are left out.

    measured: keys and lab. One join and one pivot whatever the number of labs; each lab's presence is partial-aggregated.
    """
    long = measured.select(*keys, "lab").distinct()
    flags = long.groupBy(*keys).agg(*[F.coalesce(F.max(F.col("lab") == x), F.lit(False)).alias(x) for x in labs])
    d = truth.join(flags, list(keys), "left").na.fill(False, list(labs))
    return d.withColumn("occurrence", null_sum(*[F.col(x) for x in labs])).filter("occurrence > 0")


def dataset(plan: DataFrame, labs: Sequence[str], measured: DataFrame, metadata: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Training rows: plan sites, once for each lab that covers them, with its measurement and its sample's statistics.

    plan: keys, label, beta_pyro, the lab flags, and whatever else is known of a site, which is kept. measured: keys, label,
    lab, predicted_beta, depth. metadata: label, lab, statistics. A plan column that either also has gives way to theirs.
    """
    each = F.explode(F.array(*[F.when(F.col(x), F.lit(x)) for x in labs]))
    taken = {*keys, *labs, "label", "beta_pyro", "lab", "actual_beta", *measured.columns, *metadata.columns}
    rows = plan.select(*keys, "label", F.col("beta_pyro").alias("actual_beta"), *[F.col(f"`{c}`") for c in plan.columns if c not in taken], each.alias("lab")).filter("lab is not null")
    return rows.join(measured, [*keys, "label", "lab"], "left").join(metadata, ["label", "lab"], "left")
