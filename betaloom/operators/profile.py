"""Column-level quality profile of large tables, per load.

Every present value is generalised to a character-class mask of its text as delivered (digits to 9, letters to a, the rest
kept; the coarse mask collapses runs as well), values are counted once per (load, column, value), and all figures are read
off these counts: null shares, ranges, distinct counts, dominant and rare masks, and how far the distributions of values
and of masks moved from the reference load. Dominant masks are mined per column over all loads; rows outside them violate
the column's patterns.

Defined results: a NaN counts as null (mask `NaN`); a negative zero is zero; an infinite value is present and out of range; a text column has masks
and distinct counts, and a range only where one is given, which its numbers are held to; a null load id is a
load of its own, without reference; an empty table gives no rows; columns not named in the specification are not read,
so that extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from betaloom.shared import blocked_cumsum, cut_lineage

#: Blocks into which the range of a column is cut for running shares.
BLOCKS = 512
#: Share of a column's present rows, over all loads, from which a coarse mask is dominant.
DOMINANT = 0.01


@dataclass(frozen=True)
class Check:
    """A profiled column and its closed range, if it has one."""

    lo: float | None = None
    hi: float | None = None


def mask(text: Column) -> Column:
    """Character-class mask of a value: runs keep their length, so 76.19 gives 99.99 and -1.0E-5 gives -9.9a-9."""
    return F.regexp_replace(F.regexp_replace(text, r"\p{L}", "a"), r"\p{Nd}", "9")


def coarse(fine: Column) -> Column:
    """A mask with its runs of digits and of letters collapsed: 99.99 gives 9.9, aa9_a9_9 gives a9_a9_9."""
    return F.regexp_replace(F.regexp_replace(fine, "9+", "9"), "a+", "a")


def value_counts(df: DataFrame, load: str, checks: Mapping[str, Check], agreements: Mapping[str, Column] | None = None) -> DataFrame:
    """(load, column_name, value, text, n): one scan, one shuffle of pre-aggregated counts.

    value is the number, if the column's text is one; text is how the value was delivered. Numbers are counted as such and
    put into text afterwards, once per distinct value. agreements adds pseudo-columns of 1.0 (rows disagree), 0.0 (agree) or null (not comparable).
    """
    kind = {c: df.schema[c].dataType for c in checks}
    none = F.lit(None).cast("string")
    parts = []
    for c in checks:
        number = isinstance(kind[c], NumericType)
        parts.append(F.struct(F.lit(c).alias("column_name"), (F.col(c).cast("double") if number else F.col(c).cast("string").try_cast("double")).alias("value"), (none if number else F.col(c).cast("string")).alias("text")))
    parts += [F.struct(F.lit(c).alias("column_name"), e.cast("double").alias("value"), none.alias("text")) for c, e in (agreements or {}).items()]
    long = df.select(F.col(load).alias("load_id"), F.explode(F.array(*parts)).alias("p")).select("load_id", "p.column_name", "p.value", "p.text")
    n = long.groupBy("load_id", "column_name", "value", "text").agg(F.count(F.lit(1)).alias("n"))
    whole = [c for c, t in kind.items() if isinstance(t, IntegralType)]
    written = F.when(F.col("column_name").isin(whole), F.col("value").cast("decimal(38,0)").cast("string")).otherwise(F.col("value").cast("string"))
    return n.withColumn("text", F.coalesce("text", written))


def _in_range(checks: Mapping[str, Check]) -> Column:
    """Present, and inside the column's range where it has one."""
    cond = F.lit(False)
    for c, k in checks.items():
        held = F.col("value").between(k.lo, k.hi) & ~F.isnan("value") if k.lo is not None else F.col("text").isNotNull() & (F.col("text") != "NaN")
        cond = cond | ((F.col("column_name") == c) & held)
    return F.coalesce(cond, F.lit(False))


def mask_profile(counts: DataFrame, checks: Mapping[str, Check]) -> DataFrame:
    """Per (load, column, mask): rows, distinct values, how many of each lie in range, and their extremes.

    A value has exactly one mask, so distinct counts of masks add up to those of the column.
    """
    d = counts.filter(F.col("column_name").isin(list(checks))).withColumn("mask", F.when(F.col("text").isNull(), "null").when(F.col("text") == "NaN", "NaN").otherwise(mask(F.col("text"))))
    real = F.when(F.col("value").isNotNull() & ~F.isnan("value"), F.col("value"))
    ok = _in_range(checks)
    return d.groupBy("load_id", "column_name", "mask").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.when(ok, F.col("n")).otherwise(0)).alias("n_in_range"),
        F.sum(F.when(ok, 1).otherwise(0)).alias("n_distinct_in_range"),
        F.min(real).alias("min_value"),
        F.max(real).alias("max_value"),
    )


def column_profile(masks: DataFrame) -> DataFrame:
    """Per (load, column): rows, nulls, present values, in-range values, distinct values, extremes; from the masks."""
    missing = F.col("mask").isin("null", "NaN")
    present = F.when(missing, 0).otherwise(F.col("n_rows"))
    return masks.groupBy("load_id", "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(missing, F.col("n_rows")).otherwise(0)).alias("n_null"),
        F.sum(present).alias("n_present"),
        F.sum("n_in_range").alias("n_in_range"),
        F.sum(F.when(missing, 0).otherwise(F.col("n_distinct"))).alias("n_distinct"),
        F.sum("n_distinct_in_range").alias("n_distinct_in_range"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def _references(loads: DataFrame) -> DataFrame:
    """(load_id, ref_load_id) of loads that have a reference, once each."""
    return loads.filter("load_id is not null and ref_load_id is not null").groupBy("load_id").agg(F.min("ref_load_id").alias("ref_load_id"))


def value_drift(counts: DataFrame, loads: DataFrame, checks: Mapping[str, Check]) -> DataFrame:
    """(load, column, drift): the greatest gap between the running shares of in-range values of a load and its reference.

    The gap is the maximum of a running sum of +share (load) and -share (reference) over the union of values. The sum
    runs in two levels of value blocks, so that no column of a load has to fit in one task.
    """
    checks = {c: k for c, k in checks.items() if k.lo is not None}
    ok = counts.filter(F.col("column_name").isin(list(checks)) & _in_range(checks))
    total = ok.groupBy("load_id", "column_name").agg(F.sum("n").alias("total"))
    share = ok.join(total, ["load_id", "column_name"]).select("load_id", "column_name", "value", (F.col("n") / F.col("total")).alias("share"))
    refs = _references(loads)
    both = refs.join(total.select("load_id").distinct(), "load_id").join(total.select(F.col("load_id").alias("ref_load_id")).distinct(), "ref_load_id")
    mine = share.join(both.select("load_id"), "load_id")
    theirs = share.withColumnRenamed("load_id", "ref_load_id").join(both, "ref_load_id").select("load_id", "column_name", "value", (-F.col("share")).alias("share"))
    delta = mine.unionByName(theirs).groupBy("load_id", "column_name", "value").agg(F.sum("share").alias("delta"))
    block = F.lit(0)
    for c, k in checks.items():
        block = F.when(F.col("column_name") == c, F.floor((F.col("value") - k.lo) / max(k.hi - k.lo, 1e-9) * BLOCKS).cast("int")).otherwise(block)
    run = blocked_cumsum(delta, ["load_id", "column_name"], "value", "delta", block, "gap")
    # a column without in-range values on one side has no running share to compare
    sides = total.join(both, "load_id").join(total.select(F.col("load_id").alias("ref_load_id"), "column_name", F.lit(True).alias("_r")), ["ref_load_id", "column_name"])
    return run.groupBy("load_id", "column_name").agg(F.max(F.abs("gap")).alias("drift")).join(sides.select("load_id", "column_name"), ["load_id", "column_name"])


def mask_drift(masks: DataFrame, loads: DataFrame) -> DataFrame:
    """(load, column, mask_divergence): Jensen-Shannon divergence in bits between a load's mask shares and its reference's."""
    total = masks.groupBy("load_id", "column_name").agg(F.sum("n_rows").alias("total"))
    share = masks.join(total, ["load_id", "column_name"]).select("load_id", "column_name", "mask", (F.col("n_rows") / F.col("total")).alias("share"))
    refs = _references(loads)
    mine = share.join(refs.select("load_id"), "load_id").withColumn("p", F.col("share")).withColumn("q", F.lit(0.0))
    theirs = share.withColumnRenamed("load_id", "ref_load_id").join(refs, "ref_load_id").withColumn("p", F.lit(0.0)).withColumn("q", F.col("share"))
    cols = ["load_id", "column_name", "mask", "p", "q"]
    pq = mine.select(cols).unionByName(theirs.select(cols)).groupBy("load_id", "column_name", "mask").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    m = (F.col("p") + F.col("q")) / 2
    part = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0)
    return pq.groupBy("load_id", "column_name").agg((F.sum(part("p")) / 2 + F.sum(part("q")) / 2).alias("mask_divergence"))


def rare_masks(masks: DataFrame, dominant: float = 0.01, rare: float = 0.001) -> DataFrame:
    """Masks with less than `rare` of a column's present rows in a load, where dominant masks (each at least `dominant`) hold the rest."""
    m = masks.filter(~F.col("mask").isin("null", "NaN"))
    total = m.groupBy("load_id", "column_name").agg(F.sum("n_rows").alias("total"))
    m = m.join(total, ["load_id", "column_name"]).withColumn("share", F.col("n_rows") / F.col("total"))
    main = m.filter(F.col("share") >= dominant).groupBy("load_id", "column_name").agg(F.count(F.lit(1)).alias("n_dominant"))
    return m.filter(F.col("share") < rare).join(main, ["load_id", "column_name"]).select("load_id", "column_name", "mask", "n_rows", "share", "min_value", "max_value", "n_dominant")


def dominant_masks(masks: DataFrame, dominant: float = DOMINANT) -> DataFrame:
    """(column_name, coarse_mask, n_rows, share): the patterns of a column, mined over all its loads."""
    m = masks.filter(~F.col("mask").isin("null", "NaN")).groupBy("column_name", coarse(F.col("mask")).alias("coarse_mask")).agg(F.sum("n_rows").alias("n_rows"))
    total = m.groupBy("column_name").agg(F.sum("n_rows").alias("total"))
    return m.join(total, "column_name").withColumn("share", F.col("n_rows") / F.col("total")).filter(F.col("share") >= dominant).drop("total")


def pattern_violations(masks: DataFrame, dominant: float = DOMINANT) -> DataFrame:
    """(load, column, n_violating, n_present, share): present rows of a load outside the dominant masks of the column."""
    main = dominant_masks(masks, dominant).select("column_name", "coarse_mask", F.lit(True).alias("_main"))
    m = masks.filter(~F.col("mask").isin("null", "NaN")).withColumn("coarse_mask", coarse(F.col("mask"))).join(main, ["column_name", "coarse_mask"], "left")
    out = m.groupBy("load_id", "column_name").agg(F.sum(F.when(F.col("_main").isNull(), F.col("n_rows")).otherwise(0)).alias("n_violating"), F.sum("n_rows").alias("n_present"))
    return out.withColumn("share", F.col("n_violating") / F.col("n_present"))


def failed_checks(counts: DataFrame, loads: DataFrame, checks: Mapping[str, Check], agreements: Mapping[str, str], *, null_share: float = 0.05, range_share: float = 0.01, distinct_ratio: float = 3.0, drift: float = 0.15, mismatch_share: float = 0.02, rare_share: float = 0.001, divergence: float = 0.1) -> DataFrame:
    """(load_id, column_name, check_name) of all checks that fail; agreements maps pseudo-column to reported column.

    `nulls`, `range` and `distinct` are read off the masks of a load, `rare_mask` (rows outside the column's dominant
    masks) and `mask_drift` (divergence from the masks of the reference load) off all masks; `drift` and `mismatch` off the value counts.
    """
    counts = cut_lineage(counts)  # every check reads the same counts
    masks = cut_lineage(mask_profile(counts, checks))
    prof = column_profile(masks)
    flags = prof.select(
        "load_id",
        "column_name",
        F.explode(
            F.array(
                F.when(F.col("n_null") > null_share * F.col("n_rows"), F.lit("nulls")),
                F.when((F.col("n_present") - F.col("n_in_range")) > range_share * F.col("n_present"), F.lit("range")),
            )
        ).alias("check_name"),
    ).filter("check_name is not null")
    d = prof.select("load_id", "column_name", "n_distinct_in_range")
    ref = d.select(F.col("load_id").alias("ref_load_id"), "column_name", F.col("n_distinct_in_range").alias("_ref"))
    distinct = _references(loads).join(d, "load_id").join(ref, ["ref_load_id", "column_name"]).filter(F.col("n_distinct_in_range") * distinct_ratio < F.col("_ref")).select("load_id", "column_name", F.lit("distinct").alias("check_name"))
    moved = value_drift(counts, loads, checks).filter(F.col("drift") > drift).select("load_id", "column_name", F.lit("drift").alias("check_name"))
    named = F.create_map(*[F.lit(x) for kv in (agreements or {"": ""}).items() for x in kv])
    bad = (
        counts.filter(F.col("column_name").isin(list(agreements)) & F.col("value").isNotNull())
        .groupBy("load_id", "column_name")
        .agg(F.sum(F.col("n") * F.col("value")).alias("bad"), F.sum("n").alias("all"))
        .filter(F.col("bad") > mismatch_share * F.col("all"))
        .select("load_id", named[F.col("column_name")].alias("column_name"), F.lit("mismatch").alias("check_name"))
    )
    rare = pattern_violations(masks).filter(F.col("share") > rare_share).select("load_id", "column_name", F.lit("rare_mask").alias("check_name"))
    other = mask_drift(masks, loads).filter(F.col("mask_divergence") > divergence).select("load_id", "column_name", F.lit("mask_drift").alias("check_name"))
    return flags.unionByName(distinct).unionByName(moved).unionByName(bad).unionByName(rare).unionByName(other)
