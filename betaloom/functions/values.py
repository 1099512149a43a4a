"""Expressions on betas, depths and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_beta(x: Column) -> Column:
    """Cut to 0..100; null stays null, NaN counts as above."""
    return F.when(x < 0, F.lit(0.0)).when(x > 100, F.lit(100.0)).otherwise(x.cast("double"))


def beta_bin(x: Column) -> Column:
    """5-wide right-closed bin as text: up to 5 in 0-5, from above 95 (and NaN) in 95-100; null for null."""
    out = F.when(x <= 5, F.lit("0-5"))
    for lo in range(5, 95, 5):
        out = out.when(x <= lo + 5, F.lit(f"{lo}-{lo + 5}"))
    return F.when(x.isNotNull(), out.otherwise(F.lit("95-100")))


def lab(fname: Column) -> Column:
    return F.element_at(F.split(fname, "_"), 1)


def label(fname: Column) -> Column:
    return F.try_element_at(F.split(fname, "_"), F.lit(2))


def method(fname: Column) -> Column:
    """First two letters of the lab, where they name a method."""
    m = F.substring(fname, 1, 2)
    return F.when(m.isin("BS", "EM", "PS", "RR"), m)


def trusted_depth(depth: Column, lab_name: Column) -> Column:
    """10 < depth <= 150, or 250 for RR libraries."""
    return (depth > 10) & (depth <= F.when(F.substring(lab_name, 1, 2) == "RR", 250).otherwise(150))


def contains_any(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out


def null_sum(*cols: Column) -> Column:
    """Sum across columns with nulls as 0."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(c.cast("long"), F.lit(0))
    return out
