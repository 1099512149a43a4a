"""Guards that raise before a wrong result is written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if gone := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns not found: {gone}")
    return df


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Raise if two rows share their keys; counts are partial-aggregated, only one offender travels."""
    bad = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if bad:
        raise ValueError(f"{what}: {keys} not unique, e.g. {bad[0].asDict()}")
    return df


def not_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def not_null(df: DataFrame) -> DataFrame:
    """Rows without null in any column; NaN stays (unlike na.drop)."""
    cond = F.lit(True)
    for c in df.columns:
        cond = cond & F.col(f"`{c}`").isNotNull()
    return df.filter(cond)
