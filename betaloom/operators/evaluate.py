"""Errors of betas against truth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(a: Column, b: Column) -> Column:
    return F.sqrt(F.avg(F.pow(a - b, F.lit(2.0))))


def pinball(truth: Column, guess: Column, q: float = 0.5) -> Column:
    d = truth - guess
    return F.avg(F.greatest(q * d, (q - 1) * d))
