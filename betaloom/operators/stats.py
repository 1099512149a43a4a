"""Distribution statistics per group and column, all from one table of value counts.

Rows are counted per (group, column, value) with partial aggregation, and every statistic is taken from these counts, so
that a sample that holds a third of all rows costs as much to finish as its distinct values, and these are ranked in
blocks of values of like size. Group columns must not be null. Nulls and NaN are left out; a group without values has no row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.shared import ship
from betaloom.vocab import BETA_STATS, COUNTS, DEPTH_STATS

ship(__name__)

KEYS = ["fname", "info_col"]
PERCENTS = list(range(1, 100))
#: Cells of a group's range that a density is taken from.
KDE_CELLS = 65_536


def counts(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """(fname, info_col, value, n) of the columns; the group becomes fname."""
    parts = F.array(*[F.struct(F.lit(c).alias("info_col"), F.col(c).cast("double").alias("value")) for c in columns])
    d = df.select(F.col(group).alias("fname"), F.explode(parts).alias("p")).select("fname", "p.*")
    return d.filter("value is not null and not isnan(value)").groupBy(*KEYS, "value").agg(F.count(F.lit(1)).alias("n"))


def _cells(c: DataFrame, cells: int) -> DataFrame:
    """c with `total` rows of its group and the `cell` of each value, 0 to cells - 1 from the least to the greatest."""
    ends = c.groupBy(*KEYS).agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("n").alias("total"))
    width = F.col("hi") - F.col("lo")
    cell = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / F.when(width > 0, width) * cells), F.lit(cells - 1))).otherwise(0)
    return c.join(ends, KEYS).select(*KEYS, "value", "n", "total", cell.alias("cell"))


def percentiles(c: DataFrame, percents: Sequence[float] = PERCENTS) -> DataFrame:
    """(fname, info_col, pct, value), linear interpolation between order statistics.

    Values are cut into blocks of like size. The counts of blocks tell which block holds which rank, and only ranks of
    its own block are looked up among its values.
    """
    block = F.floor(F.greatest(F.least(F.signum("value") * F.log1p(F.abs("value")), F.lit(800.0)), F.lit(-800.0)) * 64).cast("int")
    d = c.withColumn("_blk", block)
    on = [*KEYS, "_blk"]
    sizes = d.groupBy(*on).agg(F.sum("n").alias("_t"))
    sizes = sizes.withColumns({"_before": F.coalesce(F.sum("_t").over(W.partitionBy(*KEYS).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "total": F.sum("_t").over(W.partitionBy(*KEYS))})
    h = (F.col("total") - 1) * F.col("pct") / 100
    ranks = sizes.select("*", F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("pct")).withColumn("_h", h).withColumn("_k", F.floor("_h"))
    which = F.array(F.struct(F.lit(True).alias("first"), F.col("_k").alias("rank")), F.struct(F.lit(False).alias("first"), F.least(F.col("_k") + 1, F.col("total") - 1).alias("rank")))
    ranks = ranks.select(*on, "_before", "_t", "pct", (F.col("_h") - F.col("_k")).alias("_f"), F.explode(which).alias("_w"))
    ranks = ranks.select(*on, "pct", "_f", "_w.first", (F.col("_w.rank") - F.col("_before")).alias("_at"), "_t").filter("_at >= 0 and _at < _t").drop("_t")
    upto = F.sum("n").over(W.partitionBy(*on).orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    hit = d.withColumn("_upto", upto).join(ranks, on).filter("_at < _upto and _at >= _upto - n")
    both = hit.groupBy(*KEYS, "pct").agg(F.max(F.when(F.col("first"), F.col("value"))).alias("a"), F.max(F.when(~F.col("first"), F.col("value"))).alias("b"), F.max("_f").alias("f"))
    return both.select(*KEYS, "pct", (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias("value"))


def describe(c: DataFrame) -> DataFrame:
    """count, mean, std (sample), min, max, cv, skew (population), kurtosis (unbiased excess); two passes over the counts."""
    one = c.groupBy(*KEYS).agg(F.sum("n").alias("count"), (F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))
    dev = F.col("value") - F.col("mean")
    d = c.join(one, KEYS).groupBy(*KEYS).agg(*[F.first(x).alias(x) for x in ("count", "mean", "min", "max")], *[F.sum(F.col("n") * F.pow(dev, k)).alias(f"m{k}") for k in (2, 3, 4)])
    n, m2 = F.col("count").cast("double"), F.col("m2")
    spread = F.when(m2 > 0, m2)
    g2 = n * F.col("m4") / (spread * spread) - 3
    return d.select(
        *KEYS,
        "count",
        "mean",
        F.when(n > 1, F.sqrt(m2 / F.when(n > 1, n - 1))).alias("std"),
        "min",
        "max",
        F.when(F.col("mean") != 0, F.sqrt(m2 / F.when(n > 1, n - 1)) / F.when(F.col("mean") != 0, F.col("mean"))).otherwise(F.lit(float("nan"))).alias("cv"),
        (F.sqrt(n) * F.col("m3") / F.pow(spread, F.lit(1.5))).alias("skew"),
        F.when(n > 3, (n - 1) / F.when(n > 3, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
    )


def mad(c: DataFrame) -> DataFrame:
    """Median absolute deviation from the median, unscaled."""
    med = percentiles(c, [50]).select(*KEYS, F.col("value").alias("median"))
    dev = c.join(med, KEYS).groupBy(*KEYS, F.abs(F.col("value") - F.col("median")).alias("value")).agg(F.sum("n").alias("n"))
    return percentiles(dev, [50]).select(*KEYS, F.col("value").alias("mad"))


def iqr(c: DataFrame) -> DataFrame:
    p = percentiles(c, [25, 75])
    return p.groupBy(*KEYS).agg((F.max(F.when(F.col("pct") == 75, F.col("value"))) - F.max(F.when(F.col("pct") == 25, F.col("value")))).alias("iqr"))


def histogram_entropy(c: DataFrame, bins: int = 20) -> DataFrame:
    """Entropy in bits of `bins` equal bins over [min, max], the last closed; 0 where all values are equal."""
    h = _cells(c, bins).groupBy(*KEYS, "cell").agg(F.sum("n").alias("n"), F.first("total").alias("total"))
    share = F.col("n") / F.col("total")
    return h.groupBy(*KEYS).agg((-F.sum(share * F.log2(share)) + 0.0).alias("entropy"))


def _local_maxima(y: np.ndarray) -> np.ndarray:
    """Centres of strict peaks and of plateaus that fall off on both sides; ends are none."""
    turn = np.flatnonzero(np.diff(y) != 0)
    starts, ends = np.r_[0, turn + 1], np.r_[turn, len(y) - 1]
    v = y[starts]
    inner = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (starts[inner] + ends[inner]) // 2


def find_peaks(y: np.ndarray, distance: int = 0, prominence: float | None = None) -> np.ndarray:
    peaks = _local_maxima(y)
    if distance > 1 and len(peaks):
        keep = np.ones(len(peaks), dtype=bool)
        for i in np.argsort(y[peaks], kind="stable")[::-1]:
            if keep[i]:
                near = np.abs(peaks - peaks[i]) < distance
                near[i] = False
                keep &= ~near
        peaks = peaks[keep]
    if prominence is not None:
        tall = []
        for p in peaks:
            higher = np.flatnonzero(y > y[p])
            left, right = higher[higher < p], higher[higher > p]
            lo = y[(left[-1] + 1 if len(left) else 0) : p + 1].min()
            hi = y[p : (right[0] if len(right) else len(y))].min()
            if y[p] - max(lo, hi) >= prominence:
                tall.append(p)
        peaks = np.array(tall, dtype=int)
    return peaks


def density_peaks(values: np.ndarray, n: np.ndarray, kind: str, most: int = 5, grid: int = 1000) -> tuple[int, list[float]]:
    """Peaks of a Gaussian density of counted values: their number, and the positions of the `most` densest."""
    total = n.sum()
    var = (n * (values - (n * values).sum() / total) ** 2).sum() / (total - 1) if total > 1 else 0.0
    if var <= 0:
        return 0, []
    h = np.sqrt(var) * (1.0 if "beta" in kind else total ** (-0.2))
    x = np.linspace(values.min(), values.max(), grid)
    y = np.zeros(grid)
    for i in range(0, len(values), 4096):
        z = (x[:, None] - values[None, i : i + 4096]) / h
        y += np.exp(-0.5 * z * z) @ n[i : i + 4096]
    y /= total * h * np.sqrt(2 * np.pi)
    at = find_peaks(y, distance=10) if "beta" in kind else find_peaks(y, prominence=0.01 if "depth" in kind else 0.0)
    return len(at), [float(v) for v in x[at][np.argsort(-y[at], kind="stable")][:most]]


def kde_peaks(c: DataFrame, most: int = 5) -> DataFrame:
    """(fname, info_col, peak_num, peak1..): missing peaks, and a peak at exactly 0, are -1 in padded form.

    Values that share one of KDE_CELLS equal cells of their group's range enter as their mean, so that no group grows
    with its distinct values; a cell is far narrower than any bandwidth the density can show.
    """
    names = ", ".join(f"peak{i} double" for i in range(1, most + 1))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("value")
        k, at = density_peaks(pdf["value"].to_numpy(float), pdf["n"].to_numpy(float), pdf["info_col"].iloc[0], most)
        at = [p if p else -1.0 for p in at] + [-1.0] * (most - len(at))
        return pd.DataFrame([[pdf["fname"].iloc[0], pdf["info_col"].iloc[0], float(k), *at]], columns=[*KEYS, "peak_num", *[f"peak{i}" for i in range(1, most + 1)]])

    d = _cells(c, KDE_CELLS).groupBy(*KEYS, "cell").agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("value"), F.sum("n").alias("n"))
    return d.select(*KEYS, "value", "n").groupBy(*KEYS).applyInPandas(run, f"fname string, info_col string, peak_num double, {names}")


def full_table(c: DataFrame, method: DataFrame, most: int = 5) -> DataFrame:
    """fname, method, info_col, q1..q99 and all statistics, one row per group and column. method: fname, method."""
    p = percentiles(c)
    wide = p.groupBy(*KEYS).agg(*[F.max(F.when(F.col("pct") == i, F.col("value"))).alias(f"q{i}") for i in PERCENTS])
    d = wide.join(describe(c), KEYS).join(mad(c), KEYS).join(histogram_entropy(c), KEYS).join(kde_peaks(c, most), KEYS)
    d = d.withColumn("iqr", F.col("q75") - F.col("q25")).join(method, "fname", "left")
    stats = ["count", "mean", "std", "min", "max", "mad", "cv", "skew", "kurtosis", "iqr", "entropy", "peak_num"]
    return d.select("fname", "method", "info_col", *[f"q{i}" for i in PERCENTS], *stats, *[f"peak{i}" for i in range(1, most + 1)])


def model_metadata(full: DataFrame) -> DataFrame:
    """One row a sample: method, the beta statistics and the depth statistics that models use."""
    pick = []
    for kind, names in (("beta", BETA_STATS), ("depth", DEPTH_STATS)):
        for name in names:
            stat = "count" if name in COUNTS else name.removeprefix(f"{kind}_")
            pick.append(F.max(F.when(F.col("info_col") == kind, F.col(stat).cast("double"))).alias(name))
    return full.groupBy("fname", "method").agg(*pick)


def pad_peak(peak):  # noqa: ANN001, ANN201
    """-1 for a missing peak and for one at exactly 0."""
    return F.coalesce(F.nullif(peak, F.lit(0.0)), F.lit(-1.0))
