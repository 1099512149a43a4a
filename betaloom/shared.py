"""Helpers every operator may use: cutting lineage, sized broadcasts, ranking inside hot groups."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows up to which a counted side of a join is broadcast (rows here are keys and a few numbers).
BROADCAST_ROWS = 200_000


def ship(module: str) -> None:
    """Send the functions of a module along with the tasks that call them, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; one of our own only where none is set (tests)."""
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="betaloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder, so that a lost executor costs no recomputation of what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a scan with fewer partitions than cores, dealt out for costly per-row work; a larger table is left where it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 4, key) if df.rdd.getNumPartitions() < cores else df


def sized(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of `small` after counting it; beyond max_rows it is left to a shuffled (skew-aware) join."""
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """left.k <=> right.k over all keys."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def blocked_rank(df: DataFrame, keys: Sequence[str], hash_col: str, tie: Sequence[str], out: str = "rank", blocks: int = 4096, span: tuple[float, float] = (-(2.0**63), 2.0**63)) -> DataFrame:
    """1-based rank of each row within `keys` by (hash_col, tie), without a group in one task.

    hash_col is a whole number spread evenly over `span`, by default a 64-bit hash. Each group is cut by its leading bits into `blocks` blocks; rows are ranked
    inside (keys, block) and the counts of earlier blocks are added. Only the block counts, at most `blocks` rows a
    group, meet in one window partition. Null keys form groups of their own. An empty table gives an empty table.

    Keys travel as one struct, in which nulls are equal, so that ranking and the join with block counts share one
    partitioning and rows are shuffled once.
    """
    keys = list(keys)
    block = F.floor((F.col(hash_col) - F.lit(span[0])) / F.lit(span[1] - span[0]) * F.lit(blocks)).cast("int")
    d = df.withColumn("_blk", F.least(F.greatest(block, F.lit(0)), F.lit(blocks - 1)))
    group = []
    if keys:
        group, d = ["_key"], d.withColumn("_key", F.struct(*keys)).drop(*keys)
    sizes = d.groupBy(*group, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(*group, "_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*group, "_blk").orderBy(hash_col, *[t for t in tie if t not in keys])
    ranked = d.withColumn("_in", F.row_number().over(inside)).join(sizes, [*group, "_blk"])
    return ranked.select(*[F.col("_key")[c].alias(c) if c in keys else F.col(c) for c in df.columns], (F.col("_in") + F.col("_before")).alias(out))


def blocked_cumsum(df: DataFrame, keys: Sequence[str], order_col: str, value_col: str, block: Column, out: str) -> DataFrame:
    """Running sum of value_col within keys by order_col, two-level: inside blocks, plus the totals of earlier blocks.

    `block` must not decrease as order_col grows. Keys must not be null.
    """
    keys = list(keys)
    d = df.withColumn("_blk", block)
    totals = d.groupBy(*keys, "_blk").agg(F.sum(value_col).alias("_t"))
    before = W.partitionBy(*keys).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*keys, "_blk", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys, "_blk").orderBy(order_col).rowsBetween(W.unboundedPreceding, 0)
    return d.withColumn("_in", F.sum(value_col).over(inside)).join(totals, [*keys, "_blk"]).withColumn(out, F.col("_in") + F.col("_before")).drop("_blk", "_in", "_before")
