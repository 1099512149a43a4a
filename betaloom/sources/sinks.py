"""Writers with save modes, and stages that are skipped where their table is complete."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODES = {"error": "errorifexists", "force": "overwrite", "skip": "ignore"}


def free(spark: SparkSession, on_exists: str, *paths: str) -> list[str]:
    """The paths that a job has to write: an error names those taken, before anything is done; skip leaves out what is complete."""
    taken = [p for p in paths if exists(spark, p)]
    if taken and on_exists == "error":
        raise FileExistsError(f"already there: {', '.join(taken)}; --on-exists force overwrites, skip keeps them")
    return [p for p in paths if on_exists != "skip" or p not in taken]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def write_parquet(df: DataFrame, path: str, on_exists: str = "error", codec: str = "lz4_raw", max_rows: int = 0, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode(MODES[on_exists]).option("compression", codec)
    if max_rows:
        w = w.option("maxRecordsPerFile", max_rows)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_tsv(df: DataFrame, path: str, on_exists: str = "error", header: bool = True, compression: str = "gzip") -> None:
    """gzip is what every text reader takes; zstd needs a Hadoop with its native library."""
    df.write.mode(MODES[on_exists]).option("sep", "\t").option("header", header).option("compression", compression).csv(path)


def complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def stage(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path, made first unless it is complete there."""
    if not complete(spark, path):
        write_parquet(make(), path, "force")
    return spark.read.parquet(path)


def write_twice(df: DataFrame, stem: str, on_exists: str = "error") -> None:
    """The same table as Parquet and, read back from it, as CSV."""
    write_parquet(df, f"{stem}.parquet", on_exists)
    df.sparkSession.read.parquet(f"{stem}.parquet").write.mode(MODES[on_exists]).option("header", True).csv(f"{stem}.csv")
