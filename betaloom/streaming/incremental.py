"""Incremental scoring: new sample files are worked on as they arrive, finished ones are skipped.

A file-source stream remembers which files it has seen; each micro-batch is handed to a batch job, and its rows are
written under the batch's number, so that a batch that runs again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def score_new_files(spark: SparkSession, folder: str, schema: StructType | str, job: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 100, file_glob: str | None = None) -> StreamingQuery:
    """Run `job` over every file of `folder` not yet seen under this checkpoint, then stop; call again for later files."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)

    def each(batch: DataFrame, number: int) -> None:
        job(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return reader.parquet(folder).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
