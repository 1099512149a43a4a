"""Problem 6: texts of documents into containers of capacity_tokens tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.packing import pack
from betaloom.llm.tokens import VOCABULARY, token_count
from betaloom.shared import cut_lineage, spread
from betaloom.sources.tables import table


def _placed(spark: SparkSession, d: str, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame, int]:
    """Pieces with their containers, the programs, and the capacity; without a kind of container nothing is placed."""
    capacity = table(spark, d, "containers").agg(F.min("capacity_tokens")).first()[0]
    docs = spread(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    sizes = cut_lineage(docs.select(F.col("doc_id").alias("item_id"), token_count("text", vocabulary).alias("size")))
    return (*pack(sizes.limit(0) if capacity is None else sizes, capacity or 1), capacity or 1)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents of which a second piece had to be placed."""
    return _placed(spark, d)[0].filter("piece = 1 and container_id is not null").select(F.col("item_id").alias("doc_id"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return _placed(spark, d)[0].withColumnRenamed("item_id", "doc_id")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, the fewest that hold so many tokens, the gap to them, and the greatest load of a container, which is at most the capacity.

    program_bound sums what each program needs for its items at least; steps, knapsacks and least_coverage are the programs'.
    """
    placed, programs, capacity = _placed(spark, d)
    p = programs.agg(F.count(F.lit(1)).alias("programs"), F.sum("steps").alias("steps"), F.sum("knapsacks").alias("knapsacks"), F.min("covered").alias("least_coverage"), F.sum("bound").alias("program_bound")).first()
    loads = placed.groupBy("container_id").agg(F.sum("length").alias("load"), F.count(F.lit(1)).alias("n"))
    out = loads.agg(F.count(F.lit(1)).alias("n_containers"), F.ceil(F.sum("load") / capacity).alias("least_possible"), F.sum("load").alias("tokens"), F.sum("n").alias("pieces"), F.max("load").alias("greatest_load"))
    n = F.col("n_containers")
    return out.select("*", (n / F.col("least_possible") - 1).alias("gap"), (F.col("tokens") / (n * capacity)).alias("fill"), *[F.lit(p[c]).alias(c) for c in p.asDict()])


QUERIES = {f.__name__: f for f in (p6_found, p6_containers, p6_report)}
# SQL knows no vocabulary: words, numbers and runs of other signs stand for tokens, which settles the long texts alike
SIZES = r"select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[\p{L}]+|[\p{N}]+|[^\s\p{L}\p{N}]+|\s\s+')) as size from documents"
SQL = {"p6_found": f"select doc_id from ({SIZES}) s where size > (select min(capacity_tokens) from containers)"}
