"""Problem 7: a mix of documents in which each source holds its share of all tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.mixing import mix, plain
from betaloom.llm.packing_plans import SIZES
from betaloom.llm.tokens import VOCABULARY, token_count
from betaloom.shared import cut_lineage, spread
from betaloom.sources.tables import table


def _mix(spark: SparkSession, d: str, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    docs = spread(table(spark, d, "documents").select("doc_id", "source", "text"), "doc_id")
    sizes = cut_lineage(docs.select(F.col("doc_id").alias("rec"), plain(F.col("source")).alias("source"), token_count("text", vocabulary).alias("size")))
    targets = table(spark, d, "mix_targets").select(plain(F.col("source")).alias("source"), F.col("source").alias("name"), "target_share", "max_repeats")
    return mix(sizes, targets)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose cap keeps the mix below their target."""
    return _mix(spark, d)[1].filter("short and mixed_units < want").select("source")


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0].withColumnRenamed("rec", "doc_id")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


QUERIES = {f.__name__: f for f in (p7_found, p7_mix, p7_report)}
SQL = {
    "p7_found": f"""with s as ({SIZES}), per as (select lower(trim(source)) as source, sum(size) as size from s group by 1)
select t.source from mix_targets t left join per p on p.source = lower(trim(t.source)) where t.max_repeats * coalesce(p.size, 0) < t.target_share * (select sum(size) from s)""",
}
