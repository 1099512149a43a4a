"""Problem 8: keyword-stuffed pages, link lists and product tags among documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.spam import MANY_HOSTS, WORDS, host_of, hosts_per_phrase, pages, word_list
from betaloom.shared import spread
from betaloom.sources.tables import table

#: Hosts from which p8_phrases lists a phrase.
LISTED_HOSTS = 5


def _pages(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "author_id", "text"), "doc_id")
    return pages(docs, "doc_id", "author_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).filter("flagged").select(F.col("id").alias("doc_id"))


def p8_evidence(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The phrase evidence of every page: its phrases, and the shares that are stitched, repeated and copied."""
    shares = [F.round(c, 6).alias(c) for c in ("stitched", "repeated", "copied")]
    return _pages(spark, d).select(F.col("id").alias("doc_id"), F.col("phrases").cast("long").alias("phrases"), *shares)


def p8_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Five-word phrases that stand on LISTED_HOSTS hosts or more, as text, with their number of hosts."""
    docs = spread(table(spark, d, "documents").select("doc_id", "author_id", "text"), "doc_id")
    w = docs.select(host_of("author_id", "doc_id").alias("host"), word_list(F.coalesce("text", F.lit(""))).alias("w"))
    size = F.greatest(F.size("w") - (WORDS - 1), F.lit(0))
    runs = w.select("host", F.arrays_zip(*[F.slice("w", i + 1, size).alias(f"w{i}") for i in range(WORDS)]).alias("z"))
    each = runs.select("host", F.explode("z").alias("p")).select("host", F.concat_ws(" ", *[f"p.w{i}" for i in range(WORDS)]).alias("phrase"))
    return hosts_per_phrase(each, "phrase").filter(F.col("n_hosts") >= LISTED_HOSTS)


QUERIES = {f.__name__: f for f in (p8_found, p8_evidence, p8_shares, p8_phrases)}

_PHRASES = """w as (select doc_id, coalesce('h' || author_id, 'p' || doc_id) as host, [x for x in string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] as w from documents),
each as (select doc_id, host, concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) as phrase from (select doc_id, host, w, unnest(range(1, len(w) - 3)) as i from w) t),
hosts as (select phrase, count(distinct host) as n_hosts from each group by 1)"""
_CLEAN = "regexp_replace(coalesce(text, ''), '[\\x{200b}-\\x{200f}\\x{2060}\\x{feff}\\x{00ad}]', '', 'g')"
SQL = {
    "p8_phrases": f"with {_PHRASES.format(text="coalesce(text, '')")} select phrase, n_hosts from hosts where n_hosts >= {LISTED_HOSTS}",
    "p8_shares": f"""with {_PHRASES.format(text=_CLEAN)},
kinds as (select doc_id, phrase, count(*) as n from each group by all),
e as (select doc_id, sum(n) as phrases, sum(case when n > 1 or n_hosts > 1 then n else 0 end) as there, count(*) as kinds, count(*) filter (n_hosts >= {MANY_HOSTS}) as many from kinds join hosts using (phrase) group by 1)
select doc_id, cast(coalesce(phrases, 0) as bigint) as phrases, round(there / phrases, 6) as stitched, round(1 - kinds / phrases, 6) as repeated, round(many / kinds, 6) as copied from documents left join e using (doc_id)""",
}
