"""Sites, flanking sequences and annotation intervals derived from lineitem and orders, in SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from betaloom.sources.tables import table
from betaloom.vocab import TRACKS

_CONTIG = """case when {k}%50=0 then 'chrM' when {k}%50=1 then 'lambda' when {k}%50=2 then 'pUC19' when {k}%24=22 then 'chrX' when {k}%24=23 then 'chrY' else concat('chr',cast({k}%24+1 as string)) end"""
_TRACK = "case " + " ".join(f"when {{t}}={i} then '{x}'" for i, x in enumerate(TRACKS)) + " end"
_MD5 = ",\n ".join(f"translate(md5(concat(cast(start as string),'_{i}')),'0123456789abcdef','ACGTACGTACGTACGT')" for i in range(5))

SITES = f"""select distinct {_CONTIG.format(k="l_orderkey")} as chrom, l_orderkey*1000+l_linenumber*10 as start, l_orderkey*1000+l_linenumber*10+1 as stop,
 case when l_linenumber%2=0 then '+' else '-' end as strand from lineitem"""
SEQS = f"select chrom, start, stop, substr(concat_ws('',{_MD5}),1,141) as seq from ({SITES}) k"
FEATURES = f"""select {_CONTIG.format(k="o_orderkey")} as chrom, o_orderkey*1000+(o_custkey%4)*10 as start, o_orderkey*1000+(o_custkey%4)*10+10+(o_custkey%7)*10 as stop,
 case o_custkey%3 when 0 then '+' when 1 then '-' else '*' end as strand, {_TRACK.format(t="(o_custkey%17)")} as track, concat('GENE',cast(o_custkey%500 as string)) as gene_symbol from orders
union all
select {_CONTIG.format(k="o_orderkey")}, o_orderkey*1000, o_orderkey*1000+80, '*', {_TRACK.format(t="((o_custkey+5)%17)")}, concat('GENE',cast((o_custkey+1)%500 as string)) from orders where o_orderkey%3=0"""


def view(spark: SparkSession, d: str, sql: str) -> DataFrame:
    for name in ("lineitem", "orders"):
        sql = sql.replace(f" from {name}", f" from {{{name}}}")
    used = {n: table(spark, d, n) for n in ("lineitem", "orders") if f"{{{n}}}" in sql}
    return spark.sql(sql, **used)
