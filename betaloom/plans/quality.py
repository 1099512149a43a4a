"""Queries of the data-quality operators: missing cells filled by hot-deck, and the column profile of loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.operators.hotdeck import Field, fill, hot_deck
from betaloom.operators.profile import Check, column_profile, dominant_masks, failed_checks, mask_drift, mask_profile, pattern_violations, rare_masks, value_counts, value_drift
from betaloom.shared import cut_lineage
from betaloom.sources.tables import table
from betaloom.vocab import LOCATIONS

CHECKS = {"beta": Check(0, 100), "depth": Check(1, 1000), "m": Check(0, 1000), "u": Check(0, 1000)}
#: Columns of text have patterns, but no range.
ALL_CHECKS = {**CHECKS, "chrom": Check(), "fname": Check()}


def usable_beta() -> Column:
    return F.when(~F.isnan("beta") & F.col("beta").between(-0.5, 100.5), F.col("beta"))


def usable_depth() -> Column:
    return F.when(F.col("depth").between(1, 9), F.col("depth"))


def usable_location() -> Column:
    """One of the ten names, as it is spelled in the vocabulary."""
    name = F.lower(F.trim("location"))
    out = F.lit(None).cast("string")
    for x in LOCATIONS:
        out = F.when(name == x.lower(), F.lit(x)).otherwise(out)
    return out


def low_depth_cells(low: DataFrame) -> DataFrame:
    return hot_deck(low, "row_id", "start", [Field("low_depth.beta", usable_beta()), Field("low_depth.depth", usable_depth())], {"sample": ["fname", "chrom"], "stretch": ["chrom"]})


def location_cells(sites: DataFrame) -> DataFrame:
    return hot_deck(sites, "site_id", "start", [Field("annotation.location", usable_location())], {"stretch": ["chrom"]})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return low_depth_cells(table(spark, d, "low_depth")).unionByName(location_cells(table(spark, d, "annotation"))).select("field", "row_id")


def p2_low_depth_cells(spark: SparkSession, d: str) -> DataFrame:
    c = low_depth_cells(table(spark, d, "low_depth"))
    return c.filter("level = 'sample'").select("field", "row_id", F.round(F.col("value").cast("double"), 6).alias("value"), "donor_id", "distance")


def p2_low_depth_cells_whole(spark: SparkSession, d: str) -> DataFrame:
    """Cells of all levels; p2_low_depth_cells has those of the first, as its SQL."""
    c = low_depth_cells(table(spark, d, "low_depth"))
    return c.select("field", "row_id", F.round(F.col("value").cast("double"), 6).alias("value"), "donor_id", "distance", "level")


def p2_low_depth_filled(spark: SparkSession, d: str) -> DataFrame:
    low = table(spark, d, "low_depth")
    cells = low_depth_cells(low)
    out = fill(low, "row_id", "low_depth.beta", "beta", usable_beta(), cells)
    out = fill(out, "row_id", "low_depth.depth", "depth", usable_depth(), cells)
    return out.select("row_id", "fname", "chrom", "start", "depth", "depth_filled", "depth_donor", "depth_distance", "beta", "beta_filled", "beta_donor", "beta_distance")


def p2_location_filled(spark: SparkSession, d: str) -> DataFrame:
    sites = table(spark, d, "annotation")
    out = fill(sites, "site_id", "annotation.location", "location", usable_location(), location_cells(sites))
    return out.select("site_id", "location", "location_filled", "location_donor", "location_distance")


def _counts(spark: SparkSession, d: str, checks: dict[str, Check] = CHECKS) -> DataFrame:
    agree = {
        "depth=m+u": F.when(F.col("m").isNotNull() & F.col("u").isNotNull() & F.col("depth").isNotNull(), (F.col("m") + F.col("u") != F.col("depth")).cast("int")),
        "beta=m/depth": F.when(F.col("m").isNotNull() & F.col("beta").isNotNull() & ~F.isnan("beta") & (F.col("depth") >= 1), (F.abs(F.col("beta") - F.lit(100.0) * F.col("m") / F.col("depth")) > 1.0).cast("int")),
    }
    return value_counts(table(spark, d, "formatted_bedgraph"), "load_id", checks, agree)


AGREEMENTS = {"depth=m+u": "depth", "beta=m/depth": "beta"}


#: The checks that p5_found reports; the operator's others are in p5_pattern_checks.
CASES = ("nulls", "range", "distinct", "drift", "mismatch")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return failed_checks(_counts(spark, d), table(spark, d, "loads"), CHECKS, AGREEMENTS).filter(F.col("check_name").isin(*CASES))


def p5_pattern_checks(spark: SparkSession, d: str) -> DataFrame:
    """Loads and columns, text columns included, with rows outside the dominant masks, or masks unlike those of the reference load."""
    return failed_checks(_counts(spark, d, ALL_CHECKS), table(spark, d, "loads"), ALL_CHECKS, AGREEMENTS).filter(~F.col("check_name").isin(*CASES))


def p5_column_profile(spark: SparkSession, d: str) -> DataFrame:
    return column_profile(mask_profile(_counts(spark, d), CHECKS))


def p5_value_drift(spark: SparkSession, d: str) -> DataFrame:
    return value_drift(_counts(spark, d), table(spark, d, "loads"), CHECKS).select("load_id", "column_name", F.round("drift", 6).alias("drift"))


def _masks(spark: SparkSession, d: str) -> DataFrame:
    return mask_profile(_counts(spark, d, ALL_CHECKS), ALL_CHECKS)


def p5_mask_profile(spark: SparkSession, d: str) -> DataFrame:
    return _masks(spark, d)


def p5_dominant_masks(spark: SparkSession, d: str) -> DataFrame:
    return dominant_masks(_masks(spark, d)).withColumn("share", F.round("share", 9))


def p5_violations(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each load and column outside the column's dominant masks."""
    return pattern_violations(cut_lineage(_masks(spark, d))).withColumn("share", F.round("share", 9))


def p5_rare_masks(spark: SparkSession, d: str) -> DataFrame:
    return rare_masks(cut_lineage(_masks(spark, d))).withColumn("share", F.round("share", 9))


def p5_mask_drift(spark: SparkSession, d: str) -> DataFrame:
    return mask_drift(cut_lineage(_masks(spark, d)), table(spark, d, "loads")).withColumn("mask_divergence", F.round("mask_divergence", 6))


QUERIES = {f.__name__: f for f in (p2_found, p2_low_depth_cells, p2_low_depth_cells_whole, p2_low_depth_filled, p2_location_filled, p5_found, p5_column_profile, p5_value_drift, p5_pattern_checks, p5_mask_profile, p5_dominant_masks, p5_violations, p5_rare_masks, p5_mask_drift)}

_LOCS = ", ".join(f"'{x.lower()}'" for x in LOCATIONS)
_BETA = "case when not isnan(beta) and beta between -0.5 and 100.5 then beta end"
_DEPTH = "case when depth between 1 and 9 then depth end"
_NEAREST = """
select row_id, '{field}' as field, {v} as v, start,
 last_value(case when {v} is not null then {{'p': start, 'i': row_id, 'v': {v}}} end ignore nulls) over (partition by fname, chrom order by start, row_id rows between unbounded preceding and 1 preceding) as p,
 first_value(case when {v} is not null then {{'p': start, 'i': row_id, 'v': {v}}} end ignore nulls) over (partition by fname, chrom order by start, row_id rows between 1 following and unbounded following) as q
from low_depth"""


def _deck(name: str, rows: str, row_id: str, value: str, levels: dict[str, list[str]]) -> str:
    """Common table expressions that fill the cells of one field level by level; the last, `name`, has (id, d, level)."""
    groups = list(dict.fromkeys(g for gs in levels.values() for g in gs))
    over = lambda gs, frame: f"over ({'partition by ' + ', '.join(gs) if gs else ''} order by pos, id rows between {frame})"
    donor = "case when v is not null then {'p': pos, 'i': id, 'v': v} end ignore nulls"
    cols = ", ".join(["id", "pos", *groups])
    out, done = [f"{name}_rows as (select {row_id} as id, start as pos, {''.join(g + ', ' for g in groups)}{value} as v from {rows})"], []
    src = f"{name}_rows"
    for i, (level, gs) in enumerate({**levels, "any": []}.items()):
        if i:
            key = ", ".join([*gs, "pos"])
            rest = "".join(f", null as {g}" for g in groups if g not in gs)
            src = f"{name}_src{i}"
            out.append(f"{src} as (select id, pos, {''.join(g + ', ' for g in groups)}v from (select {key}, min(id) as id, arg_min(v, id) as v{rest} from {name}_rows where v is not null group by {key}) d union all select {cols}, null from {name}_{i - 1} where d is null)")
        out.append(f"""{name}_{i} as (select {cols}, case when q is not null and (p is null or q.p - pos < pos - p.p) then q else p end as d, '{level}' as level from (
select *, last_value({donor}) {over(gs, 'unbounded preceding and 1 preceding')} as p, first_value({donor}) {over(gs, '1 following and unbounded following')} as q from {src}) w where v is null)""")
        done.append(f"select id, d, level from {name}_{i} where d is not null")
    return ",\n".join([*out, f"{name} as ({' union all '.join(done)} union all select id, d, 'none' from {name}_{i} where d is null)"])


_LEVELS = {"sample": ["fname", "chrom"], "stretch": ["chrom"]}
_BETA_CELLS, _DEPTH_CELLS = _deck("beta_cells", "low_depth", "row_id", f"({_BETA})", _LEVELS), _deck("depth_cells", "low_depth", "row_id", f"({_DEPTH})", _LEVELS)
_LOCATION = "case lower(trim(location)) " + " ".join(f"when '{x.lower()}' then '{x}'" for x in LOCATIONS) + " end"
_FILLED = "coalesce({v}, c.d.v) as {f}, {v} is null and c.d.v is not null as {f}_filled, c.d.i as {f}_donor, abs(c.d.p - t.start) as {f}_distance"
_LONG = """
select load_id, 'beta' as column_name, case when isnan(beta) then null else beta end as v, 0 as lo, 100 as hi from formatted_bedgraph
union all select load_id, 'depth', depth, 1, 1000 from formatted_bedgraph
union all select load_id, 'm', m, 0, 1000 from formatted_bedgraph
union all select load_id, 'u', u, 0, 1000 from formatted_bedgraph"""
# masks of the text of each value, as both engines write it down to 0.001; zero has no sign
_MASKS = """with long as (
select load_id, 'beta' as column_name, beta as v, cast(beta + 0.0e0 as varchar) as t, 0 as lo, 100 as hi from formatted_bedgraph
union all select load_id, 'depth', depth, cast(depth as varchar), 1, 1000 from formatted_bedgraph
union all select load_id, 'm', m, cast(m as varchar), 0, 1000 from formatted_bedgraph
union all select load_id, 'u', u, cast(u as varchar), 0, 1000 from formatted_bedgraph
union all select load_id, 'chrom', try_cast(chrom as double), chrom, null, null from formatted_bedgraph
union all select load_id, 'fname', null, fname, null, null from formatted_bedgraph),
t as (select load_id, column_name, case when t is null then 'null' when t = 'nan' then 'NaN' else regexp_replace(regexp_replace(t, '\\p{L}', 'a', 'g'), '\\p{Nd}', '9', 'g') end as mask, case when t <> 'nan' then v end as v, t,
 t is not null and t <> 'nan' and (lo is null or v between lo and hi) as ok from long),
masks as (select load_id, column_name, mask, count(*) as n_rows, greatest(count(distinct t), 1) as n_distinct, count(*) filter (ok) as n_in_range, count(distinct t) filter (ok) as n_distinct_in_range,
 cast(min(v) as double) as min_value, cast(max(v) as double) as max_value from t group by all),
present as (select *, regexp_replace(regexp_replace(mask, '9+', '9', 'g'), 'a+', 'a', 'g') as coarse_mask from masks where mask not in ('null', 'NaN')),
main as (select column_name, coarse_mask, cast(sum(n_rows) as bigint) as n_rows, sum(n_rows) / any_value(total) as share from present join (select column_name, sum(n_rows) as total from present group by 1) c using (column_name) group by 1, 2 having sum(n_rows) / any_value(total) >= 0.01),
outside as (select load_id, p.column_name, cast(sum(case when m.share is null then p.n_rows else 0 end) as bigint) as n_violating, cast(sum(p.n_rows) as bigint) as n_present from present p left join main m on p.column_name = m.column_name and p.coarse_mask = m.coarse_mask group by all),
shares as (select load_id, column_name, mask, n_rows / sum(n_rows) over (partition by load_id, column_name) as s from masks),
pq as (select load_id, column_name, mask, sum(p) as p, sum(q) as q from (select load_id, column_name, mask, s as p, 0 as q from shares join loads using (load_id) where ref_load_id is not null
 union all select l.load_id, column_name, mask, 0, s from shares s join loads l on s.load_id = l.ref_load_id) x group by all),
moved as (select load_id, column_name, sum(case when p > 0 then p * log2(2 * p / (p + q)) else 0 end) / 2 + sum(case when q > 0 then q * log2(2 * q / (p + q)) else 0 end) / 2 as mask_divergence from pq group by all)
"""
_DRIFT = f"""
long as ({_LONG}),
cnt as (select load_id, column_name, v, count(*) as n from long where v between lo and hi group by all),
tot as (select load_id, column_name, sum(n) as t from cnt group by all),
sh as (select load_id, column_name, v, n / t as s from cnt join tot using (load_id, column_name)),
dl as (select l.load_id, column_name, v, s from sh join loads l using (load_id) where ref_load_id is not null
 union all select l.load_id, column_name, v, -s from sh join loads l on sh.load_id = l.ref_load_id),
dv as (select load_id, column_name, v, sum(s) as s from dl group by all),
run as (select load_id, column_name, abs(sum(s) over (partition by load_id, column_name order by v)) as g from dv),
drift as (select load_id, column_name, max(g) as drift from run group by all)"""

SQL = {
    "p2_found": f"""select 'low_depth.beta' as field, row_id from low_depth where ({_BETA}) is null
union all select 'low_depth.depth', row_id from low_depth where ({_DEPTH}) is null
union all select 'annotation.location', site_id from annotation where location is null or lower(trim(location)) not in ({_LOCS})""",
    "p2_low_depth_cells": f"""with c as ({_NEAREST.format(field="low_depth.beta", v=f"({_BETA})")} union all {_NEAREST.format(field="low_depth.depth", v=f"({_DEPTH})")}),
b as (select *, q is not null and (p is null or q.p - start < start - p.p) as fw from c where v is null and (p is not null or q is not null))
select field, row_id, round(cast(case when fw then q.v else p.v end as double), 6) as value, case when fw then q.i else p.i end as donor_id,
 abs(case when fw then q.p else p.p end - start) as distance from b""",
    "p2_low_depth_cells_whole": f"with {_BETA_CELLS}, {_DEPTH_CELLS} "
    + " union all ".join(f"select 'low_depth.{f}' as field, id as row_id, round(cast(d.v as double), 6) as value, d.i as donor_id, abs(d.p - start) as distance, level from {f}_cells join low_depth on id = row_id" for f in ("beta", "depth")),
    "p2_low_depth_filled": f"""with {_BETA_CELLS}, {_DEPTH_CELLS}
select t.row_id, fname, chrom, t.start, {_FILLED.format(v=_DEPTH, f="depth")}, {_FILLED.format(v=_BETA, f="beta").replace("c.d", "b.d")} from low_depth t left join depth_cells c on c.id = t.row_id left join beta_cells b on b.id = t.row_id""",
    "p2_location_filled": f"with {_deck('cells', 'annotation', 'site_id', _LOCATION, {'stretch': ['chrom']})} select t.site_id, {_FILLED.format(v=_LOCATION, f='location')} from annotation t left join cells c on c.id = t.site_id",
    "p5_column_profile": f"""with long as ({_LONG})
select load_id, column_name, count(*) as n_rows, count(*) - count(v) as n_null, count(v) as n_present, count(*) filter (v between lo and hi) as n_in_range,
 count(distinct v) as n_distinct, count(distinct v) filter (v between lo and hi) as n_distinct_in_range, cast(min(v) as double) as min_value, cast(max(v) as double) as max_value
from long group by all""",
    "p5_mask_profile": _MASKS + "select * from masks",
    "p5_dominant_masks": _MASKS + "select column_name, coarse_mask, n_rows, round(share, 9) as share from main",
    "p5_violations": _MASKS + "select load_id, column_name, n_violating, n_present, round(n_violating / n_present, 9) as share from outside",
    "p5_rare_masks": _MASKS
    + """, c as (select *, n_rows / sum(n_rows) over (partition by load_id, column_name) as s from present), d as (select load_id, column_name, count(*) as n_dominant from c where s >= 0.01 group by all)
select load_id, column_name, mask, n_rows, round(s, 9) as share, min_value, max_value, n_dominant from c join d using (load_id, column_name) where s < 0.001""",
    "p5_mask_drift": _MASKS + "select load_id, column_name, round(mask_divergence, 6) as mask_divergence from moved",
    "p5_pattern_checks": _MASKS
    + """select load_id, column_name, 'rare_mask' as check_name from outside where n_violating / n_present > 0.001
union all select load_id, column_name, 'mask_drift' from moved where mask_divergence > 0.1""",
    "p5_value_drift": f"with {_DRIFT} select load_id, column_name, round(drift, 6) as drift from drift",
    "p5_found": f"""with {_DRIFT},
prof as (select load_id, column_name, count(*) as n, count(v) as c, count(*) filter (v is not null and not (v between lo and hi)) as o, count(distinct v) filter (v between lo and hi) as dist from long group by all)
select load_id, column_name, 'nulls' as check_name from prof where n - c > 0.05 * n
union all select load_id, column_name, 'range' from prof where o > 0.01 * c
union all select a.load_id, a.column_name, 'distinct' from prof a join loads l using (load_id) join prof r on r.load_id = l.ref_load_id and r.column_name = a.column_name where 3 * a.dist < r.dist
union all select load_id, column_name, 'drift' from drift where drift > 0.15
union all select load_id, 'depth', 'mismatch' from formatted_bedgraph where m is not null and u is not null and depth is not null group by load_id having count(*) filter (m + u <> depth) > 0.02 * count(*)
union all select load_id, 'beta', 'mismatch' from formatted_bedgraph where m is not null and beta is not null and not isnan(beta) and depth >= 1 group by load_id having count(*) filter (abs(beta - 100.0e0 * m / depth) > 1.0) > 0.02 * count(*)""",
}
