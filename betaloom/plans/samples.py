"""Queries of per-sample statistics, division, merge, sampling plans, training sets and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.values import beta_bin, clip_beta, lab, label, method, trusted_depth
from betaloom.operators import divide as dv
from betaloom.operators import sampling as sm
from betaloom.operators import stats as st
from betaloom.operators.evaluate import pinball, rmse
from betaloom.shared import cut_lineage
from betaloom.sources.tables import table
from betaloom.vocab import BETA_STATS, COUNTS, DEPTH_STATS

SITE = ["chrom", "start", "stop"]
LABS = [*[f"BS{i}" for i in range(1, 5)], *[f"EM{i}" for i in range(1, 5)], "PS1", "PS2", "PS3", "RR1"]
SEED = "_28"


def r6(x: Column, name: str) -> Column:
    return F.round(F.when(~F.isnan(x), x), 6).alias(name)


def _valid(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "formatted_bedgraph")
    return rows.select("fname", F.when(F.col("beta").between(0, 100) & ~F.isnan("beta"), F.col("beta")).alias("beta"), F.when(F.col("depth").between(1, 1000), F.col("depth")).alias("depth"))


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return st.counts(_valid(spark, d), "fname", ["beta", "depth"])


def describe_stats(spark: SparkSession, d: str) -> DataFrame:
    s = st.describe(_counts(spark, d))
    return s.select("fname", "info_col", "count", *[r6(F.col(c), c) for c in ("mean", "std", "min", "max", "cv", "skew", "kurtosis")])


def percentiles(spark: SparkSession, d: str) -> DataFrame:
    return st.percentiles(_counts(spark, d)).select("fname", "info_col", F.col("pct").cast("int").alias("pct"), r6(F.col("value"), "value"))


def mad(spark: SparkSession, d: str) -> DataFrame:
    return st.mad(_counts(spark, d)).select("fname", "info_col", r6(F.col("mad"), "mad"))


def iqr(spark: SparkSession, d: str) -> DataFrame:
    return st.iqr(_counts(spark, d)).select("fname", "info_col", r6(F.col("iqr"), "iqr"))


def histogram_entropy(spark: SparkSession, d: str) -> DataFrame:
    return st.histogram_entropy(_counts(spark, d)).select("fname", "info_col", r6(F.col("entropy"), "entropy"))


def kde_peaks(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(st.kde_peaks(_counts(spark, d)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(F.col(c), c) if t == "double" else F.col(c) for c, t in df.dtypes])


def peak_padding(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sample_metadata").select("fname", *[st.pad_peak(F.col(f"depth_peak{i}")).alias(f"depth_peak{i}") for i in range(1, 6)])


def _full(spark: SparkSession, d: str) -> DataFrame:
    c = cut_lineage(_counts(spark, d))
    return st.full_table(c, c.select("fname").distinct().withColumn("method", method(F.col("fname"))))


def stats_merge(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_full(spark, d))


def sample_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(st.model_metadata(_full(spark, d)))


def _latest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "formatted_bedgraph").select("fname", "chrom", "start", "stop", "m", "u", "depth", "beta", "load_id")
    return dv.latest(rows, ["fname", "chrom", "start"], "load_id")


def latest_rows(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d).filter(F.col("beta").isNull() | ~F.isnan("beta"))


def latest_rows_whole(spark: SparkSession, d: str) -> DataFrame:
    """latest_rows with the sites whose latest beta is NaN, as null."""
    return _latest(spark, d).withColumn("beta", F.nanvl("beta", F.lit(None).cast("double")))


def _divided(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    a = table(spark, d, "annotation").select(*SITE, "strand", "gc_skew_70", "location", "cpg")
    m = table(spark, d, "sample_metadata").select("fname", "beta_q6", "depth_std")
    return dv.divide(dv.with_features(_latest(spark, d), a, m))


_DIVIDED = ["fname", *SITE, "depth", "predicted_beta", "location", "cpg", "beta_q6"]


def divide_control(spark: SparkSession, d: str) -> DataFrame:
    return _divided(spark, d)["control"].select(*_DIVIDED, "actual_beta")


def divide_low(spark: SparkSession, d: str) -> DataFrame:
    return _divided(spark, d)["low"].select(*_DIVIDED, "actual_beta")


def divide_high(spark: SparkSession, d: str) -> DataFrame:
    return _divided(spark, d)["high"].select(_DIVIDED)


def _merged(spark: SparkSession, d: str, origin: DataFrame) -> DataFrame:
    keys = ["fname", *SITE]
    origin = origin.filter(F.col("chrom").isNotNull())
    control = dv.divide(origin.withColumn("predicted_beta", clip_beta(F.col("beta"))))["control"]
    high = dv.latest(table(spark, d, "calibrated_high_depth").select(*keys, "row_id", F.nanvl("actual_beta", F.lit(None).cast("double")).alias("actual_beta")), keys, "row_id")
    low = dv.latest(table(spark, d, "low_depth").select(*keys, "row_id", F.nanvl("beta", F.lit(None).cast("double")).alias("actual_beta")), keys, "row_id")
    return dv.merge(control, high, low, origin, keys)


def merge_result(spark: SparkSession, d: str) -> DataFrame:
    """Control rows, calibrated high rows and low rows with their own beta, beside counts and beta of the origin.

    An origin beta that is NaN is clipped to 100, as the query's SQL has it; in merge_result_whole it is null.
    """
    return _merged(spark, d, _latest(spark, d)).filter("predicted_beta is null or not isnan(predicted_beta)")


def merge_result_whole(spark: SparkSession, d: str) -> DataFrame:
    """merge_result with every row of the three strata; an origin beta that is NaN is null."""
    return _merged(spark, d, latest_rows_whole(spark, d))


def _truth(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "gold_train").filter("beta_pyro is not null and not isnan(beta_pyro)")
    return dv.latest(t.select("label", *SITE, "beta_pyro", "stratum", "in_hcr", "rec_id"), ["label", *SITE], "rec_id")


def presence_plan(spark: SparkSession, d: str) -> DataFrame:
    rows = _latest(spark, d).withColumn("lab", lab(F.col("fname"))).withColumn("label", label(F.col("fname")))
    rows = rows.filter(trusted_depth(F.col("depth"), F.col("lab")))
    return sm.presence_plan(_truth(spark, d), rows, ["label", *SITE], LABS).select("label", *SITE, "beta_pyro", *LABS, "occurrence")


def occurrence(spark: SparkSession, d: str) -> DataFrame:
    return presence_plan(spark, d).groupBy("label", "occurrence").agg(F.count(F.lit(1)).alias("n"))


def stratified_sample_bin(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "calibrated_high_depth").select("row_id", beta_bin(F.col("predicted_beta")).alias("beta_bin"))
    return sm.stratified(c, ["beta_bin"], F.col("row_id"), 500, SEED)


def stratified_sample_bin_occ(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "sampling_plan").select("plan_row_id", F.trim("beta_bin").alias("beta_bin"), "occurrence")
    return sm.stratified(p, ["beta_bin", "occurrence"], F.col("plan_row_id"), 100, SEED)


def _gold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold_train").select("rec_id", "label")


def gold_split(spark: SparkSession, d: str) -> DataFrame:
    return sm.split(_gold(spark, d), F.col("rec_id"), 0.8, SEED)


def five_folds(spark: SparkSession, d: str) -> DataFrame:
    return sm.folds(_gold(spark, d), F.col("rec_id"), 5, SEED)


def fold_selection(spark: SparkSession, d: str) -> DataFrame:
    return sm.fold_selection(five_folds(spark, d), [4]).groupBy("label", "role").agg(F.count(F.lit(1)).alias("n"))


def dataset_build(spark: SparkSession, d: str) -> DataFrame:
    flags = [x.lower() for x in LABS]
    plan = table(spark, d, "sampling_plan").select("plan_row_id", "label", *SITE, "beta_pyro", *[F.col(f).alias(x) for f, x in zip(flags, LABS, strict=True)])
    rows = _latest(spark, d).filter("fname like '%\\_1' and not isnan(beta)")
    rows = rows.select(*SITE, label(F.col("fname")).alias("label"), lab(F.col("fname")).alias("lab"), F.col("beta").alias("predicted_beta"), "depth")
    meta = table(spark, d, "sample_metadata").filter("rep = 1").select("label", "lab", F.upper(F.substring("method", 1, 2)).alias("method"), "beta_q6", "depth_std")
    return sm.dataset(plan, LABS, rows, meta, SITE).select("label", "lab", *SITE, "actual_beta", "predicted_beta", "depth", "method", "beta_q6")


#: What the wide training set has of a plan and of a sample.
_PLAN_COLS, _STAT_COLS = ["plan_row_id", "plan_id", "in_hcr", "beta_bin", "occurrence"], [*DEPTH_STATS, *BETA_STATS]


def dataset_wide(spark: SparkSession, d: str) -> DataFrame:
    """The training set with all columns of the plan and all statistics of the sample; betas that are not numbers are null."""
    flags = [x.lower() for x in LABS]
    plan = table(spark, d, "sampling_plan").withColumnsRenamed(dict(zip(flags, LABS, strict=True)))
    rows = latest_rows_whole(spark, d).filter("fname like '%\\_1'")
    rows = rows.select(*SITE, label(F.col("fname")).alias("label"), lab(F.col("fname")).alias("lab"), F.col("beta").alias("predicted_beta"), "depth")
    meta = table(spark, d, "sample_metadata").filter("rep = 1").select("label", "lab", F.upper(F.substring("method", 1, 2)).alias("method"), *_STAT_COLS)
    return sm.dataset(plan, LABS, rows, meta, SITE).select("label", "lab", *SITE, "actual_beta", "predicted_beta", "depth", "method", *_PLAN_COLS, *_STAT_COLS)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "calibrated_high_depth").filter("predicted_beta is not null and actual_beta is not null and not isnan(predicted_beta) and not isnan(actual_beta)")
    t = _truth(spark, d).withColumn("truth", F.when(F.col("beta_pyro") <= 1, F.col("beta_pyro") * 100).otherwise(F.col("beta_pyro")))
    return c.withColumn("label", label(F.col("fname"))).join(t.select("label", *SITE, "truth"), ["label", *SITE])


def rmse_eval(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d).groupBy("label")
    return s.agg(F.count(F.lit(1)).alias("n"), F.round(rmse(F.col("predicted_beta"), F.col("truth")), 6).alias("rmse_before"), F.round(rmse(F.col("actual_beta"), F.col("truth")), 6).alias("rmse_after"))


def pinball_eval(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("label").agg(F.round(pinball(F.col("truth"), F.col("actual_beta")), 6).alias("pinball"))


QUERIES = {
    f.__name__: f
    for f in (
        describe_stats, percentiles, mad, iqr, histogram_entropy, kde_peaks, peak_padding, stats_merge, sample_statistics, latest_rows, latest_rows_whole, divide_control, divide_low, divide_high, merge_result, merge_result_whole,
        presence_plan, occurrence, stratified_sample_bin, stratified_sample_bin_occ, gold_split, five_folds, fold_selection, dataset_build, dataset_wide, rmse_eval, pinball_eval,
    )
}

_VALUES = """v as (select fname, 'beta' as info_col, beta as x from formatted_bedgraph where beta between 0 and 100 and not isnan(beta)
union all select fname, 'depth', depth from formatted_bedgraph where depth between 1 and 1000)"""


def _last(table_: str, cols: str, keys: str, load: str, rest: list[str]) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in [load, *rest])
    return f"select * exclude (rn) from (select {cols}, row_number() over (partition by {keys} order by {order}) as rn from {table_}) where rn = 1"


_LATEST = f"latest as ({_last('formatted_bedgraph', 'fname, chrom, start, stop, m, u, depth, beta, load_id', 'fname, chrom, start', 'load_id', ['stop', 'm', 'u', 'depth', 'beta'])})"
_CLIP = lambda x: f"case when {x} < 0 then 0.0e0 when {x} > 100 then 100.0e0 else {x} end"
_DIV = f"""with {_LATEST}, j as (select b.fname, b.chrom, b.start, b.stop, depth, {_CLIP("b.beta")} as predicted_beta, location, cpg, beta_q6
from latest b left join annotation a on b.chrom = a.chrom and b.start = a.start and b.stop = a.stop left join sample_metadata s on b.fname = s.fname)
"""
_CTRL = "('chrM', 'lambda', 'pUC19')"
_NULLED = lambda x: f"case when not isnan({x}) then {x} end"


def _merge_sql(beta: str, where: str) -> str:
    """Rows of the three strata beside their origin, each table read and reduced once."""
    return f"""with latest as materialized ({_LATEST.removeprefix("latest as (")}, o as materialized (select fname, chrom, start, stop, u, m, depth, {_CLIP(beta)} as predicted_beta, {_CLIP("beta")} as own from latest where chrom is not null),
h as materialized (select fname, chrom, start, stop, arg_max(actual_beta, row_id) as x from (select fname, chrom, start, stop, row_id, {{'v': {_NULLED("actual_beta")}}} as actual_beta from calibrated_high_depth) c group by all),
l as materialized (select fname, chrom, start, stop, arg_max(beta, row_id) as x from (select fname, chrom, start, stop, row_id, {{'v': {_NULLED("beta")}}} as beta from low_depth) c group by all),
a as materialized (select fname, chrom, start, stop, own as actual_beta from o where chrom in {_CTRL} union all select fname, chrom, start, stop, x.v from h union all select fname, chrom, start, stop, x.v from l)
select a.fname, a.chrom, a.start, a.stop, u, m, depth, predicted_beta, {_CLIP("actual_beta")} as actual_beta
from a left join o on a.fname = o.fname and a.chrom = o.chrom and a.start = o.start and a.stop = o.stop {where}"""


_TRUTH = f"truth as ({_last('gold_train', 'label, chrom, start, stop, beta_pyro, rec_id', 'label, chrom, start, stop', 'rec_id', [])})".replace("from gold_train", "from gold_train where beta_pyro is not null and not isnan(beta_pyro)")
_LAB, _LABEL = "split_part(fname, '_', 1)", "split_part(fname, '_', 2)"
_PLAN = f"""with {_LATEST}, {_TRUTH},
meas as (select distinct {_LABEL} as label, {_LAB} as lab, chrom, start, stop from latest where depth > 10 and depth <= case when fname like 'RR%' then 250 else 150 end),
p as (select t.label, t.chrom, t.start, t.stop, beta_pyro, {", ".join(f"coalesce(bool_or(lab = '{x}'), false) as {x}" for x in LABS)}, count(lab) as occurrence
from truth t left join meas m on t.label = m.label and t.chrom = m.chrom and t.start = m.start and t.stop = m.stop group by t.label, t.chrom, t.start, t.stop, beta_pyro having count(lab) > 0)
"""
_FOLDS = f"""with o as (select rec_id, label, row_number() over (order by md5(concat(rec_id, '{SEED}'))) as rn, count(*) over () as n from gold_train),
f as (select rec_id, label, cast((rn - 1) // (n // 5) as int) as fold from o where (rn - 1) // (n // 5) < 5)
"""
_SCORED = f"""with {_TRUTH}, s as (select t.label, predicted_beta, actual_beta, case when beta_pyro <= 1 then beta_pyro * 100 else beta_pyro end as truth
from calibrated_high_depth c join truth t on {_LABEL.replace("fname", "c.fname")} = t.label and c.chrom = t.chrom and c.start = t.start and c.stop = t.stop
where predicted_beta is not null and actual_beta is not null and not isnan(predicted_beta) and not isnan(actual_beta))
"""
_BIN = "case when predicted_beta is null then null " + " ".join(f"when predicted_beta <= {b + 5} then '{b}-{b + 5}'" for b in range(0, 95, 5)) + " else '95-100' end"
_PICK = "select * exclude (rn) from (select *, row_number() over (partition by {by} order by md5(concat({key}, '{seed}'))) as rn from ({src}) t) where rn <= {n}"

# densities are summed over a grid of 1000 points; peaks of depth must stand 0.01 above the higher of the two dips beside them
_PEAKS = """c as (select fname, info_col, x, count(*) as n from v group by all),
b as (select fname, info_col, min(x) as lo, max(x) as hi, count(*) as total, stddev_samp(x) * case when info_col = 'beta' then 1.0e0 else pow(count(*), -0.2e0) end as w from v group by fname, info_col),
g as (select b.*, i, lo + (hi - lo) / 999 * i as gx from b cross join range(1000) r(i) where w > 0),
y as (select fname, info_col, i, any_value(gx) as gx, sum(n * exp(-0.5e0 * pow((gx - x) / w, 2))) / any_value(total * w) / sqrt(2 * pi()) as y from g join c using (fname, info_col) group by all),
near as (select *, lag(y) over (partition by fname, info_col order by i) as y0, lead(y) over (partition by fname, info_col order by i) as y1 from y),
top as (select * from near where y > y0 and y > y1),
ends as (select t.fname, t.info_col, t.i, t.gx, t.y, max(j.i) filter (j.i < t.i and j.y > t.y) as l, min(j.i) filter (j.i > t.i and j.y > t.y) as r from top t join y j on t.fname = j.fname and t.info_col = j.info_col group by all),
dips as (select e.fname, e.info_col, e.i, e.gx, e.y, min(j.y) filter (j.i between coalesce(l + 1, 0) and e.i) as dl, min(j.y) filter (j.i between e.i and coalesce(r - 1, 999)) as dr from ends e join y j on e.fname = j.fname and e.info_col = j.info_col group by all),
ranked as (select *, row_number() over (partition by fname, info_col order by y desc, i) as rn from dips where info_col = 'beta' or y - greatest(dl, dr) >= 0.01e0),
peaks as (select fname, info_col, cast(count(gx) as double) as peak_num, """ + ", ".join(f"coalesce(nullif(round(max(gx) filter (rn = {i}), 6), 0), -1.0e0) as peak{i}" for i in range(1, 6)) + " from b left join ranked using (fname, info_col) group by all)"
_STATS = f"""with {_VALUES}, {_PEAKS},
s as (select fname, info_col, count(*) as count, avg(x) as mean, stddev_samp(x) as std, min(x) as min, max(x) as max, mad(x) as mad, stddev_samp(x) / avg(x) as cv,
 skewness(x) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0e0)) as skew, kurtosis(x) as kurtosis, {", ".join(f"round(quantile_cont(x, {i / 100}), 6) as q{i}" for i in range(1, 100))} from v group by all),
hist as (select v.fname, v.info_col, least(floor((x - lo) / nullif(hi - lo, 0) * 20), 19) as k, total as t, count(*) as n from v join b using (fname, info_col) group by all),
ent as (select fname, info_col, -sum(n / t * log2(n / t)) + 0.0 as entropy from hist group by all),
iqr as (select fname, info_col, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) as iqr from v group by all),
full_table as (select fname, case when substr(fname, 1, 2) in ('BS', 'EM', 'PS', 'RR') then substr(fname, 1, 2) end as method, info_col, {", ".join(f"q{i}" for i in range(1, 100))}, count,
 {", ".join(f"round({x}, 6) as {x}" for x in ("mean", "std", "min", "max", "mad", "cv", "skew", "kurtosis", "iqr", "entropy"))}, peak_num, {", ".join(f"peak{i}" for i in range(1, 6))}
 from s join ent using (fname, info_col) join iqr using (fname, info_col) join peaks using (fname, info_col))
"""
_PICKED = ", ".join(f"max(cast({'count' if x in COUNTS else x.removeprefix(k + '_')} as double)) filter (info_col = '{k}') as {x}" for k, names in (("beta", BETA_STATS), ("depth", DEPTH_STATS)) for x in names)

SQL = {
    "kde_peaks": f"with {_VALUES}, {_PEAKS} select * from peaks",
    "stats_merge": _STATS + "select * from full_table",
    "sample_statistics": _STATS + f"select fname, method, {_PICKED} from full_table group by fname, method",
    "describe_stats": f"""with {_VALUES} select fname, info_col, count(*) as count, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std, round(min(x), 6) as min, round(max(x), 6) as max,
 round(stddev_samp(x) / avg(x), 6) as cv, round(skewness(x) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0e0)), 6) as skew, round(kurtosis(x), 6) as kurtosis from v group by all""",
    "percentiles": f"""with {_VALUES} select fname, info_col, unnest(range(1, 100))::int as pct, round(unnest(quantile_cont(x, [{", ".join(f"{i / 100}" for i in range(1, 100))}])), 6) as value from v group by fname, info_col""",
    "mad": f"with {_VALUES} select fname, info_col, round(mad(x), 6) as mad from v group by all",
    "iqr": f"with {_VALUES} select fname, info_col, round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 6) as iqr from v group by all",
    "histogram_entropy": f"""with {_VALUES}, e as (select fname, info_col, min(x) as lo, max(x) as hi, count(*) as t from v group by all),
h as (select v.fname, v.info_col, least(floor((x - lo) / nullif(hi - lo, 0) * 20), 19) as b, t, count(*) as n from v join e using (fname, info_col) group by all)
select fname, info_col, round(-sum(n / t * log2(n / t)) + 0.0, 6) as entropy from h group by all""",
    "peak_padding": "select fname, " + ", ".join(f"coalesce(nullif(depth_peak{i}, 0), -1.0) as depth_peak{i}" for i in range(1, 6)) + " from sample_metadata",
    "latest_rows": f"with {_LATEST} select * from latest where beta is null or not isnan(beta)",
    "divide_control": _DIV + f"select *, predicted_beta as actual_beta from j where chrom in {_CTRL}",
    "divide_low": _DIV + f"select *, predicted_beta as actual_beta from j where chrom not in {_CTRL} and depth < 10",
    "divide_high": _DIV + f"select * from j where chrom not in {_CTRL} and depth >= 10",
    "merge_result": _merge_sql("beta", "where predicted_beta is null or not isnan(predicted_beta)"),
    "merge_result_whole": _merge_sql(_NULLED("beta"), "").replace(f"{_CLIP('beta')} as own", f"{_CLIP(_NULLED('beta'))} as own"),
    "latest_rows_whole": f"with {_LATEST} select * replace ({_NULLED('beta')} as beta) from latest",
    "presence_plan": _PLAN + "select * from p",
    "occurrence": _PLAN + "select label, occurrence, count(*) as n from p group by all",
    "stratified_sample_bin": _PICK.format(by="beta_bin", key="row_id", seed=SEED, n=500, src=f"select row_id, {_BIN} as beta_bin from calibrated_high_depth"),
    "stratified_sample_bin_occ": _PICK.format(by="beta_bin, occurrence", key="plan_row_id", seed=SEED, n=100, src="select plan_row_id, trim(beta_bin) as beta_bin, occurrence from sampling_plan"),
    "gold_split": f"""select rec_id, label, case when rn <= round_even(n * 0.8, 0) then 'head' else 'tail' end as part from
 (select rec_id, label, row_number() over (order by md5(concat(rec_id, '{SEED}'))) as rn, count(*) over () as n from gold_train) o""",
    "five_folds": _FOLDS + "select * from f",
    "fold_selection": _FOLDS + "select label, case when fold = 4 then 'validate' else 'train' end as role, count(*) as n from f group by all",
    "dataset_build": f"""with {_LATEST}, p as ({" union all ".join(f"select label, '{x}' as lab, chrom, start, stop, beta_pyro as actual_beta from sampling_plan where {x.lower()}" for x in LABS)}),
m as (select {_LABEL} as label, {_LAB} as lab, chrom, start, stop, beta as predicted_beta, depth from latest where fname like '%\\_1' escape '\\' and (beta is null or not isnan(beta))),
s as (select label, lab, upper(substr(method, 1, 2)) as method, beta_q6 from sample_metadata where rep = 1)
select p.label, p.lab, p.chrom, p.start, p.stop, actual_beta, predicted_beta, depth, method, beta_q6 from p left join m on p.label = m.label and p.lab = m.lab and p.chrom = m.chrom and p.start = m.start and p.stop = m.stop
left join s on p.label = s.label and p.lab = s.lab""",
    "dataset_wide": f"""with {_LATEST}, p as ({" union all ".join(f"select label, '{x}' as lab, chrom, start, stop, beta_pyro as actual_beta, {', '.join(_PLAN_COLS)} from sampling_plan where {x.lower()}" for x in LABS)}),
m as (select {_LABEL} as label, {_LAB} as lab, chrom, start, stop, {_NULLED("beta")} as predicted_beta, depth from latest where fname like '%\\_1' escape '\\'),
s as (select label, lab, upper(substr(method, 1, 2)) as method, {", ".join(_STAT_COLS)} from sample_metadata where rep = 1)
select p.label, p.lab, p.chrom, p.start, p.stop, actual_beta, predicted_beta, depth, method, {", ".join(_PLAN_COLS)}, {", ".join(_STAT_COLS)} from p left join m on p.label = m.label and p.lab = m.lab and p.chrom = m.chrom and p.start = m.start and p.stop = m.stop
 left join s on p.label = s.label and p.lab = s.lab""",
    "rmse_eval": _SCORED + "select label, count(*) as n, round(sqrt(avg(pow(predicted_beta - truth, 2))), 6) as rmse_before, round(sqrt(avg(pow(actual_beta - truth, 2))), 6) as rmse_after from s group by 1",
    "pinball_eval": _SCORED + "select label, round(avg(greatest(0.5e0 * (truth - actual_beta), -0.5e0 * (truth - actual_beta))), 6) as pinball from s group by 1",
}
