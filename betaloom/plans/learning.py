"""Queries of the regression operators. Models are fitted on samples bounded per beta bin, those of the search on all rows; scoring and evaluation cover all rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.sequence import neighbours
from betaloom.functions.values import beta_bin
from betaloom.operators import models as ml
from betaloom.operators.sampling import stratified
from betaloom.plans.sites import ORIENTED
from betaloom.shared import cut_lineage, sized
from betaloom.sources.tables import table
from betaloom.vocab import BASES, BETA_STATS, DEPTH_STATS

#: Training rows taken of each 5-wide beta bin, at most, by all but the search.
PER_BIN = 300
ROLES = ml.Roles(["predicted_beta", "depth", "gc_skew_70", "cpg_gc_ratio_70", "shannonentropy_70", "bwt_ratio_70"], ["location", "cpg", *BASES], ["promoter", "enhancer"])
SITE = ["chrom", "start", "stop"]


def _features(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    a = table(spark, d, "annotation")
    a = a.select(*SITE, "gc_skew_70", "cpg_gc_ratio_70", "shannonentropy_70", "bwt_ratio_70", "cpg", "location", "promoter", "enhancer", *[c.alias(k) for k, c in neighbours(F.upper("seq_5")).items()])
    return ml.prepare(rows.join(a, SITE, "left"), ROLES)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "calibrated_high_depth").filter("predicted_beta is not null and actual_beta is not null and not isnan(predicted_beta) and not isnan(actual_beta)")
    return c.select("row_id", *SITE, "depth", "predicted_beta", "actual_beta", beta_bin(F.col("predicted_beta")).alias("beta_bin"))


def _train(spark: SparkSession, d: str) -> DataFrame:
    """All labelled rows."""
    return _features(spark, d, _labelled(spark, d))


def _sample(spark: SparkSession, d: str) -> DataFrame:
    return cut_lineage(_features(spark, d, stratified(_labelled(spark, d), ["beta_bin"], F.col("row_id"), PER_BIN, "_28")))


def _unused(spark: SparkSession, d: str, fitted: DataFrame) -> DataFrame:
    """All labelled rows that a model was not fitted on."""
    return _features(spark, d, _labelled(spark, d).join(sized(fitted.select("row_id")), "row_id", "left_anti"))


def prepared_features(spark: SparkSession, d: str) -> DataFrame:
    """What models see of the calibrated rows: numbers without gaps, categories as text, flags as numbers."""
    rows = table(spark, d, "calibrated_high_depth").select("row_id", *SITE, "depth", "predicted_beta")
    return _features(spark, d, rows).select("row_id", *ROLES.numbers, *ROLES.categories, *ROLES.flags)


def feature_roles(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "sample_metadata")
    return ml.feature_roles(m, [c for c in m.columns if c != "fname"])


def gbt_median_impute(spark: SparkSession, d: str) -> DataFrame:
    """Low-depth rows with the conditional median of their beta as actual_beta."""
    t = _sample(spark, d).withColumn("held", ml.part(F.col("row_id"), 5) == 0)
    model = ml.median_model(t, ROLES, "actual_beta", trees=10, depth=4, valid="held")
    low = table(spark, d, "low_depth").select("row_id", *SITE, "depth", F.when(F.col("beta").between(-0.5, 100.5) & ~F.isnan("beta"), F.col("beta")).alias("predicted_beta"))
    return model.transform(_features(spark, d, low)).select("row_id", F.round("prediction", 6).alias("actual_beta"))


def calibration(spark: SparkSession, d: str) -> tuple[DataFrame, dict, PipelineModel]:
    """Rows to calibrate, with the columns that models use, and the models."""
    models, top, _ = ml.stacked(_sample(spark, d), ROLES, "actual_beta", "row_id", folds=2, trees=5)
    rows = table(spark, d, "calibrated_high_depth").select("row_id", *SITE, "depth", "predicted_beta")
    return _features(spark, d, rows), models, top


def stacked_calibrate(spark: SparkSession, d: str) -> DataFrame:
    """All calibrated rows scored by the members and by the ensemble of them."""
    rows, models, top = calibration(spark, d)
    return ml.predict_stacked(rows, models, top).select("row_id", *[F.round(c, 6).alias(c) for c in (*models, "ensemble")])


def leaderboard(spark: SparkSession, d: str) -> DataFrame:
    """Errors over all labelled rows: rows of the training sample by predictions out of fold, on both levels, the others by the fitted models."""
    t = _sample(spark, d)
    models, top, table_ = ml.stacked(t, ROLES, "actual_beta", "row_id", folds=2, trees=5)
    names = [*models, "ensemble", "predicted_beta"]
    scored = [table_, ml.predict_stacked(_unused(spark, d, t), models, top)]
    return ml.leaderboard(scored[0].select("actual_beta", *names).unionByName(scored[1].select("actual_beta", *names)), "actual_beta", names)


def ensemble_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Errors of the ensemble over all labelled rows that it was not fitted on."""
    t = _sample(spark, d)
    models, top, _ = ml.stacked(t, ROLES, "actual_beta", "row_id", folds=2, trees=5)
    return ml.evaluation(ml.predict_stacked(_unused(spark, d, t), models, top), "actual_beta", "ensemble")


def permutation_importance(spark: SparkSession, d: str) -> DataFrame:
    """Over all labelled rows but those the model is fitted on."""
    fit = _sample(spark, d).filter(ml.part(F.col("row_id"), 5) != 0)
    model = ml.median_model(fit, ROLES, "actual_beta", trees=5, depth=4)
    return ml.permutation_importance(model, _unused(spark, d, fit), "actual_beta", [*ROLES.numbers, "location", "cpg"], "row_id")


def hpo_trials(spark: SparkSession, d: str) -> DataFrame:
    """Models are fitted and their losses taken on all labelled rows."""
    return ml.search(_train(spark, d), ROLES, "actual_beta", "row_id", trials=3)[1]


QUERIES = {f.__name__: f for f in (prepared_features, feature_roles, gbt_median_impute, stacked_calibrate, leaderboard, ensemble_evaluation, permutation_importance, hpo_trials)}

_KINDS = {"lab": "string", "label": "string", "method": "string", "rep": "number"}
_NAMES = ["lab", "label", "rep", "method", *DEPTH_STATS, *BETA_STATS]
_NUM = lambda x: f"coalesce(case when not isnan(cast({x} as double)) then cast({x} as double) end, 0.0e0)"
SQL = {
    "prepared_features": "select row_id, "
    + ", ".join([f"{_NUM(c)} as {c}" for c in ROLES.numbers] + [f"coalesce({c}, '') as {c}" for c in ("location", "cpg")] + [f"coalesce(substr({ORIENTED}, {i + 1}, 1), '') as {k}" for k, i in BASES.items()] + [f"coalesce(cast({c} as double), 0.0e0) as {c}" for c in ROLES.flags])
    + " from calibrated_high_depth c left join annotation a on c.chrom = a.chrom and c.start = a.start and c.stop = a.stop",
    "feature_roles": " union all ".join(
        f"select '{c}' as name, case when count(distinct cast({c} as varchar)) <= 1 then 'constant' when count(distinct cast({c} as varchar)) = 2 then 'flag' else '{'category' if _KINDS.get(c) == 'string' else 'number'}' end as role from sample_metadata" for c in _NAMES
    )
}
