"""Queries that must cover all rows of their input, on the smallest tables."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from betaloom.functions.sequence import _bwt_runs
from betaloom.plans import learning
from betaloom.plans.fixtures import SEQS, view

DATA = "/root/testdata/sf0.001"


def test_rows_with_nan_are_kept_as_null(spark):
    q = entry.queries()
    low = spark.read.parquet(f"{DATA}/low_depth.parquet")
    nan = low.filter(F.isnan("beta")).count()
    clipped = q["clipped_beta_whole"](spark, DATA)
    assert nan > 0 and clipped.count() == low.count() == q["clipped_beta"](spark, DATA).count() + nan
    assert clipped.filter("beta is null").count() == low.filter("beta is null or isnan(beta)").count()
    sites = spark.read.parquet(f"{DATA}/formatted_bedgraph.parquet").select("fname", "chrom", "start").distinct().count()
    latest = q["latest_rows_whole"](spark, DATA)
    assert latest.count() == sites > q["latest_rows"](spark, DATA).count() and latest.filter(F.isnan("beta")).count() == 0
    keys = ["fname", "chrom", "start"]
    unknown = latest.filter("beta is null").select(keys)
    merged, as_sql = q["merge_result_whole"](spark, DATA), q["merge_result"](spark, DATA)
    assert merged.count() == as_sql.count()
    assert merged.join(unknown, keys).filter("predicted_beta is not null").count() == 0 < as_sql.join(unknown, keys).filter("predicted_beta is not null").count()


def test_evaluation_covers_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(learning, "PER_BIN", 12)
    labelled = spark.read.parquet(f"{DATA}/calibrated_high_depth.parquet").filter("predicted_beta is not null and actual_beta is not null and not isnan(predicted_beta) and not isnan(actual_beta)")
    seen = {}
    for name in ("leaderboard", "permutation_importance"):
        f = getattr(learning.ml, name)
        monkeypatch.setattr(learning.ml, name, lambda *a, f=f, name=name: seen.update({name: a[0 if name == "leaderboard" else 1]}) or f(*a))
    got = {r["model"]: r["rmse"] for r in learning.leaderboard(spark, DATA).collect()}
    raw = labelled.agg(F.sqrt(F.avg((F.col("actual_beta") - F.col("predicted_beta")) ** 2))).first()[0]
    assert seen["leaderboard"].count() == labelled.count() and abs(got["predicted_beta"] - raw) < 1e-9
    learning.permutation_importance(spark, DATA)
    assert labelled.count() - 20 * 12 < seen["permutation_importance"].count() < labelled.count()


def test_bwt_ratio_covers_the_whole_flank(spark):
    q = entry.queries()
    seqs = view(spark, DATA, SEQS)
    got = {(r["chrom"], r["start"]): r["bwt_ratio"] for r in q["bwt_ratio"](spark, DATA).collect()}
    some = seqs.orderBy("start").limit(5).collect()
    assert len(got) == seqs.count() and all(abs(got[r["chrom"], r["start"]] - _bwt_runs(r["seq"].upper()) / 142) < 1e-12 for r in some)
    whole = q["annotate_sites_whole"](spark, DATA)
    assert whole.count() == q["annotate_sites"](spark, DATA).count() and whole.filter("bwt_ratio_70 is null").count() == 0 and "cpg_gc_ratio_70" in whole.columns


def test_cells_of_all_levels(spark):
    q = entry.queries()
    whole, first, filled = (q[n](spark, DATA) for n in ("p2_low_depth_cells_whole", "p2_low_depth_cells", "p2_low_depth_filled"))
    n = whole.count()
    assert n == filled.agg(F.count_if("beta_filled") + F.count_if("depth_filled")).first()[0] and n > first.count() == whole.filter("level = 'sample'").count()


def test_trials_have_the_losses_of_their_trees(spark, monkeypatch):
    """On a size where location has more values than the bins drawn; the query has no SQL, so each loss is computed again row by row."""
    d, fit, fitted = "/root/testdata/sf0.01", learning.ml.median_model, []
    monkeypatch.setattr(learning.ml, "median_model", lambda train, *a, **k: fitted.append((train, m := fit(train, *a, **k))) or m)
    trials = sorted(learning.hpo_trials(spark, d).collect())
    sample = learning._train(spark, d)
    assert [t["trial"] for t in trials] == [0, 1, 2] and len(fitted) == 3 and sample.select("location").distinct().count() > 32
    for t, (train, model) in zip(trials, fitted, strict=True):
        held = model.transform(sample.join(train.select("row_id"), "row_id", "left_anti")).select("actual_beta", "prediction").collect()
        assert len(held) + train.count() == sample.count() and len(held) > 0
        assert abs(t["loss"] - sum(abs(y - p) for y, p in held) / 2 / len(held)) < 1e-9
        assert t["bins"] == model.stages[-1].getMaxBins() > train.select("location").distinct().count()


def test_trials_are_fitted_on_all_labelled_rows(spark, monkeypatch):
    labelled = spark.read.parquet(f"{DATA}/calibrated_high_depth.parquet").filter("predicted_beta is not null and actual_beta is not null and not isnan(predicted_beta) and not isnan(actual_beta)")
    monkeypatch.setattr(learning, "PER_BIN", 12)
    fit, seen = learning.ml.median_model, []
    monkeypatch.setattr(learning.ml, "median_model", lambda train, *a, **k: seen.append(train.select("row_id").collect()) or fit(train, *a, **k))
    learning.hpo_trials(spark, DATA)
    want = sorted(labelled.filter(learning.ml.part(F.col("row_id"), 5) != 0).select("row_id").collect())  # the others are held for the loss
    assert len(seen) == 3 and len(want) > 20 * 12 and all(sorted(x) == want for x in seen)
