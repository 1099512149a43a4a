"""Command line: python -m betaloom.cli COMMAND ...; one Spark job per command, tables in and out as Parquet."""

from __future__ import annotations

import argparse
import importlib

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.sequence import bwt_ratio, neighbours
from betaloom.functions.values import beta_bin, lab, label, method, trusted_depth
from betaloom.operators import divide as dv
from betaloom.operators import models as ml
from betaloom.operators import sampling as sm
from betaloom.operators import stats as st
from betaloom.operators.annotate import annotate, sequence_features, short_name, summarise_overlaps
from betaloom.operators.checks import not_empty, not_null, require_columns
from betaloom.operators.intervals import flank, overlap_join, tile_lookup
from betaloom.plans.learning import ROLES
from betaloom.shared import cut_lineage
from betaloom.sources.scans import fasta_tiles, pick_files, read_fasta, read_tracks, scan_parquet
from betaloom.sources.sinks import complete, exists, free, stage, write_parquet, write_tsv, write_twice
from betaloom.vocab import BETA_STATS, CONTIGS, CONTROLS, DEPTH_STATS

SITE = ["chrom", "start", "stop"]
#: What models may be trained on: site features, and the statistics of the sample.
ALL_ROLES = ml.Roles([*ROLES.numbers, *DEPTH_STATS, *BETA_STATS], [*ROLES.categories, "method"], ROLES.flags)


def _sites(rows: DataFrame) -> DataFrame:
    """The reference's column name `end` is read as stop."""
    return rows.withColumnRenamed("end", "stop")


def _model_input(rows: DataFrame, roles: ml.Roles = ROLES) -> tuple[DataFrame, ml.Roles]:
    """rows with those columns that models use, as far as they are there, and their roles; neighbours of the cytosine are taken from seq_5."""
    if "seq_5" in rows.columns:
        rows = rows.withColumns({k: c for k, c in neighbours(F.upper("seq_5")).items() if k not in rows.columns})
    used = ml.present(roles, rows)
    return ml.prepare(require_columns(rows, ["predicted_beta", "depth"]), used), used


def _load(path: str) -> PipelineModel:
    if not exists(SparkSession.getActiveSession(), path):
        raise FileNotFoundError(f"no model at {path}")
    return PipelineModel.load(path)


def _callable(name: str | None, default):  # noqa: ANN001, ANN202
    """`module:function` of the caller's, in place of a built-in measure."""
    if not name:
        return default
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def run_annotate(spark: SparkSession, a: argparse.Namespace) -> None:
    table, text = f"{a.output}/{a.name}.parquet", f"{a.output}/{a.name}.tsv"
    todo = free(spark, a.on_exists, table, text)
    if table in todo:
        rows = pick_files(_sites(scan_parquet(spark, *a.input)), a.whitelist or ())
        sites = not_empty(cut_lineage(rows.filter(F.col("chrom").isin(CONTIGS) & (F.col("depth") >= a.cutoff)).select(SITE).distinct()), "site set")
        tiles = fasta_tiles(read_fasta(spark, a.genome), a.tile) if a.genome.endswith((".fa", ".fasta", ".fna")) else spark.read.parquet(a.genome)
        wide = flank(sites.filter("start >= 70"), 70, 70)
        seqs = tile_lookup(wide, tiles, a.tile).select("chrom", (F.col("start") + 70).alias("start"), (F.col("stop") - 70).alias("stop"), "seq")
        made = lambda: not_null(sequence_features(seqs, complexity=_callable(a.complexity, bwt_ratio)))
        features = stage(spark, f"{a.stages}/{a.name}.features.parquet", made) if a.stages else cut_lineage(made())
        pairs = overlap_join(sites.join(features.select(*SITE, "strand"), SITE, "left"), read_tracks(spark, a.features), a.strand)
        summary = summarise_overlaps(pairs.select(*SITE, F.col("f_gene_symbol").alias("gene_symbol"), short_name(F.col("f_track")).alias("anno")))
        write_parquet(annotate(sites, features, summary), table, a.on_exists)
    if text in todo:
        write_tsv(spark.read.parquet(table), text, a.on_exists)


def run_stat(spark: SparkSession, a: argparse.Namespace) -> None:
    table, meta = f"{a.output}.stats.parquet", f"{a.output}.metadata.parquet"
    todo = free(spark, a.on_exists, table, f"{a.output}.stats.csv", *([meta] if a.peaks >= 5 else []))
    if table in todo:
        c = cut_lineage(st.counts(require_columns(scan_parquet(spark, *a.input), ["beta", "depth"]), "fname", ["beta", "depth"]))
        named = c.select("fname").distinct().withColumn("method", F.lit(a.method) if a.method else method(F.col("fname")))
        write_twice(st.full_table(c, named, a.peaks), f"{a.output}.stats", a.on_exists)
    if meta in todo:
        write_parquet(st.model_metadata(spark.read.parquet(table)), meta, a.on_exists)


def run_divide(spark: SparkSession, a: argparse.Namespace) -> None:
    paths = {name: f"{a.output}/{name}.parquet" for name in ("control", "low", "high")}
    todo = free(spark, a.on_exists, *paths.values())
    rows = cut_lineage(dv.with_features(_sites(scan_parquet(spark, *a.input)), spark.read.parquet(a.annotation), spark.read.parquet(a.metadata), validate=True))
    for name, part in dv.divide(rows, a.cutoff, a.controls.split(",")).items():
        if paths[name] in todo and not (name == "control" and a.skip_empty_control and part.isEmpty()):
            write_parquet(part, paths[name], a.on_exists)


def run_train(spark: SparkSession, a: argparse.Namespace) -> None:
    """Members, ensemble, leaderboard, evaluation and importance. Rows for validation are files named by --folds, or a fifth of all."""
    if not free(spark, a.on_exists, a.output):
        return
    rows = scan_parquet(spark, *a.input).filter("actual_beta is not null")
    rows = rows.withColumn("_key", F.xxhash64("label", *SITE, "lab"))
    held = sm.validates(F.col("fname"), a.folds) if a.folds else ml.part(F.col("_key"), 5, 30) == 0
    data, roles = _model_input(rows.withColumn("_held", held), ALL_ROLES)
    data = cut_lineage(data)
    train, valid = not_empty(data.filter("not _held"), "training set"), not_empty(data.filter("_held"), "validation set")
    models, top, _ = ml.stacked(train, roles, "actual_beta", "_key", trees=a.trees)
    for name, m in {**models, "ensemble": top}.items():
        m.write().overwrite().save(f"{a.output}/{name}")
    scored = cut_lineage(ml.predict_stacked(valid, models, top))
    write_csv = lambda df, name, sep: df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", sep).csv(f"{a.output}/{name}")  # noqa: E731 a few rows each
    write_csv(ml.evaluation(scored, "actual_beta", "ensemble"), "evaluate_stats.tsv", "\t")
    write_csv(ml.leaderboard(scored, "actual_beta", [*models, "ensemble"]), "leaderboard.csv", ",")

    class Ensemble:
        @staticmethod
        def transform(df: DataFrame) -> DataFrame:
            return ml.predict_stacked(df, models, top)

    columns = [*roles.numbers, *roles.flags, *roles.categories]
    write_csv(ml.permutation_importance(Ensemble, valid, "actual_beta", columns, "_key", "ensemble", a.shuffles).orderBy(F.desc("importance")), "feature_importance.csv", ",")


def run_calibrate(spark: SparkSession, a: argparse.Namespace) -> None:
    if not free(spark, a.on_exists, a.output):
        return
    names = list(ml.learners("actual_beta"))
    if a.member not in (*names, "ensemble"):
        raise ValueError(f"no member {a.member!r}; there are {', '.join((*names, 'ensemble'))}")
    models, top = {n: _load(f"{a.model}/{n}") for n in names}, _load(f"{a.model}/ensemble")
    rows, _ = _model_input(pick_files(scan_parquet(spark, *a.input), a.whitelist or ()), ALL_ROLES)
    require_columns(rows, [c for c in ml.inputs(models[names[0]]) if not c.endswith("_ix")])
    out = ml.predict_stacked(rows, models, top)
    write_parquet(out.withColumn("actual_beta", F.col(a.member)).drop(*names, "ensemble"), a.output, a.on_exists)


def run_impute(spark: SparkSession, a: argparse.Namespace) -> None:
    todo = free(spark, a.on_exists, a.output, f"{a.output}.trials")
    if a.output not in todo:
        return
    high = sm.stratified(spark.read.parquet(a.high).withColumn("_bin", beta_bin(F.col("predicted_beta"))), ["_bin"], F.concat_ws(":", "chrom", "start"), a.per_bin, "_28")
    train, roles = _model_input(high)
    train = cut_lineage(train.withColumn("_key", F.xxhash64("chrom", "start")))
    best, trials = ml.search(train, roles, "actual_beta", "_key", a.trials, seconds=a.seconds)
    model = ml.median_model(train.withColumn("_held", ml.part(F.col("_key"), 5) == 0), roles, "actual_beta", valid="_held", **best)
    low, _ = _model_input(spark.read.parquet(a.low).drop("actual_beta"))
    write_parquet(model.transform(low).withColumnRenamed("prediction", "actual_beta").select(*[c for c in ("fname", *SITE) if c in low.columns], "actual_beta"), a.output, a.on_exists)
    write_parquet(trials, f"{a.output}.trials", a.on_exists)


def run_merge(spark: SparkSession, a: argparse.Namespace) -> None:
    """A control table that is not there stands for no control rows."""
    if not free(spark, a.on_exists, a.output):
        return
    high, low = (spark.read.parquet(p) for p in (a.high, a.low))
    control = spark.read.parquet(a.control) if complete(spark, a.control) else high.limit(0)
    origin = _sites(scan_parquet(spark, a.origin))
    origin = origin.withColumn("beta", F.nanvl("beta", F.lit(None).cast("double")))
    keys = ["fname", *SITE] if all("fname" in d.columns for d in (control, high, low)) else SITE
    write_parquet(dv.merge(control, high, low, origin, keys).orderBy(*keys), a.output, a.on_exists, codec="snappy")


def run_plan(spark: SparkSession, a: argparse.Namespace) -> None:
    """Each label is split, sampled and folded by itself."""
    gold_path, folds_path = f"{a.output}/gold", f"{a.output}/folds"
    todo = free(spark, a.on_exists, gold_path, folds_path)
    rows = _sites(scan_parquet(spark, *a.input)).withColumn("lab", lab(F.col("fname"))).withColumn("label", label(F.col("fname")))
    labs = a.labs.split(",")
    plan = sm.presence_plan(spark.read.parquet(a.truth), rows.filter(trusted_depth(F.col("depth"), F.col("lab"))), ["label", *SITE], labs)
    plan = cut_lineage(plan.withColumn("beta_bin", beta_bin(F.col("beta_pyro"))))
    key = F.concat_ws(":", "label", "chrom", "start")
    if gold_path in todo:
        write_parquet(sm.split(plan.filter("stratum = 'gold'"), key, 0.8, "_28", ["label"]), gold_path, a.on_exists, partition_by=("part",))
    if folds_path in todo:
        silver = sm.stratified(plan.filter("stratum = 'silver'"), ["label", "beta_bin", "occurrence"], key, a.n, "_28")
        write_parquet(sm.folds(cut_lineage(silver), key, 5, "_28", ["label"]), folds_path, a.on_exists, partition_by=("fold",))


def run_sample(spark: SparkSession, a: argparse.Namespace) -> None:
    """Measurements are those of the first replicate of each lab and label."""
    if not free(spark, a.on_exists, a.output):
        return
    named = lambda df: df.filter("fname like '%\\_1'").withColumn("lab", lab(F.col("fname"))).withColumn("label", label(F.col("fname")))
    rows = named(_sites(scan_parquet(spark, *a.input))).withColumnRenamed("beta", "predicted_beta")
    out = sm.dataset(spark.read.parquet(*a.plan), a.labs.split(","), rows.select(*SITE, "label", "lab", "predicted_beta", "depth"), named(spark.read.parquet(a.metadata)).drop("fname"), SITE)
    if a.annotation:
        known = [c for c in spark.read.parquet(a.annotation).columns if c not in SITE]
        out = out.drop(*known).join(spark.read.parquet(a.annotation), SITE, "left")
    write_parquet(out, a.output, a.on_exists)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="betaloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name, job, *options):  # noqa: ANN001, ANN202
        c = sub.add_parser(name)
        c.set_defaults(job=job)
        c.add_argument("-o", "--output", required=True)
        c.add_argument("--on-exists", choices=["error", "force", "skip"], default="error")
        for flags, kw in options:
            c.add_argument(*flags, **kw)

    need, some = {"required": True}, {"required": True, "nargs": "+"}
    i = (("-i", "--input"), some)
    white = (("-w", "--whitelist"), {"nargs": "*"})
    labs = (("--labs",), {"default": "BS1,BS2,BS3,BS4,EM1,EM2,EM3,EM4,PS1,PS2,PS3,RR1"})
    add("annotate", run_annotate, i, white, (("-n", "--name"), need), (("-r", "--genome"), need), (("--features",), need), (("--tile",), {"type": int, "default": 1024}), (("-s", "--strand"), {"action": "store_true"}), (("-x", "--complexity"), {"help": "module:function from a column of sequences to a measure, in place of the BWT ratio"}), (("--stages",), {"help": "folder for sequence features, from which a run that broke off goes on"}), (("--cutoff",), {"type": int, "default": 5}))
    add("stat", run_stat, i, (("-m", "--method"), {"choices": ["BS", "EM", "PS", "RR"]}), (("-n", "--peaks"), {"type": int, "default": 5}))
    add("divide", run_divide, i, (("-a", "--annotation"), need), (("-m", "--metadata"), need), (("--controls",), {"default": ",".join(CONTROLS)}), (("-c", "--cutoff"), {"type": int, "default": 10}), (("--skip-empty-control",), {"action": "store_true"}))
    add("train", run_train, i, (("-f", "--folds"), {"help": "files for validation: a digit, or one for each label"}), (("--trees",), {"type": int, "default": 10}), (("--shuffles",), {"type": int, "default": 1}))
    add("calibrate", run_calibrate, i, white, (("-md", "--model"), need), (("-mn", "--member"), {"default": "ensemble"}))
    add("impute", run_impute, (("-hi", "--high"), need), (("-li", "--low"), need), (("-n", "--trials"), {"type": int, "default": 100}), (("--seconds",), {"type": float, "help": "no trial begins after that time"}), (("--per-bin",), {"type": int, "default": 5000}))
    add("merge", run_merge, (("-oi", "--origin"), need), (("-ci", "--control"), need), (("-li", "--low"), need), (("-hi", "--high"), need))
    add("plan", run_plan, i, labs, (("-r", "--truth"), need), (("-n",), {"type": int, "default": 500}))
    add("sample", run_sample, i, labs, (("-p", "--plan"), some), (("-m", "--metadata"), need), (("-a", "--annotation"), {"help": "sequence features and overlaps, without which nothing can be trained on the result"}))
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.job(SparkSession.builder.appName(f"betaloom {args.command}").getOrCreate(), args)


if __name__ == "__main__":
    main()
