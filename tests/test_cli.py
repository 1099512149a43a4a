"""The chain of commands on a small genome: what one writes, the next can read."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from betaloom import cli
from betaloom.operators.models import learners
from betaloom.plans.learning import ROLES
from betaloom.sources.scans import read_fasta
from betaloom.vocab import BETA_STATS, DEPTH_STATS


def run(spark, *args):
    a = cli.parser().parse_args([str(x) for x in args])
    a.job(spark, a)


def test_annotate_to_impute(spark, tmp_path):
    rnd = random.Random(1)
    genome = "".join(rnd.choice("ACGT") for _ in range(4096))
    starts = [i for i in range(100, 3900) if genome[i] in "CG"][::20]
    t = tmp_path
    pd.DataFrame({"chrom": "chr1", "tile_no": range(4), "tile_seq": [genome[i * 1024 : (i + 1) * 1024] for i in range(4)]}).to_parquet(t / "genome.parquet")
    pd.DataFrame({"chrom": ["chr1"], "start": [0], "stop": [2000], "strand": ["*"], "track": ["hg38_genes_exons"], "gene_symbol": ["G"]}).to_parquet(t / "features.parquet")
    depth = [30 if i % 3 else 6 for i in range(len(starts))]
    m = [rnd.randint(0, d) for d in depth]
    rows = pd.DataFrame({"chrom": "chr1", "start": starts, "end": [x + 1 for x in starts], "m": m, "depth": depth})
    rows.assign(u=rows.depth - rows.m, beta=100.0 * rows.m / rows.depth).to_parquet(t / "BS1_D5_1.parquet")
    pd.DataFrame({"fname": ["BS1_D5_1"], "beta_q6": [1.0]}).to_parquet(t / "meta.parquet")
    pd.DataFrame({"chrom": "chr1", "start": starts, "stop": [x + 1 for x in starts], "label": "D5", "beta_pyro": [float(x % 101) for x in starts], "BS1": True}).to_parquet(t / "plan.parquet")
    site, bed = t / "anno/x.parquet", t / "BS1_D5_1.parquet"
    run(spark, "annotate", "-i", bed, "-o", t / "anno", "-n", "x", "-r", t / "genome.parquet", "--features", t / "features.parquet")
    got = spark.read.parquet(str(site))
    assert got.count() == len(starts) and got.filter("bwt_ratio_70 > 0 and bwt_ratio_70 < 1").count() == len(starts)
    run(spark, "divide", "-i", bed, "-o", t / "div", "-a", site, "-m", t / "meta.parquet")
    run(spark, "sample", "-i", bed, "-o", t / "set", "-p", t / "plan.parquet", "-m", t / "meta.parquet", "--labs", "BS1", "-a", site)
    run(spark, "train", "-i", t / "set", "-o", t / "model")
    run(spark, "calibrate", "-i", t / "div/high.parquet", "-o", t / "high", "-md", t / "model")
    run(spark, "impute", "-hi", t / "high", "-li", t / "div/low.parquet", "-o", t / "low", "-n", 1)
    high, low = spark.read.parquet(str(t / "high")), spark.read.parquet(str(t / "low"))
    assert high.filter("actual_beta is not null").count() + low.filter("actual_beta is not null").count() == len(starts)
    assert set(ROLES.categories) <= set(high.columns) and (t / "model/leaderboard.csv").exists() and all((t / "model" / n).exists() for n in learners("x"))


def reverse_share(seq):
    """A measure of the caller's own."""
    return F.length(seq) / F.lit(1000.0)


def test_fasta_lines_keep_their_place(spark, tmp_path):
    rnd = random.Random(2)
    contigs = {f"c{i}": "".join(rnd.choice("ACGTn") for _ in range(rnd.randint(0, 900))) for i in range(30)}
    f = tmp_path / "x.fa"
    f.write_text("".join(f">{n} about {n}\n" + "".join(s[i : i + 61] + "\n" for i in range(0, len(s), 61)) for n, s in contigs.items()) + "\n")
    got = {}
    for r in read_fasta(spark, str(f), block=256).orderBy("chrom", "offset").collect():
        assert r["offset"] == len(got.get(r["chrom"], ""))
        got[r["chrom"]] = got.get(r["chrom"], "") + r["seq"]
    assert got == {n: s for n, s in contigs.items() if s}


def test_all_commands_chain(spark, tmp_path):
    rnd, t = random.Random(1), tmp_path
    genome = {c: "".join(rnd.choice("ACGT") for _ in range(6000)) for c in ("chr1", "chr2")}
    (t / "genome.fa").write_text("".join(f">{c}\n" + "".join(s[i : i + 60] + "\n" for i in range(0, len(s), 60)) for c, s in genome.items()))
    (t / "tracks.tsv").write_text("chrom\tstart\tstop\tstrand\ttrack\tgene_symbol\nchr1\t0\t2000\t*\thg38_genes_exons\tG\nchr2\t0\t5000\t+\thg38_genes_promoters\tH\n")
    sites = [(c, i) for c, s in genome.items() for i in range(100, 5900) if s[i] in "CG"][::25]
    beds = []
    for name in ("BS1_D5_1", "EM1_D5_1", "BS1_D6_1"):
        at = [*sites, *[("lambda", 10 * i + 200) for i in range(5)]]
        depth = [rnd.choice([6, 20, 30, 40]) for _ in at]
        m = [rnd.randint(0, d) for d in depth]
        beds.append(t / f"{name}.parquet")
        pd.DataFrame({"chrom": [c for c, _ in at], "start": [i for _, i in at], "end": [i + 1 for _, i in at], "m": m, "u": [d - x for d, x in zip(depth, m)], "depth": depth, "beta": [100.0 * x / d for d, x in zip(depth, m)]}).to_parquet(beds[-1])
    truth = [(x, c, i, i + 1, float((i * 7) % 101), "gold" if i % 5 == 0 else "silver") for x in ("D5", "D6") for c, i in sites]
    pd.DataFrame(truth, columns=["label", "chrom", "start", "stop", "beta_pyro", "stratum"]).to_parquet(t / "truth.parquet")

    run(spark, "annotate", "-i", *beds, "-o", t / "anno", "-n", "x", "-r", t / "genome.fa", "--features", t / "tracks.tsv", "-x", "test_cli:reverse_share", "--stages", t / "stages")
    assert spark.read.parquet(str(t / "stages/x.features.parquet")).count() == len(sites)
    anno = spark.read.parquet(str(t / "anno/x.parquet"))
    assert anno.count() == len(sites) and anno.filter("promoter").count() == sum(c == "chr2" and i < 5000 for c, i in sites)
    assert {r["bwt_ratio_70"] for r in anno.select("bwt_ratio_70").distinct().collect()} == {0.141}
    assert {(r["chrom"], r["start"]): r["seq_5"] for r in anno.collect()} == {(c, i): genome[c][i - 5 : i + 6] for c, i in sites}
    run(spark, "stat", "-i", *beds, "-o", t / "all")
    meta = spark.read.parquet(str(t / "all.metadata.parquet"))
    assert spark.read.option("header", True).csv(str(t / "all.stats.csv")).count() == spark.read.parquet(str(t / "all.stats.parquet")).count() == 6
    assert meta.count() == 3 and set(meta.columns) == {"fname", "method", *BETA_STATS, *DEPTH_STATS} and meta.filter(f"depth10_count = {len(sites) + 5}").count() == 3
    run(spark, "divide", "-i", *beds, "-o", t / "div", "-a", t / "anno/x.parquet", "-m", t / "all.metadata.parquet")
    with pytest.raises(FileExistsError):
        run(spark, "divide", "-i", *beds, "-o", t / "div", "-a", t / "anno/x.parquet", "-m", t / "all.metadata.parquet")
    run(spark, "plan", "-i", *beds, "-o", t / "plan", "-r", t / "truth.parquet", "--labs", "BS1,EM1")
    folds = spark.read.parquet(str(t / "plan/folds"))
    per = {(r["label"], r["fold"]): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert len(per) == 10 and all(len({n for (x, _), n in per.items() if x == label}) == 1 for label in ("D5", "D6"))
    assert folds.filter("beta_pyro = 100 and beta_bin <> '95-100'").count() == 0 == folds.filter("beta_pyro = 5 and beta_bin <> '0-5'").count()
    run(spark, "sample", "-i", *beds, "-o", t / "set", "-p", t / "plan/folds", "-m", t / "all.metadata.parquet", "--labs", "BS1,EM1", "-a", t / "anno/x.parquet")
    data = spark.read.parquet(str(t / "set"))
    assert {"beta_bin", "occurrence", "fold", "gc_skew_70", "method", *BETA_STATS, *DEPTH_STATS} <= set(data.columns) and data.filter("predicted_beta is null").count() == 0
    run(spark, "train", "-i", t / "set", "-o", t / "model", "--trees", 2)
    for name in ("evaluate_stats.tsv", "leaderboard.csv", "feature_importance.csv"):
        assert spark.read.option("header", True).csv(str(t / "model" / name)).count() > 3
    with pytest.raises(ValueError, match="no member"):
        run(spark, "calibrate", "-i", t / "div/high.parquet", "-o", t / "high", "-md", t / "model", "-mn", "other")
    with pytest.raises(FileNotFoundError, match="no model"):
        run(spark, "calibrate", "-i", t / "div/high.parquet", "-o", t / "high", "-md", t / "nowhere")
    run(spark, "calibrate", "-i", t / "div/high.parquet", "-o", t / "high", "-md", t / "model")
    run(spark, "impute", "-hi", t / "high", "-li", t / "div/low.parquet", "-o", t / "low", "-n", 1)
    for i, bed in enumerate(beds):
        run(spark, "merge", "-oi", bed, "-ci", t / "div/control.parquet", "-li", t / "low", "-hi", t / "high", "-o", t / f"merged{i}")
    run(spark, "merge", "-oi", t / "*_1.parquet", "-ci", t / "div/control.parquet", "-li", t / "low", "-hi", t / "high", "-o", t / "merged")
    out = spark.read.parquet(str(t / "merged"))
    assert out.count() == 3 * (len(sites) + 5) and out.filter("actual_beta is null or predicted_beta is null or depth is null").count() == 0
    run(spark, "merge", "-oi", t / "*_1.parquet", "-ci", t / "div/control.parquet", "-li", t / "low", "-hi", t / "high", "-o", t / "merged", "--on-exists", "skip")
