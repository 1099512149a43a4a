import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from betaloom.functions import sequence as sq
from betaloom.functions.values import beta_bin, clip_beta, trusted_depth
from betaloom.operators import divide as dv
from betaloom.operators import sampling as sm
from betaloom.operators import stats as st
from betaloom.operators.annotate import annotate, summarise_overlaps
from betaloom.operators.checks import assert_unique, not_null, require_columns
from betaloom.operators.intervals import overlap_join, tile_lookup
from betaloom.operators.models import feature_roles
from betaloom.sources.scans import FLANK_TABLE, fasta_tiles, pick_files, read_bed, read_tsv, scan_parquet
from betaloom.sources.sinks import complete, stage, write_parquet, write_tsv
from betaloom.streaming.incremental import score_new_files


def one(spark, values, kind, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(expr(F.col("v"))).collect()]


def test_bins_and_clip(spark):
    x = [-1.0, 0.0, 0.01, 5.0, 5.01, 50.0, 95.0, 95.01, 100.0, 101.0, None, math.nan]
    assert one(spark, x, "double", beta_bin) == ["0-5", "0-5", "0-5", "0-5", "5-10", "45-50", "90-95", "95-100", "95-100", "95-100", None, "95-100"]
    assert one(spark, [-0.1, 0.0, 100.0, 100.1, None], "double", clip_beta) == [0.0, 0.0, 100.0, 100.0, None]


def test_trusted_depth(spark):
    d = spark.createDataFrame([(d, lab) for d in (10, 11, 150, 151, 250, 251) for lab in ("RR1", "BS1")], "d int, lab string")
    got = {(r["d"], r["lab"]) for r in d.filter(trusted_depth(F.col("d"), F.col("lab"))).collect()}
    assert got == {(11, "RR1"), (150, "RR1"), (151, "RR1"), (250, "RR1"), (11, "BS1"), (150, "BS1")}


@pytest.mark.parametrize(("seq", "strand", "ctx"), [("AACGA", "+", "CpG"), ("AACAG", "+", "CHG"), ("AACAA", "+", "CHH"), ("ACGAA", "-", "CpG"), ("CAGAA", "-", "CHG"), ("AAGAA", "-", "CHH"), ("AAAAA", ".", "?"), ("AANAA", ".", "?")])
def test_strand_and_context(spark, seq, strand, ctx):
    got = spark.createDataFrame([(seq,)], "s string").select(sq.strand(F.col("s"), 2), sq.context_type(F.col("s"), 2)).first()
    assert tuple(got) == (strand, ctx)


def test_sequence_features_of_degenerate_input(spark):
    assert one(spark, ["AATT", "ACGT", "NNNN", "", None], "string", sq.shannon_entropy) == [1.0, 2.0, 0.0, 0.0, None]
    assert math.isnan(one(spark, ["AATT"], "string", sq.gc_skew)[0])
    assert one(spark, ["GCGCG"], "string", sq.cpg_gc_ratio) == [0.4]
    assert one(spark, ["AAAAACNNNNN", "AAAAAGTTTTN"], "string", sq.plus_oriented) == ["AAAAACNNNNN", "NAAAACTTTTT"]
    got = one(spark, ["AAAA", "", None, "ACGT"], "string", sq.bwt_ratio)
    assert got[0] < got[3] and got[1] is None and got[2] is None


def test_overlap_edges(spark):
    sites = spark.createDataFrame([("c", 10, 11, "+"), ("c", 10, 11, "+"), ("c", 100_000, 100_001, "-"), (None, 1, 2, "+")], "chrom string, start long, stop long, strand string")
    rows = [("c", 5, 10, "+", "left"), ("c", 11, 20, "+", "right"), ("c", 10, 11, "-", "one"), ("c", 0, 5_000_000, "*", "long"), ("c", 99_999, 120_000, "+", "bins"), ("c", 7, 7, "+", "empty")]
    f = spark.createDataFrame(rows, "chrom string, start long, stop long, strand string, name string")
    name = lambda stranded, width: sorted((r["start"], r["f_name"]) for r in overlap_join(sites, f, stranded, width).collect())
    want = [(10, "long"), (10, "long"), (10, "one"), (10, "one"), (100_000, "bins"), (100_000, "long")]
    assert name(False, 16_384) == want and name(False, 64) == want
    assert name(True, 16_384) == [(10, "long"), (10, "long"), (100_000, "long")]
    wide = spark.createDataFrame([("c", 0, 1000)], "chrom string, start long, stop long")
    many = spark.createDataFrame([("c", 100, 900)], "chrom string, start long, stop long")
    assert overlap_join(wide, many, width=16).count() == 1


def test_tiles(spark):
    text = "ACGTACGGTTAACC" * 9
    lines = spark.createDataFrame([("c", i, text[i : i + 10]) for i in range(0, len(text), 10)], "chrom string, offset long, seq string")
    tiles = fasta_tiles(lines, 16)
    assert {len(r["tile_seq"]) for r in tiles.collect()} <= {16, len(text) % 16}
    at = spark.createDataFrame([("c", 3, 5), ("c", 14, 40), ("c", 120, 999)], "chrom string, start long, stop long")
    got = {r["start"]: r["seq"] for r in tile_lookup(at, tiles, 16).collect()}
    assert got == {3: text[3:5], 14: text[14:40], 120: text[120:]}


def test_overlap_priorities_and_uniqueness(spark):
    rows = [("c", 1, 2, "B", "exon"), ("c", 1, 2, "A", "intron"), ("c", 1, 2, None, "cpg_shore"), ("c", 5, 6, None, "promoter"), ("c", 7, 8, "Z", "odd")]
    s = summarise_overlaps(spark.createDataFrame(rows, "chrom string, start long, stop long, gene_symbol string, anno string"))
    got = {r["start"]: (r["gene_symbols"], r["promoter"], r["cpg"], r["location"]) for r in s.collect()}
    assert got == {1: ("A,B", False, "cpg_shore", "intron"), 5: ("", True, "cpg_inter", "intergenic"), 7: ("Z", False, "cpg_inter", "intergenic")}
    sites = spark.createDataFrame([("c", 1, 2), ("c", 99, 100)], "chrom string, start long, stop long")
    feats = spark.createDataFrame([("c", 1, 2, "+"), ("c", 1, 2, "+")], "chrom string, start long, stop long, strand string")
    assert {r["start"]: r["location"] for r in annotate(sites, feats, s).collect()} == {1: "intron", 99: None}
    with pytest.raises(Exception, match="sites.*not unique"):
        annotate(sites.unionByName(sites), feats, s).collect()
    with pytest.raises(Exception, match="features.*not unique"):
        annotate(sites, feats.union(spark.createDataFrame([("c", 1, 2, None)], feats.schema)), s).collect()
    with pytest.raises(Exception, match="summary.*not unique"):
        annotate(sites, feats, s.unionByName(s.withColumn("location", F.lit("cds")))).write.format("noop").mode("overwrite").save()
    assert annotate(sites.limit(0), feats, s).count() == 0
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(feats, ["chrom"], "x")
    with pytest.raises(ValueError, match="not found"):
        require_columns(sites, ["beta"])
    nan = spark.createDataFrame([(1.0, "a"), (math.nan, "b"), (None, "c")], "x double, y string")
    assert not_null(nan).count() == 2


def test_peaks_and_statistics_against_numpy(spark):
    rnd = np.random.default_rng(1)
    x = np.round(np.r_[rnd.normal(20, 3, 400), rnd.normal(80, 5, 600)], 1).clip(0, 100)
    df = spark.createDataFrame([("s", float(v)) for v in x] + [("s", None), ("s", math.nan), ("flat", 5.0), ("flat", 5.0)], "g string, depth double")
    c = st.counts(df, "g", ["depth"])
    d = {r["fname"]: r for r in st.describe(c).collect()}
    assert d["s"]["count"] == 1000 and math.isclose(d["s"]["mean"], x.mean()) and math.isclose(d["s"]["std"], x.std(ddof=1)) and d["flat"]["skew"] is None
    z = (x - x.mean()) / x.std()
    assert math.isclose(d["s"]["skew"], (z**3).mean())
    p = {r["pct"]: r["value"] for r in st.percentiles(c.filter("fname = 's'"), [1, 33, 50, 99]).collect()}
    assert np.allclose([p[k] for k in (1.0, 33.0, 50.0, 99.0)], np.percentile(x, [1, 33, 50, 99]))
    m = {r["fname"]: r["mad"] for r in st.mad(c).collect()}
    assert math.isclose(m["s"], np.median(np.abs(x - np.median(x)))) and m["flat"] == 0
    h = np.histogram(x, bins=20)[0] / 1000
    e = {r["fname"]: r["entropy"] for r in st.histogram_entropy(c).collect()}
    assert math.isclose(e["s"], -(h[h > 0] * np.log2(h[h > 0])).sum()) and e["flat"] == 0
    k = {r["fname"]: r for r in st.kde_peaks(c.withColumn("info_col", F.lit("other"))).collect()}
    assert abs(k["s"]["peak1"] - 80) < 4 and k["flat"]["peak_num"] == 0 and k["flat"]["peak1"] == -1
    assert st.find_peaks(np.array([0, 2, 0, 3, 3, 0, 1, 0.0]), distance=0).tolist() == [1, 3, 6]
    assert st.find_peaks(np.array([0, 2, 0, 3, 3, 0, 1, 0.0]), distance=3).tolist() == [3, 6]
    assert st.find_peaks(np.array([0, 2, 1.9, 3, 0.0]), prominence=0.5).tolist() == [3]


def test_division_and_merge(spark):
    rows = [("c", 1, 2, 9, 101.0), ("c", 3, 4, 10, 50.0), ("lambda", 5, 6, 50, -1.0), (None, 7, 8, 50, 1.0), ("c", 9, 10, None, 1.0)]
    df = spark.createDataFrame(rows, "chrom string, start long, stop long, depth long, beta double")
    d = dv.divide(df.withColumn("predicted_beta", clip_beta(F.col("beta"))))
    assert {k: [r["start"] for r in v.collect()] for k, v in d.items()} == {"control": [5], "low": [1], "high": [3]}
    assert dv.divide(df.filter("start = 1").withColumnRenamed("beta", "predicted_beta"))["control"].count() == 0
    with pytest.raises(ValueError, match="cutoff"):
        dv.divide(df, 0)
    origin = df.withColumn("u", F.lit(1)).withColumn("m", F.lit(2))
    m = dv.merge(d["control"], d["high"].withColumn("actual_beta", F.lit(120.0)), d["low"], origin)
    assert {r["start"]: (r["predicted_beta"], r["actual_beta"]) for r in m.collect()} == {1: (100.0, 100.0), 3: (50.0, 100.0), 5: (0.0, 0.0)}
    again = spark.createDataFrame([("s", 1, 5, "new"), ("s", 1, 4, "old"), ("s", 2, None, "x")], "f string, p long, load long, v string")
    assert sorted(r["v"] for r in dv.latest(again, ["f", "p"], "load").collect()) == ["new", "x"]


@pytest.mark.parametrize("n", [0, 4, 5, 6, 12])
def test_folds_and_split(spark, n):
    df = spark.createDataFrame([(i,) for i in range(n)], "rec long")
    sizes = {r["fold"]: r["count"] for r in sm.folds(df, F.col("rec"), 5, "x").groupBy("fold").count().collect()}
    assert sizes == ({i: n // 5 for i in range(5)} if n >= 5 else {})
    head = sm.split(df, F.col("rec"), 0.8, "x").filter("part = 'head'").count()
    assert head == round(n * 0.8)


def test_strata_take_all_of_small_and_most_of_large(spark):
    df = spark.createDataFrame([(i, None if i < 3 else "a") for i in range(40)], "k long, s string")
    got = {r["s"]: r["count"] for r in sm.stratified(df, ["s"], F.col("k"), 10, "x").groupBy("s").count().collect()}
    assert got == {None: 3, "a": 10}


def test_roles(spark):
    df = spark.createDataFrame([(1, "a", 1.0, True), (1, "b", 2.0, False), (1, "c", 3.0, None)], "k int, c string, x double, f boolean")
    assert {r["name"]: r["role"] for r in feature_roles(df, df.columns).collect()} == {"k": "constant", "c": "category", "x": "number", "f": "flag"}


def test_readers_writers_and_stages(spark, tmp_path):
    df = spark.createDataFrame([("c", 1, 2, "ACGT", 0.5, 1.5)], FLANK_TABLE)
    write_tsv(df, f"{tmp_path}/t", header=False)
    assert read_tsv(spark, f"{tmp_path}/t", FLANK_TABLE).collect() == df.collect()
    assert read_bed(spark, f"{tmp_path}/t").first()["start"] == 2
    write_parquet(df, f"{tmp_path}/BS1_D5_1.parquet")
    with pytest.raises(Exception, match="(?i)exists"):
        write_parquet(df, f"{tmp_path}/BS1_D5_1.parquet")
    write_parquet(df.limit(0), f"{tmp_path}/BS1_D5_1.parquet", "skip")
    assert spark.read.parquet(f"{tmp_path}/BS1_D5_1.parquet").count() == 1
    assert not complete(spark, f"{tmp_path}/s") and stage(spark, f"{tmp_path}/s", lambda: df).count() == 1
    assert stage(spark, f"{tmp_path}/s", lambda: 1 / 0).count() == 1
    names = spark.createDataFrame([("BS1_D5_1",), ("RR1_D5_1",), ("BS1_D6_1",)], "fname string")
    assert [r[0] for r in pick_files(names, ["D5", "D6"], ["RR"], "D5").collect()] == ["BS1_D5_1"]
    assert "fname" in scan_parquet(spark, f"{tmp_path}/s").columns


def test_incremental_scoring_skips_what_is_done(spark, tmp_path):
    src, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    run = lambda: score_new_files(spark, src, "x long", lambda b: b.withColumn("y", F.col("x") * 2), out, state).awaitTermination()
    spark.range(3).select(F.col("id").alias("x")).coalesce(1).write.parquet(src)
    run()
    run()
    assert spark.read.parquet(out).count() == 3
    spark.range(2).select(F.col("id").alias("x")).coalesce(1).write.mode("append").parquet(src)
    run()
    assert spark.read.parquet(out).count() == 5


def test_search_draws_all_parameters_and_ends_in_time(spark):
    from betaloom.operators.models import Roles, median_model, search

    d = spark.range(300).select("id", (F.col("id") % 17).cast("double").alias("x"), ((F.col("id") % 17) * 2.0).alias("y"))
    best, trials = search(d, Roles(["x"]), "y", "id", trials=50, seconds=0.0)
    assert trials.count() == 1 and set(best) == {"trees", "depth", "rate", "subsample", "columns", "leaf", "gain", "bins"} == set(trials.columns) - {"trial", "loss"}
    assert median_model(d, Roles(["x"]), "y", **best).transform(d).filter("prediction is null").count() == 0


def test_categories_wider_than_the_bins(spark):
    from betaloom.operators.models import Roles, median_model, search

    rows = lambda n, wide: spark.range(n).select("id", (F.col("id") % wide).cast("string").alias("c"), F.when(F.col("id") % wide % 2 == 0, 10.0).otherwise(90.0).alias("y"))
    d, roles = rows(600, 50), Roles(categories=["c"])
    m = median_model(d, roles, "y", trees=2, rate=1.0, bins=32)
    assert m.stages[-1].getMaxBins() == 51 and m.transform(d).filter("abs(prediction - y) > 2").count() == 0  # no two values are taken together
    assert median_model(d, roles, "y", trees=2, bins=64).stages[-1].getMaxBins() == 64
    best, trials = search(d, roles, "y", "id", trials=1)
    assert best["bins"] == trials.first()["bins"] == 51 and trials.filter("loss is null").count() == 0
    from betaloom.operators.models import _fit, learners

    for learner in learners("y", 2).values():  # 64 bins
        assert _fit(rows(400, 100), roles, learner).transform(rows(400, 100)).filter("prediction is null").count() == 0


def test_categories_with_a_value_in_each_row(spark):
    from betaloom.operators.models import Roles, median_model

    d = spark.range(6).select(F.col("id").cast("string").alias("c"), (F.col("id") * 1.0).alias("y"), (F.col("id") > 3).alias("held"))
    for valid in (None, "held"):
        out = median_model(d, Roles(categories=["c"]), "y", trees=2, valid=valid).transform(d)
        assert out.count() == 6 and out.filter("prediction is null").count() == 0


def test_search_repeats_however_rows_are_laid_out(spark, monkeypatch):
    from betaloom.operators import models
    from betaloom.operators.models import Roles, search

    d = spark.range(600).select("id", F.rand(1).alias("x"), (F.col("id") % 9).cast("string").alias("c")).withColumn("y", F.col("x") * 50 + F.pmod(F.xxhash64("id"), F.lit(40))).localCheckpoint()
    run = lambda n, by: [tuple(round(v, 9) for v in t) for t in search(d.repartition(n, by), Roles(["x"], ["c"]), "y", "id", trials=2)[1].orderBy("trial").collect()]
    assert run(1, "x") == run(7, "id")
    monkeypatch.setattr(models, "PART_ROWS", 200)
    assert run(2, "x") == run(5, "c")


def test_thresholds_follow_from_all_rows(spark):
    from betaloom.operators.models import Roles, edges, median_model

    one = 12_345  # of 40,000 rows, of which Spark alone takes thresholds from 10,000
    d = spark.range(40_000).select((F.col("id") == one).cast("double").alias("x"), F.when(F.col("id") == one, 1e6).otherwise(F.col("id") % 2).alias("y"))
    cuts = edges(d, ["x"], [32])[32]
    m = median_model(d, Roles(["x"]), "y", trees=1, rate=1.0, bins=32, cuts=cuts)
    assert cuts == {"x": [0.5]} and m.stages[-1].getMaxBins() == 32 and m.transform(d).agg(F.max("prediction")).first()[0] == 1e6


def test_edges_cut_like_numbers_of_rows(spark):
    from bisect import bisect_right

    from betaloom.operators.models import edges

    vals = [float(i) for i in range(1000)] + [-7.5] * 500 + [float("inf")]
    d = spark.createDataFrame([(v, 1.0, float(i % 5)) for i, v in enumerate(vals)], "a double, b double, c double").repartition(7)
    got = edges(d, ["a", "b", "c"], [4, 8])
    assert [sum(bisect_right(got[4]["a"], v) == k for v in vals) for k in range(5)] == [500, 250, 376, 375, 0]
    assert all(got[b]["b"] == [] for b in (4, 8)) and got[8]["c"] == [0.5, 1.5, 2.5, 3.5] and len(got[4]["c"]) == 3
    assert edges(spark.createDataFrame([(1.0,), (1.0,), (float("inf"),)], "a double"), ["a"], [2])[2]["a"][0] > 1.0
