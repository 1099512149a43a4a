import math
import random

from pyspark.sql import functions as F

from betaloom.llm.overlap import BIT_RADIUS, SEGMENTS, candidates, coded, contig, gray, hamming, pairs, segments

SCHEMA = "rec long, label string, chrom string, start long, beta double, split string, code string, perm string"


def side(spark, rows):
    d = spark.createDataFrame([(*r, "s", "c", "p") for r in rows], SCHEMA)
    return coded(d.withColumn("_c", contig(F.col("chrom"))), "rec", ["label", "_c"], "start", "beta", [])


def near(a, b):
    if a is None or b is None:
        return a is None and b is None
    return any(abs(x - y) <= 0.5 + 1e-9 for x in ([a, 100 * a] if a <= 1 else [a]) for y in ([b, 100 * b] if b <= 1 else [b]))


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    rec = lambda i: (i, rnd.choice(["A", "B", None]), rnd.choice(["chr1", "1", "CHR1 ", "chrX", "x", None]), rnd.choice([None, *range(60), 10**9]), rnd.choice([None, 0.0, 1.0, 0.5, 50.0, 50.5, 51.01, 49.7, round(rnd.random(), 3), round(100 * rnd.random(), 1)]))
    t, o = [rec(i) for i in range(400)], [rec(i) for i in range(400, 700)]
    t.append(t[0])  # a repeated row is a row
    plain = lambda c: None if c is None else "chr" + c.strip().lower().removeprefix("chr").upper()
    want = sorted((a[0], b[0]) for a in t for b in o if None not in (a[1], a[2], a[3], b[1], b[2], b[3]) and a[1] == b[1] and plain(a[2]) == plain(b[2]) and abs(a[3] - b[3]) <= 2 and near(a[4], b[4]))
    got = sorted((r["rec_t"], r["rec_o"]) for r in pairs(side(spark, t), side(spark, o), 2).collect())
    assert got == want and len(want) > 150


def test_nan_counts_as_missing_and_empty(spark):
    a, b = [(1, "A", "chr1", 5, math.nan)], [(2, "A", "1", 7, None)]
    assert pairs(side(spark, a), side(spark, b), 2).count() == 1
    assert pairs(side(spark, a), side(spark, []), 2).count() == 0


def test_distance_grows_with_the_distance(spark):
    d = spark.range(400).select(F.col("id"), F.explode(F.sequence(F.lit(0), F.lit(8))).alias("k"))
    for step, unit in ((2, 1), (0.5, 0.25)):
        x = (F.col("id") - 200) * unit
        got = d.select("k", hamming(segments(x, step), segments(x + F.col("k") * unit, step)).alias("h")).groupBy("k").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).collect()
        for r in got:  # k units are k / 2 steps, each of which crosses one line and turns one bit
            assert (r["lo"], r["hi"]) == (r["k"] // 2, (r["k"] + 1) // 2)


def test_gray_code_turns_one_bit(spark):
    n = spark.range(-1000, 1000).select(F.bit_count(gray(F.col("id")).bitwiseXOR(gray(F.col("id") + 1))).alias("b"))
    assert {r["b"] for r in n.collect()} == {1}


def test_radius_rejects_candidates_and_loses_none(spark):
    rows = [(i, "A", "chr1", i % 97, 40 + (i * 7 % 40) / 10) for i in range(400)]
    t, o = side(spark, rows[:250]), side(spark, rows[250:])
    c = candidates(t, o, 2)
    near_ = sorted((a[0], b[0]) for a in rows[:250] for b in rows[250:] if abs(a[3] - b[3]) <= 2 and near(a[4], b[4]))
    n, kept = c.count(), c.filter(F.col("distance") <= BIT_RADIUS).count()
    assert n > 1.5 * kept >= 1.5 * len(near_) > 0 and c.agg(F.max("distance")).first()[0] > 2 * SEGMENTS - 4
    assert sorted((r["rec_t"], r["rec_o"]) for r in pairs(t, o, 2).collect()) == near_


def test_recall_for_ids_divisible_by_20(spark):
    from betaloom.llm import overlap_plans

    folder = "/root/testdata/sf0.01"
    plain = lambda c: None if c is None else "chr" + c.strip().lower().removeprefix("chr").upper()
    rows = lambda name: [r for r in spark.read.parquet(f"{folder}/{name}.parquet").select("rec_id", "label", "chrom", "start", "beta_pyro").collect() if None not in (r["label"], r["chrom"], r["start"])]
    some, other = [r for r in rows("gold_eval") if r["rec_id"] % 20 == 0], rows("gold_train")
    want = {(a["rec_id"], b["rec_id"]) for a in some for b in other if a["label"] == b["label"] and plain(a["chrom"]) == plain(b["chrom"]) and abs(a["start"] - b["start"]) <= 2 and near(a["beta_pyro"], b["beta_pyro"])}
    got = {(r["rec_id_b"], r["rec_id_a"]) for r in overlap_plans.p4_found(spark, folder).collect()} | {(r["rec_id_a"], r["rec_id_b"]) for r in overlap_plans.p4_found(spark, folder).collect()}
    assert want and want <= got
