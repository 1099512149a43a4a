from pyspark.sql import functions as F

from betaloom.llm.sampling import draw
from betaloom.llm.sampling_plans import beta_bin

T = "draw_id long, category string, target_share double, draw_size long, min_rows long"
C = "draw_id long, category string, chrom string, start long"


def run(spark, targets, cands, seed=28):
    s, r = draw(spark.createDataFrame(cands, C), spark.createDataFrame(targets, T), ["chrom", "start"], seed)
    return s.collect(), {(x["draw_id"], x["category"]): x for x in r.collect()}


def pool(draw_id, cat, n):
    return [(draw_id, cat, "c", i) for i in range(n)]


def test_shares_floors_and_shortfalls(spark):
    targets = [(1, "a", 0.7, 100, 0), (1, "b", 0.255, 100, 0), (1, "c", 0.025, 100, 10), (1, "d", 0.02, 100, 5), (2, "a", 1.0, 50, 0), (3, "x", None, 10, None)]
    cands = pool(1, "a", 3000) + pool(1, "b", 300) + pool(1, "c", 40) + pool(1, "d", 3) + pool(2, "a", 20)
    s, r = run(spark, targets, cands)
    n = {}
    for x in s:
        n[x["draw_id"], x["category"]] = n.get((x["draw_id"], x["category"]), 0) + 1
    assert n[1, "a"] == 70 and n[1, "b"] == 26 and n[1, "c"] == 10 and n[1, "d"] == 3 and n[2, "a"] == 20
    assert {k for k, x in r.items() if x["short"]} == {(1, "d"), (2, "a")}
    assert all(r[k]["taken"] == v for k, v in n.items()) and r[3, "x"]["need"] == 0 and r[3, "x"]["available"] == 0
    assert len({(x["draw_id"], x["category"], x["start"]) for x in s}) == len(s)


def test_inclusion_follows_probability(spark):
    hits = [0] * 40
    for seed in range(12):
        for x in run(spark, [(1, "a", 1.0, 10, 0)], pool(1, "a", 40), seed)[0]:
            hits[x["start"]] += 1
    assert sum(hits) == 120 and max(hits) < 10 and sum(h > 0 for h in hits) > 30


def test_empty_and_nulls(spark):
    assert run(spark, [], pool(1, "a", 3)) == ([], {})
    s, r = run(spark, [(1, "a", 1.0, 2, 0)], [])
    assert s == [] and r[1, "a"]["short"]
    s, _ = run(spark, [(1, "a", 1.0, 2, 0)], [(1, "a", None, None), (1, "a", None, 1), (None, "a", "c", 1), (1, None, "c", 1)])
    assert len(s) == 2 and {x["chrom"] for x in s} == {None}


def test_bins(spark):
    d = spark.createDataFrame([(x,) for x in (0.0, 5.0, 5.01, 95.0, 100.0, 100.1, -0.1, None, float("nan"))], "x double")
    assert [r[0] for r in d.select(beta_bin(F.col("x"))).collect()] == ["0-5", "0-5", "5-10", "90-95", "95-100", None, None, None, None]
