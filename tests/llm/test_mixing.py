import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from betaloom.llm.mixing import _flight, cube_sample, mix, plain

S = "rec long, source string, size long"
T = "source string, name string, target_share double, max_repeats long"


def test_cube_is_balanced_in_blocks(spark):
    rnd = random.Random(2)
    rows = [("a", i, rnd.choice([5, 50, 500]), 0.3) for i in range(3000)] + [("b", i, 7, 1.0) for i in range(5)] + [("c", 1, 7, 0.0)]
    d = spark.createDataFrame(rows, "source string, rec long, size long, pi double")
    out = cube_sample(d, block=200).groupBy("source").agg(F.sum("pi").alias("n"), F.sum(F.col("pi") * F.col("size")).alias("units"), F.count(F.lit(1)).alias("all")).collect()
    got = {r["source"]: r for r in out}
    want = sum(r[2] for r in rows if r[0] == "a") * 0.3
    assert got["a"]["all"] == 3000 and abs(got["a"]["n"] - 900) <= 2 and abs(got["a"]["units"] - want) <= 1000
    assert got["b"]["n"] == 5 and got["c"]["n"] == 0


def test_shares_caps_and_report(spark):
    rnd = random.Random(3)
    docs = [(i, "big", rnd.randrange(1, 200)) for i in range(2000)] + [(5000 + i, "tiny", 10) for i in range(100)] + [(9000 + i, "mid", rnd.randrange(1, 100)) for i in range(600)] + [(9999, None, 500), (10000, "big", 0)]
    targets = [("big", "Big", 0.4, 2), ("tiny", "Tiny", 0.2, 3), ("mid", "Mid", 0.25, None), ("gone", "Gone", 0.1, 5), ("zero", "Zero", 0.0, 1)]
    out, report = mix(spark.createDataFrame(docs, S), spark.createDataFrame(targets, T))
    r = {x["source"]: x for x in report.collect()}
    assert {k for k, x in r.items() if x["short"]} == {"Tiny", "Gone"}
    for k in ("Big", "Mid"):
        assert abs(r[k]["mixed_units"] - r[k]["want"]) <= 0.01 * r[k]["want"]
    assert r["Tiny"]["mixed_units"] == 3000 and r["Tiny"]["most_copies"] == 3 and r["Gone"]["mixed_units"] == 0
    copies = {x["rec"]: x["copies"] for x in out.collect()}
    assert 9999 not in copies and all(1 <= c <= 3 for i, c in copies.items() if 5000 <= i < 5100)
    assert {copies.get(9000 + i, 0) for i in range(600)} <= {int(r["Mid"]["want"] // r["Mid"]["size"]), int(r["Mid"]["want"] // r["Mid"]["size"]) + 1}


def test_walk_keeps_probabilities_and_balance():
    rnd = random.Random(9)
    size, pi = [float(rnd.randrange(1, 300)) for _ in range(40)], 0.37
    runs, units = np.zeros(40), []
    for h in range(1, 1501):
        got = _flight(pd.DataFrame({"source": "a", "rec": range(40), "size": size, "h": [h * 40 + i for i in range(40)], "pi": pi}), True).sort_values("rec")["pi"].to_numpy()
        assert set(got) <= {0.0, 1.0} and abs(got.sum() - 40 * pi) <= 2
        runs += got
        units.append(got @ size)
    # every record keeps its probability (five standard errors), and units vary far less than if each were drawn by itself
    assert np.abs(runs / 1500 - pi).max() < 5 * (pi * (1 - pi) / 1500) ** 0.5
    assert abs(np.mean(units) - pi * sum(size)) < 0.01 * sum(size) and np.var(units) < 0.1 * pi * (1 - pi) * sum(x * x for x in size)


def test_deviation_is_from_what_was_wanted(spark):
    docs = [(i, "a", 10) for i in range(100)] + [(1000 + i, "b", 10) for i in range(5)]
    _, report = mix(spark.createDataFrame(docs, S), spark.createDataFrame([("a", "A", 0.5, 2), ("b", "B", 0.4, 2), ("c", "C", None, 1)], T))
    r = {x["source"]: x for x in report.collect()}
    assert abs(r["A"]["deviation"]) < 0.03 and abs(r["B"]["deviation"] - (100 / 420 - 1)) < 1e-9 and r["C"]["deviation"] is None
    assert abs(r["A"]["share_of_all"] - 0.5) < 0.02 < r["A"]["share_of_mix"] - 0.5


def test_empty(spark):
    out, report = mix(spark.createDataFrame([], S), spark.createDataFrame([("a", "a", 0.5, 2)], T))
    assert out.count() == 0 and report.first()["mixed_units"] == 0 and not report.first()["short"]
    out, report = mix(spark.createDataFrame([(1, "a", 5)], S), spark.createDataFrame([], T))
    assert out.count() == 0 and report.count() == 0


def test_source_spelling(spark):
    assert spark.createDataFrame([(" PaperHall ",)], "s string").select(plain(F.col("s"))).first()[0] == "paperhall"
