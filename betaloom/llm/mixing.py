"""Mixing sources to target shares of all units, by cube-method balanced sampling.

A source of size s that is to hold t units is taken floor(t / s) times whole, and a sample with inclusion probability t / s -
floor(t / s) makes up the rest; a source that would have to be taken more than its cap is taken as often as the cap
allows and reported as short. The sample is balanced on units and on records: probabilities walk through the null space
of the two constraints, three records at a time, until each is 0 or 1 or too few are left to move (flight); these few
are settled last, first keeping the number of records, then freely (landing).

The walk runs in blocks of a source, each a task-sized group by a hash of the record's id; what blocks leave undecided, at
most two records each, is walked again in fewer blocks until one block a source is left. So no source, however large,
meets in one task, and totals miss their target by a few records a source. Records that alone are a good part of what
their source is to give (some hundreds at most) walk first, and the probability of the others makes up for the outcome.

Defined results: sources are compared trimmed and without case; records without source count to the total only; a source
without target is not mixed; records are told apart by `rec`, which is unique; a target without records is short (unless its share is 0 or null); a null cap means no
cap; records of size 0 may be drawn like others; an empty table gives an empty mix and no units.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.shared import cut_lineage, ship, sized

ship(__name__)
BLOCK = 4096
#: A record of more than 1 / LARGE of what a source is to give is settled before the others, whose probability then makes up for it.
LARGE = 200


def plain(source: Column) -> Column:
    return F.lower(F.trim(source))


def _step(p: list[float], x: list[float], rng: np.random.Generator) -> list[float]:
    """Move up to three probabilities in the null space of (records, units); at least one reaches 0 or 1."""
    if len(p) == 3:
        u = [x[1] - x[2], x[2] - x[0], x[0] - x[1]]
        if not any(u):
            u = [1.0, -1.0, 0.0]
    else:
        u = [1.0, -1.0]
    up = min((1 - a) / b if b > 0 else a / -b for a, b in zip(p, u, strict=True) if b)
    down = min(a / b if b > 0 else (1 - a) / -b for a, b in zip(p, u, strict=True) if b)
    move = up if rng.random() * (up + down) < down else -down
    q = [a + move * b for a, b in zip(p, u, strict=True)]
    return [0.0 if a < 1e-9 else 1.0 if a > 1 - 1e-9 else a for a in q]


def _flight(pdf: pd.DataFrame, land: bool) -> pd.DataFrame:
    """pi of one block after its walk; at most two stay strictly between 0 and 1, none if it lands."""
    # largest first: records of like size settle among themselves, so that small ones are left for the landing
    pdf = pdf.sort_values(["size", "h", "rec"], ascending=[False, True, True], kind="stable", na_position="first").reset_index(drop=True)
    pi, x = pdf["pi"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
    rng = np.random.default_rng(abs(int(pdf["h"].iloc[0])))
    held: list[int] = []
    for i in np.flatnonzero((pi > 0) & (pi < 1)):
        held.append(int(i))
        while len(held) == 3:
            for j, v in zip(held, _step([pi[j] for j in held], [x[j] for j in held], rng), strict=True):
                pi[j] = v
            held = [j for j in held if 0 < pi[j] < 1]
    if land:
        while len(held) == 2:
            for j, v in zip(held, _step([pi[j] for j in held], [], rng), strict=True):
                pi[j] = v
            held = [j for j in held if 0 < pi[j] < 1]
        for j in held:
            pi[j] = float(rng.random() < pi[j])
    return pdf.assign(pi=pi)[["source", "rec", "size", "h", "pi"]]


def cube_sample(df: DataFrame, block: int = BLOCK, seed: int = 5) -> DataFrame:
    """df: source, rec, size, pi. The same with pi 0 or 1, balanced per source on records and size."""
    d = df.select("source", "rec", F.col("size").cast("double").alias("size"), F.xxhash64(F.lit(seed), "rec").alias("h"), F.col("pi").cast("double").alias("pi"))
    done, level = d.filter("pi <= 0 or pi >= 1"), 0
    todo = d.filter("pi > 0 and pi < 1")
    schema = "source string, rec long, size double, h long, pi double"
    while True:
        sizes = cut_lineage(todo.groupBy("source").agg(F.count(F.lit(1)).alias("_n")))
        most = sizes.agg(F.max("_n")).first()[0] or 0
        if most == 0:
            return done
        land = most <= block
        blocks = todo.join(sized(sizes), "source").withColumn("_b", F.pmod(F.xxhash64("h", F.lit(level)), F.ceil(F.col("_n") / block)))
        walk = partial(_flight, land=land)
        walked = cut_lineage(blocks.select("source", "rec", "size", "h", "pi", "_b").groupBy("source", "_b").applyInPandas(lambda pdf: walk(pdf), schema))  # noqa: B023, PLW0108
        done = done.unionByName(walked.filter("pi <= 0 or pi >= 1"))
        todo, level = walked.filter("pi > 0 and pi < 1"), level + 1


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: source, share, cap, size, all units, units wanted, whole repeats, probability of one more, and whether it is short."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("records"))
    every = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    d = targets.withColumn("all_units", F.lit(every)).join(per, "source", "left").withColumn("size", F.coalesce("size", F.lit(0))).withColumn("records", F.coalesce("records", F.lit(0)))
    want = F.coalesce(F.col("target_share"), F.lit(0.0)) * F.col("all_units")
    cap = F.coalesce(F.col("max_repeats").cast("double"), F.lit(float("inf")))
    times = F.when(F.col("size") > 0, F.least(F.col("want") / F.col("size"), cap)).otherwise(0.0)
    d = d.withColumn("want", want).withColumn("short", F.when(F.col("max_repeats").isNull(), (F.col("size") == 0) & (F.col("want") > 0)).otherwise(F.col("max_repeats") * F.col("size") < F.col("want")))
    return d.withColumn("times", times).withColumn("whole", F.floor("times")).withColumn("extra", F.col("times") - F.floor("times"))


def mix(sizes: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mix, report). sizes: rec, source (plain), size. targets: source (plain, unique), name, target_share, max_repeats.

    mix has every record that is taken, with its copies; report has, per target, what was wanted, what was reached and
    whether the cap kept it short. target_share is a share of all units there are (share_of_all is the one to set beside it);
    share_of_mix grows beyond it where short sources leave room, and deviation is how far a source is from what was wanted.
    """
    p = cut_lineage(plan(sizes, targets))
    d = sizes.join(sized(p.select("source", "whole", "extra", F.col("size").alias("_all"))), "source")
    # what a source is to give beyond whole repeats; records that alone are a good part of it are settled first
    extra, big = F.col("extra") * F.col("_all"), F.col("size") * LARGE > F.col("extra") * F.col("_all")
    first = cut_lineage(cube_sample(d.filter(big).select("source", "rec", "size", F.col("extra").alias("pi"))))
    had = first.groupBy("source").agg(F.sum(F.col("pi") * F.col("size")).alias("_got"), F.sum("size").alias("_big"))
    rest = d.filter(~big).join(sized(had), "source", "left").withColumn("_got", F.coalesce("_got", F.lit(0.0))).withColumn("_left", F.col("_all") - F.coalesce("_big", F.lit(0.0)))
    pi = F.when(F.col("_left") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (extra - F.col("_got")) / F.col("_left")))).otherwise(F.col("extra"))
    second = cube_sample(rest.select("source", "rec", "size", pi.alias("pi")))
    drawn = first.unionByName(second).select("source", "rec", F.col("pi").cast("long").alias("more"), F.col("size").cast("long").alias("size"))
    out = cut_lineage(drawn.join(sized(p.select("source", "whole")), "source").select("rec", "source", "size", (F.col("whole") + F.col("more")).alias("copies")).filter("copies > 0"))
    reached = out.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("mixed_units"), F.max("copies").alias("most_copies"))
    total = reached.agg(F.coalesce(F.sum("mixed_units"), F.lit(0))).first()[0]
    report = p.join(reached, "source", "left").withColumn("mix_units", F.lit(total)).select(
        F.col("name").alias("source"),
        "target_share",
        "max_repeats",
        "size",
        "want",
        F.coalesce("mixed_units", F.lit(0)).alias("mixed_units"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        F.when(F.col("all_units") > 0, F.coalesce("mixed_units", F.lit(0)) / F.col("all_units")).alias("share_of_all"),
        F.when(F.col("mix_units") > 0, F.coalesce("mixed_units", F.lit(0)) / F.col("mix_units")).alias("share_of_mix"),
        F.when(F.col("want") > 0, F.coalesce("mixed_units", F.lit(0)) / F.col("want") - 1).alias("deviation"),
        "short",
    )
    return out, report
