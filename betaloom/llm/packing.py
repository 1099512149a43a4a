"""Putting items into containers of fixed capacity: configuration linear programs over histograms of lengths.

A configuration says how many items of each length share a container. The program asks for the fewest containers whose
configurations hold every length as often as it occurs; it is solved by multiplicative weights: each length has a weight
that falls as it gets covered, and the next configuration is the knapsack of greatest weight, found by dynamic programming
over the capacity and kept for as long as no better one can exist by more than `slack`. Lengths are grouped into runs of
about equal total (linear grouping), each standing for its longest, and lengths below a small part of the capacity are
left for the gaps, as is usual for these programs. Configurations are then rounded down to whole containers, and what they
leave is put into the open ones or into new ones, largest first, best fit.

Items are dealt out by a hash to as many programs as there are CONTAINERS containers to fill, PROGRAMS at most, each a
task on a histogram of at most `capacity` counts, however many items it stands for. The weights also bound from below how
many containers any filling needs: each program reports this bound, its own containers, steps and knapsacks. Steps have a
proven end (each covers its scarcest length by a fixed part), so that none is cut short.

Items are sized, ranked within their program and length and assigned to containers by Spark: the r-th item of a length
falls into the last slot that starts at or before r.

Defined results: an item longer than the capacity is cut into full pieces and a rest, and only such an item is cut; an
item of size 0 (null or empty text) takes no room and gets no container; items of equal length, repeated rows included,
are interchangeable; an empty table gives no rows. Items are told apart by their id; a null id is an item like others.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.shared import blocked_rank, cut_lineage, ship, sized

ship(__name__)

Config = tuple[tuple[int, int], ...]  # (length, items of it), largest first
#: Containers that one program is to fill, about, and programs at most.
CONTAINERS, PROGRAMS = 2000, 64
#: Part of the capacity up to which lengths are left for the gaps, and classes of the other lengths.
SMALL, CLASSES = 1 / 64, 96


@dataclass
class Solved:
    """Fractional containers per configuration, and how they were found: the least coverage of a length, and a bound on the containers of any solution."""

    configs: dict[Config, float] = field(default_factory=dict)
    steps: int = 0
    knapsacks: int = 0
    covered: float = 1.0
    bound: float = 0.0


def _knapsack(lengths: np.ndarray, gains: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Items (at most `most` of each length) of greatest total gain within capacity; multiples as powers of two."""
    best, steps = np.zeros(capacity + 1), []
    for i, (size, gain, m) in enumerate(zip(lengths, gains, most, strict=True)):
        m, k = min(int(m), capacity // int(size)), 1
        while m > 0:
            k = min(k, m)
            w = k * int(size)
            other = best[: capacity + 1 - w] + k * gain
            took = other > best[w:]
            best = best.copy()
            best[w:] = np.where(took, other, best[w:])
            steps.append((i, k, w, took))
            m, k = m - k, k * 2
    out, w = defaultdict(int), capacity
    for i, k, size, took in reversed(steps):
        if w >= size and took[w - size]:
            out[i] += k
            w -= size
    return dict(out)


def _classes(hist: dict[int, int], most: int, small: int) -> list[list[int]]:
    """Lengths above `small`, in at most `most` runs of about equal total length; shorter ones are left for the gaps."""
    lengths = [x for x in sorted(hist) if x > small]
    if not lengths:
        return []
    mass = np.cumsum([x * hist[x] for x in lengths])
    of = np.minimum((mass - 1e-9) / mass[-1] * most, most - 1).astype(int) if len(lengths) > most else np.arange(len(lengths))
    return [[x for x, c in zip(lengths, of, strict=True) if c == i] for i in np.unique(of)]


def solve_lp(hist: dict[int, int], capacity: int, least: dict[int, int] | None = None, eps: float = 0.15, slack: float = 0.05) -> Solved:
    """Fractional containers per configuration by multiplicative weights, every length covered.

    Weights are exp(-eta * coverage) / count with eta = ln(lengths) / eps; a step adds a configuration until its scarcest
    open length is covered by a quarter of 1 / eta more, and lengths that are covered drop out: at most 4 * eta steps a
    length. Weights only fall, so the value of the last knapsack bounds all later ones, and known configurations are used
    while one of them is worth 1 - slack of it. Weights over the value of their knapsack solve the dual program, whose
    value bounds the containers of any filling from below; `least` gives the shortest length that each length stands for.
    """
    lengths = np.array(sorted(hist), dtype=np.int64)
    if not len(lengths):
        return Solved()
    counts = np.array([hist[x] for x in lengths], dtype=float)
    eta = max(math.log(len(lengths) + 1) / eps, 1.0)
    cover, most = np.zeros(len(lengths)), np.ceil(counts)
    pool, used = np.zeros((0, len(lengths))), np.zeros(0)
    out, top, best, dual = Solved(), np.inf, 0.0, None
    while (open_ := cover < 1).any():
        y = np.where(open_, np.exp(-eta * np.minimum(cover, 1)) / counts, 0.0)
        worth = pool @ y
        k = int(worth.argmax()) if len(worth) else -1
        if k < 0 or worth[k] < (1 - slack) * top:
            at = np.flatnonzero(open_)
            pick = _knapsack(lengths[at], y[at], most[at], capacity)
            new = np.zeros(len(lengths))
            new[at[list(pick)]] = list(pick.values())
            top, out.knapsacks = float(new @ y), out.knapsacks + 1
            pool, used, k = np.vstack([pool, new]), np.append(used, 0.0), len(pool)
            if y @ counts > best * top:
                best, dual = y @ counts / top, y
        a = pool[k]
        idx = np.flatnonzero((a > 0) & open_)
        step = float((counts[idx] / a[idx]).min() / (4 * eta))
        cover += step * a / counts
        used[k] += step
        out.steps += 1
    out.covered = float(cover.min())
    for a, x in zip(pool, used, strict=True):
        if x > 0:
            config = tuple((int(lengths[i]), int(a[i])) for i in np.flatnonzero(a)[::-1])
            out.configs[config] = out.configs.get(config, 0.0) + float(x)
    at = np.flatnonzero(dual)
    short = np.array([(least or {}).get(int(x), int(x)) for x in lengths[at]], dtype=np.int64)
    pick = _knapsack(short, dual[at], most[at], capacity)
    out.bound = float(dual @ counts / sum(n * dual[at[i]] for i, n in pick.items()))
    return out


def _best_fit(rest: dict[int, int], capacity: int, open_: list[tuple[Config, int]]) -> list[tuple[Config, int]]:
    """Largest first, best fit, over counts: groups of alike containers are filled and split together."""
    by_room: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(config: dict[int, int], n: int) -> None:
        room = capacity - sum(k * v for k, v in config.items())
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append((config, n))

    for config, n in open_:
        put(dict(config), n)
    for size in sorted(rest, reverse=True):
        left = rest[size]
        while left > 0:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if left // each:
                    put({size: each}, left // each)
                if left % each:
                    put({size: left % each}, 1)
                break
            room = rooms[at]
            config, n = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            each = min(room // size, left)
            use = min(n, left // each)
            if n > use:
                put(config, n - use)
            put(config | {size: config.get(size, 0) + each}, use)
            left -= use * each
    return [(tuple(sorted(c.items(), reverse=True)), n) for groups in by_room.values() for c, n in groups]


def _dealt(config: Config, n: int, stock: dict[int, list[list[int]]]) -> list[tuple[Config, int]]:
    """n containers of classes as containers of lengths: each slot takes a run of its class's stock, longest first."""
    ends, slots = {0, n}, []
    for cls, k in config:
        for _ in range(k):
            run, at = [], 0
            while at < n:
                size, left = stock[cls][-1]
                use = min(left, n - at)
                run.append((at, size))
                at += use
                ends.add(at)
                stock[cls][-1][1] -= use
                if left == use:
                    stock[cls].pop()
            slots.append(run)
    cuts = sorted(ends)
    out = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        c: dict[int, int] = defaultdict(int)
        for run in slots:
            c[max(x for x in run if x[0] <= lo)[1]] += 1
        out.append((tuple(sorted(c.items(), reverse=True)), hi - lo))
    return out


def pack_histogram(hist: dict[int, int], capacity: int, classes: int = CLASSES, small: float = SMALL) -> tuple[list[tuple[Config, int]], Solved]:
    """Configurations and how many containers follow each, which together hold the histogram exactly, and how they were found.

    The program runs over classes of lengths, each standing for its longest; what its configurations leave free in
    truth, and the lengths up to small * capacity, are settled by best fit.
    """
    rest = {k: v for k, v in hist.items() if v > 0 and k < capacity}
    full = hist.get(capacity, 0)
    out = [(((capacity, 1),), full)] if full else []
    runs = _classes(rest, classes, int(small * capacity))
    stock = {run[-1]: [[x, rest[x]] for x in run] for run in runs}
    left = {run[-1]: sum(rest[x] for x in run) for run in runs}
    solved = solve_lp(left, capacity, {run[-1]: run[0] for run in runs})
    solved.bound = full + max(solved.bound, sum(k * v for k, v in rest.items()) / capacity)
    chosen: list[tuple[Config, int]] = []
    for config, x in sorted(solved.configs.items(), key=lambda t: (-t[1], t[0])):
        n = min([int(x), *(left[size] // k for size, k in config)])
        if n > 0:
            chosen += _dealt(config, n, stock)
            for size, k in config:
                left[size] -= n * k
    for run in runs:
        for x in run:
            rest[x] = 0
        for x, n in stock[run[-1]]:
            rest[x] = n
    return out + sorted(_best_fit({k: v for k, v in rest.items() if v > 0}, capacity, chosen)), solved


def pieces(items: DataFrame, capacity: int) -> DataFrame:
    """items: item_id, size. Pieces with their number, size and first unit; one piece unless the item exceeds the capacity."""
    n = F.ceil(F.col("size") / F.lit(capacity)).cast("int")
    d = items.filter("size > 0").select("item_id", "size", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    return d.select("item_id", "piece", (F.col("piece") * capacity).cast("long").alias("first_unit"), F.least(F.lit(capacity), F.col("size") - F.col("piece") * capacity).cast("long").alias("length"), (F.col("size") > capacity).alias("cut"))


def _slots(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Slots of one program's histogram: `per` items of a length a container, from the item ranked `first` on, from container `base` on."""
    configs, solved = pack_histogram(dict(zip(pdf["length"].tolist(), pdf["n"].tolist(), strict=True)), capacity)
    rows, seen, at = [], defaultdict(int), 0
    for config, n in configs:
        for size, k in config:
            rows.append((size, seen[size], k, at))
            seen[size] += n * k
        at += n
    out = pd.DataFrame(rows, columns=["length", "first", "per", "base"])
    return out.assign(program=pdf["program"].iloc[0], containers=at, steps=solved.steps, knapsacks=solved.knapsacks, covered=solved.covered, bound=solved.bound)


def pack(items: DataFrame, capacity: int, seed: int = 17, containers: int = CONTAINERS) -> tuple[DataFrame, DataFrame]:
    """(placed, programs): pieces of items (item_id, size) with the container each goes into, and a row a program with its containers, bound, steps, knapsacks and coverage."""
    parts = pieces(items, capacity).withColumn("_h", F.xxhash64(F.lit(seed), "item_id", "piece"))
    total = parts.agg(F.sum("length")).first()[0] or 0
    programs = min(PROGRAMS, max(1, -(-total // (capacity * containers))))
    parts = parts.withColumn("program", F.pmod(F.xxhash64(F.lit(seed + 1), "_h"), F.lit(programs)).cast("int"))
    hist = parts.groupBy("program", "length").agg(F.count(F.lit(1)).alias("n"))
    solve = lambda pdf: _slots(pdf, capacity)
    schema = "length long, first long, per long, base long, program int, containers long, steps long, knapsacks long, covered double, bound double"
    # a partition of their own for programs, which are few rows and much work
    slots = cut_lineage(hist.repartition(2 * programs, "program").groupBy("program").applyInPandas(solve, schema))
    stats = ["containers", "steps", "knapsacks", "covered", "bound"]
    each = slots.groupBy("program").agg(*[F.max(c).alias(c) for c in stats])
    # a row a program, PROGRAMS at most
    before = F.coalesce(F.sum("containers").over(W.orderBy("program").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    each = cut_lineage(each.withColumn("_offset", before))
    runs = slots.join(F.broadcast(each.select("program", "_offset")), "program").groupBy("program", "length").agg(F.array_sort(F.collect_list(F.struct("first", "per", (F.col("base") + F.col("_offset")).alias("base")))).alias("_slots"))
    r = blocked_rank(parts, ["program", "length"], "_h", ["item_id", "piece"], "_r").withColumn("_r", F.col("_r") - 1)
    d = r.join(sized(cut_lineage(runs)), ["program", "length"]).withColumn("_slot", F.element_at(F.filter("_slots", lambda s: s["first"] <= F.col("_r")), -1))
    container = (F.col("_slot.base") + F.floor((F.col("_r") - F.col("_slot.first")) / F.col("_slot.per"))).alias("container_id")
    return d.select("item_id", "piece", "first_unit", "length", "cut", container), each.drop("_offset")
