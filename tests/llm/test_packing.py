from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as stg

from betaloom.llm.packing import pack, pack_histogram, solve_lp


@settings(max_examples=40, deadline=None)
@given(stg.dictionaries(stg.integers(1, 60), stg.integers(1, 30), max_size=12))
def test_configurations_hold_the_histogram_exactly(hist):
    got, (out, solved) = Counter(), pack_histogram(hist, 60)
    for config, n in out:
        assert sum(k * v for k, v in config) <= 60 and n > 0
        for size, k in config:
            got[size] += k * n
    assert got == Counter(hist)
    least = -(-sum(k * v for k, v in hist.items()) // 60)
    assert sum(n for _, n in out) <= max(2 * least, 1)
    assert solved.covered >= 1 and solved.bound <= sum(n for _, n in out) + 1e-9


def test_linear_program_is_near_its_optimum_and_covers():
    hist = {44: 6000, 24: 6000, 32: 6000}  # one of each fills a container
    solved = solve_lp(hist, 100, eps=0.05)
    x = solved.configs
    assert 5999 <= sum(x.values()) <= 6600
    assert 5400 <= solved.bound <= 6000 + 1e-6 and solved.covered >= 1 and solved.knapsacks < solved.steps
    for size, n in hist.items():
        assert sum(v * dict(c).get(size, 0) for c, v in x.items()) >= n - 1e-6
    assert sum(n for _, n in pack_histogram(hist, 100)[0]) <= 6600


def test_bound_holds_against_the_best_filling():
    def best(sizes, room, loads=()):
        """Fewest containers, by trying all."""
        if not sizes:
            return len(loads)
        x, rest = sizes[0], sizes[1:]
        fits = {w for w in loads if w + x <= room}
        ways = [best(rest, room, tuple(sorted((*(loads[: loads.index(w)]), *(loads[loads.index(w) + 1 :]), w + x)))) for w in fits]
        return min([*ways, best(rest, room, tuple(sorted((*loads, x))))])

    for sizes in ([6, 6, 6, 6], [7, 5, 5, 3, 3, 3, 2], [9, 8, 2, 1, 4, 4], [5, 5, 5, 4, 4, 3, 2, 2]):
        out, solved = pack_histogram(dict(Counter(sizes)), 10, small=0)
        assert solved.bound - 1e-9 <= best(sorted(sizes, reverse=True), 10) <= sum(n for _, n in out)


def test_many_programs_place_every_item(spark):
    sizes = [1 + (i * 37) % 60 for i in range(3000)]
    placed, programs = pack(rows(spark, sizes), 60, containers=200)
    load = Counter()
    for r in placed.collect():
        load[r["container_id"]] += r["length"]
    stats = programs.collect()
    assert sum(load.values()) == sum(sizes) and max(load.values()) <= 60 and sorted(load) == list(range(len(load)))
    assert len(stats) > 4 and sum(r["containers"] for r in stats) == len(load) and len(load) <= 1.03 * sum(sizes) / 60 + len(stats)
    assert all(r["covered"] >= 1 and r["bound"] <= r["containers"] for r in stats)


def rows(spark, sizes):
    return spark.createDataFrame(list(enumerate(sizes)), "item_id long, size long")


def test_items_stay_whole_unless_too_long(spark):
    sizes = [5, 5, 5, 0, 10, 23, 20, 1, 9, 3, 3, 3] + [4] * 50
    got = pack(rows(spark, sizes), 10)[0].collect()
    load, per = Counter(), Counter()
    for r in got:
        load[r["container_id"]] += r["length"]
        per[r["item_id"]] += r["length"]
        assert r["cut"] == (sizes[r["item_id"]] > 10) and r["first_unit"] == 10 * r["piece"]
    assert max(load.values()) <= 10 and {i: s for i, s in enumerate(sizes) if s} == dict(per)
    assert Counter(r["item_id"] for r in got)[5] == 3 and Counter(r["item_id"] for r in got)[6] == 2
    assert sorted(load) == list(range(len(load)))


def test_empty_nulls_and_repeats(spark):
    assert pack(rows(spark, []), 10)[0].count() == 0 and pack(rows(spark, [0]), 10)[0].count() == 0
    twice = spark.createDataFrame([(1, 6), (1, 6), (None, 4), (2, None)], "item_id long, size long")
    got = pack(twice, 10)[0].collect()
    assert len(got) == 3 and len({r["container_id"] for r in got}) == 2
