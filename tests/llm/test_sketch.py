import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as stg

from betaloom.llm.sketch import exact, growth, merge, partial_counts, percentiles

ALPHA, Q = 0.01, [0.0, 0.05, 0.5, 0.9, 1.0]
SCHEMA = "k string, day int, x double, field string, bucket string, n string, q string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "f", "b", "n", "q") for r in rows], SCHEMA)


def test_bounds_hold_and_partials_add_up(spark):
    rnd = random.Random(1)
    rows = [("a", i % 3, rnd.choice([0.0, -1.5, 2.0, 1.0]) if i % 5 == 0 else rnd.lognormvariate(0, 3) * rnd.choice([1, -1])) for i in range(2000)]
    rows += [("a", 0, None), ("a", 0, math.nan), ("a", 1, math.inf), (None, 0, 4.0), (None, None, 4.0), ("empty", 0, None)]
    df, span = table(spark, rows), {"x": None}
    parts = partial_counts(df, ["k", "day"], span, ALPHA)
    whole = merge(parts, ["k"])
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, partial_counts(df, ["k"], span, ALPHA).collect()), key=str)
    x = np.array([v for k, _, v in rows if k == "a" and v is not None and math.isfinite(v)])
    p = percentiles(whole, ["k"], {"x": Q}, ALPHA)
    got = {(r["k"], r["q"]): r for r in p.collect()}
    assert {k for k, _ in got} == {"a", None} and got[None, 0.5]["n"] == 2
    for q in Q:
        true = np.percentile(x, 100 * q)
        r = got["a", q]
        assert r["low"] <= true <= r["high"]
        order = np.sort(x)[int(q * (len(x) - 1))]
        if q in (0.0, 1.0):
            assert abs(r["estimate"] - order) <= ALPHA * abs(order) * (1 + 1e-6)
    v = {r["q"]: r["value"] for r in exact(df.filter("k = 'a'"), ["k"], span, p.filter("k = 'a'"), ALPHA).collect()}
    assert all(math.isclose(v[q], np.percentile(x, 100 * q), rel_tol=1e-12, abs_tol=1e-12) for q in Q)


def test_empty_and_ranges(spark):
    assert percentiles(partial_counts(table(spark, []), ["k"], {"x": None}, ALPHA), ["k"], {"x": Q}, ALPHA).count() == 0
    rows = [("a", 0, v) for v in (-0.1, 0.0, 100.0, 100.1)]
    got = percentiles(partial_counts(table(spark, rows), ["k"], {"x": (0.0, 100.0)}, ALPHA), ["k"], {"x": [0.5]}, ALPHA).first()
    assert got["n"] == 2 and got["low"] <= 50 <= got["high"]


@settings(max_examples=200)
@given(stg.floats(min_value=1e-300, max_value=1e300))
def test_bucket_width_is_relative(x):
    g = growth(ALPHA)
    i = math.ceil(math.log(x) / math.log(g))
    middle = 2 * math.exp(i * math.log(g)) / (g + 1)
    assert abs(middle - x) <= ALPHA * x * (1 + 1e-6)


def test_small_alpha_keeps_sign_order_and_bound(spark):
    xs = [1e-300, 1e-250, 1e-240, 1e-230, 1e-3, 1.0, 1e200, 1e300]
    rows = [("a", 0, s * x) for x in xs for s in (1, -1)] + [("a", 0, 0.0)]
    true = sorted(v for _, _, v in rows)
    q = [i / (len(true) - 1) for i in range(len(true))]
    for alpha in (1e-3, 1e-4, 1e-6):
        p = percentiles(partial_counts(table(spark, rows), ["k"], {"x": None}, alpha), ["k"], {"x": q}, alpha)
        got = {r["q"]: r for r in p.collect()}
        for x, at in zip(true, q, strict=True):
            r = got[at]
            near = min(true, key=lambda v: abs(r["estimate"] - v))
            assert r["low"] <= r["estimate"] <= r["high"] and r["low"] <= x <= r["high"] and near == x
            if r["frac"] == 0:
                assert abs(r["estimate"] - x) <= alpha * abs(x) * (1 + 1e-6)
    with pytest.raises(ValueError, match="alpha"):
        growth_of = partial_counts(table(spark, rows), ["k"], {"x": None}, 0.0)
        growth_of.count()


def test_exact_orders_many_values_of_one_bucket_and_null_keys(spark):
    rnd = random.Random(3)
    rows = [(k, 0, 50 + rnd.random() / 1000) for k in ("a", None) for _ in range(3000)] + [(None, 0, 50.0)] * 4000
    d = table(spark, rows)
    p = percentiles(partial_counts(d, ["k"], {"x": None}, ALPHA), ["k"], {"x": Q}, ALPHA)
    got = {(r["k"], r["q"]): r["value"] for r in exact(d, ["k"], {"x": None}, p, ALPHA).collect()}
    for k in ("a", None):
        x = np.array([v for kk, _, v in rows if kk == k])
        assert all(math.isclose(got[k, q], np.percentile(x, 100 * q), rel_tol=1e-12) for q in Q)
