import math

from pyspark.sql import functions as F

from betaloom.operators.profile import Check, coarse, column_profile, dominant_masks, failed_checks, mask, mask_drift, mask_profile, pattern_violations, rare_masks, value_counts, value_drift

CHECKS = {"x": Check(0, 100), "k": Check(1, 10)}
LOADS = [(1, None), (2, 1), (3, 9), (4, 4)]


def counts(spark, rows):
    return value_counts(spark.createDataFrame(rows, "load long, x double, k long, value string, n string, mask string"), "load", CHECKS)


def rows_of(load, xs, ks):
    return [(load, x, k, "v", "n", "m") for x, k in zip(xs, ks, strict=True)]


def test_mask(spark):
    got = spark.createDataFrame([("76.19",), ("-1.0E-5",), ("Aé9",), ("",)], "t string").select(mask(F.col("t"))).collect()
    assert [r[0] for r in got] == ["99.99", "-9.9a-9", "aa9", ""]


def test_profile_counts_nan_as_null_and_infinity_as_out_of_range(spark):
    c = counts(spark, rows_of(1, [None, math.nan, math.inf, -1.0, 5.5, 5.5], [1, 1, 2, 11, None, 0]))
    got = {r["column_name"]: r for r in column_profile(mask_profile(c, CHECKS)).collect()}
    x, k = got["x"], got["k"]
    assert (x["n_rows"], x["n_null"], x["n_present"], x["n_in_range"], x["n_distinct"], x["n_distinct_in_range"]) == (6, 2, 4, 2, 3, 1)
    assert (k["n_null"], k["n_in_range"], k["n_distinct_in_range"], k["min_value"], k["max_value"]) == (1, 3, 2, 0.0, 11.0)


def test_drift_equals_brute_force(spark):
    a, b = [float(i % 40) for i in range(200)], [float((i * 7) % 60) for i in range(300)]
    c = counts(spark, rows_of(1, a, [1] * 200) + rows_of(2, b, [2] * 300) + rows_of(3, b, [2] * 300))
    loads = spark.createDataFrame(LOADS, "load_id long, ref_load_id long")
    got = {(r["load_id"], r["column_name"]): r["drift"] for r in value_drift(c, loads, CHECKS).collect()}
    cdf = lambda s, v: sum(y <= v for y in s) / len(s)
    assert math.isclose(got[2, "x"], max(abs(cdf(a, v) - cdf(b, v)) for v in a + b), abs_tol=1e-12)
    assert math.isclose(got[2, "k"], 1.0) and (3, "x") not in got  # load 3 names a reference that is not there


def test_masks_report_rare_and_moved(spark):
    c = counts(spark, rows_of(1, [5.5] * 2000, [1] * 2000) + rows_of(2, [5.5] * 1999 + [1e-9], [1] * 2000))
    m = mask_profile(c, CHECKS)
    assert [(r["load_id"], r["mask"]) for r in rare_masks(m).collect()] == [(2, "9.9a-9")]
    loads = spark.createDataFrame(LOADS, "load_id long, ref_load_id long")
    got = {(r["load_id"], r["column_name"]): r["mask_divergence"] for r in mask_drift(m, loads).collect()}
    assert 0 < got[2, "x"] < 0.001 and got[2, "k"] == 0.0


def test_text_columns_have_patterns(spark):
    rows = [(1, f"chr{i % 22 + 1}") for i in range(990)] + [(1, None)] * 5 + [(2, "chr1")] * 300 + [(2, "Chr 1"), (2, ""), (2, "7")]
    checks = {"c": Check(), "d": Check(0, 5)}
    d = spark.createDataFrame([(a, b, b if b == "7" else "3") for a, b in rows], "load long, c string, d string")
    m = mask_profile(value_counts(d, "load", checks), checks)
    assert {(r["load_id"], r["mask"], r["n_rows"]) for r in m.filter("column_name = 'c'").collect()} == {(1, "aaa9", 405), (1, "aaa99", 585), (1, "null", 5), (2, "aaa9", 300), (2, "aaa 9", 1), (2, "", 1), (2, "9", 1)}
    assert [(r["coarse_mask"], r["n_rows"]) for r in dominant_masks(m).filter("column_name = 'c'").collect()] == [("a9", 1290)]
    got = {(r["load_id"], r["column_name"]): (r["n_violating"], r["n_present"]) for r in pattern_violations(m).collect()}
    assert got == {(1, "c"): (0, 990), (2, "c"): (3, 303), (1, "d"): (0, 995), (2, "d"): (0, 303)}
    prof = {(r["load_id"], r["column_name"]): r for r in column_profile(m).collect()}
    assert prof[2, "d"]["n_in_range"] == 302 and prof[2, "d"]["max_value"] == 7 and prof[1, "c"]["n_null"] == 5 and prof[1, "c"]["n_distinct"] == 22
    loads = spark.createDataFrame([(1, None), (2, 1)], "load_id long, ref_load_id long")
    failed = {tuple(r) for r in failed_checks(value_counts(d, "load", checks), loads, checks, {}).collect()}
    assert (2, "c", "rare_mask") in failed and (2, "c", "mask_drift") in failed and not any(r[0] == 1 and r[2] == "rare_mask" for r in failed)


def test_coarse_mask(spark):
    got = spark.createDataFrame([("999.99",), ("aa9_a9_9",), ("",), (None,)], "t string").select(coarse(F.col("t"))).collect()
    assert [r[0] for r in got] == ["9.9", "a9_a9_9", "", None]


def test_empty(spark):
    c = counts(spark, [])
    loads = spark.createDataFrame([], "load_id long, ref_load_id long")
    assert failed_checks(c, loads, CHECKS, {"a": "x"}).count() == 0
