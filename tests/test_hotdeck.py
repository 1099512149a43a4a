import random

from pyspark.sql import functions as F

from betaloom.operators import hotdeck
from betaloom.operators.hotdeck import Field, fill, hot_deck

SCHEMA = "rid long, grp string, pos long, val double, extra string, level string, value string, id string"


def cells(spark, rows, width, levels=None):
    df = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)
    out = hot_deck(df, "rid", "pos", [Field("val", F.col("val"))], levels or {"group": ["grp"]}, width)
    return df, out, sorted([(r["row_id"], r["value"], r["donor_id"], r["distance"], r["level"]) for r in out.collect()], key=str)


def brute(rows):
    out = []
    for rid, g, p, v in rows:
        if v is not None:
            continue
        own = [r for r in rows if r[1] == g and r[3] is not None]
        prev = max([r for r in own if (r[2], r[0]) < (p, rid)], key=lambda r: (r[2], r[0]), default=None)
        nxt = min([r for r in own if (r[2], r[0]) > (p, rid)], key=lambda r: (r[2], r[0]), default=None)
        pick = nxt if prev is None or (nxt is not None and nxt[2] - p < p - prev[2]) else prev
        if pick is not None:
            out.append((rid, str(pick[3]), pick[0], abs(pick[2] - p), "group"))
    return sorted(out, key=str)


def test_equals_brute_force_over_stretches(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("abc"), rnd.randrange(400), None if rnd.random() < 0.4 else float(rnd.randrange(9))) for i in range(300)]
    for width in (7, 100_000):
        assert cells(spark, rows, width)[2] == brute(rows)


def test_positions_with_very_many_rows_are_cut_by_id(spark, monkeypatch):
    for k, v in (("HOT_SAMPLE", 1.0), ("HOT_LEAST", 15), ("HOT_PARTS", 4)):
        monkeypatch.setattr(hotdeck, k, v)
    rnd = random.Random(4)
    rows = [(i, rnd.choice("ab"), rnd.choice([3, 3, 3, 3, 9, 20, 20, 20, *range(30)]), None if rnd.random() < 0.5 else float(rnd.randrange(9))) for i in range(400)]
    rows += [(1000 + i, "c", 5, 1.0 if i == 57 else None) for i in range(100)]  # a single donor among a hundred
    for width in (7, 1000):
        assert cells(spark, rows, width)[2] == brute(rows)


def test_levels_and_no_donor(spark):
    rows = [(1, "a", 10, None), (2, "b", 14, 3.0), (3, "b", 7, 4.0)]
    assert cells(spark, rows, 5)[2] == [(1, "4.0", 3, 3, "any")]
    assert cells(spark, [(1, "a", 10, None)], 5)[2] == [(1, None, None, None, "none")]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, None, 10, None), (2, None, 8, 5.0), (3, None, 12, 6.0), (4, "a", None, None), (5, "a", None, 7.0), (6, "a", 3, 8.0)]
    got = {r[0]: r for r in cells(spark, rows, 5)[2]}
    assert got[1] == (1, "5.0", 2, 2, "group")  # a tie goes to the previous donor, a null group is a group
    assert got[4][1:4] == ("7.0", 5, None)  # no position: no distance
    assert len(cells(spark, [(1, "a", 1, None), (1, "a", 1, None), (2, "a", 1, 1.0)], 5)[2]) == 2
    assert cells(spark, [], 5)[2] == []


def test_fill_marks_only_what_it_filled(spark):
    df, c, _ = cells(spark, [(1, "a", 1, None), (2, "a", 2, 2.0)], 5)
    got = {r["rid"]: r for r in fill(df, "rid", "val", "val", F.col("val"), c).collect()}
    assert got[1]["val"] == 2.0 and got[1]["val_filled"] and got[1]["val_donor"] == 2 and got[1]["val_distance"] == 1
    assert got[2]["val"] == 2.0 and not got[2]["val_filled"] and got[2]["extra"] == "x"


def test_rows_without_position_are_cut_by_id(spark):
    rnd = random.Random(6)
    rows = [(i * 3, rnd.choice("ab"), None, None if rnd.random() < 0.7 else float(rnd.randrange(9))) for i in range(200)] + [(1000, "a", 5, None), (1001, "a", 6, 4.0)]
    want = []
    for rid, g, p, v in rows:
        own = [r for r in rows if r[1] == g and r[3] is not None and r[2] is None]
        if v is None and p is None:
            pick = max([r for r in own if r[0] < rid], default=None) or min(r for r in own if r[0] > rid)
            want.append((rid, str(pick[3]), pick[0], None, "group"))
    for width in (7, 100_000):
        assert cells(spark, rows, width)[2] == sorted([*want, (1000, "4.0", 1001, 1, "group")], key=str)
