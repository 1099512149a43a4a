"""The same or nearly the same records across splits, by similarity-preserving bit fingerprints.

A fingerprint has a position code and a value code of four segments each. Segment j is the Gray code of the record's cell on
a grid of cells four steps wide, shifted by j steps, a step being the radius. The lines of the four grids lie one step
apart, and cells next to each other differ in one bit: a record that lies k steps off differs in about k bits, as long as
it is near, and one within the radius in one bit of each code at most. So near records have a Hamming distance of at
most two, while records that share a cell may lie four steps apart in either code and be at a distance of up to eight.

Since at most one segment of either code differs, two segments of each are enough to find all near records: the tables of
the four permuted pairs (position segment, value segment) are joined across splits together with a hash of the exact
fields. Candidates beyond the Hamming radius are dropped, and what is left is verified on the values themselves. A pair is
kept only at the first pair of segments it shares, so that nothing has to be made distinct.

A value of at most 1 may also stand for a fraction of 100: each record enters with every reading of its value, and a
pair is kept at the first pair of readings that verifies. Missing values match only missing values.

Because the value is part of the join key, a position that holds a third of all rows is cut by value; beyond that the
join's size follows the number of pairs that verify. Skewed keys are left to the adaptive skew join.

Defined results: a record with a null exact field or position matches nothing; NaN counts as missing; repeated records are
records of their own; empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reach in positions and in value, and slack for the rounding of decimal values.
POS_RADIUS, VALUE_RADIUS, SLACK = 2, 0.5, 1e-9
#: Segments of a code, those of them that are joined on, and the Hamming radius of both codes together.
SEGMENTS, JOINED, BIT_RADIUS = 4, (0, 2), 2
#: Cell of a missing value, out of reach of all others.
MISSING = -(2**40)


def contig(c: Column) -> Column:
    """One spelling per contig: blanks and case dropped, prefix `chr` restored."""
    bare = F.regexp_replace(F.lower(F.trim(c)), "^chr", "")
    return F.when(bare != "", F.concat(F.lit("chr"), F.upper(bare)))


def gray(n: Column) -> Column:
    """Code of a whole number in which neighbours differ in one bit."""
    return n.bitwiseXOR(F.shiftrightunsigned(n, 1))


def segments(x: Column, step: float) -> list[Column]:
    """Code of a number: Gray codes of its cells on shifted grids, whose lines lie a step apart."""
    return [gray(F.coalesce(F.floor((x + j * step) / (SEGMENTS * step)), F.lit(MISSING).cast("long"))) for j in range(SEGMENTS)]


def hamming(a: list[Column], b: list[Column]) -> Column:
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b, strict=True)), F.lit(0))


def _code(pos: str, x: str, pos_radius: float, value_radius: float) -> tuple[list[Column], list[Column]]:
    """Position and value segments. Whole positions need no slack."""
    return segments(F.col(pos), pos_radius), segments(F.col(x), value_radius + 2 * SLACK)


def coded(df: DataFrame, rec_id: str, exact: Sequence[str], pos: str, value: str, carry: Sequence[str], pos_radius: float = POS_RADIUS, value_radius: float = VALUE_RADIUS) -> DataFrame:
    """One row per record, reading of its value and permuted pair of segments: the pair's number and key, and the record.

    Fingerprints follow from the record, so the shuffle carries one key of 64 bits instead of them.
    """
    v = F.when(~F.isnan(value), F.col(value).cast("double"))
    base = df.select(F.col(rec_id).alias("rec"), *[F.col(e).alias(f"e{i}") for i, e in enumerate(exact)], F.col(pos).cast("double").alias("pos"), v.alias("v"), *carry)
    ex = [f"e{i}" for i in range(len(exact))]
    base = base.filter(" and ".join(f"{x} is not null" for x in ["rec", "pos", *ex]))
    readings = F.when(F.col("v") <= 1, F.array(F.struct(F.lit(0).alias("no"), F.col("v").alias("x")), F.struct(F.lit(1).alias("no"), (F.col("v") * 100).alias("x")))).otherwise(F.array(F.struct(F.lit(0).alias("no"), F.col("v").alias("x"))))
    d = base.select("*", F.explode(readings).alias("r")).select("rec", "pos", "v", *carry, *ex, F.col("r.no").alias("no"), F.col("r.x").alias("x"))
    ps, vs = _code("pos", "x", pos_radius, value_radius)
    perms = F.array(*[F.struct(F.lit(2 * i + j).cast("byte").alias("perm"), F.xxhash64(*ex, F.lit(2 * i + j), ps[p], vs[v]).alias("code")) for i, p in enumerate(JOINED) for j, v in enumerate(JOINED)])
    return d.select("*", F.explode(perms).alias("k")).select("*", "k.perm", "k.code").drop("k")


def candidates(train: DataFrame, other: DataFrame, n_exact: int, carry: Sequence[str] = (), pos_radius: float = POS_RADIUS, value_radius: float = VALUE_RADIUS) -> DataFrame:
    """Pairs that share a permuted pair of segments, each at the first it shares, with their Hamming `distance`."""
    cols = ["rec", "pos", "v", "no", "x", *[f"e{i}" for i in range(n_exact)]]
    t = train.select("perm", "code", *[F.col(c).alias(f"t_{c}") for c in cols])
    o = other.select("perm", "code", *[F.col(c).alias(f"o_{c}") for c in cols], *carry)
    (tp, tv), (op, ov) = (_code(f"{s}_pos", f"{s}_x", pos_radius, value_radius) for s in "to")
    k = JOINED[0]
    first = ((F.col("perm") < 2) | (tp[k] != op[k])) & ((F.col("perm") % 2 == 0) | (tv[k] != ov[k]))
    return t.join(o, ["perm", "code"]).filter(first).withColumn("distance", hamming(tp, op) + hamming(tv, ov))


def pairs(train: DataFrame, other: DataFrame, n_exact: int, carry: Sequence[str] = (), pos_radius: float = POS_RADIUS, value_radius: float = VALUE_RADIUS) -> DataFrame:
    """Verified pairs of two coded tables: rec_t, rec_o, and carried columns of the other side."""
    j = candidates(train, other, n_exact, carry, pos_radius, value_radius).filter(F.col("distance") <= BIT_RADIUS)
    near = lambda a, b: F.abs(a - b) <= value_radius + SLACK
    tv, ov, tx, ox = F.col("t_v"), F.col("o_v"), F.col("t_x"), F.col("o_x")
    value_ok = (tv.isNull() & ov.isNull()) | F.coalesce(near(tx, ox), F.lit(False))
    # readings in the order (0,0), (1,0), (0,1), (1,1): an earlier one that holds makes this one a repeat
    plain, left, right = near(tv, ov), (tv <= 1) & near(tv * 100, ov), (ov <= 1) & near(tv, ov * 100)
    tn, on = F.col("t_no"), F.col("o_no")
    repeat = ((tn + on > 0) & plain) | ((on == 1) & left) | ((tn == 1) & (on == 1) & right)
    exact_ok = F.lit(True)
    for e in [f"e{i}" for i in range(n_exact)]:
        exact_ok = exact_ok & (F.col(f"t_{e}") == F.col(f"o_{e}"))
    ok = exact_ok & (F.abs(F.col("t_pos") - F.col("o_pos")) <= pos_radius) & value_ok & ~F.coalesce(repeat, F.lit(False))
    return j.filter(ok).select(F.col("t_rec").alias("rec_t"), F.col("o_rec").alias("rec_o"), *carry)
