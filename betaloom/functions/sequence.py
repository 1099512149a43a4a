"""Sequence features as column expressions: flanks, composition, strand, context, entropy, complement, complexity.

A flank of `width` bases on either side surrounds the cytosine, which stands at 0-based offset `width`. Null sequences
give null; ratios without G or C are NaN. All expressions stay in generated code but bwt_ratio, whose transform has none.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.shared import ship
from betaloom.vocab import BASES

ship(__name__)

FLANK, CONTEXT = 70, 5


def window(seq: Column, center: int, before: int, after: int) -> Column:
    """Bases from `before` left of the 0-based center to `after` right of it."""
    return F.substring(seq, center - before + 1, before + after + 1)


def base_at(seq: Column, offset: int) -> Column:
    return F.substring(seq, offset + 1, 1)


def count_base(seq: Column, base: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, base, ""))


def with_base_counts(df: DataFrame, seq: Column, prefix: str = "n_") -> tuple[DataFrame, dict[str, Column]]:
    """df with a column per base, and these by base: counted in a step of their own, so that measures made of them count once."""
    return df.withColumns({f"{prefix}{b.lower()}": count_base(seq, b) for b in "ACGT"}), {b: F.col(f"{prefix}{b.lower()}") for b in "ACGT"}


def _counts(seq: Column, counts: dict[str, Column] | None) -> dict[str, Column]:
    return counts or {b: count_base(seq, b) for b in "ACGT"}


def gc_content(seq: Column, width: int = FLANK, counts: dict[str, Column] | None = None) -> Column:
    """Share of G and C; the divisor is 2 * width + 2 (one more than the window holds), as models were fitted."""
    n = _counts(seq, counts)
    return (n["G"] + n["C"]) / F.lit(2.0 * width + 2)


def _over_gc(top: Column, n: dict[str, Column]) -> Column:
    gc = n["G"] + n["C"]
    return F.when(gc == 0, F.lit(float("nan"))).otherwise(top / F.when(gc != 0, gc))


def gc_skew(seq: Column, counts: dict[str, Column] | None = None) -> Column:
    n = _counts(seq, counts)
    return _over_gc((n["G"] - n["C"]).cast("double"), n)


def cpg_gc_ratio(seq: Column, counts: dict[str, Column] | None = None) -> Column:
    """Non-overlapping GC or CG pairs over G and C."""
    return _over_gc(F.regexp_count(seq, F.lit("(GC|CG)")).cast("double"), _counts(seq, counts))


def strand(seq: Column, center: int) -> Column:
    b = base_at(seq, center)
    return F.when(b == "C", "+").when(b == "G", "-").otherwise(".")


def context_type(seq: Column, center: int) -> Column:
    """CpG, CHG or CHH from the two bases downstream on the cytosine's strand; ? for any other base."""
    b = lambda i: base_at(seq, center + i)
    plus = F.when(b(1) == "G", "CpG").when(b(2) == "G", "CHG").otherwise("CHH")
    minus = F.when(b(-1) == "C", "CpG").when(b(-2) == "C", "CHG").otherwise("CHH")
    return F.when(b(0) == "C", plus).when(b(0) == "G", minus).otherwise("?")


def shannon_entropy(seq: Column, counts: dict[str, Column] | None = None) -> Column:
    """Bits per base over A, C, G, T; other letters only lengthen the divisor; 0 for the empty sequence."""
    n = F.length(seq)
    total = F.lit(0.0)
    for x in _counts(seq, counts).values():
        share = x / F.when(n > 0, n)
        total = total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    return F.when(seq.isNotNull(), total)


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGT", "TGCA")


def plus_oriented(seq: Column, center: int = CONTEXT) -> Column:
    """The sequence if its centre is a C, else its reverse complement."""
    return F.when(base_at(seq, center) == "C", seq).otherwise(reverse_complement(seq))


def neighbours(seq: Column) -> dict[str, Column]:
    """b5..b1 and a1..a5 of an 11-base context."""
    s = plus_oriented(seq)
    return {k: base_at(s, i) for k, i in BASES.items()}


def complexity_window(seq: Column, flank: int, width: int) -> Column:
    """The part used for complexity measures: from flank - width on, 2 * width + 2 bases as far as there are."""
    return F.substring(seq, flank - width + 1, 2 * width + 2)


def _bwt_runs(s: str) -> int:
    t = s + "$"
    last = [t[i - 1] for i in sorted(range(len(t)), key=lambda i: t[i:])]
    return 1 + sum(a != b for a, b in zip(last, last[1:], strict=False))


def bwt_ratio(seq: Column) -> Column:
    """Runs in the Burrows-Wheeler transform over its length; our definition, as none is published. Null for null or empty."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        known = {x: _bwt_runs(x) / (len(x) + 1) for x in s.dropna().unique() if x}
        return s.map(known).astype("float64")

    return run(seq)
