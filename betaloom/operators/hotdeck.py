"""Filling missing cells from similar records: sequential hot-deck.

Records are sorted by position within groups; a cell without usable value takes that of the nearest previous or next
donor, with the donor's id and its distance. A group may hold a third of all rows: groups are cut into stretches of
`width` positions, and single positions that hold very many rows by their ids; nearest donors are found inside each stretch, and for cells near its ends the first and last donors
of other stretches of the group are carried over, one row a stretch. Cells of groups without any donor go on to the next,
wider level.

Defined results: the previous donor wins a tie in distance, and among rows at one position the id orders them. A null
group value is a group of its own; a record without position has no distance, and takes a
donor (the one before it by id, else the one after) only from records without position in its group or at a later level by the same rule. A cell stays without value
only if no record of the table has one. Repeated rows (equal ids) are cells of their own. An empty table gives no cells. Ids are whole numbers.
Input columns other than those named are not read, so that extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.shared import cut_lineage, sized


@dataclass(frozen=True)
class Field:
    """A column to fill: `usable` gives its value where it may be kept and donated, else null."""

    name: str
    usable: Column


#: A position with at least HOT_LEAST rows in a sample of HOT_SAMPLE of the table is cut by id into HOT_PARTS parts.
#: The sample decides only how the work is split; every row takes part whatever it holds.
HOT_SAMPLE, HOT_LEAST, HOT_PARTS = 0.001, 100, 64


def _blocks(base: DataFrame, groups: Sequence[str], width: int) -> DataFrame:
    """base with stretch, part_pos and part, whose order follows (pos, id) and whose groups fit in a task.

    A stretch is one block, unless positions in it hold very many rows: then it is cut before and after each of these,
    and they are cut by bounds of their ids. Rows without position are cut by `width` ids.
    """
    by_id = F.floor(F.col("id") / F.lit(width)).cast("long")
    d = base.withColumn("stretch", F.floor(F.col("pos") / F.lit(width)).cast("long"))
    cuts = F.array(*[F.lit(i / HOT_PARTS) for i in range(1, HOT_PARTS)])
    hot = d.filter("pos is not null").sample(HOT_SAMPLE, 1).groupBy(*groups, "stretch", "pos").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("id", cuts).alias("bounds"))
    hot = cut_lineage(hot.filter(F.col("n") >= HOT_LEAST).groupBy(*groups, "stretch").agg(F.array_sort(F.collect_list(F.struct("pos", "bounds"))).alias("hot")))
    if hot.isEmpty():
        return d.withColumn("part_pos", F.lit(0).cast("long")).withColumn("part", F.when(F.col("pos").isNull(), by_id).otherwise(F.lit(0).cast("long")))
    h = sized(hot.select(*[F.col(k).alias(f"h_{k}") for k in [*groups, "stretch"]], "hot"))
    cond = F.lit(True)
    for k in [*groups, "stretch"]:
        cond = cond & d[k].eqNullSafe(h[f"h_{k}"])
    d = d.join(h, cond, "left")
    last = F.try_element_at(F.filter(F.coalesce("hot", F.array().cast(hot.schema["hot"].dataType)), lambda x: x["pos"] <= F.col("pos")), F.lit(-1))
    d = d.withColumn("last_hot", last)
    inside = 1 + F.size(F.filter(F.col("last_hot.bounds"), lambda x: x < F.col("id")))
    part = F.when(F.col("pos").isNull(), by_id).when(F.col("last_hot").isNull(), 0).when(F.col("last_hot.pos") == F.col("pos"), inside).otherwise(HOT_PARTS + 1)
    return d.withColumn("part_pos", F.coalesce(F.col("last_hot.pos"), F.lit(-(2**63)))).withColumn("part", part.cast("long")).select(*base.columns, "stretch", "part_pos", "part")


def _search(base: DataFrame, groups: Sequence[str], names: Sequence[str], width: int) -> DataFrame:
    """base: id, groups, pos, cell (bool: to be filled here) and a value per name. Cells with d_<name>: the nearest donor."""
    block = ["stretch", "part_pos", "part"]
    keys = [*groups, *block]
    d = _blocks(base, groups, width)
    fwd, bwd = W.partitionBy(*keys).orderBy("pos", "id"), W.partitionBy(*keys).orderBy(F.col("pos").desc_nulls_last(), F.col("id").desc_nulls_last())
    for n in names:
        donor = F.when(F.col(n).isNotNull(), F.struct(F.col("pos").alias("pos"), F.col("id").alias("id"), F.col(n).alias("value")))
        d = d.withColumn(f"p_{n}", F.last(donor, ignorenulls=True).over(fwd)).withColumn(f"n_{n}", F.last(donor, ignorenulls=True).over(bwd))
    d = d.withColumn("is_last", F.lead(F.lit(1)).over(fwd).isNull()).withColumn("is_first", F.lag(F.lit(1)).over(fwd).isNull())
    # what goes on: cells to fill, and the ends of stretches with the donors they can hand on
    kept = cut_lineage(d.filter(F.col("cell") | F.col("is_last") | F.col("is_first")))
    cells = kept.filter("cell")
    ends = kept.groupBy(*keys).agg(
        *[F.max(F.when(F.col("is_last"), F.col(f"p_{n}"))).alias(f"last_{n}") for n in names],
        *[F.max(F.when(F.col("is_first"), F.col(f"n_{n}"))).alias(f"first_{n}") for n in names],
    )
    # rows without position neither give to nor take from the others
    placed = F.col("stretch").isNotNull()
    before = W.partitionBy(*groups, placed).orderBy(*block).rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy(*groups, placed).orderBy(*[F.col(b).desc_nulls_last() for b in block]).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(k).alias(f"k_{k}") for k in keys],
        *[F.last(f"last_{n}", ignorenulls=True).over(before).alias(f"cp_{n}") for n in names],
        *[F.last(f"first_{n}", ignorenulls=True).over(after).alias(f"cn_{n}") for n in names],
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & cells[k].eqNullSafe(carried[f"k_{k}"])
    out = cells.join(carried, cond, "left")
    for n in names:
        p, q = F.coalesce(F.col(f"p_{n}"), F.col(f"cp_{n}")), F.coalesce(F.col(f"n_{n}"), F.col(f"cn_{n}"))
        nearer = q.isNotNull() & (p.isNull() | ((q["pos"] - F.col("pos")) < (F.col("pos") - p["pos"])))
        out = out.withColumn(f"d_{n}", F.when(nearer, q).otherwise(p))
    return out.select("id", "pos", *[c for c in base.columns if c not in ("id", "pos", "cell")], *[f"d_{n}" for n in names])


def hot_deck(df: DataFrame, id_col: str, pos_col: str, fields: Sequence[Field], levels: Mapping[str, Sequence[str]], width: int = 100_000) -> DataFrame:
    """One row per cell without usable value: id, field, value (text), donor_id, distance, level.

    levels: name and grouping columns of each level, narrowest first; a last level `any` over the whole table is
    added. Beyond the first level donors are reduced to one a position (the least id) before they are sorted.
    """
    names = [f"v{i}" for i in range(len(fields))]
    groups = list(dict.fromkeys(g for gs in levels.values() for g in gs))
    g_alias = {g: f"g{i}" for i, g in enumerate(groups)}
    base = df.select(F.col(id_col).alias("id"), F.col(pos_col).alias("pos"), *[F.col(g).alias(a) for g, a in g_alias.items()], *[f.usable.cast("string").alias(n) for f, n in zip(fields, names, strict=True)])
    missing = F.lit(False)
    for n in names:
        missing = missing | F.col(n).isNull()
    steps = [*levels.items(), ("any", [])]
    first = [g_alias[g] for g in steps[0][1]]
    found = _search(base.withColumn("cell", missing), first, names, width)
    long = found.select("id", "pos", *g_alias.values(), F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(n).isNull().alias("todo"), F.col(f"d_{n}").alias("d")) for i, n in enumerate(names)])).alias("x")).filter("x.todo").select("id", "pos", *g_alias.values(), F.col("x.f").alias("f"), F.col("x.d").alias("d"), F.lit(steps[0][0]).alias("level"))
    done = cut_lineage(long)
    for name, gs in steps[1:]:
        left = done.filter("d is null")
        if left.isEmpty():
            break
        cols = [g_alias[g] for g in gs]
        parts = []
        for i, n in enumerate(names):
            todo = left.filter(F.col("f") == i)
            donors = base.filter(F.col(n).isNotNull()).groupBy(*cols, "pos").agg(F.min(F.struct("id", n)).alias("m")).select(*cols, "pos", F.col("m.id").alias("id"), F.col(f"m.{n}").alias(n), F.lit(False).alias("cell"))
            rest = [a for a in g_alias.values() if a not in cols]
            donors = donors.select("*", *[F.lit(None).cast(base.schema[a].dataType).alias(a) for a in rest])
            cells = todo.select(*cols, "pos", "id", F.lit(None).cast("string").alias(n), F.lit(True).alias("cell"), *rest)
            parts.append(_search(donors.unionByName(cells), cols, [n], width).select("id", "pos", *g_alias.values(), F.lit(i).alias("f"), F.col(f"d_{n}").alias("d"), F.lit(name).alias("level")))
        more = parts[0]
        for p in parts[1:]:
            more = more.unionByName(p)
        done = cut_lineage(done.filter("d is not null").unionByName(more))
    label = F.lit(None).cast("string")
    for i, f in enumerate(fields):
        label = F.when(F.col("f") == i, F.lit(f.name)).otherwise(label)
    return done.select(
        F.col("id").alias("row_id"),
        label.alias("field"),
        F.col("d.value").alias("value"),
        F.col("d.id").alias("donor_id"),
        F.abs(F.col("d.pos") - F.col("pos")).alias("distance"),
        F.when(F.col("d").isNull(), F.lit("none")).otherwise(F.col("level")).alias("level"),
    )


def fill(df: DataFrame, id_col: str, field: str, column: str, usable: Column, cells: DataFrame) -> DataFrame:
    """df with `column` filled from the cells of `field`, and <column>_filled, <column>_donor, <column>_distance beside it.

    Only cells are joined, on the id; rows whose value is usable keep it as `usable` gives it.
    """
    kind = df.schema[column].dataType
    c = cells.filter(F.col("field") == field).select(F.col("row_id").alias("_id"), F.col("value").alias("_value"), F.col("donor_id").alias("_donor"), F.col("distance").alias("_distance")).dropDuplicates(["_id"])
    d = df.withColumn("_usable", usable)
    return (
        d.join(c, d["_usable"].isNull() & d[id_col].eqNullSafe(c["_id"]), "left")
        .withColumn(column, F.coalesce(F.col("_usable"), F.col("_value").cast(kind)).cast(kind))
        .withColumn(f"{column}_filled", F.col("_usable").isNull() & F.col("_value").isNotNull())
        .withColumn(f"{column}_donor", F.col("_donor"))
        .withColumn(f"{column}_distance", F.col("_distance"))
        .drop("_usable", "_id", "_value", "_donor", "_distance")
    )
