"""Values at given ranks of large groups, exactly, without a group in one task.

A group of up to SMALL values is sorted in a task. Of a larger one, the values are counted in cells, first by sign and power of two,
then by equal widths between the least and the greatest value of the one cell that holds the wanted rank, until that cell has one
value, or the rank is its first or last. A pass is a partial count, so a task holds CELLS numbers for each group and rank and
no values; five passes are enough for any doubles, two or three for most. What one pass leaves to the next is a small table written to the
shared folder.

Nulls don't count. NaN comes after all numbers, as in Spark's order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import store

SMALL = 1 << 16
CELLS = 4096
#: Rows of a table of groups up to which it is broadcast.
BROADCAST = 1_000_000
NAN_CELL = 1 << 20


def bounded(table: DataFrame) -> DataFrame:
    """For a join: broadcast if it is counted to be small, else as Spark chooses."""
    return F.broadcast(table) if table.count() <= BROADCAST else table


def _magnitude(v: Column) -> Column:
    """Sign and power of two, in order of the values."""
    size = F.floor(F.log2(F.abs(v))) + 1100
    return F.when(F.isnan(v), NAN_CELL).when(v == 0, 0).when(F.abs(v) == float("inf"), F.signum(v) * 2200).otherwise(F.signum(v) * size).cast("int")


def _width(v: Column, lo: Column, hi: Column) -> Column:
    """One of CELLS equal parts of lo to hi, which are of one sign and power of two."""
    return F.least(F.floor((v - lo) / (hi - lo) * CELLS), F.lit(CELLS - 1)).cast("int")


def _narrowed(counts: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """Of each wanted rank (counted from its bracket's first value) the cell that holds it, as a new bracket. counts: rows of by and
    bracket, cell, n, lo, hi."""
    order = Window.partitionBy(*by, "bracket").orderBy("cell")
    upto = counts.withColumn("upto", F.sum("n").over(order))  # a few thousand cells of a group
    hit = wanted.select(*by, "bracket", "rank", "left").join(upto, [*by, "bracket"]).where((F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n")))
    left = F.col("left") - (F.col("upto") - F.col("n"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(left == 0, F.col("lo")).when(left == F.col("n") - 1, F.col("hi"))
    return hit.select(*by, "rank", left.alias("left"), F.dense_rank().over(Window.partitionBy(*by).orderBy("bracket", "cell")).alias("bracket"), "lo", "hi", value.alias("value"))


def _large(rows: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """(by, rank, value) by passes over the rows (by, v)."""
    cells = rows.groupBy(*by, F.lit(0).alias("bracket"), _magnitude(F.col("v")).alias("cell")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    state = store.saved(_narrowed(cells, wanted.select(*by, "rank", F.col("rank").alias("left"), F.lit(0).alias("bracket")), by))
    found = []
    while True:
        found.append(state.where("value is not null").select(*by, "rank", "value"))
        open_ = state.where("value is null")
        if open_.isEmpty():
            break
        brackets = open_.select(*by, "bracket", F.col("lo").alias("_lo"), F.col("hi").alias("_hi")).distinct()
        inside = rows.join(bounded(brackets), by).where((F.col("v") >= F.col("_lo")) & (F.col("v") <= F.col("_hi")))
        cells = inside.groupBy(*by, "bracket", _width(F.col("v"), F.col("_lo"), F.col("_hi")).alias("cell")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        state = store.saved(_narrowed(cells, open_, by))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def at_ranks(rows: DataFrame, wanted: DataFrame, by: list[str], sizes: DataFrame | None = None) -> DataFrame:
    """(by, rank, value): of each group of rows (by, v; doubles) the values at the ranks (from 0) that `wanted` (by, rank) asks for; ranks
    that a group doesn't have are left out. sizes: (by, n), if they are known."""
    rows = rows.select(*by, "v").where("v is not null")
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n")) if sizes is None else sizes
    asked = wanted.select(*by, F.col("rank").cast("long").alias("rank")).distinct().join(sizes, by).where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    large = store.saved(asked.where(F.col("n") > SMALL))
    few = asked.where(F.col("n") <= SMALL).groupBy(*by).agg(F.collect_set("rank").alias("ranks"))
    values = rows if large.isEmpty() else rows.join(bounded(large.select(*by).distinct()), by, "left_anti")
    sorted_ = values.join(few.select(*by), by, "left_semi").groupBy(*by).agg(F.sort_array(F.collect_list("v")).alias("_v"))  # SMALL values at most
    out = sorted_.join(few, by).select(*by, F.explode("ranks").alias("rank"), "_v").select(*by, "rank", F.get("_v", F.col("rank").cast("int")).alias("value"))
    if large.isEmpty():
        return out
    groups = bounded(large.select(*by).distinct())
    return out.unionByName(_large(rows.join(groups, by, "left_semi"), large.select(*by, "rank"), by))


def quantiles(rows: DataFrame, fractions: list[float], by: list[str], between: bool = True) -> DataFrame:
    """(by, q0, q1, ...): the quantiles of each group of rows (by, v). between: linear interpolation of the values around (n - 1) *
    fraction; else the first value that has at least the fraction of all up to it."""
    rows = rows.where("v is not null")
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= SMALL:
        one = lambda q: F.percentile("v", F.lit(float(q))) if between else F.expr(f"percentile_disc({float(q)!r}) within group (order by v)")
        return rows.groupBy(*by).agg(*[one(q).alias(f"q{i}") for i, q in enumerate(fractions)])
    sizes = store.saved(sizes)
    last = F.col("n") - 1
    place = [F.lit(float(q)) * last for q in fractions]
    low = [F.floor(p) if between else F.greatest(F.ceil(F.lit(float(q)) * F.col("n")) - 1, F.lit(0)) for p, q in zip(place, fractions, strict=True)]
    high = [F.least(r + 1, last) if between else r for r in low]
    wanted = sizes.select(*by, F.explode(F.array_distinct(F.array(*[r.cast("long") for r in [*low, *high]]))).alias("rank"))
    got = at_ranks(rows, wanted, by, sizes).groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))  # two values a fraction
    both = got.join(sizes, by)
    out = []
    for i, (p, a, b) in enumerate(zip(place, low, high, strict=True)):
        x, y = (F.element_at("_at", r.cast("long")) for r in (a, b))
        part = p - a
        out.append((F.when(part == 0, x).otherwise(x * (1 - part) + y * part) if between else x).alias(f"q{i}"))
    return both.select(*by, *out)


def firsts(rows: DataFrame, by: list[str], keys: list[Column], need: Column) -> DataFrame:
    """Rows of each group among which its first `need` (a whole number, alike in a group) in the order of the keys (numbers) are: all rows of
    groups of up to SMALL, of larger ones the first, and of rows that are alike in all keys those at the end, up to SMALL.

    The value of the first key at the wanted rank divides the rows: those below it are in, those of the value are divided by the next key in the
    same way, as long as they are many. So what is sorted afterwards is about `need` rows of a group."""
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = rows.withColumns({**{n: k.cast("double") for n, k in zip(names, keys, strict=True)}, "_need": need.cast("long")})
    sizes = keyed.groupBy(*by).agg(F.count("*").alias("_n"), F.max("_need").alias("_want"))
    large = store.saved(sizes.where((F.col("_n") > SMALL) & (F.col("_want") < F.col("_n")) & (F.col("_want") > 0)))
    if large.isEmpty():
        return rows
    out = [keyed.join(bounded(large.select(*by)), by, "left_anti")]
    open_ = store.saved(keyed.join(bounded(large.select(*by)), by, "left_semi"))
    wants = large.select(*by, "_want")
    for name in names:
        got = at_ranks(open_.select(*by, F.col(name).alias("v")), wants.select(*by, (F.col("_want") - 1).alias("rank")), by)
        cut = store.saved(got.select(*by, F.col("value").alias("_t")).join(wants, by))
        parts = open_.join(bounded(cut.select(*by, "_t")), by)
        out.append(store.saved(parts.where(F.col(name) < F.col("_t")).drop("_t")))
        open_ = store.saved(parts.where(F.col(name) == F.col("_t")).drop("_t"))
        # Groups whose rows of the value are few, or all wanted, are done.
        below = out[-1].groupBy(*by).agg(F.count("*").alias("_b"))
        left = open_.groupBy(*by).agg(F.count("*").alias("_n")).join(cut, by).join(below, by, "left").select(*by, "_n", (F.col("_want") - F.coalesce("_b", F.lit(0))).alias("_want"))
        more = store.saved(left.where((F.col("_n") > SMALL) & (F.col("_want") < F.col("_n"))))
        wants = more.select(*by, "_want")
        if more.isEmpty():
            break
        out.append(open_.join(bounded(wants.select(*by)), by, "left_anti"))
        open_ = open_.join(bounded(wants.select(*by)), by, "left_semi")
    done = out[0]
    for o in [*out[1:], open_]:
        done = done.unionByName(o)
    return done.select(*rows.columns)
