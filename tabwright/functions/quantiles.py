"""Exact quantiles with linear interpolation, for columns and groups of any length, by refinement of histograms.

A pass counts the values of each open interval in equal bins, with the smallest and the largest value of each bin. The
bin that holds a wanted rank is the next interval of that rank, narrowed to the values it has. A rank is found when its
bin has one distinct value, or when it is the first or the last of its bin. Only counts are shuffled, added up inside
the tasks before; passes are few, as each divides an interval by BINS.
"""

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.lookup import broadcast_if_light
from tabwright.operators.reshape import melt
from tabwright.session import settle

BINS = 4096
INFINITE = float("inf")


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < INFINITE)


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """The bin of a value of the interval; it never falls while the value rises, and the ends are in different bins.

    Values outside all numbers have bins of their own: minus infinity -1, infinity BINS, not a number BINS + 1.
    """
    width = hi - lo
    share = F.when(width < INFINITE, (v - lo) / width).otherwise((v / 2 - lo / 2) / (hi / 2 - lo / 2))  # the width may be too large for a double
    inside = F.when(width > 0, F.least(F.floor(share * BINS), F.lit(BINS - 1))).otherwise(F.lit(0))
    return F.when(F.isnan(v), BINS + 1).when(v == INFINITE, BINS).when(v == -INFINITE, -1).otherwise(inside).cast("int")


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    return reduce(and_, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b)])


def _bins(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group…, _from, _bin, _n, _lo, _hi, _seen) of rows that hold their interval (_from, _lo, _hi) and value _v."""
    bins = rows.groupBy(*group, "_from", _bin(F.col("_v"), F.col("_lo"), F.col("_hi")).alias("_bin")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    before = W.partitionBy(*group, "_from").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    return bins.withColumn("_seen", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def _narrowed(open_: DataFrame, bins: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group…, _rank, _place, _lo, _hi, _value): each open rank in the bin that holds it, with its value if that is known."""
    names = {c: f"_b{i}" for i, c in enumerate([*group, "_from"])}
    here = _same(list(names), list(names.values())) & (F.col("_place") > F.col("_seen")) & (F.col("_place") <= F.col("_seen") + F.col("_n"))
    place = F.col("_place") - F.col("_seen")
    value = F.when((F.col("_lo") == F.col("_hi")) | (place == 1), F.col("_lo")).when(place == F.col("_n"), F.col("_hi"))
    return open_.join(bins.withColumnsRenamed(names), here).select(*group, "_rank", place.alias("_place"), "_lo", "_hi", value.alias("_value"))


def _ends(doubles: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """(by…, _c, _n, _lo, _hi): per column number the count of values and the range of the finite ones."""
    cells = [
        F.struct(F.lit(i).alias("_c"), F.count(v).alias("_n"), F.min(F.when(_finite(v), v)).alias("_lo"), F.max(F.when(_finite(v), v)).alias("_hi"))
        for i, v in ((i, F.col(f"_x{i}")) for i in range(n))
    ]
    return doubles.groupBy(*by).agg(F.array(*cells).alias("_e")).select(*by, F.inline("_e"))


def _literal_intervals(c: int, parts: Sequence[tuple[float, float]], whole: bool) -> Column:
    """(_c, _v, _from, _lo, _hi) of the intervals of column `c` that hold the row's value: at most one, or the whole range."""
    v = F.col(f"_x{c}")
    at = [(F.lit(i), F.lit(lo).cast("double"), F.lit(hi).cast("double")) for i, (lo, hi) in enumerate(parts)]

    def row(i: Column, lo: Column, hi: Column) -> Column:
        return F.struct(F.lit(c).alias("_c"), v.alias("_v"), i.alias("_from"), lo.alias("_lo"), hi.alias("_hi"))

    if whole:
        return F.array(row(*at[0]))
    out = F.when(F.lit(False), F.array(row(*at[0])))
    for i, lo, hi in at:
        out = out.when((v >= lo) & (v <= hi), F.array(row(i, lo, hi)))
    return out.otherwise(F.slice(F.array(row(*at[0])), 1, 0))


def _interpolate(at: dict[int, float], n: int, p: float) -> float:
    position = (n - 1) * p
    low, high, w = at[floor(position)], at[ceil(position)], position - floor(position)
    return low if low == high or (low != low and high != high) else (1 - w) * low + w * high


def _doubles(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    return df.select(*by, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Exact quantiles of whole columns as driver values, all columns together; None for a column without values.

    The driver holds the open intervals, at most two per quantile and column, and sends them as literals.
    """
    if not cols:
        return {}
    doubles = _doubles(df, cols, [])
    spark = df.sparkSession
    sizes, open_, intervals = {}, [], {}
    for e in _ends(doubles, len(cols), []).collect():
        c, n = e["_c"], e["_n"]
        if n:
            sizes[c] = n
            intervals[c] = [(e["_lo"], e["_hi"])]
            ranks = {f((n - 1) * p) for p in probs for f in (floor, ceil)}
            open_ += [(c, 0, r, r + 1) for r in sorted(ranks)]
    found: dict[int, dict[int, float]] = {c: {} for c in sizes}
    first = True
    while open_:
        cells = [_literal_intervals(c, parts, first) for c, parts in intervals.items()]
        rows = doubles.select(F.inline(F.concat(*cells))).filter(F.col("_v").isNotNull())
        table = spark.createDataFrame(open_, "_c int, _from int, _rank long, _place long")
        still: dict[int, list] = {}
        for r in _narrowed(table, _bins(rows, ["_c"]), ["_c"]).collect():  # a row per open rank
            if r["_value"] is not None:
                found[r["_c"]][r["_rank"]] = r["_value"]
            else:
                still.setdefault(r["_c"], []).append(r)
        intervals = {c: sorted({(r["_lo"], r["_hi"]) for r in rs}) for c, rs in still.items()}
        open_ = [(c, intervals[c].index((r["_lo"], r["_hi"])), r["_rank"], r["_place"]) for c, rs in still.items() for r in rs]
        first = False
    return {name: [_interpolate(found[i], sizes[i], p) for p in probs] if i in sizes else [None] * len(probs) for i, name in enumerate(cols)}


def quantile_frame(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), label: str = "variable"
) -> DataFrame:
    """Exact quantiles per group and column: (by…, label, quantiles array in the order of `probs`).

    Missing values take no part; a group without values in a column has null there. Not-a-number is the largest value.
    All groups are refined together; their intervals are a table, sent to the rows by a join.
    """
    by = list(by)
    if not by:
        found = fit_quantiles(df, cols, probs)
        rows = [(c, None if found[c][0] is None else found[c]) for c in cols]
        return df.sparkSession.createDataFrame(rows, f"`{label}` string, quantiles array<double>")
    group = [*by, "_c"]
    mine = {c: f"_k{i}" for i, c in enumerate(group)}  # names of the group on the small side of joins
    same = _same(group, list(mine.values()))
    doubles = _doubles(df, cols, by)
    ends = settle(_ends(doubles, len(cols), by))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor((F.col("_n") - 1) * F.lit(float(p))), F.ceil((F.col("_n") - 1) * F.lit(float(p)))) for p in probs])))
    open_ = ends.filter("_n > 0").select(*group, F.lit(0).alias("_from"), F.explode(ranks).alias("_rank")).withColumn("_place", F.col("_rank") + 1)
    whole = F.array(F.struct(F.lit(0).alias("_from"), F.col("_lo"), F.col("_hi")))
    intervals = ends.filter("_n > 0").select(*group, whole.alias("_intervals"))
    values = melt(doubles, by, [(i, F.col(f"_x{i}")) for i in range(len(cols))], "_c", "_v").filter(F.col("_v").isNotNull())
    v, done, first = F.col("_v"), [], True
    while True:
        met = values.join(broadcast_if_light(settle(intervals.withColumnsRenamed(mine))), same)
        held = F.col("_intervals") if first else F.filter("_intervals", lambda i: (v >= i["_lo"]) & (v <= i["_hi"]))
        found = settle(_narrowed(open_, _bins(met.select(*group, "_v", F.inline(held)), group), group))
        done.append(found.filter("_value IS NOT NULL").select(*group, "_rank", "_value"))
        still = found.filter("_value IS NULL")
        if still.isEmpty():
            break
        # the intervals of a group are disjoint; they are numbered by their ends
        cuts = still.groupBy(*group).agg(F.array_sort(F.collect_set(F.struct("_lo", "_hi"))).alias("_cuts"))
        numbered = F.transform("_cuts", lambda c, i: F.struct(i.alias("_from"), c["_lo"].alias("_lo"), c["_hi"].alias("_hi")))
        intervals = cuts.select(*group, numbered.alias("_intervals"))
        own = intervals.withColumnsRenamed(mine).select(*mine.values(), F.inline("_intervals")).withColumnsRenamed({"_lo": "_l", "_hi": "_h"})
        open_ = still.join(own, same & (F.col("_lo") == F.col("_l"))).select(*group, "_from", "_rank", "_place")
        first = False
    at = reduce(DataFrame.unionByName, done).groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def quantile(p: float) -> Column:
        position = (F.col("_n") - 1) * F.lit(float(p))
        low, high, w = F.try_element_at("_at", F.floor(position)), F.try_element_at("_at", F.ceil(position)), position - F.floor(position)
        return F.when(low == high, low).otherwise((1 - w) * low + w * high)

    names = F.array(*[F.lit(c) for c in cols])
    out = ends.join(at.withColumnsRenamed(mine), same, "left")
    return out.select(*by, names[F.col("_c")].alias(label), F.when(F.col("_at").isNotNull(), F.array(*[quantile(p) for p in probs])).alias("quantiles"))
