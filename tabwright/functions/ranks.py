"""Global order without a single-task sort.

`Window.orderBy` without a partition key moves every row into one task. The functions here split
the order into ranges, take one small total per range, and add the running total of the earlier
ranges to a window that runs inside each range.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, log
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.hashing import hash_hex
from tabwright.functions.lookup import broadcast_if_light
from tabwright.session import settle

HEX_DIGITS = 3  # digits of a hash looked at together: 4096 ranges at least
PART_ROWS = 250_000  # rows that one task sorts in `with_centred_rank`, whatever the number of shuffle partitions


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for that many rows: PART_ROWS in each at most, and the shuffle partitions at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(rows / PART_ROWS))


def _ranges(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Range-partition `df` and freeze the range number of each row as a column."""
    ranged = df.repartitionByRange(*order) if parts is None else df.repartitionByRange(parts, *order)
    return settle(ranged.withColumn("_range", F.spark_partition_id()))


def cumulate(
    df: DataFrame, value: str, weights: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct (keys, value) with each weight, its sum over smaller values and its total.

    Columns: keys, value, `w`, `w_before`, `w_total`. Equal values are merged before anything is
    ordered, so a value that holds a large share of all rows costs one row.
    """
    keys = list(keys)
    names = list(weights)
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[w.alias(n) for n, w in weights.items()])
    )
    ranged = _ranges(distinct, [F.col(c) for c in [*keys, value]])
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_range").agg(*[F.sum(n).alias(n) for n in names])
    offsets = offsets.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_offset") for n in names],
        *[F.sum(n).over(W.partitionBy(*keys)).alias(f"{n}_total") for n in names],
    )
    inside = W.partitionBy(*keys, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return ranged.join(offsets, [*keys, "_range"]).select(
        *keys,
        value,
        *names,
        *[
            (F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col(f"_{n}_offset")).alias(f"{n}_before")
            for n in names
        ],
        *[f"{n}_total" for n in names],
    )


def ordered_index(
    df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = (), name: str = "idx"
) -> DataFrame:
    """Add the zero-based position of each row in the order given, counted inside each key."""
    keys = list(keys)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = _ranges(df, [F.col(k) for k in keys] + order)
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(
        *keys, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy(*keys, "_range").orderBy(*order)
    return (
        ranged.join(offsets, [*keys, "_range"])
        .withColumn(name, F.row_number().over(inside) - 1 + F.col("_offset"))
        .drop("_range", "_offset")
    )


def hash_ranges(df: DataFrame, key: str | Sequence[str], seed: int | str) -> DataFrame:
    """Add the seeded hash of the key, `_hash`, and its leading digits, `_range`: as many ranges as shuffle partitions at least."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = max(HEX_DIGITS, ceil(log(max(parts, 2), 16)) + 1)
    return df.withColumn("_hash", hash_hex(key, seed)).withColumn("_range", F.substring("_hash", 1, digits))


def hashed_index(
    df: DataFrame, key: str | Sequence[str], seed: int | str, by: Sequence[str] = (), name: str = "idx", size: str | None = None
) -> DataFrame:
    """Add the zero-based position of each row in a seeded random order, counted inside each `by` group.

    The hash is uniform, so its leading digits are ready-made ranges: no sampling pass and one shuffle of
    the rows, shared by the join and the window. Where only a cut of the order is needed use `hash_cuts`,
    which moves no rows at all. `size` names a column for the group size.
    """
    by = list(by)
    keys = [key] if isinstance(key, str) else list(key)
    hashed = hash_ranges(df, keys, seed)
    earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = hashed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(
        *by,
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(W.partitionBy(*by)).alias("_size"),
    )
    inside = W.partitionBy(*by, "_range").orderBy("_hash", *keys)
    out = hashed.join(offsets, [*by, "_range"]).withColumn(
        name, F.row_number().over(inside) - 1 + F.col("_offset")
    )
    if size is not None:
        out = out.withColumn(size, F.col("_size"))
    return out.drop("_hash", "_range", "_offset", "_size")


@dataclass(frozen=True)
class Cuts:
    """Hash values that cut the random order of each group: a settled table (_g, _cuts), one row per group."""

    table: DataFrame
    by: str | None

    def __getitem__(self, group: Any) -> list[str]:
        """The cuts of one group (None where there are no groups)."""
        row = self.table.filter(F.col("_g").eqNullSafe(F.lit(group))).first() if self.by else self.table.first()
        return [] if row is None else list(row["_cuts"])


def hash_cuts(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int | str,
    counts: Callable[[Column], Sequence[Column | int]],
    by: str | None = None,
) -> Cuts:
    """Hash values that cut a seeded random order exactly: rows with `hash <= cut` are the first `count` rows.

    `counts` gives the wanted row counts for the size of a group. The cuts are found by radix selection, in all groups at
    once: a pass counts rows by the next HEX_DIGITS digits of their hash, among the rows that share the digits found so
    far with a cut, and each cut moves to the digits at which its count is reached. It is done when its count ends
    with these digits. Only counts are shuffled, and a pass reads the key alone; their number grows with the logarithm of the largest
    group. The caller selects rows by comparing hashes, a narrow filter. A cut that falls between rows of equal keys cannot
    be exact and is an error. "" selects nothing, "g" everything.
    """
    keys = [key] if isinstance(key, str) else list(key)
    group = F.col(by) if by else F.lit(0)
    hashed = df.select(group.alias("_g"), hash_hex(keys, seed).alias("_hash"))

    def counted(rows: DataFrame, digits: int) -> DataFrame:
        """(_g, _prefix, _next, _n, _seen): rows per next digits, and those before them under the same prefix."""
        following = F.substring("_hash", digits + 1, HEX_DIGITS)
        n = rows.groupBy("_g", F.substring("_hash", 1, digits).alias("_prefix"), following.alias("_next")).agg(F.count(F.lit(1)).alias("_n"))
        before = W.partitionBy("_g", "_prefix").orderBy("_next").rowsBetween(W.unboundedPreceding, -1)
        return n.withColumn("_seen", F.coalesce(F.sum("_n").over(before), F.lit(0)))

    bins = settle(counted(hashed, 0))
    sizes = bins.groupBy("_g").agg(F.sum("_n").alias("_size"))
    wanted = [c if isinstance(c, Column) else F.lit(c) for c in counts(F.col("_size"))]
    places = F.array(*[F.struct(F.lit(i).alias("_i"), c.cast("long").alias("_place")) for i, c in enumerate(wanted)])
    cuts = sizes.select("_g", "_size", F.inline(places)) if wanted else sizes.withColumns({"_i": F.lit(None).cast("int"), "_place": F.lit(None).cast("long")})
    inner = (F.col("_place") > 0) & (F.col("_place") < F.col("_size"))
    done = [cuts.filter(~F.coalesce(inner, F.lit(False))).select("_g", "_i", F.when(F.col("_place") <= 0, "").otherwise("g").alias("_cut"))]
    open_ = cuts.filter(inner).select("_g", "_i", F.lit("").alias("_prefix"), "_place")
    digits = 0
    while True:
        at = bins.withColumnsRenamed({"_g": "_h", "_prefix": "_p"})
        here = F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_prefix") == F.col("_p")) & (F.col("_place") > F.col("_seen")) & (F.col("_place") <= F.col("_seen") + F.col("_n"))
        found = settle(open_.join(at, here).select("_g", "_i", F.concat("_prefix", "_next").alias("_prefix"), (F.col("_place") - F.col("_seen")).alias("_place"), "_n"))
        done.append(found.filter("_place = _n").select("_g", "_i", F.concat("_prefix", F.lit("g")).alias("_cut")))
        open_, digits = found.filter("_place < _n").drop("_n"), digits + HEX_DIGITS
        if open_.isEmpty():
            break
        if digits >= 32:
            raise ValueError(f"a cut falls between rows of equal {', '.join(keys)}: the key must be unique")
        pending = open_.select(F.col("_g").alias("_h"), F.col("_prefix").alias("_p")).distinct()
        same = F.col("_g").eqNullSafe(F.col("_h")) & (F.substring("_hash", 1, digits) == F.col("_p"))
        bins = counted(hashed.join(broadcast_if_light(settle(pending)), same, "left_semi"), digits)
    table = union_all(done).groupBy("_g").agg(F.array_sort(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "_cut")))).alias("_c"))
    return Cuts(settle(table.select("_g", F.transform("_c", lambda c: c["_cut"]).alias("_cuts"))), by)


def with_cut_code(df: DataFrame, key: str | Sequence[str], seed: int | str, cuts: Cuts, name: str) -> DataFrame:
    """Add the number of the first cut that the row's hash does not exceed; the number of cuts when it exceeds all.

    The cuts are those of the row's group, found by a join with the table of groups; without groups they are
    literals. Rows of other groups get null.
    """
    own = hash_hex(key, seed)
    if cuts.by is None:
        values = cuts[None]
        return df.withColumn(name, sum([(own > F.lit(c)).cast("int") for c in values], F.lit(0)))
    found = df.join(broadcast_if_light(cuts.table), F.col(cuts.by).eqNullSafe(F.col("_g")), "left")
    code = F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda c: c < own)))
    return found.withColumn(name, code).drop("_g", "_cuts")


def mean_rank(df: DataFrame, value: str, keys: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """Rank of each distinct (keys, value), ties at their mean rank.

    Columns: keys, value, `n`, `rank`, and `centred`, the rank minus the mean of all ranks.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rank = F.col("n_before") + (F.col("n") + 1) / 2
    return cumulate(df, value, {"n": n}, keys).select(
        *keys, value, "n", rank.alias("rank"), (rank - (F.col("n_total") + 1) / 2).alias("centred")
    )


def with_centred_rank(df: DataFrame, value: str, keys: Sequence[str] = (), name: str = "_r") -> DataFrame:
    """Add to each row the rank of its value inside the keys, ties at their mean, minus the mean of all ranks.

    Rows with a null value are left out. Rows are ordered by value and a hash of the row, so a value that holds a large share
    of them spreads over many ranges; the few values at the ends of ranges are counted apart, one row per range. No
    rank is joined to a row: it comes from the window of its range. The number of ranges grows with the rows, so that
    the memory of a task does not, and the windows take the ranges apart again in their order: hashed, several would meet.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull())
    parts = parts_for(df.sparkSession, rows.count())
    ranged = _ranges(rows.withColumn("_salt", F.xxhash64(*rows.columns)), [F.col(c) for c in [*keys, value, "_salt"]], parts).drop("_salt")
    ends = ranged.groupBy(*keys, "_range").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(F.lit(1)).alias("_n"))
    ends = settle(ends)
    at = [F.count_if(F.col(value) == F.col(e)).alias(f"_n{e}") for e in ("_lo", "_hi")]
    counted = ranged.select(*keys, "_range", value).join(F.broadcast(ends), [*keys, "_range"])
    counted = counted.groupBy(*keys, "_range").agg(F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"), F.first("_n").alias("_n"), *at)
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    counted = counted.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_total": F.sum("_n").over(W.partitionBy(*keys))})
    counted = settle(counted)
    one_value = F.col("_lo") == F.col("_hi")
    edges = F.array(
        F.struct(F.col("_lo").alias("_v"), F.col("_before").alias("_at"), F.col("_n_lo").alias("_c")),
        F.struct(F.col("_hi").alias("_v"), (F.col("_before") + F.col("_n") - F.col("_n_hi")).alias("_at"), F.when(one_value, 0).otherwise(F.col("_n_hi")).alias("_c")),
    )
    edges = counted.select(*keys, F.inline(edges)).groupBy(*keys, "_v").agg(F.min("_at").alias("_at"), F.sum("_c").alias("_c"))
    for e in ("_lo", "_hi"):
        named = edges.select(*keys, F.col("_v").alias(e), F.col("_at").alias(f"_at{e}"), F.col("_c").alias(f"_c{e}"))
        counted = counted.join(named, [*keys, e])
    counted = counted.select(*keys, "_range", "_lo", "_hi", "_before", "_total", "_at_lo", "_c_lo", "_at_hi", "_c_hi")
    inside = W.partitionBy(*keys, "_range")
    placed = ranged.repartitionByRange(parts, "_range").withColumns({"_smaller": F.rank().over(inside.orderBy(value)) - 1, "_same": F.count(F.lit(1)).over(W.partitionBy(*keys, "_range", value))})
    placed = placed.join(F.broadcast(settle(counted)), [*keys, "_range"])

    def by_end(lo: str, hi: str, other: Column) -> Column:
        return F.when(F.col(value) == F.col("_lo"), F.col(lo)).when(F.col(value) == F.col("_hi"), F.col(hi)).otherwise(other)

    smaller = by_end("_at_lo", "_at_hi", F.col("_before") + F.col("_smaller"))
    same = by_end("_c_lo", "_c_hi", F.col("_same"))
    return placed.select(*[c for c in rows.columns if c != name], (smaller + (same + 1) / 2 - (F.col("_total") + 1) / 2).alias(name))


def rank_products(df: DataFrame, value: str, rank: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rank correlation of `value` with centred ranks `rank` that the rows already hold: (keys…, spear).

    The ranks are summed per distinct value, so only distinct values are ordered and multiplied.
    """
    keys = list(keys)
    r = F.col(rank)
    return summed_rank_products(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.sum(r).alias("_s"), F.sum(r * r).alias("_q")), value, keys)


def summed_rank_products(sums: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """`rank_products` from rows of (keys, value, _n, _s, _q): number, sum and sum of squares of the ranks."""
    keys = list(keys)
    merged = sums.groupBy(*keys, value).agg(F.sum("_s").alias("_s"), F.sum("_q").alias("_q"), F.sum("_n").alias("_n"))
    ranged = _ranges(merged, [F.col(c) for c in [*keys, value]])
    offsets = ranged.groupBy(*keys, "_range").agg(F.sum("_n").alias("_m"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select(*keys, "_range", F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_offset"), F.sum("_m").over(W.partitionBy(*keys)).alias("_total"))
    inside = W.partitionBy(*keys, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    placed = ranged.withColumn("_seen", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(offsets), [*keys, "_range"])
    other = F.col("_offset") + F.col("_seen") + (F.col("_n") + 1) / 2 - (F.col("_total") + 1) / 2
    product = F.try_divide(F.sum(F.col("_s") * other), F.sqrt(F.sum("_q")) * F.sqrt(F.sum(F.col("_n") * other * other)))
    return placed.groupBy(*keys).agg(product.alias("spear"))
