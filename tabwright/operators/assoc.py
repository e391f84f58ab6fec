"""Association between features: chi-square based for categories, rank correlation for metric columns."""

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.ranks import parts_for, with_centred_rank
from tabwright.functions.scalars import columns_with_missing
from tabwright.operators.metrics import spear
from tabwright.operators.profile import level_counts, missing_share
from tabwright.session import settle


def _pairs(df: DataFrame, columns: Sequence[str], kind: str, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per row and column pair (var1, var2, a, b), all pairs by default, those with a missing value left out."""
    cells = [
        F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"), F.col(x).cast(kind).alias("a"), F.col(y).cast(kind).alias("b"))
        for x, y in (combinations(columns, 2) if pairs is None else pairs)
    ]
    return df.select(F.inline(F.array(*cells))).filter(F.col("a").isNotNull() & F.col("b").isNotNull())


def chi_square(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson chi-square of every column pair in one job: (var1, var2, n, rows, cols, chi2).

    Two-by-two tables get the continuity correction, at most |observed - expected|. Empty cells need no rows:
    the sum of (o - e)² / e over all cells equals n * (sum of o² / (row total * column total) over filled cells - 1).
    """
    cells = _pairs(df, columns, "string").groupBy("var1", "var2", "a", "b").agg(F.count(F.lit(1)).alias("o"))
    r = F.sum("o").over(W.partitionBy("var1", "var2", "a"))
    c = F.sum("o").over(W.partitionBy("var1", "var2", "b"))
    o, r_, c_ = F.col("o"), F.col("r"), F.col("c")
    stats = (
        cells.withColumn("r", r)
        .withColumn("c", c)
        .groupBy("var1", "var2")
        .agg(
            F.sum("o").alias("n"),
            F.round(F.sum(o / r_)).cast("long").alias("rows"),
            F.round(F.sum(o / c_)).cast("long").alias("cols"),
            F.sum(o * (o / r_) / c_).alias("_s"),
            (F.sum(o / r_ / r_) * F.sum(o / c_ / c_)).alias("_inverse"),  # (Σ 1/row total) * (Σ 1/column total)
        )
    )
    plain = F.greatest(F.col("n") * (F.col("_s") - 1), F.lit(0.0))
    gap = F.sqrt(plain / (F.col("n") * F.col("_inverse")))  # |o - e|, equal in all cells of a 2 × 2 table
    corrected = F.pow(F.greatest(gap - 0.5, F.lit(0.0)), 2) * F.col("n") * F.col("_inverse")
    chi2 = F.when((F.col("rows") == 2) & (F.col("cols") == 2), corrected).otherwise(plain)
    return stats.select("var1", "var2", "n", "rows", "cols", chi2.alias("chi2"))


def contingency(table: DataFrame) -> DataFrame:
    """Add the corrected contingency coefficient; null when a variable has a single level."""
    m = F.least("rows", "cols")
    ratio = F.when(m > 1, m / F.nullif(m - 1, F.lit(0)))
    value = F.sqrt(F.col("chi2") / (F.col("n") + F.col("chi2"))) * F.sqrt(ratio)
    return table.withColumn("contingency", value)


def cramers_v(table: DataFrame) -> DataFrame:
    """Add Cramér's V; null when a variable has a single level."""
    m = F.least("rows", "cols") - 1
    return table.withColumn("cramersv", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.when(m > 0, m))))


def _symmetric(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Both orders of each pair, with display labels."""
    both = pairs.select("var1", "var2", "value").unionByName(
        pairs.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "value")
    )
    return both.join(
        F.broadcast(labels.select(F.col("variable").alias("var1"), F.col("label").alias("label1"))), "var1"
    ).join(F.broadcast(labels.select(F.col("variable").alias("var2"), F.col("label").alias("label2"))), "var2")


def categorical_matrix(df: DataFrame, columns: Sequence[str], kind: str = "contingency") -> DataFrame:
    """Association of all pairs of categorical columns, long and symmetric without the diagonal."""
    stats = chi_square(df, columns)
    stats = contingency(stats) if kind == "contingency" else cramers_v(stats)
    labels = level_counts(df, columns).select(
        "variable", F.concat("variable", F.lit(" ("), F.col("levels").cast("string"), F.lit(")")).alias("label")
    )
    return _symmetric(settle(stats.withColumnRenamed(kind, "value")), labels)


def metric_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """|Spearman| of all pairs of metric columns, pairwise complete, long and symmetric without the diagonal.

    Columns without missing values are ranked once for all their pairs; a pair with a column that has some is ranked
    on its own rows.
    """
    partial = set(columns_with_missing(df, columns))
    complete = [c for c in columns if c not in partial]
    parts = []
    if len(complete) > 1:
        parts.append(_complete_spearman(df, complete))
    cells = _pairs(df, columns, "double", [p for p in combinations(columns, 2) if partial & set(p)]) if partial else None
    if cells is not None:
        parts.append(spear(cells, "a", "b", ["var1", "var2"]).select("var1", "var2", F.abs("spear").alias("value")))
    pairs = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    labels = missing_share(df, columns).select(
        "variable",
        F.concat("variable", F.lit(" (NA: "), F.format_string("%.1f", F.col("share") * 100), F.lit("%)")).alias("label"),
    )
    return _symmetric(settle(pairs), labels)


def _complete_spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs of columns without missing values, from the Gram matrix of the rows of ranks.

    Every value travels three times whatever the number of columns: into the range that ranks it, into its window and
    back to its row, in tasks whose number grows with the values. Each task adds up X'X of its rows; the matrices are
    summed cell by cell.
    """
    names, p = list(columns), len(columns)
    rows = settle(df.select(F.monotonically_increasing_id().alias("_row"), *[F.col(c).cast("double").alias(c) for c in names]))
    cells = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(c).alias("_value")) for i, c in enumerate(names)])
    ranked = with_centred_rank(rows.select("_row", F.inline(cells)), "_value", ["_column"])
    ranked = ranked.repartition(parts_for(df.sparkSession, rows.count() * p), "_row")
    whole = ranked.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_column", "_r"))).alias("_x"))  # p values of one row

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p, p))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            total += x.T @ x
        i, j = np.triu_indices(p)
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    sums = whole.select(F.transform("_x", lambda c: c["_r"]).alias("x")).mapInArrow(gram, "i int, j int, v double")
    sums = settle(sums.groupBy("i", "j").agg(F.sum("v").alias("v")))  # p (p + 1) / 2 rows
    width = sums.filter("i = j")
    both = sums.filter("i < j").join(F.broadcast(width.select("i", F.col("v").alias("_ii"))), "i")
    both = both.join(F.broadcast(width.select("j", F.col("v").alias("_jj"))), "j")
    label = F.array(*[F.lit(c) for c in names])
    value = F.abs(F.try_divide(F.col("v"), F.sqrt("_ii") * F.sqrt("_jj")))
    return both.select(label[F.col("i")].alias("var1"), label[F.col("j")].alias("var2"), value.alias("value"))


def association_matrix(df: DataFrame, columns: Sequence[str], kind: str = "contingency") -> DataFrame:
    """`categorical_matrix` or `metric_matrix`; columns of mixed scale are an error."""
    types = dict(df.dtypes)
    text = [types[c] == "string" for c in columns]
    if any(text) and not all(text):
        raise ValueError("metric and categorical columns cannot be mixed")
    return categorical_matrix(df, columns, kind) if all(text) else metric_matrix(df, columns)


def above_cutoff(matrix: DataFrame, cutoff: float) -> DataFrame:
    """Rows and columns of variables whose largest association with another variable exceeds the cutoff."""
    keep = matrix.groupBy("var1").agg(F.max("value").alias("_max")).filter(F.col("_max") > cutoff).select("var1")
    return matrix.join(F.broadcast(keep), "var1", "left_semi").join(
        F.broadcast(keep.withColumnRenamed("var1", "var2")), "var2", "left_semi"
    )
