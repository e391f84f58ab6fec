"""Row union, melt and pivot."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str | tuple[str, Column]],
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """Wide to long in one narrow step; only `ids` and the melted columns are read.

    A column is a name, or (label, expression) where a cast or a derived value is wanted.
    All values must share one type.
    """
    pairs = [(c, F.col(c)) if isinstance(c, str) else c for c in columns]
    cells = F.array(*[F.struct(F.lit(n).alias(variable), e.alias(value)) for n, e in pairs])
    return df.select(*ids, F.explode(cells).alias("_cell")).select(
        *ids,
        f"_cell.{variable}",
        f"_cell.{value}",
    )


def union_rows(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; columns a frame lacks become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def pivot_scores(
    df: DataFrame,
    params: Sequence[str],
    fold_types: Sequence[str] = ("test", "train"),
    scorers: Sequence[str] = ("auc",),
    value: str = "scorer_value",
) -> DataFrame:
    """Long search results to one row per parameter set: mean_<fold_type>_<scorer>, std_<fold_type>_<scorer>."""
    cells = [
        (f"{t}_{s}", F.when((F.col("fold_type") == t) & (F.col("scorer") == s), F.col(value)))
        for t in fold_types
        for s in scorers
    ]
    return df.groupBy(*params).agg(
        *[F.avg(c).alias(f"mean_{n}") for n, c in cells],
        *[F.stddev_samp(c).alias(f"std_{n}") for n, c in cells],
    )


def pivot_first(df: DataFrame, index: str, column: str, labels: Sequence, value: str) -> DataFrame:
    """Long to wide with a known list of labels, one value per cell."""
    return df.groupBy(index).pivot(column, list(labels)).agg(F.first(value, ignorenulls=True))


def distinct_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.select(left, right).distinct()
