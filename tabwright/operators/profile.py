"""Descriptive aggregates: one fused pass per call, however many columns."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.lookup import attach
from tabwright.functions.quantiles import quantile_frame
from tabwright.operators.reshape import melt

DROP_SHARE = 0.95  # fixed value: columns with a larger share of missing values are dropped


def describe_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles (linear interpolation), max per column and group."""
    by = list(by)
    values = [(c, F.col(c).cast("double")) for c in columns]
    doubles = df.select(*by, *[e.alias(c) for c, e in values])
    wide = doubles.groupBy(*by).agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    stats = melt(wide, by, list(columns), value="s").select(*by, "variable", "s.*")
    quartiles = quantile_frame(doubles, columns, [0.25, 0.5, 0.75], by).select(
        *by, "variable", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])]
    )
    return stats.join(quartiles, [*by, "variable"], "left").select(
        *by, "variable", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (variable, value) for categorical columns, nulls included."""
    return melt(df, [], list(columns)).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top and freq per column; the smaller level wins a tie."""
    levels = level_table(df, columns).filter(F.col("value").isNotNull())
    return levels.groupBy("variable").agg(
        F.sum("n").alias("count"),
        F.count("value").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def most_frequent(levels: DataFrame, n: int) -> DataFrame:
    """The n most frequent levels per variable of a level table, with their rank; the smaller level wins a tie."""
    by_count = W.partitionBy("variable").orderBy(F.desc("n"), F.asc("value"))
    present = levels.filter(F.col("value").isNotNull())
    return present.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= n)


def top_values(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The n most frequent levels per column, long form with their rank."""
    return most_frequent(level_table(df, columns), n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per level."""
    total = df.agg(F.count(column)).scalar()
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share", F.col("n") / total)
    )


def group_transform(df: DataFrame, key: str, value: str, stat: str, name: str) -> DataFrame:
    """Add a per-group statistic to every row.

    `mean`: the mean of `value` over the group; `per_head`: `value` divided by the group's count of
    non-missing values. The groups are aggregated first, so a hot key is never gathered in one task.
    """
    groups = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(value).alias("_mean"), F.count(value).alias("_count")
    )
    out = attach(df, groups, [key])
    result = F.col("_mean") if stat == "mean" else F.try_divide(F.col(value), F.col("_count"))
    return out.withColumn(name, result).select(*df.columns, name)


def missing_share(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Share of nulls per column and whether it is above the limit for dropping."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    long = melt(wide, [], list(columns), value="share")
    return long.select(
        "variable",
        F.round("share", digits).alias("share"),
        (F.round("share", digits) > DROP_SHARE).alias("drop"),
    )


def columns_to_drop(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [r["variable"] for r in missing_share(df, columns).filter("drop").collect()]


def level_counts(
    df: DataFrame, columns: Sequence[str], n_top: int = 10, count_null: bool = False, approximate: bool = False
) -> DataFrame:
    """Number of levels per column and whether it is too many; null counts as a level on request.

    `approximate` uses a fixed-size sketch per column instead of shuffling the distinct levels.
    """
    if approximate:
        wide = df.agg(
            *[
                (F.approx_count_distinct(c) + (F.count_if(F.col(c).isNull()) > 0).cast("int") * int(count_null)).alias(c)
                for c in columns
            ]
        )
        counts = melt(wide, [], list(columns), value="levels")
    else:
        present = F.count("value") + (F.count_if(F.col("value").isNull()) if count_null else F.lit(0))
        counts = level_table(df, columns).groupBy("variable").agg(present.alias("levels"))
    return counts.withColumn("toomany", F.col("levels") > n_top)


def too_many_levels(df: DataFrame, columns: Sequence[str], n_top: int = 10, count_null: bool = False) -> list[str]:
    """Columns with more than n_top levels, in the order given."""
    if not columns:
        return []
    counts = level_counts(df, columns, n_top, count_null)
    found = {r["variable"] for r in counts.filter("toomany").collect()}
    return [c for c in columns if c in found]


def single_level_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with exactly one non-null level."""
    if not columns:
        return []
    row = df.agg(*[F.min(c).alias(f"a_{c}") for c in columns], *[F.max(c).alias(f"z_{c}") for c in columns]).first()
    return [c for c in columns if row[f"a_{c}"] is not None and row[f"a_{c}"] == row[f"z_{c}"]]


def crosstab(df: DataFrame, feature: str, target: str, labels: Sequence) -> DataFrame:
    """Per level: counts and row shares of each target label, bar weight and percent of all rows."""
    pairs = df.filter(F.col(feature).isNotNull() & F.col(target).isNotNull())
    counts = pairs.groupBy(F.col(feature).alias("level")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(target) == x).alias(f"n_{x}") for x in labels]
    )
    return _with_weight(counts, df).select(
        "level", "n", *[f"n_{x}" for x in labels], *[(F.col(f"n_{x}") / F.col("n")).alias(f"share_{x}") for x in labels], "pct", "w"
    )


def target_profile(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Per level: mean target, count, percent of all rows, bar weight, and the overall mean."""
    counts = (
        df.filter(F.col(feature).isNotNull())
        .groupBy(F.col(feature).alias("level"))
        .agg(F.avg(target).alias("h"), F.count(F.lit(1)).alias("n"))
    )
    return _with_weight(counts, df).withColumn("prior", df.agg(F.avg(target)).scalar())


def _with_weight(counts: DataFrame, df: DataFrame) -> DataFrame:
    total = df.agg(F.count(F.lit(1))).scalar()
    largest = counts.agg(F.max("n")).scalar()
    return counts.withColumns({"pct": 100 * F.col("n") / total, "w": 0.9 * F.col("n") / largest})


def spread(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """mean, std and standard error of a value over repeated runs."""
    return df.groupBy(*by).agg(
        F.avg(value).alias(f"{value}_mean"),
        F.stddev_samp(value).alias(f"{value}_std"),
        (F.stddev_samp(value) / F.sqrt(F.count(value))).alias(f"{value}_sem"),
    )


def class_priors(df: DataFrame, target: str = "target") -> DataFrame:
    """Share of rows per class, keyed by class."""
    total = df.agg(F.count(target)).scalar()
    counts = df.filter(F.col(target).isNotNull()).groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("prior", F.col("n") / total)


def quantile_grid(df: DataFrame, columns: Sequence[str], n: int = 10, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Quantiles 0, 1/n … 1 per column, one row each."""
    probs = [i / n for i in range(n + 1)]
    if approximate:
        grid = F.array(*[F.lit(p) for p in probs])
        wide = df.groupBy(*by).agg(*[F.percentile_approx(F.col(c).cast("double"), grid).alias(c) for c in columns])
        frame = melt(wide, list(by), list(columns), value="quantiles")
    else:
        frame = quantile_frame(df, columns, probs, by)
    return frame.select(*by, "variable", F.posexplode("quantiles").alias("step", "quantile")).withColumn(
        "prob", F.col("step") / n
    )


def selection_counts(df: DataFrame, variable: str = "variable", rep: str = "rep", fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """How often each variable was kept, and how many variables each repetition and fold kept."""
    per_variable = df.groupBy(variable).agg(F.count(F.lit(1)).alias("n"))
    per_fold = df.groupBy(rep, fold).agg(F.count(variable).alias("n"))
    return per_variable, per_fold


def running_share(df: DataFrame, value: str, order: Sequence[str | Column], name: str) -> DataFrame:
    """Running percent of the total over a table that is small by nature (one row per feature)."""
    ordered = W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, 100 * F.sum(value).over(ordered) / F.sum(value).over(W.partitionBy()))


def bottom_and_top(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The n rows with the largest and the n rows with the smallest value, each row once; rows without a value come last in both."""
    worst = df.orderBy(F.desc_nulls_last(value), F.asc(key)).limit(n)
    best = df.orderBy(F.asc_nulls_last(value), F.asc(key)).limit(n)
    return worst.unionByName(best).dropDuplicates([key])
