"""Histograms, kernel densities, box statistics, hexagon counts and trend lines as small frames.

Every function takes grouping columns, so a report over many features is one melted frame grouped by
`variable`: one job per kind of frame, however many features there are.
"""

from collections.abc import Sequence
from math import pi

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.lookup import attach
from tabwright.functions.quantiles import fit_quantiles, quantile_frame
from tabwright.operators.prepare import bin_edges, bin_label
from tabwright.operators.reshape import melt

KDE_CELLS = 4096  # data cells of a kernel density; their width is far below the bandwidth


def _keys(by: str | Sequence[str] | None) -> list[str]:
    return [] if by is None else [by] if isinstance(by, str) else list(by)


def _with_stats(data: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Add per-group statistics to the rows: as literals without groups, by lookup otherwise."""
    if keys:
        return attach(data, stats, keys, how="inner")
    row = stats.first()
    return data.withColumns({c: F.lit(row[c]) for c in stats.columns})


def histogram(df: DataFrame, column: str, by: str | Sequence[str] | None = None, bins: int = 20) -> DataFrame:
    """Density per equal-width bin over the range of each group: (by…, bin, lower, upper, n, density)."""
    keys = _keys(by)
    data = df.select(*keys, F.col(column).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    ranges = data.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    located = _with_stats(data, ranges, keys)
    width = (F.col("_hi") - F.col("_lo")) / bins
    cell = F.least(F.floor(F.try_divide(F.col("_x") - F.col("_lo"), width)), F.lit(bins - 1))
    counts = located.groupBy(*keys, F.coalesce(cell, F.lit(0)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in ("_lo", "_hi", "_n")]
    )
    return counts.select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"),
        "n",
        F.try_divide(F.col("n"), F.col("_n") * width).alias("density"),
    )


def kernel_density(df: DataFrame, column: str, points: int = 100, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a grid, bandwidth std * n^(-1/5): (point, x, density).

    Rows are first counted in KDE_CELLS cells with their mean, so the kernels run over a bounded table.
    """
    data = df.select(F.col(column).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    s = data.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.stddev_samp("_x").alias("sd"), F.count(F.lit(1)).alias("n")).first()
    if not s["n"] or not s["sd"]:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    width = (s["hi"] - s["lo"]) / KDE_CELLS
    bandwidth = s["sd"] * s["n"] ** (-0.2)
    start = s["lo"] - cut * bandwidth
    step = (s["hi"] - s["lo"] + 2 * cut * bandwidth) / (points - 1)
    cells = data.groupBy(F.least(F.floor((F.col("_x") - s["lo"]) / width), F.lit(KDE_CELLS - 1)).alias("cell")).agg(
        F.avg("_x").alias("centre"), F.count(F.lit(1)).alias("w")
    )
    grid = cells.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    grid = grid.withColumn("x", F.lit(start) + F.col("point") * step)
    z = (F.col("x") - F.col("centre")) / bandwidth
    norm = s["n"] * bandwidth * (2 * pi) ** 0.5
    return grid.groupBy("point").agg(
        F.max("x").alias("x"), (F.sum(F.col("w") * F.exp(-z * z / 2)) / norm).alias("density")
    )


def box_stats(df: DataFrame, column: str, by: str | Sequence[str] | None = None) -> DataFrame:
    """Quartiles, mean, whiskers (last value within 1.5 interquartile ranges) and number of outliers per group."""
    keys = _keys(by)
    data = df.select(*keys, F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull())
    quartiles = quantile_frame(data, ["x"], [0.25, 0.5, 0.75], keys, label="_column").select(
        *keys, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    rows = _with_stats(data, quartiles, keys)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("x").alias("mean"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 50, by: str | Sequence[str] | None = None) -> DataFrame:
    """Counts on a hexagonal grid over the range of each group: (by…, lattice, i, j, x_centre, y_centre, n).

    Hexagon centres form two rectangular lattices shifted by half a cell; a point belongs to the nearer centre.
    """
    keys = _keys(by)
    data = df.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).filter(
        F.col("_x").isNotNull() & F.col("_y").isNotNull()
    )

    def cell(column: str, n: int):
        size = (F.max(column) - F.min(column)) / n
        return F.when(size > 0, size).otherwise(1.0)

    ranges = data.groupBy(*keys).agg(
        F.min("_x").alias("x0"), F.min("_y").alias("y0"),
        cell("_x", gridsize).alias("sx"), cell("_y", int(gridsize / 3**0.5)).alias("sy"),
        F.count(F.lit(1)).alias("_n"),
    )
    rows = _with_stats(data, ranges, keys)
    rows = rows.withColumns({"u": (F.col("_x") - F.col("x0")) / F.col("sx"), "v": (F.col("_y") - F.col("y0")) / F.col("sy")})
    i1, j1, i2, j2 = F.floor(F.col("u") + 0.5), F.floor(F.col("v") + 0.5), F.floor("u"), F.floor("v")

    def distance(i, j):
        return (F.col("u") - i) * (F.col("u") - i) + 3 * (F.col("v") - j) * (F.col("v") - j)

    first = distance(i1, j1) < distance(i2 + 0.5, j2 + 0.5)
    cells = rows.select(
        *keys, "x0", "y0", "sx", "sy",
        F.when(first, 0).otherwise(1).alias("lattice"),
        F.when(first, i1).otherwise(i2).cast("int").alias("i"),
        F.when(first, j1).otherwise(j2).cast("int").alias("j"),
    )
    counts = cells.groupBy(*keys, "lattice", "i", "j").agg(
        F.count(F.lit(1)).alias("n"), *[F.max(c).alias(c) for c in ("x0", "y0", "sx", "sy")]
    )
    shift = F.col("lattice") * 0.5
    return counts.select(
        *keys, "lattice", "i", "j",
        (F.col("x0") + (F.col("i") + shift) * F.col("sx")).alias("x_centre"),
        (F.col("y0") + (F.col("j") + shift) * F.col("sy")).alias("y_centre"),
        "n",
    )


def trend(df: DataFrame, x: str, y: str, n_bins: int = 20) -> DataFrame:
    """Trend line: mean of x and y inside quantile bins of x."""
    edges = bin_edges(fit_quantiles(df, [x], [i / n_bins for i in range(n_bins + 1)])[x])
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(bin_label(x, edges).alias("bin"))
        .agg(F.avg(x).alias("x_mean"), F.avg(y).alias("y_mean"), F.count(F.lit(1)).alias("n"))
    )


def trends(df: DataFrame, columns: Sequence[str], y: str, n_bins: int = 20) -> DataFrame:
    """`trend` of many columns, edges fitted in one pass and means taken in another: (variable, bin, x_mean, y_mean, n)."""
    found = fit_quantiles(df, columns, [i / n_bins for i in range(n_bins + 1)])
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                bin_label(c, bin_edges(found[c])).alias("bin"),
                F.col(c).cast("double").alias("x"),
            )
            for c in columns
        ]
    )
    long = df.filter(F.col(y).isNotNull()).select(F.col(y).alias("_y"), F.inline(cells)).filter(F.col("x").isNotNull())
    return long.groupBy("variable", "bin").agg(
        F.avg("x").alias("x_mean"), F.avg("_y").alias("y_mean"), F.count(F.lit(1)).alias("n")
    )


def level_profiles(df: DataFrame, columns: Sequence[str], target: str, labels: Sequence = ()) -> DataFrame:
    """Per feature and level: n, percent of all rows, bar weight, mean target; with labels also their row shares."""
    total = df.agg(F.count(F.lit(1))).first()[0]
    numeric = dict(df.dtypes)[target] != "string"
    long = melt(df, [target], list(columns), value="level").filter(F.col("level").isNotNull())
    counts = long.groupBy("variable", "level").agg(
        F.count(F.lit(1)).alias("n"),
        *([F.avg(target).alias("h")] if numeric else []),
        *[F.count_if(F.col(target) == x).alias(f"n_{x}") for x in labels],
        *[F.avg((F.col(target) == x).cast("double")).alias(f"share_{x}") for x in labels],
    )
    largest = counts.groupBy("variable").agg(F.max("n").alias("_max"))  # one row per feature
    out = counts.join(F.broadcast(largest), "variable")
    return out.withColumns({"pct": 100 * F.col("n") / total, "w": 0.9 * F.col("n") / F.col("_max")}).drop("_max")


def distribution_profile(
    df: DataFrame, features: Sequence[str], target: str = "target", target_type: str = "CLASS", labels: Sequence = ()
) -> dict[str, DataFrame]:
    """The frames behind the distribution pages of all features, by kind; `variable` names the feature.

    Class targets: histogram and box per class for metric features, shares per level for categorical ones.
    Regression: hexagon counts, trend, histogram and box for metric features, mean and box of the target per level.
    """
    types = dict(df.dtypes)
    cate = [f for f in features if types[f] == "string"]
    metr = [f for f in features if types[f] != "string"]
    out: dict[str, DataFrame] = {}
    if metr:
        long = melt(df, [target], [(f, F.col(f).cast("double")) for f in metr])
        if target_type == "REGR":
            out["hexbin"] = hexbin(long, "value", target, by="variable")
            out["trend"] = trends(df, metr, target)
            out["histogram"] = histogram(long, "value", by="variable")
            out["box"] = box_stats(long, "value", by="variable")
        else:
            out["histogram"] = histogram(long, "value", by=["variable", target])
            out["box"] = box_stats(long, "value", by=["variable", target])
    if cate:
        out["levels"] = level_profiles(df, cate, target, [] if target_type == "REGR" else labels)
        if target_type == "REGR":
            out["level_box"] = box_stats(melt(df, [target], cate, value="level"), target, by=["variable", "level"])
    return out
