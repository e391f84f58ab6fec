"""Univariate importance of many features at once."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.ranks import cumulate, summed_rank_products, with_centred_rank
from tabwright.functions.scalars import columns_with_missing
from tabwright.operators.metrics import auc_from_counts
from tabwright.operators.prepare import Binning
from tabwright.operators.reshape import melt
from tabwright.schema import BINNED, MISSING
from tabwright.session import settle


def _leveled(df: DataFrame, features: Sequence[str], target: str, n_bins: int) -> DataFrame:
    """(feature, level, target) long frame; metric features as quantile bins with a level for missing."""
    types = dict(df.dtypes)
    metric = [f for f in features if types[f] != "string"]
    binned = Binning(metric, n_bins, MISSING).fit(df).transform(df) if metric else df
    cells = [(f, F.col(f + BINNED if f in metric else f)) for f in features]
    long = melt(binned, [target], cells, variable="feature", value="level")
    return long.filter(F.col("level").isNotNull() & F.col(target).isNotNull())


def _importance_class(df, features, target, n_bins) -> DataFrame:
    levels = _leveled(df, features, target, n_bins).groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("pos")
    )
    scored = levels.withColumn("score", F.col("pos") / F.col("n"))
    table = cumulate(scored, "score", {"pos": F.sum("pos"), "neg": F.sum(F.col("n") - F.col("pos"))}, ["feature"])
    return auc_from_counts(table, ["feature"]).withColumnRenamed("auc", "importance")


def _importance_multiclass(df, features, target, n_bins) -> DataFrame:
    """Mean one-versus-rest AUC over any number of classes: only levels that hold rows of a class are listed for it."""
    cells = settle(_leveled(df, features, target, n_bins).groupBy("feature", "level", F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("pos")))
    sizes = cells.groupBy("feature", "level").agg(F.sum("pos").alias("n"))
    totals = cells.groupBy("feature").agg(F.sum("pos").alias("_rows"))
    listed = cells.join(sizes, ["feature", "level"]).select("feature", "class", "pos", "n", (F.col("pos") / F.col("n")).alias("score"))
    # the levels without a row of the class share score 0
    rest = listed.groupBy("feature", "class").agg(F.sum("n").alias("_held")).join(F.broadcast(totals), "feature")
    rest = rest.select("feature", "class", F.lit(0).cast("long").alias("pos"), (F.col("_rows") - F.col("_held")).alias("n"), F.lit(0.0).alias("score"))
    per_class = listed.unionByName(rest.filter("n > 0"))
    table = cumulate(per_class, "score", {"pos": F.sum("pos"), "neg": F.sum(F.col("n") - F.col("pos"))}, ["feature", "class"])
    aucs = auc_from_counts(table, ["feature", "class"])
    return aucs.groupBy("feature").agg(F.avg("auc").alias("importance"))


def _importance_regression(df, features, target) -> DataFrame:
    """|Spearman| of the target with each feature, a category standing for its mean target.

    The rows are ranked by the target, once for all features without missing values. Ranks are summed per value of
    a feature; only distinct values are ordered, and categories get their means there.
    """
    df = df.filter(F.col(target).isNotNull()).withColumn("_y", F.col(target).cast("double")).select("_y", *features)
    types = dict(df.dtypes)
    partial = columns_with_missing(df, features)
    complete = [f for f in features if f not in partial]

    def long(frame: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
        """(keep…, feature, number, level): metric features as numbers, categorical ones as levels."""
        cells = [
            F.struct(
                F.lit(f).alias("feature"),
                (F.lit(None) if types[f] == "string" else F.col(f)).cast("double").alias("number"),
                (F.col(f) if types[f] == "string" else F.lit(None)).cast("string").alias("level"),
            )
            for f in names
        ]
        return frame.select(*keep, F.inline(F.array(*cells))).filter(F.col("number").isNotNull() | F.col("level").isNotNull())

    parts = []
    if complete:
        parts.append(long(with_centred_rank(df.select("_y", *complete), "_y"), complete, ["_y", "_r"]))
    if partial:
        parts.append(with_centred_rank(long(df, partial, ["_y"]), "_y", ["feature"]).select("_y", "_r", "feature", "number", "level"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    r = F.col("_r")
    sums = rows.groupBy("feature", "number", "level").agg(F.count(F.lit(1)).alias("_n"), F.sum(r).alias("_s"), F.sum(r * r).alias("_q"), F.avg("_y").alias("_mean"))
    sums = sums.withColumn("score", F.coalesce("number", "_mean"))
    return summed_rank_products(sums, "score", ["feature"]).select("feature", F.abs("spear").alias("importance"))


def univariate_importance(
    df: DataFrame,
    features: Sequence[str],
    target: str = "target",
    target_type: str = "CLASS",
    n_bins: int = 10,
    digits: int | None = 3,
) -> DataFrame:
    """(feature, importance), largest first: AUC of the level means for class targets, |Spearman| for regression.

    All features share one pass; `digits` rounds the result.
    """
    features = list(features)
    if target_type == "CLASS":
        out = _importance_class(df, features, target, n_bins)
    elif target_type == "MULTICLASS":
        out = _importance_multiclass(df, features, target, n_bins)
    else:
        out = _importance_regression(df, features, target)
    if digits is not None:
        out = out.withColumn("importance", F.round("importance", digits))
    return out.orderBy(F.desc("importance"), F.asc("feature"))


def fold_drift(df: DataFrame, features: Sequence[str], cutoff: float = 0.52, fold_num: str = "fold_num", digits: int | None = 3) -> DataFrame:
    """How well each feature tells test rows from training rows, and whether that exceeds the cutoff."""
    out = univariate_importance(df, features, fold_num, "CLASS", digits=digits)
    return out.withColumn("drift", F.col("importance") > cutoff)
