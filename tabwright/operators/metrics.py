"""Performance metrics as distributed aggregates; all take optional `keys` and return one row per key."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.predictions import argmax
from tabwright.functions.ranks import cumulate, rank_products, with_centred_rank


def spear(df: DataFrame, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """Spearman correlation: Pearson correlation of mean ranks over rows where both values are present.

    The rows are ranked by one side in one range shuffle; its ranks are summed per distinct value of the other.
    """
    keys = list(keys)
    data = df.select(*keys, F.col(y).cast("double").alias("_a"), F.col(yhat).cast("double").alias("_b"))
    data = data.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return rank_products(with_centred_rank(data, "_a", keys), "_b", "_r", keys)


def rmse(df: DataFrame, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), 2))).alias("rmse"))


def auc(df: DataFrame, y: str = "target", p: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties count one half. Null when a class is absent."""
    scored = df.filter(F.col(y).isNotNull())
    table = cumulate(scored, p, {"pos": F.sum(F.col(y).cast("long")), "neg": F.sum(1 - F.col(y).cast("long"))}, keys)
    return auc_from_counts(table, keys)


def auc_from_counts(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """AUC from a `cumulate` table with weights pos and neg."""
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return table.groupBy(*keys).agg(F.try_divide(wins, pairs).alias("auc"))


def class_scores(
    df: DataFrame, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = (), binary_once: bool = False
) -> DataFrame:
    """One row per row and class: keys, class, is_class (0/1), p.

    With `binary_once` two probabilities give class 1 only, since class 0 mirrors it.
    """
    cells = F.transform(yhat, lambda p, i: F.struct(i.alias("class"), p.alias("p")))
    if binary_once:
        cells = F.filter(cells, lambda c: (F.size(yhat) != 2) | (c["class"] == 1))
    return df.select(*keys, F.col(y).alias("_y"), F.inline(cells)).select(
        *keys, "class", (F.col("_y") == F.col("class")).cast("int").alias("is_class"), "p"
    )


def auc_per_class(
    df: DataFrame, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = (), binary_once: bool = False
) -> DataFrame:
    """One-versus-rest AUC and number of rows of each class."""
    keys = list(keys)
    scores = class_scores(df, y, yhat, keys, binary_once).filter(F.col("is_class").isNotNull())
    is_class = F.col("is_class").cast("long")
    table = cumulate(scores, "p", {"pos": F.sum(is_class), "neg": F.sum(1 - is_class)}, [*keys, "class"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return table.groupBy(*keys, "class").agg(
        F.try_divide(wins, F.max(F.col("pos_total").cast("double") * F.col("neg_total"))).alias("auc"),
        F.max("pos_total").alias("n"),
    )


def auc_multiclass(df: DataFrame, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the one-versus-rest AUCs, plain (auc) and weighted by class frequency (auc_weighted)."""
    per_class = auc_per_class(df, y, yhat, keys)
    return per_class.groupBy(*keys).agg(
        F.avg("auc").alias("auc"), (F.sum(F.col("auc") * F.col("n")) / F.sum("n")).alias("auc_weighted")
    )


def acc(df: DataFrame, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose most probable class is the true one."""
    hit = (argmax(yhat) == F.col(y)).cast("double")
    return df.groupBy(*keys).agg(F.avg(hit).alias("acc"))


def _auc_any(df: DataFrame, y: str, yhat: str, keys: Sequence[str]) -> DataFrame:
    """AUC of a probability array: of P(y = 1) for two classes, the one-versus-rest mean otherwise."""
    return auc_per_class(df, y, yhat, keys, binary_once=True).groupBy(*keys).agg(F.avg("auc").alias("auc"))


@dataclass(frozen=True)
class Metric:
    """A scorer, the direction in which it is better, and whether it reads its input more than once."""

    name: str
    compute: Callable[[DataFrame, str, str, Sequence[str]], DataFrame]
    greater_is_better: bool = True
    several_passes: bool = False


METRICS = {
    "auc": Metric("auc", _auc_any),
    "acc": Metric("acc", acc),
    "spear": Metric("spear", spear, several_passes=True),
    "rmse": Metric("rmse", rmse, greater_is_better=False),
}

# The scorers of each target type, the first one decides.
SCORERS = {"CLASS": ("auc", "acc"), "MULTICLASS": ("auc", "acc"), "REGR": ("spear", "rmse")}


def score(df: DataFrame, metric: str, y: str = "target", yhat: str = "yhat", keys: Sequence[str] = ()) -> DataFrame:
    """(keys…, value) of a registered metric."""
    m = METRICS[metric]
    return m.compute(df, y, yhat, keys).withColumnRenamed(m.name, "value")


def score_value(df: DataFrame, metric: str, y: str = "target", yhat: str = "yhat") -> float | None:
    rows = score(df, metric, y, yhat).collect()
    return rows[0]["value"] if rows else None
