"""Expressions on predictions: a probability array per row, or one number for regression."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.lookup import attach
from tabwright.functions.ranks import ordered_index


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def inv_logit(p: str | Column) -> Column:
    return 1 / (1 + F.exp(-_col(p)))


def scale_predictions(
    yhat: str | Column, b_sample: Sequence[float] | None = None, b_all: Sequence[float] | None = None
) -> Column:
    """Undo undersampling: per class yhat * b_all / b_sample, renormalised to one.

    Priors are listed in class order. Without `b_sample` the predictions are returned as they are.
    """
    y = _col(yhat)
    if b_sample is None:
        return y
    factor = F.array(*[F.lit(float(a) / float(s)) for a, s in zip(b_all, b_sample)])
    raw = F.zip_with(y, factor, lambda p, f: p * f)
    total = F.aggregate(raw, F.lit(0.0), lambda acc, p: acc + p)
    return F.transform(raw, lambda p: p / total)


def scale_binary(p: str | Column, b_sample: Sequence[float] | None = None, b_all: Sequence[float] | None = None) -> Column:
    """`scale_predictions` for a single column that holds P(y = 1)."""
    y = _col(p)
    if b_sample is None:
        return y
    f0, f1 = (float(a) / float(s) for a, s in zip(b_all, b_sample))
    return y * f1 / ((1 - y) * f0 + y * f1)


def argmax(yhat: str | Column) -> Column:
    """Zero-based class with the largest probability, the first one on ties."""
    y = _col(yhat)
    return (F.array_position(y, F.array_max(y)) - 1).cast("int")


def top_classes(yhat: str | Column, k: int = 3) -> Column:
    """Zero-based classes by falling probability, at most `k`; ties by class."""
    order = F.array_sort(
        F.transform(_col(yhat), lambda p, i: F.struct((-p).alias("p"), i.cast("int").alias("i")))
    )
    return F.transform(F.slice(order, 1, k), lambda s: s["i"])


def one_hot(y: str | Column, k: int) -> Column:
    """Array of k indicators for a class number."""
    return F.array(*[(_col(y) == i).cast("int") for i in range(k)])


def residual(y: str | Column, yhat: str | Column, target_type: str) -> Column:
    """1 - probability of the true class, or y - yhat for regression."""
    if target_type == "REGR":
        return _col(y) - _col(yhat)
    return 1 - F.element_at(_col(yhat), (_col(y) + 1).cast("int"))


def with_residuals(df: DataFrame, y: str = "target", yhat: str = "yhat", target_type: str = "CLASS") -> DataFrame:
    """Add residual and abs_residual, for regression also rel_residual = |y - yhat| / |y|."""
    out = df.withColumn("residual", residual(y, yhat, target_type)).withColumn("abs_residual", F.abs("residual"))
    if target_type == "REGR":
        out = out.withColumn("rel_residual", F.try_divide(F.col("abs_residual"), F.abs(_col(y))))
    return out


def label_codes(df: DataFrame, column: str) -> list:
    """Sorted labels of a class target; their positions are the codes. A model has an output for each of them.

    `with_label_codes` numbers any number of labels without a list.
    """
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def with_label_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Add the position of each label among the sorted ones; null for a null label. Labels are numbered in a table."""
    table = ordered_index(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], name=name)
    return attach(df, table.select(column, F.col(name).cast("int").alias(name)), [column])


def label_encode(column: str | Column, labels: Sequence) -> Column:
    """Sorted labels to 0..k-1; labels that were not fitted become null."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in labels]), _col(column)) - 1, F.lit(-1)).cast("int")
