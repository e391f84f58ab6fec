"""Samples of exact size, folds and random imputation, all driven by a hash of the row key."""

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.hashing import hash_hex, hash_long, hash_unit
from tabwright.functions.ranks import hash_cuts, hashed_index, with_cut_code
from tabwright.operators.prepare import _Stage
from tabwright.operators.profile import bottom_and_top
from tabwright.operators.reshape import melt
from tabwright.session import settle


def assign_fold(
    df: DataFrame,
    key: str,
    seed: int,
    fracs: Sequence[float] = (0.1, 0.7, 0.2),
    labels: Sequence[str] = ("util", "train", "test"),
) -> DataFrame:
    """Add `fold` with the exact shares given, on a random permutation of the rows."""
    edges = [round(sum(fracs[: i + 1]), 12) for i in range(len(fracs) - 1)]
    cuts = hash_cuts(df, key, seed, lambda n: [F.floor(F.lit(e) * (n - 1)) + 1 for e in edges])
    coded = with_cut_code(df, key, seed, cuts, "_code")
    return coded.withColumn("fold", F.array(*[F.lit(x) for x in labels])[F.col("_code")]).drop("_code")


def time_fold(df: DataFrame, is_test: Column, key: str, seed: int, util_frac: float = 0.1) -> DataFrame:
    """Add `fold`: test by a time condition, the rest train, of which a random share becomes util."""
    flagged = df.withColumn("fold", F.when(is_test, "test").otherwise("train"))
    cuts = hash_cuts(flagged.filter("fold = 'train'"), key, seed, lambda n: [F.bround(F.lit(util_frac) * n)])
    util = (F.col("fold") == "train") & (F.col("_code") == 0)
    coded = with_cut_code(flagged, key, seed, cuts, "_code")
    return coded.withColumn("fold", F.when(util, "util").otherwise(F.col("fold"))).drop("_code")


def bernoulli_flag(df: DataFrame, key: str, seed: int, p: float = 0.2, name: str = "encode_flag") -> DataFrame:
    """Add a 0/1 flag that is 1 with probability p, independently per row."""
    return df.withColumn(name, (hash_unit(hash_hex(key, seed)) < p).cast("int"))


def fold_flags(df: DataFrame) -> DataFrame:
    """Add fold_num (1 on test) and encode_flag (1 on util)."""
    return df.withColumns(
        {"fold_num": (F.col("fold") == "test").cast("int"), "encode_flag": (F.col("fold") == "util").cast("int")}
    )


def remove_burned(df: DataFrame) -> DataFrame:
    return df.filter(F.col("fold") != "util")


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly min(n, rows) random rows."""
    cuts = hash_cuts(df, key, seed, lambda _: [n])
    return with_cut_code(df, key, seed, cuts, "_code").filter("_code = 0").drop("_code")


def worst_best_random(df: DataFrame, value: str, key: str, n: int, n_random: int, seed: int) -> DataFrame:
    """The n rows with the largest, the n with the smallest value and n_random random ones, each row once."""
    extremes = bottom_and_top(df, value, key, n)
    return extremes.unionByName(sample_rows(df, key, n_random, seed).select(*df.columns)).dropDuplicates([key])


class Undersample(_Stage, Estimator):
    """At most n rows per class for training. The fitted stage leaves scoring data unchanged.

    `UndersampleModel.sample` draws the training rows; `b_all` and `b_sample` are the class priors before
    and after, listed in class order as `scale_predictions` expects them.
    """

    n_max_per_level = Param(Params._dummy(), "n_max_per_level", "rows to keep per class")
    target = Param(Params._dummy(), "target", "class column")
    key = Param(Params._dummy(), "key", "row key")
    seed = Param(Params._dummy(), "seed", "seed of the random order")

    def __init__(self, n_max_per_level: int = 500, target: str = "target", key: str = "id", seed: int = 42):
        super().__init__()
        self._store(n_max_per_level=n_max_per_level, target=target, key=key, seed=seed)

    def _fit(self, dataset: DataFrame) -> "UndersampleModel":
        n, target = self._value("n_max_per_level"), self._value("target")
        rows = dataset.filter(F.col(target).isNotNull()).groupBy(target).count().orderBy(target).collect()
        before = [r["count"] for r in rows]
        after = [min(n, c) for c in before]
        return UndersampleModel(
            n, target, self._value("key"), self._value("seed"), [r[target] for r in rows],
            [c / sum(before) for c in before], [c / sum(after) for c in after],
        )


class UndersampleModel(_Stage, Model):
    n_max_per_level = Param(Params._dummy(), "n_max_per_level", "rows to keep per class")
    target = Param(Params._dummy(), "target", "class column")
    key = Param(Params._dummy(), "key", "row key")
    seed = Param(Params._dummy(), "seed", "seed of the random order")
    labels = Param(Params._dummy(), "labels", "classes in order")
    prior_all = Param(Params._dummy(), "prior_all", "class shares before sampling")
    prior_sample = Param(Params._dummy(), "prior_sample", "class shares after sampling")

    def __init__(self, n_max_per_level: int = 500, target: str = "target", key: str = "id", seed: int = 42, labels: list | None = None, prior_all: list | None = None, prior_sample: list | None = None):
        super().__init__()
        self._store(n_max_per_level=n_max_per_level, target=target, key=key, seed=seed, labels=labels, prior_all=prior_all, prior_sample=prior_sample)

    @property
    def b_all(self) -> list[float]:
        return list(self._value("prior_all"))

    @property
    def b_sample(self) -> list[float]:
        return list(self._value("prior_sample"))

    def sample(self, df: DataFrame) -> DataFrame:
        key, seed, target, n = (self._value(p) for p in ("key", "seed", "target", "n_max_per_level"))
        cuts = hash_cuts(df.filter(F.col(target).isNotNull()), key, seed, lambda _: [n], by=target)
        return with_cut_code(df, key, seed, cuts, "_code").filter("_code = 0").drop("_code")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset


def random_impute(df: DataFrame, features: Sequence[str], key: str, seed: int = 0, df_ref: DataFrame | None = None) -> DataFrame:
    """Fill each null with the value of a random row that has one, drawn per column and row.

    Donors are numbered per column, a recipient picks a number by hash, and both meet in one equi-join.
    """
    if not features:
        return df
    donors = melt(df if df_ref is None else df_ref, [key], list(features)).filter(F.col("value").isNotNull())
    donors = settle(hashed_index(donors, key, seed, by=["variable"]).select("variable", "idx", "value"))
    sizes = donors.groupBy("variable").agg(F.count(F.lit(1)).alias("_n"))  # one row per column
    pick = hash_long(hash_hex([key, "variable"], seed)) % F.col("_n")
    recipients = melt(df, [key], list(features)).filter(F.col("value").isNull()).drop("value")
    recipients = recipients.join(F.broadcast(sizes), "variable").withColumn("idx", pick)
    filled = recipients.join(donors, ["variable", "idx"]).groupBy(key).agg(
        *[F.max(F.when(F.col("variable") == f, F.col("value"))).alias(f"_fill_{f}") for f in features]
    )
    out = df.join(filled, key, "left").withColumns({f: F.coalesce(F.col(f), F.col(f"_fill_{f}")) for f in features})
    return out.select(*df.columns)
