"""Model search, validation and comparison.

The driver submits one fit per parameter set and split from a thread pool; rows stay on the executors and
only metric values come back.
"""

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.density import box_stats
from tabwright.operators.encode import DesignMatrixModel
from tabwright.operators.metrics import METRICS, SCORERS, score
from tabwright.operators.models import Fitted, ModelSpec, fit_model
from tabwright.operators.reshape import melt, pivot_scores
from tabwright.operators.split import LEARNING_SHARES, learning_subsets, separate_split, shuffle_split, with_chunks
from tabwright.operators.trees import staged_scores
from tabwright.session import settle

Split = tuple[DataFrame, DataFrame]


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """All combinations of the parameter values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _parallel(spark: SparkSession, tasks: Sequence[Callable[[], Any]], parallelism: int) -> list:
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
        return [f.result() for f in futures]


class Problem:
    """A design frame with key, target and fold, settled once and shared by all fits of a search."""

    def __init__(self, df: DataFrame, design: DesignMatrixModel, key: str = "id", target: str = "target", target_type: str = "CLASS", n_classes: int = 2, fold: str = "fold"):
        self.design, self.key, self.target = design, key, target
        self.target_type, self.n_classes, self.fold = target_type, n_classes, fold
        keep = [key, target] + ([fold] if fold in df.columns else [])
        self.df = settle(design.transform(df).select(*keep, design.getOrDefault("output")))

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def splits(self, k: int = 1, seed: int = 42) -> list[Split]:
        """Separate-fold splits: train rows only from the train fold, test rows only from the test fold."""
        rows = settle(with_chunks(self.df.filter(F.col(self.fold).isin("train", "test")), self.key, k, seed, by=self.fold))
        return [separate_split(rows, i, k, self.fold) for i in range(k)]

    def inner_split(self, df: DataFrame, test_size: float = 0.2, seed: int = 999) -> Split:
        """A single random split of the rows given, for tuning."""
        rows = settle(shuffle_split(df, self.key, test_size, seed, name="_role"))
        return rows.filter("_role = 'train'").drop("_role"), rows.filter("_role = 'test'").drop("_role")

    def fit(self, spec: ModelSpec, df: DataFrame) -> Fitted:
        return fit_model(spec, df, self.design, self.target, self.target_type, self.n_classes)

    def evaluate(self, scored: DataFrame, keys: Sequence[str] = ()) -> list[dict]:
        """Every scorer of the target type on a frame with `yhat`, per key."""
        rows = []
        for s in SCORERS[self.target_type]:
            for r in score(scored, s, self.target, keys=keys).collect():
                rows.append({**{k: r[k] for k in keys}, "scorer": s, "scorer_value": r["value"]})
        return rows


def grid_search(problem: Problem, spec: ModelSpec, grid: Mapping[str, Sequence], splits: Sequence[Split], train_score: bool = True, parallelism: int = 4) -> DataFrame:
    """Long results (params…, fold, fold_type, scorer, scorer_value) of every parameter set on every split."""

    def run(params, fold, train, test):
        fitted = problem.fit(spec.with_params(**params), train)
        rows = []
        for fold_type, part in (("test", test), ("train", train)) if train_score else (("test", test),):
            scored = settle(fitted.score_matrix(part).select(problem.target, "yhat"))
            rows += [{**params, "fold": fold, "fold_type": fold_type, **r} for r in problem.evaluate(scored)]
        return rows

    tasks = [
        lambda params=params, fold=fold, train=train, test=test: run(params, fold, train, test)
        for params in expand_grid(grid)
        for fold, (train, test) in enumerate(splits)
    ]
    rows = [r for part in _parallel(problem.spark, tasks, parallelism) for r in part]
    return problem.spark.createDataFrame(rows)


def staged_search(problem: Problem, spec: ModelSpec, grid: Mapping[str, Sequence], splits: Sequence[Split], train_score: bool = True, parallelism: int = 4) -> DataFrame:
    """Grid search over boosted trees that fits once with the most trees and scores every smaller number in one pass."""
    stages = sorted(int(n) for n in grid["n_estimators"])
    rest = {k: v for k, v in grid.items() if k != "n_estimators"}

    def run(params, fold, train, test):
        fitted = problem.fit(spec.with_params(**params, n_estimators=stages[-1]), train)
        rows = []
        for fold_type, part in (("test", test), ("train", train)) if train_score else (("test", test),):
            scored = staged_scores(fitted, part.select(problem.target, problem.design.getOrDefault("output")), stages)
            scored = settle(scored.select(problem.target, "n_estimators", "yhat"))
            rows += [{**params, "fold": fold, "fold_type": fold_type, **r} for r in problem.evaluate(scored, ["n_estimators"])]
        return rows

    tasks = [
        lambda params=params, fold=fold, train=train, test=test: run(params, fold, train, test)
        for params in expand_grid(rest)
        for fold, (train, test) in enumerate(splits)
    ]
    rows = [r for part in _parallel(problem.spark, tasks, parallelism) for r in part]
    return problem.spark.createDataFrame(rows)


def search_summary(results: DataFrame, params: Sequence[str], target_type: str) -> DataFrame:
    """One row per parameter set with mean and std of every scorer on test and train rows."""
    return pivot_scores(results, params, scorers=SCORERS[target_type])


def best_params(summary: DataFrame, params: Sequence[str], metric: str) -> dict[str, Any]:
    """Parameters with the best mean test score, in the direction of the metric; ties by parameter value."""
    column = F.col(f"mean_test_{metric}")
    order = F.desc_nulls_last(column) if METRICS[metric].greater_is_better else F.asc_nulls_last(column)
    row = summary.orderBy(order, *params).select(*params).first()
    return {p: row[p] for p in params}


def tune(problem: Problem, spec: ModelSpec, grid: Mapping[str, Sequence], splits: Sequence[Split], refit_on: DataFrame, metric: str | None = None, parallelism: int = 4) -> tuple[Fitted, dict[str, Any], DataFrame]:
    """Search, pick the best parameters and fit them on `refit_on`. Returns the model, the parameters and the summary."""
    search = staged_search if spec.kind == "boosted_trees" and "n_estimators" in grid else grid_search
    results = search(problem, spec, grid, splits, train_score=False, parallelism=parallelism)
    summary = search_summary(results, list(grid), problem.target_type)
    params = best_params(summary, list(grid), metric or SCORERS[problem.target_type][0])
    return problem.fit(spec.with_params(**params), refit_on), params, summary


def cv_fits(problem: Problem, spec: ModelSpec, splits: Sequence[Split], parallelism: int = 4) -> list[Fitted]:
    """One fitted model per split."""
    return _parallel(problem.spark, [lambda train=train: problem.fit(spec, train) for train, _ in splits], parallelism)


def compare_models(problem: Problem, candidates: Mapping[str, tuple[ModelSpec, Mapping[str, Sequence]]], k: int = 5, parallelism: int = 2) -> DataFrame:
    """Nested validation: tune each candidate on an inner split of each outer training set, score on the outer test set.

    (model, run, scorer, scorer_value)
    """
    rows = []
    for run, (train, test) in enumerate(problem.splits(k)):
        inner = problem.inner_split(train)
        for name, (spec, grid) in candidates.items():
            fitted, _, _ = tune(problem, spec, grid, [inner], train, parallelism=parallelism)
            scored = settle(fitted.score_matrix(test).select(problem.target, "yhat"))
            rows += [{"model": name, "run": run, **r} for r in problem.evaluate(scored)]
    return problem.spark.createDataFrame(rows)


def learning_curve(problem: Problem, spec: ModelSpec, split: Split, grid: Mapping[str, Sequence] | None = None, shares: Sequence[float] = LEARNING_SHARES, metric: str | None = None, seed: int = 42) -> DataFrame:
    """Score and fit time on nested shares of the training rows: (share, n_train, fold, score, fit_time)."""
    metric = metric or SCORERS[problem.target_type][0]
    train = settle(learning_subsets(split[0], problem.key, seed, shares))
    rows = []
    for i, share in enumerate(shares):
        part = train.filter(F.col("step") <= i).drop("step")
        start = time.time()
        if grid:
            fitted, _, _ = tune(problem, spec, grid, [problem.inner_split(part)], part, metric)
        else:
            fitted = problem.fit(spec, part)
        spent, n = time.time() - start, part.count()
        for fold, frame in (("train", part), ("test", split[1])):
            scored = settle(fitted.score_matrix(frame).select(problem.target, "yhat"))
            value = score(scored, metric, problem.target).first()["value"]
            rows.append((float(share), n, fold, value, spent))
    return problem.spark.createDataFrame(rows, "share double, n_train long, fold string, score double, fit_time double")


# --- frames behind the search pictures ------------------------------------------------------------------


def cv_result_frame(summary: DataFrame, metric: str, params: Sequence[str]) -> DataFrame:
    """Parameters without the `param_` prefix and the mean test score."""
    names = {c: c.removeprefix("param_") for c in summary.columns}
    out = summary.withColumnsRenamed(names)
    return out.select(*[p.removeprefix("param_") for p in params], F.col(f"mean_test_{metric}").alias("score"))


def generalization_gap(summary: DataFrame, metric: str, params: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Train and test score in long form (params…, fold, score), and their difference (params…, train_test_score_diff)."""
    wide = summary.select(
        *params, F.col(f"mean_test_{metric}").alias("test"), F.col(f"mean_train_{metric}").alias("train")
    )
    gap = wide.select(*params, (F.col("train") - F.col("test")).alias("train_test_score_diff"))
    return melt(wide, list(params), ["test", "train"], "fold", "score"), gap


def comparison_frame(results: DataFrame, metric: str) -> tuple[DataFrame, DataFrame]:
    """Box statistics per model, and the score of every run for the connecting lines."""
    lines = results.filter(F.col("scorer") == metric).select("model", "run", F.col("scorer_value").alias("score"))
    return box_stats(lines, "score", by="model"), lines
