"""Stability of coefficients, importance and predictions over repeated cross-validation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.encode import DesignMatrix
from tabwright.operators.interpret import permutation_importance, top_features
from tabwright.operators.models import ModelSpec, coefficients, fit_model
from tabwright.operators.reshape import union_rows
from tabwright.operators.split import repeated_k_fold
from tabwright.session import settle


def _rounds(df: DataFrame, key: str, k: int, n_rep: int, seed: int):
    """(rep, fold, train, test) of repeated cross-validation; the fold table is settled once."""
    folds = settle(repeated_k_fold(df, key, k, n_rep, seed))
    for rep in range(1, n_rep + 1):
        rows = settle(df.join(folds.filter(F.col("rep") == rep).select(key, F.col("fold").alias("_cv")), key))
        for fold in range(1, k + 1):
            yield rep, fold, rows.filter(F.col("_cv") != fold).drop("_cv"), rows.filter(F.col("_cv") == fold).drop("_cv")


def coefficient_stability(df: DataFrame, spec: ModelSpec, metr: Sequence[str], cate: Sequence[str], key: str = "id", target: str = "target", target_type: str = "REGR", k: int = 5, n_rep: int = 10, seed: int = 42) -> DataFrame:
    """Coefficients of a linear model per repetition and fold: (variable, beta, rep, fold)."""
    design = DesignMatrix(metr, cate).fit(df)
    ready = design.transform(df).select(key, target, design.getOrDefault("output"))
    rows = []
    for rep, fold, train, _ in _rounds(ready, key, k, n_rep, seed):
        fitted = fit_model(spec, train, design, target, target_type)
        rows += [(v, b, rep, fold) for v, b in coefficients(fitted)]
    return df.sparkSession.createDataFrame(rows, "variable string, beta double, rep int, fold int")


def kept_coefficients(betas: DataFrame) -> DataFrame:
    """Rows of variables that a fit kept with a positive coefficient."""
    return betas.filter(F.col("beta") > 0)


def importance_stability(df: DataFrame, spec: ModelSpec, metr: Sequence[str], cate: Sequence[str], key: str = "id", target: str = "target", target_type: str = "CLASS", cut: float = 99.0, k: int = 5, n_rep: int = 10, seed: int = 42, n_classes: int = 2) -> tuple[DataFrame, DataFrame]:
    """Per repetition and fold: test predictions of the full model and of the model on its top features, and the importances.

    (key, yhat, type full/vi, rep, fold) and (feature, perf_diff, importance…, type, rep, fold).
    """
    metr, cate = list(metr), list(cate)
    design = DesignMatrix(metr, cate).fit(df)
    predictions, importances = [], []
    for rep, fold, train, test in _rounds(df.select(key, target, *metr, *cate), key, k, n_rep, seed):
        def tag(frame: DataFrame, kind: str) -> DataFrame:
            return frame.withColumns({"type": F.lit(kind), "rep": F.lit(rep), "fold": F.lit(fold)})

        full = fit_model(spec, train, design, target, target_type, n_classes)
        predictions.append(tag(full.score(test).select(key, "yhat"), "full"))
        vi = settle(permutation_importance(train, full.score, metr + cate, key, target, target_type, seed))
        top = top_features(vi, cut)
        importances.append(tag(vi.filter(F.col("feature").isin(*top)), "full"))
        reduced_design = DesignMatrix([m for m in metr if m in top], [c for c in cate if c in top]).fit(df)
        reduced = fit_model(spec, train, reduced_design, target, target_type, n_classes)
        predictions.append(tag(reduced.score(test).select(key, "yhat"), "vi"))
    return union_rows(*predictions), union_rows(*importances)
