"""Stage 3: fit the chosen model and explain it."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.predictions import with_residuals
from tabwright.operators import interpret as X
from tabwright.operators import shap as S
from tabwright.operators.curves import performance_report
from tabwright.operators.density import distribution_profile
from tabwright.operators.encode import DesignMatrix
from tabwright.operators.models import Fitted, ModelSpec, fit_model, gain_importance
from tabwright.operators.reshape import union_rows
from tabwright.operators.sample import Undersample, worst_best_random
from tabwright.operators.split import separate_split, with_chunks
from tabwright.schema import REGR
from tabwright.session import settle


@dataclass
class Interpreted:
    fitted: Fitted
    scored: DataFrame
    top: list[str]
    frames: dict[str, DataFrame] = field(default_factory=dict)


def interpret(
    table: DataFrame,
    metr: Sequence[str],
    cate: Sequence[str],
    spec: ModelSpec,
    key: str = "id",
    target: str = "target",
    target_type: str = "CLASS",
    labels: Sequence[str] = ("0", "1"),
    n_max: int = 500,
    k: int = 5,
    cut: float = 95.0,
    topn: int = 10,
    n_select: int = 10,
    seed: int = 42,
) -> Interpreted:
    """Fit on training rows, then performance, importance, dependence and explanations.

    `n_max` bounds the rows per class that a classifier is fitted on, in the fit on all training rows and in each
    of the k cross-validation fits; a regression is fitted on all. Everything is measured on all rows of the train
    or test part concerned. `n_select` rows are explained from the worst, the best and at random.
    """
    metr, cate, frames = list(metr), list(cate), {}
    table = settle(table)  # every fit, score and importance reads it
    train, test = table.filter(F.col("fold") == "train"), table.filter(F.col("fold") == "test")
    b_sample = b_all = None
    if target_type != REGR:
        sampler = Undersample(n_max, target, key, seed).fit(train)
        b_sample, b_all = sampler.b_sample, sampler.b_all
    both = settle(with_chunks(union_rows(train, test), key, k, seed, by="fold"))
    design = DesignMatrix(metr, cate).fit(both)

    def fit(df: DataFrame, matrix=design) -> Fitted:
        if target_type != REGR:
            df = settle(Undersample(n_max, target, key, seed).fit(df).sample(df))
        return fit_model(spec, df, matrix, target, target_type, len(labels))

    def scorer(model: Fitted):
        return lambda df: model.score(df, b_sample, b_all)

    fitted = fit(train)
    scored = settle(with_residuals(scorer(fitted)(test), target, "yhat", target_type))
    frames |= {f"performance_{n}": f for n, f in performance_report(scored, target_type, target, "yhat", labels).items()}
    if spec.kind in ("random_forest", "boosted_trees"):
        frames["gain"] = gain_importance(fitted)

    # importance
    features = metr + cate
    on_train = settle(X.permutation_importance(train, scorer(fitted), features, key, target, target_type))
    kept = X.top_features(on_train, cut)
    top_design = DesignMatrix([m for m in metr if m in kept], [c for c in cate if c in kept]).fit(both)
    scored_top = settle(scorer(fit(train, top_design))(test))
    frames |= {f"performance_top_{n}": f for n, f in performance_report(scored_top, target_type, target, "yhat", labels).items()}
    on_test = settle(X.permutation_importance(test, scorer(fitted), features, key, target, target_type))
    top = [r["feature"] for r in on_test.orderBy(F.desc("perf_diff"), "feature").limit(topn).collect()]
    splits = [separate_split(both, i, k) for i in range(k)]
    fits = [fit(tr) for tr, _ in splits]
    runs = [
        settle(X.permutation_importance(tr, scorer(f), top, key, target, target_type)) for f, (tr, _) in zip(fits, splits)
    ]
    frames["importance"] = X.importance_summary(on_test, X.importance_over_runs(runs))
    frames["importance_folds"] = X.train_versus_test(on_train, on_test)

    # residuals
    residuals = distribution_profile(scored, features, "residual", REGR)
    frames |= {f"residual_{n}": f for n, f in residuals.items()}

    # dependence
    grid_metr, grid_cate = [m for m in metr if m in top], [c for c in cate if c in top]

    def dependence(df: DataFrame, model: Fitted) -> DataFrame:
        return settle(X.fitted_dependence(df, model, grid_metr, grid_cate, both, labels, b_sample=b_sample, b_all=b_all))

    over_runs = X.importance_over_runs([dependence(tr, f) for f, (tr, _) in zip(fits, splits)])
    frames["dependence"] = X.dependence_band(dependence(test, fitted), over_runs)

    # explanations of single rows
    if spec.kind != "network":
        picked = settle(worst_best_random(scored, "abs_residual", key, n_select, n_select + 1, seed))
        rows = settle(S.explain_rows(fitted, picked, key, target, b_sample, b_all, train, keep=["yhat"]))
        frames["shap"] = S.long_frame(rows)
        frames["shap_check"] = S.check_rows(rows, "yhat", target_type)
        frames["waterfall"] = S.waterfall(S.true_class_only(rows) if target_type == "MULTICLASS" else rows, topn)
    return Interpreted(fitted, scored, top, frames)
