"""Stage 2: tune the model families, compare them and draw the learning curve of the winner."""

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.scalars import min_max_scale
from tabwright.operators import search
from tabwright.operators.encode import DesignMatrix
from tabwright.operators.metrics import SCORERS
from tabwright.operators.models import ModelSpec
from tabwright.operators.reshape import union_rows
from tabwright.operators.sample import Undersample
from tabwright.schema import REGR
from tabwright.session import settle
from tabwright.sources.handoff import FeatureSets

# Which feature set each family works on.
FEATURES_OF = {
    "elastic_net": ("metr_binned", "cate_binned"),
    "l1_logistic": ("metr_binned", "cate_binned"),
    "random_forest": ("metr_standard", "cate_standard"),
    "boosted_trees": ("metr_standard", "cate_standard"),
    "network": ("metr_encoded", "cate_encoded"),
}


def tuning_table(df: DataFrame, target_type: str, key: str = "id", target: str = "target", n_max: int = 5_000_000, seed: int = 42) -> DataFrame:
    """Training rows, of a class target at most `n_max` per class, plus all test rows; for regression all rows."""
    if target_type == REGR:
        return df
    train = df.filter(F.col("fold") == "train")
    sampled = Undersample(n_max, target, key, seed).fit(train).sample(train)
    return union_rows(sampled, df.filter(F.col("fold") == "test"))


def family_problem(df: DataFrame, sets: FeatureSets, kind: str, key: str = "id", target: str = "target", target_type: str = "CLASS", n_classes: int = 2) -> search.Problem:
    """Design frame of one model family."""
    metr, cate = (getattr(sets, name) for name in FEATURES_OF[kind])
    return search.Problem(df, DesignMatrix(metr, cate).fit(df), key, target, target_type, n_classes)


def compare(
    table: DataFrame,
    sets: FeatureSets,
    candidates: Mapping[str, tuple[ModelSpec, Mapping[str, Sequence[Any]]]],
    winner: str,
    key: str = "id",
    target: str = "target",
    target_type: str = "CLASS",
    n_classes: int = 2,
    k: int = 5,
    shares: Sequence[float] = (0.1, 0.4, 1.0),
    n_max: int = 5_000_000,
) -> dict[str, DataFrame]:
    """Search results and summary per candidate, the generalization gap, the comparison and the learning curve.

    `n_max` bounds the rows per class that classifiers are fitted on; regressions and all test rows are used whole.
    """
    metric = SCORERS[target_type][0]
    df = settle(tuning_table(min_max_scale(table, sets.metr_encoded), target_type, key, target, n_max))  # every candidate reads it
    out: dict[str, DataFrame] = {}
    comparisons = []
    for name, (spec, grid) in candidates.items():
        problem = family_problem(df, sets, spec.kind, key, target, target_type, n_classes)
        one = problem.splits(1)
        run = search.staged_search if spec.kind == "boosted_trees" else search.grid_search
        summary = search.search_summary(run(problem, spec, grid, one), list(grid), target_type)
        out[f"search_{name}"] = summary
        out[f"gap_{name}"], out[f"gap_difference_{name}"] = search.generalization_gap(summary, metric, list(grid))
        comparisons.append(search.compare_models(problem, {name: (spec, grid)}, k))
        if name == winner:
            best = search.best_params(summary, list(grid), metric)
            out["learning_curve"] = search.learning_curve(problem, spec.with_params(**best), one[0], shares=shares)
    out["comparison"], out["comparison_runs"] = search.comparison_frame(union_rows(*comparisons), metric)
    return out
