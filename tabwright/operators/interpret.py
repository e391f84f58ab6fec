"""Model-agnostic interpretation: permutation importance, partial dependence and their summaries.

A scorer is any function that adds `yhat` to a frame of raw features (`Fitted.score`, or an expression).
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.lookup import attach
from tabwright.functions.quantiles import fit_quantiles
from tabwright.functions.ranks import hashed_index
from tabwright.functions.scalars import fixed_cut
from tabwright.operators.metrics import METRICS, SCORERS, score, score_value
from tabwright.operators.models import Fitted
from tabwright.operators.profile import running_share, spread, target_profile
from tabwright.operators.reshape import melt, union_rows
from tabwright.operators.trees import tree_dependence
from tabwright.schema import CLASS, MULTICLASS, REGR
from tabwright.session import settle

Scorer = Callable[[DataFrame], DataFrame]

# --- permutation importance ------------------------------------------------------------------------------


def with_donor(df: DataFrame, key: str, features: Sequence[str], seed: int = 999, settled: bool = False) -> DataFrame:
    """Add to each row the features of another row, `_donor_x`, under one random permutation of all rows.

    Rows and donors are numbered in two random orders and meet on the number: a one-to-one join without skew. The rows
    are settled once (unless the caller did), as both orders read them twice.
    """
    df = df if settled else settle(df)
    rows = hashed_index(df, key, seed, name="_position")
    donors = hashed_index(df.select(key, *features), key, f"{seed}-donor", name="_position")
    donors = donors.select("_position", *[F.col(f).alias(f"_donor_{f}") for f in features])
    return rows.join(donors, "_position").drop("_position")


def permuted_copies(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One copy of each row per feature in which that feature holds the donor's value."""
    copies = df.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    return copies.withColumns(
        {f: F.when(F.col("feature") == f, F.col(f"_donor_{f}")).otherwise(F.col(f)) for f in features}
    ).drop(*[f"_donor_{f}" for f in features])


def normalise_importance(drops: DataFrame) -> DataFrame:
    """(feature, perf_diff) to perf_diff >= 0, importance (percent of the largest), its running and its plain share of the sum."""
    d = drops.withColumn("perf_diff", F.greatest(F.col("perf_diff"), F.lit(0.0)))
    largest, total = d.agg(F.max("perf_diff")).scalar(), d.agg(F.sum("perf_diff")).scalar()
    d = d.withColumn("importance", F.try_divide(100 * F.col("perf_diff"), largest))
    d = running_share(d, "perf_diff", [F.desc("perf_diff"), F.asc("feature")], "importance_cum")
    return d.withColumn("importance_sumnormed", F.try_divide(100 * F.col("perf_diff"), total))


def permutation_importance(
    df: DataFrame,
    scorer: Scorer,
    features: Sequence[str],
    key: str = "id",
    target: str = "target",
    target_type: str = CLASS,
    seed: int = 999,
    metric: str | None = None,
    batch: int = 50,
) -> DataFrame:
    """Drop of the performance when one feature is permuted, for all features, `batch` features per job.

    All copies of a batch are scored by one transform and reduced by one grouped metric.
    """
    metric = metric or SCORERS[target_type][0]
    features = list(features)
    df = settle(df)
    original = score_value(scorer(df), metric, target)
    joined = with_donor(df, key, features, seed, settled=True)
    if len(features) > batch:
        joined = settle(joined)  # several jobs read it
    parts = []
    for start in range(0, len(features), batch):
        names = features[start : start + batch]
        scored = scorer(permuted_copies(joined.drop(*[f"_donor_{f}" for f in features if f not in names]), names))
        scored = scored.select("feature", target, "yhat")
        if METRICS[metric].several_passes:
            scored = settle(scored)
        parts.append(score(scored, metric, target, keys=["feature"]))
    drops = settle(union_rows(*parts).select("feature", (F.lit(original) - F.col("value")).alias("perf_diff")))
    return normalise_importance(drops)


def top_features(importance: DataFrame, cut: float = 95.0) -> list[str]:
    """Features whose running share is below the cut, at least the first one."""
    rows = importance.orderBy("importance_cum", F.desc("perf_diff"), "feature").select("feature", "importance_cum").collect()
    kept = [r["feature"] for r in rows if r["importance_cum"] is not None and r["importance_cum"] < cut]
    return kept or [r["feature"] for r in rows[:1]]


def importance_over_runs(frames: Sequence[DataFrame]) -> DataFrame:
    """Importance of several fits, tagged with their run number."""
    return union_rows(*[f.withColumn("run", F.lit(i)) for i, f in enumerate(frames)])


def importance_summary(importance: DataFrame, over_runs: DataFrame | None = None) -> DataFrame:
    """Add the category (low, medium, high) and, from repeated runs, mean and standard error."""
    out = importance.withColumn("Category", fixed_cut("importance"))
    if over_runs is None:
        return out
    return attach(out, spread(over_runs, ["feature"], "importance").drop("importance_std"), ["feature"])


def train_versus_test(train: DataFrame, test: DataFrame) -> DataFrame:
    return union_rows(train.withColumn("fold", F.lit("train")), test.withColumn("fold", F.lit("test")))


# --- partial dependence ----------------------------------------------------------------------------------


def dependence_grid(df_ref: DataFrame, metr: Sequence[str], cate: Sequence[str], n: int = 10) -> dict[str, list]:
    """Grid per feature: quantiles 0, 1/n … 1 of a metric one, all categories of a categorical one.

    The lists become columns of copied rows; for trees and any number of categories see `fitted_dependence`.
    """
    grid: dict[str, list] = {}
    if metr:
        grid |= fit_quantiles(df_ref, list(metr), [i / n for i in range(n + 1)])
    for r in category_grid(df_ref, cate).orderBy("feature", "value").collect() if cate else []:
        grid.setdefault(r["feature"], []).append(r["value"])
    return grid


def category_grid(df_ref: DataFrame, cate: Sequence[str]) -> DataFrame:
    """All categories as a table (feature, value)."""
    return melt(df_ref, [], list(cate), "feature").filter(F.col("value").isNotNull()).distinct()


def with_grid(df: DataFrame, grid: dict[str, list], metr: Sequence[str]) -> DataFrame:
    """One copy of each row per (feature, grid value) in which the feature holds that value."""
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(str(v)).alias("value"),
            (F.lit(float(v)) if f in metr else F.lit(None).cast("double")).alias("number"),
        )
        for f, values in grid.items()
        for v in dict.fromkeys(values)
    ]
    copies = df.withColumn("_grid", F.explode(F.array(*cells)))
    new = {
        f: F.when(F.col("_grid.feature") == f, F.col("_grid.number" if f in metr else "_grid.value")).otherwise(F.col(f))
        for f in grid
    }
    return copies.withColumns({**new, "feature": F.col("_grid.feature"), "value": F.col("_grid.value")}).drop("_grid")


def partial_dependence(
    df: DataFrame,
    scorer: Scorer,
    metr: Sequence[str],
    cate: Sequence[str],
    df_ref: DataFrame | None = None,
    target_type: str = CLASS,
    labels: Sequence[str] = (),
    n: int = 10,
    batch_cells: int = 200,
) -> DataFrame:
    """Mean prediction over all rows with one feature set to each grid value: (feature, value, target, yhat_mean, type).

    The copies are made and reduced inside each task; only (feature, value) means are shuffled.
    """
    grid = dependence_grid(df if df_ref is None else df_ref, metr, cate, n)
    batches: list[dict[str, list]] = [{}]
    for f, values in grid.items():
        if batches[-1] and sum(map(len, batches[-1].values())) + len(values) > batch_cells:
            batches.append({})
        batches[-1][f] = values
    parts = []
    for b in batches:
        scored = scorer(with_grid(df, b, metr))
        if target_type == REGR:
            pairs = scored.select("feature", "value", F.lit("target").alias("target"), F.col("yhat").alias("p"))
        elif target_type == MULTICLASS:
            names = F.array(*[F.lit(x) for x in labels])
            pairs = scored.select("feature", "value", F.posexplode("yhat").alias("k", "p"))
            pairs = pairs.select("feature", "value", names[F.col("k")].alias("target"), "p")
        else:
            pairs = scored.select("feature", "value", F.lit("target").alias("target"), F.col("yhat")[1].alias("p"))
        parts.append(pairs.groupBy("feature", "value", "target").agg(F.avg("p").alias("yhat_mean")))
    kind = F.when(F.col("feature").isin(*metr), "metr").otherwise("cate") if metr else F.lit("cate")
    return union_rows(*parts).withColumn("type", kind)


def fitted_dependence(
    df: DataFrame,
    fitted: Fitted,
    metr: Sequence[str],
    cate: Sequence[str],
    df_ref: DataFrame | None = None,
    labels: Sequence[str] = (),
    n: int = 10,
    b_sample: Sequence[float] | None = None,
    b_all: Sequence[float] | None = None,
) -> DataFrame:
    """`partial_dependence` of a fitted model. Trees are read once per row for all grid values; other models score copies."""
    if fitted.kind not in ("random_forest", "boosted_trees"):
        return partial_dependence(df, lambda d: fitted.score(d, b_sample, b_all), metr, cate, df_ref, fitted.target_type, labels, n)
    df_ref = df if df_ref is None else df_ref
    grid = dependence_grid(df_ref, metr, [], n)
    names = list(labels) if fitted.target_type == MULTICLASS else ["target"]
    kind = F.when(F.col("feature").isin(*metr), "metr").otherwise("cate") if metr else F.lit("cate")
    levels = category_grid(df_ref, cate) if cate else None
    return tree_dependence(fitted, df, grid, names, levels, b_sample, b_all).withColumn("type", kind)


def dependence_band(dependence: DataFrame, over_runs: DataFrame, ci: str = "std") -> DataFrame:
    """Add mean, std and sem over repeated runs, and the band yhat_mean ± std or sem."""
    stats = spread(over_runs, ["feature", "value", "target"], "yhat_mean")
    out = dependence.join(stats, ["feature", "value", "target"], "left")
    width = F.col(f"yhat_mean_{ci}")
    return out.withColumns({"lower": F.col("yhat_mean") - width, "upper": F.col("yhat_mean") + width})


def dependence_background(df_ref: DataFrame, feature: str, target: str = "target") -> DataFrame:
    """Level shares behind the dependence of a categorical feature, with the overall mean target.

    For a metric feature use `density.kernel_density`.
    """
    return target_profile(df_ref, feature, target).select("level", (F.col("pct") / 100).alias("pct"), "w", "prior")
