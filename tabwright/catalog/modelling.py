"""Queries on models, search and interpretation.

Model training has no SQL counterpart: those queries are checked by row counts here and by properties in the
tests. Everything around the models is checked in SQL with a fixed linear scorer.
"""

from pyspark.sql import functions as F

from tabwright.catalog.frames import ORDER_SQL, SEARCH_SQL, order_frame, search_frame
from tabwright.catalog.projections import scratch
from tabwright.catalog.registry import query
from tabwright.catalog.reshaping import DONOR_SQL, SUMMARY_SQL
from tabwright.catalog.statistics import auc_sql, box_sql
from tabwright.operators import interpret, optimality, search, shap, stability
from tabwright.operators.encode import DesignMatrix
from tabwright.operators.metrics import score
from tabwright.operators.models import ModelSpec, coefficients, fit_model, gain_importance
from tabwright.operators.profile import selection_counts
from tabwright.operators.reshape import union_rows
from tabwright.operators.sample import Undersample
from tabwright.functions.predictions import with_residuals
from tabwright.plans.production import score_saved, train_and_save
from tabwright.session import settle

METR = ["qty", "lines", "tax", "discount"]
CATE = ["flag", "status"]
TREES = ModelSpec("boosted_trees", {"n_estimators": 8, "learning_rate": 0.3, "max_depth": 3, "seed": 1})

FOREST = ModelSpec("random_forest", {"n_estimators": 6, "max_depth": 4, "max_features": 3, "seed": 1})


def orders(spark, sf):
    """`order_frame`, summed once for all passes of a query."""
    return settle(order_frame(spark, sf))


def problem(spark, sf, target="target", target_type="CLASS", n_classes=2, cate=CATE):
    df = orders(spark, sf)
    design = DesignMatrix(METR, cate).fit(df)
    return search.Problem(df, design, "id", target, target_type, n_classes)


def fitted_scores(spark, sf, spec, target="target", target_type="CLASS", n_classes=2):
    """(metric, fold, value) of one model trained on the train fold."""
    p = problem(spark, sf, target, target_type, n_classes)
    train, test = p.splits(1)[0]
    fitted = p.fit(spec, train)
    rows = [{"fold": name, **r} for name, part in (("train", train), ("test", test)) for r in p.evaluate(fitted.score_matrix(part))]
    return spark.createDataFrame(rows)


# --- models ----------------------------------------------------------------------------------------------


@query(
    "linear_model_coefficients",
    f"""SELECT 'qty' AS variable, regr_slope(y, qty) AS beta FROM ({ORDER_SQL}) AS t
    UNION ALL SELECT 'intercept', regr_intercept(y, qty) FROM ({ORDER_SQL}) AS t""",
    num="beta",
    digits=3,
)
def _(spark, sf):
    df = order_frame(spark, sf)
    fitted = fit_model(ModelSpec("elastic_net", {"alpha": 0.0}), df, DesignMatrix(["qty"]).fit(df), "y", "REGR")
    rows = [*coefficients(fitted), ("intercept", float(fitted.models[0].intercept))]
    return spark.createDataFrame(rows, "variable string, beta double")


@query("model_elastic_net_class")
def _(spark, sf):
    return fitted_scores(spark, sf, ModelSpec("elastic_net", {"alpha": 0.01, "l1_ratio": 1.0}))


@query("model_elastic_net_regression")
def _(spark, sf):
    return fitted_scores(spark, sf, ModelSpec("elastic_net", {"alpha": 1.0, "l1_ratio": 1.0}), "y", "REGR")


@query("model_l1_logistic")
def _(spark, sf):
    return fitted_scores(spark, sf, ModelSpec("l1_logistic", {"C": 0.25}), "target3", "MULTICLASS", 3)


@query("model_random_forest")
def _(spark, sf):
    return fitted_scores(spark, sf, ModelSpec("random_forest", {"n_estimators": 10, "max_features": 2, "seed": 1}))


@query("model_boosted_trees_class")
def _(spark, sf):
    return fitted_scores(spark, sf, TREES)


@query("model_boosted_trees_multiclass")
def _(spark, sf):
    return fitted_scores(spark, sf, TREES, "target3", "MULTICLASS", 3)


@query("model_boosted_trees_regression")
def _(spark, sf):
    return fitted_scores(spark, sf, TREES.with_params(num_leaves=8), "y", "REGR")


@query("model_network")
def _(spark, sf):
    return fitted_scores(spark, sf, ModelSpec("network", {"size": "6", "epochs": 20}))


SLOTS_SQL = f"(SELECT 4 + count(DISTINCT flag) + count(DISTINCT status) + 1 FROM ({ORDER_SQL}) AS o)"
LINEAR = {
    "regression": (ModelSpec("elastic_net", {"alpha": 500.0, "l1_ratio": 1.0}), "y", "REGR", 2, 500.0, 1.0),
    "ridge": (ModelSpec("elastic_net", {"alpha": 500.0, "l1_ratio": 0.0}), "y", "REGR", 2, 500.0, 0.0),
    "class": (ModelSpec("elastic_net", {"alpha": 0.02, "l1_ratio": 0.5, "max_iter": 500}), "target", "CLASS", 2, 0.02, 0.5),
    "multiclass": (ModelSpec("elastic_net", {"alpha": 0.01, "l1_ratio": 1.0, "max_iter": 500}), "target3", "MULTICLASS", 3, 0.01, 1.0),
}
for _name, (_spec, _target, _type, _n, _alpha, _l1) in LINEAR.items():
    # every coefficient and intercept of every class: its optimality condition holds to a thousandth of the residual's deviation

    @query(
        f"optimality_linear_{_name}",
        f"SELECT {_n if _type == 'MULTICLASS' else 1} * {SLOTS_SQL} AS conditions, {_n if _type == 'MULTICLASS' else 1} * {SLOTS_SQL} AS satisfied",
    )
    def _(spark, sf, spec=_spec, target=_target, target_type=_type, n=_n, alpha=_alpha, l1_ratio=_l1):
        df = order_frame(spark, sf)
        fitted = fit_model(spec, df, DesignMatrix(METR, CATE).fit(df), target, target_type, n)
        found = optimality.linear_conditions(fitted, df, alpha, l1_ratio, target)
        return found.agg(F.count(F.lit(1)).alias("conditions"), F.count_if(F.col("violation") < 1e-3).alias("satisfied"))


for _name, (_target, _type, _n, _where) in {
    "regression": ("y", "REGR", 2, 0), "class": ("target", "CLASS", 2, 0), "multiclass": ("target3", "MULTICLASS", 3, 2)
}.items():
    # all training rows lie in leaves of the first tree that predict their mean and were counted in training

    @query(f"optimality_leaves_{_name}", f"SELECT count(*) AS n, count(*) AS n_close FROM ({ORDER_SQL}) AS o")
    def _(spark, sf, target=_target, target_type=_type, n=_n, ensemble=_where):
        df = order_frame(spark, sf)
        fitted = fit_model(TREES.with_params(n_estimators=2), df, DesignMatrix(METR, CATE).fit(df), target, target_type, n)
        leaves = optimality.first_tree_leaves(fitted, df, target, ensemble)
        close = (F.abs(F.col("mean") - F.col("prediction")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("mean"))) & (F.col("n") == F.col("training_rows"))
        return leaves.agg(F.sum("n").alias("n"), F.sum(F.when(close, F.col("n")).otherwise(0)).alias("n_close"))


@query("gain_importance")
def _(spark, sf):
    p = problem(spark, sf)
    return gain_importance(p.fit(TREES, p.splits(1)[0][0]))


@query("batch_scoring")
def _(spark, sf):
    path = scratch(spark)
    df = order_frame(spark, sf).withColumn("encode_flag", (F.col("id") % 5 == 1).cast("int"))
    train_and_save(df.filter("fold = 'train'"), path, METR, CATE, spec=TREES, n_max_per_level=2000)
    scored = score_saved(df.filter("fold = 'test'"), path)
    return scored.select("id", F.col("yhat")[1].alias("p"))


# --- search ------------------------------------------------------------------------------------------------


@query("grid_search")
def _(spark, sf):
    p = problem(spark, sf)
    return search.grid_search(p, ModelSpec("elastic_net"), {"alpha": [0.01, 0.1], "l1_ratio": [1.0]}, p.splits(2))


@query("staged_tree_search")
def _(spark, sf):
    p = problem(spark, sf)
    results = search.staged_search(p, TREES, {"n_estimators": [2, 5, 8], "max_depth": [2, 3]}, p.splits(1))
    return search.search_summary(results, ["n_estimators", "max_depth"], "CLASS")


@query(
    "best_parameters",
    f"""SELECT n_estimators, depth FROM ({SUMMARY_SQL}) AS s ORDER BY mean_test_auc DESC, n_estimators, depth LIMIT 1""",
)
def _(spark, sf):
    params = ["n_estimators", "depth"]
    summary = search.search_summary(search_frame(spark, sf), params, "CLASS")
    best = search.best_params(summary, params, "auc")
    return spark.createDataFrame([tuple(best.values())], "n_estimators int, depth string")


@query("nested_model_comparison")
def _(spark, sf):
    candidates = {
        "ElasticNet": (ModelSpec("elastic_net"), {"alpha": [0.01], "l1_ratio": [1.0]}),
        "Trees": (TREES, {"n_estimators": [4, 8]}),
    }
    return search.compare_models(problem(spark, sf), candidates, k=2)


@query("cv_fits")
def _(spark, sf):
    p = problem(spark, sf)
    splits = p.splits(3)
    fits = search.cv_fits(p, ModelSpec("elastic_net", {"alpha": 0.01}), splits)
    rows = [{"run": i, **r} for i, (f, (_, test)) in enumerate(zip(fits, splits)) for r in p.evaluate(f.score_matrix(test))]
    return spark.createDataFrame(rows)


@query(
    "generalization_gap",
    f"""SELECT n_estimators, depth, fold, score FROM (SELECT n_estimators, depth, 'test' AS fold, mean_test_auc AS score FROM ({SUMMARY_SQL}) AS a
    UNION ALL SELECT n_estimators, depth, 'train', mean_train_auc FROM ({SUMMARY_SQL}) AS b
    UNION ALL SELECT n_estimators, depth, 'diff', mean_train_auc - mean_test_auc FROM ({SUMMARY_SQL}) AS c) AS u""",
    num="score",
    digits=9,
)
def _(spark, sf):
    params = ["n_estimators", "depth"]
    long, gap = search.generalization_gap(search.search_summary(search_frame(spark, sf), params, "CLASS"), "auc", params)
    diff = gap.select(*params, F.lit("diff").alias("fold"), F.col("train_test_score_diff").alias("score"))
    return long.unionByName(diff)


@query("cv_result_frame", f"SELECT n_estimators, depth, mean_test_auc AS score FROM ({SUMMARY_SQL}) AS s", num="score", digits=9)
def _(spark, sf):
    summary = search.search_summary(search_frame(spark, sf), ["n_estimators", "depth"], "CLASS")
    summary = summary.withColumnsRenamed({"n_estimators": "param_n_estimators", "depth": "param_depth"})
    return search.cv_result_frame(summary, "auc", ["param_n_estimators", "param_depth"])


RUNS_SQL = f"SELECT depth AS model, fold * 1000 + n_estimators AS run, scorer_value AS score FROM ({SEARCH_SQL}) AS r WHERE scorer = 'auc' AND fold_type = 'test'"


@query(
    "model_comparison_frame",
    f"""SELECT model, 'box' AS kind, -1 AS run, median AS score FROM ({box_sql(RUNS_SQL, 'score', 'model')}) AS b
    UNION ALL SELECT model, 'run', run, score FROM ({RUNS_SQL}) AS l""",
    num="score",
    digits=9,
)
def _(spark, sf):
    runs = search_frame(spark, sf).filter("fold_type = 'test'").select(
        F.col("depth").alias("model"), (F.col("fold") * 1000 + F.col("n_estimators")).alias("run"), "scorer", "scorer_value"
    )
    box, lines = search.comparison_frame(runs, "auc")
    return union_rows(
        box.select("model", F.lit("box").alias("kind"), F.lit(-1).alias("run"), F.col("median").alias("score")),
        lines.select("model", F.lit("run").alias("kind"), "run", "score"),
    )


@query("learning_curve")
def _(spark, sf):
    p = problem(spark, sf)
    out = search.learning_curve(p, ModelSpec("elastic_net", {"alpha": 0.01}), p.splits(1)[0], shares=(0.1, 0.5, 1.0))
    return out.drop("fit_time")


@query("refit_on_top_features")
def _(spark, sf):
    df = orders(spark, sf)
    train, test = df.filter("fold = 'train'"), df.filter("fold = 'test'")
    fitted = fit_model(TREES, train, DesignMatrix(METR, CATE).fit(df))
    top = interpret.top_features(interpret.permutation_importance(train, fitted.score, METR + CATE), 95.0)
    design = DesignMatrix([m for m in METR if m in top], [c for c in CATE if c in top]).fit(df)
    reduced = fit_model(TREES, train, design)
    return union_rows(
        *[score(f.score(test), "auc").select(F.lit(n).alias("model"), "value") for n, f in (("full", fitted), ("top", reduced))]
    )


# --- importance and dependence with a fixed scorer -----------------------------------------------------------


def linear_scorer(df):
    p = F.col("qty") / 400 + F.col("lines") / 40
    return df.withColumn("yhat", F.array(1 - p, p))


COPIES_SQL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, target, {q} / 400 + {n} / 40 AS p FROM ({DONOR_SQL}) AS d"
    for f, q, n in (("qty", "dq", "lines"), ("lines", "qty", "dl"), ("tax", "qty", "lines"))
)
DROPS_SQL = f"""SELECT feature, greatest(0, (SELECT auc FROM ({auc_sql(f"SELECT target, qty / 400 + lines / 40 AS p FROM ({ORDER_SQL}) AS o", 'target', 'p')}) AS a) - auc) AS perf_diff
  FROM ({auc_sql(COPIES_SQL, 'target', 'p', 'feature')}) AS c"""
IMPORTANCE_SQL = f"""SELECT feature, perf_diff, 100 * perf_diff / max(perf_diff) OVER () AS importance,
  100 * sum(perf_diff) OVER (ORDER BY perf_diff DESC, feature) / sum(perf_diff) OVER () AS importance_cum,
  100 * perf_diff / sum(perf_diff) OVER () AS importance_sumnormed FROM ({DROPS_SQL}) AS d"""
IMPORTANCE_NUM = "perf_diff importance importance_cum importance_sumnormed"


@query("permutation_importance", IMPORTANCE_SQL, num=IMPORTANCE_NUM)
def _(spark, sf):
    return interpret.permutation_importance(order_frame(spark, sf), linear_scorer, ["qty", "lines", "tax"])


FOLD_RUNS_SQL = f"""SELECT feature, importance, run FROM (SELECT feature, CAST(fold AS INTEGER) AS run, 100 * d / max(d) OVER (PARTITION BY fold) AS importance FROM (
  SELECT flag AS feature, id % 3 AS fold, avg(qty) AS d FROM ({ORDER_SQL}) AS o GROUP BY 1, 2) AS g) AS h"""


def runs_frame(spark, sf, run):
    return order_frame(spark, sf).filter(F.col("id") % 3 == run).groupBy(F.col("flag").alias("feature")).agg(F.avg("qty").alias("perf_diff"))


@query("importance_over_runs", FOLD_RUNS_SQL, num="importance")
def _(spark, sf):
    frames = [interpret.normalise_importance(runs_frame(spark, sf, i)) for i in range(3)]
    return interpret.importance_over_runs(frames).select("feature", "importance", "run")


@query(
    "importance_summary",
    f"""SELECT i.feature, importance, CASE WHEN importance <= 10 THEN 'low' WHEN importance <= 50 THEN 'medium' ELSE 'high' END AS "Category",
    importance_mean, importance_sem FROM (SELECT feature, 100 * d / max(d) OVER () AS importance FROM (SELECT flag AS feature, avg(qty) AS d FROM ({ORDER_SQL}) AS o GROUP BY 1) AS a) AS i
    LEFT JOIN (SELECT feature, avg(importance) AS importance_mean, stddev_samp(importance) / sqrt(count(*)) AS importance_sem FROM ({FOLD_RUNS_SQL}) AS r GROUP BY 1) AS s
    ON s.feature = i.feature""",
    num="importance importance_mean importance_sem",
)
def _(spark, sf):
    whole = order_frame(spark, sf).groupBy(F.col("flag").alias("feature")).agg(F.avg("qty").alias("perf_diff"))
    runs = interpret.importance_over_runs([interpret.normalise_importance(runs_frame(spark, sf, i)) for i in range(3)])
    out = interpret.importance_summary(interpret.normalise_importance(whole), runs)
    return out.select("feature", "importance", "Category", "importance_mean", "importance_sem")


@query(
    "importance_train_vs_test",
    f"""SELECT fold, feature, 100 * d / sum(d) OVER (PARTITION BY fold) AS importance_sumnormed
    FROM (SELECT fold, flag AS feature, avg(qty) AS d FROM ({ORDER_SQL}) AS o GROUP BY 1, 2) AS g""",
    num="importance_sumnormed",
)
def _(spark, sf):
    def one(fold):
        rows = order_frame(spark, sf).filter(F.col("fold") == fold).groupBy(F.col("flag").alias("feature")).agg(F.avg("qty").alias("perf_diff"))
        return interpret.normalise_importance(rows)

    return interpret.train_versus_test(one("train"), one("test")).select("fold", "feature", "importance_sumnormed")


def dependence_sql(where: str = "TRUE") -> str:
    base = f"(SELECT * FROM ({ORDER_SQL}) AS o WHERE {where})"
    steps = "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]"
    return f"""SELECT 'qty' AS feature, CAST(v AS VARCHAR) AS value, 'target' AS target, avg(v / 400 + lines / 40) AS yhat_mean, 'metr' AS type
    FROM {base} AS b, (SELECT DISTINCT unnest(quantile_cont(qty, {steps})) AS v FROM ({ORDER_SQL}) AS q) AS g GROUP BY v
    UNION ALL SELECT 'flag', v, 'target', avg(qty / 400 + lines / 40), 'cate' FROM {base} AS b, (SELECT DISTINCT flag AS v FROM ({ORDER_SQL}) AS q) AS g GROUP BY v"""


@query("partial_dependence", dependence_sql(), num="yhat_mean")
def _(spark, sf):
    return interpret.partial_dependence(order_frame(spark, sf), linear_scorer, ["qty"], ["flag"])


@query(
    "partial_dependence_band",
    f"""SELECT p.feature, p.value, p.yhat_mean, m AS yhat_mean_mean, s AS yhat_mean_std, p.yhat_mean - s AS lower, p.yhat_mean + s AS upper FROM ({dependence_sql()}) AS p
    JOIN (SELECT feature, value, avg(yhat_mean) AS m, stddev_samp(yhat_mean) AS s FROM ({' UNION ALL '.join(f'({dependence_sql(f"id % 3 = {i}")})' for i in range(3))}) AS u GROUP BY 1, 2) AS r
    ON r.feature = p.feature AND r.value = p.value""",
    num="yhat_mean yhat_mean_mean yhat_mean_std lower upper",
    digits=8,
)
def _(spark, sf):
    df = order_frame(spark, sf)
    whole = interpret.partial_dependence(df, linear_scorer, ["qty"], ["flag"])
    runs = [interpret.partial_dependence(df.filter(F.col("id") % 3 == i), linear_scorer, ["qty"], ["flag"], df_ref=df) for i in range(3)]
    out = interpret.dependence_band(whole, interpret.importance_over_runs(runs))
    return out.select("feature", "value", "yhat_mean", "yhat_mean_mean", "yhat_mean_std", "lower", "upper")


@query(
    "partial_dependence_background",
    f"""SELECT flag AS level, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct, 0.9 * count(*) / max(count(*)) OVER () AS w,
    (SELECT avg(target) FROM ({ORDER_SQL}) AS a) AS prior FROM ({ORDER_SQL}) AS o GROUP BY flag""",
    num="pct w prior",
)
def _(spark, sf):
    return interpret.dependence_background(order_frame(spark, sf), "flag")


@query("partial_dependence_trees")
def _(spark, sf):
    df = orders(spark, sf)
    fitted = fit_model(TREES, df, DesignMatrix(METR, CATE).fit(df), "target3", "MULTICLASS", 3)
    return interpret.fitted_dependence(df, fitted, ["qty"], ["flag"], labels=["low", "mid", "high"])


def dependence_gap(fitted, df, metr, cate, labels=()):
    """Grid cells, and those where reading the trees once and scoring a copy per grid value agree."""
    read = interpret.fitted_dependence(df, fitted, metr, cate, labels=labels)
    copied = interpret.partial_dependence(df, fitted.score, metr, cate, target_type=fitted.target_type, labels=labels)
    both = read.join(copied.withColumnRenamed("yhat_mean", "_copied"), ["feature", "value", "target", "type"], "full")
    close = F.abs(F.col("yhat_mean") - F.col("_copied")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("_copied"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(close).alias("n_close"))


# the grid of a metric feature has its distinct deciles, that of a categorical one its levels
CELLS_SQL = f"""(SELECT count(*) FROM (SELECT DISTINCT unnest(quantile_cont(qty, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) FROM ({ORDER_SQL}) AS q) AS d)
    + (SELECT count(DISTINCT flag) FROM ({ORDER_SQL}) AS f)"""


@query("partial_dependence_forest", f"SELECT 3 * ({CELLS_SQL}) AS n, 3 * ({CELLS_SQL}) AS n_close")
def _(spark, sf):
    df = orders(spark, sf)
    fitted = fit_model(FOREST, df, DesignMatrix(METR, CATE).fit(df), "target3", "MULTICLASS", 3)
    return dependence_gap(fitted, df, ["qty"], ["flag"], ["low", "mid", "high"])


# --- explanations --------------------------------------------------------------------------------------------

COEFS = {"qty": 0.04, "lines": -0.3, "discount": 6.0}
COEFS3 = {"qty": [-0.03, 0.0, 0.03], "lines": [0.2, -0.1, 0.1], "discount": [1.0, -4.0, 2.0]}


def linear_shap_rows(spark, sf, target_type, b_sample=None, b_all=None, keep=None):
    df, keep = order_frame(spark, sf), keep or {}
    means = df.agg(*[F.avg(c).alias(c) for c in COEFS]).first().asDict()
    three = target_type == "MULTICLASS"
    parts, intercepts = shap.linear_contributions(COEFS3 if three else COEFS, means, [0.3, 0.1, -0.2] if three else [-1.5])
    rows = df.select("id", F.col("target3" if three else "target").alias("target"), *COEFS, *keep.values()).withColumn("contributions", parts)
    return shap.explained(rows, "contributions", intercepts, target_type=target_type, b_sample=b_sample, b_all=b_all, keep=list(keep))


def linear_shap_frame(spark, sf, target_type, b_sample=None, b_all=None):
    return shap.long_frame(linear_shap_rows(spark, sf, target_type, b_sample, b_all))


def shap_sql(coefs: dict, intercept: float, y: str, extra: str = "") -> str:
    """Ordered contributions with their running sum for one margin."""
    base = f"{intercept} + " + " + ".join(f"({b}) * m_{v}" for v, b in coefs.items())
    rows = [f"SELECT id, {y} AS y, 'intercept' AS variable, NULL AS variable_value, {base} AS shap_value, 1 AS flag_intercept FROM b"]
    rows += [
        f"SELECT id, {y}, '{v}', CAST({v} AS VARCHAR), ({b}) * ({v} - m_{v}), 0 FROM b" for v, b in coefs.items()
    ]
    means = ", ".join(f"avg({v}) OVER () AS m_{v}" for v in coefs)
    order = "PARTITION BY id ORDER BY flag_intercept DESC, abs(shap_value) DESC, variable"
    return f"""(WITH b AS (SELECT *, {means} FROM ({ORDER_SQL}) AS o) SELECT *, abs(shap_value) AS abs_shap_value,
    sum(shap_value) OVER ({order} ROWS UNBOUNDED PRECEDING) AS shap_value_cum, CAST(row_number() OVER ({order}) AS INTEGER) AS rank
    FROM ({' UNION ALL '.join(rows)}) AS u)"""


SHAP_NUM = "shap_value abs_shap_value shap_value_cum yhat"
SHAP_CLASS_SQL = f"""SELECT id, variable, shap_value, variable_value, flag_intercept, abs_shap_value, shap_value_cum, rank, y,
  p * 0.3 / 0.5 / (p * 0.3 / 0.5 + (1 - p) * 0.7 / 0.5) AS yhat FROM (SELECT *, 1 / (1 + exp(-shap_value_cum)) AS p FROM {shap_sql(COEFS, -1.5, 'target')} AS s) AS t"""


@query("shap_linear_class", SHAP_CLASS_SQL, num=SHAP_NUM)
def _(spark, sf):
    return linear_shap_frame(spark, sf, "CLASS", [0.5, 0.5], [0.7, 0.3])


@query("shap_linear_regression", f"SELECT *, shap_value_cum AS yhat FROM {shap_sql(COEFS, -1.5, 'target')} AS s", num=SHAP_NUM)
def _(spark, sf):
    return linear_shap_frame(spark, sf, "REGR")


def shap3_sql() -> str:
    """Running softmax: the sums of the other classes follow the order of the class that is explained."""
    intercepts = [0.3, 0.1, -0.2]
    parts = []
    for k in range(3):
        order = "PARTITION BY s.id ORDER BY s.rank ROWS UNBOUNDED PRECEDING"
        joins, sums = "", []
        for j in range(3):
            if j != k:
                joins += f" JOIN {shap_sql({v: c[j] for v, c in COEFS3.items()}, intercepts[j], 'target3')} AS s{j} ON s{j}.id = s.id AND s{j}.variable = s.variable"
            sums.append(f"sum({'s' if j == k else f's{j}'}.shap_value) OVER ({order})")
        exps = " + ".join(f"exp({x})" for x in sums)
        parts.append(
            f"""SELECT s.id, s.variable, s.shap_value, s.variable_value, CAST({k} AS INTEGER) AS target, s.flag_intercept, s.abs_shap_value, s.shap_value_cum, s.rank, s.y,
            exp({sums[k]}) / ({exps}) AS yhat FROM {shap_sql({v: c[k] for v, c in COEFS3.items()}, intercepts[k], 'target3')} AS s{joins}"""
        )
    return " UNION ALL ".join(parts)


@query("shap_linear_multiclass", shap3_sql(), num=SHAP_NUM)
def _(spark, sf):
    return linear_shap_frame(spark, sf, "MULTICLASS")


@query("shap_true_class", f"SELECT id, variable, rank, yhat FROM ({shap3_sql()}) AS s WHERE target = y", num="yhat")
def _(spark, sf):
    return shap.true_class_only(linear_shap_frame(spark, sf, "MULTICLASS")).select("id", "variable", "rank", "yhat")


@query(
    "shap_check",
    f"SELECT count(*) AS n, count(*) AS n_close FROM ({ORDER_SQL}) AS o",
)
def _(spark, sf):
    margin = F.lit(-1.5) + sum(F.lit(b) * F.col(v) for v, b in COEFS.items())
    return shap.check_rows(linear_shap_rows(spark, sf, "REGR", keep={"yhat": margin.alias("yhat")}), target_type="REGR")


def waterfall_sql(topn: int) -> str:
    bars = f"""SELECT id, rank, yhat, lag(yhat, 1, 0) OVER (PARTITION BY id ORDER BY rank) AS off,
    CASE variable WHEN 'intercept' THEN 'intercept' ELSE variable || ' = ' || variable_value END AS label
    FROM (SELECT *, shap_value_cum AS yhat FROM {shap_sql(COEFS, -1.5, 'target')} AS s) AS t"""
    return f"""SELECT id, position, bar_label, bar, off AS "offset", CASE WHEN bar_label IN ('intercept') THEN 'intercept' WHEN bar > 0 THEN 'positive' ELSE 'negative' END AS sign FROM (
    SELECT id, least(rank, {topn + 2}) AS position, CASE WHEN rank > {topn + 1} THEN '... the rest' ELSE label END AS bar_label, sum(yhat - off) AS bar, arg_min(off, rank) AS off
    FROM ({bars}) AS b GROUP BY ALL) AS g
    UNION ALL SELECT id, max(rank) + 1, 'Prediction', arg_max(yhat, rank), 0, 'prediction' FROM ({bars}) AS b GROUP BY id"""


@query("shap_waterfall", waterfall_sql(1), num="bar offset")
def _(spark, sf):
    return shap.waterfall(linear_shap_rows(spark, sf, "REGR"), topn=1)


@query("shap_trees")
def _(spark, sf):
    df = order_frame(spark, sf)
    train, test = df.filter("fold = 'train'"), df.filter("fold = 'test'")
    sampled = Undersample(3000).fit(train)
    fitted = fit_model(TREES, sampled.sample(train), DesignMatrix(METR, CATE).fit(df))
    scored = with_residuals(fitted.score(test, sampled.b_sample, sampled.b_all))
    return shap.explain_trees(fitted, scored, b_sample=sampled.b_sample, b_all=sampled.b_all)


def explained_test_rows(spark, sf, spec, target, target_type, n_classes=2):
    """Explanations of all test rows by a model of the train rows, with the model's own scores."""
    df = orders(spark, sf).withColumn("target", F.col(target))
    train, test = df.filter("fold = 'train'"), df.filter("fold = 'test'")
    fitted = fit_model(spec, train, DesignMatrix(METR, CATE).fit(df), "target", target_type, n_classes)
    return shap.explain_rows(fitted, fitted.score(test), df_ref=train, keep=["yhat"])


EXPLAINED = {
    "forest_class": (FOREST, "target", "CLASS", 2),
    "forest_multiclass": (FOREST, "target3", "MULTICLASS", 3),
    "forest_regression": (FOREST, "y", "REGR", 2),
    "linear_class": (ModelSpec("elastic_net", {"alpha": 0.01}), "target", "CLASS", 2),
    "linear_multiclass": (ModelSpec("l1_logistic", {"C": 0.25}), "target3", "MULTICLASS", 3),
    "linear_regression": (ModelSpec("elastic_net", {"alpha": 1.0}), "y", "REGR", 2),
    "booster_class": (TREES, "target", "CLASS", 2),
    "booster_multiclass": (TREES, "target3", "MULTICLASS", 3),
    "booster_regression": (TREES, "y", "REGR", 2),
}
for _name, (_spec, _target, _type, _n) in EXPLAINED.items():
    # every test row and class: the contributions add up to the prediction

    @query(
        f"explained_{_name}",
        f"SELECT {_n if _type == 'MULTICLASS' else 1} * count(*) AS n, {_n if _type == 'MULTICLASS' else 1} * count(*) AS n_close FROM ({ORDER_SQL}) AS o WHERE fold = 'test'",
    )
    def _(spark, sf, spec=_spec, target=_target, target_type=_type, n=_n):
        return shap.check_rows(explained_test_rows(spark, sf, spec, target, target_type, n), "yhat", target_type)


@query("shap_forest")
def _(spark, sf):
    return shap.long_frame(explained_test_rows(spark, sf, FOREST, "target3", "MULTICLASS", 3))


@query("shap_fitted_linear")
def _(spark, sf):
    return shap.long_frame(explained_test_rows(spark, sf, ModelSpec("elastic_net", {"alpha": 0.01}), "target", "CLASS"))


@query("coefficient_stability")
def _(spark, sf):
    betas = stability.coefficient_stability(
        order_frame(spark, sf), ModelSpec("elastic_net", {"alpha": 100.0, "l1_ratio": 1.0}), ["qty", "lines", "tax"], ["flag"], target="y", k=2, n_rep=2
    )
    return selection_counts(stability.kept_coefficients(betas))[0]


@query("importance_stability")
def _(spark, sf):
    _, importance = stability.importance_stability(
        order_frame(spark, sf), ModelSpec("elastic_net", {"alpha": 0.01}), ["qty", "lines", "tax"], [], k=2, n_rep=1
    )
    return importance.select("feature", "rep", "fold", "type")
