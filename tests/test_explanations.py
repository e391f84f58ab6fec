"""Explanations and dependence of fitted models against brute force."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from common import SF
from tabwright.catalog.frames import order_frame
from tabwright.operators import encode, interpret, models, optimality, shap, trees
from tabwright.session import checkpoint_dir

METR, CATE = ["qty", "lines", "tax"], ["flag", "status"]
PROBLEMS = [("target", "CLASS", 2), ("target3", "MULTICLASS", 3), ("y", "REGR", 2)]
SPECS = {
    "forest": models.ModelSpec("random_forest", {"n_estimators": 4, "max_depth": 5, "max_features": 3, "seed": 3}),
    "booster": models.ModelSpec("boosted_trees", {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.4, "seed": 3}),
    "linear": models.ModelSpec("elastic_net", {"alpha": 0.001}),
}


@pytest.fixture(scope="module")
def orders(spark):
    return order_frame(spark, SF).cache()


@pytest.fixture(scope="module")
def fits(orders):
    design = encode.DesignMatrix(METR, CATE).fit(orders)
    return {(name, kind): models.fit_model(spec, orders, design, target, kind, n) for name, spec in SPECS.items() for target, kind, n in PROBLEMS}


@pytest.mark.parametrize("name", SPECS)
@pytest.mark.parametrize("target, kind, n", PROBLEMS)
def test_contributions_add_up(orders, fits, name, target, kind, n):
    df = orders.withColumn("t", F.col(target))
    priors = None if kind == "REGR" else [1 / n] * n
    other = None if kind == "REGR" else [0.5] + [0.5 / (n - 1)] * (n - 1)
    fitted = fits[name, kind]
    rows = shap.explain_rows(fitted, fitted.score(df, priors, other), target="t", b_sample=priors, b_all=other, keep=["yhat"])
    got = shap.check_rows(rows, "yhat", kind).first()
    assert got["n"] == got["n_close"] == orders.count() * (n if kind == "MULTICLASS" else 1)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]


def expected_leaf(tree, x, known, value, i=0):
    n = tree[i]
    if n["leftChild"] < 0:
        return value(n)
    f, rule = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"]
    if f in known:
        left = x[f] in rule if n["split"]["numCategories"] >= 0 else x[f] <= rule[0]
        return expected_leaf(tree, x, known, value, n["leftChild"] if left else n["rightChild"])
    return sum(tree[c]["rawCount"] / n["rawCount"] * expected_leaf(tree, x, known, value, c) for c in (n["leftChild"], n["rightChild"]))


def test_forest_contributions_match_brute_force(spark, orders, fits):
    """Shapley values of class shares by enumerating all feature subsets, categories included."""
    fitted = fits["forest", "MULTICLASS"]
    by_tree = {}
    for n in trees.node_table(fitted.models[0], checkpoint_dir(spark)):
        by_tree.setdefault(n["treeID"], {})[n["id"]] = n
    assert any(n["split"]["numCategories"] >= 0 for t in by_tree.values() for n in t.values() if n["leftChild"] >= 0)
    positions = fitted.design.positions()
    few = orders.orderBy("id").limit(3)
    parts = {r["id"]: r["contributions"] for r in trees.tree_contributions(fitted, few, "id")[0].collect()}

    def value(node):
        return np.array(node["impurityStats"]) / sum(node["impurityStats"]) / len(by_tree)

    for r in fitted.design.transform(few).collect():
        x, want = r["features"].toArray(), {v: np.zeros(3) for _, v, _ in positions}
        for i, variable, _ in positions:
            others = [j for j, *_ in positions if j != i]
            for tree in by_tree.values():
                used = {n["split"]["featureIndex"] for n in tree.values() if n["leftChild"] >= 0}
                if i not in used:
                    continue
                rest = [j for j in others if j in used]
                for size in range(len(rest) + 1):
                    for s in combinations(rest, size):
                        w = factorial(size) * factorial(len(rest) - size) / factorial(len(rest) + 1)
                        want[variable] += w * (expected_leaf(tree, x, {*s, i}, value) - expected_leaf(tree, x, set(s), value))
        for p in parts[r["id"]]:
            assert p["shap"] == pytest.approx(want[p["variable"]].tolist(), abs=1e-10)


def test_linear_contributions_are_products(orders, fits):
    fitted = fits["linear", "REGR"]
    parts, intercepts = shap.linear_model_contributions(fitted, orders, orders, ["id", *METR])
    beta = dict(models.coefficients(fitted))
    means = orders.agg(*[F.avg(c).alias(c) for c in METR]).first()
    for r in parts.orderBy("id").limit(5).collect():
        got = {p["variable"]: p["shap"][0] for p in r["contributions"]}
        for c in METR:
            assert got[c] == pytest.approx(beta[c] * (r[c] - means[c]), abs=1e-6)
    assert intercepts[0] == pytest.approx(fitted.score(orders).agg(F.avg("yhat")).first()[0], rel=1e-9)


@pytest.mark.parametrize("name", ["forest", "booster"])
@pytest.mark.parametrize("target, kind, n", PROBLEMS)
def test_dependence_equals_scored_copies(orders, fits, name, target, kind, n):
    labels, fitted = [f"c{i}" for i in range(n)], fits[name, kind]
    priors = None if kind == "REGR" else [1 / n] * n
    other = None if kind == "REGR" else [0.5] + [0.5 / (n - 1)] * (n - 1)
    read = interpret.fitted_dependence(orders, fitted, ["qty", "tax"], CATE, labels=labels, b_sample=priors, b_all=other)
    copied = interpret.partial_dependence(orders, lambda d: fitted.score(d, priors, other), ["qty", "tax"], CATE, target_type=kind, labels=labels)

    def table(df):
        return {(r["feature"], r["value"], r["target"], r["type"]): r["yhat_mean"] for r in df.collect()}

    a, b = table(read), table(copied)
    assert a.keys() == b.keys() and len(a) > 10
    assert all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)


def test_long_grid_shares_cells(orders, fits):
    """A grid of thousands of values costs no more than the splits of the trees; levels never seen are as good as any other."""
    fitted = fits["forest", "CLASS"]
    grid = {"qty": [i / 10 for i in range(5_000)], "flag": ["A", "N", "R", *[f"new{i}" for i in range(3_000)]]}
    out = {(r["feature"], r["value"]): r["yhat_mean"] for r in trees.tree_dependence(fitted, orders, grid).collect()}
    assert len(out) == 8_003
    assert len({v for (f, g), v in out.items() if g.startswith("new")}) == 1
    some = {"qty": [0.0, 33.3, 499.9], "flag": ["R"]}
    for (f, g), v in {(r["feature"], r["value"]): r["yhat_mean"] for r in trees.tree_dependence(fitted, orders, some).collect()}.items():
        assert out[f, g] == pytest.approx(v, rel=1e-12)


def test_single_leaf_trees(spark):
    """A target without variation gives trees of one leaf: no contribution, flat dependence."""
    df = spark.range(50).select("id", F.col("id").cast("double").alias("a"), F.lit(3.0).alias("t"))
    fitted = models.fit_model(SPECS["booster"], df, encode.DesignMatrix(["a"]).fit(df), "t", "REGR")
    rows = shap.explain_rows(fitted, fitted.score(df), target="t", keep=["yhat"])
    assert shap.check_rows(rows, "yhat", "REGR").first()["n_close"] == 50
    assert {r["yhat_mean"] for r in trees.tree_dependence(fitted, df, {"a": [1.0, 2.0]}).collect()} == {3.0}


def test_network_has_no_explanation(orders, fits):
    network = models.Fitted(fits["linear", "CLASS"].stages, "CLASS", "network")
    with pytest.raises(ValueError, match="network"):
        shap.explain_rows(network, orders)


def test_waterfall_closes(orders, fits):
    fitted = fits["forest", "CLASS"]
    rows = shap.explain_rows(fitted, fitted.score(orders), keep=["yhat"])
    for topn in (None, 0, 2, 50):
        bars = shap.waterfall(rows, topn).groupBy("id").agg(
            F.sum(F.when(F.col("sign") != "prediction", F.col("bar"))).alias("sum"), F.max(F.when(F.col("sign") == "prediction", F.col("bar"))).alias("p"), F.count(F.lit(1)).alias("n")
        )
        assert bars.filter("abs(sum - p) > 1e-9").isEmpty()
        assert bars.select("n").distinct().collect()[0][0] == 7 if topn in (None, 50) else topn + 3


def test_conditions_tell_a_wrong_fit(orders, fits):
    """The conditions hold for the penalty of the fit and fail for another one; leaves fit their own target only."""
    fitted = fits["linear", "CLASS"]
    assert optimality.linear_conditions(fitted, orders, 0.001).filter("violation > 1e-3").isEmpty()
    wrong = optimality.linear_conditions(fitted, orders, 0.02).filter("violation > 1e-3")
    assert wrong.count() >= 3
    booster = models.fit_model(SPECS["booster"], orders, fitted.design, "y", "REGR")
    leaves = optimality.first_tree_leaves(booster, orders, "y")
    assert leaves.filter("abs(mean - prediction) > 1e-6 OR n <> training_rows").isEmpty() and leaves.count() > 4
    assert not optimality.first_tree_leaves(booster, orders, "qty").filter("abs(mean - prediction) > 1e-6").isEmpty()
