"""Properties that hold for any data, and plan checks."""

from hashlib import md5

import pytest
from pyspark.sql import functions as F

from common import SF
from tabwright.catalog.frames import class_frame, order_frame, scored_frame
from tabwright.functions.predictions import scale_binary, scale_predictions
from tabwright.functions.ranks import cumulate, hash_cuts, ordered_index
from tabwright.operators import encode, interpret, metrics, models, prepare, sample, search, shap, split, trees
from tabwright.plans.explore import explore
from tabwright.plans.production import score_saved, train_and_save
from tabwright.sources.handoff import FeatureSets, load_stage, save_stage

METR, CATE = ["qty", "lines", "tax"], ["flag", "status"]
SPEC = models.ModelSpec("boosted_trees", {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 3, "seed": 1, "subsample": 0.8})


@pytest.fixture(scope="module")
def orders(spark):
    return order_frame(spark, SF).cache()


@pytest.fixture(scope="module")
def design(orders):
    return encode.DesignMatrix(METR, CATE).fit(orders)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- order and splits ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_results_do_not_depend_on_partitions(spark, partitions):
    df = scored_frame(spark, SF).repartition(partitions)
    assert metrics.auc(df).first()["auc"] == pytest.approx(metrics.auc(scored_frame(spark, SF)).first()["auc"], abs=1e-12)
    assert sorted(r["id"] for r in sample.sample_rows(df, "id", 100, 3).collect()) == sorted(
        r["id"] for r in sample.sample_rows(scored_frame(spark, SF), "id", 100, 3).collect()
    )


def test_ordered_index_is_a_permutation(spark):
    df = class_frame(spark, SF).select("id", "nation")
    got = ordered_index(df, [F.desc("id")], keys=["nation"])
    per = got.groupBy("nation").agg(F.count(F.lit(1)).alias("n"), F.max("idx").alias("m"), F.count_distinct("idx").alias("d"))
    assert per.filter("m <> n - 1 OR d <> n").isEmpty()


def test_hash_cuts_select_exact_counts(spark):
    df = spark.range(3000)
    wanted = [0, 1, 2, 1499, 2999, 3000, 5000]
    cuts = hash_cuts(df, "id", 5, lambda n: wanted)[None]
    from tabwright.functions.hashing import hash_hex

    got = df.select(*[F.count_if(hash_hex("id", 5) <= c).alias(str(i)) for i, c in enumerate(cuts)]).first()
    assert list(got) == [0, 1, 2, 1499, 2999, 3000, 3000]


def test_splits_are_disjoint_and_complete(orders):
    table = split.separate_split_table(orders, "id", 4).cache()
    test = table.filter("role = 'test'")
    assert test.count() == test.select("id").distinct().count() == orders.filter("fold = 'test'").count()
    for i in range(4):
        one = table.filter(F.col("split") == i)
        assert one.count() == one.select("id").distinct().count()
    mixed = table.join(orders.select("id", "fold"), "id").filter("role <> fold")
    assert mixed.isEmpty()


def test_bootstrap_draws_as_many_rows_as_the_fold_has(orders):
    got = split.bootstrap_table(orders, "id", 2).groupBy("split", "role").agg(F.sum("multiplicity").alias("n")).collect()
    sizes = {r["fold"]: r["count"] for r in orders.groupBy("fold").count().collect()}
    assert len(got) == 4 and all(r["n"] == sizes[r["role"]] for r in got)


def test_random_imputation_draws_existing_values(spark):
    df = class_frame(spark, SF).select("id", "price", "acctbal")
    out = sample.random_impute(df, ["price", "acctbal"], "id")
    assert out.filter("price IS NULL OR acctbal IS NULL").isEmpty() and out.count() == df.count()
    assert out.join(df.select("price").distinct(), "price", "left_anti").isEmpty()


# --- transformations ---------------------------------------------------------------------------------------


def test_bins_partition_the_rows(spark):
    df = class_frame(spark, SF)
    got = prepare.Binning(["price"]).fit(df).transform(df).groupBy("price_BINNED").agg(F.min("price").alias("lo"), F.max("price").alias("hi"), F.count("price").alias("n"))
    bins = sorted((r for r in got.collect() if r["price_BINNED"]), key=lambda r: r["price_BINNED"])
    assert len(bins) == 10 and all(a["hi"] < b["lo"] for a, b in zip(bins, bins[1:]))
    assert sum(r["n"] for r in bins) == df.filter("price IS NOT NULL").count()


def test_scaled_predictions_sum_to_one_and_keep_equal_priors(spark):
    df = spark.createDataFrame([([0.2, 0.3, 0.5],)], "yhat array<double>")
    got = df.select(scale_predictions("yhat", [0.5, 0.25, 0.25], [0.1, 0.3, 0.6])).first()[0]
    assert sum(got) == pytest.approx(1.0)
    assert df.select(scale_predictions("yhat", [0.2, 0.3, 0.5], [0.2, 0.3, 0.5])).first()[0] == pytest.approx([0.2, 0.3, 0.5])
    pair = df.select(scale_binary(F.lit(0.3), [0.5, 0.5], [0.9, 0.1]), scale_predictions(F.array(F.lit(0.7), F.lit(0.3)), [0.5, 0.5], [0.9, 0.1])[1]).first()
    assert pair[0] == pytest.approx(pair[1])


def test_auc_is_antisymmetric_and_rank_based(spark):
    df = scored_frame(spark, SF)
    a = metrics.auc(df).first()["auc"]
    assert metrics.auc(df.withColumn("p", -F.col("p"))).first()["auc"] == pytest.approx(1 - a)
    assert metrics.auc(df.withColumn("p", F.exp(F.col("p") * 3))).first()["auc"] == pytest.approx(a)


# --- models ------------------------------------------------------------------------------------------------


def test_last_stage_equals_the_model_score(orders, design):
    for target, kind, n in (("target", "CLASS", 2), ("target3", "MULTICLASS", 3), ("y", "REGR", 2)):
        fitted = models.fit_model(SPEC, orders, design, target, kind, n)
        whole = fitted.score(orders).select("id", "yhat")
        staged = trees.staged_scores(fitted, design.transform(orders).select("id", "features"), [2, 6])
        last = staged.filter("n_estimators = 6").select("id", F.col("yhat").alias("s"))
        gap = F.abs(F.col("yhat") - F.col("s")) / (1 + F.abs("yhat")) if kind == "REGR" else F.array_max(F.zip_with("yhat", "s", lambda a, b: F.abs(a - b)))
        assert whole.join(last, "id").agg(F.max(gap)).first()[0] < 1e-9
        assert staged.count() == 2 * orders.count()


def test_tree_contributions_add_up(orders, design):
    for target, kind, n in (("target", "CLASS", 2), ("target3", "MULTICLASS", 3), ("y", "REGR", 2)):
        df = orders.withColumn("t", F.col(target))
        fitted = models.fit_model(SPEC, df, design, "t", kind, n)
        priors = None if kind == "REGR" else [1 / n] * n
        other = None if kind == "REGR" else [0.5] + [0.5 / (n - 1)] * (n - 1)
        out = shap.explain_trees(fitted, df, target="t", b_sample=priors, b_all=other).cache()
        check = shap.check_shap(out, fitted.score(df, priors, other), target_type=kind).first()
        assert check["n"] == check["n_close"] == orders.count() * (n if kind == "MULTICLASS" else 1)
        if kind == "REGR":
            assert abs(out.filter("variable <> 'intercept'").agg(F.avg("shap_value")).first()[0]) < 2000


def test_tree_contributions_match_brute_force(spark):
    """Shapley values by enumerating all feature subsets, with the conditional expectation along the tree."""
    from itertools import combinations
    from math import factorial

    df = spark.range(400).select(
        "id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 3).cast("double").alias("c")
    ).withColumn("t", F.col("a") * F.col("b") + 10 * (F.col("c") > 1).cast("double"))
    names = ["a", "b", "c"]
    fitted = models.fit_model(models.ModelSpec("boosted_trees", {"n_estimators": 2, "max_depth": 3, "learning_rate": 0.5}), df, encode.DesignMatrix(names).fit(df), "t", "REGR")
    from tabwright.session import checkpoint_dir

    nodes = trees.node_table(fitted.models[0], checkpoint_dir(spark))
    by_tree = {}
    for n in nodes:
        by_tree.setdefault(n["treeID"], {})[n["id"]] = n

    def expected(tree, x, known, i=0):
        n = tree[i]
        if n["leftChild"] < 0:
            return n["prediction"]
        f, limit = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"][0]
        if f in known:
            return expected(tree, x, known, n["leftChild"] if x[f] <= limit else n["rightChild"])
        return sum(tree[c]["rawCount"] / n["rawCount"] * expected(tree, x, known, c) for c in (n["leftChild"], n["rightChild"]))

    parts, _ = trees.tree_contributions(fitted, df, "id")
    for r in df.join(parts, "id").filter("id IN (0, 17, 38, 399)").collect():
        x = [r[n] for n in names]
        got = {p["variable"]: p["shap"][0] for p in r["contributions"]}
        for i, name in enumerate(names):
            want, others = 0.0, [j for j in range(3) if j != i]
            for size in range(3):
                for s in combinations(others, size):
                    w = factorial(size) * factorial(2 - size) / factorial(3)
                    for t, tree in by_tree.items():
                        w_t = fitted.models[0].treeWeights[t]
                        want += w * w_t * (expected(tree, x, {*s, i}) - expected(tree, x, set(s)))
            assert got[name] == pytest.approx(want, abs=1e-9)


def test_unused_feature_has_no_importance_and_linear_dependence_is_linear(orders):
    def scorer(df):
        p = F.col("qty") / 400
        return df.withColumn("yhat", F.array(1 - p, p))

    got = {r["feature"]: r["perf_diff"] for r in interpret.permutation_importance(orders, scorer, ["qty", "tax"]).collect()}
    assert got["tax"] == 0.0 and got["qty"] > 0
    pd_ = interpret.partial_dependence(orders, scorer, ["qty"], []).collect()
    assert all(r["yhat_mean"] == pytest.approx(float(r["value"]) / 400) for r in pd_)


def test_donors_follow_a_random_order_of_their_own(spark):
    def order(seed):
        return sorted(range(300), key=lambda i: md5(f"{i}:{seed}".encode()).hexdigest())

    df = spark.range(300).select("id", (F.col("id") * 2).cast("double").alias("x"))
    got = {r["id"]: r["_donor_x"] for r in interpret.with_donor(df, "id", ["x"]).collect()}
    assert got == {i: 2.0 * donor for i, donor in zip(order("999"), order("999-donor"))}


def test_importance_is_the_drop_under_donors_of_an_order_of_their_own(spark):
    def order(seed):
        return sorted(range(40), key=lambda i: md5(f"{i}:{seed}".encode()).hexdigest())

    def auc(p):
        wins = [(p[i] > p[j]) + (p[i] == p[j]) / 2 for i in range(40) for j in range(40) if i >= 25 > j]
        return sum(wins) / len(wins)

    df = spark.range(40).select("id", (F.col("id") >= 25).cast("int").alias("target"), (F.col("id") % 32 / 40).alias("x"))
    got = interpret.permutation_importance(df, lambda d: d.withColumn("yhat", F.array(1 - F.col("x"), F.col("x"))), ["x"]).first()
    donor = dict(zip(order("999"), order("999-donor")))
    x = {i: i % 32 / 40 for i in range(40)}
    assert got["perf_diff"] == pytest.approx(max(auc(x) - auc({i: x[donor[i]] for i in x}), 0))


def test_batches_do_not_change_importance(orders):
    def scorer(df):
        p = F.col("qty") / 400 + F.col("lines") / 40
        return df.withColumn("yhat", F.array(1 - p, p))

    a = interpret.permutation_importance(orders, scorer, ["qty", "lines", "tax"]).orderBy("feature").collect()
    b = interpret.permutation_importance(orders, scorer, ["qty", "lines", "tax"], batch=1).orderBy("feature").collect()
    assert a == b


def test_search_prefers_low_rmse(spark):
    summary = spark.createDataFrame([(1, 5.0), (2, 3.0), (3, None)], "n int, mean_test_rmse double")
    assert search.best_params(summary, ["n"], "rmse") == {"n": 2}


def test_trained_stages_score_the_same_after_loading(spark, orders, tmp_path):
    df = orders.withColumn("encode_flag", (F.col("id") % 5 == 0).cast("int"))
    train_and_save(df.filter("fold = 'train'"), str(tmp_path), METR, CATE, SPEC, n_max_per_level=200)
    a = score_saved(df.filter("fold = 'test'"), str(tmp_path))
    assert a.count() == orders.filter("fold = 'test'").count()
    assert a.filter(F.abs(F.aggregate("yhat", F.lit(0.0), lambda s, p: s + p) - 1) > 1e-9).isEmpty()


def test_stage_round_trip(spark, orders, tmp_path):
    sets = FeatureSets(metr_standard=METR, target_labels=["0", "1"])
    save_stage(orders, sets, str(tmp_path / "s"))
    df, loaded = load_stage(spark, str(tmp_path / "s"))
    assert loaded == sets and df.count() == orders.count()


# --- plans ---------------------------------------------------------------------------------------------------


def test_random_selection_does_not_move_rows(spark):
    df = class_frame(spark, SF).select("id", "price")
    for out in (sample.assign_fold(df, "id", 1), sample.sample_rows(df, "id", 50, 1), split.k_fold(df, "id")):
        assert "RangePartitioning" not in plan(out) and "SinglePartition" not in plan(out) and "Window" not in plan(out)


def test_global_order_uses_no_single_task(spark):
    table = cumulate(scored_frame(spark, SF), "p", {"n": F.count(F.lit(1))}, ["target"])
    assert "SinglePartition" not in plan(table)


def test_only_needed_columns_are_read(spark):
    from tabwright.operators.profile import describe_numeric

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(describe_numeric(li, ["l_tax"]))
    assert "ReadSchema: struct<l_tax:double>" in text and "l_quantity" not in text


def counted_source(spark, n):
    """Rows with a counter of how often one was made."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    made = spark.range(n, numPartitions=2).mapInArrow(rows, "id long")
    x = (F.col("id") * 7919) % 101
    return seen, made.select(
        "id", x.cast("double").alias("qty"), (F.col("id") % 13).cast("double").alias("tax"), (F.col("id") % 3).cast("string").alias("flag"),
        F.when(x > 60, 1).otherwise(0).alias("target"), (F.col("id") % 3).cast("int").alias("target3"),
    )


@pytest.mark.parametrize("kind,target,target_type,n", [("boosted_trees", "target", "CLASS", 2), ("random_forest", "target3", "MULTICLASS", 3)])
def test_tree_learners_read_their_source_once(spark, kind, target, target_type, n):
    seen, df = counted_source(spark, 200)
    design = encode.DesignMatrix(["qty", "tax"]).fit(df)
    before = seen.value
    models.fit_model(models.ModelSpec(kind, {"n_estimators": 2, "max_depth": 2, "seed": 1}), df, design, target, target_type, n)
    assert seen.value - before == 200


def test_exploration_reads_its_source_once(spark):
    seen, df = counted_source(spark, 200)
    done = explore(df.drop("target3"), ["qty", "tax"], ["flag"])
    assert done.table.count() > 100 and seen.value == 200
