"""Rules at their edges: missing values, many groups, unknown parameters."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from common import SF
from tabwright.catalog import frames
from tabwright.functions.predictions import with_label_codes
from tabwright.functions.ranks import hash_cuts, with_centred_rank, with_cut_code
from tabwright.operators import assoc, encode
from tabwright.operators.encode import TargetEncoding
from tabwright.operators.importance import univariate_importance
from tabwright.operators.metrics import spear
from tabwright.operators.interpret import fitted_dependence
from tabwright.operators.models import ModelSpec, _estimator, fit_model
from tabwright.operators.profile import bottom_and_top
from tabwright.operators.sample import Undersample
from tabwright.plans.compare import tuning_table
from tabwright.sources.tables import read_table


def test_target_encoding_without_targets(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 9.0), ("c", 5.0), *[("d", None)] * 9]
    df = spark.createDataFrame(rows, "x string, target double").withColumn("encode_flag", F.lit(1))
    out = {r["x"]: r["x_ENCODED"] for r in TargetEncoding(["x"], target_type="REGR").fit(df).transform(df).collect()}
    assert out == {"b": 1.0, "c": 2.0, "a": 3.0, "d": 2.0}


def test_best_row_has_a_value(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 1), (4, 9)], "id int, v int")
    assert sorted(r["id"] for r in bottom_and_top(df, "v", "id", 1).collect()) == [3, 4]


def test_unknown_parameter():
    with pytest.raises(ValueError, match="reg_lambda"):
        _estimator(ModelSpec("boosted_trees", {"reg_lambda": 1}), "CLASS", "x", "y", 10, 2, 2)


def test_undersample_many_classes(spark):
    df = spark.range(0, 20_000).select(F.col("id"), (F.col("id") % 1000).alias("target"))
    out = Undersample(7, "target", "id", 1).fit(df).sample(df)
    assert out.count() == 7_000 and out.groupBy("target").count().filter("count != 7").count() == 0


def test_regression_uses_all_rows(spark):
    df = spark.range(0, 6_000).withColumn("fold", F.lit("train"))
    assert tuning_table(df, "REGR").count() == 6_000


def test_missing_texts(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\nNaN,NA\n x ,2.5\nNULL,nan\n")
    got = [tuple(r) for r in read_table(spark, str(path), "a string, b double").collect()]
    assert got == [(None, None), (" x ", 2.5), (None, None)]


def test_every_test_row_is_explained(spark):
    test = frames.order_frame(spark, SF).filter("fold = 'test'").select("id")
    explained = contract.queries()["shap_trees"](spark, SF).groupBy("id").count()
    assert explained.join(test, "id").count() == explained.count() == test.count()
    assert explained.select("count").distinct().count() == 1


# --- random cuts and ranks -------------------------------------------------------------------------------


def test_cuts_of_many_groups(spark):
    """10^5 classes are cut at once, with a table of cuts and no list on the driver."""
    df = spark.range(0, 400_000).select(F.col("id"), (F.col("id") % 100_000).alias("g"))
    out = with_cut_code(df, "id", 3, hash_cuts(df, "id", 3, lambda n: [1, n - 1], "g"), "code").groupBy("g", "code").count()
    got = {(r["code"], r["count"]): r["groups"] for r in out.groupBy("code", "count").agg(F.count(F.lit(1)).alias("groups")).collect()}
    assert got == {(0, 1): 100_000, (1, 2): 100_000, (2, 1): 100_000}


def test_cuts_with_null_group_and_skew(spark):
    df = spark.range(0, 5_000).select("id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") == 7, "small").otherwise("hot").alias("g"))
    out = with_cut_code(df, "id", 3, hash_cuts(df, "id", 3, lambda n: [F.floor(n / 2)], "g"), "code")
    got = {(r["g"], r["code"]): r["count"] for r in out.groupBy("g", "code").count().collect()}
    assert got == {(None, 0): 250, (None, 1): 250, ("hot", 0): 2249, ("hot", 1): 2250, ("small", 1): 1}
    assert hash_cuts(df.limit(0), "id", 3, lambda n: [1])[None] == []


def test_equal_keys_cannot_be_cut(spark):
    df = spark.range(0, 100).select((F.col("id") % 2).alias("id"))
    assert with_cut_code(df, "id", 1, hash_cuts(df, "id", 1, lambda n: [50]), "code").groupBy("code").count().count() == 2
    with pytest.raises(ValueError, match="unique"):
        hash_cuts(df, "id", 1, lambda n: [30])


def test_cuts_shuffle_counts_only(spark):
    """The rows that are shuffled hold digits and counts; the key goes no further than its hash."""
    df = frames.order_frame(spark, SF).select("id", "fold")
    marked = with_cut_code(df, "id", 3, hash_cuts(df, "id", 3, lambda n: [10]), "code")
    assert "_hash" not in marked._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]


@pytest.mark.parametrize("parts", [1, 6])
def test_ranks_of_hot_and_tied_values(spark, parts):
    rng = np.random.default_rng(parts)
    a = np.where(rng.random(6_000) < 0.4, 5.0, np.round(rng.normal(5, 3, 6_000), 2))
    pdf = pd.DataFrame({"k": rng.choice(["x", "y"], 6_000, p=[0.99, 0.01]), "a": a, "b": np.round(a + rng.normal(0, 4, 6_000), 1)})
    pdf.loc[::97, "b"] = None
    df = spark.createDataFrame(pdf).repartition(parts).withColumn("b", F.when(~F.isnan("b"), F.col("b")))
    ranked = with_centred_rank(df.select("k", "a"), "a", ["k"]).toPandas()
    want = pdf.groupby("k")["a"].rank() - (pdf.groupby("k")["a"].transform("size") + 1) / 2
    assert sorted(zip(ranked["k"], ranked["a"], ranked["_r"])) == sorted(zip(pdf["k"], pdf["a"], want))
    whole = pdf.dropna()
    for r in spear(df, "a", "b", ["k"]).collect():
        part = whole[whole["k"] == r["k"]]
        assert r["spear"] == pytest.approx(part["a"].rank().corr(part["b"].rank()), abs=1e-12)
    assert spear(df.filter("k = 'none'"), "a", "b").first()["spear"] is None


def test_importance_of_regression(spark):
    """Metric and categorical features, with and without missing values, against pandas."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"m": np.round(rng.normal(size=900), 1), "c": rng.choice(list("abcdef"), 900), "target": np.round(rng.normal(size=900), 1)})
    pdf["p"] = pdf["m"].where(rng.random(900) < 0.7)
    pdf["d"] = pdf["c"].where(rng.random(900) < 0.7)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "m double, c string, target double, p double, d string")
    got = {r["feature"]: r["importance"] for r in univariate_importance(df, ["m", "c", "p", "d"], "target", "REGR", digits=None).collect()}
    for f in ("m", "c", "p", "d"):
        part = pdf[pdf[f].notna()]
        score = part[f] if f in ("m", "p") else part.groupby(f)["target"].transform("mean")
        assert got[f] == pytest.approx(abs(score.rank().corr(part["target"].rank())), abs=1e-12)


def test_rank_matrix_of_many_columns(spark):
    """200 columns from one Gram matrix; columns with missing values pair by pair."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(120, 200)) + rng.normal(size=(120, 1)), 1)
    names = [f"x{i}" for i in range(200)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names))
    want = pd.DataFrame(x, columns=names).corr("spearman").abs().to_numpy()
    got = {(r["var1"], r["var2"]): r["value"] for r in assoc.metric_matrix(df, names).collect()}
    assert len(got) == 200 * 199
    assert all(got[names[i], names[j]] == pytest.approx(want[i, j], abs=1e-12) for i in range(0, 200, 7) for j in range(200) if i != j)
    few = names[:3] + ["gap"]
    mixed = df.select(*names[:3], F.when(F.col("x3") > 0, F.col("x3")).alias("gap"))
    own = mixed.toPandas().corr("spearman").abs()
    for r in assoc.metric_matrix(mixed, few).collect():
        assert r["value"] == pytest.approx(own.loc[r["var1"], r["var2"]], abs=1e-12)


# --- any number of levels --------------------------------------------------------------------------------


def test_design_matrix_of_two_million_levels(spark, tmp_path):
    df = spark.range(0, 2_000_000, numPartitions=8).select(
        F.col("id").cast("string").alias("c"), (F.col("id") % 3).cast("string").alias("d"), F.col("id").cast("double").alias("m")
    )
    model = encode.DesignMatrix(["m"], ["c", "d"]).fit(df)
    assert model.width == 2_000_004 and model.owner([0, 1, 2_000_000, 2_000_001]) == {0: "m", 1: "c", 2_000_000: "c", 2_000_001: "d"}
    few = df.filter("m IN (0, 7, 1999999)")
    got = {int(r["m"]): r["features"] for r in model.transform(few).collect()}
    ranks = {str(n): i for i, n in enumerate(sorted(map(str, range(2_000_000))))}
    for n, v in got.items():
        want = {0: float(n), 1 + ranks[str(n)]: 1.0, 2_000_001 + n % 3: 1.0}
        assert v.size == 2_000_004 and dict(zip(v.indices.tolist(), v.values.tolist())) == {k: x for k, x in want.items() if x}
    path = str(tmp_path / "design")
    model.write().save(path)
    again = encode.DesignMatrixModel.load(path)
    assert again.width == model.width and again.spans() == model.spans()
    assert sorted(map(tuple, again.long(few, "m").filter("m = 7").collect())) == [(7.0, 0, 7.0), (7.0, 1 + ranks["7"], 1.0), (7.0, 2_000_002, 1.0)]


def test_labels_without_a_cap(spark):
    df = spark.range(0, 30_000).select(F.when(F.col("id") > 0, F.col("id") * 2).alias("y"))
    got = with_label_codes(df, "y")
    assert got.filter("y IS NOT NULL AND code <> y / 2 - 1").isEmpty() and got.filter("y IS NULL AND code IS NULL").count() == 1


def test_importance_of_many_classes(spark):
    """A class for every third row; against a plain one-versus-rest AUC of the level shares."""
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"x": rng.choice(list("abcdefgh"), 600), "y": rng.integers(0, 200, 600)})
    got = univariate_importance(spark.createDataFrame(pdf), ["x"], "y", "MULTICLASS", digits=None).first()["importance"]
    aucs = []
    for k in pdf["y"].unique():
        p = pdf.groupby("x")["y"].transform(lambda v, k=k: (v == k).mean())
        r, pos = p.rank(), pdf["y"] == k
        aucs.append((r[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum()))
    assert got == pytest.approx(np.mean(aucs), abs=1e-9)


def test_dependence_on_twenty_thousand_categories(spark):
    df = spark.range(0, 20_000).select("id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"), (F.col("id") % 50).cast("double").alias("m"))
    few = df.withColumn("c", F.when(F.col("id") % 2 == 0, "even").otherwise("odd")).withColumn("t", F.col("m") + 10 * (F.col("id") % 2))
    fitted = fit_model(ModelSpec("random_forest", {"n_estimators": 3, "max_depth": 4, "seed": 1}), few, encode.DesignMatrix(["m"], ["c"]).fit(few), "t", "REGR")
    out = fitted_dependence(few, fitted, [], ["c"], df_ref=df.unionByName(few.select("id", "c", "m")))
    got = {r["value"]: r["yhat_mean"] for r in out.collect()}
    assert len(got) == 20_002 and len({v for k, v in got.items() if k not in ("even", "odd")}) == 1 and got["odd"] > got["even"] + 5
