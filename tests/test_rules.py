"""Hand-worked results on tiny frames: null rules, ties and the decided semantics."""

import math

import pytest
from pyspark.sql import functions as F

from tabwright.functions import predictions as P
from tabwright.functions import quantiles, ranks, scalars
from tabwright.functions.lookup import attach
from tabwright.functions import lookup
from tabwright.operators import assoc, encode, metrics, prepare, profile, sample, split
from tabwright.operators.features import feature_sets
from tabwright.operators.importance import univariate_importance
from tabwright.operators.interpret import normalise_importance, top_features
from tabwright.plans.explore import map_income_target, passenger_features
from tabwright.schema import Metadata, setdiff, union_names


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def values(df, column, key="id"):
    return [r[0] for r in df.orderBy(key).select(column).collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --- bins and quantiles ----------------------------------------------------------------------------------


def test_bins_are_right_closed_and_include_the_lowest(spark):
    df = frame(spark, [(i, float(i)) for i in range(11)] + [(99, None)], "id int, x double")
    assert values(prepare.char_bins(df, "x", 2), "x_BINNED") == ["q01"] * 6 + ["q02"] * 5 + [None]


def test_equal_edges_are_merged_and_renumbered(spark):
    df = frame(spark, [(i, 0.0) for i in range(8)] + [(8, 1.0), (9, 2.0)], "id int, x double")
    # quartiles of eight zeros, 1 and 2 are 0, 0, 0, 0 and 2: one bin is left
    assert values(prepare.char_bins(df, "x", 4), "x_BINNED") == ["q01"] * 10
    # deciles: 0 (eight times), 0.2, 1.1 and 2
    assert values(prepare.char_bins(df, "x", 10), "x_BINNED") == ["q01"] * 8 + ["q02", "q03"]


def test_constant_column_has_no_bin(spark):
    df = frame(spark, [(i, 5.0) for i in range(4)], "id int, x double")
    model = prepare.Binning(["x"], missing="(Missing)").fit(df)
    assert values(model.transform(df), "x_BINNED") == ["(Missing)"] * 4
    assert model.single_bin_columns() == ["x_BINNED"]


def test_stored_edges_take_values_outside_the_fit(spark):
    df = frame(spark, [(i, float(i)) for i in range(10)], "id int, x double")
    new = frame(spark, [(0, -5.0), (1, 50.0), (2, None)], "id int, x double")
    assert values(prepare.Binning(["x"], 2).fit(df).transform(new), "x_BINNED") == ["q01", "q02", None]


def test_quantiles_skip_nulls_and_interpolate(spark):
    df = frame(spark, [(1.0,), (2.0,), (None,), (4.0,)], "x double")
    assert quantiles.fit_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0])["x"] == [1.0, 1.5, 2.0, 4.0]


def test_quantiles_equal_the_built_in_ones(spark, monkeypatch):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 5003).cast("double")).alias("x"),
        F.when(F.col("id") % 11 != 0, F.sqrt("id")).alias("y"),
        F.when(F.col("id") % 3 == 1, F.exp(F.col("id") / 500) * F.when(F.col("id") % 2 == 0, -1).otherwise(1)).alias("z"),
    )
    probs = [0.0, 0.02, 0.1, 0.5, 0.77, 0.98, 1.0]
    grid = F.array(*[F.lit(p) for p in probs])
    for by in ([], ["g"]):
        want = {(r["g"] if by else None, c): r[c] for r in df.groupBy(*by).agg(*[F.percentile(c, grid).alias(c) for c in "xyz"]).collect() for c in "xyz"}
        for bins in (4096, 16):  # a few passes, and many
            monkeypatch.setattr(quantiles, "BINS", bins)
            got = {(r["g"] if by else None, r["variable"]): r["quantiles"] for r in quantiles.quantile_frame(df, ["x", "y", "z"], probs, by).collect()}
            assert got.keys() == want.keys()
            assert all((got[k] is None and w is None) or got[k] == pytest.approx(w, rel=1e-13) for k, w in want.items())


def test_quantiles_of_extreme_values(spark):
    inf = float("inf")
    x = [inf, -inf, 1.7e308, -1.7e308, 5e-324, 0.0, 1e-9, 3.0, float("nan")]
    df = spark.createDataFrame([(v, "a") for v in x] + [(None, "b")], "x double, g string")
    got = quantiles.fit_quantiles(df, ["x"], [i / 8 for i in range(9)])["x"]
    assert got[:8] == [-inf, -1.7e308, 0.0, 5e-324, 1e-9, 3.0, 1.7e308, inf] and got[8] != got[8]
    rows = {r["g"]: r["quantiles"] for r in quantiles.quantile_frame(df, ["x"], [0.125, 0.25], ["g"]).collect()}
    assert rows == {"a": [-1.7e308, 0.0], "b": None}
    assert quantiles.fit_quantiles(df.limit(0), ["x"], [0.5]) == {"x": [None]}


# --- scalars -----------------------------------------------------------------------------------------------


def test_text_nan_and_float_nan_become_null(spark):
    df = frame(spark, [(1, "nan", float("nan")), (2, "a", 1.5)], "id int, s string, x double")
    out = scalars.convert(scalars.convert(df, ["s"], "str"), ["x"], "float")
    assert values(out, "s") == [None, "a"] and values(out, "x") == [None, 1.5]


def test_zero_pad_keeps_long_texts(spark):
    df = frame(spark, [(1, "7"), (2, "12"), (3, "123"), (4, None)], "id int, s string")
    assert values(df.select("id", scalars.zero_pad("s").alias("s")), "s") == ["07", "12", "123", None]


def test_winsorize_keeps_missing(spark):
    df = frame(spark, [(i, float(i)) for i in range(101)] + [(200, None)], "id int, x double")
    out = values(prepare.Winsorize(["x"], lower_quantile=0.02, upper_quantile=0.98).fit(df).transform(df), "x")
    assert out[0] == 2.0 and out[100] == 98.0 and out[101] is None


def test_shifted_log_moves_negative_minimum_to_one(spark):
    df = frame(spark, [(1, -3.0), (2, 0.0), (3, None)], "id int, x double")
    out = values(scalars.shifted_log(df, ["x"]), "x_LOG_")
    assert out[0] == 0.0 and out[1] == pytest.approx(math.log(4)) and out[2] is None


def test_fixed_cut_is_right_closed(spark):
    df = frame(spark, [(1, 10.0), (2, 10.1), (3, 50.0), (4, 51.0), (5, None)], "id int, x double")
    assert values(df.select("id", scalars.fixed_cut("x").alias("c")), "c") == ["low", "medium", "medium", "high", None]


def test_name_lists():
    assert setdiff(["b", "a", "c"], ["a"]) == ["b", "c"]
    assert union_names(["a", "b"], ["b", "c"]) == ["a", "b", "c"]


def test_metadata_roles(spark):
    meta = frame(spark, [("a", "orig", "ready", "metr"), ("b", "orig", "derive", "ordi"), ("c", "orig", "drop", "nomi")], "variable string, category string, status string, type string")
    assert Metadata.from_frame(meta) == Metadata(["a"], ["b"])


def test_census_target_keeps_the_leading_blank(spark):
    df = frame(spark, [(1, " - 50000."), (2, " 50000+."), (3, "50000+.")], "id int, income string")
    assert values(map_income_target(df), "target") == [0, 1, None]


def test_two_fares_per_head(spark):
    df = frame(spark, [(1, "C1", 1, 0, "t", 10.0), (2, "C2", 0, 0, "t", 30.0), (3, None, 0, 2, None, 5.0)], "id int, cabin string, sibsp int, parch int, ticket string, fare double")
    out = passenger_features(df)
    assert values(out, "fare_pp") == [5.0, 15.0, None]
    assert values(out, "deck") == ["C", "C", None] and values(out, "familysize") == [2, 1, 3]
    assert values(profile.group_transform(df, "ticket", "fare", "mean", "m"), "m") == [20.0, 20.0, None]


# --- encoders ----------------------------------------------------------------------------------------------


def test_lumping_sends_missing_to_other(spark):
    df = frame(spark, list(enumerate(["a", "a", "b", "b", "c", None])), "id int, x string")
    assert values(encode.LumpLevels(["x"], n_top=2).fit(df).transform(df), "x") == ["a", "a", "b", "b", "_OTHER_", "_OTHER_"]


def test_few_levels_are_not_lumped(spark):
    df = frame(spark, list(enumerate(["a", "b", None])), "id int, x string")
    assert values(encode.LumpLevels(["x"], n_top=3).fit(df).transform(df), "x") == ["a", "b", None]


def test_target_encoding_ranks_by_falling_mean_and_fills_the_median(spark):
    data = [(1, "a", 1, 0), (2, "b", 1, 1), (3, "c", 1, 1), (4, "z", 0, 1), (5, None, 0, 0)]
    df = frame(spark, data, "id int, x string, encode_flag int, target int")
    model = encode.TargetEncoding(["x"]).fit(df)
    assert values(model.transform(df), "x_ENCODED") == [3.0, 1.0, 2.0, 2.0, 2.0]
    burned = encode.TargetEncoding(["x"], remove_burned=True).fit(df).transform(df)
    assert values(burned, "id") == [4, 5]


def test_majority_label_is_the_multiclass_indicator(spark):
    data = [(1, "a", 1, "u"), (2, "a", 1, "v"), (3, "b", 1, "v"), (4, "b", 1, "v"), (5, "a", 1, "w")]
    df = frame(spark, data, "id int, x string, encode_flag int, target string")
    assert values(encode.TargetEncoding(["x"]).fit(df).transform(df), "x_ENCODED") == [2.0, 2.0, 1.0, 1.0, 2.0]


def test_unseen_levels_become_the_mode(spark):
    train = frame(spark, list(enumerate(["a", "a", "b"])), "id int, x string")
    new = frame(spark, list(enumerate(["b", "z", None])), "id int, x string")
    model = encode.MapUnseen(["x"]).fit(train)
    assert values(model.transform(train), "x") == ["a", "a", "b"]
    assert values(model.transform(new), "x") == ["b", "a", "a"]


def test_design_matrix_rejects_unseen_levels(spark):
    df = frame(spark, [(1, 2.0, "a", "k"), (2, 3.0, "b", "k")], "id int, m double, c string, one string")
    model = encode.DesignMatrix(["m"], ["c", "one"]).fit(df)
    assert model.positions() == [(0, "m", None), (1, "c", "a"), (2, "c", "b"), (3, "one", "k")]
    assert [r[0].toArray().tolist() for r in model.transform(df).orderBy("id").select("features").collect()] == [[2, 1, 0, 1], [3, 0, 1, 1]]
    for bad in [(3, 1.0, "z", "k"), (3, 1.0, "a", "y")]:
        with pytest.raises(Exception):
            model.transform(frame(spark, [bad], "id int, m double, c string, one string")).collect()


def test_feature_sets_order():
    s = feature_sets(["m1", "m2"], ["c1", "c2"], ["c2"], ["m1"], ["m2_BINNED"])
    assert s.metr_standard == ["m1", "m2", "c2_ENCODED"] and s.cate_standard == ["c1", "c2", "MISS_m1"]
    assert s.cate_binned == ["m1_BINNED", "c1", "c2"]
    assert s.metr_encoded == ["m1", "m2", "c1_ENCODED", "c2_ENCODED", "MISS_m1_ENCODED"]


# --- joins -------------------------------------------------------------------------------------------------


def test_lookup_gives_the_same_rows_by_every_plan(spark, monkeypatch):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 9, F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), "id")
    table = df.filter("k IS NOT NULL AND k <> 7").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
    for how in ("left", "inner"):
        small = rows(attach(df, table, ["k"], how), F.coalesce("k", F.lit(-1)), "id", F.coalesce("s", F.lit(-1)))
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
        assert rows(attach(df, table, ["k"], how), F.coalesce("k", F.lit(-1)), "id", F.coalesce("s", F.lit(-1))) == small
        monkeypatch.undo()


def test_heavy_keys_spread_over_tasks(spark, monkeypatch):
    """Half of the rows have one key and a fifth none: no task joins more than a part of them."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 != 1, F.col("id")).alias("k"), "id")
    assert lookup.heavy_keys(df, F.xxhash64("k"), 8) != []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach(df, df.filter("k IS NOT NULL").select("k").distinct().withColumn("v", F.col("k") + 1), ["k"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.filter("v = k + 1").count() == df.filter("k IS NOT NULL").count() and joined.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 5_000


# --- statistics --------------------------------------------------------------------------------------------


def test_chi_square_correction_is_capped(spark):
    even = frame(spark, [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")], "p string, q string")
    assert assoc.chi_square(even, ["p", "q"]).first()["chi2"] == pytest.approx(0.0, abs=1e-9)
    data = [("a", "x")] * 8 + [("a", "y")] * 2 + [("b", "x")] * 3 + [("b", "y")] * 7
    got = assoc.chi_square(frame(spark, data, "p string, q string"), ["p", "q"]).first()
    assert got["chi2"] == pytest.approx(4 * (2.5 - 0.5) ** 2 / 1 * (1 / 5.5 + 1 / 4.5) / 2)


def test_mixed_scales_are_an_error(spark):
    with pytest.raises(ValueError):
        assoc.association_matrix(frame(spark, [("a", 1.0)], "s string, x double"), ["s", "x"])


def test_categorical_importance_of_a_perfect_feature(spark):
    df = frame(spark, [("a", 1)] * 5 + [("b", 0)] * 5, "x string, target int")
    assert univariate_importance(df, ["x"]).first()["importance"] == 1.0


def test_priors_are_keyed_by_class(spark):
    df = frame(spark, [(i, int(i >= 3)) for i in range(10)], "id int, target int")
    model = sample.Undersample(4).fit(df)
    assert model.b_all == [0.3, 0.7] and model.b_sample == [3 / 7, 4 / 7]
    assert model.sample(df).groupBy("target").count().orderBy("target").collect()[1]["count"] == 4
    assert model.transform(df).count() == 10


def test_importance_normalisation_and_cut(spark):
    d = frame(spark, [("a", 0.3), ("b", 0.1), ("c", -0.2)], "feature string, perf_diff double")
    out = {r["feature"]: r for r in normalise_importance(d).collect()}
    assert out["a"]["importance"] == 100.0 and out["b"]["importance_sumnormed"] == pytest.approx(25.0)
    assert out["c"]["perf_diff"] == 0.0 and out["c"]["importance_cum"] == pytest.approx(100.0)
    assert top_features(normalise_importance(d), 80.0) == ["a"] and top_features(normalise_importance(d), 10.0) == ["a"]


def test_top_classes_and_argmax_break_ties_by_class(spark):
    df = frame(spark, [(1, [0.4, 0.4, 0.2]), (2, [0.1, 0.2, 0.7])], "id int, yhat array<double>")
    assert values(df.select("id", P.argmax("yhat").alias("a")), "a") == [0, 2]
    assert values(df.select("id", P.top_classes("yhat", 2).alias("t")), "t") == [[0, 1], [2, 1]]


def test_metric_directions():
    assert metrics.METRICS["auc"].greater_is_better and not metrics.METRICS["rmse"].greater_is_better


def test_chunk_sizes_follow_the_first_longer_rule(spark):
    chunks = lambda n, k: spark.range(1).select(F.array(*split.chunk_counts(F.lit(n), k))).first()[0]
    assert chunks(11, 3) == [4, 8] and chunks(2, 4) == [1, 2, 2]


def test_ranks_take_more_tasks_for_more_rows(spark, monkeypatch):
    """Rows of a task are bounded whatever the number of shuffle partitions, also where one value fills many ranges."""
    monkeypatch.setattr(ranks, "PART_ROWS", 1000)
    df = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.col("id") % 501).cast("double").alias("x"))
    out = ranks.with_centred_rank(df, "x")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 4000
    want = ranks.mean_rank(df, "x").select("x", F.col("centred").alias("_want"))
    assert out.join(want, "x").filter("_r <> _want").count() == 0
