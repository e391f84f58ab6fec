"""Additive explanations of single predictions: long frame, check and waterfall.

A row's explanation is built, ordered and summed up inside the row, as an array; frames are exploded last.
"""

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.predictions import inv_logit, scale_binary, scale_predictions
from tabwright.operators.models import Fitted, softmax
from tabwright.operators.trees import tree_contributions, tree_link
from tabwright.schema import CLASS, MULTICLASS, REGR

INTERCEPT = "intercept"
# How summed contributions become a prediction, by target type, unless the model says otherwise.
LINKS = {CLASS: "logit", MULTICLASS: "softmax", REGR: "identity"}


def linear_contributions(
    coefs: Mapping[str, float | Sequence[float]], means: Mapping[str, float], intercepts: Sequence[float]
) -> tuple[Column, list[float]]:
    """Contributions coef * (x - mean) of a linear model as a column expression, and the intercepts that complete them."""
    table = {v: [float(b) for b in (c if isinstance(c, (list, tuple)) else [c])] for v, c in coefs.items()}
    parts = [
        F.struct(F.lit(v).alias("variable"), F.array(*[F.lit(b) * (F.col(v) - F.lit(float(means[v]))) for b in bs]).alias("shap"))
        for v, bs in table.items()
    ]
    base = [float(i) + sum(bs[k] * float(means[v]) for v, bs in table.items()) for k, i in enumerate(intercepts)]
    return F.array(*parts), base


def linear_model_contributions(fitted: Fitted, df: DataFrame, df_ref: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, list[float]]:
    """The columns `keep` with the `contributions` of a fitted linear model, and its intercepts.

    A position adds its coefficient times (x - mean over `df_ref`); the positions of a variable are summed. Outputs
    are logits for class targets.
    """

    def ready(frame: DataFrame) -> DataFrame:
        return frame if fitted.features in frame.columns else fitted.design.transform(frame)

    model, regression = fitted.models[0], fitted.target_type == REGR
    betas = [model.coefficients.toArray()] if regression else list(model.coefficientMatrix.toArray())
    base = [float(model.intercept)] if regression else [float(b) for b in model.interceptVector]
    means = ready(df_ref).select(Summarizer.mean(F.col(fitted.features))).first()[0].toArray()
    spans = {v: list(span) for v, span in fitted.design.spans().items()}
    x = vector_to_array(fitted.features)

    def part(beta, at: list[int]) -> Column:
        own = F.slice(x, at[0] + 1, len(at))
        weighed = F.zip_with(own, F.lit(beta[at]), lambda v, b: v * b)
        return F.aggregate(weighed, F.lit(0.0), lambda total, v: total + v) - F.lit(float(beta[at] @ means[at]))

    parts = [F.struct(F.lit(v).alias("variable"), F.array(*[part(b, at) for b in betas]).alias("shap")) for v, at in spans.items()]
    return ready(df).select(*keep, F.array(*parts).alias("contributions")), [i + float(b @ means) for i, b in zip(base, betas)]


def explained(
    df: DataFrame,
    contributions: str,
    intercepts: Sequence[float],
    key: str = "id",
    target: str = "target",
    target_type: str = CLASS,
    b_sample: Sequence[float] | None = None,
    b_all: Sequence[float] | None = None,
    link: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row and class: id, y, (target,) the columns `keep`, and `explanation`, an array in order of rank.

    Its elements hold variable, variable_value, shap_value, flag_intercept, abs_shap_value, shap_value_cum, rank and
    yhat: the intercept, then falling |shap|, ties by variable; `yhat` is the prediction that the variables up to this
    rank add up to. Class k is ordered by its own contributions while the values of all classes are summed in that
    order. `link` tells how sums become predictions (see LINKS). Narrow: no rows move.
    """
    link = link or LINKS[target_type]
    values = F.create_map(
        *[x for c in df.columns if c not in (key, target, contributions, *keep) for x in (F.lit(c), F.col(c).cast("string"))]
    )
    first = F.array(*[F.lit(float(i)) for i in intercepts])

    def predicted(sums: Column, k: int) -> Column:
        if target_type == MULTICLASS:
            return scale_predictions(softmax(sums) if link == "softmax" else sums, b_sample, b_all)[k]
        if target_type == CLASS:
            return scale_binary(inv_logit(sums[0]) if link == "logit" else sums[0], b_sample, b_all)
        return sums[0]

    def ranked(k: int) -> Column:
        items = F.array_sort(
            F.transform(contributions, lambda c: F.struct((-F.abs(c["shap"][k])).alias("o"), c["variable"].alias("variable"), c["shap"].alias("shap")))
        )
        none = F.array().cast("array<struct<variable:string,shap:double,sums:array<double>>>")
        head = F.struct(F.lit(INTERCEPT).alias("variable"), first[k].alias("shap"), first.alias("sums"))

        def step(state: Column, c: Column) -> Column:
            sums = F.zip_with(state["sums"], c["shap"], lambda a, b: a + b)
            row = F.struct(c["variable"].alias("variable"), c["shap"][k].alias("shap"), sums.alias("sums"))
            return F.struct(sums.alias("sums"), F.array_append(state["rows"], row).alias("rows"))

        start = F.struct(first.alias("sums"), F.concat(none, F.array(head)).alias("rows"))
        rows = F.aggregate(items, start, step, lambda state: state["rows"])
        return F.transform(
            rows,
            lambda r, i: F.struct(
                r["variable"].alias("variable"),
                F.try_element_at(F.col("_values"), r["variable"]).alias("variable_value"),
                r["shap"].alias("shap_value"),
                (i == 0).cast("int").alias("flag_intercept"),
                F.abs(r["shap"]).alias("abs_shap_value"),
                r["sums"][k].alias("shap_value_cum"),
                (i + 1).cast("int").alias("rank"),
                predicted(r["sums"], k).alias("yhat"),
            ),
        )

    rows = df.withColumn("_values", values).select(F.col(key).alias("id"), F.col(target).alias("y"), "_values", contributions, *keep)
    if target_type != MULTICLASS:
        return rows.select("id", "y", *keep, ranked(0).alias("explanation"))
    per_class = F.array(*[F.struct(F.lit(k).alias("target"), ranked(k).alias("explanation")) for k in range(len(intercepts))])
    return rows.select("id", "y", *keep, F.inline(per_class))


def long_frame(rows: DataFrame) -> DataFrame:
    """`explained` rows with one row per rank."""
    columns = ["id", "variable", "shap_value", "variable_value", "target", "flag_intercept", "abs_shap_value", "shap_value_cum", "rank", "yhat", "y"]
    out = rows.select(*[c for c in ("id", "y", "target") if c in rows.columns], F.inline("explanation"))
    return out.select(*[c for c in columns if c in out.columns])


def shap_frame(df: DataFrame, contributions: str, intercepts: Sequence[float], *args, **kwargs) -> DataFrame:
    """Long explanation frame, one row per row, (class,) and variable; arguments as for `explained`."""
    return long_frame(explained(df, contributions, intercepts, *args, **kwargs))


def explain_rows(
    fitted: Fitted,
    df: DataFrame,
    key: str = "id",
    target: str = "target",
    b_sample: Sequence[float] | None = None,
    b_all: Sequence[float] | None = None,
    df_ref: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """`explained` rows of any fitted ensemble of trees or linear model.

    Boosters and linear classifiers are explained in logits, forests in probabilities, regressions in the target. The
    reference of a linear model is the mean of `df_ref` (default: `df`); that of trees are their training rows.
    """
    columns = list(dict.fromkeys([key, target, *fitted.design.metr, *fitted.design.cate, *keep]))
    if fitted.kind in ("random_forest", "boosted_trees"):
        parts, intercepts = tree_contributions(fitted, df, columns)
        link = tree_link(fitted)
    elif fitted.kind in ("elastic_net", "l1_logistic"):
        parts, intercepts = linear_model_contributions(fitted, df, df if df_ref is None else df_ref, columns)
        link = LINKS[fitted.target_type]
    else:
        raise ValueError(f"{fitted.kind} has no additive explanation")
    return explained(parts, "contributions", intercepts, key, target, fitted.target_type, b_sample, b_all, link, keep)


def explain(fitted: Fitted, df: DataFrame, key: str = "id", target: str = "target", b_sample=None, b_all=None, df_ref: DataFrame | None = None) -> DataFrame:
    """Long explanation frame of any fitted ensemble of trees or linear model."""
    return long_frame(explain_rows(fitted, df, key, target, b_sample, b_all, df_ref))


def explain_trees(fitted: Fitted, df: DataFrame, key: str = "id", target: str = "target", b_sample=None, b_all=None) -> DataFrame:
    """`explain` for an ensemble of trees."""
    return explain(fitted, df, key, target, b_sample, b_all)


def _expected(yhat: Column, target_type: str) -> Column:
    """The prediction that an explanation has to reach."""
    if target_type == REGR:
        return yhat
    return yhat[1] if target_type == CLASS else yhat[F.col("target")]


def _closeness(reached: Column, wanted: Column, rtol: float, atol: float) -> list[Column]:
    close = F.abs(reached - wanted) <= atol + rtol * F.abs(wanted)
    return [F.count(F.lit(1)).alias("n"), F.count_if(close).alias("n_close")]


def check_rows(rows: DataFrame, yhat: str = "yhat", target_type: str = CLASS, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Whether the contributions of each row add up to its prediction `yhat` (a kept column): (n, n_close), one narrow pass."""
    return rows.agg(*_closeness(F.element_at("explanation", -1)["yhat"], _expected(F.col(yhat), target_type), rtol, atol))


def check_shap(shap: DataFrame, scored: DataFrame, key: str = "id", target_type: str = CLASS, yhat: str = "yhat", rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """`check_rows` for a long frame and scores that are held apart."""
    final = shap.groupBy(*[c for c in ("id", "target") if c in shap.columns]).agg(F.max_by("yhat", "rank").alias("_reached"))
    pairs = final.join(scored.select(F.col(key).alias("id"), F.col(yhat).alias("_yhat")), "id")
    return pairs.agg(*_closeness(F.col("_reached"), _expected(F.col("_yhat"), target_type), rtol, atol))


def true_class_only(shap: DataFrame) -> DataFrame:
    """Explanations of the true class of each row, from `explained` rows or from a long frame."""
    return shap.filter(F.col("target") == F.col("y"))


def waterfall(rows: DataFrame, topn: int | None = None) -> DataFrame:
    """Bars of the waterfall picture from `explained` rows: (id, position, bar_label, bar, offset, sign).

    The intercept and the topn largest contributions, the others as one bar, and the prediction. Narrow.
    """
    steps, last = F.col("explanation"), F.element_at("explanation", -1)
    shown = F.size(steps) if topn is None else F.least(F.size(steps), F.lit(topn + 1))
    before = F.when(shown > 0, F.element_at(steps, shown)["yhat"])

    def bar(position: Column, label: Column, height: Column, offset: Column) -> Column:
        return F.struct(position.cast("int").alias("position"), label.alias("bar_label"), height.alias("bar"), offset.alias("offset"))

    def of_step(s: Column, i: Column) -> Column:
        offset = F.when(i == 0, F.lit(0.0)).otherwise(F.element_at(steps, F.greatest(i, F.lit(1)))["yhat"])
        text = F.concat(s["variable"], F.lit(" = "), F.coalesce(s["variable_value"], F.lit("None")))
        return bar(s["rank"], F.when(s["flag_intercept"] == 1, F.lit(INTERCEPT)).otherwise(text), s["yhat"] - offset, offset)

    bars = F.transform(F.slice(steps, F.lit(1), shown), of_step)
    rest = F.array(bar(shown + 1, F.lit("... the rest"), last["yhat"] - before, before))
    bars = F.when(shown < F.size(steps), F.concat(bars, rest)).otherwise(bars)
    final = F.array(bar(F.size(steps) + 1, F.lit("Prediction"), last["yhat"], F.lit(0.0)))
    sign = (
        F.when(F.col("bar_label") == INTERCEPT, "intercept")
        .when(F.col("bar_label") == "Prediction", "prediction")
        .when(F.col("bar") > 0, "positive")
        .otherwise("negative")
    )
    return rows.select("id", F.inline(F.concat(bars, final))).withColumn("sign", sign)
