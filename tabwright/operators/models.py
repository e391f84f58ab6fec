"""The model families, trained by pyspark.ml, behind one fit and one score call.

Scoring adds `yhat`: an array of class probabilities, or one number for regression.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from math import ceil, log2
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.predictions import scale_predictions
from tabwright.operators.encode import DesignMatrixModel
from tabwright.schema import MULTICLASS, REGR
from tabwright.session import settle

# Parameter names users know, and the name of the matching Spark parameter.
TREE_PARAMS = {
    "max_depth": "maxDepth",
    "min_child_weight": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "gamma": "minInfoGain",
    "max_features": "featureSubsetStrategy",
    "colsample_bytree": "featureSubsetStrategy",
    "seed": "seed",
    "max_bins": "maxBins",
}
KINDS = ("elastic_net", "l1_logistic", "random_forest", "boosted_trees", "network")


@dataclass(frozen=True)
class ModelSpec:
    """A model family and its parameters; `with_params` derives a variant."""

    kind: str
    params: Mapping[str, Any] = field(default_factory=dict)

    def with_params(self, **params) -> "ModelSpec":
        return ModelSpec(self.kind, {**self.params, **params})


def _tree_params(params: Mapping[str, Any]) -> dict[str, Any]:
    out = {TREE_PARAMS[k]: v for k, v in params.items() if k in TREE_PARAMS}
    if "num_leaves" in params and "max_depth" not in params:
        out["maxDepth"] = ceil(log2(params["num_leaves"]))
    if "featureSubsetStrategy" in out:
        out["featureSubsetStrategy"] = str(out["featureSubsetStrategy"])
    return out


# Parameters that each family has.
KNOWN = {
    "elastic_net": {"alpha", "l1_ratio", "max_iter"},
    "l1_logistic": {"C", "max_iter"},
    "random_forest": {"n_estimators", "num_leaves", *TREE_PARAMS},
    "boosted_trees": {"n_estimators", "learning_rate", "num_leaves", *TREE_PARAMS},
    "network": {"size", "epochs", "batch_size", "seed"},
}


def _estimator(spec: ModelSpec, target_type: str, features: str, label: str, n_rows: int, n_inputs: int, n_classes: int):
    p = dict(spec.params)
    if unknown := sorted(set(p) - KNOWN.get(spec.kind, set(p))):
        raise ValueError(f"{spec.kind} has no parameter {', '.join(unknown)}")
    io = dict(featuresCol=features, labelCol=label)
    regression = target_type == REGR
    if spec.kind == "elastic_net":
        args = dict(regParam=p.get("alpha", 0.0), elasticNetParam=p.get("l1_ratio", 1.0), maxIter=p.get("max_iter", 100), **io)
        return LinearRegression(**args) if regression else LogisticRegression(**args)
    if spec.kind == "l1_logistic":
        if regression:
            raise ValueError("l1_logistic needs a class target")
        return LogisticRegression(regParam=1.0 / (p.get("C", 1.0) * n_rows), elasticNetParam=1.0, maxIter=p.get("max_iter", 100), **io)
    if spec.kind == "random_forest":
        args = dict(numTrees=p.get("n_estimators", 20), **_tree_params(p), **io)
        return RandomForestRegressor(**args) if regression else RandomForestClassifier(**args)
    if spec.kind == "boosted_trees":
        args = dict(maxIter=p.get("n_estimators", 20), stepSize=p.get("learning_rate", 0.1), **_tree_params(p), **io)
        return GBTRegressor(**args) if regression else GBTClassifier(**args)
    if spec.kind == "network":
        if regression:
            raise ValueError("network needs a class target")
        hidden = [int(u) for u in str(p.get("size", "10")).split("-")]
        return MultilayerPerceptronClassifier(
            layers=[n_inputs, *hidden, n_classes], maxIter=p.get("epochs", 100), blockSize=p.get("batch_size", 128), seed=p.get("seed", 42), **io
        )
    raise ValueError(f"unknown model kind: {spec.kind}")


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    weights = F.transform(logits, lambda m: F.exp(m - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: x / total)


def margin_to_yhat(margins: Column, target_type: str) -> Column:
    """Boosting margins (array, one per fitted ensemble) to `yhat`. A class margin is half a logit."""
    if target_type == REGR:
        return margins[0]
    logits = F.transform(margins, lambda m: 2 * m)
    if target_type == MULTICLASS:
        return softmax(logits)
    p = 1 / (1 + F.exp(-logits[0]))
    return F.array(1 - p, p)


@dataclass
class Fitted:
    """A fitted model with its design matrix."""

    stages: PipelineModel
    target_type: str
    kind: str
    n_classes: int = 2
    features: str = "features"

    @property
    def design(self) -> DesignMatrixModel:
        return self.stages.stages[0]

    @property
    def models(self) -> list:
        return list(self.stages.stages[1:])

    def score(self, df: DataFrame, b_sample: Sequence[float] | None = None, b_all: Sequence[float] | None = None) -> DataFrame:
        """Add `yhat`; with class priors the effect of undersampling is removed."""
        ready = df if self.features in df.columns else self.design.transform(df)
        return self.score_matrix(ready, b_sample, b_all).select(*[c for c in df.columns if c != "yhat"], "yhat")

    def score_matrix(self, df: DataFrame, b_sample=None, b_all=None) -> DataFrame:
        """Like `score` for a frame that already holds the design matrix."""
        for m in self.models:
            df = m.transform(df)
        if self.target_type == REGR:
            return df.withColumn("yhat", F.col("_prediction_0"))
        if self.kind == "boosted_trees" and self.target_type == MULTICLASS:
            margins = F.array(*[vector_to_array(f"_raw_{i}")[1] for i in range(self.n_classes)])
            yhat = margin_to_yhat(margins, MULTICLASS)
        else:
            yhat = vector_to_array("_probability_0")
        return df.withColumn("yhat", scale_predictions(yhat, b_sample, b_all))


def _named(estimator, i: int):
    estimator.set(estimator.predictionCol, f"_prediction_{i}")
    if estimator.hasParam("probabilityCol"):
        estimator.set(estimator.probabilityCol, f"_probability_{i}")
        estimator.set(estimator.rawPredictionCol, f"_raw_{i}")
    return estimator


def fit_model(
    spec: ModelSpec,
    df: DataFrame,
    design: DesignMatrixModel,
    target: str = "target",
    target_type: str = "CLASS",
    n_classes: int = 2,
) -> Fitted:
    """Train on `df`. Class targets are codes 0..k-1. A multi-class booster is one ensemble per class against the rest.

    Tree learners read their rows several times before they hold them binned, so a design matrix made here is settled.
    """
    features = design.getOrDefault("output")
    ready = df if features in df.columns else design.transform(df)
    ready = ready.select(features, F.col(target).cast("double").alias("_label"))
    n_rows = ready.count() if spec.kind == "l1_logistic" else 0
    args = (target_type, features)
    n_inputs = design.width
    if spec.kind in ("random_forest", "boosted_trees") and (features not in df.columns or (spec.kind == "boosted_trees" and target_type == MULTICLASS)):
        ready = settle(ready)  # read anew by every pass, and by every ensemble
    if spec.kind == "boosted_trees" and target_type == MULTICLASS:
        models = []
        for k in range(n_classes):
            part = ready.withColumn(f"_is_{k}", (F.col("_label") == k).cast("double"))
            models.append(_named(_estimator(spec, *args, f"_is_{k}", n_rows, n_inputs, n_classes), k).fit(part))
    else:
        models = [_named(_estimator(spec, *args, "_label", n_rows, n_inputs, n_classes), 0).fit(ready)]
    return Fitted(PipelineModel([design, *models]), target_type, spec.kind, n_classes, features)


def gain_importance(fitted: Fitted) -> DataFrame:
    """Share of the split gain per variable, one-hot positions summed; multi-class boosters are averaged."""
    sums: dict[str, float] = {}
    for m in fitted.models:
        gains = m.featureImportances
        for variable, span in fitted.design.spans().items():
            inside = (gains.indices >= span.start) & (gains.indices < span.stop)
            sums[variable] = sums.get(variable, 0.0) + float(gains.values[inside].sum()) / len(fitted.models)
    rows = sorted(sums.items(), key=lambda r: (-r[1], r[0]))
    return SparkSession.active().createDataFrame(rows, "feature string, gain double")


def coefficients(fitted: Fitted) -> list[tuple[str, float]]:
    """(variable or `variable = value`, coefficient) of a linear model, for P(y = 1) of a class target."""
    m = fitted.models[0]
    beta = m.coefficients
    return [
        (variable if value is None else f"{variable} = {value}", float(beta[position]))
        for position, variable, value in fitted.design.positions()
    ]
