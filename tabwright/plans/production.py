"""Production: fit the preparation stages and a model, save both, load them elsewhere and score."""

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from tabwright.operators.encode import DesignMatrix, LumpLevels, MapUnseen, TargetEncoding
from tabwright.operators.models import Fitted, ModelSpec, fit_model
from tabwright.operators.prepare import Convert, SimpleImpute
from tabwright.operators.sample import Undersample
from tabwright.schema import CLASS, REGR
from tabwright.session import settle


def preparation_stages(metr: Sequence[str], cate: Sequence[str], target: str = "target", n_max_per_level: int = 500, key: str = "id", derive: Sequence = (), target_type: str = CLASS) -> list:
    """Stages in their fixed order. Levels are collected before encoding, encoded before rare ones are lumped.

    `n_max_per_level` bounds the rows per class that a classifier is fitted on.
    """
    return [
        *derive,
        Convert(cate, "str"),
        Convert(metr, "float"),
        SimpleImpute(cate, "constant"),
        MapUnseen(cate),
        TargetEncoding(cate, target=target, target_type=target_type),
        LumpLevels(cate),
        SimpleImpute(metr, "median"),
        Undersample(n_max_per_level, target, key),
    ]


def train_and_save(
    df: DataFrame,
    path: str,
    metr: Sequence[str],
    cate: Sequence[str],
    spec: ModelSpec,
    target: str = "target",
    target_type: str = CLASS,
    key: str = "id",
    n_max_per_level: int = 500,
    derive: Sequence = (),
    n_classes: int = 2,
) -> Fitted:
    """Fit on `df` (it needs `encode_flag`) and save the preparation, the model and the class priors under `path`."""
    stages = preparation_stages(metr, cate, target, n_max_per_level, key, derive, target_type)
    if target_type == REGR:
        stages = stages[:-1]
    etl = Pipeline(stages=stages).fit(df)
    ready = etl.transform(df)
    priors = {}
    if target_type != REGR:
        sampler = etl.stages[-1]
        ready = sampler.sample(ready)
        priors = {"b_sample": sampler.b_sample, "b_all": sampler.b_all}
    ready = settle(ready)
    fitted = fit_model(spec, ready, DesignMatrix(metr, cate).fit(ready), target, target_type, n_classes)
    etl.write().overwrite().save(f"{path}/etl")
    fitted.stages.write().overwrite().save(f"{path}/model")
    info = {"target_type": target_type, "kind": spec.kind, "n_classes": n_classes, **priors}
    line = df.sparkSession.createDataFrame([(json.dumps(info),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{path}/info")
    return fitted


def score_saved(df: DataFrame, path: str) -> DataFrame:
    """Load preparation and model, add `yhat` with the effect of undersampling removed."""
    info = json.loads(df.sparkSession.read.text(f"{path}/info").first()["value"])
    prepared = PipelineModel.load(f"{path}/etl").transform(df)
    fitted = Fitted(PipelineModel.load(f"{path}/model"), info["target_type"], info["kind"], info["n_classes"])
    return fitted.score(prepared, info.get("b_sample"), info.get("b_all"))
