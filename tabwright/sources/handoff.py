"""Hand a prepared table and its feature lists from one stage to the next."""

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


@dataclass
class FeatureSets:
    """Column lists for the three kinds of models, and the labels of a class target."""

    metr_standard: list[str] = field(default_factory=list)
    cate_standard: list[str] = field(default_factory=list)
    metr_binned: list[str] = field(default_factory=list)
    cate_binned: list[str] = field(default_factory=list)
    metr_encoded: list[str] = field(default_factory=list)
    cate_encoded: list[str] = field(default_factory=list)
    target_labels: list[str] = field(default_factory=list)

    def all_features(self) -> list[str]:
        lists = (self.metr_standard, self.cate_standard, self.metr_binned, self.cate_binned, self.metr_encoded)
        return sorted({c for names in lists for c in names})


def save_stage(df: DataFrame, sets: FeatureSets, path: str) -> None:
    """Table as parquet, lists as JSON next to it."""
    df.write.mode("overwrite").parquet(f"{path}/table")
    line = df.sparkSession.createDataFrame([(json.dumps(asdict(sets)),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{path}/features")


def load_stage(spark: SparkSession, path: str) -> tuple[DataFrame, FeatureSets]:
    lines = spark.read.text(f"{path}/features").collect()
    return spark.read.parquet(f"{path}/table"), FeatureSets(**json.loads(lines[0]["value"]))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
