"""Estimators for categorical columns and the design matrix.

Level tables can be as long as the data has levels, so the fitted state of target encoding and of the
unseen-level rule is a DataFrame (saved as parquet), never a dictionary on the driver.
"""

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.lookup import attach, broadcast_if_light
from tabwright.functions.ranks import ordered_index
from tabwright.operators.prepare import _Stage
from tabwright.operators.profile import level_table, most_frequent
from tabwright.operators.reshape import melt
from tabwright.schema import ENCODED, OTHER
from tabwright.session import settle

class _StateWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.levels.write.parquet(f"{path}/levels")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.levels = self.sparkSession.read.parquet(f"{path}/levels")
        return stage


class _LevelModel(_Stage, Model):
    """Model whose state is a level table `levels`."""

    levels: DataFrame | None = None
    _marked: dict = {}  # the table of each feature, measured once

    def write(self):
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)

    def _level_join(self, df: DataFrame, feature: str, payload: str) -> DataFrame:
        """Left join the level table of one feature; `payload` becomes `_payload`."""
        table = self.levels.filter(F.col("variable") == feature)
        table = table.select(F.col("value").alias(feature), F.col(payload).alias("_payload"))
        if feature not in self._marked:
            self._marked = {**self._marked, feature: (table, broadcast_if_light(table))}
        table, light = self._marked[feature]
        return df.join(light, feature, "left") if light is not table else attach(df, table, [feature], settled=True)


# --- lumping -----------------------------------------------------------------------------------------


class LumpLevels(_Stage, Estimator):
    """Keep the n_top most frequent levels of columns with more levels than that; the rest and nulls become one level."""

    n_top = Param(Params._dummy(), "n_top", "levels to keep")
    other_label = Param(Params._dummy(), "other_label", "label of the rest")

    def __init__(self, features: Sequence[str] = (), n_top: int = 10, other_label: str = OTHER):
        super().__init__()
        self._store(features=list(features), n_top=n_top, other_label=other_label)

    def _fit(self, dataset: DataFrame) -> "LumpLevelsModel":
        names, n = self._names(), self._value("n_top")
        if not names:
            return LumpLevelsModel([], {}, self._value("other_label"))
        levels = settle(level_table(dataset, names))
        counts = levels.groupBy("variable").agg(F.count(F.lit(1)).alias("levels"))
        toomany = {r["variable"] for r in counts.filter(F.col("levels") > n).collect()}
        kept: dict[str, list[str]] = {c: [] for c in names if c in toomany}
        if kept:
            for r in most_frequent(levels.filter(F.col("variable").isin(*kept)), n).orderBy("variable", "rank").collect():
                kept[r["variable"]].append(r["value"])
        return LumpLevelsModel(names, kept, self._value("other_label"))


class LumpLevelsModel(_Stage, Model):
    kept = Param(Params._dummy(), "kept", "levels kept per lumped column")
    other_label = Param(Params._dummy(), "other_label", "label of the rest")

    def __init__(self, features: Sequence[str] = (), kept: dict | None = None, other_label: str = OTHER):
        super().__init__()
        self._store(features=list(features), kept=kept, other_label=other_label)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        other = self._value("other_label")
        return dataset.withColumns(
            {c: F.when(F.col(c).isin(*levels), F.col(c)).otherwise(other) for c, levels in self._value("kept").items()}
        )


# --- target encoding ---------------------------------------------------------------------------------


class TargetEncoding(_Stage, Estimator):
    """x_ENCODED = rank of the level by falling mean target on the rows kept for encoding.

    Levels that were not seen get the median rank. A numeric target (`target_type` REGR) is averaged as it is; a
    class target with more than two labels is replaced by the indicator of its most frequent one. Rows without
    a target take no part.
    """

    flag = Param(Params._dummy(), "flag", "column that is 1 on rows used for encoding")
    target = Param(Params._dummy(), "target", "target column")
    remove_burned = Param(Params._dummy(), "remove_burned", "drop the rows used for encoding on transform")
    target_type = Param(Params._dummy(), "target_type", "CLASS, MULTICLASS or REGR")

    def __init__(self, features: Sequence[str] = (), flag: str = "encode_flag", target: str = "target", remove_burned: bool = False, target_type: str = "CLASS"):
        super().__init__()
        self._store(features=list(features), flag=flag, target=target, remove_burned=remove_burned, target_type=target_type)

    def _fit(self, dataset: DataFrame) -> "TargetEncodingModel":
        names, flag, target = self._names(), self._value("flag"), self._value("target")
        dataset = dataset.filter(F.col(target).isNotNull())
        y = F.col(target).cast("double")
        if self._value("target_type") != "REGR":
            top = dataset.groupBy(target).count().orderBy(F.desc("count"), F.asc(target)).limit(3).collect()
            if len(top) > 2:
                y = (F.col(target) == F.lit(top[0][target])).cast("double")
        used = dataset.filter(F.col(flag) == 1).withColumn("_y", y)
        means = (
            melt(used, ["_y"], names)
            .filter(F.col("value").isNotNull())
            .groupBy("variable", "value")
            .agg(F.avg("_y").alias("_mean"), F.count(F.lit(1)).alias("n"))
            .withColumn("_falling", -F.col("_mean"))
        )
        ranked = ordered_index(means, ["_falling", "value"], keys=["variable"])
        levels = settle(ranked.select("variable", "value", "n", (F.col("idx") + 1).cast("double").alias("code")))
        sizes = {r["variable"]: r["n"] for r in levels.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
        return TargetEncodingModel(names, levels, sizes, flag, self._value("remove_burned"))


class TargetEncodingModel(_LevelModel):
    flag = Param(Params._dummy(), "flag", "column that is 1 on rows used for encoding")
    remove_burned = Param(Params._dummy(), "remove_burned", "drop the rows used for encoding")
    sizes = Param(Params._dummy(), "sizes", "number of levels per column")

    def __init__(self, features: Sequence[str] = (), levels: DataFrame | None = None, sizes: dict | None = None, flag: str = "encode_flag", remove_burned: bool = False):
        super().__init__()
        self._store(features=list(features), sizes=sizes, flag=flag, remove_burned=remove_burned)
        self.levels = levels

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = dataset
        if self._value("remove_burned"):
            df = df.filter(F.coalesce(F.col(self._value("flag")) != 1, F.lit(True)))
        columns = df.columns
        for c in self._names():
            size = self._value("sizes").get(c, 0)
            median = (size + 1) / 2 if size else None  # median of the ranks 1..size
            df = self._level_join(df, c, "code").withColumn(c + ENCODED, F.coalesce(F.col("_payload"), F.lit(median).cast("double"))).drop("_payload")
        return df.select(*columns, *[c + ENCODED for c in self._names()])


# --- levels that did not occur in training ---------------------------------------------------------


class MapUnseen(_Stage, Estimator):
    """Levels that did not occur when fitting become the most frequent level. Training data pass through unchanged."""

    def __init__(self, features: Sequence[str] = ()):
        super().__init__()
        self._store(features=list(features))

    def _fit(self, dataset: DataFrame) -> "MapUnseenModel":
        levels = settle(level_table(dataset, self._names()))
        stats = levels.groupBy("variable").agg(
            F.count(F.lit(1)).alias("n"),
            F.min_by(
                "value", F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value")))
            ).alias("mode"),
            (F.count_if(F.col("value").isNull()) > 0).alias("null_seen"),
        ).collect()
        return MapUnseenModel(
            self._names(),
            levels.filter(F.col("value").isNotNull()).select("variable", "value", "n", F.col("value").alias("same")),
            {r["variable"]: r["n"] for r in stats},
            {r["variable"]: r["mode"] for r in stats},
            [r["variable"] for r in stats if r["null_seen"]],
        )


class MapUnseenModel(_LevelModel):
    sizes = Param(Params._dummy(), "sizes", "number of levels per column")
    modes = Param(Params._dummy(), "modes", "most frequent level per column")
    nulls = Param(Params._dummy(), "nulls", "columns that held nulls when fitted")

    def __init__(self, features: Sequence[str] = (), levels: DataFrame | None = None, sizes: dict | None = None, modes: dict | None = None, nulls: list | None = None):
        super().__init__()
        self._store(features=list(features), sizes=sizes, modes=modes, nulls=nulls)
        self.levels = levels

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df, columns = dataset, dataset.columns
        for c in self._names():
            seen = F.col("_payload")
            if c in self._value("nulls"):
                value = F.when(F.col(c).isNull(), F.col(c)).otherwise(F.coalesce(seen, F.lit(self._value("modes")[c])))
            else:
                value = F.coalesce(seen, F.lit(self._value("modes")[c]))
            df = self._level_join(df, c, "same").withColumn(c, value).drop("_payload")
        return df.select(*columns)


# --- design matrix -----------------------------------------------------------------------------------


class DesignMatrix(_Stage, Estimator):
    """Metric columns followed by one indicator per category seen when fitting, as one sparse vector.

    A category that was not seen is an error, as is a missing metric value. Categories are numbered in a table, however
    many there are; the driver holds their number per column.
    """

    cate = Param(Params._dummy(), "cate", "categorical columns")
    output = Param(Params._dummy(), "output", "vector column")

    def __init__(self, metr: Sequence[str] = (), cate: Sequence[str] = (), output: str = "features"):
        super().__init__()
        self._store(features=list(metr), cate=list(cate), output=output)

    def _fit(self, dataset: DataFrame) -> "DesignMatrixModel":
        cate, spark = list(self._value("cate")), dataset.sparkSession
        sizes = dict.fromkeys(cate, 0)
        if cate:
            found = melt(dataset, [], cate).filter(F.col("value").isNotNull()).distinct()
            levels = settle(ordered_index(found, ["value"], keys=["variable"]).select("variable", "value", "idx"))
            sizes |= {r["variable"]: r["n"] for r in levels.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
        else:
            levels = spark.createDataFrame([], "variable string, value string, idx long")
        return DesignMatrixModel(self._names(), levels, sizes, self._value("output"))


class DesignMatrixModel(_LevelModel):
    sizes = Param(Params._dummy(), "sizes", "number of categories per categorical column")
    output = Param(Params._dummy(), "output", "vector column")

    def __init__(self, metr: Sequence[str] = (), levels: DataFrame | None = None, sizes: dict | None = None, output: str = "features"):
        super().__init__()
        self._store(features=list(metr), sizes=sizes, output=output)
        self.levels = levels

    @property
    def metr(self) -> list[str]:
        return self._names()

    @property
    def cate(self) -> list[str]:
        return list(self._value("sizes"))

    def spans(self) -> dict[str, range]:
        """The positions of each variable."""
        out, start = {m: range(i, i + 1) for i, m in enumerate(self.metr)}, len(self.metr)
        for c, n in self._value("sizes").items():
            out[c] = range(start, start + n)
            start += n
        return out

    @property
    def width(self) -> int:
        return len(self.metr) + sum(self._value("sizes").values())

    def owner(self, positions: Sequence[int]) -> dict[int, str]:
        """The variable of each of the positions."""
        names, ends, out = list(self.spans()), [r.stop for r in self.spans().values()], {}
        for p in positions:
            out[p] = names[bisect_right(ends, p)]
        return out

    def map_frame(self, df: DataFrame | None = None) -> DataFrame:
        """Position, variable and value (null for a metric column) of every slot of the vector."""
        spark, spans = self.levels.sparkSession, self.spans()
        own = spark.createDataFrame([(i, m, None) for i, m in enumerate(self.metr)], "position int, variable string, value string")
        start = F.lit(0)
        for c in self.cate:
            start = F.when(F.col("variable") == c, spans[c].start).otherwise(start)
        hot = self.levels.select((start + F.col("idx")).cast("int").alias("position"), "variable", F.col("value").cast("string").alias("value"))
        return own.unionByName(hot)

    def positions(self, only: Sequence[int] | None = None) -> list[tuple[int, str, str | None]]:
        """`map_frame` as a list, of all slots or of some."""
        found = self.map_frame() if only is None else self.map_frame().filter(F.col("position").isin([int(p) for p in only]))
        return sorted((tuple(r) for r in found.collect()), key=lambda r: r[0])

    def _indexed(self, df: DataFrame) -> DataFrame:
        """Add the number of each category among those of its column, `_c_index`; null for one not seen."""
        for c in self.cate:
            df = self._level_join(df, c, "idx").withColumnRenamed("_payload", f"_{c}_index")
        return df

    def long(self, df: DataFrame, key: str) -> DataFrame:
        """The matrix in long form (key, position, value), zeros left out."""
        cells, spans = [], self.spans()
        for i, m in enumerate(self.metr):
            cells.append(F.struct(F.lit(i).alias("position"), F.col(m).cast("double").alias("value")))
        for c in self.cate:
            slot = (F.col(f"_{c}_index") + spans[c].start).cast("int")
            cells.append(F.struct(slot.alias("position"), F.lit(1.0).alias("value")))
        out = self._indexed(df).select(key, F.inline(F.array(*cells)))
        return out.filter((F.col("value") != 0) & (F.col("position").isNotNull()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes, output = self._value("sizes"), self._value("output")
        df, columns, parts = self._indexed(dataset), dataset.columns, list(self.metr)
        for c in sizes:
            error = F.raise_error(F.concat(F.lit(f"unseen label of {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("null"))))
            df = df.withColumn(f"_{c}_index", F.when(F.col(f"_{c}_index").isNotNull(), F.col(f"_{c}_index").cast("double")).otherwise(error))
        many = {c: n for c, n in sizes.items() if n > 1}
        if many:
            df = _one_hot_model(df, [f"_{c}_index" for c in many], [f"_{c}_hot" for c in many], list(many.values())).transform(df)
        for c, n in sizes.items():
            if n <= 1:
                df = df.withColumn(f"_{c}_hot", F.col(f"_{c}_index") + 1.0)
        parts += [f"_{c}_hot" for c in sizes]
        df = VectorAssembler(inputCols=parts, outputCol=output, handleInvalid="error").transform(df)
        return df.select(*[c for c in columns if c != output], output)


def _one_hot_model(df: DataFrame, index: list[str], hot: list[str], sizes: list[int]):
    """A one-hot encoder for known category counts: it learns them from the largest index of each column."""
    top = df.sparkSession.createDataFrame([tuple(float(n - 1) for n in sizes)], index)
    return OneHotEncoder(inputCols=index, outputCols=hot, dropLast=False).fit(top)


__all__ = [
    "DesignMatrix", "DesignMatrixModel", "LumpLevels", "LumpLevelsModel", "MapUnseen", "MapUnseenModel",
    "TargetEncoding", "TargetEncodingModel",
]
