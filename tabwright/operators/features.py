"""Feature derivation and the three feature sets."""

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tabwright.functions.scalars import family_size, prefix
from tabwright.operators.profile import group_transform
from tabwright.schema import BINNED, ENCODED, MISS, setdiff
from tabwright.sources.handoff import FeatureSets


class DeriveFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Passenger features: deck = first character of cabin, familysize, mean fare per ticket."""

    deck = Param(Params._dummy(), "deck", "derive the deck")
    familysize = Param(Params._dummy(), "familysize", "derive the family size")
    fare_pp = Param(Params._dummy(), "fare_pp", "derive the mean fare per ticket")

    def __init__(self, deck: bool = True, familysize: bool = True, fare_pp: bool = True):
        super().__init__()
        self._set(deck=deck, familysize=familysize, fare_pp=fare_pp)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = dataset
        if self.getOrDefault("deck"):
            df = df.withColumn("deck", prefix("cabin"))
        if self.getOrDefault("familysize"):
            df = df.withColumn("familysize", family_size("sibsp", "parch"))
        if self.getOrDefault("fare_pp"):
            df = group_transform(df, "ticket", "fare", "mean", "fare_pp")
        return df


def feature_sets(
    metr: Sequence[str],
    cate: Sequence[str],
    toomany: Sequence[str] = (),
    miss: Sequence[str] = (),
    onebin: Sequence[str] = (),
    target_labels: Sequence[str] = (),
) -> FeatureSets:
    """Lists for tree models (standard), linear models (binned) and networks (encoded)."""
    metr, cate = list(metr), list(cate)
    miss_flags = [MISS + m for m in miss]
    return FeatureSets(
        metr_standard=metr + [t + ENCODED for t in toomany],
        cate_standard=cate + miss_flags,
        metr_binned=[],
        cate_binned=setdiff([m + BINNED for m in metr], onebin) + cate,
        metr_encoded=metr + [c + ENCODED for c in cate] + [m + ENCODED for m in miss_flags],
        cate_encoded=[],
        target_labels=list(target_labels),
    )
