"""Stage 1: from a raw table to a prepared table with folds, three feature sets and the frames of the report."""

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import scalars
from tabwright.functions.predictions import label_codes, label_encode
from tabwright.operators.assoc import above_cutoff, association_matrix
from tabwright.operators.density import distribution_profile
from tabwright.operators.encode import LumpLevels, TargetEncoding
from tabwright.operators.features import DeriveFeatures, feature_sets
from tabwright.operators.importance import fold_drift, univariate_importance
from tabwright.operators.prepare import Binning, Convert, Winsorize
from tabwright.operators.profile import (
    columns_to_drop,
    describe_categorical,
    describe_numeric,
    group_transform,
    too_many_levels,
)
from tabwright.operators.sample import assign_fold, fold_flags, random_impute, remove_burned
from tabwright.schema import BINNED, CLASS, LOG, MISS, MISSING, MULTICLASS, rename_derived, setdiff
from tabwright.session import settle
from tabwright.sources.handoff import FeatureSets, save_stage


@dataclass
class Explored:
    """Prepared table, its feature sets, and lazily evaluated report frames."""

    table: DataFrame
    features: FeatureSets
    reports: dict[str, DataFrame] = field(default_factory=dict)

    def save(self, path: str) -> None:
        save_stage(self.table, self.features, path)


def explore(
    df: DataFrame,
    metr: Sequence[str],
    cate: Sequence[str],
    key: str = "id",
    target: str = "target",
    target_type: str = CLASS,
    ordinal: Sequence[str] = (),
    tolog: Sequence[str] = (),
    zero_is_missing: bool = False,
    winsor: tuple[float, float] = (0.02, 0.98),
    n_top: int = 10,
    corr_cutoff: float = 0.0,
    remove: Sequence[str] = (),
    seed: int = 123,
) -> Explored:
    """Prepare a table. A `fold` column (util, train, test) is kept if there is one, otherwise drawn.

    The source is settled once: every fit and report reads it, and a join in it would be sent to the driver and
    broadcast anew by each of them. All steps up to the random imputation are narrow projections with fitted constants.
    """
    metr, cate = setdiff(metr, remove), setdiff(cate, remove)
    reports: dict[str, DataFrame] = {}
    labels: list = []
    df = settle(df)
    df = fold_flags(df if "fold" in df.columns else assign_fold(df, key, seed))
    df = Convert(cate, "str").transform(Convert(metr, "float").transform(df))
    if zero_is_missing:
        df = scalars.zero_to_missing(df, metr)
    if target_type == MULTICLASS:
        labels = label_codes(df, target)
    elif target_type == CLASS:
        labels = [0, 1]

    # metric columns
    bins = Binning(metr, missing=MISSING).fit(df)
    df, onebin = bins.transform(df), bins.single_bin_columns()
    metr = setdiff(metr, columns_to_drop(df, metr))
    reports["describe_metric"] = describe_numeric(df, metr)
    df = Winsorize(metr, lower_quantile=winsor[0], upper_quantile=winsor[1]).fit(df).transform(df)
    tolog = [c for c in tolog if c in metr]
    if tolog:
        df = rename_derived(scalars.shifted_log(df, tolog), tolog)
        onebin = [c.replace(BINNED, LOG + BINNED) if c.removesuffix(BINNED) in tolog else c for c in onebin]
        metr = [c + LOG if c in tolog else c for c in metr]
    shown = metr + [m + BINNED for m in metr]
    reports["importance_metric"] = univariate_importance(df, shown, target, target_type)
    reports["drift_metric"] = fold_drift(df, metr)
    reports |= {f"metric_{k}": v for k, v in distribution_profile(df, metr, target, target_type, labels).items()}
    if len(metr) > 1:
        reports["association_metric"] = above_cutoff(association_matrix(df, metr), corr_cutoff)
    miss = scalars.columns_with_missing(df, metr)
    df = scalars.missing_indicator(df, miss, encoded=True)

    # categorical columns
    df = df.withColumns({c: scalars.zero_pad(c) for c in ordinal if c in cate})
    df = scalars.fill_level(df, cate)
    reports["describe_categorical"] = describe_categorical(df, cate)
    toomany = too_many_levels(df, cate, n_top)
    df = TargetEncoding(cate, "encode_flag", target, target_type=target_type).fit(df).transform(df)
    df = LumpLevels(toomany, n_top).fit(df).transform(df)
    levels = cate + [MISS + m for m in miss]
    reports["importance_categorical"] = univariate_importance(df, levels, target, target_type)
    reports["drift_categorical"] = fold_drift(df, levels)
    reports |= {f"categorical_{k}": v for k, v in distribution_profile(df, levels, target, target_type, labels).items()}
    if len(levels) > 1:
        reports["association_categorical"] = above_cutoff(association_matrix(df, levels), corr_cutoff)

    # final table
    df = random_impute(df, miss, key)
    if target_type == MULTICLASS:
        df = df.withColumn(target, label_encode(target, labels))
    sets = feature_sets(metr, cate, toomany, miss, onebin, [str(x) for x in labels])
    return Explored(remove_burned(df), sets, reports)


def passenger_features(df: DataFrame) -> DataFrame:
    """Exploration variant of the passenger features: fare per head instead of the mean fare per ticket."""
    return group_transform(DeriveFeatures(fare_pp=False).transform(df), "ticket", "fare", "per_head", "fare_pp")


def map_income_target(df: DataFrame, column: str = "income") -> DataFrame:
    """Census target: the two income texts to 0 and 1."""
    # Texts of the census file, with their leading blank.
    return df.withColumn("target", scalars.map_values(F.col(column), {" - 50000.": 0, " 50000+.": 1}))
