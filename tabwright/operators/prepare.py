"""Estimators for metric columns. `fit` is one aggregation, `transform` a narrow projection.

The fitted values of a stage are a JSON parameter, so every stage saves and loads inside a Pipeline.
"""

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import scalars
from tabwright.functions.quantiles import fit_quantiles, quantile_frame
from tabwright.operators.profile import top_values
from tabwright.schema import BINNED, MISSING


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    features = Param(Params._dummy(), "features", "columns to work on")

    def _names(self) -> list[str]:
        return list(self.getOrDefault("features"))

    def _value(self, name: str):
        return self.getOrDefault(name) if self.isDefined(name) else None

    def _store(self, **values):
        self._set(**{k: v for k, v in values.items() if v is not None})


class Convert(_Stage, Transformer):
    """Cast columns to `float` or `str`."""

    convert_to = Param(Params._dummy(), "convert_to", "float or str")

    def __init__(self, features: Sequence[str] = (), convert_to: str = "float"):
        super().__init__()
        self._store(features=list(features), convert_to=convert_to)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return scalars.convert(dataset, self._names(), self._value("convert_to"))


# --- quantile bins ---------------------------------------------------------------------------------


def bin_edges(quantiles: Sequence[float | None]) -> list[float]:
    """Distinct edges in rising order."""
    return sorted({q for q in quantiles if q is not None})


def bin_label(column: str | Column, edges: Sequence[float], prefix: str = "q") -> Column:
    """Right-closed bins q01, q02 … between the edges; values outside go to the first or last bin.

    Missing values, and all values of a column with a single edge, have no bin.
    """
    c = F.col(column) if isinstance(column, str) else column
    if len(edges) < 2:
        return F.lit(None).cast("string")
    last = len(edges) - 1
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for i in range(1, last):
        out = out.when(c <= edges[i], f"{prefix}{i:02d}")
    return out.otherwise(f"{prefix}{last:02d}")


def char_bins(df: DataFrame, column: str, n_bins: int = 10, prefix: str = "q", name: str | None = None) -> DataFrame:
    """Add the quantile bin of one column."""
    edges = bin_edges(fit_quantiles(df, [column], [i / n_bins for i in range(n_bins + 1)])[column])
    return df.withColumn(name or column + BINNED, bin_label(column, edges, prefix))


class Binning(_Stage, Estimator):
    """Quantile bins of many columns, fitted in one pass; adds x_BINNED."""

    n_bins = Param(Params._dummy(), "n_bins", "number of bins before equal edges are merged")
    missing = Param(Params._dummy(), "missing", "label of missing values, empty keeps them missing")

    def __init__(self, features: Sequence[str] = (), n_bins: int = 10, missing: str = ""):
        super().__init__()
        self._store(features=list(features), n_bins=n_bins, missing=missing)

    def _fit(self, dataset: DataFrame) -> "BinningModel":
        n = self._value("n_bins")
        found = fit_quantiles(dataset, self._names(), [i / n for i in range(n + 1)])
        return BinningModel(self._names(), {c: bin_edges(q) for c, q in found.items()}, self._value("missing"))


class BinningModel(_Stage, Model):
    edges = Param(Params._dummy(), "edges", "bin edges per column")
    missing = Param(Params._dummy(), "missing", "label of missing values")

    def __init__(self, features: Sequence[str] = (), edges: dict | None = None, missing: str = ""):
        super().__init__()
        self._store(features=list(features), edges=edges, missing=missing)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        edges, missing = self._value("edges"), self._value("missing")
        new = {c + BINNED: bin_label(c, edges[c]) for c in self._names()}
        if missing:
            new = {c: F.coalesce(e, F.lit(missing)) for c, e in new.items()}
        return dataset.withColumns(new)

    def single_bin_columns(self) -> list[str]:
        """Binned columns with one bin or none; known from the edges, no pass over the data."""
        return [c + BINNED for c in self._names() if len(self._value("edges")[c]) <= 2]


# --- winsorize and z-scale -------------------------------------------------------------------------


class Winsorize(_Stage, Estimator):
    """Clip at fitted quantiles. With `fresh` the quantiles are taken from the data being transformed."""

    fresh = Param(Params._dummy(), "fresh", "fit again on every transform")
    lower_quantile = Param(Params._dummy(), "lower_quantile", "lower quantile, unset for none")
    upper_quantile = Param(Params._dummy(), "upper_quantile", "upper quantile, unset for none")

    def __init__(self, features: Sequence[str] = (), fresh: bool = False, lower_quantile: float | None = None, upper_quantile: float | None = None):
        super().__init__()
        self._store(features=list(features), fresh=fresh, lower_quantile=lower_quantile, upper_quantile=upper_quantile)

    def _fit(self, dataset: DataFrame) -> "WinsorizeModel":
        lo, hi = self._value("lower_quantile"), self._value("upper_quantile")
        limits = None if self._value("fresh") else winsor_limits(dataset, self._names(), lo, hi)
        return WinsorizeModel(self._names(), limits, lo, hi)


class WinsorizeModel(_Stage, Model):
    limits = Param(Params._dummy(), "limits", "[lower, upper] per column")
    lower_quantile = Param(Params._dummy(), "lower_quantile", "lower quantile")
    upper_quantile = Param(Params._dummy(), "upper_quantile", "upper quantile")

    def __init__(self, features: Sequence[str] = (), limits: dict | None = None, lower_quantile: float | None = None, upper_quantile: float | None = None):
        super().__init__()
        self._store(features=list(features), limits=limits, lower_quantile=lower_quantile, upper_quantile=upper_quantile)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limits = self._value("limits")
        if limits is None:
            limits = winsor_limits(dataset, self._names(), self._value("lower_quantile"), self._value("upper_quantile"))
        return dataset.withColumns({c: clip(c, *limits[c]) for c in self._names()})


def winsor_limits(df: DataFrame, columns: Sequence[str], lower: float | None, upper: float | None) -> dict[str, list]:
    probs = [p for p in (lower, upper) if p is not None]
    if not probs:
        return {c: [None, None] for c in columns}
    found = fit_quantiles(df, columns, probs)
    return {c: [q[0] if lower is not None else None, q[-1] if upper is not None else None] for c, q in found.items()}


def clip(column: str, lower: float | None, upper: float | None) -> Column:
    """Limit a column; missing stays missing."""
    c = F.col(column)
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNotNull(), out)


class Zscale(_Stage, Estimator):
    """(x - mean) / std. With `fresh` the moments are taken from the data being transformed."""

    fresh = Param(Params._dummy(), "fresh", "fit again on every transform")

    def __init__(self, features: Sequence[str] = (), fresh: bool = False):
        super().__init__()
        self._store(features=list(features), fresh=fresh)

    def _fit(self, dataset: DataFrame) -> "ZscaleModel":
        return ZscaleModel(self._names(), None if self._value("fresh") else moments(dataset, self._names()))


class ZscaleModel(_Stage, Model):
    moments = Param(Params._dummy(), "moments", "[mean, std] per column")

    def __init__(self, features: Sequence[str] = (), moments: dict | None = None):
        super().__init__()
        self._store(features=list(features), moments=moments)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stats = self._value("moments") or moments(dataset, self._names())
        return dataset.withColumns(
            {c: F.try_divide(F.col(c) - F.lit(stats[c][0]), F.lit(stats[c][1]).cast("double")) for c in self._names()}
        )


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    row = df.agg(*[F.struct(F.avg(c), F.stddev_samp(c)).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


# --- imputation with one value per column ----------------------------------------------------------


class SimpleImpute(_Stage, Estimator):
    """Fill missing values with the mean, the exact median, the most frequent value or a constant."""

    strategy = Param(Params._dummy(), "strategy", "mean, median, most_frequent or constant")
    fill_value = Param(Params._dummy(), "fill_value", "value for strategy constant")

    def __init__(self, features: Sequence[str] = (), strategy: str = "median", fill_value=MISSING):
        super().__init__()
        self._store(features=list(features), strategy=strategy, fill_value=fill_value)

    def _fit(self, dataset: DataFrame) -> "SimpleImputeModel":
        names, strategy = self._names(), self._value("strategy")
        if not names:
            fills = {}
        elif strategy == "constant":
            fills = {c: self._value("fill_value") for c in names}
        elif strategy == "mean":
            fills = dataset.agg(*[F.avg(c).alias(c) for c in names]).first().asDict()
        elif strategy == "median":
            fills = {c: q[0] for c, q in fit_quantiles(dataset, names, [0.5]).items()}
        elif strategy == "most_frequent":
            texts = dataset.select(*[F.col(c).cast("string").alias(c) for c in names])
            fills = {r["variable"]: r["value"] for r in top_values(texts, names, 1).collect()}
        else:
            raise ValueError(f"unknown strategy: {strategy}")
        return SimpleImputeModel(names, fills)


class SimpleImputeModel(_Stage, Model):
    fills = Param(Params._dummy(), "fills", "fill value per column")

    def __init__(self, features: Sequence[str] = (), fills: dict | None = None):
        super().__init__()
        self._store(features=list(features), fills=fills)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills, types = self._value("fills"), dataset.schema
        known = [c for c in self._names() if fills.get(c) is not None]
        return dataset.withColumns({c: F.coalesce(F.col(c), F.lit(fills[c]).cast(types[c].dataType)) for c in known})


__all__ = [
    "Binning", "BinningModel", "Convert", "SimpleImpute", "SimpleImputeModel", "Winsorize", "WinsorizeModel",
    "Zscale", "ZscaleModel", "bin_edges", "bin_label", "char_bins", "clip", "quantile_frame",
]
