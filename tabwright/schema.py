"""Naming rules and the metadata table that drives which columns are metric and which categorical."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed names and levels of the data model.
CLASS, MULTICLASS, REGR = "CLASS", "MULTICLASS", "REGR"
MISSING = "(Missing)"
OTHER = "_OTHER_"
BINNED, LOG, ENCODED, MISS = "_BINNED", "_LOG_", "_ENCODED", "MISS_"
METRIC_TYPES = ("metr",)
CATEGORICAL_TYPES = ("nomi", "ordi")
KEPT_STATUS = ("ready", "derive")


def setdiff(a: Sequence[str], b: Sequence[str]) -> list[str]:
    """Names in `a` that are not in `b`, in the order of `a`."""
    drop = set(b)
    return [x for x in a if x not in drop]


def setdiff_rows(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Table form of `setdiff`: rows of `a` whose name does not occur in `b`."""
    return a.join(b.select(on).distinct(), on, "left_anti")


def union_names(*lists: Sequence[str]) -> list[str]:
    """All names once, in order of first appearance."""
    return list(dict.fromkeys(x for names in lists for x in names))


def normalise_names(df: DataFrame) -> DataFrame:
    """Blanks in column names become underscores."""
    return df.toDF(*[c.strip().replace(" ", "_") for c in df.columns])


def rename_derived(df: DataFrame, columns: Sequence[str], suffix: str = LOG) -> DataFrame:
    """`x_BINNED` becomes `x_LOG__BINNED` for the columns that were log-transformed; column order is kept."""
    return df.withColumnsRenamed({c + BINNED: c + suffix + BINNED for c in columns})


@dataclass(frozen=True)
class Metadata:
    """Column roles read from a metadata table (variable, category, status, type)."""

    metric: list[str]
    categorical: list[str]

    @classmethod
    def from_frame(cls, meta: DataFrame) -> "Metadata":
        rows = kept_metadata(meta).select("variable", "type").collect()
        return cls(
            metric=[r["variable"] for r in rows if r["type"] in METRIC_TYPES],
            categorical=[r["variable"] for r in rows if r["type"] in CATEGORICAL_TYPES],
        )


def kept_metadata(meta: DataFrame) -> DataFrame:
    """Rows of the metadata table whose variable is in use."""
    return meta.filter(F.col("status").isin(*KEPT_STATUS))
