"""Narrow projections: casts, missing values, text forms, small derivations."""

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.schema import MISS, MISSING


def convert(df: DataFrame, columns: Sequence[str], to: str) -> DataFrame:
    """Cast columns to `float` or `str`. NaN and the text `nan` become null."""
    if to == "float":
        new = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    elif to == "str":
        new = {c: F.nullif(F.col(c).cast("string"), F.lit("nan")) for c in columns}
    else:
        raise ValueError(f"unknown target type: {to}")
    return df.withColumns(new)


def zero_to_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


def fill_level(df: DataFrame, columns: Sequence[str], level: str = MISSING) -> DataFrame:
    """Missing categories become a level of their own."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(level)) for c in columns})


def columns_with_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that hold at least one null, from one pass."""
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] > 0]


def missing_indicator(df: DataFrame, columns: Sequence[str], encoded: bool = False) -> DataFrame:
    """Add MISS_x with `miss` / `no_miss`; with `encoded` also MISS_x_ENCODED with 1 / 0."""
    new = {MISS + c: F.when(F.col(c).isNull(), "miss").otherwise("no_miss") for c in columns}
    if encoded:
        new |= {f"{MISS}{c}_ENCODED": F.col(c).isNull().cast("int") for c in columns}
    return df.withColumns(new)


def zero_pad(column: str | Column, width: int = 2) -> Column:
    """Left-pad with zeros; longer texts stay whole."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def prefix(column: str, n: int = 1) -> Column:
    return F.substring(column, 1, n)


def family_size(*parts: str) -> Column:
    """Sum of integer counts plus one."""
    total = F.lit(1)
    for p in parts:
        total = total + F.col(p).cast("int")
    return total


def shifted_log(df: DataFrame, columns: Sequence[str], suffix: str = "_LOG_") -> DataFrame:
    """Add ln(x - min(0, min x) + 1); the minima of all columns come from one pass."""
    lows = df.agg(*[F.min(c).alias(c) for c in columns]).first()
    return df.withColumns(
        {c + suffix: F.log(F.col(c) - F.lit(float(min(0, lows[c] or 0))) + 1) for c in columns}
    )


def map_values(column: str | Column, mapping: Mapping, default=None) -> Column:
    """Look a value up in a small dictionary; unlisted values become `default`."""
    c = F.col(column) if isinstance(column, str) else column
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min); a column without spread becomes null."""
    stats = df.agg(
        *[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]
    ).first()
    new = {}
    for c in columns:
        lo, hi = stats[f"lo_{c}"], stats[f"hi_{c}"]
        spread = None if lo is None or hi == lo else float(hi - lo)
        new[c] = (F.col(c) - F.lit(lo)) / F.lit(spread).cast("double")
    return df.withColumns(new)


def fixed_cut(column: str | Column, cuts: Sequence[float] = (10.0, 50.0), labels=("low", "medium", "high")) -> Column:
    """Right-closed intervals between fixed cuts."""
    c = F.col(column) if isinstance(column, str) else column
    out = F.when(c <= cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(c <= cut, label)
    return out.when(c > cuts[-1], labels[-1])


def percent_label(value: Column, share: Column) -> Column:
    """`value (12.3%)`"""
    return F.concat(value, F.lit(" ("), F.format_string("%.1f", share * 100), F.lit("%)"))


def count_label(name: Column, n: Column) -> Column:
    """`name (7)`"""
    return F.concat(name, F.lit(" ("), n.cast("string"), F.lit(")"))


def missing_label(name: Column, share: Column) -> Column:
    """`name (NA: 12.3%)`"""
    return F.concat(name, F.lit(" (NA: "), F.format_string("%.1f", share * 100), F.lit("%)"))
