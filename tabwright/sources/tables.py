"""Readers and writers for the input tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.ranks import ordered_index
from tabwright.schema import kept_metadata, normalise_names


# Texts that stand for a missing value unless the caller names others.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    trim: bool = False,
    missing: Sequence[str] = MISSING,
) -> DataFrame:
    """Delimited text with a header, or parquet by its extension.

    Give a schema for text: without one every column is read as text, no extra pass infers types. Texts listed in
    `missing` are null, in number columns also what is no number; blanks around a text are kept unless `trim` is set.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", header).option("sep", sep).option("nullValue", "")
    reader = reader.option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    text = {f.name: F.when(~F.col(f"`{f.name}`").isin(*missing), F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)}
    number = {f.name: F.when(~F.isnan(f"`{f.name}`"), F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns({**text, **number})


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Tab-delimited text; blanks in column names become underscores."""
    return normalise_names(read_table(spark, path, schema, sep="\t"))


def read_names(spark: SparkSession, path: str) -> list[str]:
    """Column names from a side file, one per line, stray tabs and blanks removed."""
    lines = [r["value"].strip() for r in spark.read.text(path, wholetext=False).collect()]
    return [line for line in lines if line]


def read_headerless(
    spark: SparkSession, path: str, names: list[str], types: dict[str, T.DataType] | None = None, trim: bool = False
) -> DataFrame:
    """Delimited text without a header. Values keep a leading blank unless `trim` is set."""
    types = types or {}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    return read_table(spark, path, schema, header=False, trim=trim)


def read_meta(spark: SparkSession, path: str) -> DataFrame:
    """Metadata table (variable, category, status, type), only the rows in use."""
    return kept_metadata(read_table(spark, path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def row_slice(df: DataFrame, order: list[str], start: int = 0, stop: int | None = None) -> DataFrame:
    """Rows start..stop-1 of the order given, whose columns identify a row.

    Only the order columns are ranked; the rows are then picked by comparing with the two border rows.
    """
    ends = [i for i in (start, stop) if i]
    keys = ordered_index(df.select(*order), order, name="_row")
    border = {r["_row"]: r for r in keys.filter(F.col("_row").isin(*ends)).collect()} if ends else {}
    place = F.struct(*order)

    def value(i: int) -> Column:
        return F.struct(*[F.lit(border[i][c]).cast(df.schema[c].dataType).alias(c) for c in order])

    out = df
    if start:
        out = out.filter(place >= value(start)) if start in border else out.filter(F.lit(False))
    if stop is not None and (stop in border or stop == 0):
        out = out.filter(place < value(stop)) if stop else out.filter(F.lit(False))
    return out


def with_row_id(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """Add a consecutive id from 1 in the order given, whose columns identify a row.

    The ranking works on the order columns alone; the full rows are shuffled once, for the join.
    """
    ids = ordered_index(df.select(*order), order, name=name)
    return df.join(ids.withColumn(name, F.col(name) + 1), order)
