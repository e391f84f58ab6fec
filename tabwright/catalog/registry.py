"""Registered queries: one Spark callable per operator and, where SQL can say it, the same result in SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def round_columns(df: DataFrame, num: str, digits: int) -> DataFrame:
    """Round the named columns; adding zero turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in num.split()})


def round_sql(sql: str, num: str, digits: int) -> str:
    if not num:
        return sql
    parts = ", ".join(f'CAST(round(CAST("{c}" AS DOUBLE), {digits}) + 0.0 AS DOUBLE) AS "{c}"' for c in num.split())
    return f"SELECT * REPLACE ({parts}) FROM ({sql}) AS result"


def query(name: str, sql: str | None = None, num: str = "", digits: int = 6):
    """Register a query. `num` lists the double columns that both sides round before comparing."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return round_columns(out, num, digits) if num else out

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = round_sql(sql, num, digits)
        return fn

    return register
