"""Input frames of the registered queries, each as a DataFrame and as the same SQL.

The given tables hold no nulls, so missing values are set by a rule on the key that both sides share.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


METRIC = ["price", "acctbal"]
CATEGORICAL = ["status", "segment", "nation"]

CLASS_SQL = """SELECT o_orderkey AS id,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS target,
  CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 7 = 2 THEN NULL ELSE c_acctbal END AS acctbal,
  o_orderstatus AS status,
  CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE c_mktsegment END AS segment,
  CAST(c_nationkey AS VARCHAR) AS nation,
  CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders JOIN customer ON o_custkey = c_custkey"""


def class_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer; target 1 for urgent orders, some values missing."""
    key = F.col("o_orderkey")
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("target"),
            F.when(key % 10 != 3, F.col("o_totalprice")).alias("price"),
            F.when(key % 7 != 2, F.col("c_acctbal")).alias("acctbal"),
            F.col("o_orderstatus").alias("status"),
            F.when(key % 11 != 5, F.col("c_mktsegment")).alias("segment"),
            F.col("c_nationkey").cast("string").alias("nation"),
            F.year("o_orderdate").alias("year"),
        )
    )


ITEM_SQL = """SELECT l_returnflag AS target, l_linestatus AS linestatus, l_quantity AS quantity, l_tax AS tax,
  CASE WHEN l_partkey % 10 = 3 THEN NULL ELSE l_discount END AS discount,
  l_extendedprice AS price, CAST(l_linenumber AS VARCHAR) AS linenumber
FROM lineitem"""


def item_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Line items: three return flags as a multi-class target, the price as a regression target."""
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("target"),
        F.col("l_linestatus").alias("linestatus"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_tax").alias("tax"),
        F.when(F.col("l_partkey") % 10 != 3, F.col("l_discount")).alias("discount"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_linenumber").cast("string").alias("linenumber"),
    )


SCORED_SQL = """SELECT o_orderkey AS id,
  CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS target,
  CAST(floor(o_totalprice / 25000) AS DOUBLE) / 40.0 + (c_acctbal + 1000.0) / 24000.0 AS p
FROM orders JOIN customer ON o_custkey = c_custkey"""


def scored_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a fixed score in [0, 1) that uses only +, -, * and /, so every engine gets the same bits."""
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("target"),
            (
                F.floor(F.col("o_totalprice") / 25000).cast("double") / 40.0
                + (F.col("c_acctbal") + 1000.0) / 24000.0
            ).alias("p"),
        )
    )


SCORED3_SQL = """SELECT target, floor(a / (a + b + c) * 1000000) / 1000000 AS p0, floor(b / (a + b + c) * 1000000) / 1000000 AS p1,
  floor(c / (a + b + c) * 1000000) / 1000000 AS p2
FROM (SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS INTEGER) AS target,
  0.5 + l_discount * 4.0 AS a, 0.4 + l_quantity / 50.0 AS b, 0.6 + l_tax * 5.0 AS c FROM lineitem) AS raw"""


def scored3_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with fixed probabilities of the three return flags (array `yhat`).

    They are cut to six digits, so no two scores differ by a rounding error only.
    """
    flag = F.col("l_returnflag")
    raw = table(spark, sf, "lineitem").select(
        F.when(flag == "A", 0).when(flag == "N", 1).otherwise(2).alias("target"),
        (0.5 + F.col("l_discount") * 4.0).alias("a"),
        (0.4 + F.col("l_quantity") / 50.0).alias("b"),
        (0.6 + F.col("l_tax") * 5.0).alias("c"),
    )
    total = F.col("a") + F.col("b") + F.col("c")
    return raw.select(
        "target", F.array(*[F.floor(F.col(c) / total * 1000000) / 1000000 for c in "abc"]).alias("yhat")
    )


REGR_SQL = """SELECT l_extendedprice AS y, l_quantity * 2000.0 + l_discount * 10000.0 + l_tax * 5000.0 AS yhat
FROM lineitem"""


def regr_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a fixed linear prediction of the price."""
    return table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 2000.0 + F.col("l_discount") * 10000.0 + F.col("l_tax") * 5000.0).alias("yhat"),
    )


SEARCH_SQL = """SELECT l_linenumber * 100 AS n_estimators, l_returnflag AS depth,
  CAST(l_suppkey % 5 AS INTEGER) AS fold, CASE l_linestatus WHEN 'F' THEN 'test' ELSE 'train' END AS fold_type,
  CASE WHEN l_tax < 0.04 THEN 'auc' ELSE 'acc' END AS scorer, avg(l_discount) AS scorer_value
FROM lineitem GROUP BY ALL"""


def search_frame(spark: SparkSession, sf: str) -> DataFrame:
    """A long search-result table (parameters, fold, fold_type, scorer, scorer_value) derived from line items."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            (F.col("l_linenumber") * 100).alias("n_estimators"),
            F.col("l_returnflag").alias("depth"),
            (F.col("l_suppkey") % 5).cast("int").alias("fold"),
            F.when(F.col("l_linestatus") == "F", "test").otherwise("train").alias("fold_type"),
            F.when(F.col("l_tax") < 0.04, "auc").otherwise("acc").alias("scorer"),
        )
        .agg(F.avg("l_discount").alias("scorer_value"))
    )


ORDER_SQL = """SELECT l_orderkey AS id, sum(l_quantity) AS qty, CAST(count(*) AS DOUBLE) AS lines, max(l_tax) AS tax, max(l_discount) AS discount,
  max(l_returnflag) AS flag, min(l_linestatus) AS status, sum(l_extendedprice) AS y,
  CAST(CASE WHEN sum(l_extendedprice) > 200000 THEN 1 ELSE 0 END AS INTEGER) AS target,
  CAST(CASE WHEN sum(l_extendedprice) > 250000 THEN 2 WHEN sum(l_extendedprice) > 120000 THEN 1 ELSE 0 END AS INTEGER) AS target3,
  CASE WHEN l_orderkey % 4 = 0 THEN 'test' ELSE 'train' END AS fold
FROM lineitem GROUP BY l_orderkey"""


def order_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Line items summed per order, with a unique id, a binary, a three-class and a numeric target, and a fold."""
    total = F.sum("l_extendedprice")
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.count(F.lit(1)).cast("double").alias("lines"),
            F.max("l_tax").alias("tax"),
            F.max("l_discount").alias("discount"),
            F.max("l_returnflag").alias("flag"),
            F.min("l_linestatus").alias("status"),
            total.alias("y"),
            F.when(total > 200000, 1).otherwise(0).alias("target"),
            F.when(total > 250000, 2).when(total > 120000, 1).otherwise(0).alias("target3"),
        )
        .withColumn("fold", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    )
