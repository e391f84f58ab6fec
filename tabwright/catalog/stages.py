"""Queries that run a whole stage."""

from pyspark.sql import functions as F

from tabwright.catalog.frames import CATEGORICAL, CLASS_SQL, METRIC, class_frame, order_frame
from tabwright.catalog.modelling import CATE, METR, TREES
from tabwright.catalog.preparation import TOP_SQL, encoding_sql
from tabwright.catalog.projections import scratch
from tabwright.catalog.registry import query
from tabwright.operators.models import ModelSpec
from tabwright.plans.compare import compare
from tabwright.plans.explore import explore
from tabwright.plans.interpret import interpret
from tabwright.sources.handoff import load_stage

EXPLORE_SQL = f"""WITH base AS (SELECT * FROM ({CLASS_SQL}) AS t),
folded AS (SELECT id, CASE WHEN idx <= 0.1 * (n - 1) THEN 'util' WHEN idx <= 0.8 * (n - 1) THEN 'train' ELSE 'test' END AS fold
  FROM (SELECT id, row_number() OVER (ORDER BY md5(id || ':123'), id) - 1 AS idx, count(*) OVER () AS n FROM base) AS i),
q AS (SELECT quantile_cont(price, [.02, .98]) AS p, quantile_cont(acctbal, [.02, .98]) AS a FROM base),
clipped AS (SELECT base.*, fold, CASE WHEN price IS NOT NULL THEN least(greatest(price, p[1]), p[2]) END AS wp,
  CASE WHEN acctbal IS NOT NULL THEN least(greatest(acctbal, a[1]), a[2]) END AS wa,
  CAST(fold = 'util' AS INTEGER) AS encode_flag FROM base JOIN folded USING (id), q),
dp AS (SELECT wp AS value, row_number() OVER (ORDER BY md5(id || ':0'), id) - 1 AS idx FROM clipped WHERE wp IS NOT NULL),
da AS (SELECT wa AS value, row_number() OVER (ORDER BY md5(id || ':0'), id) - 1 AS idx FROM clipped WHERE wa IS NOT NULL)
SELECT c.id, c.fold, coalesce(wp, dp.value) AS price, coalesce(wa, da.value) AS acctbal, coalesce(segment, '(Missing)') AS segment,
  CASE WHEN wp IS NULL THEN 'miss' ELSE 'no_miss' END AS "MISS_price",
  CASE WHEN nation IN {TOP_SQL} THEN nation ELSE '_OTHER_' END AS nation, e.code AS "nation_ENCODED"
FROM clipped AS c
LEFT JOIN dp ON wp IS NULL AND dp.idx = CAST('0x' || substr(md5(c.id || ':price:0'), 1, 15) AS BIGINT) % (SELECT count(*) FROM dp)
LEFT JOIN da ON wa IS NULL AND da.idx = CAST('0x' || substr(md5(c.id || ':acctbal:0'), 1, 15) AS BIGINT) % (SELECT count(*) FROM da)
JOIN ({encoding_sql('SELECT * FROM clipped', 'nation', 'target', 'encode_flag = 1')}) AS e ON e.level = c.nation
WHERE c.fold <> 'util'"""


@query("explore_stage", EXPLORE_SQL, num="price acctbal", digits=4)
def _(spark, sf):
    done = explore(class_frame(spark, sf), METRIC, CATEGORICAL)
    return done.table.select("id", "fold", "price", "acctbal", "segment", "MISS_price", "nation", "nation_ENCODED")


@query("compare_stage")
def _(spark, sf):
    df = order_frame(spark, sf).withColumn("fold", F.when(F.col("id") % 10 == 1, "util").otherwise(F.col("fold")))
    path = scratch(spark)
    explore(df, METR, CATE).save(path)
    prepared, features = load_stage(spark, path)
    candidates = {
        "elastic": (ModelSpec("elastic_net"), {"alpha": [0.01], "l1_ratio": [1.0]}),
        "trees": (TREES, {"n_estimators": [2, 4]}),
    }
    return compare(prepared, features, candidates, "elastic", k=2, shares=(1.0,))["comparison_runs"]


@query("interpret_stage")
def _(spark, sf):
    done = interpret(order_frame(spark, sf), METR, CATE, TREES, k=2, topn=3)
    return done.frames["importance"]
