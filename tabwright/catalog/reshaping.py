"""Queries on joins, windows, set operations and reshaping."""

from pyspark.sql import functions as F

from tabwright.catalog.frames import CLASS_SQL, ITEM_SQL, ORDER_SQL, SEARCH_SQL, class_frame, item_frame, order_frame, search_frame, table
from tabwright.catalog.preparation import MAP_SQL, complete_frame
from tabwright.catalog.registry import query
from tabwright.functions.lookup import attach
from tabwright.operators import interpret, reshape
from tabwright.operators.encode import DesignMatrix
from tabwright.operators.profile import running_share
from tabwright.schema import union_names


@query(
    "join_level_rates",
    f"""SELECT linenumber, quantity, rate, count(*) AS n FROM ({ITEM_SQL}) AS t JOIN (SELECT linenumber AS ln, avg(CAST(target = 'R' AS INTEGER)) AS rate
    FROM ({ITEM_SQL}) AS r GROUP BY 1) AS g ON g.ln = t.linenumber GROUP BY ALL""",
    num="rate",
)
def _(spark, sf):
    df = item_frame(spark, sf)
    rates = df.groupBy("linenumber").agg(F.avg((F.col("target") == "R").cast("int")).alias("rate"))
    out = attach(df, rates, ["linenumber"], how="inner")
    return out.groupBy("linenumber", "quantity", "rate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_attribute_map",
    f"""SELECT position, variable, value, n FROM ({MAP_SQL}) AS m LEFT JOIN (SELECT status AS level, count(*) AS n FROM ({CLASS_SQL}) AS t GROUP BY 1
    UNION ALL SELECT nation, count(*) FROM ({CLASS_SQL}) AS t GROUP BY 1) AS c ON c.level = m.value WHERE value IS NOT NULL""",
)
def _(spark, sf):
    df = complete_frame(spark, sf)
    positions = DesignMatrix(["price", "acctbal"], ["status", "nation"]).fit(df).map_frame(df)
    counts = reshape.melt(df, [], ["status", "nation"]).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return attach(positions.filter("value IS NOT NULL"), counts, ["value"]).select("position", "variable", "value", "n")


@query(
    "join_row_and_variable",
    f"""SELECT id, 'status' AS variable, status AS variable_value, CAST(length(status) AS DOUBLE) AS shap_value FROM ({CLASS_SQL}) AS a
    UNION ALL SELECT id, 'segment', segment, CAST(length(segment) AS DOUBLE) FROM ({CLASS_SQL}) AS b""",
)
def _(spark, sf):
    df = class_frame(spark, sf)
    values = reshape.melt(df, ["id"], ["status", "segment"], value="variable_value")
    scores = reshape.melt(
        df, ["id"], [(c, F.length(c).cast("double")) for c in ("status", "segment")], value="shap_value"
    )
    return values.join(scores, ["id", "variable"], "left")


@query(
    "semi_and_anti_rows",
    """SELECT 'in' AS side, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    UNION ALL SELECT 'out', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey")
    keys = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return customers.join(keys, "c_custkey", "left_semi").select(F.lit("in").alias("side"), "c_custkey").unionByName(
        customers.join(keys, "c_custkey", "left_anti").select(F.lit("out").alias("side"), "c_custkey")
    )


@query(
    "dictionary_lookup",
    """SELECT o_orderkey, n_name AS nation, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _(spark, sf):
    customer = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    named = attach(orders, table(spark, sf, "nation"), ["n_nationkey"]).withColumnRenamed("n_regionkey", "r_regionkey")
    named = attach(named, table(spark, sf, "region"), ["r_regionkey"])
    return named.select("o_orderkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query(
    "grid_product",
    f"""SELECT feature, CAST(value AS DOUBLE) AS value, count(*) AS n, sum(CASE feature WHEN 'lines' THEN CAST(value AS DOUBLE) ELSE lines END) AS lines
    FROM ({ORDER_SQL}) AS t, (SELECT 'lines' AS feature, unnest([1, 2, 5]) AS value UNION ALL SELECT 'qty', unnest([10, 100])) AS g GROUP BY ALL""",
    num="value lines",
    digits=1,
)
def _(spark, sf):
    grid = {"lines": [1.0, 2.0, 5.0], "qty": [10.0, 100.0]}
    copies = interpret.with_grid(order_frame(spark, sf), grid, ["lines", "qty"])
    return copies.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("lines").alias("lines"))


DONOR_SQL = f"""SELECT r.*, d.qty AS dq, d.lines AS dl, d.tax AS dt FROM
  (SELECT *, row_number() OVER (ORDER BY md5(id || ':999'), id) AS pos FROM ({ORDER_SQL}) AS a) AS r
  JOIN (SELECT qty, lines, tax, row_number() OVER (ORDER BY md5(id || ':999-donor'), id) AS pos FROM ({ORDER_SQL}) AS b) AS d ON d.pos = r.pos"""


@query("permuted_rows", f"SELECT id, qty, lines, dq, dl FROM ({DONOR_SQL}) AS j")
def _(spark, sf):
    out = interpret.with_donor(order_frame(spark, sf), "id", ["qty", "lines"])
    return out.select("id", "qty", "lines", F.col("_donor_qty").alias("dq"), F.col("_donor_lines").alias("dl"))


RUNNING_SQL = """SELECT p_brand AS feature, 100.0 * sum(n) OVER (ORDER BY n DESC, p_brand) / sum(n) OVER () AS importance_cum, CAST(n AS DOUBLE) AS perf_diff
  FROM (SELECT p_brand, sum(p_size) AS n FROM part GROUP BY 1) AS g"""


def brand_importance(spark, sf):
    brands = table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_size").cast("double").alias("perf_diff"))
    return running_share(brands, "perf_diff", [F.desc("perf_diff"), F.asc("feature")], "importance_cum")


@query("running_share", RUNNING_SQL, num="importance_cum perf_diff")
def _(spark, sf):
    return brand_importance(spark, sf)


@query("cumulative_cut", f"SELECT feature FROM ({RUNNING_SQL}) AS r WHERE importance_cum < 50")
def _(spark, sf):
    return spark.createDataFrame([(f,) for f in interpret.top_features(brand_importance(spark, sf), 50.0)], "feature string")


@query(
    "union_rows_tolerant",
    """SELECT c_custkey AS "key", c_acctbal AS acctbal, 'c' || c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, 's' || s_nationkey, NULL FROM supplier""",
    num="acctbal",
    digits=2,
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("acctbal"), F.concat(F.lit("c"), "c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    s = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), "s_nationkey").alias("nation"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("acctbal")
    )
    return reshape.union_rows(c, s)


@query(
    "set_operations",
    """SELECT 'difference' AS kind, p_name AS name FROM (SELECT p_name FROM part WHERE p_type = 'PROMO' EXCEPT SELECT p_name FROM part WHERE p_size < 8) AS a
    UNION ALL SELECT 'union', name FROM (SELECT p_name AS name FROM part UNION SELECT p_brand FROM part) AS b""",
)
def _(spark, sf):
    part = table(spark, sf, "part")
    promo, small = part.filter("p_type = 'PROMO'").select("p_name"), part.filter("p_size < 8").select("p_name")
    names = part.select("p_name").union(part.select("p_brand")).distinct().toDF("name")
    return promo.subtract(small).select(F.lit("difference").alias("kind"), F.col("p_name").alias("name")).unionByName(
        names.select(F.lit("union").alias("kind"), "name")
    )


@query("union_of_names", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders", num="o_totalprice", digits=2)
def _(spark, sf):
    names = union_names(["o_orderkey", "o_custkey"], ["o_custkey", "o_totalprice"])
    return table(spark, sf, "orders").select(*names)


@query(
    "melt_columns",
    f"""SELECT id, variable, value FROM (SELECT id, CAST(price AS DOUBLE) AS price, acctbal FROM ({CLASS_SQL}) AS t)
    UNPIVOT INCLUDE NULLS (value FOR variable IN (price, acctbal))""",
    num="value",
    digits=2,
)
def _(spark, sf):
    return reshape.melt(class_frame(spark, sf), ["id"], ["price", "acctbal"])


SUMMARY_SQL = f"""SELECT n_estimators, depth, {', '.join(
    f"{fn}(scorer_value) FILTER (fold_type = '{t}' AND scorer = '{s}') AS {name}_{t}_{s}"
    for fn, name in (('avg', 'mean'), ('stddev_samp', 'std')) for t in ('test', 'train') for s in ('auc', 'acc'))}
  FROM ({SEARCH_SQL}) AS r GROUP BY ALL"""
SUMMARY_NUM = " ".join(f"{n}_{t}_{s}" for n in ("mean", "std") for t in ("test", "train") for s in ("auc", "acc"))


@query("pivot_search_results", SUMMARY_SQL, num=SUMMARY_NUM, digits=9)
def _(spark, sf):
    return reshape.pivot_scores(search_frame(spark, sf), ["n_estimators", "depth"], scorers=["auc", "acc"])


@query(
    "pivot_class_columns",
    """SELECT l_linenumber, max(q) FILTER (l_returnflag = 'A') AS "A", max(q) FILTER (l_returnflag = 'N') AS "N", max(q) FILTER (l_returnflag = 'R') AS "R"
    FROM (SELECT l_linenumber, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) AS g GROUP BY 1""",
)
def _(spark, sf):
    long = table(spark, sf, "lineitem").groupBy("l_linenumber", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return reshape.pivot_first(long, "l_linenumber", "l_returnflag", ["A", "N", "R"], "q")


@query("distinct_pairs", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    return reshape.distinct_pairs(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
