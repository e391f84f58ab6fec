"""Queries on sources, projections, filters and scalar functions."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.catalog.frames import (
    CATEGORICAL,
    CLASS_SQL,
    ITEM_SQL,
    METRIC,
    REGR_SQL,
    SCORED3_SQL,
    SCORED_SQL,
    class_frame,
    item_frame,
    regr_frame,
    scored3_frame,
    scored_frame,
    table,
)
from tabwright.catalog.registry import query
from tabwright.functions import predictions as P
from tabwright.functions import scalars as S
from tabwright.operators.features import DeriveFeatures
from tabwright.schema import kept_metadata, normalise_names, rename_derived, setdiff, setdiff_rows
from tabwright.session import checkpoint_dir
from tabwright.sources import handoff
from tabwright.sources.tables import read_headerless, read_meta, read_names, read_table, read_tsv, row_slice, with_row_id, write_csv


def scratch(spark) -> str:
    """A new folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base}/scratch-{uuid.uuid4().hex}"


CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("read_csv_with_header", "SELECT * FROM customer", num="c_acctbal", digits=2)
def _(spark, sf):
    path = scratch(spark)
    write_csv(table(spark, sf, "customer"), path)
    return read_table(spark, path, CUSTOMER_SCHEMA)


@query(
    "read_tsv_names",
    'SELECT p_partkey AS part_key, p_name AS part_name, p_size AS "size" FROM part',
)
def _(spark, sf):
    path = scratch(spark)
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size").toDF("part key", "part name", "size")
    part.write.option("header", True).option("sep", "\t").csv(path)
    return read_tsv(spark, path, "`part key` long, `part name` string, size int")


@query(
    "read_headerless_names",
    "SELECT s_suppkey, ' ' || s_name AS s_name, s_nationkey, s_acctbal FROM supplier",
    num="s_acctbal",
    digits=2,
)
def _(spark, sf):
    path = scratch(spark)
    supplier = table(spark, sf, "supplier")
    names = spark.createDataFrame([(f"{c}\t",) for c in supplier.columns], "value string")
    names.coalesce(1).write.text(f"{path}/names")
    supplier.withColumn("s_name", F.concat(F.lit(" "), "s_name")).write.option(
        "ignoreLeadingWhiteSpace", False
    ).csv(f"{path}/data")
    types = {"s_suppkey": T.LongType(), "s_nationkey": T.IntegerType(), "s_acctbal": T.DoubleType()}
    return read_headerless(spark, f"{path}/data", read_names(spark, f"{path}/names"), types)


META_SQL = """SELECT p_name AS variable, min(p_brand) AS category,
  CASE WHEN min(p_size) % 3 = 0 THEN 'ready' WHEN min(p_size) % 3 = 1 THEN 'derive' ELSE 'drop' END AS status,
  CASE WHEN max(p_size) % 2 = 0 THEN 'metr' ELSE 'nomi' END AS type FROM part GROUP BY p_name"""


def meta_frame(spark, sf):
    low, high = F.min("p_size"), F.max("p_size")
    return (
        table(spark, sf, "part")
        .groupBy(F.col("p_name").alias("variable"))
        .agg(
            F.min("p_brand").alias("category"),
            F.when(low % 3 == 0, "ready").when(low % 3 == 1, "derive").otherwise("drop").alias("status"),
            F.when(high % 2 == 0, "metr").otherwise("nomi").alias("type"),
        )
    )


@query("read_meta_filter", f"SELECT * FROM ({META_SQL}) AS m WHERE status IN ('ready', 'derive')")
def _(spark, sf):
    path = scratch(spark)
    write_csv(meta_frame(spark, sf), path)
    return read_meta(spark, path)


@query(
    "schema_setdiff",
    f"""SELECT 'unknown' AS side, t.p_name AS variable FROM (SELECT DISTINCT p_name FROM part) AS t
    WHERE p_name NOT IN (SELECT variable FROM ({META_SQL}) AS m WHERE status <> 'drop')
    UNION ALL SELECT 'absent', variable FROM ({META_SQL}) AS m
    WHERE variable NOT IN (SELECT p_name FROM part WHERE p_type <> 'PROMO')""",
)
def _(spark, sf):
    meta, part = meta_frame(spark, sf), table(spark, sf, "part").withColumnRenamed("p_name", "variable")
    unknown = setdiff_rows(part.select("variable").distinct(), kept_metadata(meta), "variable")
    absent = setdiff_rows(meta, part.filter("p_type <> 'PROMO'"), "variable").select("variable")
    return unknown.select(F.lit("unknown").alias("side"), "variable").unionByName(
        absent.select(F.lit("absent").alias("side"), "variable")
    )


@query("stage_handoff", f"SELECT id, price, segment, target FROM ({CLASS_SQL}) AS t", num="price", digits=2)
def _(spark, sf):
    path = scratch(spark)
    sets = handoff.FeatureSets(metr_standard=["price"], cate_standard=["segment"], target_labels=["0", "1"])
    handoff.save_stage(class_frame(spark, sf), sets, path)
    df, loaded = handoff.load_stage(spark, path)
    return df.select("id", *loaded.metr_standard, *loaded.cate_standard, "target")


@query(
    "positional_slice",
    """SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) AS t
    WHERE rn > 1000""",
)
def _(spark, sf):
    return row_slice(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 1000)


@query("row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS id FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_row_id(orders, ["o_totalprice", "o_orderkey"]).select("o_orderkey", F.col("id").cast("long"))


@query(
    "convert_types",
    """SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS qty, nullif(nan_text, 'nan') AS nan_text, CAST(l_linenumber AS VARCHAR) AS line
    FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN 'nan' ELSE l_returnflag END AS nan_text FROM lineitem) AS t""",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").cast("string").alias("qty"),
        F.when(F.col("l_linenumber") == 3, "nan").otherwise(F.col("l_returnflag")).alias("nan_text"),
        F.col("l_linenumber").alias("line"),
    )
    return S.convert(S.convert(df, ["qty"], "float"), ["nan_text", "line"], "str")


@query(
    "zero_to_missing",
    "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")
    )
    return S.zero_to_missing(df, ["discount", "tax"])


@query("fill_missing_level", f"SELECT id, coalesce(segment, '(Missing)') AS segment FROM ({CLASS_SQL}) AS t")
def _(spark, sf):
    return S.fill_level(class_frame(spark, sf).select("id", "segment"), ["segment"])


@query(
    "missing_indicator",
    f"""SELECT id, CASE WHEN price IS NULL THEN 'miss' ELSE 'no_miss' END AS "MISS_price",
    CASE WHEN acctbal IS NULL THEN 'miss' ELSE 'no_miss' END AS "MISS_acctbal",
    CAST(price IS NULL AS INTEGER) AS "MISS_price_ENCODED", CAST(acctbal IS NULL AS INTEGER) AS "MISS_acctbal_ENCODED"
    FROM ({CLASS_SQL}) AS t""",
)
def _(spark, sf):
    df = class_frame(spark, sf)
    miss = S.columns_with_missing(df, [*METRIC, "year"])
    return S.missing_indicator(df, miss, encoded=True).select(
        "id", "MISS_price", "MISS_acctbal", "MISS_price_ENCODED", "MISS_acctbal_ENCODED"
    )


@query(
    "zero_pad",
    """SELECT c_custkey, CASE WHEN length(CAST(c_nationkey AS VARCHAR)) < 2
    THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
    CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 2 THEN lpad(CAST(c_custkey AS VARCHAR), 2, '0')
    ELSE CAST(c_custkey AS VARCHAR) END AS cust FROM customer""",
)
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        S.zero_pad(F.col("c_nationkey").cast("string")).alias("nation"),
        S.zero_pad(F.col("c_custkey").cast("string")).alias("cust"),
    )


@query("prefix_extract", "SELECT p_partkey, substring(p_name, 1, 1) AS deck FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", S.prefix("p_name").alias("deck"))


@query("arithmetic_derive", "SELECT p_partkey, CAST(p_size + p_partkey % 7 + 1 AS INTEGER) AS familysize FROM part")
def _(spark, sf):
    part = table(spark, sf, "part").withColumn("parch", F.col("p_partkey") % 7)
    return part.select("p_partkey", S.family_size("p_size", "parch").alias("familysize"))


@query(
    "shifted_log",
    """SELECT c_custkey, ln(c_acctbal - least(0, (SELECT min(c_acctbal) FROM customer)) + 1) AS "c_acctbal_LOG_",
    ln(c_nationkey - least(0, (SELECT min(c_nationkey) FROM customer)) + 1) AS "c_nationkey_LOG_" FROM customer""",
    num="c_acctbal_LOG_ c_nationkey_LOG_",
)
def _(spark, sf):
    out = S.shifted_log(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])
    return out.select("c_custkey", "c_acctbal_LOG_", "c_nationkey_LOG_")


@query(
    "value_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0.5 WHEN 'O' THEN 1.5 END AS code,
    CASE o_orderstatus WHEN 'F' THEN 10 ELSE -1 END AS code_default FROM orders""",
    num="code",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        S.map_values("o_orderstatus", {"F": 0.5, "O": 1.5}).alias("code"),
        S.map_values("o_orderstatus", {"F": 10}, default=-1).alias("code_default"),
    )


@query(
    "rename_derived",
    'SELECT p_partkey, p_size AS "size_LOG__BINNED", p_retailprice AS "price_BINNED" FROM part',
)
def _(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").alias("size_BINNED"), F.col("p_retailprice").alias("price_BINNED")
    )
    return rename_derived(df, ["size"])


@query(
    "min_max_scale",
    f"""SELECT id, (price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()) AS price,
    (year - min(year) OVER ()) / (max(year) OVER () - min(year) OVER ()) AS year, CAST(NULL AS DOUBLE) AS flat
    FROM ({CLASS_SQL}) AS t""",
    num="price year flat",
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", "price", "year", F.lit(1.0).alias("flat"))
    return S.min_max_scale(df, ["price", "year", "flat"])


@query(
    "fixed_cut",
    """SELECT l_orderkey, l_linenumber, l_quantity,
    CASE WHEN l_quantity <= 10 THEN 'low' WHEN l_quantity <= 40 THEN 'medium' ELSE 'high' END AS category FROM lineitem""",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", S.fixed_cut("l_quantity", (10.0, 40.0)).alias("category")
    )


@query(
    "inverse_logit",
    "SELECT event_id, 1 / (1 + exp(-(value - 50) / 20)) AS p FROM events",
    num="p",
)
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", P.inv_logit((F.col("value") - 50) / 20).alias("p"))


@query(
    "scale_predictions",
    f"""SELECT target, p0 * .2 / .5 / t AS q0, p1 * .5 / .3 / t AS q1, p2 * .3 / .2 / t AS q2
    FROM (SELECT *, p0 * .2 / .5 + p1 * .5 / .3 + p2 * .3 / .2 AS t FROM ({SCORED3_SQL}) AS s) AS u""",
    num="q0 q1 q2",
    digits=9,
)
def _(spark, sf):
    q = P.scale_predictions("yhat", b_sample=[0.5, 0.3, 0.2], b_all=[0.2, 0.5, 0.3])
    return scored3_frame(spark, sf).withColumn("q", q).select(
        "target", *[F.col("q")[i].alias(f"q{i}") for i in range(3)]
    )


@query(
    "scale_predictions_binary",
    f"SELECT id, p * .2 / .5 / (p * .2 / .5 + (1 - p) * .8 / .5) AS q FROM ({SCORED_SQL}) AS s",
    num="q",
    digits=9,
)
def _(spark, sf):
    return scored_frame(spark, sf).select("id", P.scale_binary("p", [0.5, 0.5], [0.8, 0.2]).alias("q"))


@query("row_filter", f"SELECT id, price FROM ({CLASS_SQL}) AS t WHERE year <> 1998", num="price", digits=2)
def _(spark, sf):
    return class_frame(spark, sf).filter("year <> 1998").select("id", "price")


@query(
    "residuals_class",
    f"""SELECT target, r AS residual, abs(r) AS abs_residual
    FROM (SELECT target, 1 - CASE target WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS r FROM ({SCORED3_SQL}) AS s) AS u""",
    num="residual abs_residual",
    digits=9,
)
def _(spark, sf):
    return P.with_residuals(scored3_frame(spark, sf), target_type="MULTICLASS").drop("yhat")


@query(
    "residuals_regression",
    f"""SELECT y, y - yhat AS residual, abs(y - yhat) AS abs_residual, abs(y - yhat) / abs(y) AS rel_residual
    FROM ({REGR_SQL}) AS s""",
    num="residual abs_residual rel_residual",
)
def _(spark, sf):
    return P.with_residuals(regr_frame(spark, sf), y="y", target_type="REGR").drop("yhat")


@query(
    "label_encode",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    return P.with_label_codes(orders, "o_orderpriority").select("o_orderkey", "code")


@query(
    "one_hot_target",
    f"""SELECT target, CAST(target = 0 AS INTEGER) AS y0, CAST(target = 1 AS INTEGER) AS y1, CAST(target = 2 AS INTEGER) AS y2
    FROM ({SCORED3_SQL}) AS s""",
)
def _(spark, sf):
    df = scored3_frame(spark, sf).select("target", P.one_hot("target", 3).alias("y"))
    return df.select("target", *[F.col("y")[i].alias(f"y{i}") for i in range(3)])


@query(
    "label_text",
    f"""SELECT target || ' (' || printf('%.1f', 100.0 * count(*) / (SELECT count(*) FROM lineitem)) || '%)' AS level_label,
    'quantity (' || count(DISTINCT quantity) || ')' AS count_label,
    'discount (NA: ' || printf('%.1f', 100.0 * avg(CAST(discount IS NULL AS INTEGER))) || '%)' AS missing_label
    FROM ({ITEM_SQL}) AS t GROUP BY target""",
)
def _(spark, sf):
    df = item_frame(spark, sf)
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.groupBy("target")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("quantity").alias("levels"),
            F.avg(F.col("discount").isNull().cast("int")).alias("missing"),
        )
        .select(
            S.percent_label(F.col("target"), F.col("n") / total).alias("level_label"),
            S.count_label(F.lit("quantity"), F.col("levels")).alias("count_label"),
            S.missing_label(F.lit("discount"), F.col("missing")).alias("missing_label"),
        )
    )


@query(
    "derive_features",
    """SELECT o.o_orderkey, substring(o.o_orderpriority, 1, 1) AS deck, CAST(o.o_custkey % 5 + o.o_orderkey % 3 + 1 AS INTEGER) AS familysize,
    m.mean AS fare_pp FROM orders AS o JOIN (SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY 1) AS m
    ON o.o_custkey = m.o_custkey""",
    num="fare_pp",
)
def _(spark, sf):
    passengers = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("cabin"),
        (F.col("o_custkey") % 5).alias("sibsp"),
        (F.col("o_orderkey") % 3).alias("parch"),
        F.col("o_custkey").alias("ticket"),
        F.col("o_totalprice").alias("fare"),
    )
    return DeriveFeatures().transform(passengers).select("o_orderkey", "deck", "familysize", "fare_pp")


@query(
    "read_missing_tokens",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN ' ' || c_name || ' ' END AS c_name,
    CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal FROM customer""",
    num="c_acctbal",
    digits=2,
)
def _(spark, sf):
    path = scratch(spark)
    key = F.col("c_custkey")
    text = F.when(key % 3 == 0, F.element_at(F.array(*map(F.lit, ("NA", "NULL", "nan"))), (key % 9 / 3 + 1).cast("int"))).otherwise(F.concat(F.lit(" "), "c_name", F.lit(" ")))
    number = F.when(key % 4 == 0, F.element_at(F.array(*map(F.lit, ("NA", "NaN"))), (key % 8 / 4 + 1).cast("int"))).otherwise(F.col("c_acctbal").cast("string"))
    out = table(spark, sf, "customer").select("c_custkey", text.alias("c_name"), number.alias("c_acctbal"))
    out.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_table(spark, path, "c_custkey long, c_name string, c_acctbal double")
