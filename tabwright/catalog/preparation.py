"""Queries on fit/transform stages, samples and splits."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabwright.catalog.frames import CATEGORICAL, CLASS_SQL, ITEM_SQL, METRIC, class_frame, item_frame, table
from tabwright.catalog.projections import scratch
from tabwright.catalog.registry import query
from tabwright.operators import encode, prepare, profile, sample, split
from tabwright.operators.features import feature_sets
from tabwright.operators.profile import too_many_levels

STEPS = ", ".join(str(i / 10) for i in range(11))


def bin_sql(column: str, source: str, n: int = 10, prefix: str = "q") -> str:
    """Scalar SQL expression: quantile bin of `column` with edges from `source`."""
    steps = ", ".join(str(i / n) for i in range(n + 1))
    edges = f"(SELECT list_sort(list_distinct(quantile_cont({column}, [{steps}]))) FROM ({source}) AS e)"
    return (
        f"CASE WHEN {column} IS NULL OR len({edges}) < 2 THEN NULL ELSE '{prefix}' || "
        f"printf('%02d', greatest(1, len(list_filter({edges}[1:len({edges}) - 1], lambda x: x < {column})))) END"
    )


ITEM_BINS = ["price", "quantity", "discount", "tax"]


@query("char_bins", f"SELECT id, {bin_sql('price', CLASS_SQL, 3, 'Cat_')} AS price_bin FROM ({CLASS_SQL}) AS t")
def _(spark, sf):
    return prepare.char_bins(class_frame(spark, sf), "price", 3, "Cat_", "price_bin").select("id", "price_bin")


@query(
    "binning_many_columns",
    f"""SELECT "price_BINNED", "quantity_BINNED", "discount_BINNED", "tax_BINNED", count(*) AS n FROM (SELECT
    {', '.join(f'''coalesce({bin_sql(c, ITEM_SQL)}, '(Missing)') AS "{c}_BINNED"''' for c in ITEM_BINS)}
    FROM ({ITEM_SQL}) AS t) AS b GROUP BY ALL""",
)
def _(spark, sf):
    df = item_frame(spark, sf)
    binned = prepare.Binning(ITEM_BINS, missing="(Missing)").fit(df).transform(df)
    return binned.groupBy(*[f"{c}_BINNED" for c in ITEM_BINS]).agg(F.count(F.lit(1)).alias("n"))


@query("single_bin_columns", f"SELECT id, {bin_sql('price', CLASS_SQL)} AS \"price_BINNED\" FROM ({CLASS_SQL}) AS t")
def _(spark, sf):
    df = class_frame(spark, sf).select("id", "price", F.lit(1.0).alias("flat"))
    model = prepare.Binning(["price", "flat"]).fit(df)
    return model.transform(df).drop("price", "flat", *model.single_bin_columns())


@query(
    "winsorize",
    f"""SELECT id, CASE WHEN price IS NOT NULL THEN least(greatest(price, p[1]), p[2]) END AS price,
    CASE WHEN acctbal IS NOT NULL THEN least(greatest(acctbal, a[1]), a[2]) END AS acctbal
    FROM ({CLASS_SQL}) AS t, (SELECT quantile_cont(price, [.02, .98]) AS p, quantile_cont(acctbal, [.02, .98]) AS a
    FROM ({CLASS_SQL}) AS s) AS q""",
    num="price acctbal",
    digits=4,
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", *METRIC)
    return prepare.Winsorize(METRIC, lower_quantile=0.02, upper_quantile=0.98).fit(df).transform(df)


@query(
    "winsorize_fresh",
    f"""SELECT id, CASE WHEN price IS NOT NULL THEN least(price, p) END AS price
    FROM ({CLASS_SQL}) AS t, (SELECT quantile_cont(price, .9) AS p FROM ({CLASS_SQL}) AS s WHERE year > 1998) AS q
    WHERE year > 1998""",
    num="price",
    digits=4,
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", "price", "year")
    model = prepare.Winsorize(["price"], fresh=True, upper_quantile=0.9).fit(df)
    return model.transform(df.filter("year > 1998")).select("id", "price")


@query(
    "zscale",
    f"""SELECT id, (price - avg(price) OVER ()) / stddev_samp(price) OVER () AS price,
    (acctbal - avg(acctbal) OVER ()) / stddev_samp(acctbal) OVER () AS acctbal FROM ({CLASS_SQL}) AS t""",
    num="price acctbal",
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", *METRIC)
    return prepare.Zscale(METRIC).fit(df).transform(df)


TOP_SQL = f"""(SELECT nation FROM ({CLASS_SQL}) AS c GROUP BY nation ORDER BY count(*) DESC, nation LIMIT 10)"""


@query(
    "lump_levels",
    f"""SELECT id, status, segment, CASE WHEN nation IN {TOP_SQL} THEN nation ELSE '_OTHER_' END AS nation
    FROM ({CLASS_SQL}) AS t""",
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", *CATEGORICAL)
    return encode.LumpLevels(CATEGORICAL, n_top=10).fit(df).transform(df)


def encoding_sql(source: str, column: str, target: str, flag: str) -> str:
    return f"""SELECT {column} AS level, CAST(row_number() OVER (ORDER BY avg({target}) DESC, {column}) AS DOUBLE) AS code
    FROM ({source}) AS e WHERE {flag} AND {column} IS NOT NULL GROUP BY {column}"""


FLAGGED = f"SELECT *, CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS encode_flag FROM ({CLASS_SQL}) AS f"


@query(
    "target_encoding",
    f"""SELECT id, coalesce(n.code, (SELECT median(code) FROM ({encoding_sql(FLAGGED, 'nation', 'target', 'encode_flag = 1')}) AS m1)) AS "nation_ENCODED",
    coalesce(s.code, (SELECT median(code) FROM ({encoding_sql(FLAGGED, 'segment', 'target', 'encode_flag = 1')}) AS m2)) AS "segment_ENCODED"
    FROM ({CLASS_SQL}) AS t
    LEFT JOIN ({encoding_sql(FLAGGED, 'nation', 'target', 'encode_flag = 1')}) AS n ON t.nation = n.level
    LEFT JOIN ({encoding_sql(FLAGGED, 'segment', 'target', 'encode_flag = 1')}) AS s ON t.segment = s.level""",
)
def _(spark, sf):
    df = class_frame(spark, sf).withColumn("encode_flag", (F.col("id") % 5 == 0).cast("int"))
    out = encode.TargetEncoding(["nation", "segment"]).fit(df).transform(df)
    return out.select("id", "nation_ENCODED", "segment_ENCODED")


@query(
    "target_encoding_regression",
    f"""SELECT id, coalesce(n.code, (SELECT median(code) FROM ({encoding_sql(FLAGGED, 'nation', 'price', 'encode_flag = 1 AND price IS NOT NULL')}) AS m1)) AS "nation_ENCODED"
    FROM ({CLASS_SQL}) AS t
    LEFT JOIN ({encoding_sql(FLAGGED, 'nation', 'price', 'encode_flag = 1 AND price IS NOT NULL')}) AS n ON t.nation = n.level""",
)
def _(spark, sf):
    df = class_frame(spark, sf).withColumn("encode_flag", (F.col("id") % 5 == 0).cast("int"))
    out = encode.TargetEncoding(["nation"], target="price", target_type="REGR").fit(df).transform(df)
    return out.select("id", "nation_ENCODED")


@query(
    "target_encoding_multiclass",
    f"""SELECT linenumber, n.code AS "linenumber_ENCODED", count(*) AS n FROM ({ITEM_SQL}) AS t
    JOIN ({encoding_sql(f"SELECT *, CASE WHEN target = (SELECT target FROM ({ITEM_SQL}) AS c GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) THEN 1 ELSE 0 END AS y FROM ({ITEM_SQL}) AS i", 'linenumber', 'y', 'quantity < 10')}) AS n
    ON t.linenumber = n.level WHERE quantity >= 10 GROUP BY ALL""",
)
def _(spark, sf):
    df = item_frame(spark, sf).withColumn("encode_flag", (F.col("quantity") < 10).cast("int"))
    out = encode.TargetEncoding(["linenumber"], remove_burned=True).fit(df).transform(df)
    return out.groupBy("linenumber", "linenumber_ENCODED").agg(F.count(F.lit(1)).alias("n"))


@query(
    "simple_impute",
    f"""SELECT id, coalesce(price, (SELECT quantile_cont(price, .5) FROM ({CLASS_SQL}) AS a)) AS price,
    coalesce(acctbal, (SELECT avg(acctbal) FROM ({CLASS_SQL}) AS b)) AS acctbal,
    coalesce(segment, (SELECT segment FROM ({CLASS_SQL}) AS c WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS segment,
    coalesce(segment, '(Missing)') AS segment_filled FROM ({CLASS_SQL}) AS t""",
    num="price acctbal",
    digits=4,
)
def _(spark, sf):
    df = class_frame(spark, sf).withColumn("segment_filled", F.col("segment"))
    stages = [
        prepare.SimpleImpute(["price"], "median"),
        prepare.SimpleImpute(["acctbal"], "mean"),
        prepare.SimpleImpute(["segment"], "most_frequent"),
        prepare.SimpleImpute(["segment_filled"], "constant"),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).select("id", *METRIC, "segment", "segment_filled")


def random_fill_sql(column: str) -> str:
    return f"""LEFT JOIN (SELECT r.id, d.value FROM
      (SELECT id, CAST('0x' || substr(md5(id || ':{column}:7'), 1, 15) AS BIGINT) % (SELECT count({column}) FROM ({CLASS_SQL}) AS n) AS pick
       FROM ({CLASS_SQL}) AS a WHERE {column} IS NULL) AS r
      JOIN (SELECT {column} AS value, row_number() OVER (ORDER BY md5(id || ':7'), id) - 1 AS idx FROM ({CLASS_SQL}) AS b WHERE {column} IS NOT NULL) AS d
      ON r.pick = d.idx) AS f_{column} ON t.id = f_{column}.id"""


@query(
    "random_impute",
    f"""SELECT t.id, coalesce(t.price, f_price.value) AS price, coalesce(t.acctbal, f_acctbal.value) AS acctbal
    FROM ({CLASS_SQL}) AS t {random_fill_sql('price')} {random_fill_sql('acctbal')}""",
    num="price acctbal",
    digits=2,
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", *METRIC)
    return sample.random_impute(df, METRIC, "id", seed=7)


@query(
    "map_unseen_levels",
    """SELECT o_orderkey, CASE WHEN level IN (SELECT level FROM train) THEN level
    ELSE (SELECT level FROM train GROUP BY level ORDER BY count(*) DESC, level LIMIT 1) END AS level FROM late""".replace(
        "FROM train", "FROM (SELECT 'c' || o_custkey % 50 AS level FROM orders WHERE o_custkey % 50 <> 7) AS train"
    ).replace("FROM late", "FROM (SELECT o_orderkey, 'c' || o_custkey % 60 AS level FROM orders) AS late"),
)
def _(spark, sf):
    orders = table(spark, sf, "orders")

    def levels(n):
        return orders.select("o_orderkey", F.concat(F.lit("c"), (F.col("o_custkey") % n).cast("string")).alias("level"))

    model = encode.MapUnseen(["level"]).fit(levels(50).filter("level <> 'c7'"))
    return model.transform(levels(60))


MAP_ROWS = f"""SELECT 0 AS ord, 'price' AS variable, CAST(NULL AS VARCHAR) AS value UNION ALL SELECT 1, 'acctbal', NULL
  UNION ALL SELECT DISTINCT 2, 'status', status FROM ({CLASS_SQL}) AS a
  UNION ALL SELECT DISTINCT 3, 'nation', nation FROM ({CLASS_SQL}) AS b"""
MAP_SQL = f"""SELECT CAST(row_number() OVER (ORDER BY ord, value) - 1 AS INTEGER) AS position, variable, value FROM ({MAP_ROWS}) AS r"""


def complete_frame(spark, sf):
    return class_frame(spark, sf).fillna(0.0, METRIC)


@query("design_map", MAP_SQL)
def _(spark, sf):
    df = complete_frame(spark, sf)
    return encode.DesignMatrix(METRIC, ["status", "nation"]).fit(df).map_frame(df)


LONG_SQL = f"""SELECT id, position, x AS value FROM (
    SELECT id, 0 AS position, coalesce(price, 0) AS x FROM ({CLASS_SQL}) AS t
    UNION ALL SELECT id, 1, coalesce(acctbal, 0) FROM ({CLASS_SQL}) AS t
    UNION ALL SELECT id, m.position, 1.0 FROM ({CLASS_SQL}) AS t JOIN ({MAP_SQL}) AS m
    ON (m.variable = 'status' AND m.value = t.status) OR (m.variable = 'nation' AND m.value = t.nation)) AS u WHERE x <> 0"""


@query(
    "design_matrix_long",
    LONG_SQL,
    num="value",
    digits=2,
)
def _(spark, sf):
    df = complete_frame(spark, sf)
    return encode.DesignMatrix(METRIC, ["status", "nation"]).fit(df).long(df, "id")


@query(
    "design_matrix_vector",
    f"SELECT position, sum(value) AS total, count(*) AS n FROM ({LONG_SQL}) AS l GROUP BY position",
    num="total",
    digits=1,
)
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array

    df = complete_frame(spark, sf)
    out = encode.DesignMatrix(METRIC, ["status", "nation"]).fit(df).transform(df)
    cells = out.select("id", F.posexplode(vector_to_array("features")).alias("position", "value"))
    return cells.groupBy("position").agg(F.sum("value").alias("total"), F.count_if(F.col("value") != 0).alias("n"))


@query(
    "undersample",
    f"""SELECT id, target FROM (SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY md5(id || ':42'), id) AS rn
    FROM ({CLASS_SQL}) AS t) AS r WHERE rn <= 500""",
)
def _(spark, sf):
    df = class_frame(spark, sf).select("id", "target")
    return sample.Undersample(500).fit(df).sample(df)


@query(
    "undersample_priors",
    f"""SELECT target, avg(n) / sum(avg(n)) OVER () AS b_all, least(500, avg(n)) / sum(least(500, avg(n))) OVER () AS b_sample
    FROM (SELECT target, count(*) AS n FROM ({CLASS_SQL}) AS t GROUP BY target) AS c GROUP BY target""",
    num="b_all b_sample",
    digits=9,
)
def _(spark, sf):
    model = sample.Undersample(500).fit(class_frame(spark, sf))
    rows = list(zip(model.getOrDefault("labels"), model.b_all, model.b_sample))
    return spark.createDataFrame(rows, "target int, b_all double, b_sample double")


@query(
    "feature_sets",
    f"""SELECT list, variable FROM (
    SELECT 'metr_standard' AS list, unnest(['price', 'acctbal', 'nation_ENCODED']) AS variable
    UNION ALL SELECT 'cate_standard', unnest(['status', 'segment', 'nation', 'MISS_price', 'MISS_acctbal'])
    UNION ALL SELECT 'cate_binned', unnest(['price_BINNED', 'acctbal_BINNED', 'status', 'segment', 'nation'])
    UNION ALL SELECT 'metr_encoded', unnest(['price', 'acctbal', 'status_ENCODED', 'segment_ENCODED', 'nation_ENCODED',
    'MISS_price_ENCODED', 'MISS_acctbal_ENCODED'])) AS l
    WHERE (SELECT count(DISTINCT nation) > 10 AND count(DISTINCT segment) <= 10 AND count(*) > count(price) FROM ({CLASS_SQL}) AS t)""",
)
def _(spark, sf):
    from tabwright.functions.scalars import columns_with_missing

    df = class_frame(spark, sf)
    onebin = prepare.Binning(METRIC).fit(df).single_bin_columns()
    sets = feature_sets(METRIC, CATEGORICAL, too_many_levels(df, CATEGORICAL), columns_with_missing(df, METRIC), onebin)
    rows = [(k, v) for k, vs in vars(sets).items() for v in vs]
    return spark.createDataFrame(rows, "list string, variable string")


@query(
    "etl_stages_saved",
    f"""WITH base AS (SELECT id, target, coalesce(price, (SELECT quantile_cont(price, .5) FROM ({CLASS_SQL}) AS p)) AS price,
      coalesce(segment, '(Missing)') AS segment, nation, CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS encode_flag FROM ({CLASS_SQL}) AS t)
    SELECT b.id, price, n.code AS "nation_ENCODED", s.code AS "segment_ENCODED", segment,
      CASE WHEN nation IN {TOP_SQL} THEN nation ELSE '_OTHER_' END AS nation FROM base AS b
    JOIN ({encoding_sql('SELECT * FROM base', 'nation', 'target', 'encode_flag = 1')}) AS n ON b.nation = n.level
    JOIN ({encoding_sql('SELECT * FROM base', 'segment', 'target', 'encode_flag = 1')}) AS s ON b.segment = s.level""",
    num="price",
    digits=4,
)
def _(spark, sf):
    df = class_frame(spark, sf).withColumn("encode_flag", (F.col("id") % 5 == 0).cast("int"))
    cate = ["segment", "nation"]
    stages = [
        prepare.Convert(cate, "str"),
        prepare.Convert(["price"], "float"),
        prepare.SimpleImpute(cate, "constant"),
        encode.MapUnseen(cate),
        encode.TargetEncoding(cate),
        encode.LumpLevels(cate),
        prepare.SimpleImpute(["price"], "median"),
        sample.Undersample(500),
    ]
    path = scratch(spark)
    Pipeline(stages=stages).fit(df).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(df)
    return out.select("id", "price", "nation_ENCODED", "segment_ENCODED", "segment", "nation")


# --- folds, samples, splits --------------------------------------------------------------------------


def order_sql(seed: str, key: str = "o_orderkey", by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"row_number() OVER ({part} ORDER BY md5({key} || ':{seed}'), {key}) - 1"


FOLD_SQL = f"""SELECT o_orderkey, CASE WHEN idx <= 0.1 * (n - 1) THEN 'util' WHEN idx <= 0.8 * (n - 1) THEN 'train' ELSE 'test' END AS fold
  FROM (SELECT o_orderkey, {order_sql('123')} AS idx, count(*) OVER () AS n FROM orders) AS i"""


def orders_with_fold(spark, sf):
    return sample.assign_fold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 123)


@query("assign_fold", FOLD_SQL)
def _(spark, sf):
    return orders_with_fold(spark, sf)


@query(
    "time_fold",
    f"""SELECT o_orderkey, CASE WHEN fold = 'train' AND idx < round_even(0.1 * n, 0) THEN 'util' ELSE fold END AS fold
    FROM (SELECT *, {order_sql('123', by='fold')} AS idx, count(*) OVER (PARTITION BY fold) AS n FROM (SELECT o_orderkey,
    CASE WHEN year(o_orderdate) = 2001 THEN 'test' ELSE 'train' END AS fold FROM orders) AS f) AS i""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return sample.time_fold(orders, F.year("o_orderdate") == 2001, "o_orderkey", 123).select("o_orderkey", "fold")


@query(
    "bernoulli_flag",
    """SELECT o_orderkey, CAST(CAST('0x' || substr(md5(o_orderkey || ':1234'), 1, 8) AS BIGINT) / 4294967296.0 < 0.2 AS INTEGER) AS encode_flag
    FROM orders""",
)
def _(spark, sf):
    return sample.bernoulli_flag(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 1234)


@query(
    "fold_flags",
    f"""SELECT o_orderkey, fold, CAST(fold = 'test' AS INTEGER) AS fold_num, CAST(fold = 'util' AS INTEGER) AS encode_flag FROM ({FOLD_SQL}) AS f""",
)
def _(spark, sf):
    return sample.fold_flags(orders_with_fold(spark, sf))


@query("remove_burned_rows", f"SELECT * FROM ({FOLD_SQL}) AS f WHERE fold <> 'util'")
def _(spark, sf):
    return sample.remove_burned(orders_with_fold(spark, sf))


def chunk_sql(k: int) -> str:
    return f"""CAST(CASE WHEN idx < (n % {k}) * (n // {k} + 1) THEN idx // (n // {k} + 1)
    ELSE n % {k} + (idx - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS INTEGER)"""


CHUNKED_SQL = f"""SELECT o_orderkey, fold, idx, n, {chunk_sql(5)} AS chunk FROM (SELECT o_orderkey, fold, {order_sql('42', by='fold')} AS idx,
  count(*) OVER (PARTITION BY fold) AS n FROM ({FOLD_SQL}) AS f WHERE fold <> 'util') AS i"""


@query(
    "split_separate_folds",
    f"""SELECT CAST(s AS INTEGER) AS split, fold AS role, o_orderkey FROM ({CHUNKED_SQL}) AS c JOIN (SELECT unnest(range(5)) AS s) AS r
    ON (fold = 'test' AND chunk = s) OR (fold = 'train' AND chunk <> s)""",
)
def _(spark, sf):
    return split.separate_split_table(orders_with_fold(spark, sf), "o_orderkey", 5)


@query(
    "split_bootstrap",
    f"""SELECT CAST(rep - 1 AS INTEGER) AS split, d.fold AS role, c.o_orderkey, count(*) AS multiplicity FROM
    (SELECT fold, rep, CAST('0x' || substr(md5(idx || ':' || rep * 42 || ':draw'), 1, 15) AS BIGINT) % n AS pick
     FROM ({CHUNKED_SQL}) AS a, (SELECT unnest(range(1, 4)) AS rep) AS r) AS d
    JOIN ({CHUNKED_SQL}) AS c ON c.fold = d.fold AND c.idx = d.pick GROUP BY ALL""",
)
def _(spark, sf):
    return split.bootstrap_table(orders_with_fold(spark, sf), "o_orderkey", 3)


@query(
    "split_k_fold",
    f"SELECT o_orderkey, {chunk_sql(5)} AS fold FROM (SELECT o_orderkey, {order_sql('42')} AS idx, count(*) OVER () AS n FROM orders) AS i",
)
def _(spark, sf):
    return split.k_fold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "split_repeated_k_fold",
    f"""SELECT rep, CAST({chunk_sql(5)} + 1 AS INTEGER) AS fold, o_orderkey FROM (SELECT o_orderkey, CAST(rep AS INTEGER) AS rep,
    row_number() OVER (PARTITION BY rep ORDER BY md5(o_orderkey || ':' || rep || ':42'), o_orderkey) - 1 AS idx,
    count(*) OVER (PARTITION BY rep) AS n FROM orders, (SELECT unnest(range(1, 4)) AS rep) AS r) AS i""",
)
def _(spark, sf):
    return split.repeated_k_fold(table(spark, sf, "orders"), "o_orderkey", 5, 3)


@query(
    "split_shuffle",
    f"""SELECT o_orderkey, CASE WHEN idx < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS role
    FROM (SELECT o_orderkey, {order_sql('999')} AS idx, count(*) OVER () AS n FROM orders) AS i""",
)
def _(spark, sf):
    return split.shuffle_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "sample_rows",
    f"SELECT o_orderkey, o_totalprice FROM (SELECT *, {order_sql('5')} AS idx FROM orders) AS i WHERE idx < 5000",
)
def _(spark, sf):
    return sample.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 5000, 5)


@query(
    "learning_curve_subsets",
    f"""SELECT o_orderkey, CAST(CASE {' '.join(f'WHEN idx < floor({s} * n) THEN {i}' for i, s in enumerate(split.LEARNING_SHARES))} END AS INTEGER) AS step
    FROM (SELECT o_orderkey, {order_sql('42')} AS idx, count(*) OVER () AS n FROM orders) AS i""",
)
def _(spark, sf):
    return split.learning_subsets(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "worst_best_random_rows",
    f"""SELECT o_orderkey, o_totalprice FROM (SELECT *, {order_sql('9')} AS idx, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS hi,
    row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS lo FROM orders) AS i WHERE idx < 11 OR hi <= 10 OR lo <= 10""",
    num="o_totalprice",
    digits=2,
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sample.worst_best_random(orders, "o_totalprice", "o_orderkey", 10, 11, 9)


@query(
    "worst_best_with_nulls",
    """SELECT o_orderkey, v FROM (SELECT o_orderkey, v, row_number() OVER (ORDER BY v DESC NULLS LAST, o_orderkey) AS hi,
    row_number() OVER (ORDER BY v NULLS LAST, o_orderkey) AS lo
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v FROM orders) AS o) AS i WHERE hi <= 10 OR lo <= 10""",
    num="v",
    digits=2,
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("v"))
    return profile.bottom_and_top(orders, "v", "o_orderkey", 10)
