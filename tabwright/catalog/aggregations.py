"""Queries on descriptive aggregates."""

from pyspark.sql import functions as F

from tabwright.catalog.frames import CATEGORICAL, CLASS_SQL, ITEM_SQL, METRIC, SEARCH_SQL, class_frame, item_frame, search_frame, table
from tabwright.catalog.registry import query
from tabwright.operators import profile as A
from tabwright.operators.reshape import union_rows


def describe_sql(source: str, columns: list[str], by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS variable, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
        CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
        quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM ({source}) AS t {group}"""
        for c in columns
    )


def levels_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {c} AS value, count(*) AS n FROM ({source}) AS t GROUP BY {c}" for c in columns
    )


STATS = "mean std min q25 q50 q75 max"


@query("describe_numeric", describe_sql(CLASS_SQL, METRIC), num=STATS, digits=4)
def _(spark, sf):
    return A.describe_numeric(class_frame(spark, sf), METRIC)


@query("describe_numeric_by_group", describe_sql(ITEM_SQL, ["price", "discount", "quantity"], "target"), num=STATS, digits=4)
def _(spark, sf):
    return A.describe_numeric(item_frame(spark, sf), ["price", "discount", "quantity"], ["target"])


@query(
    "describe_categorical",
    f"""SELECT variable, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique", arg_min(value, rn) AS top, max(n) AS freq
    FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) AS rn
    FROM ({levels_sql(CLASS_SQL, CATEGORICAL)}) AS l WHERE value IS NOT NULL) AS r GROUP BY variable""",
)
def _(spark, sf):
    return A.describe_categorical(class_frame(spark, sf), CATEGORICAL)


@query(
    "top_values",
    f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, value) AS INTEGER) AS rank
    FROM ({levels_sql(CLASS_SQL, CATEGORICAL)}) AS l WHERE value IS NOT NULL) AS r WHERE rank <= 4""",
)
def _(spark, sf):
    return A.top_values(class_frame(spark, sf), CATEGORICAL, 4)


@query(
    "value_counts",
    f"""SELECT segment, count(*) AS n, count(*) / CAST((SELECT count(segment) FROM ({CLASS_SQL}) AS u) AS DOUBLE) AS share
    FROM ({CLASS_SQL}) AS t WHERE segment IS NOT NULL GROUP BY segment""",
    num="share",
)
def _(spark, sf):
    return A.value_counts(class_frame(spark, sf), "segment")


@query(
    "group_transform_mean",
    """SELECT o_orderkey, avg(o_totalprice) OVER (PARTITION BY o_custkey) AS fare_pp FROM orders""",
    num="fare_pp",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return A.group_transform(df, "o_custkey", "o_totalprice", "mean", "fare_pp").select("o_orderkey", "fare_pp")


@query(
    "group_transform_per_head",
    """SELECT o_orderkey, o_totalprice / count(o_totalprice) OVER (PARTITION BY o_custkey) AS fare_pp FROM orders""",
    num="fare_pp",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return A.group_transform(df, "o_custkey", "o_totalprice", "per_head", "fare_pp").select("o_orderkey", "fare_pp")


@query(
    "missing_share",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 3) AS share,
        round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 3) > 0.95 AS "drop" FROM
        (SELECT *, CASE WHEN id % 100 = 0 THEN price END AS rare FROM ({CLASS_SQL}) AS t) AS u"""
        for c in ["price", "acctbal", "segment", "status", "rare"]
    ),
    num="share",
)
def _(spark, sf):
    df = class_frame(spark, sf).withColumn("rare", F.when(F.col("id") % 100 == 0, F.col("price")))
    return A.missing_share(df, ["price", "acctbal", "segment", "status", "rare"])


@query(
    "level_counts",
    f"""SELECT variable, count(*) AS levels, count(*) > 10 AS toomany FROM ({levels_sql(CLASS_SQL, CATEGORICAL)}) AS l
    WHERE value IS NOT NULL GROUP BY variable""",
)
def _(spark, sf):
    return A.level_counts(class_frame(spark, sf), CATEGORICAL)


@query(
    "level_counts_with_null",
    f"""SELECT variable, count(*) AS levels, count(*) > 5 AS toomany FROM ({levels_sql(CLASS_SQL, CATEGORICAL)}) AS l
    GROUP BY variable""",
)
def _(spark, sf):
    return A.level_counts(class_frame(spark, sf), CATEGORICAL, n_top=5, count_null=True)


@query(
    "single_level_columns",
    """SELECT p_partkey, p_name AS name FROM part""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), F.lit("x").alias("flat"))
    return df.drop(*A.single_level_columns(df, ["name", "flat"]))


@query(
    "crosstab_shares",
    f"""SELECT linenumber AS level, n, "n_A", "n_N", "n_R", "n_A" / CAST(n AS DOUBLE) AS "share_A",
    "n_N" / CAST(n AS DOUBLE) AS "share_N", "n_R" / CAST(n AS DOUBLE) AS "share_R",
    100.0 * n / (SELECT count(*) FROM lineitem) AS pct, 0.9 * n / max(n) OVER () AS w
    FROM (SELECT linenumber, count(*) AS n, count(*) FILTER (target = 'A') AS "n_A", count(*) FILTER (target = 'N') AS "n_N",
    count(*) FILTER (target = 'R') AS "n_R" FROM ({ITEM_SQL}) AS t GROUP BY linenumber) AS c""",
    num="share_A share_N share_R pct w",
)
def _(spark, sf):
    return A.crosstab(item_frame(spark, sf), "linenumber", "target", ["A", "N", "R"])


@query(
    "target_profile",
    f"""SELECT segment AS level, avg(target) AS h, count(*) AS n, 100.0 * count(*) / (SELECT count(*) FROM orders) AS pct,
    0.9 * count(*) / max(count(*)) OVER () AS w, (SELECT avg(target) FROM ({CLASS_SQL}) AS p) AS prior
    FROM ({CLASS_SQL}) AS t WHERE segment IS NOT NULL GROUP BY segment""",
    num="h pct w prior",
)
def _(spark, sf):
    return A.target_profile(class_frame(spark, sf), "segment", "target")


@query(
    "run_spread",
    f"""SELECT n_estimators, avg(scorer_value) AS scorer_value_mean, stddev_samp(scorer_value) AS scorer_value_std,
    stddev_samp(scorer_value) / sqrt(count(scorer_value)) AS scorer_value_sem FROM ({SEARCH_SQL}) AS t GROUP BY n_estimators""",
    num="scorer_value_mean scorer_value_std scorer_value_sem",
    digits=9,
)
def _(spark, sf):
    return A.spread(search_frame(spark, sf), ["n_estimators"], "scorer_value")


@query(
    "class_priors",
    """SELECT l_returnflag AS label, count(*) AS n, count(*) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS prior
    FROM lineitem GROUP BY 1""",
    num="prior",
    digits=9,
)
def _(spark, sf):
    return A.class_priors(item_frame(spark, sf))


@query(
    "quantile_grid",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS variable, CAST(step AS INTEGER) AS step, q[step + 1] AS quantile, step / 10.0 AS prob
        FROM (SELECT unnest(range(11)) AS step, q FROM (SELECT quantile_cont({c},
        [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q FROM ({CLASS_SQL}) AS t) AS a) AS b"""
        for c in METRIC
    ),
    num="quantile prob",
    digits=4,
)
def _(spark, sf):
    return A.quantile_grid(class_frame(spark, sf), METRIC)


@query(
    "selection_counts",
    """SELECT 'variable' AS kind, l_returnflag AS name, count(*) AS n FROM kept GROUP BY 2 UNION ALL
    SELECT 'fold', rep || '/' || fold, count(*) FROM kept GROUP BY 2""".replace(
        "FROM kept",
        """FROM (SELECT l_linenumber AS rep, l_suppkey % 5 AS fold, l_returnflag FROM lineitem
        GROUP BY 1, 2, 3 HAVING avg(l_discount) > 0.05) AS kept""",
    ),
)
def _(spark, sf):
    kept = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_linenumber").alias("rep"), (F.col("l_suppkey") % 5).alias("fold"), F.col("l_returnflag").alias("variable"))
        .agg(F.avg("l_discount").alias("beta"))
        .filter("beta > 0.05")
    )
    per_variable, per_fold = A.selection_counts(kept)
    return union_rows(
        per_variable.select(F.lit("variable").alias("kind"), F.col("variable").alias("name"), "n"),
        per_fold.select(F.lit("fold").alias("kind"), F.concat_ws("/", "rep", "fold").alias("name"), "n"),
    )
