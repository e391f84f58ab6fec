"""Queries on metrics, curves, association, importance and densities."""

from itertools import combinations

from pyspark.sql import functions as F

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
from tabwright.catalog.preparation import bin_sql
from tabwright.catalog.registry import ORACLE, query
from tabwright.functions.predictions import argmax, top_classes
from tabwright.functions.ranks import mean_rank
from tabwright.operators import assoc, curves, density, metrics
from tabwright.operators.importance import fold_drift, univariate_importance
from tabwright.operators.reshape import union_rows
from tabwright.operators.sample import fold_flags


def rank_sql(column: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    tied = f"PARTITION BY {by}, {column}" if by else f"PARTITION BY {column}"
    return f"(rank() OVER ({part} ORDER BY {column}) + (count(*) OVER ({tied}) - 1) / 2.0)"


def spear_sql(source: str, y: str, x: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}corr(ry, rx) AS spear FROM (SELECT {lead}{rank_sql(y, by)} AS ry, {rank_sql(x, by)} AS rx
    FROM ({source}) AS s WHERE {y} IS NOT NULL AND {x} IS NOT NULL) AS r {'GROUP BY ' + by if by else ''}"""


def auc_sql(source: str, y: str, p: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}(sum(CASE WHEN {y} = 1 THEN r ELSE 0 END) - sum({y}) * (sum({y}) + 1) / 2.0)
    / (CAST(sum({y}) AS DOUBLE) * (count(*) - sum({y}))) AS auc
    FROM (SELECT {lead}{y}, {rank_sql(p, by)} AS r FROM ({source}) AS s) AS ranked {'GROUP BY ' + by if by else ''}"""


CLASSES_SQL = " UNION ALL ".join(
    f"SELECT {k} AS class, CAST(target = {k} AS INTEGER) AS is_class, p{k} AS p FROM ({SCORED3_SQL}) AS s{k}" for k in range(3)
)
PRED3 = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"


@query(
    "mean_ranks",
    f"SELECT DISTINCT l_quantity, count(*) OVER (PARTITION BY l_quantity) AS n, {rank_sql('l_quantity')} AS rank FROM lineitem",
    num="rank",
    digits=1,
)
def _(spark, sf):
    return mean_rank(table(spark, sf, "lineitem"), "l_quantity").select("l_quantity", "n", "rank")


@query("spearman", spear_sql(REGR_SQL, "y", "yhat"), num="spear", digits=9)
def _(spark, sf):
    return metrics.spear(regr_frame(spark, sf), "y", "yhat")


@query("rmse", f"SELECT sqrt(avg((y - yhat) * (y - yhat))) AS rmse FROM ({REGR_SQL}) AS s", num="rmse", digits=4)
def _(spark, sf):
    return metrics.rmse(regr_frame(spark, sf), "y", "yhat")


@query("auc_binary", auc_sql(SCORED_SQL, "target", "p"), num="auc", digits=9)
def _(spark, sf):
    return metrics.auc(scored_frame(spark, sf))


@query(
    "auc_one_vs_rest",
    f"""SELECT avg(auc) AS auc, sum(auc * n) / sum(n) AS auc_weighted FROM ({auc_sql(CLASSES_SQL, 'is_class', 'p', 'class')}) AS a
    JOIN (SELECT target, count(*) AS n FROM ({SCORED3_SQL}) AS c GROUP BY 1) AS w ON a.class = w.target""",
    num="auc auc_weighted",
    digits=9,
)
def _(spark, sf):
    return metrics.auc_multiclass(scored3_frame(spark, sf))


@query("accuracy", f"SELECT avg(CASE WHEN target = {PRED3} THEN 1.0 ELSE 0.0 END) AS acc FROM ({SCORED3_SQL}) AS s", num="acc", digits=9)
def _(spark, sf):
    return metrics.acc(scored3_frame(spark, sf))


THRESHOLD_SQL = f"""SELECT p AS threshold, pos, tp, fp, CAST(tp AS DOUBLE) / pt AS tpr, CAST(fp AS DOUBLE) / nt AS fpr,
  CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp + fp AS DOUBLE) / (pt + nt) AS pct_tested, pt FROM (
  SELECT p, pos, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp, sum(pos) OVER () AS pt, sum(neg) OVER () AS nt
  FROM (SELECT p, sum(target) AS pos, sum(1 - target) AS neg FROM ({SCORED_SQL}) AS s GROUP BY p) AS g) AS w"""


@query("roc_curve", f"SELECT threshold, fpr, tpr FROM ({THRESHOLD_SQL}) AS t", num="threshold fpr tpr", digits=9)
def _(spark, sf):
    return curves.roc_curve(curves.threshold_frame(scored_frame(spark, sf)))


@query(
    "precision_recall_curve",
    f"SELECT threshold, tpr AS recall, precision FROM ({THRESHOLD_SQL}) AS t",
    num="threshold recall precision",
    digits=9,
)
def _(spark, sf):
    return curves.pr_curve(curves.threshold_frame(scored_frame(spark, sf)))


@query(
    "average_precision",
    f"SELECT sum(CAST(pos AS DOUBLE) / pt * precision) AS average_precision FROM ({THRESHOLD_SQL}) AS t",
    num="average_precision",
    digits=9,
)
def _(spark, sf):
    return curves.average_precision(curves.threshold_frame(scored_frame(spark, sf)))


@query(
    "precision_vs_tested",
    f"SELECT threshold, pct_tested, precision FROM ({THRESHOLD_SQL}) AS t",
    num="threshold pct_tested precision",
    digits=9,
)
def _(spark, sf):
    return curves.precision_curve(curves.threshold_frame(scored_frame(spark, sf)))


@query(
    "curve_marks",
    f"""SELECT mark, threshold, tpr AS recall, precision, pct_tested FROM (SELECT m.mark, t.*,
    row_number() OVER (PARTITION BY m.mark ORDER BY CASE WHEN threshold > m.mark THEN 0 ELSE 1 END, threshold) AS rn
    FROM ({THRESHOLD_SQL}) AS t, (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS mark) AS m) AS r WHERE rn = 1""",
    num="mark threshold recall precision pct_tested",
    digits=9,
)
def _(spark, sf):
    return curves.curve_marks(curves.threshold_frame(scored_frame(spark, sf)))


@query(
    "thinned_curve",
    f"""SELECT threshold, tpr, pct_tested FROM (SELECT *, row_number() OVER (PARTITION BY floor(pct_tested * 100) ORDER BY pct_tested DESC) AS rn
    FROM ({THRESHOLD_SQL}) AS t) AS r WHERE rn = 1""",
    num="threshold tpr pct_tested",
    digits=9,
)
def _(spark, sf):
    return curves.thin_curve(curves.threshold_frame(scored_frame(spark, sf)), 100).select("threshold", "tpr", "pct_tested")


@query(
    "calibration_uniform",
    f"""SELECT CAST(least(floor(p * 5), 4) AS INTEGER) AS bin, avg(p) AS yhat_mean, avg(target) AS y_mean, count(*) AS n
    FROM ({SCORED_SQL}) AS s GROUP BY 1""",
    num="yhat_mean y_mean",
    digits=9,
)
def _(spark, sf):
    return curves.calibration_uniform(scored_frame(spark, sf))


@query(
    "calibration_quantile",
    f"""SELECT bin, avg(yhat) AS yhat_mean, avg(y) AS y_mean, count(*) AS n FROM (SELECT *, {bin_sql('yhat', REGR_SQL)} AS bin
    FROM ({REGR_SQL}) AS s) AS b GROUP BY bin""",
    num="yhat_mean y_mean",
    digits=4,
)
def _(spark, sf):
    return curves.calibration_quantile(regr_frame(spark, sf), "y", "yhat")


@query(
    "calibration_per_class",
    " UNION ALL ".join(
        f"""SELECT {k} AS class, CAST(len(list_filter((SELECT quantile_cont(p{k}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
        FROM ({SCORED3_SQL}) AS e), lambda x: x <= p{k})) AS INTEGER) AS bin, avg(p{k}) AS yhat_mean,
        avg(CAST(target = {k} AS INTEGER)) AS y_mean, count(*) AS n FROM ({SCORED3_SQL}) AS s GROUP BY 2"""
        for k in range(3)
    ),
    num="yhat_mean y_mean",
    digits=9,
)
def _(spark, sf):
    return curves.calibration_classes(scored3_frame(spark, sf), 3)


def confusion_sql(source: str, y: str, pred: str, labels: list[str]) -> str:
    names = "[" + ", ".join(f"'{x}'" for x in labels) + "]"
    k = len(labels)
    return f"""SELECT {names}[t + 1] AS true_label, {names}[q + 1] AS pred_label, n, CAST(sum(n) OVER (PARTITION BY t) AS BIGINT) AS n_true,
    CAST(sum(n) OVER (PARTITION BY q) AS BIGINT) AS n_pred, round(100.0 * sum(n) OVER (PARTITION BY t) / sum(n) OVER (), 1) AS pct_true,
    round(100.0 * sum(n) OVER (PARTITION BY q) / sum(n) OVER (), 1) AS pct_pred FROM (
    SELECT t, q, (SELECT count(*) FROM ({source}) AS s WHERE {y} = t AND {pred} = q) AS n
    FROM (SELECT unnest(range({k})) AS t) AS a, (SELECT unnest(range({k})) AS q) AS b) AS g"""


@query(
    "confusion_matrix",
    confusion_sql(f"SELECT target, {PRED3} AS pred FROM ({SCORED3_SQL}) AS s", "target", "pred", ["A", "N", "R"]),
    num="pct_true pct_pred",
)
def _(spark, sf):
    return curves.confusion(scored3_frame(spark, sf), ["A", "N", "R"], pred=argmax("yhat"))


@query(
    "class_table",
    f"""SELECT CASE class WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS label, acc_top1, acc_top2, 1.0 AS acc_top3, auc, recall, precision,
    round(2 * precision * recall / (precision + recall), 1) AS f1 FROM (
    SELECT a.class, round(avg(CASE WHEN place = 1 THEN 1.0 ELSE 0 END), 2) AS acc_top1, round(avg(CASE WHEN place <= 2 THEN 1.0 ELSE 0 END), 2) AS acc_top2,
    round(any_value(auc), 2) AS auc, round(100.0 * sum(CAST(pred = target AS INTEGER)) / count(*), 1) AS recall,
    round(100.0 * sum(CAST(pred = target AS INTEGER)) / any_value(np), 1) AS precision FROM
    (SELECT target, {PRED3} AS pred, CASE target
      WHEN 0 THEN 1 + CAST(p1 > p0 AS INTEGER) + CAST(p2 > p0 AS INTEGER)
      WHEN 1 THEN 1 + CAST(p0 >= p1 AS INTEGER) + CAST(p2 > p1 AS INTEGER)
      ELSE 1 + CAST(p0 >= p2 AS INTEGER) + CAST(p1 >= p2 AS INTEGER) END AS place FROM ({SCORED3_SQL}) AS s) AS r
    JOIN ({auc_sql(CLASSES_SQL, 'is_class', 'p', 'class')}) AS a ON a.class = r.target
    JOIN (SELECT {PRED3} AS q, count(*) AS np FROM ({SCORED3_SQL}) AS s GROUP BY 1) AS p ON p.q = r.target GROUP BY a.class) AS m""",
    num="acc_top1 acc_top2 acc_top3 auc recall precision f1",
)
def _(spark, sf):
    return curves.class_table(scored3_frame(spark, sf), ["A", "N", "R"])


@query(
    "top_classes",
    f"""SELECT target, {PRED3} AS first, count(*) AS n FROM ({SCORED3_SQL}) AS s GROUP BY ALL""",
)
def _(spark, sf):
    top = scored3_frame(spark, sf).select("target", top_classes("yhat", 2)[0].alias("first"))
    return top.groupBy("target", "first").agg(F.count(F.lit(1)).alias("n"))


# --- association -------------------------------------------------------------------------------------

ITEM_CATE = ["target", "linestatus", "linenumber"]


def chi_sql(source: str, x: str, y: str) -> str:
    base = f"(SELECT {x} AS a, {y} AS b FROM ({source}) AS s WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return f"""SELECT '{x}' AS var1, '{y}' AS var2, CAST(any_value(n) AS BIGINT) AS n, count(DISTINCT a) AS rows, count(DISTINCT b) AS cols,
    CASE WHEN count(DISTINCT a) = 2 AND count(DISTINCT b) = 2 THEN sum(power(greatest(abs(o - e) - 0.5, 0), 2) / e)
    ELSE sum(power(o - e, 2) / e) END AS chi2 FROM (
    SELECT ra.a, rb.b, coalesce(o, 0) AS o, CAST(ra.r AS DOUBLE) * rb.c / t.n AS e, t.n FROM
    (SELECT a, count(*) AS r FROM {base} AS q GROUP BY a) AS ra CROSS JOIN (SELECT b, count(*) AS c FROM {base} AS q GROUP BY b) AS rb
    CROSS JOIN (SELECT count(*) AS n FROM {base} AS q) AS t
    LEFT JOIN (SELECT a, b, count(*) AS o FROM {base} AS q GROUP BY a, b) AS obs ON obs.a = ra.a AND obs.b = rb.b) AS g"""


ITEM_FLAG_SQL = f"SELECT *, CASE WHEN quantity > 25 THEN 'hi' ELSE 'lo' END AS size, 'x' AS flat FROM ({ITEM_SQL}) AS i"
CHI_COLUMNS = ["target", "linestatus", "linenumber", "size", "flat"]
CHI_SQL = " UNION ALL ".join(chi_sql(ITEM_FLAG_SQL, x, y) for x, y in combinations(CHI_COLUMNS, 2))


def chi_frame(spark, sf):
    df = item_frame(spark, sf).withColumn("size", F.when(F.col("quantity") > 25, "hi").otherwise("lo"))
    return df.withColumn("flat", F.lit("x")).select(*CHI_COLUMNS)


@query("chi_square", CHI_SQL, num="chi2")
def _(spark, sf):
    return assoc.chi_square(chi_frame(spark, sf), CHI_COLUMNS)


@query(
    "contingency_coefficient",
    f"""SELECT var1, var2, CASE WHEN least(rows, cols) > 1 THEN sqrt(chi2 / (n + chi2)) * sqrt(least(rows, cols) / (least(rows, cols) - 1.0)) END AS contingency
    FROM ({CHI_SQL}) AS c""",
    num="contingency",
)
def _(spark, sf):
    out = assoc.contingency(assoc.chi_square(chi_frame(spark, sf), CHI_COLUMNS))
    return out.select("var1", "var2", "contingency")


@query(
    "cramers_v",
    f"""SELECT var1, var2, CASE WHEN least(rows, cols) > 1 THEN sqrt(chi2 / (n * (least(rows, cols) - 1.0))) END AS cramersv FROM ({CHI_SQL}) AS c""",
    num="cramersv",
)
def _(spark, sf):
    return assoc.cramers_v(assoc.chi_square(chi_frame(spark, sf), CHI_COLUMNS)).select("var1", "var2", "cramersv")


CATE_PAIRS = " UNION ALL ".join(chi_sql(CLASS_SQL, x, y) for x, y in combinations(CATEGORICAL, 2))
CATE_MATRIX = f"""WITH c AS (SELECT var1, var2, sqrt(chi2 / (n + chi2)) * sqrt(least(rows, cols) / (least(rows, cols) - 1.0)) AS value FROM ({CATE_PAIRS}) AS p),
  l AS ({' UNION ALL '.join(f"SELECT '{c}' AS v, '{c} (' || count(DISTINCT {c}) || ')' AS label FROM ({CLASS_SQL}) AS t" for c in CATEGORICAL)})
  SELECT var1, var2, value, a.label AS label1, b.label AS label2
  FROM (SELECT var1, var2, value FROM c UNION ALL SELECT var2, var1, value FROM c) AS m JOIN l AS a ON a.v = var1 JOIN l AS b ON b.v = var2"""


@query("association_categorical", CATE_MATRIX, num="value")
def _(spark, sf):
    return assoc.association_matrix(class_frame(spark, sf), CATEGORICAL)


def spearman_matrix_sql(source: str, columns: list[str]) -> str:
    pairs = " UNION ALL ".join(
        f"SELECT '{x}' AS var1, '{y}' AS var2, abs(spear) AS value FROM ({spear_sql(source, x, y)}) AS s" for x, y in combinations(columns, 2)
    )
    labels = " UNION ALL ".join(
        f"SELECT '{c}' AS v, '{c} (NA: ' || printf('%.1f', round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END), 3) * 100) || '%)' AS label FROM ({source}) AS t"
        for c in columns
    )
    return f"""WITH c AS ({pairs}), l AS ({labels}) SELECT var1, var2, value, a.label AS label1, b.label AS label2
    FROM (SELECT var1, var2, value FROM c UNION ALL SELECT var2, var1, value FROM c) AS m JOIN l AS a ON a.v = var1 JOIN l AS b ON b.v = var2"""


@query("association_metric_missing", spearman_matrix_sql(ITEM_SQL, ["price", "quantity", "discount"]), num="value")
def _(spark, sf):
    return assoc.association_matrix(item_frame(spark, sf), ["price", "quantity", "discount"])


@query("association_metric_complete", spearman_matrix_sql(ITEM_SQL, ["price", "quantity", "tax"]), num="value")
def _(spark, sf):
    return assoc.association_matrix(item_frame(spark, sf), ["price", "quantity", "tax"])


@query(
    "association_cutoff",
    f"""WITH m AS ({CATE_MATRIX}), k AS (SELECT var1 FROM m GROUP BY var1 HAVING max(value) > 0.05)
    SELECT * FROM m WHERE var1 IN (SELECT var1 FROM k) AND var2 IN (SELECT var1 FROM k)""",
    num="value",
)
def _(spark, sf):
    return assoc.above_cutoff(assoc.association_matrix(class_frame(spark, sf), CATEGORICAL), 0.05)


# --- univariate importance -----------------------------------------------------------------------------


def importance_levels_sql(source: str, features: list[str], target: str) -> str:
    parts = []
    for f in features:
        level = f"coalesce({bin_sql(f, source)}, '(Missing)')" if f in METRIC + ["quantity", "discount", "tax"] else f
        where = "" if level != f else f"WHERE {f} IS NOT NULL"
        parts.append(f"SELECT '{f}' AS feature, {level} AS level, {target} AS target FROM ({source}) AS t {where}")
    return " UNION ALL ".join(parts)


def importance_sql(source: str, features: list[str], target: str) -> str:
    scored = f"""SELECT feature, target, avg(target) OVER (PARTITION BY feature, level) AS p FROM ({importance_levels_sql(source, features, target)}) AS l"""
    return f"SELECT feature, round(auc, 3) AS importance FROM ({auc_sql(scored, 'target', 'p', 'feature')}) AS a"


@query("importance_class", importance_sql(CLASS_SQL, METRIC + CATEGORICAL, "target"), num="importance")
def _(spark, sf):
    return univariate_importance(class_frame(spark, sf), METRIC + CATEGORICAL)


ITEM_FEATURES = ["quantity", "discount", "tax", "linestatus", "linenumber"]


@query(
    "importance_multiclass",
    f"""SELECT feature, round(avg(auc), 3) AS importance FROM ({auc_sql(' UNION ALL '.join(
        f'''SELECT feature || '/{k}' AS fk, CAST(target = '{k}' AS INTEGER) AS y, avg(CAST(target = '{k}' AS INTEGER)) OVER (PARTITION BY feature, level) AS p
        FROM ({importance_levels_sql(ITEM_SQL, ITEM_FEATURES, 'target')}) AS l{k}''' for k in 'ANR'), 'y', 'p', 'fk')}) AS a,
    (SELECT unnest(['quantity', 'discount', 'tax', 'linestatus', 'linenumber']) AS feature) AS f
    WHERE split_part(fk, '/', 1) = feature GROUP BY feature""",
    num="importance",
)
def _(spark, sf):
    return univariate_importance(item_frame(spark, sf), ITEM_FEATURES, "target", "MULTICLASS")


@query(
    "importance_regression",
    " UNION ALL ".join(
        [f"SELECT '{f}' AS feature, round(abs(spear), 3) AS importance FROM ({spear_sql(ITEM_SQL, 'price', f)}) AS s" for f in ["quantity", "discount", "tax"]]
        + [
            f"""SELECT '{f}' AS feature, round(abs(spear), 3) AS importance FROM
            ({spear_sql(f"SELECT price, avg(price) OVER (PARTITION BY {f}) AS score FROM ({ITEM_SQL}) AS i", 'price', 'score')}) AS s"""
            for f in ["target", "linenumber"]
        ]
    ),
    num="importance",
)
def _(spark, sf):
    return univariate_importance(item_frame(spark, sf), ["quantity", "discount", "tax", "target", "linenumber"], "price", "REGR")


DRIFT_SQL = f"SELECT *, CASE WHEN year >= 2000 THEN 1 ELSE 0 END AS fold_num FROM ({CLASS_SQL}) AS c"


@query(
    "fold_drift",
    f"SELECT *, importance > 0.52 AS drift FROM ({importance_sql(DRIFT_SQL, METRIC + CATEGORICAL, 'fold_num')}) AS i",
    num="importance",
)
def _(spark, sf):
    df = class_frame(spark, sf).withColumn("fold", F.when(F.col("year") >= 2000, "test").otherwise("train"))
    return fold_drift(fold_flags(df), METRIC + CATEGORICAL)


# --- densities -----------------------------------------------------------------------------------------


def histogram_sql(source: str, column: str, by: str, bins: int = 20) -> str:
    return f"""SELECT {by}, bin, any_value(lo + bin * w) AS lower, any_value(lo + (bin + 1) * w) AS upper, count(*) AS n, count(*) / any_value(total * w) AS density
    FROM (SELECT *, CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin FROM (SELECT s.{by}, s.{column} AS x, lo, (hi - lo) / {bins}.0 AS w, total
    FROM ({source}) AS s JOIN (SELECT {by}, min({column}) AS lo, max({column}) AS hi, count({column}) AS total FROM ({source}) AS r GROUP BY {by}) AS g
    ON g.{by} = s.{by} WHERE s.{column} IS NOT NULL) AS a) AS b GROUP BY {by}, bin"""


@query("histogram_by_target", histogram_sql(CLASS_SQL, "price", "target"), num="lower upper density", digits=9)
def _(spark, sf):
    return density.histogram(class_frame(spark, sf), "price", by="target")


KDE_STATS = f"(SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, stddev_samp(x) * power(count(*), -0.2) AS bw FROM x)"


@query(
    "kernel_density",
    f"""WITH x AS (SELECT acctbal AS x FROM ({CLASS_SQL}) AS t WHERE acctbal IS NOT NULL), s AS {KDE_STATS},
    c AS (SELECT least(floor((x - lo) / ((hi - lo) / 4096.0)), 4095) AS cell, avg(x) AS centre, count(*) AS w FROM x, s GROUP BY 1)
    SELECT CAST(p AS INTEGER) AS point, gx AS x, sum(w * exp(-power((gx - centre) / bw, 2) / 2)) / any_value(n * bw) / sqrt(2 * pi()) AS density
    FROM c, (SELECT p, lo - 3 * bw + p * (hi - lo + 6 * bw) / 99.0 AS gx, bw, n FROM s, (SELECT unnest(range(100)) AS p) AS r) AS g GROUP BY p, gx""",
    num="x density",
    digits=7,
)
def _(spark, sf):
    return density.kernel_density(class_frame(spark, sf), "acctbal")


def box_sql(source: str, column: str, by: str) -> str:
    return f"""SELECT {by}, count(*) AS n, avg(x) AS mean, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
    min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM (
    SELECT s.{by}, s.{column} AS x, q1, median, q3, s.{column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM ({source}) AS s
    JOIN (SELECT {by}, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS median, quantile_cont({column}, 0.75) AS q3
    FROM ({source}) AS q GROUP BY {by}) AS g ON g.{by} = s.{by} WHERE s.{column} IS NOT NULL) AS b GROUP BY {by}"""


EVENTS_SQL = "SELECT event_type, value FROM events"


@query("box_statistics", box_sql(EVENTS_SQL, "value", "event_type"), num="mean q1 median q3 whisker_low whisker_high")
def _(spark, sf):
    return density.box_stats(table(spark, sf, "events"), "value", by="event_type")


def hexbin_sql(source: str, x: str, y: str) -> str:
    return f"""SELECT lattice, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, x0 + (i + lattice * 0.5) * sx AS x_centre, y0 + (j + lattice * 0.5) * sy AS y_centre, count(*) AS n
    FROM (SELECT *, CASE WHEN a THEN 0 ELSE 1 END AS lattice, CASE WHEN a THEN floor(u + 0.5) ELSE floor(u) END AS i, CASE WHEN a THEN floor(v + 0.5) ELSE floor(v) END AS j
    FROM (SELECT *, power(u - floor(u + 0.5), 2) + 3 * power(v - floor(v + 0.5), 2) < power(u - floor(u) - 0.5, 2) + 3 * power(v - floor(v) - 0.5, 2) AS a
    FROM (SELECT ({x} - x0) / sx AS u, ({y} - y0) / sy AS v, x0, y0, sx, sy FROM ({source}) AS s, (SELECT min({x}) AS x0, min({y}) AS y0,
    (max({x}) - min({x})) / 50.0 AS sx, (max({y}) - min({y})) / 28.0 AS sy FROM ({source}) AS r WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS g
    WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS d) AS e) AS f GROUP BY ALL"""


@query("hexagon_counts", hexbin_sql(CLASS_SQL, "price", "acctbal"), num="x_centre y_centre", digits=4)
def _(spark, sf):
    return density.hexbin(class_frame(spark, sf), "price", "acctbal")


@query(
    "trend_line",
    f"""SELECT bin, avg(discount) AS x_mean, avg(price) AS y_mean, count(*) AS n FROM (SELECT *, {bin_sql('discount', ITEM_SQL, 20)} AS bin
    FROM ({ITEM_SQL}) AS s) AS b WHERE discount IS NOT NULL GROUP BY bin""",
    num="x_mean y_mean",
)
def _(spark, sf):
    return density.trend(item_frame(spark, sf), "discount", "price")


@query(
    "distribution_profile_class",
    f"""SELECT 'histogram' AS frame, '{METRIC[0]}' AS variable, target || '/' || bin AS item, density AS value FROM ({histogram_sql(CLASS_SQL, METRIC[0], 'target')}) AS h
    UNION ALL SELECT 'histogram', '{METRIC[1]}', target || '/' || bin, density FROM ({histogram_sql(CLASS_SQL, METRIC[1], 'target')}) AS h
    UNION ALL SELECT 'box', '{METRIC[0]}', CAST(target AS VARCHAR), median FROM ({box_sql(CLASS_SQL, METRIC[0], 'target')}) AS b
    UNION ALL SELECT 'box', '{METRIC[1]}', CAST(target AS VARCHAR), median FROM ({box_sql(CLASS_SQL, METRIC[1], 'target')}) AS b
    UNION ALL SELECT 'levels', 'status', status, avg(target) FROM ({CLASS_SQL}) AS c GROUP BY status
    UNION ALL SELECT 'levels', 'segment', segment, avg(target) FROM ({CLASS_SQL}) AS c WHERE segment IS NOT NULL GROUP BY segment""",
    num="value",
    digits=9,
)
def _(spark, sf):
    found = density.distribution_profile(class_frame(spark, sf), [*METRIC, "status", "segment"], labels=[0, 1])

    def item(frame, key, value):
        return found[frame].select(F.lit(frame).alias("frame"), "variable", key.alias("item"), F.col(value).alias("value"))

    return union_rows(
        item("histogram", F.concat_ws("/", "target", "bin"), "density"),
        item("box", F.col("target").cast("string"), "median"),
        item("levels", F.col("level"), "share_1"),
    )


@query(
    "distribution_profile_regression",
    f"""SELECT 'hexbin' AS frame, v AS variable, lattice || '/' || i || '/' || j AS item, CAST(n AS DOUBLE) AS value FROM (
      SELECT 'quantity' AS v, * FROM ({hexbin_sql(ITEM_SQL, 'quantity', 'price')}) AS a UNION ALL SELECT 'discount', * FROM ({hexbin_sql(ITEM_SQL, 'discount', 'price')}) AS b) AS h
    UNION ALL SELECT 'trend', 'discount', bin, avg(price) FROM (SELECT *, {bin_sql('discount', ITEM_SQL, 20)} AS bin FROM ({ITEM_SQL}) AS s WHERE discount IS NOT NULL) AS t GROUP BY bin
    UNION ALL SELECT 'trend', 'quantity', bin, avg(price) FROM (SELECT *, {bin_sql('quantity', ITEM_SQL, 20)} AS bin FROM ({ITEM_SQL}) AS s) AS t GROUP BY bin
    UNION ALL SELECT 'levels', 'linenumber', linenumber, avg(price) FROM ({ITEM_SQL}) AS l GROUP BY linenumber
    UNION ALL SELECT 'level_box', 'linenumber', linenumber, median FROM ({box_sql(ITEM_SQL, 'price', 'linenumber')}) AS b""",
    num="value",
)
def _(spark, sf):
    found = density.distribution_profile(item_frame(spark, sf), ["quantity", "discount", "linenumber"], "price", "REGR")

    def item(frame, key, value):
        return found[frame].select(F.lit(frame).alias("frame"), "variable", key.alias("item"), F.col(value).cast("double").alias("value"))

    return union_rows(
        item("hexbin", F.concat_ws("/", "lattice", "i", "j"), "n"),
        item("trend", F.col("bin"), "y_mean"),
        item("levels", F.col("level"), "h"),
        item("level_box", F.col("level"), "median"),
    )


@query(
    "performance_report_class",
    f"""SELECT 'average_precision' AS frame, 'all' AS item, sum(CAST(pos AS DOUBLE) / pt * precision) AS value FROM ({THRESHOLD_SQL}) AS t
    UNION ALL SELECT 'confusion', true_label || '/' || pred_label, CAST(n AS DOUBLE) FROM
    ({confusion_sql(f"SELECT target, CAST(p > 0.5 AS INTEGER) AS pred FROM ({SCORED_SQL}) AS s", 'target', 'pred', ['0', '1'])}) AS c
    UNION ALL SELECT 'calibration', CAST(CAST(least(floor(p * 5), 4) AS INTEGER) AS VARCHAR), avg(target) FROM ({SCORED_SQL}) AS s GROUP BY 2
    UNION ALL SELECT 'roc', 'points', CAST(count(*) AS DOUBLE) FROM ({THRESHOLD_SQL}) AS t""",
    num="value",
    digits=9,
)
def _(spark, sf):
    df = scored_frame(spark, sf).withColumn("yhat", F.array(1 - F.col("p"), F.col("p")))
    found = curves.performance_report(df, "CLASS")

    def item(frame, key, value):
        return found[frame].select(F.lit(frame).alias("frame"), key.alias("item"), value.cast("double").alias("value"))

    return union_rows(
        item("average_precision", F.lit("all"), F.col("average_precision")),
        item("confusion", F.concat_ws("/", "true_label", "pred_label"), F.col("n")),
        item("calibration", F.col("bin").cast("string"), F.col("y_mean")),
        found["roc"].agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("roc").alias("frame"), F.lit("points").alias("item"), "value"),
    )


@query(
    "performance_report_regression",
    f"""SELECT 'spear' AS frame, 'all' AS item, spear AS value FROM ({spear_sql(REGR_SQL, 'y', 'yhat')}) AS s
    UNION ALL SELECT 'box', type, median FROM ({box_sql(f"SELECT 'y' AS type, y AS value FROM ({REGR_SQL}) AS a UNION ALL SELECT 'yhat', yhat FROM ({REGR_SQL}) AS b", 'value', 'type')}) AS b
    UNION ALL SELECT 'calibration', bin, avg(y) FROM (SELECT *, {bin_sql('yhat', REGR_SQL)} AS bin FROM ({REGR_SQL}) AS s) AS b GROUP BY bin
    UNION ALL SELECT 'residual', lattice || '/' || i || '/' || j, CAST(n AS DOUBLE) FROM ({hexbin_sql(f"SELECT yhat, y - yhat AS residual FROM ({REGR_SQL}) AS g", 'yhat', 'residual')}) AS h""",
    num="value",
    digits=6,
)
def _(spark, sf):
    found = curves.performance_report(regr_frame(spark, sf), "REGR", "y", "yhat")

    def item(frame, key, value):
        return found[frame].select(F.lit(frame).alias("frame"), key.alias("item"), value.cast("double").alias("value"))

    return union_rows(
        item("spear", F.lit("all"), F.col("spear")),
        item("box", F.col("type"), F.col("median")),
        item("calibration", F.col("bin"), F.col("y_mean")),
        item("residual", F.concat_ws("/", "lattice", "i", "j"), F.col("n")),
    )


def registered(name: str, columns: str) -> str:
    """Items of a registered query's SQL, as (frame, item, value)."""
    return f"SELECT '{name}' AS frame, {columns} FROM ({ORACLE[name]}) AS q"


@query(
    "performance_report_multiclass",
    " UNION ALL ".join(
        [
            registered("auc_one_vs_rest", "'auc' AS item, auc AS value"),
            registered("auc_one_vs_rest", "'auc_weighted', auc_weighted"),
            registered("confusion_matrix", "true_label || '/' || pred_label, CAST(n AS DOUBLE)"),
            registered("calibration_per_class", "class || '/' || bin, y_mean"),
            registered("class_table", "label, f1"),
            f"SELECT 'roc', CAST(class AS VARCHAR), CAST(count(DISTINCT p) AS DOUBLE) FROM ({CLASSES_SQL}) AS c GROUP BY class",
        ]
    ),
    num="value",
    digits=9,
)
def _(spark, sf):
    found = curves.performance_report(scored3_frame(spark, sf), "MULTICLASS", labels=["A", "N", "R"])

    def item(name, frame, key, value):
        return frame.select(F.lit(name).alias("frame"), key.alias("item"), value.cast("double").alias("value"))

    return union_rows(
        item("auc_one_vs_rest", found["auc"], F.lit("auc"), F.col("auc")),
        item("auc_one_vs_rest", found["auc"], F.lit("auc_weighted"), F.col("auc_weighted")),
        item("confusion_matrix", found["confusion"], F.concat_ws("/", "true_label", "pred_label"), F.col("n")),
        item("calibration_per_class", found["calibration"], F.concat_ws("/", "class", "bin"), F.col("y_mean")),
        item("class_table", found["classes"], F.col("label"), F.col("f1")),
        item("roc", found["roc"].groupBy("class").agg(F.count_distinct("threshold").alias("n")), F.col("class").cast("string"), F.col("n")),
    )


SHARE_ITEMS_SQL = " UNION ALL ".join(
    f"SELECT 'levels', 'linestatus', linestatus || '/{x}', avg(CASE WHEN target = '{x}' THEN 1.0 ELSE 0.0 END) FROM ({ITEM_SQL}) AS l GROUP BY linestatus"
    for x in "ANR"
)


@query(
    "distribution_profile_multiclass",
    f"""SELECT 'histogram' AS frame, 'quantity' AS variable, target || '/' || bin AS item, density AS value FROM ({histogram_sql(ITEM_SQL, 'quantity', 'target')}) AS h
    UNION ALL SELECT 'box', 'quantity', target, median FROM ({box_sql(ITEM_SQL, 'quantity', 'target')}) AS b
    UNION ALL SELECT 'box', 'discount', target, median FROM ({box_sql(ITEM_SQL, 'discount', 'target')}) AS b
    UNION ALL {SHARE_ITEMS_SQL}""",
    num="value",
    digits=9,
)
def _(spark, sf):
    found = density.distribution_profile(item_frame(spark, sf), ["quantity", "discount", "linestatus"], "target", "MULTICLASS", ["A", "N", "R"])

    def item(name, frame, key, value):
        return frame.select(F.lit(name).alias("frame"), "variable", key.alias("item"), value.cast("double").alias("value"))

    shares = [item("levels", found["levels"], F.concat("level", F.lit(f"/{x}")), F.col(f"share_{x}")) for x in "ANR"]
    return union_rows(
        item("histogram", found["histogram"].filter("variable = 'quantity'"), F.concat_ws("/", "target", "bin"), F.col("density")),
        item("box", found["box"], F.col("target"), F.col("median")),
        *shares,
    )
