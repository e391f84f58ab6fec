"""Performance curves and tables behind a classification report.

All curves of a score are projections of one cumulative frame with a row per distinct threshold.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.predictions import argmax, top_classes
from tabwright.functions.quantiles import fit_quantiles
from tabwright.functions.ranks import cumulate
from tabwright.operators.density import box_stats, hexbin, histogram
from tabwright.operators.metrics import auc_multiclass, auc_per_class, class_scores, spear
from tabwright.operators.prepare import bin_edges, bin_label
from tabwright.session import settle

MARKS = tuple(i / 10 for i in range(1, 10))  # thresholds annotated on the curves


def threshold_frame(df: DataFrame, y: str = "target", p: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: threshold, tp, fp, fpr, tpr (= recall), precision, pct_tested, for `score >= threshold`."""
    keys = list(keys)
    y01 = F.col(y).cast("long")
    table = cumulate(df.filter(F.col(y).isNotNull()), p, {"pos": F.sum(y01), "neg": F.sum(1 - y01)}, keys)
    tp, fp = F.col("pos_total") - F.col("pos_before"), F.col("neg_total") - F.col("neg_before")
    return table.select(
        *keys,
        F.col(p).alias("threshold"),
        F.col("pos"),
        F.col("pos_total"),
        tp.alias("tp"),
        fp.alias("fp"),
        F.try_divide(fp, F.col("neg_total")).alias("fpr"),
        F.try_divide(tp, F.col("pos_total")).alias("tpr"),
        (tp / (tp + fp)).alias("precision"),
        ((tp + fp) / (F.col("pos_total") + F.col("neg_total"))).alias("pct_tested"),
    )


def roc_curve(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return frame.select(*keys, "threshold", "fpr", "tpr")


def pr_curve(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return frame.select(*keys, "threshold", F.col("tpr").alias("recall"), "precision")


def precision_curve(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return frame.select(*keys, "threshold", "pct_tested", "precision")


def average_precision(frame: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of precision times the gain in recall."""
    gain = F.try_divide(F.col("pos"), F.col("pos_total"))
    return frame.groupBy(*keys).agg(F.sum(gain * F.col("precision")).alias("average_precision"))


def curve_marks(frame: DataFrame, keys: Sequence[str] = (), marks: Sequence[float] = MARKS) -> DataFrame:
    """Curve point of the first threshold above each mark, the lowest threshold if there is none."""
    point = F.struct("threshold", F.col("tpr").alias("recall"), "precision", "pct_tested")
    first = F.min_by(point, F.col("threshold"))
    found = [
        F.struct(
            F.lit(m).alias("mark"),
            F.coalesce(F.min_by(point, F.when(F.col("threshold") > m, F.col("threshold"))), first).alias("point"),
        )
        for m in marks
    ]
    cells = frame.groupBy(*keys).agg(F.array(*found).alias("_cells"))
    return cells.select(*keys, F.explode("_cells").alias("_c")).select(*keys, "_c.mark", "_c.point.*")


def thin_curve(frame: DataFrame, n: int = 1000, keys: Sequence[str] = ()) -> DataFrame:
    """At most about n curve points, evenly spread over the share of rows tested; for display only."""
    cell = F.floor(F.col("pct_tested") * n).alias("_cell")
    last = F.max_by(F.struct(*[c for c in frame.columns if c not in keys]), F.col("pct_tested"))
    return frame.groupBy(*keys, cell).agg(last.alias("_p")).select(*keys, "_p.*")


def _bin_means(df: DataFrame, bin_: Column, y: str, p: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, bin_.alias("bin")).agg(
        F.avg(p).alias("yhat_mean"), F.avg(F.col(y).cast("double")).alias("y_mean"), F.count(F.lit(1)).alias("n")
    )


def calibration_uniform(df: DataFrame, y: str = "target", p: str = "p", n_bins: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """Mean prediction and mean target per equal-width bin of [0, 1]; empty bins are left out."""
    bin_ = F.least(F.floor(F.col(p) * n_bins), F.lit(n_bins - 1)).cast("int")
    return _bin_means(df.filter(F.col(p).isNotNull()), bin_, y, p, keys)


def calibration_quantile(df: DataFrame, y: str = "target", p: str = "p", n_bins: int = 10) -> DataFrame:
    """Mean prediction and mean target per right-closed quantile bin of the prediction."""
    edges = bin_edges(fit_quantiles(df, [p], [i / n_bins for i in range(n_bins + 1)])[p])
    return _bin_means(df.filter(F.col(p).isNotNull()), bin_label(p, edges), y, p, [])


def calibration_classes(df: DataFrame, n_classes: int, y: str = "target", yhat: str = "yhat", n_bins: int = 10) -> DataFrame:
    """Calibration of every class against the rest, left-closed quantile bins of its probability."""
    wide = df.select(F.col(y).alias("_y"), *[F.col(yhat)[k].alias(f"p{k}") for k in range(n_classes)])
    found = fit_quantiles(wide, [f"p{k}" for k in range(n_classes)], [i / n_bins for i in range(n_bins + 1)])
    bin_ = F.lit(None).cast("int")
    for k in range(n_classes):
        inner = found[f"p{k}"][1:-1]
        code = F.lit(0)
        for e in inner:
            code = code + (F.col("p") >= e).cast("int")
        bin_ = F.when(F.col("class") == k, code).otherwise(bin_)
    return _bin_means(class_scores(df, y, yhat), bin_, "is_class", "p", ["class"])


def confusion(df: DataFrame, labels: Sequence[str], y: str = "target", pred: str | Column = "pred") -> DataFrame:
    """Counts on the full grid of true and predicted class numbers, with the share of each margin."""
    pred = F.col(pred) if isinstance(pred, str) else pred
    counts = df.select(F.col(y).cast("int").alias("y"), pred.cast("int").alias("pred")).groupBy("y", "pred").agg(F.count(F.lit(1)).alias("n"))
    numbers = F.sequence(F.lit(0), F.lit(len(labels) - 1))
    grid = df.sparkSession.range(1).select(F.explode(numbers).alias("y")).select("y", F.explode(numbers).alias("pred"))
    full = grid.join(F.broadcast(counts), ["y", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    names = F.array(*[F.lit(x) for x in labels])
    total = F.sum("n").over(W.partitionBy())  # k × k rows
    return full.select(
        names[F.col("y")].alias("true_label"),
        names[F.col("pred")].alias("pred_label"),
        "n",
        F.sum("n").over(W.partitionBy("y")).alias("n_true"),
        F.sum("n").over(W.partitionBy("pred")).alias("n_pred"),
        F.round(100 * F.sum("n").over(W.partitionBy("y")) / total, 1).alias("pct_true"),
        F.round(100 * F.sum("n").over(W.partitionBy("pred")) / total, 1).alias("pct_pred"),
    )


def class_table(df: DataFrame, labels: Sequence[str], y: str = "target", yhat: str = "yhat") -> DataFrame:
    """Per class: top-1/2/3 accuracy, AUC against the rest, recall, precision and F1 (the last three in percent)."""
    names = F.array(*[F.lit(x) for x in labels])
    rows = df.select(F.col(y).cast("int").alias("class"), top_classes(yhat, 3).alias("top"), argmax(yhat).alias("pred"))
    rows = rows.select("class", "pred", (F.array_position("top", F.col("class"))).alias("place"))

    def within(k):
        return F.round(F.avg(F.col("place").between(1, k).cast("double")), 2)

    true_side = rows.groupBy("class").agg(
        within(1).alias("acc_top1"), within(2).alias("acc_top2"), within(3).alias("acc_top3"),
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("pred") == F.col("class")).alias("_hit"),
    )
    pred_side = rows.groupBy(F.col("pred").alias("class")).agg(F.count(F.lit(1)).alias("_npred"))
    aucs = auc_per_class(df, y, yhat).select("class", F.round("auc", 2).alias("auc"))
    recall = F.round(100 * F.col("_hit") / F.col("_n"), 1)
    precision = F.round(F.try_divide(100 * F.col("_hit"), F.col("_npred")), 1)
    joined = true_side.join(pred_side, "class", "left").join(aucs, "class", "left")
    joined = joined.withColumns({"recall": recall, "precision": precision})
    f1 = F.round(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), 1)
    return joined.select(names[F.col("class")].alias("label"), "acc_top1", "acc_top2", "acc_top3", "auc", "recall", "precision", f1.alias("f1"))


def performance_report(
    df: DataFrame, target_type: str, y: str = "target", yhat: str = "yhat", labels: Sequence[str] = (), n_bins: int = 10
) -> dict[str, DataFrame]:
    """Every frame behind the performance page of a target type. Input is settled once and shared."""
    if target_type == "CLASS":
        scored = settle(df.select(F.col(y).alias("y"), F.col(yhat)[1].alias("p")))
        frame = settle(threshold_frame(scored, "y", "p"))
        return {
            "roc": roc_curve(frame),
            "pr": pr_curve(frame),
            "precision": precision_curve(frame),
            "average_precision": average_precision(frame),
            "marks": curve_marks(frame),
            "confusion": confusion(scored, labels or ("0", "1"), "y", (F.col("p") > 0.5).cast("int")),
            "calibration": calibration_uniform(scored, "y", "p", 5),
            "histogram": histogram(scored, "p", by="y"),
        }
    if target_type == "MULTICLASS":
        scored = settle(df.select(F.col(y).alias("y"), F.col(yhat).alias("yhat")))
        return {
            "roc": roc_curve(threshold_frame(class_scores(scored, "y"), "is_class", "p", ["class"]), ["class"]),
            "auc": auc_multiclass(scored, "y"),
            "confusion": confusion(scored, labels, "y", argmax("yhat")),
            "calibration": calibration_classes(scored, len(labels), "y", n_bins=n_bins),
            "classes": class_table(scored, labels, "y"),
        }
    gap = F.col("y") - F.col("yhat")
    scored = settle(
        df.select(F.col(y).alias("y"), F.col(yhat).alias("yhat")).withColumns(
            {"residual": gap, "abs_residual": F.abs(gap), "rel_residual": F.try_divide(F.abs(gap), F.abs(F.col("y")))}
        )
    )
    both = scored.select(F.explode(F.array(
        F.struct(F.lit("y").alias("type"), F.col("y").alias("value")),
        F.struct(F.lit("yhat").alias("type"), F.col("yhat").alias("value")),
    )).alias("_s")).select("_s.*")
    return {
        "spear": spear(scored, "y", "yhat"),
        "observed": hexbin(scored, "yhat", "y"),
        "residual": hexbin(scored, "yhat", "residual"),
        "abs_residual": hexbin(scored, "yhat", "abs_residual"),
        "rel_residual": hexbin(scored, "yhat", "rel_residual"),
        "calibration": calibration_quantile(scored, "y", "yhat"),
        "histogram": histogram(both, "value", by="type"),
        "box": box_stats(both, "value", by="type"),
    }
