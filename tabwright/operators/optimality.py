"""How far a fitted model is from the conditions that its training minimises, measured by aggregation over the training rows."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.models import Fitted
from tabwright.operators.trees import node_table
from tabwright.schema import CLASS, REGR
from tabwright.session import checkpoint_dir


def linear_conditions(fitted: Fitted, df: DataFrame, alpha: float, l1_ratio: float = 1.0, target: str = "target") -> DataFrame:
    """Subgradient conditions of a penalised linear model: (class, position, beta, gradient, violation).

    The loss is the mean squared error halved, or the mean negative log-likelihood, plus alpha times
    l1_ratio |b| + (1 - l1_ratio) b² / 2 summed over coefficients b of standardised features (for a regression of a
    standardised target as well). `gradient` is the mean product of the standardised feature and the residual; it equals the
    derivative of the penalty where the coefficient is not zero, and is at most alpha * l1_ratio where it is. `violation`
    is the distance from that, in standard deviations of the residual. Position -1 is the intercept, whose residuals sum to zero.
    """
    model, regression = fitted.models[0], fitted.target_type == REGR
    ready = df if fitted.features in df.columns else fitted.design.transform(df)
    ready = fitted.score_matrix(ready.filter(F.col(target).isNotNull()))
    y = F.col(target).cast("double")
    if regression:
        betas, residuals = [model.coefficients.toArray()], F.array(y - F.col("yhat"))
    else:
        betas = list(model.coefficientMatrix.toArray())
        first = 1 if len(betas) == 1 else 0  # two classes have the coefficients of the second one
        residuals = F.array(*[(F.col(target) == k + first).cast("double") - F.col("yhat")[k + first] for k in range(len(betas))])
    stats = ready.select(Summarizer.metrics("mean", "std", "count").summary(F.col(fitted.features)).alias("s"), F.stddev_samp(y).alias("ys"))
    row = stats.first()
    means, widths, n = row["s"]["mean"].toArray(), row["s"]["std"].toArray(), row["s"]["count"]
    unit = row["ys"] if regression else 1.0
    rows = ready.select(vector_to_array(fitted.features).alias("x"), F.posexplode(residuals).alias("class", "r"))
    cells = rows.select("class", "r", F.posexplode(F.concat("x", F.array(F.lit(1.0)))).alias("position", "v"))
    sums = cells.groupBy("class", "position").agg(F.sum(F.col("v") * F.col("r")).alias("xr"), F.sum("r").alias("r"), F.sum(F.col("r") * F.col("r")).alias("rr")).collect()
    out = []
    for s in sums:
        k, j = s["class"], s["position"]
        spread = float(np.sqrt(s["rr"] / n)) or 1.0
        if j == len(means):
            out.append((k, -1, None, s["r"] / n, abs(s["r"]) / n / spread))
            continue
        beta = float(betas[k][j])
        gradient = 0.0 if widths[j] == 0 else float((s["xr"] - means[j] * s["r"]) / widths[j] / n)
        scaled = beta * widths[j]
        if scaled:
            off = abs(gradient - alpha * (l1_ratio * np.sign(scaled) + (1 - l1_ratio) * scaled / unit))
        else:
            off = max(0.0, abs(gradient) - alpha * l1_ratio)
        out.append((k, j, beta, gradient, float(off / spread)))
    return df.sparkSession.createDataFrame(sorted(out, key=lambda o: o[:2]), "class int, position int, beta double, gradient double, violation double")


def first_tree_leaves(fitted: Fitted, df: DataFrame, target: str = "target", ensemble: int = 0) -> DataFrame:
    """Leaves of the first tree of a booster trained without subsampling: (leaf, n, mean, training_rows, prediction).

    A leaf predicts the mean of what the first tree is trained on in its rows: the target of a regression, -1 and 1 for a
    class against the others.
    """
    model = fitted.models[ensemble]
    ready = df if fitted.features in df.columns else fitted.design.transform(df)
    label = 1 if fitted.target_type == CLASS else ensemble
    y = F.col(target).cast("double") if fitted.target_type == REGR else F.when(F.col(target) == label, 1.0).otherwise(-1.0)
    rows = ready.filter(F.col(target).isNotNull()).withColumn("_y", y)
    leaf = vector_to_array("_leaf")[0].cast("int")
    found = model.copy({model.leafCol: "_leaf"}).transform(rows).groupBy(leaf.alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"))
    leaves = [t for t in node_table(model, checkpoint_dir(df.sparkSession)) if t["treeID"] == 0 and t["leftChild"] < 0]
    table = df.sparkSession.createDataFrame([(i, int(t["rawCount"]), float(t["prediction"])) for i, t in enumerate(leaves)], "leaf int, training_rows long, prediction double")
    return found.join(F.broadcast(table), "leaf", "full")
