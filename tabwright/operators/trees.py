"""Tree ensembles as tables: staged scores, additive contributions and partial dependence."""

from collections.abc import Callable, Iterator, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.models import Fitted, margin_to_yhat
from tabwright.schema import MULTICLASS, REGR
from tabwright.session import checkpoint_dir


def node_table(model, folder: str) -> list[dict]:
    """Nodes of all trees of a fitted ensemble, read from its saved table, in tree and preorder order."""
    path = f"{folder}/{model.uid}"
    model.write().overwrite().save(path)
    rows = SparkSession.active().read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    return [r.asDict(recursive=True) for r in sorted(rows, key=lambda r: (r["treeID"], r["id"]))]


def leaf_contributions(model, df: DataFrame, nodes: list[dict], name: str) -> DataFrame:
    """Add an array with the weighted leaf value of every tree, from one transform of the whole ensemble."""
    values: dict[int, list[float]] = {}
    for n in nodes:
        if n["leftChild"] < 0:
            values.setdefault(n["treeID"], []).append(n["prediction"])
    trees = sorted(values)
    flat = F.lit(np.array([v * model.treeWeights[t] for t in trees for v in values[t]]))
    starts = F.lit(np.cumsum([0] + [len(values[t]) for t in trees[:-1]]).astype("int32"))
    leaves = vector_to_array(f"{name}_leaf")

    def value(leaf: Column, tree: Column) -> Column:
        return F.element_at(flat, (F.element_at(starts, tree + 1) + leaf).cast("int") + 1)

    scored = model.copy({model.leafCol: f"{name}_leaf"}).transform(df)
    return scored.withColumn(name, F.transform(leaves, value)).select(*df.columns, name)


def staged_scores(fitted: Fitted, df: DataFrame, stages: Sequence[int], name: str = "n_estimators") -> DataFrame:
    """One row per row and stage with the `yhat` of the first n trees, for all n in one pass over the data."""
    out = df
    folder = checkpoint_dir(df.sparkSession)
    for i, m in enumerate(fitted.models):
        out = leaf_contributions(m, out, node_table(m, folder), f"_trees_{i}")

    def prefix(i: int, n: int) -> Column:
        return F.aggregate(F.slice(f"_trees_{i}", 1, n), F.lit(0.0), lambda a, x: a + x)

    k = len(fitted.models)
    cells = F.array(
        *[F.struct(F.lit(int(n)).alias(name), F.array(*[prefix(i, int(n)) for i in range(k)]).alias("_margins")) for n in stages]
    )
    long = out.select(*df.columns, F.explode(cells).alias("_stage"))
    yhat = margin_to_yhat(F.col("_stage._margins"), fitted.target_type)
    return long.select(*df.columns, F.col(f"_stage.{name}").alias(name), yhat.alias("yhat"))


# --- additive contributions ------------------------------------------------------------------------------

CELLS = 4_000_000  # numbers in one temporary array of a task


class TreePaths:
    """A fitted tree prepared for many rows: what each leaf asks of each player on its path.

    A player is a feature, or a group of features that are set together; `player` maps a feature to its number and
    `column` to its place in a row. A pair (leaf, player) is satisfied by a row if all conditions on the leaf's path
    that concern the player are. `values` holds one row per leaf, and belongs to the outputs from `first` on.
    """

    def __init__(self, nodes: list[dict], values: np.ndarray, first: int, column: dict[int, int], player: dict[int, int]):
        by_id = {n["id"]: n for n in nodes}
        self.splits = [n for n in nodes if n["leftChild"] >= 0]
        place = {n["id"]: i for i, n in enumerate(self.splits)}
        leaves: list[list[tuple[int, int, bool, float]]] = []  # per leaf: player, split, goes left, share of training rows
        stack: list[tuple[int, list[tuple[int, int, bool, float]]]] = [(nodes[0]["id"], [])]
        found: dict[int, list[tuple[int, int, bool, float]]] = {}
        while stack:
            i, path = stack.pop()
            n = by_id[i]
            if n["leftChild"] < 0:
                found[i] = path
                continue
            who = player[n["split"]["featureIndex"]]
            for child, left in ((n["leftChild"], True), (n["rightChild"], False)):
                stack.append((child, [*path, (who, place[i], left, by_id[child]["rawCount"] / n["rawCount"])]))
        leaves = [sorted(found[i]) for i in sorted(found)]  # ids are in preorder, as are the values
        flat = [(k, *step) for k, path in enumerate(leaves) for step in path]
        self.node = np.array([s[2] for s in flat], np.int64)
        self.left = np.array([s[3] for s in flat], bool)
        pairs = np.array([(s[0], s[1]) for s in flat], np.int64).reshape(-1, 2)
        new = np.ones(len(flat), bool)
        new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
        self.starts = np.flatnonzero(new)
        self.leaf_of, self.player_of = pairs[self.starts].T
        self.share = np.multiply.reduceat(np.array([s[4] for s in flat]), self.starts) if flat else np.zeros(0)
        self.size = np.bincount(self.leaf_of, minlength=len(leaves))  # players of each leaf
        self.slot = np.arange(len(self.starts)) - (np.cumsum(self.size) - self.size)[self.leaf_of]
        self.columns = np.array([column[n["split"]["featureIndex"]] for n in self.splits], np.int64)
        self.categorical = [(i, n["split"]["leftCategoriesOrThreshold"]) for i, n in enumerate(self.splits) if n["split"]["numCategories"] >= 0]
        self.limits = np.array([n["split"]["leftCategoriesOrThreshold"][0] if n["split"]["numCategories"] < 0 else np.nan for n in self.splits])
        self.values, self.outputs = values, slice(first, first + values.shape[1])
        depth = max(self.size.max(initial=0), 1)
        self.chunk = max(1, CELLS // (max(len(leaves), 1) * (depth + 1) + len(flat)))
        weights = np.zeros((len(leaves), depth + 1))
        for k, d in enumerate(self.size):
            weights[k, :d] = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
        self.weights = weights
        self.padded = np.ones((len(leaves), depth))
        self.padded[self.leaf_of, self.slot] = self.share

    @property
    def mean(self) -> np.ndarray:
        """The mean prediction over the training rows that the shares count."""
        return self.padded.prod(axis=1) @ self.values

    def goes_left(self, x: np.ndarray) -> np.ndarray:
        """For each row and split whether the row goes left."""
        left = x[:, self.columns] <= self.limits
        for i, categories in self.categorical:
            left[:, i] = np.isin(x[:, self.columns[i]], categories)
        return left

    def satisfied(self, x: np.ndarray) -> np.ndarray:
        """For each row and pair whether the row satisfies it."""
        if not len(self.starts):
            return np.zeros((len(x), 0), bool)
        left = self.goes_left(x)
        return np.logical_and.reduceat(left[:, self.node] == self.left, self.starts, axis=1)

    def by_leaf(self, pairs: np.ndarray) -> np.ndarray:
        """Sums of the pairs of each leaf, for each row."""
        if not len(self.starts):
            return np.zeros((len(pairs), len(self.values)), np.int64)
        return np.add.reduceat(pairs, np.cumsum(self.size) - self.size, axis=1, dtype=np.int64)

    def add_contributions(self, x: np.ndarray, out: np.ndarray) -> None:
        """Add the path-dependent Shapley values of all players to `out` (rows, players, outputs).

        Player j counts as present with its indicator o_j and as absent with the share z_j of training rows that take
        the path, so the Shapley sum over subsets is read off the coefficients of prod (z_j + o_j t) without the
        factor of the player itself: one product for a leaf, from which each factor is divided out.
        """
        for start in range(0, len(x) if len(self.starts) else 0, self.chunk):
            rows = slice(start, start + self.chunk)
            hit = self.satisfied(x[rows])
            n, (leaves, depth) = len(hit), self.padded.shape
            o = np.zeros((n, leaves, depth))
            o[:, self.leaf_of, self.slot] = hit
            product = np.zeros((n, leaves, depth + 1))
            product[..., 0] = 1.0
            for j in range(depth):
                grown = product * self.padded[:, j, None]
                grown[..., 1:] += product[..., :-1] * o[..., j, None]
                product = grown
            own = np.zeros((n, leaves, depth))
            for j in range(depth):
                z, present = self.padded[:, j], o[..., j] > 0
                carried, total = product[..., depth].copy(), np.zeros((n, leaves))
                for s in range(depth - 1, -1, -1):
                    total += self.weights[:, s] * np.where(present, carried, product[..., s] / z)
                    carried = product[..., s] - z * carried
                own[..., j] = (o[..., j] - z) * total
            pairs = own[:, self.leaf_of, self.slot]
            for p in np.unique(self.player_of):
                mine = np.flatnonzero(self.player_of == p)
                out[rows, p, self.outputs] += pairs[:, mine] @ self.values[self.leaf_of[mine]]


def _leaf_value(node: dict, fitted: Fitted) -> list[float]:
    """What a leaf adds: class shares in a classification forest (P(y = 1) for two classes), else its prediction."""
    if fitted.kind != "random_forest" or fitted.target_type == REGR:
        return [node["prediction"]]
    counts = [*node["impurityStats"], *[0.0] * fitted.n_classes][: fitted.n_classes]
    shares = [c / sum(counts) for c in counts]
    return shares if fitted.target_type == MULTICLASS else shares[1:]


def tree_link(fitted: Fitted) -> str:
    """How the summed outputs of a tree ensemble become a prediction: `identity`, `logit` or `softmax`."""
    if fitted.kind == "random_forest" or fitted.target_type == REGR:
        return "identity"
    return "softmax" if fitted.target_type == MULTICLASS else "logit"


def prepare_trees(fitted: Fitted, folder: str, player: Callable[[int], int] | None = None) -> tuple[list[TreePaths], list[int], int]:
    """All trees of a fitted ensemble, the features they use, and the number of outputs.

    Outputs add up over trees to the prediction of a forest or regression, and to the logits of a booster. `player`
    groups features (by default each one is its own, numbered by its place among those used).
    """
    raw: list[tuple[list[dict], float, int]] = []
    for i, model in enumerate(fitted.models):
        trees: dict[int, list[dict]] = {}
        for n in node_table(model, folder):
            trees.setdefault(n["treeID"], []).append(n)
        scale = 2.0 if tree_link(fitted) != "identity" else 1.0  # a boosting margin is half a logit
        total = sum(model.treeWeights) if fitted.kind == "random_forest" else 1.0
        raw += [(trees[t], scale * model.treeWeights[t] / total, i) for t in sorted(trees)]
    used = sorted({n["split"]["featureIndex"] for nodes, *_ in raw for n in nodes if n["leftChild"] >= 0})
    column = {f: i for i, f in enumerate(used)}
    players = column if player is None else {f: player(f) for f in used}
    out = []
    for nodes, weight, first in raw:
        values = weight * np.array([_leaf_value(n, fitted) for n in nodes if n["leftChild"] < 0])
        out.append(TreePaths(nodes, values, first, column, players))
    return out, used, max(t.outputs.stop for t in out)


def used_inputs(fitted: Fitted, df: DataFrame, used: Sequence[int]) -> tuple[DataFrame, Column]:
    """`df` with its design matrix, and the array of the used features of a row."""
    ready = df if fitted.features in df.columns else fitted.design.transform(df)
    dense = vector_to_array(fitted.features)
    return ready, F.array(*[dense[f] for f in used]) if used else F.array(F.lit(0.0))


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column of equally long arrays."""
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def tree_contributions(fitted: Fitted, df: DataFrame, keep: str | Sequence[str]) -> tuple[DataFrame, list[float]]:
    """The columns `keep` of `df` with `contributions`, and the intercepts.

    `contributions` is an array of (variable, shap array with one value per output); the values of one-hot positions
    are summed to their variable. Outputs are logits for boosters, else predictions (see `tree_link`). The trees are
    prepared once and travel with the task; rows stay where they are, with their other columns.
    """
    keep = [keep] if isinstance(keep, str) else list(keep)
    trees, used, outputs = prepare_trees(fitted, checkpoint_dir(df.sparkSession))
    intercepts = np.zeros(outputs)
    for t in trees:
        intercepts[t.outputs] += t.mean
    variables = list(fitted.design.spans())
    to_variable = np.zeros((len(used), len(variables)))
    for i, v in enumerate(fitted.design.owner(used).values()):
        to_variable[i, variables.index(v)] = 1.0

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, "_x")
            out = np.zeros((len(x), len(used), outputs))
            for t in trees:
                t.add_contributions(x, out)
            summed = np.einsum("rfk,fv->rvk", out, to_variable)
            width = len(variables) * outputs
            flat = pa.array(np.ascontiguousarray(summed).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, width * len(x) + 1, max(width, 1), dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], lists], names=[*keep, "_s"])

    ready, cells = used_inputs(fitted, df, used)
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["_s array<double>"])
    raw = ready.select(*keep, cells.alias("_x")).mapInArrow(explain, schema)
    parts = [
        F.struct(F.lit(v).alias("variable"), F.slice("_s", i * outputs + 1, outputs).alias("shap"))
        for i, v in enumerate(variables)
    ]
    return raw.select(*keep, F.array(*parts).alias("contributions")), intercepts.tolist()


# --- partial dependence ----------------------------------------------------------------------------------


def _told_apart(trees: Sequence[TreePaths], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row for each way through all splits of the ensemble, and how many rows go it."""
    ways = np.ascontiguousarray(np.packbits(np.concatenate([np.ones((len(x), 1), bool), *[t.goes_left(x) for t in trees]], axis=1), axis=1))
    _, first, times = np.unique(ways.view(np.dtype((np.void, ways.shape[1]))).ravel(), return_index=True, return_counts=True)
    return x[first], times


def _grid_cells(trees: Sequence[TreePaths], grids: Sequence[np.ndarray]) -> tuple[list[np.ndarray], list[list[np.ndarray]]]:
    """Per grid the cell of each of its values, and per grid and tree which leaves each cell can reach.

    Values that no split of the ensemble tells apart share a cell, so cells are bounded by the splits.
    """
    cells, reach = [], []
    for v, grid in enumerate(grids):
        seen: dict[bytes, int] = {}
        number, first = np.zeros(len(grid), np.int64), []
        for start in range(0, len(grid), 4096):
            part = grid[start : start + 4096]
            open_ = []
            for t in trees:
                hit, mine = t.satisfied(part), np.flatnonzero(t.player_of == v)
                able = np.ones((len(part), len(t.values)), bool)
                able[:, t.leaf_of[mine]] = hit[:, mine]
                open_.append(able)
            for i, code in enumerate(np.packbits(np.concatenate(open_, axis=1), axis=1)):
                key = code.tobytes()
                if key not in seen:
                    seen[key] = len(seen)
                    first.append([able[i] for able in open_])
                number[start + i] = seen[key]
        cells.append(number)
        reach.append([np.array([f[t] for f in first]).reshape(len(first), -1) for t in range(len(trees))])
    return cells, reach


def tree_dependence(
    fitted: Fitted,
    df: DataFrame,
    grid: dict[str, list],
    labels: Sequence[str] = ("target",),
    levels: DataFrame | None = None,
    b_sample: Sequence[float] | None = None,
    b_all: Sequence[float] | None = None,
) -> DataFrame:
    """Mean prediction over all rows with one variable set to each grid value: (feature, value, target, yhat_mean).

    No row is copied. A row reaches a leaf for some values of a variable if it satisfies the path's conditions on
    all others; with the leaves each value can reach, known beforehand, one reading of a tree gives the row's outputs
    for all values of all variables. Values are handled in cells that no split tells apart, so the work depends on
    the trees and not on the length of the grid. Rows of a batch that no split tells apart are read once and counted. Tasks send one sum per variable, cell and class. `grid` lists values;
    `levels`, a table (feature, value) of categorical variables, may hold any number of them.
    """
    names = list(dict.fromkeys([*grid, *(() if levels is None else fitted.design.cate)]))
    own = lambda f: fitted.design.owner([f])[f]
    trees, used, outputs = prepare_trees(fitted, checkpoint_dir(df.sparkSession), lambda f: names.index(own(f)) if own(f) in names else len(names))
    variables, told_apart = names, fitted.design.positions(used)
    values = {v: list(dict.fromkeys(grid[v])) if v in grid else [None, *(g for _, w, g in told_apart if w == v)] for v in variables}
    slots = {f: i for i, f in enumerate(used)}
    points = []
    for v in variables:
        inputs = np.zeros((len(values[v]), max(len(used), 1)))
        place = {g: i for i, g in enumerate(values[v])}
        for position, variable, level in told_apart:
            if variable != v:
                continue
            if level is None:
                inputs[:, slots[position]] = [float(g) for g in values[v]]
            elif level in place:
                inputs[place[level], slots[position]] = 1.0
        points.append(inputs)
    cells, reach = _grid_cells(trees, points)
    link, target_type = tree_link(fitted), fitted.target_type
    factor = None if b_sample is None else np.array([a / s for a, s in zip(b_all, b_sample)])

    def prediction(sums: np.ndarray) -> np.ndarray:
        """Outputs (…, k) to predictions, those of class 1 for two classes."""
        if target_type == REGR:
            return sums
        if link == "softmax":
            p = np.exp(sums - sums.max(axis=-1, keepdims=True))
            p /= p.sum(axis=-1, keepdims=True)
        elif target_type == MULTICLASS:
            p = sums
        else:
            one = sums if link == "identity" else 1 / (1 + np.exp(-sums))
            p = np.concatenate([1 - one, one], axis=-1)
        if factor is not None:
            p = p * factor
            p = p / p.sum(axis=-1, keepdims=True)
        return p if target_type == MULTICLASS else p[..., 1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(r[0]), outputs)) for r in reach]
        n = 0
        chunk = max(1, CELLS // (outputs * max([len(r[0]) for r in reach], default=1) + max(t.node.size + len(t.values) for t in trees)))
        for batch in batches:
            whole = matrix(batch, "_x")
            for start in range(0, len(whole), chunk):
                x, times = _told_apart(trees, whole[start : start + chunk])
                margins = [np.zeros((len(x), len(r[0]), outputs)) for r in reach]
                for k, t in enumerate(trees):
                    missed = ~t.satisfied(x)
                    failed = t.by_leaf(missed)
                    plain = (failed == 0) @ t.values
                    for v in range(len(variables)):
                        mine = np.flatnonzero(t.player_of == v)
                        if not len(mine):
                            margins[v][:, :, t.outputs] += plain[:, None, :]
                            continue
                        others = failed.copy()
                        others[:, t.leaf_of[mine]] -= missed[:, mine]
                        table = (reach[v][k][:, :, None] * t.values).transpose(1, 0, 2)  # leaf, cell, output
                        added = (others == 0).astype(float) @ table.reshape(len(t.values), -1)
                        margins[v][:, :, t.outputs] += added.reshape(len(x), -1, t.values.shape[1])
                for v, m in enumerate(margins):
                    sums[v] += np.tensordot(times, prediction(m), axes=1)
                n += int(times.sum())
        for v, total in enumerate(sums if n else []):
            cell, k = (i.ravel() for i in np.indices(total.shape))
            yield pa.RecordBatch.from_pydict({"_v": np.full(total.size, v, np.int32), "_cell": cell.astype(np.int32), "_k": k.astype(np.int32), "_sum": total.ravel(), "_n": np.full(total.size, n, np.int64)})

    ready, inputs = used_inputs(fitted, df, used)
    parts = ready.select(inputs.alias("_x")).mapInArrow(run, "_v int, _cell int, _k int, _sum double, _n long")
    means = parts.groupBy("_v", "_cell", "_k").agg((F.sum("_sum") / F.sum("_n")).alias("yhat_mean"))
    spark = df.sparkSession
    rows = [(v, name, str(g), int(c)) for v, name in enumerate(variables) if name in grid for g, c in zip(values[name], cells[v])]
    table = spark.createDataFrame(rows, "_v int, feature string, value string, _cell int")
    if levels is not None:  # a level that no split mentions has the cell of them all
        known = [(v, name, g, int(c)) for v, name in enumerate(variables) if name not in grid for g, c in zip(values[name], cells[v])]
        known = spark.createDataFrame(known, "_v int, feature string, value string, _cell int")
        others = known.filter("value IS NULL").select("feature", "_v", F.col("_cell").alias("_other"))
        open_ = levels.select("feature", "value").join(F.broadcast(others), "feature")
        table = table.unionByName(open_.join(F.broadcast(known.drop("_v")), ["feature", "value"], "left").select("_v", "feature", "value", F.coalesce("_cell", "_other").alias("_cell")))
    classes = F.array(*[F.lit(x) for x in labels])
    return table.join(means, ["_v", "_cell"]).select("feature", "value", classes[F.col("_k")].alias("target"), "yhat_mean")
