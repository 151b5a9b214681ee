"""Boosted trees grown leaf by leaf on distributed histograms.

Rows never leave Spark: every pass over them is one DataFrame aggregate, a histogram of gradients and hessians per (node,
feature, bin). Its size is bounded by leaves x features x bins, whatever the number of rows, and that is all the driver sees.

* Features are binned once, at approximate quantiles; a missing value has a bin of its own and goes to the side that gains more.
* A tree grows best-first: of all leaves the one whose split gains most is split next, up to ``num_leaves``. The histograms
  of several leaves are taken in one pass: the queue is run ahead with what is known, the splits that it meets get their
  children's histograms together, and the queue is run again, until it meets no unknown child. Of two children only the
  one with fewer rows is aggregated; the other is the parent less that.
* Scores are a stored column, carried from round to round. The write that stores them also observes the loss, so a round
  has no job of its own for that, and training stops inside the loop.
* Rows are drawn by a hash of the row, anew every ``bagging_freq`` rounds.
* Gradients are summed as whole multiples of 2^-30: sums don't depend on how rows are dealt out.
"""

from __future__ import annotations

import heapq
import json
import math
import random
import sys
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..context import Workspace

# Fixed values of the source's training run.
DEFAULTS = {
    "num_boost_round": 100,
    "num_leaves": 31,
    "learning_rate": 0.05,
    "feature_fraction": 0.9,
    "bagging_fraction": 0.8,
    "bagging_freq": 5,
    "min_data_in_leaf": 20,
}
#: Bins of a feature, without the one for missing values; depth of a tree (-1: as deep as its leaves allow); least sum of hessians of a leaf.
OWN_DEFAULTS = {"max_bin": 63, "max_depth": -1, "min_hessian": 1e-3}
#: Stands for a split between all known values and the missing ones.
LARGEST = sys.float_info.max
#: Gradients are summed in units of one part in so many.
UNIT = float(1 << 30)


@dataclass
class Node:
    """A node of a tree. A leaf has ``feature`` -1. ``value`` is what the leaf adds to the score, ``gain`` what the split gained."""

    tree: int
    node: int
    feature: int = -1
    bin: int = 0
    threshold: float = 0.0
    missing_left: bool = False
    left: int = -1
    right: int = -1
    gain: float = 0.0
    value: float = 0.0
    n_rows: int = 0


@dataclass
class BoostedTrees:
    """``edges`` are the features' cut points: a value is in the first bin whose edge isn't below it."""

    features: list[str]
    edges: list[list[float]]
    base: float
    nodes: list[Node] = field(default_factory=list)
    losses: list[tuple[float, float | None]] = field(default_factory=list)  # per fitted round: training, validation

    @property
    def n_trees(self) -> int:
        return 1 + max((n.tree for n in self.nodes), default=-1)

    def node_table(self, spark: SparkSession) -> DataFrame:
        """The ensemble as a table, a row for each node; a leaf has no feature."""
        rows = [(n.tree, n.node, self.features[n.feature] if n.feature >= 0 else None, n.threshold if n.feature >= 0 else None, n.missing_left if n.feature >= 0 else None,
                 n.left if n.feature >= 0 else None, n.right if n.feature >= 0 else None, n.gain, n.value, n.n_rows) for n in self.nodes]
        schema = "tree int, node int, feature string, threshold double, missing_left boolean, left int, right int, gain double, value double, n_rows bigint"
        return spark.createDataFrame(rows, schema)

    def score(self) -> Column:
        """The raw score of a row, from its feature columns: a null or NaN is missing."""
        by_tree: dict[int, dict[int, Node]] = {}
        for n in self.nodes:
            by_tree.setdefault(n.tree, {})[n.node] = n
        total = F.lit(self.base)
        for tree in by_tree.values():
            total = total + F.expr(self._branch(tree, 0))
        return total

    def _branch(self, tree: dict[int, Node], at: int) -> str:
        n = tree[at]
        if n.feature < 0:
            return f"{n.value!r}D"
        x = f"CAST(`{self.features[n.feature]}` AS DOUBLE)"
        known = f"{x} <= {n.threshold!r}D" if n.threshold < LARGEST else f"NOT isnan({x})"  # NaN is above every number, null gives null
        test = f"coalesce({known}, true) OR isnan({x})" if n.missing_left else f"coalesce({known}, false)"
        return f"CASE WHEN {test} THEN {self._branch(tree, n.left)} ELSE {self._branch(tree, n.right)} END"

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        d = json.loads(text)
        return BoostedTrees(d["features"], d["edges"], d["base"], [Node(**n) for n in d["nodes"]], [tuple(x) for x in d["losses"]])


def save(model: BoostedTrees, spark: SparkSession, path: str) -> str:
    """The model as one row of text in any store that Spark writes."""
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load(spark: SparkSession, path: str) -> BoostedTrees:
    return BoostedTrees.from_json(spark.read.text(path, wholetext=True).first()[0])


def gain_importance(nodes: DataFrame) -> DataFrame:
    """(feature, importance): total gain of a feature's splits over all trees, from the table of nodes."""
    return nodes.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("gain").alias("importance"))


def predict(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Adds ``p``, the probability of class 1."""
    return df.withColumn("p", 1.0 / (1.0 + F.exp(-model.score())))


# -- binning ----------------------------------------------------------------------------------------------------------


def cut_points(df: DataFrame, features: Sequence[str], max_bin: int) -> list[list[float]]:
    """Edges of each feature's bins: approximate quantiles, without the largest value. One aggregate for all features."""
    shares = [k / max_bin for k in range(1, max_bin)]
    quantiles = [F.percentile_approx(_value(f), shares, 100 * max_bin).alias(f"q{i}") for i, f in enumerate(features)]
    largest = [F.max(_value(f)).alias(f"m{i}") for i, f in enumerate(features)]
    row = df.agg(*quantiles, *largest).first()
    return [sorted({float(q) for q in row[f"q{i}"] or () if q < row[f"m{i}"]}) for i in range(len(features))]


def _value(feature: str) -> Column:
    return F.nanvl(F.col(f"`{feature}`").cast("double"), F.lit(None).cast("double"))


def binned(df: DataFrame, features: Sequence[str], edges: list[list[float]], label: str, val_col: str | None) -> DataFrame:
    """(label, is_val, draw, b0, b1, …) of every row: a bin for each feature; bin -1 is a missing value, ``draw`` a number that the row's values give."""
    bins = [F.expr(f"CASE WHEN v{i} IS NULL THEN -1 ELSE size(filter(array({', '.join(f'{e!r}D' for e in cuts)}), e -> e < v{i})) END") if cuts else F.expr(f"CASE WHEN v{i} IS NULL THEN -1 ELSE 0 END") for i, cuts in enumerate(edges)]
    wanted = [_value(f).alias(f"v{i}") for i, f in enumerate(features)]
    rows = df.select(F.col(f"`{label}`").cast("double").alias("label"), (F.col(val_col) if val_col else F.lit(False)).alias("is_val"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("draw"), *wanted)
    return rows.select("label", "is_val", "draw", *[b.alias(f"b{i}") for i, b in enumerate(bins)])


# -- one tree ---------------------------------------------------------------------------------------------------------


def place(nodes: list[Node], result, at: int = 0) -> str:
    """SQL for where a binned row is in the tree of ``nodes``: ``result`` of the leaf. A row runs through one path only."""
    n = nodes[at]
    if n.feature < 0:
        return result(n)
    test = f"b{n.feature} <= {n.bin}" if n.missing_left else f"b{n.feature} BETWEEN 0 AND {n.bin}"
    return f"CASE WHEN {test} THEN {place(nodes, result, n.left)} ELSE {place(nodes, result, n.right)} END"


def histograms(rows: DataFrame, nodes: list[Node], wanted: Sequence[int], n_features: int, n_bins: int) -> dict[int, np.ndarray]:
    """Per wanted node (features, bins + 1, 3): sums of gradient and hessian, rows; a missing value is in bin 0. One aggregate; what it returns is bounded by its shape."""
    at = rows.withColumn("node", F.expr(place(nodes, lambda n: str(n.node)))).where(F.col("node").isin(list(wanted)))
    each = at.select("node", "g", "h", F.posexplode(F.array(*[f"b{i}" for i in range(n_features)])).alias("feature", "bin"))
    sums = each.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")).toPandas()
    out = {k: np.zeros((n_features, n_bins + 1, 3)) for k in wanted}
    for k in wanted:
        s = sums[sums["node"] == k]
        out[k][s["feature"].to_numpy(), s["bin"].to_numpy() + 1] = s[["g", "h", "n"]].to_numpy(float)
    return out


def best_split(hist: np.ndarray, allowed: Sequence[int], least_rows: int, least_hessian: float) -> tuple[float, int, int, bool] | None:
    """(gain, feature, bin, missing left) of the split that gains most: up to and with the bin to the left; after the last bin, only missing values are to the right. Ties: smaller feature, smaller bin, missing to the right.

    None where no split gains anything with enough rows and hessian on both sides.
    """
    total = hist[allowed[0]].sum(axis=0)
    known, gone = hist[:, 1:].cumsum(axis=1), hist[:, :1]
    best = None
    for side, left in ((False, known), (True, known + gone)):
        right = total - left
        enough = (left[..., 2] >= least_rows) & (right[..., 2] >= least_rows) & (left[..., 1] / UNIT >= least_hessian) & (right[..., 1] / UNIT >= least_hessian)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left[..., 0] ** 2 / left[..., 1] + right[..., 0] ** 2 / right[..., 1] - total[0] ** 2 / total[1]) / UNIT
        gain = np.where(enough, gain, -np.inf)
        for f in allowed:
            b = int(np.argmax(gain[f]))
            if gain[f, b] > 1e-12:
                place = (-float(gain[f, b]), f, b, side)
                if best is None or place < best:
                    best = place
    return None if best is None else (-best[0], *best[1:])


def grow(rows: DataFrame, tree: int, edges: list[list[float]], allowed: Sequence[int], params: dict) -> list[Node]:
    """One tree on ``rows`` (bins, g and h), best-first. The nodes come out in the order in which splits make them."""
    n_features, n_bins = len(edges), 1 + max(map(len, edges), default=0)
    all_nodes = [Node(tree, 0)]
    depths, hists, splits = {0: 0}, {}, {}

    def learn(found: dict[int, np.ndarray]) -> None:
        for k, h in found.items():
            hists[k] = h
            total = h[0].sum(axis=0)
            all_nodes[k].n_rows = int(total[2])
            all_nodes[k].value = float(-total[0] / total[1]) if total[1] > 0 else 0.0
            deep = 0 <= params["max_depth"] <= depths[k]
            splits[k] = None if deep else best_split(h, allowed, params["min_data_in_leaf"], params["min_hessian"])

    def run_ahead() -> tuple[list[int], list[int]]:
        """Nodes in the order in which the queue splits them with what is known, and those of them without children yet."""
        queue = [(-splits[0][0], 0)] if splits[0] else []
        order, lacking = [], []
        while queue and 1 + len(order) < params["num_leaves"]:
            _, k = heapq.heappop(queue)
            order.append(k)
            n = all_nodes[k]
            if n.left < 0:
                lacking.append(k)
                continue
            for child in (n.left, n.right):
                if splits[child]:
                    heapq.heappush(queue, (-splits[child][0], child))
        return order, lacking

    learn(histograms(rows, all_nodes, [0], n_features, n_bins))
    while True:
        order, lacking = run_ahead()
        if not lacking:
            break
        small = {}
        for k in lacking:
            n = all_nodes[k]
            n.gain, n.feature, n.bin, n.missing_left = splits[k]
            n.threshold = edges[n.feature][n.bin] if n.bin < len(edges[n.feature]) else LARGEST
            n.left, n.right = len(all_nodes), len(all_nodes) + 1
            all_nodes += [Node(tree, n.left), Node(tree, n.right)]
            depths[n.left] = depths[n.right] = depths[k] + 1
            row = hists[k][n.feature]
            n_left = row[1 : n.bin + 2, 2].sum() + (row[0, 2] if n.missing_left else 0)
            small[k] = n.left if 2 * n_left <= row[:, 2].sum() else n.right
        found = histograms(rows, all_nodes, list(small.values()), n_features, n_bins)
        for k in lacking:
            other = all_nodes[k].left + all_nodes[k].right - small[k]
            found[other] = hists[k] - found[small[k]]
        learn(found)
    # Splits that the last run of the queue didn't reach were looked at too early: their nodes are leaves.
    new = {0: 0}
    for k in order:
        for child in (all_nodes[k].left, all_nodes[k].right):
            new[child] = len(new)
    out = []
    for old, number in new.items():
        n = all_nodes[old]
        n.node = number
        if old in order:
            n.left, n.right, n.value = new[n.left], new[n.right], 0.0
        else:
            n.feature, n.bin, n.threshold, n.missing_left, n.left, n.right, n.gain = -1, 0, 0.0, False, -1, -1, 0.0
            n.value *= params["learning_rate"]
        out.append(n)
    return sorted(out, key=lambda n: n.node)


# -- boosting ---------------------------------------------------------------------------------------------------------


def train(
    data: DataFrame, features: Sequence[str], label: str, val_col: str | None = None, params: dict | None = None, seed: int = 42, patience: int = 10, edges: list[list[float]] | None = None,
) -> BoostedTrees:
    """Boosted trees for a 0/1 label, on the rows where ``val_col`` isn't true; rows without a label take no part.

    Each round is fitted once. With validation rows, training stops ``patience`` rounds after the lowest validation loss,
    and the model keeps the rounds up to it; ``losses`` keeps all. ``edges`` replaces the quantile cut points. Without
    training rows, or with one class only, there is no tree.
    """
    p = {**DEFAULTS, **OWN_DEFAULTS, **(params or {})}
    if unknown := set(p) - set(DEFAULTS) - set(OWN_DEFAULTS):
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    features = list(features)
    known = data.where(F.col(f"`{label}`").isNotNull())
    fitted = known.where(~F.col(val_col)) if val_col else known
    edges = edges or cut_points(fitted, features, p["max_bin"])
    with Workspace(data.sparkSession) as work:
        rows = work.materialize(binned(known, features, edges, label, val_col))
        of = ~F.col("is_val")
        n, positive, n_val = rows.agg(F.count_if(of), F.sum(F.when(of, F.col("label"))), F.count_if(~of)).first()
        if not n or positive in (0, n):
            return BoostedTrees(features, edges, 0.0 if not n else math.log(1e-15) * (1 if positive == 0 else -1))
        model = BoostedTrees(features, edges, math.log(positive / (n - positive)))
        scored = rows.withColumn("score", F.lit(model.base))
        fitted_trees: list[list[Node]] = []
        best = 0
        for t in range(p["num_boost_round"]):
            rng = random.Random(f"{seed}:{t}")
            allowed = sorted(rng.sample(range(len(features)), max(1, round(p["feature_fraction"] * len(features)))))
            turn = t // p["bagging_freq"] if p["bagging_freq"] else 0
            drawn = F.pmod(F.xxhash64("draw", F.lit(seed), F.lit(turn)), F.lit(1 << 20)) < int(p["bagging_fraction"] * (1 << 20))
            prob = 1.0 / (1.0 + F.exp(-F.col("score")))
            whole = lambda x: F.rint(x * UNIT).cast("bigint")
            taken = scored.where(~F.col("is_val") & drawn).withColumn("p", prob)
            tree = grow(taken.select(*[f"b{i}" for i in range(len(features))], whole(F.col("p") - F.col("label")).alias("g"), whole(F.col("p") * (1 - F.col("p"))).alias("h")), t, edges, allowed, p)
            if len(tree) == 1:
                break  # nothing gains any more
            moved = scored.withColumn("score", F.col("score") + F.expr(place(tree, lambda n: f"{n.value!r}D")))
            loss = F.log1p(F.exp(-F.abs("score"))) + F.greatest("score", F.lit(0.0)) - F.col("score") * F.col("label")
            seen = Observation()
            mark = len(work.paths)
            scored = work.materialize(moved.observe(seen, F.avg(F.when(of, loss)).alias("fitted"), F.avg(F.when(~of, loss)).alias("val")))
            if t:
                work.paths[mark - 1 : mark], old = [], work.paths[mark - 1 : mark]
                work.paths = [*old, *work.paths]  # the scores of the round before; the binned rows stay first
                _drop(work, old)
            fitted_trees.append(tree)
            model.losses.append((seen.get["fitted"], seen.get["val"]))
            if n_val:
                if model.losses[t][1] < model.losses[best][1]:
                    best = t
                elif t - best >= patience:
                    break
        keep = fitted_trees[: best + 1] if n_val else fitted_trees
        model.nodes = [node for tree in keep for node in tree]
        return model


def _drop(work: Workspace, paths: list[str]) -> None:
    """Tables of a workspace that aren't read any more."""
    rest = [x for x in work.paths if x not in paths]
    work.paths = [*rest, *paths]
    work.release(len(rest))
