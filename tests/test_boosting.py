"""Leaf-wise boosting against a brute-force tree on rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from sessionsmith.operators import boosting as B

NAMES = ["x", "y", "z"]
EDGES = [[1.0, 2.0, 3.0, 5.0, 8.0], [0.5], [10.0, 20.0, 30.0]]
PARAMS = {"num_boost_round": 1, "num_leaves": 6, "bagging_fraction": 1.0, "feature_fraction": 1.0, "min_data_in_leaf": 5}


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    out = []
    for i in range(400):
        x = None if rnd.random() < 0.2 else float(rnd.randint(0, 9))
        y = float("nan") if rnd.random() < 0.1 else rnd.choice([0.0, 1.0])
        z = float(rnd.randint(0, 40))
        odds = (2 if x is None else 0.3 * x) + (z > 20) * 1.5 - 2
        out.append((i, x, y, z, int(rnd.random() < 1 / (1 + math.exp(-odds))), i % 5 == 0))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, x double, y double, z double, label int, is_val boolean")


def known(v):
    return v is not None and v == v


def brute_tree(rows, leaves, least):
    """Best-first, one split at a time, every split tried on the rows themselves."""
    p = sum(r[4] for r in rows) / len(rows)
    g = {r[0]: round((p - r[4]) * B.UNIT) for r in rows}
    h = round(p * (1 - p) * B.UNIT)

    def sums(some):
        return sum(g[r[0]] for r in some), h * len(some)

    def best(some):
        found = None
        gt, ht = sums(some)
        for f in range(3):
            for b, cut in enumerate([*EDGES[f], math.inf]):
                for missing_left in (False, True):
                    left = [r for r in some if (r[1 + f] <= cut if known(r[1 + f]) else missing_left)]
                    if len(left) < least or len(some) - len(left) < least:
                        continue
                    ids = {r[0] for r in left}
                    right = [r for r in some if r[0] not in ids]
                    (gl, hl), (gr, hr) = sums(left), sums(right)
                    gain = (gl**2 / hl + gr**2 / hr - gt**2 / ht) / B.UNIT
                    if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                        found = (gain, f, b, missing_left, left, right)
        return found

    tree = {"rows": rows, "split": best(rows)}
    open_ = [tree]
    for _ in range(leaves - 1):
        open_ = [n for n in open_ if n["split"]]
        if not open_:
            break
        n = max(open_, key=lambda n: n["split"][0])
        open_.remove(n)
        n["kids"] = [{"rows": side, "split": best(side)} for side in n["split"][4:]]
        open_ += n["kids"]

    def shape(n):
        if "kids" not in n:
            gs, hs = sums(n["rows"])
            return (len(n["rows"]), pytest.approx(-gs / hs * 0.05))
        return (n["split"][1:4], pytest.approx(n["split"][0]), *[shape(k) for k in n["kids"]])

    return shape(tree)


def shape(nodes, at=0):
    n = nodes[at]
    if n.feature < 0:
        return (n.n_rows, n.value)
    return ((n.feature, n.bin, n.missing_left), n.gain, shape(nodes, n.left), shape(nodes, n.right))


@pytest.mark.parametrize("leaves", [2, 6, 40])
def test_tree_against_brute_force(frame, rows, leaves):
    model = B.train(frame, NAMES, "label", params={**PARAMS, "num_leaves": leaves}, edges=EDGES)
    assert shape(model.nodes) == brute_tree(rows, leaves, 5)


def test_scores_follow_the_nodes(frame, rows):
    model = B.train(frame, NAMES, "label", params=PARAMS, edges=EDGES)

    def leaf(r):
        n = model.nodes[0]
        while n.feature >= 0:
            v = r[1 + n.feature]
            n = model.nodes[n.left if (v <= n.threshold if known(v) else n.missing_left) else n.right]
        return model.base + n.value

    got = {r["id"]: r["p"] for r in B.predict(model, frame).collect()}
    assert got == {r[0]: pytest.approx(1 / (1 + math.exp(-leaf(r)))) for r in rows}


def test_rounds_stop_and_none_is_fitted_twice(frame, monkeypatch):
    """Training stops ``patience`` rounds after the best one; the model is the beginning of one that goes on; losses are those of its scores."""
    fitted = []
    grow = B.grow
    monkeypatch.setattr(B, "grow", lambda rows, tree, *a: fitted.append(tree) or grow(rows, tree, *a))
    params = {"num_boost_round": 40, "learning_rate": 0.6, "min_data_in_leaf": 5, "num_leaves": 8}
    model = B.train(frame, NAMES, "label", "is_val", params, patience=3)
    val = [v for _, v in model.losses]
    best = val.index(min(val))
    assert fitted == list(range(len(val))) and model.n_trees == best + 1 and len(val) == best + 4
    loss = B.predict(model, frame.where("is_val")).select(F.avg(-F.ln(F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))))).first()[0]
    assert loss == pytest.approx(val[best])
    longer = B.train(frame, NAMES, "label", "is_val", {**params, "num_boost_round": model.n_trees}, patience=99)
    assert longer.nodes == model.nodes


def test_same_however_rows_are_dealt(frame):
    params = {"num_boost_round": 3, "min_data_in_leaf": 5}
    a = B.train(frame, NAMES, "label", "is_val", params, edges=EDGES)
    b = B.train(frame.repartition(7, "z").orderBy("x"), NAMES, "label", "is_val", params, edges=EDGES)
    assert a.nodes == b.nodes


def test_saved_table_and_importance(spark, frame, tmp_path):
    model = B.train(frame, NAMES, "label", params={**PARAMS, "num_boost_round": 2}, edges=EDGES)
    again = B.load(spark, B.save(model, spark, str(tmp_path / "model")))
    assert again.nodes == model.nodes and again.edges == model.edges and again.losses == model.losses
    model.node_table(spark).createOrReplaceTempView("tree_nodes")
    want = {r[0]: r[1] for r in spark.sql("SELECT feature, sum(gain) FROM tree_nodes WHERE feature IS NOT NULL GROUP BY feature").collect()}
    got = {r["feature"]: r["importance"] for r in B.gain_importance(model.node_table(spark)).collect()}
    assert got == want == {f: pytest.approx(sum(n.gain for n in model.nodes if n.feature == i)) for i, f in enumerate(NAMES) if f in want}


def test_nothing_to_learn(spark, frame):
    for rows in (frame.limit(0), frame.withColumn("label", F.lit(1)), frame.withColumn("label", F.lit(None).cast("int"))):
        model = B.train(rows, NAMES, "label", params=PARAMS, edges=EDGES)
        assert model.nodes == [] and all(0 <= r["p"] <= 1 for r in B.predict(model, frame).collect())
    with pytest.raises(ValueError, match="maxDepth"):
        B.train(frame, NAMES, "label", params={"maxDepth": 3})
