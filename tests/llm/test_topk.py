from __future__ import annotations

import math

import numpy as np
import pytest

from sessionsmith.llm import topk as T


def brute(rows, asked, k=5):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    there = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for i, v in {(i, tuple(v)): (i, v) for i, v in there if asked(i)}.values():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in there if j != i and len(w) == len(v))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block_rows": 60, "chunk_rows": 4}])
def test_against_brute_force(spark, rng, monkeypatch, options):
    """Ties, copies, repeated ids, several lengths, nulls and other values that are no numbers."""
    monkeypatch.setattr(T, "PAGE", 8)
    monkeypatch.setattr(T, "FANOUT", 4)
    rows = []
    for i in range(300):
        v = [rng.choice([-0.5, 0.0, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(rng.choice([3, 3, 3, 3, 2, 0, 1]))]
        if rng.random() < 0.06:
            v = rng.choice([None, [None, 0.1, 0.2], [math.nan, 0.1, 0.1], [math.inf, 0.0, 0.0]])
        rows.append((rng.choice([i, i // 2, None]) if rng.random() < 0.2 else i, v))
    rows += rows[:10] + [(1000 + i, [0.5, 0.5, 0.5]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS id", "2 AS block", "3 AS dim")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(tuple(r) for r in T.top_k(df, df.where("vec_id % 5 = 0"), 5, **options).collect())
    assert got == brute(rows, lambda i: i % 5 == 0)


def test_tree_bounds():
    """Covering radii and stored distances are those of the pages; a search skips pages when it can."""
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(30, 6)) * 1000
    x = np.floor(np.repeat(centers, 200, axis=0) + rng.normal(size=(6000, 6)))
    most = float((x * x).sum(axis=1).max())
    lifted = T.lifted(x, most)
    pages = list(T.bulk_loaded(lifted))
    below = {p["page"]: list(p["rows"]) for p in pages}
    for p in reversed(pages):
        if p["parent"] >= 0:
            below[p["parent"]] += below[p["page"]]
    for p in pages:
        assert T.distances(lifted[below[p["page"]]], p["routing"]).max() <= p["radius"] + 1e-6
        if p["parent"] >= 0:
            assert abs(T.distances(pages[p["parent"]]["routing"][None], p["routing"])[0] - p["to_parent"]) < 1e-6
        p["ids"], p["points"] = p["rows"], x[p["rows"]]
    assert sorted(below[0]) == list(range(6000))
    tree = T.Tree(pages, most)
    seen = []
    tree.pages = {k: _Seen(p, seen) for k, p in tree.pages.items()}
    for q in range(0, 6000, 600):
        seen.clear()
        best = sorted(tree.search(x[q], q, 3, -np.inf), reverse=True)
        scores = x @ x[q]
        scores[q] = -np.inf
        assert [s for s, _ in best] == sorted(scores, reverse=True)[:3]
    assert len(set(seen)) < len(pages)


class _Seen(dict):
    def __init__(self, page, seen):
        super().__init__(page)
        self.seen = seen

    def __getitem__(self, name):
        if name == "points":
            self.seen.append(super().__getitem__("page"))
        return super().__getitem__(name)


def test_empty_and_few(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert T.top_k(empty, empty, 5).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, T.top_k(two, two, 5).collect())) == [(0, 1, 1, 256 * 128), (1, 1, 0, 256 * 128)]
