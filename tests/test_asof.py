"""As-of join against a brute-force answer, in both directions, with ties,
tolerance and matches several time buckets away."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from sessionsmith.context import Workspace
from sessionsmith.operators.asof import asof_join
from sessionsmith.operators.asof_ranges import asof_join_ranges

BASE = dt.datetime(2024, 1, 1)


def _data(seed, n_left=60, n_right=40, keys=3):
    rnd = random.Random(seed)
    left = [(f"k{rnd.randrange(keys)}", BASE + dt.timedelta(minutes=rnd.randrange(0, 3000)), i) for i in range(n_left)]
    right = [
        (f"k{rnd.randrange(keys)}", BASE + dt.timedelta(minutes=rnd.randrange(0, 3000, 7)), rnd.randrange(5), f"v{i}")
        for i in range(n_right)
    ]
    left.append((None, BASE, 999))
    left.append(("k0", None, 998))
    return left, right


def _brute(left, right, direction, tol, exact=True):
    out = {}
    for k, t, i in left:
        cands = []
        for rk, rt, tie, v in right:
            if k is None or t is None or rk != k:
                continue
            ok = (rt >= t if exact else rt > t) if direction == "forward" else (rt <= t if exact else rt < t)
            if ok:
                cands.append((rt, tie, v))
        best = None
        if cands:
            best = min(cands) if direction == "forward" else max(cands)
            if tol is not None and abs((best[0] - t).total_seconds()) > tol:
                best = None
        out[i] = None if best is None else (best[0], best[2])
    return out


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("tol", [None, 3600])
@pytest.mark.parametrize("bucket", [600, 86400])
def test_matches_brute_force(spark, direction, tol, bucket):
    for seed in (1, 2):
        left, right = _data(seed)
        ldf = spark.createDataFrame(left, "k string, t timestamp_ntz, id int")
        rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz, tie int, v string")
        got = asof_join(
            ldf, rdf, by=["k"], left_time="t", right_time="rt", direction=direction, how="left",
            tie=["tie"], payload=["v"], tolerance_seconds=tol, matched_time="mt", bucket_seconds=bucket,
        ).collect()
        assert len(got) == len(left)
        want = _brute(left, right, direction, tol)
        for r in got:
            w = want[r["id"]]
            assert (None if r["v"] is None else (r["mt"], r["v"])) == w, (r, w)


def test_inner_drops_and_exact_flag(spark):
    left = [("a", BASE, 1), ("a", BASE + dt.timedelta(hours=5), 2)]
    right = [("a", BASE, 0, "same"), ("a", BASE + dt.timedelta(hours=1), 0, "later")]
    ldf = spark.createDataFrame(left, "k string, t timestamp_ntz, id int")
    rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz, tie int, v string")
    inner = asof_join(ldf, rdf, ["k"], "t", "rt", tie=["tie"], payload=["v"]).collect()
    assert {r["id"]: r["v"] for r in inner} == {1: "same"}
    strict = asof_join(ldf, rdf, ["k"], "t", "rt", tie=["tie"], payload=["v"], allow_exact=False).collect()
    assert {r["id"]: r["v"] for r in strict} == {1: "later"}


@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("tol", [None, 3600])
@pytest.mark.parametrize("exact", [True, False])
def test_ranges_match_brute_force(spark, direction, tol, exact):
    """Few keys and many ranges, so that most ranges begin inside a key and some hold no right row."""
    for seed, n_right in ((1, 40), (2, 6)):
        left, right = _data(seed, n_right=n_right)
        right += [(None, BASE, 0, "no key"), ("k0", None, 0, "no time")]
        ldf = spark.createDataFrame(left, "k string, t timestamp_ntz, id int")
        rdf = spark.createDataFrame(right, "k string, rt timestamp_ntz, tie int, v string")
        with Workspace(spark) as work:
            got = asof_join_ranges(
                ldf, rdf, by=["k"], left_time="t", right_time="rt", direction=direction, how="left",
                tie=["tie"], payload=["v"], tolerance_seconds=tol, matched_time="mt", allow_exact=exact, ranges=23, work=work,
            ).collect()
        want = _brute(left, [r for r in right if r[0] and r[1]], direction, tol, exact)
        assert sorted(r["id"] for r in got) == sorted(i for _, _, i in left)
        assert {r["id"]: None if r["v"] is None else (r["mt"], r["v"]) for r in got} == want


def test_ranges_cut_one_instant(spark):
    """All left rows of one key at one time, repeated rows too: no range holds more than a small part of them, and each row keeps its match."""
    n = 4000
    left = spark.range(n, numPartitions=8).selectExpr("'a' AS k", "TIMESTAMP_NTZ '2024-01-01 10:00:00' AS t", "CAST(id / 2 AS INT) AS id")
    right = spark.createDataFrame([("a", BASE, "old"), ("a", BASE + dt.timedelta(hours=9), "new"), ("b", BASE, "other")], "k string, rt timestamp_ntz, v string")
    with Workspace(spark) as work:
        out = asof_join_ranges(left, right, ["k"], "t", "rt", direction="backward", ranges=20, work=work)
        assert out.groupBy("v").count().collect() == [("new", n)]
        sizes = [r["count"] for r in spark.read.parquet(work.paths[0]).groupBy("__scan_p").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 0.15 * n


def test_ranges_edges(spark):
    """Empty sides, several keys with a null in one, all left columns whatever their names, inner join."""
    left = spark.createDataFrame([(1, "x", BASE, "l"), (1, None, BASE, "n")], "a int, b string, t timestamp_ntz, `a.dot` string").withColumnRenamed("a.dot", "p0")
    right = spark.createDataFrame([(1, "x", BASE, 7)], "a int, b string, rt timestamp_ntz, v int")
    with Workspace(spark) as work:
        rows = asof_join_ranges(left, right, ["a", "b"], "t", "rt", how="left", work=work).collect()
        assert sorted((r["p0"], r["v"]) for r in rows) == [("l", 7), ("n", None)] and rows[0].__fields__ == ["a", "b", "t", "p0", "v"]
        assert [r["p0"] for r in asof_join_ranges(left, right, ["a", "b"], "t", "rt", work=work).collect()] == ["l"]
        none = right.where("false")
        assert [r["v"] for r in asof_join_ranges(left, none, ["a", "b"], "t", "rt", how="left", work=work).collect()] == [None, None]
        assert asof_join_ranges(left.where("false"), right, ["a", "b"], "t", "rt", how="left", work=work).count() == 0
    with pytest.raises(ValueError):
        asof_join_ranges(left, right, ["a"], "t", "rt", direction="both")
