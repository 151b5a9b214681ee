from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from sessionsmith.llm import simhash as S


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance=4):
    close = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(len(fps))
    while True:
        new = np.array([label[c].min() for c in close])
        if (new == label).all():
            return label
        label = new


def test_fingerprints_and_spark_hash(spark, docs_of, rng):
    texts = [None, "", " \t", "One", "É Ärger THE the", "a b c", "a b c d", "a b c d"] + [" ".join(rng.choice("abcDEFé") for _ in range(rng.randint(1, 40))) for _ in range(100)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.hex for r in S.fingerprints(docs_of(rows, "doc_id bigint, text string"), ["doc_id"]).withColumn("hex", S.hex_digits(F.col("fp"))).collect()}
    assert got == {i: f"{brute_fingerprint(t):016x}" for i, t in rows}
    # the hash is Spark's own
    assert spark.sql("SELECT xxhash64('a b c d') AS h").first().h == np.array([xxhash.xxh64_intdigest(b"a b c d", 42)], np.uint64).view(np.int64)[0]


@pytest.mark.parametrize(("key_bits", "distance"), [(16, 4), (8, 4), (32, 4), (16, 2), (16, 6)])
def test_links_lose_nothing(spark, key_bits, distance):
    rng = np.random.default_rng(3)
    fps = [0, 1, 3, 2**63]
    for center in rng.integers(0, 2**63, 25, dtype=np.uint64):
        for _ in range(20):
            x = int(center)
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                x ^= 1 << int(b)
            fps.append(x)
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    root = {r.node: r.root for r in S.components(S.links(df, distance, key_bits, rows_each=5_000)).collect()}
    got, want = [root.get(x, x) for x in fps.view(np.int64).tolist()], brute_components(fps, distance).tolist()
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_hot_key_in_slices(monkeypatch):
    """A key with more values than fit is unfolded piece by piece, with the same links."""
    rng = np.random.default_rng(5)
    fps = np.unique(np.array([int(rng.integers(0, 4)) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, 4))) for _ in range(120)], np.uint64))
    whole = S.collisions(fps, fps & np.uint64(1), np.full(len(fps), 2), [S.flips(list(range(1, 64)), k) for k in range(3)], np.uint64(1))
    monkeypatch.setattr(S, "VALUES_AT_ONCE", 20_000)
    sliced = S.collisions(fps, fps & np.uint64(1), np.full(len(fps), 2), [S.flips(list(range(1, 64)), k) for k in range(3)], np.uint64(1))
    assert set(zip(*whole, strict=True)) == set(zip(*sliced, strict=True))


@pytest.mark.parametrize("bound", [20_000, 1_500])
def test_hot_key_is_dealt_out(spark, monkeypatch, bound):
    """Many distinct fingerprints with the same bits in all key positions: no key brings a task more values than the bound, and no link is lost."""
    rng = np.random.default_rng(11)
    others = [p for p in range(64) if p % 4]
    fps = [0]
    for center in rng.integers(0, 2**63, 30, dtype=np.uint64):
        base = sum(1 << p for p in others if int(center) >> p & 1)
        fps += [base ^ sum(1 << int(p) for p in rng.choice(others, rng.integers(0, 5), replace=False)) for _ in range(8)]
    fps = np.unique(np.array(fps, np.uint64))
    sent, batches = [], S.in_batches
    monkeypatch.setattr(S, "VALUES_AT_ONCE", bound)
    monkeypatch.setattr(S, "in_batches", lambda df, run, schema: sent.append(df) or batches(df, run, schema))
    df = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    root = {r.node: r.root for r in S.components(S.links(df)).collect()}
    got, want = [root.get(x, x) for x in fps.view(np.int64).tolist()], brute_components(fps).tolist()
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))
    for level, rows in enumerate(sent):
        fp, key = (np.array(x, np.int64).view(np.uint64) for x in zip(*rows.collect(), strict=True))
        fixed = np.uint64(sum(1 << p for p in range(64) if p % 4 <= level))
        ball = np.cumsum([math.comb(48 - 16 * level, k) for k in range(3)])
        values = pd.Series(ball[2 - np.bitwise_count((fp ^ key) & fixed).astype(int)]).groupby(key).sum()
        assert values.max() <= bound


def test_near_duplicates_edges(docs_of, spark, rng):
    base = [f"w{rng.randrange(999)}" for _ in range(400)]
    near = base.copy()
    near[200] = "changed"
    rows = [(5, " ".join(base)), (9, " ".join(near)), (9, " ".join(near)), (None, " ".join(base).upper()), (7, None), (8, ""), (6, " \n"), (None, "quite something else here"), (3, " ".join(f"v{i}" for i in range(200_000)))]
    got = sorted(((r.doc_id, r.component) for r in S.near_duplicates(docs_of(rows, "doc_id bigint, text string")).collect()), key=str)
    fps = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    label = brute_components(fps)
    want = [(k, min((rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None), default=None)) for i, (k, _) in enumerate(rows)]
    assert got == sorted(want, key=str)
    assert S.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in S.components(edges).collect()} == {0}
