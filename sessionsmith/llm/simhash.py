"""Near-duplicates by SimHash fingerprints, found by meeting in the middle.

Two fingerprints within distance 2r have a value within r of both. So every distinct fingerprint stands for its ball: all
values that differ from it in at most r bits. Values of two balls that collide link their fingerprints.

A ball has thousands of values, so it travels folded: the shuffle key is what a value holds in ``key_bits`` fixed bit
positions, a fingerprint is sent once to each key that its ball touches, and the task that holds a key unfolds the rest of
the ball there (the flips that are left over, in the other positions). All values with one key are in one task, so every
collision is seen, at a small part of the rows. A key with more values than a task holds at a time is folded once more on
further fixed positions, and again until all are fixed: whether it is depends on the key alone, so each value still has one.

Balls that collide in one value are all within 2r of each other, so each colliding value links its members in a star, not
pairwise. Links are reduced to a spanning forest in each task before they leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, stored

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Fixed positions that make the shuffle key.
KEY_BITS = 16
#: Unfolded values that a task holds at a time.
VALUES_AT_ONCE = 3_000_000
#: Rows (fingerprint, key) for one task.
ROWS_EACH = 1_000_000


def fingerprint(raw: bytes, width: int = SHINGLE) -> int:
    """SimHash of a text's lower-cased ``width``-word shingles, repeats included; zero without words."""
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *stops[:-1]]
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - width + 1)
    span = min(width, len(words)) - 1
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, 1 << 16):
        b = min(n, a + (1 << 16))
        hashes = np.array([digest(text[i : j - 1], SEED) for i, j in zip(starts[a:b], stops[a + span : b + span], strict=True)], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a long) of each row's whole text; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.large_binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", width) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([*batch.columns[: len(keep)], pa.array(fps)], names=[*keep, "fp"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), "fp bigint"])
    return in_batches(docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`")), run, schema)


def flips(positions: list[int], most: int) -> np.ndarray:
    """Every mask of at most ``most`` of the bit ``positions``, the empty one first."""
    return np.array([sum(1 << p for p in c) for k in range(most + 1) for c in combinations(positions, k)], np.uint64)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A smaller set of links with the same components: every node but the smallest of its component, linked to that."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    kept = root != np.arange(len(nodes))
    return nodes[root[kept]], nodes[kept]


def links(fps: DataFrame, distance: int = DISTANCE, key_bits: int = KEY_BITS, rows_each: int = ROWS_EACH) -> DataFrame:
    """Links (a, b), a before b, that connect all distinct fingerprints of column ``fp`` within an even ``distance`` of each other, directly or by way of others that are.

    ``fps`` must hold each fingerprint once and be a stored table.
    """
    if distance < 2 or distance % 2:
        raise ValueError("the distance must be even and at least 2")
    radius = distance // 2
    found = [linked(rows, mask, rest, radius, rows_each) for rows, mask, rest in folded(fps, radius, key_bits)]
    return reduce(DataFrame.unionByName, found).distinct()


def folded(fps: DataFrame, radius: int, key_bits: int) -> Iterator[tuple[DataFrame, int, list[np.ndarray]]]:
    """Per level, the rows (fp, key) whose key isn't folded further, the mask of the positions fixed so far, and the flips of at most 0, 1, … ``radius`` of the others.

    Values are counted per key from the fingerprints' own bits, before any row is sent. The list of folded keys
    grows with the fingerprints (at most all values divided by ``VALUES_AT_ONCE``), so Spark joins it by its measured size, by shuffle beyond that.
    """
    step = BITS // key_bits
    inner = [p * step for p in range(key_bits)]
    outer = [p for p in range(BITS) if p not in inner]
    n = -(-len(outer) // key_bits)
    fixed = 0
    rows = fps.select("fp", F.lit(0).cast("long").alias("key"), F.lit(radius).alias("left_over"))
    for positions in [inner, *(outer[i::n] for i in range(n))]:
        here = sum(1 << p for p in positions)
        fixed |= here
        free = [p for p in range(BITS) if not fixed >> p & 1]
        rest = [flips(free, k) for k in range(radius + 1)]
        masks = F.array(*[F.array(*[F.lit(signed(m)) for m in flips(positions, k)]) for k in range(radius + 1)])[F.col("left_over")]
        own = F.col("fp").bitwiseAND(F.lit(signed(here))).bitwiseOR(F.col("key"))
        to = [F.col("own").bitwiseXOR(F.col("m")).alias("key"), (F.col("left_over") - F.bit_count("m")).alias("left_over")]
        sent = rows.select("fp", own.alias("own"), "left_over", F.explode(masks).alias("m")).select("fp", *to)
        hot = None
        if free and fps.count() * len(rest[radius]) > VALUES_AT_ONCE:
            alike = rows.groupBy(own.alias("own"), "left_over").agg(F.count(F.lit(1)).alias("n"))
            values = F.col("n") * F.array(*[F.lit(len(r)) for r in rest])[F.col("left_over")]
            keys = alike.select("own", "left_over", "n", F.explode(masks).alias("m")).select(*to, "n").groupBy("key").agg(F.sum(values).alias("n_values"))
            hot = stored(keys.where(F.col("n_values") > VALUES_AT_ONCE).select("key"))
        if hot is None or hot.isEmpty():
            yield sent.select("fp", "key"), fixed, rest
            return
        yield sent.join(hot, "key", "left_anti").select("fp", "key"), fixed, rest
        rows = stored(sent.join(hot, "key", "left_semi"))


def signed(x: int) -> int:
    return int(np.uint64(x).astype(np.int64))


def linked(rows: DataFrame, mask: int, rest: list[np.ndarray], radius: int, rows_each: int) -> DataFrame:
    """Links of the fingerprints that ``rows`` (fp, key) send to each key."""
    parts = max(1, -(-rows.count() // rows_each))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy().view(np.uint64)) for b in batches]
        if not got:
            return
        fp, key = (np.concatenate(x) for x in zip(*got, strict=True))
        del got
        left_over = radius - np.bitwise_count((fp ^ key) & np.uint64(mask)).astype(np.int64)
        weight = np.array([len(r) for r in rest])[left_over]
        with np.errstate(over="ignore"):
            order = np.argsort(key * np.uint64(0x9E3779B97F4A7C15), kind="stable")
        fp, key, left_over, weight = fp[order], key[order], left_over[order], weight[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.add.reduceat(weight, first)
        chunk = np.cumsum(sizes) // VALUES_AT_ONCE  # whole keys
        begins = first[np.concatenate([[True], chunk[1:] != chunk[:-1]])]
        a_all, b_all = [], []
        for i, j in zip(begins, [*begins[1:], len(fp)], strict=True):
            a, b = collisions(fp[i:j], key[i:j], left_over[i:j], rest, np.uint64(mask))
            a_all.append(a)
            b_all.append(b)
            if sum(map(len, a_all)) > VALUES_AT_ONCE:
                a, b = forest(np.concatenate(a_all), np.concatenate(b_all))
                a_all, b_all = [a], [b]
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        if not len(a):
            return
        yield pa.record_batch([pa.array(x.view(np.int64)) for x in forest(a, b)], names=["a", "b"])

    return in_batches(rows.repartition(int(parts), "key"), run, "a bigint, b bigint")


def collisions(fp: np.ndarray, key: np.ndarray, left_over: np.ndarray, rest: list[np.ndarray], mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Links of the fingerprints whose balls collide in a value with one of these keys. A hot key is unfolded in slices of its other bits."""
    total = int(sum(len(rest[k]) * np.count_nonzero(left_over == k) for k in range(len(rest))))
    slices = max(1, -(-total // VALUES_AT_ONCE))
    found_a, found_b = [], []
    base = (fp & ~mask) | key
    for s in range(slices):
        values, owners = [], []
        for k, masks in enumerate(rest):
            own = np.flatnonzero(left_over == k)
            for x in range(0, len(own), max(1, VALUES_AT_ONCE // len(masks))):
                some = own[x : x + max(1, VALUES_AT_ONCE // len(masks))]
                v = (base[some, None] ^ masks[None, :]).ravel()
                o = np.repeat(some, len(masks))
                if slices > 1:
                    with np.errstate(over="ignore"):
                        mine = ((v * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) % np.uint64(slices) == s
                    v, o = v[mine], o[mine]
                values.append(v)
                owners.append(o)
        v, o = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(v, kind="stable")
        v, o = v[order], o[order]
        new = np.concatenate([[True], v[1:] != v[:-1]])
        head = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
        hit = ~new
        a, b = fp[o[head[hit]]], fp[o[hit]]
        pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.uint64)
        found_a.append(pair[0])
        found_b.append(pair[1])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if len(a) and (np.bitwise_count(a ^ b) > 2 * (len(rest) - 1)).any():
        raise AssertionError("a collision links distant fingerprints")
    return forest(a, b) if len(a) else (a, b)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node of its component.

    Alternates two steps until nothing changes: each node's larger neighbours are linked to its smallest neighbour, then its
    smaller ones. Each step is one minimum per node and one join, with the results stored in the shared folder: lineage
    stays short, and as the join deals out both its sides anew, Spark can split the links of a node that has very many.
    """
    edges = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        large = stored(large)
        low = stored(large.groupBy("u").agg(F.min("v").alias("low")))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        edges = stored(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), width: int = SHINGLE, distance: int = DISTANCE, key_bits: int = KEY_BITS) -> DataFrame:
    """``key``, ``keep`` columns, ``fp``, ``root`` (smallest fingerprint of the component) and ``component`` (smallest key in it) of every row.

    Null and empty texts, and texts without words, have fingerprint zero and are linked like any other. Rows that repeat a
    key keep their own row. Null keys never are a component's name unless all its keys are null. Other columns are not
    read; an empty table gives an empty one. Exact copies share a fingerprint and are one node, however many there are.
    """
    fps = stored(fingerprints(docs, [key, *keep], text, width))
    nodes = stored(fps.groupBy("fp").agg(F.min(key).alias("first")))
    linked = stored(components(links(nodes.select("fp"), distance, key_bits)))
    named = stored(nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"))
    names = named.join(stored(named.groupBy("root").agg(F.min("first").alias("component"))), "root").select("fp", "root", "component")
    return fps.join(names, "fp").select(key, *keep, "fp", "root", "component")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
