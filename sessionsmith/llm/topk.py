"""Exact top-k by inner product: best-first search in M-trees.

Inner products become distances: with one more coordinate, sqrt(M - |x|^2) for vectors and 0 for queries, M the greatest
|x|^2, the squared distance of query and vector is |q|^2 + M - 2 q.x. So the largest products are the least distances, in a
metric space.

Vectors go to the cell of their nearest pivot, large cells are split by a hash, and each block has an M-tree: pages with a
routing object, a covering radius and the distance to the parent's routing object; leaf pages keep that distance for every
entry. A search takes pages from a queue by their least possible distance and stops where that exceeds the k-th best. The
stored distances bound a child's or an entry's distance from below by the triangle inequality, and only what that leaves is
computed. Products are computed from whole numbers, so scores and ties are exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_batches, stored

#: Entries of a leaf page, and children of an inner one.
PAGE = 512
FANOUT = 16
#: Vectors of one block, about: one task builds its tree and holds it while it searches.
BLOCK_ROWS = 8_192
#: Queries of one chunk, about: a task searches one block for one chunk.
CHUNK_ROWS = 4_096
#: The pivots, and the sample whose best products are each query's first bound, are drawn from this many vectors at most, by a hash.
SAMPLE_ROWS = 1_024
PIVOTS = 16
#: A list of blocks up to this long is broadcast.
BROADCAST_BLOCKS = 500_000
#: Bounds are computed in floating point: nothing is skipped that is within this of the k-th best, relatively.
SLACK = 1e-9


def flat(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def rows_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The arrays of a list column."""
    out = []
    for chunk in column.chunks:
        values, bounds = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
        out += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))])


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - to) ** 2).sum(axis=1))


def spread_out(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows far from each other at most, fewer if others repeat them. The first is the one nearest the mean."""
    chosen = [int(np.argmin(distances(x, x.mean(axis=0))))]
    near = distances(x, x[chosen[0]])
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(np.argmax(near)))
        near = np.minimum(near, distances(x, x[chosen[-1]]))
    return x[chosen]


def nearest(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Which of the rows ``to`` is nearest to each row of ``x``."""
    return np.argmin((to * to).sum(axis=1) - 2 * (x @ to.T), axis=1)


def parted(x: np.ndarray, n: int) -> list[np.ndarray]:
    """Rows of ``x`` in up to ``n`` groups around centers: some rows at equal steps, moved twice to the mean of their group. Equal shares if all rows are alike."""
    centers = x[np.linspace(0, len(x) - 1, n).astype(np.int64)]
    for _ in range(2):
        side = nearest(x, centers)
        centers = np.stack([x[side == k].mean(axis=0) if (side == k).any() else centers[k] for k in range(n)])
    side = nearest(x, centers)
    groups = [np.flatnonzero(side == k) for k in range(n)]
    groups = [g for g in groups if len(g)]
    return groups if len(groups) > 1 else np.array_split(np.arange(len(x)), n)


def bulk_loaded(x: np.ndarray) -> Iterator[dict]:
    """Pages of an M-tree over the lifted vectors ``x``: the root is page 0, parents come before children. ``rows`` of a leaf number its entries. A routing object is the mean of what it covers."""
    todo = [(np.arange(len(x)), -1, None)]
    page = 0
    while todo:
        rows, parent, above = todo.pop()
        routing = x[rows].mean(axis=0)
        own = distances(x[rows], routing)
        leaf = len(rows) <= PAGE
        yield {"page": page, "parent": parent, "leaf": leaf, "routing": routing, "radius": float(own.max(initial=0.0)), "to_parent": 0.0 if above is None else float(np.sqrt(((routing - above) ** 2).sum())), "rows": rows if leaf else rows[:0], "entry": own if leaf else own[:0]}
        if not leaf:
            todo += [(rows[g], page, routing) for g in parted(x[rows], min(FANOUT, -(-len(rows) * 5 // (4 * PAGE)) + 1))]
        page += 1


class Tree:
    """A block's pages, ready to be searched."""

    def __init__(self, pages: list[dict], most: float):
        self.most = most
        self.pages = {p["page"]: p for p in pages}
        self.children: dict[int, list[int]] = {}
        for p in pages:
            self.children.setdefault(p["parent"], []).append(p["page"])
        self.family = {}
        for parent, own in self.children.items():
            self.family[parent] = (own, np.array([self.pages[c]["routing"] for c in own]), np.array([self.pages[c]["radius"] for c in own]), np.array([self.pages[c]["to_parent"] for c in own]))

    def search(self, query: np.ndarray, own_id: int, k: int, bound: float) -> list[tuple[float, int]]:
        """Up to ``k`` of the best (score, id), other than the query's own id; any that are missing have scores below ``bound``."""
        square = float(query @ query) + self.most
        q = np.append(query, 0.0)
        best: list[tuple[float, int]] = []  # a heap of (score, -id): its first is the worst

        def reach() -> float:
            """Beyond this distance nothing can count any more."""
            least = max(bound, best[0][0]) if len(best) == k else bound
            gap = square - 2 * least
            return np.sqrt(max(0.0, gap + SLACK * (abs(square) + 2 * abs(least)))) + SLACK if np.isfinite(least) else np.inf

        root = self.children[-1][0]
        far = float(np.sqrt(((q - self.pages[root]["routing"]) ** 2).sum()))
        queue = [(max(0.0, far - self.pages[root]["radius"]), root, far)]
        limit = reach()
        while queue:
            least, number, far = heapq.heappop(queue)
            if least > limit:
                break
            page = self.pages[number]
            if page["leaf"]:
                near = np.flatnonzero(np.abs(far - page["entry"]) <= limit)  # others are too far by the triangle inequality
                if not len(near):
                    continue
                scores, ids = page["points"][near] @ query, page["ids"][near]
                good = (scores >= (max(bound, best[0][0]) if len(best) == k else bound)) & (ids != own_id)
                scores, ids = scores[good], ids[good]
                if len(scores) > 4 * k:
                    some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]  # with all ties of the last
                    scores, ids = scores[some], ids[some]
                for s, i in zip(scores.tolist(), ids.tolist(), strict=True):
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                limit = reach()
            else:
                own, routing, radius, to_parent = self.family[number]
                maybe = np.flatnonzero(np.abs(far - to_parent) - radius <= limit)
                if len(maybe):
                    d = distances(routing[maybe], q)
                    for c, at, r in zip(maybe.tolist(), d.tolist(), radius[maybe].tolist(), strict=True):
                        if at - r <= limit:
                            heapq.heappush(queue, (max(0.0, at - r), own[c], at))
        return [(s, -i) for s, i in best]


PAGES = "block bigint, page int, parent int, leaf boolean, routing array<double>, radius double, to_parent double, entry array<double>, ids array<bigint>, points array<double>, most double"


def whole(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, x, dim) with x = floor(scale * component), for vectors that are not null and hold finite numbers only. Rows with a null key take no part."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows.select("id", F.transform("v", lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("x"), F.size("v").alias("dim"))


def blocks_of(rows: DataFrame, sample: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """``rows`` with ``block``: the dimension, the cell of the nearest pivot and a share of the cell."""
    pivots = {dim: spread_out(x, PIVOTS) for dim, x in sample.items()}

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                if dim and dim in pivots:
                    x = flat(batch.column(1).take(pa.array(rows)), int(dim))
                    cell[rows] = np.argmin(np.stack([distances(x, p) for p in pivots[dim]]), axis=0)
            yield pa.record_batch([*batch.columns, pa.array(cell)], names=["id", "x", "dim", "cell"])

    placed = stored(in_batches(rows, cells, "id bigint, x array<double>, dim int, cell bigint"))
    # a row for each pivot of each dimension
    sizes = placed.groupBy("dim", "cell").count().withColumn("shares", F.ceil(F.col("count") / block_rows))
    share = F.pmod(F.xxhash64("id", "x"), F.col("shares"))  # a hot vector has one share for each of its keys
    return placed.join(F.broadcast(sizes.drop("count")), ["dim", "cell"]).select("id", "x", "dim", F.xxhash64("dim", "cell", share).alias("block"))


def built(blocks: DataFrame) -> DataFrame:
    """The pages of a tree for each block."""

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim = table.column("dim")[0].as_py()
        ids, points = table.column("id").to_numpy(), flat(table.column("x").combine_chunks(), dim) if dim else np.zeros((table.num_rows, 0))
        most = float((points * points).sum(axis=1).max())
        block, out = table.column("block")[0].as_py(), []
        for p in bulk_loaded(lifted(points, most)):
            out.append((block, p["page"], p["parent"], p["leaf"], p["routing"], p["radius"], p["to_parent"], p["entry"], ids[p["rows"]], points[p["rows"]].ravel(), most))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.float64()]
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in PAGES.split(", ")])

    return blocks.groupBy("block").applyInArrow(build, PAGES)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``queries`` the ``k`` rows of ``vectors`` with the greatest inner product, ties to the smaller key.

    Both tables have ``key`` and ``vector``; components become floor(scale * component). A vector that is null or has a null
    or non-finite component, or a null key, takes no part on either side. Rows with the query's key are no candidates of
    it; other rows that repeat a key each are. Queries that repeat key and vector are answered once. Only vectors of a
    query's own length are its candidates; empty ones have score 0. Fewer than k candidates are all returned; an empty
    table gives an empty result. Scores are exact while they stay below 2^53.
    """
    rows = stored(whole(vectors, key, vector, scale))
    asked = whole(queries, key, vector, scale).dropDuplicates(["id", "x"])
    n = rows.count()
    chance = F.pmod(F.xxhash64(F.lit("sample"), "id", "x"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / max(1, n)))
    sample: dict[int, list] = {}
    for r in rows.where(chance).orderBy(F.xxhash64(F.lit("sample"), "id", "x")).limit(2 * SAMPLE_ROWS).collect():
        if r.dim:
            sample.setdefault(r.dim, []).append((r.id, r.x))
    first_ids = {d: np.array([i for i, _ in v]) for d, v in sample.items()}
    first_rows = {d: np.array([x for _, x in v]) for d, v in sample.items()}
    pages = stored(built(blocks_of(rows, first_rows, block_rows)))
    blocks = pages.where("parent = -1").select(F.col("block").alias("home"), (F.size("routing") - 1).alias("dim"))

    chunks = max(1, -(-asked.count() // chunk_rows))
    asked = stored(asked.withColumn("chunk", F.pmod(F.xxhash64("id", "x"), F.lit(int(chunks)))))
    # every query chunk against every block: one task each, with a bounded share of both
    few = blocks.count() <= BROADCAST_BLOCKS
    sides = asked.join(F.broadcast(blocks) if few else blocks, "dim").select("home", "chunk", "id", "x", F.xxhash64("id", "x").alias("q"))
    each = pages.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(int(chunks) - 1).cast("bigint"))))

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            plain = ["page", "parent", "leaf", "radius", "to_parent", "most"]
            listed = left.select(plain).to_pylist()
            for p, routing, entry, ids, points in zip(listed, *(rows_of(left.column(c)) for c in ("routing", "entry", "ids", "points")), strict=True):
                p |= {"routing": routing, "entry": entry, "ids": ids, "points": points.reshape(len(ids), len(routing) - 1)}
            tree = Tree(listed, listed[0]["most"])
            for q, x in zip(right.select(["q", "id"]).to_pylist(), rows_of(right.column("x")), strict=True):
                bound = -np.inf
                if len(x) in first_rows:
                    some = (first_rows[len(x)] @ x)[first_ids[len(x)] != q["id"]]
                    if len(some) >= k:
                        bound = float(np.partition(some, len(some) - k)[len(some) - k])
                found += [(q["q"], q["id"], i, int(s)) for s, i in tree.search(x, q["id"], k, bound) if s >= bound]
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["q", "query_id", "vec_id", "score"])

    hits = each.groupBy("block", "chunk").cogroup(sides.groupBy("home", "chunk")).applyInArrow(search, "q bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int, every: int, scale: int = 256) -> str:
    """Every product, in DuckDB, for vectors of one length over ``embeddings``."""
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % {every} = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}
"""
