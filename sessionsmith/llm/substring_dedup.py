"""Duplicate spans by Relative Lempel-Ziv factors against an indexed reference.

The reference is the corpus itself, in blocks: the index is dealt out by the hash of its entries, one block per task.
Entries are anchors: of every 25 consecutive 26-word grams the one with the least hash, so that each 50-word window holds
an anchor at a place that depends on its own words alone. An anchor's reference is the first document that has it.

Each document is parsed greedily from anchor to anchor: a factor goes on as long as the next anchor overlaps or touches the
last one and has the same reference document at the same displacement. Every word of a factor then lies in a matched gram,
so a factor of at least 50 words is a duplicate span, and all windows inside it are settled.

Factors end at anchors, and an anchor's first document need not be the one with the longest match. So windows at factor
boundaries, and those of anchors in no long factor, are checked by 128-bit hashes of the whole window: the first document
that has the window decides. Only windows of anchors that are open somewhere are hashed, in any document that has them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, stored

WINDOW = 50
GRAM = 26
#: Grams in one window; neighbouring anchors are at most this far apart, so they leave no gap.
GRAMS = WINDOW - GRAM + 1
#: Bytes of text that a task works on at a time; a longer text is worked on alone.
PART = 4_000_000
REMEMBERED = 500_000
#: Low bits that hold a word's place while least hashes are sought.
PLACE_BITS = 30
U = np.uint64


class WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        got = self[word] = xxhash.xxh64_intdigest(word)
        return got


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def grams(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes. ``base`` is odd."""
    inverse = pow(base, -1, 2**64)
    power, back = np.full(len(words) + 1, U(base)), np.full(len(words) + 1, U(inverse))
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    total = np.concatenate([np.zeros(1, U), np.cumsum(words * power[:-1])])
    return mixed((total[width:] - total[:-width]) * back[: len(words) - width + 1])


def least_places(hashes: np.ndarray) -> np.ndarray:
    """For each run of ``GRAMS`` hashes the place of the least, the first of equals."""
    low = (hashes >> U(PLACE_BITS) << U(PLACE_BITS)) | np.arange(len(hashes), dtype=U)
    span = 1
    while span * 2 <= GRAMS:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < GRAMS:
        low = np.minimum(low[: len(low) - (GRAMS - span)], low[GRAMS - span :])
    return (low & U((1 << PLACE_BITS) - 1)).astype(np.int64)


class Parsed:
    """Texts of one part: their words in a row, with hashes."""

    def __init__(self, texts: list[bytes], known: WordHashes):
        if len(known) > REMEMBERED:
            known.clear()
        self.words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.hashes = np.fromiter((known[w] for words in self.words for w in words), U, self.first[-1])
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.whole = np.zeros(0, np.int64)  # starts of windows that lie in one document
        self.owner = np.zeros(0, np.int64)  # the anchor of each
        if len(self.hashes) >= WINDOW:
            self.gram = grams(self.hashes, GRAM, 0x9E3779B97F4A7C15)
            least = least_places(self.gram)
            self.whole = np.flatnonzero(self.doc[: len(least)] == self.doc[WINDOW - 1 :])
            self.owner = least[self.whole]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all anchors. The first and last gram of a document count too, so that copies match to their ends."""
        long = np.flatnonzero(self.counts >= WINDOW)
        if not len(long):
            return np.zeros(0, np.int64), np.zeros(0, U)
        places = np.unique(np.concatenate([self.owner, self.first[long], self.first[long + 1] - GRAM]))
        return places, self.gram[places]


def parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PART`` bytes."""
    a, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t) > PART:
            yield a, k
            a, size = k, 0
        size += len(t)
    if a < len(texts):
        yield a, len(texts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(U).view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def without(words: list[bytes], starts: list[int], ends: list[int]) -> tuple[int, str]:
    """How many words the ranges cover, and the digest of the others."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.array(starts, np.int64), 1)
    np.add.at(edges, np.array(ends, np.int64), -1)
    gone = np.cumsum(edges[:-1]) > 0
    return int(gone.sum()), digest([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def indexed(rows: DataFrame) -> DataFrame:
    """Per row (id, tid, text): number of words, digest of all, and anchors with their places. A null id has no anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = [t or b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()]
                there = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                for a, b in parts(texts):
                    p = Parsed(texts[a:b], known)
                    places, hashes = p.anchors()
                    of = p.doc[places] if len(places) else places
                    named = there[a:b][of]
                    places, hashes, of = places[named], hashes[named], of[named]
                    bounds = np.searchsorted(of, np.arange(b - a + 1))
                    columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(p.counts), pa.array([digest(w) for w in p.words])]
                    yield pa.record_batch([*columns, lists(signed(hashes), bounds, pa.int64()), lists(places - p.first[of], bounds, pa.int32())], names=["id", "tid", "n_words", "sha", "anchors", "places"])

    return in_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, tid bigint, n_words bigint, sha string, anchors array<bigint>, places array<int>")


def factors(matches: DataFrame) -> DataFrame:
    """Greedy parse. ``matches``: (id, tid, n_words, found: array of (place, anchor, ref, ref_place)) with anchors that several documents have.

    Gives the factors of at least a window as ``starts`` and ``ends``, and the anchors with ``query`` (an earlier document
    has it) and ``open`` (some window with it is in no factor).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n_words, found = batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3)
            bounds = found.offsets.to_numpy() - found.offsets[0].as_py()
            place, anchor, ref, ref_place = (found.flatten().field(k).to_numpy().astype(np.int64) for k in range(4))
            of = np.repeat(np.arange(len(ids)), np.diff(bounds))
            order = np.lexsort((place, of))
            place, anchor, ref, ref_place = place[order], anchor[order], ref[order], ref_place[order]
            query = ref < ids[of]
            step = np.diff(place)
            goes_on = (of[1:] == of[:-1]) & query[1:] & query[:-1] & (ref[1:] == ref[:-1]) & (np.diff(ref_place) == step) & (step <= GRAM)
            run_id = np.concatenate([[0], np.cumsum(~goes_on)]) if len(place) else np.zeros(0, np.int64)
            head = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(place) else np.zeros(0, np.int64)
            tail = np.append(head[1:], len(place)) - 1
            start, end = place[head], place[tail] + GRAM
            long = (end - start >= WINDOW) & query[head]
            inside = long[run_id] & (np.maximum(0, place - (GRAMS - 1)) >= start[run_id]) & (np.minimum(n_words[of], place + WINDOW) <= end[run_id])
            cut = np.searchsorted(of[head[long]], np.arange(len(ids) + 1))
            columns = [lists(start[long], cut, pa.int32()), lists(end[long], cut, pa.int32()), lists(anchor, bounds, pa.int64()), lists(place, bounds, pa.int32()), lists(query, bounds, pa.bool_()), lists(query & ~inside, bounds, pa.bool_())]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], names=["id", "tid", "starts", "ends", "anchors", "places", "query", "open"])

    return in_batches(matches, run, f"id {matches.schema['id'].dataType.simpleString()}, tid bigint, starts array<int>, ends array<int>, anchors array<bigint>, places array<int>, query array<boolean>, open array<boolean>")


def boundary_windows(rows: DataFrame) -> DataFrame:
    """``rows``: (id, tid, text, starts, ends, checked: array of (place, query)). Hashes of the windows whose anchor is to be checked and that are in no factor.

    A row without query windows is finished: ``n_removed`` and ``sha``. Another keeps its text for later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = [t or b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()]
                for a, b in parts(texts):
                    p = Parsed(texts[a:b], known)
                    starts, ends, checked = (batch.column(k).slice(a, b - a).to_pylist() for k in (3, 4, 5))
                    settled = np.zeros(len(p.hashes) + 1, np.int64)
                    level = np.zeros(len(p.hashes) + 1, np.int8)  # 1: reference only, 2: query
                    for k in range(b - a):
                        for s, e in zip(starts[k], ends[k], strict=True):
                            settled[p.first[k] + s] += 1
                            settled[p.first[k] + e - WINDOW + 1] -= 1
                        for c in checked[k] or ():
                            level[p.first[k] + c["place"]] = 2 if c["query"] else 1
                    settled = np.cumsum(settled) > 0
                    wanted = (level[p.owner] > 0) & ~settled[p.whole]
                    at, query = p.whole[wanted], level[p.owner[wanted]] == 2
                    of = p.doc[at]
                    if len(at):
                        high, low = (grams(x, WINDOW, base)[at] for x, base in ((p.hashes, 0xD6E8FEB86659FD93), (mixed(p.hashes + U(1)), 0xA0761D6478BD642F)))
                    else:
                        high = low = np.zeros(0, U)
                    bounds = np.searchsorted(of, np.arange(b - a + 1))
                    later = np.bincount(of[query], minlength=b - a) > 0
                    done = [(None, None) if later[k] else without(p.words[k], starts[k], ends[k]) for k in range(b - a)]
                    left = [texts[a + k].decode() if later[k] else None for k in range(b - a)]
                    columns = [lists(signed(high), bounds, pa.int64()), lists(signed(low), bounds, pa.int64()), lists(at - p.first[of], bounds, pa.int32()), lists(query, bounds, pa.bool_())]
                    yield pa.record_batch([*(batch.column(i).slice(a, b - a) for i in (0, 1)), pa.array(left, pa.string()), *(batch.column(i).slice(a, b - a) for i in (3, 4)), *columns, pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["id", "tid", "text", "starts", "ends", "high", "low", "at", "query", "n_removed", "sha"])

    return in_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, tid bigint, text string, starts array<int>, ends array<int>, high array<bigint>, low array<bigint>, at array<int>, query array<boolean>, n_removed bigint, sha string")


def finished(rows: DataFrame) -> DataFrame:
    """``rows``: (id, tid, text, starts, ends, at): factors and windows to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for raw, starts, ends, at in zip(batch.column(2).cast(pa.large_binary()).to_pylist(), *(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                at = at or []
                done.append(without(raw.split(), [*starts, *at], [*ends, *(x + WINDOW for x in at)]))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["id", "tid", "n_removed", "sha"])

    return in_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, tid bigint, n_removed bigint, sha string")


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_words``, ``n_removed`` and ``kept_sha256`` after removal of every word that lies in a window whose words also start in a document with a smaller key.

    A null text has no words. A row with a null key has no smaller key and is none: it stays whole. Rows that repeat a key
    are judged alike, never against each other. Other columns are not read; an empty table gives an empty one. ``key`` is
    an integer.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("tid"), F.col(f"`{text}`").alias("text"))
    index = stored(indexed(rows))
    entries = index.select("id", "tid", "n_words", F.explode(F.arrays_zip("anchors", "places")).alias("e")).select("id", "tid", "n_words", F.col("e.anchors").alias("anchor"), F.col("e.places").alias("place"))
    # stored, so that the join deals out both sides anew and an anchor that very many documents have can be split
    shared = stored(entries.groupBy("anchor").agg(F.min("id").alias("ref"), F.min_by("place", "id").alias("ref_place"), F.max("id").alias("last")).where(F.col("ref") < F.col("last")).drop("last"))
    found = F.collect_set(F.struct("place", "anchor", F.col("ref").cast("bigint").alias("ref"), "ref_place")).alias("found")
    parsed = stored(factors(entries.join(shared, "anchor").groupBy("id", "tid").agg(F.max("n_words").alias("n_words"), found).select("id", "tid", "n_words", "found")))

    places = parsed.select("id", "tid", F.explode(F.arrays_zip("anchors", "places", "query", "open")).alias("p")).select("id", "tid", F.col("p.anchors").alias("anchor"), F.struct(F.col("p.places").alias("place"), F.col("p.query").alias("query")).alias("at"), F.col("p.open").alias("open"))
    unsettled = stored(places.where("open").select("anchor").distinct())
    checked = places.join(unsettled, "anchor", "left_semi").groupBy("id", "tid").agg(F.collect_list("at").alias("checked"))
    known = parsed.where((F.size("starts") > 0)).select("id", "tid", "starts", "ends").join(checked, ["id", "tid"], "full")
    none = F.array().cast("array<int>")
    known = known.select("id", "tid", F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"), "checked")
    windows = stored(boundary_windows(rows.join(known, ["id", "tid"]).select("id", "tid", "text", "starts", "ends", "checked")))

    single = windows.select("id", "tid", F.explode(F.arrays_zip("high", "low", "at", "query")).alias("w")).select("id", "tid", "w.*")
    first = stored(single.groupBy("high", "low").agg(F.min("id").alias("first"), F.max(F.when(F.col("query"), F.col("id"))).alias("last")).where(F.col("first") < F.col("last")).drop("last"))
    repeated = single.where("query").join(first, ["high", "low"]).where(F.col("id") > F.col("first")).groupBy("id", "tid").agg(F.collect_set("at").alias("at"))
    waiting = windows.where(F.col("sha").isNull()).select("id", "tid", "text", "starts", "ends")
    late = finished(waiting.join(repeated, ["id", "tid"], "left").select("id", "tid", "text", "starts", "ends", "at"))
    done = windows.where(F.col("sha").isNotNull()).select("id", "tid", "n_removed", "sha").unionByName(late).dropDuplicates(["id", "tid"]).withColumnRenamed("sha", "kept")
    out = index.select("id", "tid", "n_words", "sha").join(done, ["id", "tid"], "left")
    return out.select(F.col("id").alias(key), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"))


#: Over all windows, in DuckDB.
ORACLE = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS k FROM d, unnest(range(1, len(w) - {WINDOW - 2})) AS t(i)),
first AS (SELECT *, min(doc_id) OVER (PARTITION BY k) AS owner FROM windows),
gone AS (SELECT DISTINCT doc_id, p FROM first, unnest(range(i, i + {WINDOW})) AS u(p) WHERE owner < doc_id),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
left_over AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n FROM words x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p WHERE g.p IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN left_over l ON d.doc_id = l.doc_id
"""
