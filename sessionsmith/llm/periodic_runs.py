"""Runs: stretches of words that repeat with a period, found in tiles and stitched.

Periods are split into octaves [s, 2s), s a power of two. For octave s a document is exploded into tiles: one around each
word number c that s divides, from c - s to c + 5s, so that a tile's size goes with its periods. Word i *agrees* for period q
if words i and i + q are identical; a run of period q and length L is a stretch of L - q agreeing words. With L >= 4q the
stretch has 3s words or more, so it holds the whole block [c, c + 2s) of some tile, and of every further tile on its way.

A tile is solved by itself: the Z-function of the words after its boundary c, and that of the words before it read backwards,
give how far agreement reaches from c to either side, for all periods of the octave at once and in time linear in the tile.
What a tile sees of a stretch is a fragment: at most s words before the boundary and 3s after it. Fragments are shuffled by
document and period; there, those that overlap are stitched to whole stretches.

Only tiles whose block repeats at a distance in the octave can matter. They are found by hashes of blocks before a tile is
written; equal blocks have equal hashes, so no tile is missed, and a tile that a hash let through by mistake has no fragment.

A fragment has more than 2q words, so it shows whether the period is the run's smallest: if a divisor of q is a period too,
it is one of the whole run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, stored

#: A run has at least so many words, and its period so many times.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words in the tiles of one Arrow batch.
TILE_WORDS = 1 << 20


def plant(raw: bytes, key: int) -> bytes:
    """The text's words, for one id in ten with a stretch to the end that repeats its beginning; see ``planted``."""
    h = zlib.crc32(str(key).encode())
    words = raw.split()
    if h % 10 or not words:
        return raw
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join([*words[:a], *(words[a + i % p] for i in range(n - a))])


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text`` of every row, with runs planted in a tenth of them by a checksum of the id. Null ids and texts stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(1).cast(pa.large_binary()).to_pylist()
            out = [t if t is None or k is None else plant(t, k) for k, t in zip(batch.column(0).to_pylist(), raws, strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(batch.schema.field(1).type)], names=[key, text])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, `{text}` string"
    return in_batches(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), run, schema)


def word_codes(words: list[bytes]) -> np.ndarray:
    codes: dict[bytes, int] = {}
    return np.array([codes.setdefault(w, len(codes)) for w in words], np.int32)


def tile_places(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(s, c) of every tile whose block [c, c + 2s) has the same hash as one s to 2s - 1 words later."""
    n = len(codes)
    if n < LEAST_WORDS:
        return
    h = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    s = 1
    while LEAST_PERIODS * s <= n:
        h = h[:-s] * np.uint64(0xBF58476D1CE4E5B9 + 2 * s) + h[s:]  # now of blocks of 2s words
        h ^= h >> np.uint64(31)
        m = (n - 3 * s) // s + 1
        later = h[s : s + m * s]
        if len(later) < m * s:
            later = np.concatenate([later, np.zeros(m * s - len(later), np.uint64)])
        alike = (later.reshape(m, s) == h[: m * s : s][:m, None]).any(axis=1)
        for c in (np.flatnonzero(alike) * s).tolist():
            yield s, c
        s *= 2


def z_function(u: list) -> list[int]:
    """For each position, how many elements from there on equal those from the start on."""
    n = len(u)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right:
            while i + k < n and u[k] == u[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def prime_divisors(q: int) -> Iterator[int]:
    r = 2
    while r * r <= q:
        if q % r == 0:
            yield r
            while q % r == 0:
                q //= r
        r += 1
    if q > 1:
        yield q


def fragments(s: int, before: int, window: list[int]) -> list[tuple[int, int, int]]:
    """(period, words before, words after the boundary) of each stretch that covers the tile's block.

    ``window`` are the tile's words, ``before`` of them ahead of its boundary. Periods that a divisor replaces are left out.
    """
    after = window[before:]
    far = min(2 * s - 1, len(after) - 1)
    forward = z_function(after)
    periods = [q for q in range(s, far + 1) if forward[q] >= 2 * s]
    if not periods:
        return []
    # Backwards, the words before the boundary are the pattern; -1 is no word's code.
    turned = z_function([*window[:before][::-1], -1, *window[: before + far][::-1]])
    end = before + 1 + far  # at end - d: how far words before the boundary agree with those d further on
    found = []
    for q in periods:
        a, b = min(turned[end - q], before), min(forward[q], 3 * s)
        for r in prime_divisors(q):
            d = q // r
            if turned[end - d] >= a and forward[d] >= b + q - d:
                break
        else:
            found.append((q, a, b))
    return found


def exploded(docs: DataFrame, key: str, text: str, texts: bool) -> DataFrame:
    """Rows of two kinds: documents (``octave`` null) and their tiles.

    A document has ``digest`` of its words joined by one space, which with the key is its identity, and that text if it has
    tiles or ``texts`` is set. Tiles are rows of their own, in batches of bounded size, however many a document has.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, digest string, n_words bigint, text string, octave int, at bigint, before int, codes array<int>"

    def rows(keys: pa.Array, digests: list, n_words: list, kept: list, tiles: list | None) -> pa.RecordBatch:
        n = len(digests)
        if tiles is None:
            octave = at = before = pa.nulls(n, pa.int32())
            codes = pa.nulls(n, pa.list_(pa.int32()))
        else:
            octave, before = (pa.array([t[k] for t in tiles], pa.int32()) for k in (0, 2))
            at = pa.array([t[1] for t in tiles], pa.int64())
            stops = np.cumsum([0, *(len(t[3]) for t in tiles)])
            codes = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(np.concatenate([t[3] for t in tiles]), pa.int32()))
        cols = [keys, pa.array(digests, pa.string()), pa.array(n_words, pa.int64()), pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string()), octave, at.cast(pa.int64()), before, codes]
        return pa.record_batch(cols, names=["key", "digest", "n_words", "text", "octave", "at", "before", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, n_words, kept = [], [], []
            owners, names, tiles, size = [], [], [], 0
            for i, raw in enumerate(batch.column(1).cast(pa.large_binary()).to_pylist()):
                words = (raw or b"").split()
                whole = b" ".join(words)
                digest = hashlib.sha256(whole).hexdigest()
                codes = word_codes(words)
                any_tile = False
                for s, c in tile_places(codes):
                    any_tile = True
                    window = codes[max(0, c - s) : c + 5 * s]
                    owners.append(i)
                    names.append(digest)
                    tiles.append((s, c, min(s, c), window))
                    size += len(window)
                    if size > TILE_WORDS:
                        yield rows(batch.column(0).take(pa.array(owners)), names, [None] * len(names), [None] * len(names), tiles)
                        owners, names, tiles, size = [], [], [], 0
                digests.append(digest)
                n_words.append(len(words))
                kept.append(whole if any_tile or texts else None)
            if tiles:
                yield rows(batch.column(0).take(pa.array(owners)), names, [None] * len(names), [None] * len(names), tiles)
            yield rows(batch.column(0), digests, n_words, kept, None)

    return in_batches(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), run, schema)


def solved(tiles: DataFrame) -> DataFrame:
    """Fragments (key, digest, period, first, last) of tiles: agreeing words from ``first`` up to, without, ``last``. Those that overlap are joined within an Arrow batch."""
    kind = tiles.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, digests, octaves, ats, befores = (batch.column(i).to_pylist() for i in range(5))
            flat = batch.column(5)
            found: dict[tuple, list[list[int]]] = {}
            for i in range(batch.num_rows):
                for period, a, b in fragments(octaves[i], befores[i], flat[i].values.to_numpy().tolist()):
                    spans = found.setdefault((keys[i], digests[i], period), [])
                    first, last = ats[i] - a, ats[i] + b
                    if spans and spans[-1][0] <= first <= spans[-1][1]:
                        spans[-1][1] = max(last, spans[-1][1])
                    else:
                        spans.append([first, last])
            out = [(k, d, p, x, y) for (k, d, p), spans in found.items() for x, y in spans]
            cols = [pa.array([r[j] for r in out], t) for j, t in enumerate((batch.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.record_batch(cols, names=["key", "digest", "period", "first", "last"])

    return in_batches(tiles.select("key", "digest", "octave", "at", "before", "codes"), run, f"key {kind}, digest string, period bigint, first bigint, last bigint")


def stitched(found: DataFrame) -> DataFrame:
    """Runs (key, digest, start, length, period): fragments of a document and period that overlap or touch are one stretch.

    Fragments that rows with the same key and text repeat are one before the shuffle; what is left of a document and period is bounded by its words.
    """
    order = Window.partitionBy("key", "digest", "period").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("first") > reach), 1).otherwise(0)
    islands = found.distinct().withColumn("new", new).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("key", "digest", "period", "island").agg(F.min("first").alias("start"), F.max("last").alias("last"))
    length = F.col("last") - F.col("start") + F.col("period")
    runs = whole.select("key", "digest", "start", length.alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period")))


def collapse(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """Words without those that some run has after its first period."""
    depth = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        depth[r["start"] + r["period"]] += 1
        depth[r["start"] + r["length"]] -= 1
    gone = np.cumsum(depth) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=False) if not g]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: bool = True) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (array of start, length, period, by start and period), ``text`` (words that stay, joined by one space), ``digest`` (its SHA-256) of every row.

    A run is a stretch of words whose smallest period is q, of max(6, 4q) words or more, that can't be extended to either
    side. Every run after its first q words is collapsed. Without ``texts`` the collapsed text is null where a document has no
    tile and so no run, and such texts aren't stored; ``digest`` is always set. Null and empty texts have no words; rows that
    repeat a key or a whole row keep their own row, and a null key is a key like any other; an empty table gives an empty one.
    Other columns are not read. A document of any length is solved tile by tile; its runs and its text meet in one row.
    """
    rows = stored(exploded(docs, key, text, texts))
    runs = stitched(solved(rows.where("octave IS NOT NULL")))
    each = stored(runs.groupBy("key", "digest").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs")))
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    # A document without a run isn't changed. Those that may have one are joined with what was found.
    docs_rows = rows.where("octave IS NULL").select("key", "digest", "n_words", "text")
    match = F.col("d.key").eqNullSafe(F.col("r.key")) & (F.col("d.digest") == F.col("r.digest"))
    joined = docs_rows.where("text IS NOT NULL").alias("d").join(each.alias("r"), match, "left").select("d.key", "d.n_words", F.coalesce("r.runs", F.expr(f"CAST(array() AS {kind})")).alias("runs"), "d.text")
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for runs_of, raw in zip(batch.column(2).to_pylist(), batch.column(3).cast(pa.large_binary()).to_pylist(), strict=True):
                left.append(b" ".join(collapse(raw.split(), runs_of)) if runs_of else raw)
            digests = pa.array([hashlib.sha256(t).hexdigest() for t in left], pa.string())
            yield pa.record_batch([*batch.columns[:3], pa.array(left, pa.large_binary()).cast(pa.large_string()).cast(pa.string()), digests], names=["key", "n_words", "runs", "text", "digest"])

    changed = in_batches(joined, run, f"key {key_type}, n_words bigint, runs {kind}, text string, digest string")
    untouched = docs_rows.where("text IS NULL").select("key", "n_words", F.expr(f"CAST(array() AS {kind})").alias("runs"), "text", "digest")
    return changed.unionByName(untouched).withColumnRenamed("key", key)


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: number of runs, the one with the greatest exponent (null without one), digests of all runs and of the text that stays.

    Exponents are compared as doubles: a quotient of whole numbers is correctly rounded, and two different ones of runs in a text of fewer than 10^8 words are further apart than that.
    """
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"] / r["period"]).alias("least"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    milli = F.expr("best.length * 1000 div best.period")
    return found.withColumn("best", best).select(
        F.col(f"`{key}`"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        milli.alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.col("digest").alias("collapsed_sha256"),
    )
