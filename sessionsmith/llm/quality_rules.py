"""Quality rules with thresholds that adapt to each language and source.

Each document is measured once. A quantile sketch per (language, source, measure) counts documents in buckets whose bounds
grow by a fixed factor, so a quantile read from it is within ``ACCURACY`` of the exact one, relatively. Sketches merge by
adding counts: partial sketches of tasks, the sketch of a language from those of its sources, the sketch of everything
from those of the languages. The result does not depend on how rows were dealt out.

Thresholds are fences beyond the quartiles, on the logarithmic scale of the buckets, and are joined back to the documents.
Rates of rare things are smoothed by half a count, (k + 1/2) / (n + 1), so that "none in n words" is a small value that depends
on n: a group in which most texts have none still has a range, and its own sketch decides how far a fence lies. Fences of a
group are blended with those of its language, and these with those of the table, by their numbers of documents against
``PRIOR``; they move smoothly as a group grows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_batches, stored

#: Up to this many languages and sources their thresholds (some 200 bytes each) are broadcast.
BROADCAST_GROUPS = 100_000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks")
#: Relative accuracy of a sketch's quantiles.
ACCURACY = 0.0025
GROWTH = (1 + ACCURACY) / (1 - ACCURACY)
#: Values up to this count as zero, which has a bucket of its own.
ZERO = 1e-12
ZERO_BUCKET = -6000
#: The thresholds of a language weigh as much as this many documents in those of its sources; the table's likewise in a language's.
PRIOR = 100
#: A guard for groups whose texts are all alike: interquartile ranges count at least this many buckets (2 %).
LEAST_RANGE = 4
#: measure -> (fences lie this many interquartile ranges beyond the quartiles, whether low values are rejected too).
#: Shares of rare things have the nearer fences; shares and means over all words vary more in short texts.
MEASURES: dict[str, tuple[float, bool]] = {
    "symbol_ratio": (3.0, False),
    "mark_ratio": (3.0, False),
    "upper_ratio": (4.0, False),
    "dup_line_ratio": (3.0, False),
    "repeat_ratio": (3.0, False),
    "word_length": (4.0, True),
}


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, width: int = WINDOW) -> np.ndarray:
    """Per document, the words that lie in a ``width``-word window occurring at least twice in it. ``ids``: words of all documents in a row."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(n_docs, np.int64)
    rng = np.random.default_rng(7)
    code = rng.integers(0, 2**63, int(ids.max()) + 1, dtype=np.uint64)[ids]
    with np.errstate(over="ignore"):
        mixed = rng.integers(0, 2**63, n_docs, dtype=np.uint64)[doc[:n]]
        for j in range(width):
            mixed = mixed + code[j : j + n] * np.uint64(2 * int(rng.integers(0, 2**62)) + 1)
    inside = doc[:n] == doc[width - 1 :]
    values = np.sort(mixed[inside])
    twice = np.unique(values[1:][values[1:] == values[:-1]])
    if not len(twice):
        return np.zeros(n_docs, np.int64)
    at = np.minimum(np.searchsorted(twice, mixed), len(twice) - 1)
    at = np.flatnonzero(inside & (twice[at] == mixed))  # candidates; the words themselves decide
    keys = np.stack([doc[at], *(ids[at + j] for j in range(width))])
    order = np.lexsort(keys)
    alike = (keys[:, order[1:]] == keys[:, order[:-1]]).all(axis=0)
    hit = np.zeros(len(at), bool)
    hit[order[1:]] |= alike
    hit[order[:-1]] |= alike
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, at[hit], 1)
    np.add.at(edges, at[hit] + width, -1)
    return np.bincount(doc[np.cumsum(edges[:-1]) > 0], minlength=n_docs)


def measured(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for each text."""
    n = len(texts)
    out = {c: np.zeros(n, np.int64) for c in COUNTS}
    vocabulary: dict[bytes, int] = {}
    number = vocabulary.setdefault
    ids: list[np.ndarray] = []
    for k, raw in enumerate(texts):
        words = raw.split()
        ids.append(np.array([number(w, len(vocabulary)) for w in words], np.int64))
        histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        spaces = int(histogram[list(SPACES)].sum())
        upper = int(histogram[65:91].sum())
        lines = [x for x in raw.split(b"\n") if x.strip()]
        got = (len(words), int(histogram[:128].sum() + histogram[192:].sum()) - spaces, histogram[list(SYMBOLS)].sum(), len(lines) - len(set(lines)), 0, len(lines), upper, upper + int(histogram[97:123].sum()), histogram[33] + histogram[63])
        for c, v in zip(COUNTS, got, strict=True):
            out[c][k] = v
    doc = np.repeat(np.arange(n), out["n_words"])
    out["n_repeat_words"] = repeated_words(np.concatenate(ids) if ids else np.zeros(0, np.int64), doc, n)
    return out


def base_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of each row, and the counts of its whole text (null: none)."""
    passed = keep if text in keep else [*keep, text]
    place = passed.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(place).cast(pa.large_binary()).to_pylist()]
            ends, size = [], 0
            for k, t in enumerate(texts):  # in parts of some MB
                size += len(t)
                if size > 4e6 or k == len(texts) - 1:
                    ends.append(k + 1)
                    size = 0
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                got = measured(texts[a:b])
                yield pa.record_batch([*(batch.column(i).slice(a, b - a) for i in range(len(keep))), *(pa.array(got[c]) for c in COUNTS)], names=[*keep, *COUNTS])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} bigint" for c in COUNTS)])
    return in_batches(docs.select(*[F.col(f"`{c}`") for c in passed]), run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measures() -> dict[str, Column]:
    ratio = lambda a, b: (F.col(a) + 0.5) / (F.col(b) + 1)
    return {
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "mark_ratio": ratio("n_marks", "n_words"),
        "upper_ratio": ratio("n_upper", "n_letters"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "word_length": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
    }


def bucket(value: Column) -> Column:
    """Bucket of a non-negative value."""
    return F.when(value <= ZERO, ZERO_BUCKET).otherwise(F.ceil(F.log(value) / math.log(GROWTH))).cast("int")


def sketches(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """(lang, source, measure, bucket, n): one sketch per language, source and measure. ``rows`` has a column for each measure."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES]))
    return rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), pairs.alias("p")).groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame) -> DataFrame:
    """Level 0: the sketches as they are; 1: those of a language's sources merged; 2: all merged."""
    null = F.lit(None).cast("string")
    levels = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), (null if k > 1 else F.col("lang")).alias("lang"), (null if k else F.col("source")).alias("source")) for k in range(3)]))
    return sketch.select(levels.alias("g"), "measure", "bucket", "n").groupBy("g.level", "g.lang", "g.source", "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, reach: float | None = None) -> DataFrame:
    """Per level, language and source one row: ``docs``, and ``low_{measure}`` and ``high_{measure}`` as buckets. ``reach`` replaces that of all measures.

    A window holds the buckets of one sketch: their number is bounded by the accuracy, whatever the number of documents.
    """
    of = ["level", "lang", "source", "measure"]
    upto = F.sum("n").over(Window.partitionBy(*of).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy(*of).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = sketch.withColumns({"upto": upto, "total": total})
    quartile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bucket")))
    per = ranked.groupBy(*of).agg(F.max("total").alias("total"), quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    reaches = F.create_map(*[x for m, (r, _) in MEASURES.items() for x in (F.lit(m), F.lit(float(r if reach is None else reach)))])[F.col("measure")]
    per = per.withColumn("width", reaches * F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_RANGE)))
    one = lambda m, fence, name: F.max(F.when(F.col("measure") == m, fence)).alias(f"{name}_{m}")
    both = [one(m, *x) for m in MEASURES for x in ((F.col("q1") - F.col("width"), "low"), (F.col("q3") + F.col("width"), "high"))]
    return per.groupBy("level", "lang", "source").agg(F.max("total").alias("docs"), *both)


def blended(table: DataFrame, limits: list[str], prior: float) -> DataFrame:
    """``lang_0``, ``source_0`` and ``limits`` of every group: its own fences, and by weight those of its language and of the table.

    ``table``: a stored result of ``fences``. The table's own fences are one row, read by the driver.
    """
    level = lambda k, on: table.where(F.col("level") == k).select(*[F.col(c).alias(f"{c}_{k}") for c in on], F.col("docs").alias(f"docs_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in limits])
    of = level(0, ["lang", "source"]).join(level(1, ["lang"]), F.col("lang_0").eqNullSafe(F.col("lang_1")))
    overall = table.where(F.col("level") == 2).first()  # one row
    mixed = lambda c, k, parent: (F.col(f"docs_{k}") * F.col(f"{c}_{k}") + F.lit(float(prior)) * parent) / (F.col(f"docs_{k}") + F.lit(float(prior)))
    return of.select("lang_0", "source_0", *[mixed(c, 0, mixed(c, 1, F.lit(overall and overall[c]).cast("double"))).alias(c) for c in limits])


def judged(counts: DataFrame, lang: str = "lang", source: str = "source", reach: float | None = None, prior: float = PRIOR) -> DataFrame:
    """``counts`` (a stored table with ``COUNTS``, language and source) with ``base_failed``, the violated measures in ``outside``, and ``kept``.

    Thresholds come from documents that pass the base rules, so junk that those already reject doesn't shift them.
    Null language or source: a group of its own. Without documents that pass, no thresholds exist and none reject.
    """
    rows = counts.withColumn("base_failed", base_failed()).withColumns(measures())
    table = stored(fences(merged(sketches(rows.where(~F.col("base_failed")), lang, source)), reach))
    limits = [f"{side}_{m}" for m in MEASURES for side in ("low", "high")]
    of = blended(table, limits, prior)
    if table.count() <= BROADCAST_GROUPS:  # else the join deals out by language and source, and Spark splits hot ones
        of = F.broadcast(of)
    joined = rows.join(of, rows[lang].eqNullSafe(of["lang_0"]) & rows[source].eqNullSafe(of["source_0"]), "left")
    out = lambda m, both: (bucket(F.col(m)) > F.col(f"high_{m}")) | (bucket(F.col(m)) < F.col(f"low_{m}") if both else F.lit(False))
    outside = F.array_compact(F.array(*[F.when(out(m, both), F.lit(m)) for m, (_, both) in MEASURES.items()]))
    return joined.withColumn("outside", outside).withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0)).select(*counts.columns, "base_failed", "outside", "kept")


def quality_rules(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source", **options) -> DataFrame:
    """Verdict on each row of ``docs``: ``keep`` columns, counts, ``base_failed``, ``outside`` and ``kept``.

    A null text counts as empty and fails the base rules. Repeated rows are judged alike; other columns are not read; an
    empty table gives an empty one. Language and source may be null.
    """
    keep = list(dict.fromkeys([*keep, lang, source]))
    return judged(stored(base_counts(docs, keep, text)), lang, source, **options)


def oracle() -> str:
    """The same in DuckDB SQL, over ``documents``."""
    ratios = {"symbol_ratio": ("n_symbols", "n_words"), "mark_ratio": ("n_marks", "n_words"), "upper_ratio": ("n_upper", "n_letters"), "dup_line_ratio": ("n_dup_lines", "n_lines"), "repeat_ratio": ("n_repeat_words", "n_words")}
    values = {m: f"(CAST({a} AS DOUBLE) + 0.5::DOUBLE) / ({b} + 1)" for m, (a, b) in ratios.items()} | {"word_length": "CAST(word_chars AS DOUBLE) / greatest(n_words, 1)"}
    measure = " UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, '{m}' AS measure, {v} AS v FROM base" for m, v in values.items())
    reaches = " ".join(f"WHEN '{m}' THEN {reach}::DOUBLE" for m, (reach, _) in MEASURES.items())
    mixed = lambda own, docs, parent: f"(CAST({docs} AS DOUBLE) * {own} + {PRIOR}::DOUBLE * {parent}) / (CAST({docs} AS DOUBLE) + {PRIOR}::DOUBLE)"
    fence = lambda side: mixed(f"s.{side}", "s.docs", f"({mixed(f'l.{side}', 'l.docs', f'a.{side}')})")
    both = ", ".join(f"'{m}'" for m, (_, low) in MEASURES.items() if low)
    return f"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS k FROM d, unnest(range(1, len(w) - 3)) AS t(i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS u(p) WHERE n > 1 GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, lang, source, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
valued AS ({measure}),
measured AS (SELECT *, CAST(CASE WHEN v <= {ZERO}::DOUBLE THEN {ZERO_BUCKET} ELSE ceil(ln(v) / {math.log(GROWTH)!r}::DOUBLE) END AS INTEGER) AS bucket FROM valued),
bucketed AS (SELECT * FROM measured WHERE NOT base_failed),
levels AS (
  SELECT 0 AS level, lang, source, measure, bucket, count(*) AS n FROM bucketed GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, measure, bucket, count(*) FROM bucketed GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, measure, bucket, count(*) FROM bucketed GROUP BY ALL
),
summed AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure) AS total, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS upto FROM levels),
quartiles AS (
  SELECT level, lang, source, measure, max(total) AS docs, min(bucket) FILTER (WHERE upto >= 0.25 * total) AS b1, min(bucket) FILTER (WHERE upto >= 0.75 * total) AS b3
  FROM summed GROUP BY level, lang, source, measure
),
widths AS (SELECT *, (CASE measure {reaches} END) * greatest(b3 - b1, {LEAST_RANGE}) AS width FROM quartiles),
fences AS (SELECT level, lang, source, measure, docs, b1 - width AS low, b3 + width AS high FROM widths),
chosen AS (
  SELECT s.lang, s.source, s.measure, {fence('low')} AS low, {fence('high')} AS high
  FROM fences s JOIN fences l ON l.level = 1 AND s.lang IS NOT DISTINCT FROM l.lang AND s.measure = l.measure JOIN fences a ON a.level = 2 AND s.measure = a.measure WHERE s.level = 0
),
outside AS (
  SELECT DISTINCT m.doc_id FROM measured m JOIN chosen c ON m.lang IS NOT DISTINCT FROM c.lang AND m.source IS NOT DISTINCT FROM c.source AND m.measure = c.measure
  WHERE m.bucket > c.high OR (m.measure IN ({both}) AND m.bucket < c.low)
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND o.doc_id IS NULL AS kept FROM base b LEFT JOIN outside o ON b.doc_id = o.doc_id
"""
