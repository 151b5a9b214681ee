"""Removal of lines that many sites share.

Each distinct line has a HyperLogLog sketch of the sites it occurs on; sketches merge by aggregation, so a line on all
sites travels as one small sketch per task. A line whose estimate is clearly above or below the limit is decided by it.
Lines near the limit, where the sketch could be wrong, get an exact distinct count of their sites.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, stored

#: Distinct sites from which on a line is boilerplate.
LEAST_SITES = 10
#: log2 of the sketch's registers: a standard error of 1.04 / 64.
LOG_REGISTERS = 12
#: Estimates within this fraction of the limit (over ten standard errors) are counted exactly.
NEAR = 0.2
_WORD = r"[^\x20\x09-\x0D]"


def line_id(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def occurrences(docs: DataFrame, key: str, site: str, text: str) -> DataFrame:
    """One row per document and distinct line with a word. A null site counts as a site of its own."""
    lines = F.explode(F.array_distinct(F.split(F.col(f"`{text}`"), "\n"))).alias("line")
    of = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("text_id"), F.when(F.col(f"`{site}`").isNull(), "null").otherwise(F.concat(F.lit("="), F.col(f"`{site}`").cast("string"))).alias("site"), lines)
    return of.where(F.col("line").rlike(_WORD)).withColumn("id", line_id(F.col("line")))


def unused(names: list[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that none of ``names`` equals, in either case."""
    taken = {n.lower() for n in names}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def spread(lines: DataFrame, least_sites: int = LEAST_SITES, near: float = NEAR) -> DataFrame:
    """(id, owner) of every line on at least ``least_sites`` distinct sites; owner: the smallest key that has it."""
    sketched = stored(lines.groupBy("id").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("sketch"), F.min("key").alias("owner")).select("id", "owner", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= least_sites * (1 - near)))
    above = F.col("sites") > least_sites * (1 + near)
    close = sketched.where(~above)
    exact = lines.select("id", "site").join(close.select("id"), "id", "left_semi").distinct().groupBy("id").count().where(F.col("count") >= least_sites).select("id")
    return sketched.where(above).select("id", "owner").unionByName(close.join(exact, "id", "left_semi").select("id", "owner"))


def line_dedup(docs: DataFrame, key: str = "doc_id", site: str = "source", text: str = "text", least_sites: int = LEAST_SITES, keep_first: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; all its columns, and ``n_lines_removed``.

    A line occurs on a site if a document of the site has it, however often. With ``keep_first`` the document with the
    smallest key that has a line keeps it, so that text which is copied whole to many sites stays in the corpus once.
    Lines without a word always stay. A null text stays null; an empty text or table stays empty. Rows that repeat key
    and text are treated alike. A null key is never the smallest unless all keys of a line are null: then they all keep it.
    Other columns may have any names, dotted ones too; one named ``n_lines_removed`` is replaced.
    """
    lines = occurrences(docs, key, site, text)
    common = stored(spread(lines, least_sites))
    gone = lines.join(common, "id")
    if keep_first:
        gone = gone.where(~F.col("key").eqNullSafe(F.col("owner")))
    names = [c for c in docs.columns if c.lower() != "n_lines_removed"]
    of_key, of_text, of_lines = unused(docs.columns, "key", "text_id", "lines")
    gone = gone.groupBy("key", "text_id").agg(F.collect_list("line").alias(of_lines)).withColumnsRenamed({"key": of_key, "text_id": of_text})
    match = F.col(f"`{key}`").eqNullSafe(F.col(of_key)) & F.xxhash64(F.col(f"`{text}`")).eqNullSafe(F.col(of_text))
    marked = docs.join(gone, match, "left").select(*[F.col(f"`{c}`") for c in names], of_lines)
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            removed = [0] * len(texts)
            for k, lines in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if lines:
                    out, had = set(lines), texts[k].split("\n")
                    left = [x for x in had if x not in out]
                    texts[k], removed[k] = "\n".join(left), len(had) - len(left)
            columns = [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*columns, pa.array(removed, pa.int64())], names=[f"c{i}" for i in range(len(names) + 1)])

    # By position: mapInArrow takes no dotted names.
    kinds = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names)]
    told = in_batches(marked.toDF(*[f"c{i}" for i in range(len(names) + 1)]), run, ", ".join([*kinds, f"c{len(names)} bigint"]))
    return told.toDF(*names, "n_lines_removed")


#: The same by exact counts.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, i, string_split(text, chr(10))[i] AS line
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)
),
common AS (
  SELECT line, min(doc_id) AS owner FROM lines WHERE regexp_matches(line, '{_WORD}')
  GROUP BY line HAVING count(DISTINCT coalesce('=' || source, 'null')) >= {LEAST_SITES}
),
told AS (SELECT l.doc_id, l.i, l.line, c.line IS NOT NULL AND c.owner <> l.doc_id AS gone FROM lines l LEFT JOIN common c ON l.line = c.line),
kept AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text, count(*) FILTER (gone) AS n_lines_removed
  FROM told GROUP BY doc_id
)
SELECT d.doc_id, k.text, coalesce(k.n_lines_removed, 0) AS n_lines_removed FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
