"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing to target weights, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, which is what its predecessor kept. All stages but
the last return the columns of ``documents``; ``sf_dir`` holds the tables that are not documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionsmith.context import Workspace, default_workspace
from sessionsmith.llm import line_dedup, mixing, pieces, quality_rules, queries, simhash
from sessionsmith.llm.common import scratch, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are not in ``gone`` (_doc_id, _text_id).

    Both sides are dealt out by document: the list of documents grows with the corpus, so the plan doesn't depend on
    whether it still fits a broadcast, and no key is hot.
    """
    match = docs["doc_id"].eqNullSafe(gone["_doc_id"]) & F.xxhash64(docs["text"]).eqNullSafe(gone["_text_id"])
    return docs.join(gone.hint("merge"), match, "left_anti").select(*COLUMNS)


def identified(docs: DataFrame) -> DataFrame:
    """With the hash that stands for a text where texts need not travel: a key and it tell rows apart unless they are the same."""
    return docs.withColumn("_text_id", F.xxhash64("text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Texts stay with their counts, so that verdicts need no join back."""
    return quality_rules.quality_rules(docs, COLUMNS).where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sources share. The first document with a line keeps it."""
    cleaned = line_dedup.line_dedup(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id (a null one last), of several texts for it the one with the least hash."""
    found = stored(simhash.near_duplicates(identified(docs), keep=("_text_id",)))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text_id")
    first = stored(found.groupBy("root").agg(F.min(order).alias("first")))
    others = found.join(first, "root").where(~order.eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("_doc_id"), "_text_id").distinct()
    kept = without(docs, stored(others))
    if found.groupBy("doc_id", "_text_id").count().where("count > 1").isEmpty():
        return kept
    return kept.dropDuplicates(["doc_id", "text"])  # rows that repeat a document


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates, up to 1, that bring the labelled domains nearest to their weights."""
    rated = mixing.mixed(identified(docs), queries.domains(table(spark, sf_dir, "labels")), queries.DOMAIN_WEIGHTS, ["doc_id", "_text_id"], steady=0, most=1.0)
    undrawn = rated.where(~mixing.drawn(F.col("rate"), "doc_id", "_text_id")).select(F.col("doc_id").alias("_doc_id"), "_text_id").distinct()
    return without(docs, stored(undrawn))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return pieces.encoding_digests(docs, queries.piece_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("mixing", mixture),
    ("sentencepiece", encoding),
]

#: SQL expresses neither the fingerprints of the near-duplicate stage nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is a table in the shared folder that the next one reads.

    What a stage writes for itself is deleted when its result is written, a result when the next one is, all of it also after
    an error. The rows returned read the last table; ``release_materialized`` deletes that one once they are used.
    """
    docs = table(spark, sf_dir, "documents")
    with Workspace(spark) as results:
        for _, stage in STAGES[:-1]:
            with scratch(spark):
                docs = results.materialize(stage(spark, docs, sf_dir))
            newest = results.paths.pop()
            results.release()
            results.paths.append(newest)
        last = STAGES[-1][1](spark, docs, sf_dir)
        default_workspace(spark).paths.append(results.paths.pop())
    return last
